import itertools

import public_tokenizers as P
from odd_rows import SF_SMALL, no_docs, odd_docs  # noqa: F401
from test_near_duplicates import components, plain_fingerprint
from test_tokens import check_pieces
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from panelkit.llm import langid
from panelkit.llm.secret_scan import redact_text
from panelkit.session import scratch_path

NAMES = ["language_id", "exact_dedup", "simhash_dedup", "secret_scan", "packing"]


def expected_texts(spark, docs):
    """Brute force over plain Python rows: id -> text that reaches the packing."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = langid.train(docs)
    langs, scores = langid.score_texts([t for _, t in rows], model)
    rows = [r for r, lang, s in zip(rows, langs, scores) if lang != "und" and s >= C.MIN_LANGUAGE_SCORE]
    largest = {}
    for i, t in rows:
        largest[t or ""] = max(largest.get(t or "", -1), -1 if i is None else i)
    rows = [(None if i == -1 else i, t) for t, i in largest.items()]
    fps = {i: plain_fingerprint(t) for i, t in rows}
    known = [i for i in fps if i is not None]
    part = components(known, [(a, b) for a, b in itertools.combinations(known, 2) if (fps[a] ^ fps[b]).bit_count() <= 3])
    return {i: redact_text(t) for i, t in rows if i is None or part[i] == i}


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    expected = expected_texts(spark, docs)
    assert 0 < len(expected) < docs.count()
    rows = E.queries()["pipeline"](spark, SF_SMALL).collect()
    check_pieces(rows, expected, Tokenizer.from_file(P.path("byte_bpe_50k.json")), 2048)


def test_stages_keep_the_columns_and_stand_odd_rows(spark, odd_docs, no_docs):
    assert [n for n, _ in C.STAGES] == NAMES and C.ORACLE_SQL is None
    docs, empty = odd_docs, no_docs
    for name, stage in C.STAGES:
        folder = scratch_path(spark, "stage")
        stage(spark, docs, SF_SMALL).write.parquet(f"{folder}/docs")
        stage(spark, empty, SF_SMALL).write.parquet(f"{folder}/empty")
        docs, empty = spark.read.parquet(f"{folder}/docs"), spark.read.parquet(f"{folder}/empty")
        if name != "packing":
            assert docs.columns == odd_docs.columns
    expected = expected_texts(spark, odd_docs)
    check_pieces(docs.collect(), expected, Tokenizer.from_file(P.path("byte_bpe_50k.json")), 2048)
    assert empty.collect() == []


def test_documents_without_any_language_are_an_error(spark, odd_docs):
    import pytest
    from pyspark.sql import functions as F

    with pytest.raises(ValueError, match="learn from"):
        C.language_id(spark, odd_docs.withColumn("lang", F.lit(None).cast("string")), SF_SMALL)
