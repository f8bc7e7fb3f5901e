"""A corpus pipeline over ``documents``: identify, deduplicate, mask secrets, pack.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes each stage's result as Parquet into the shared folder
and reads it again, so a lost executor never sets back more than one stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import langid
from panelkit.llm.exact_dedup import drop_exact_duplicates
from panelkit.llm.packing import pack_documents
from panelkit.llm.secret_scan import redact_secrets
from panelkit.llm.simhash import drop_near_duplicates
from panelkit.session import scratch_path

MIN_LANGUAGE_SCORE = 0.5
SHINGLE_WORDS = 3
RADIUS = 3

#: Hashing, lexing and dynamic programming have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go.  Documents of which none can be learnt from are an error."""
    model = langid.train(docs)
    if not model.langs and not docs.isEmpty():
        raise ValueError("no document with text and language to learn from: every document would go")
    return langid.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return drop_exact_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the smallest doc_id stays."""
    return drop_near_duplicates(docs, SHINGLE_WORDS, RADIUS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and n_chars follows; no document goes."""
    return redact_secrets(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash_dedup", simhash_dedup), ("secret_scan", secret_scan), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "corpus-pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
