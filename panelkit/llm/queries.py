"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import langid, quality
from panelkit.llm.bpe_codec import decode_documents, encode_documents
from panelkit.llm.collocations import collocations
from panelkit.llm.exact_dedup import exact_duplicates
from panelkit.llm.lattice_dedup import near_duplicate_vectors
from panelkit.llm.packing import pack_documents
from panelkit.llm.secret_scan import scan_secrets
from panelkit.llm.sharding import interleaved_shards
from panelkit.llm.simhash import near_duplicates
from panelkit.llm.suffix_dedup import remove_repeats
from panelkit.llm.token_counts import count_tokens
from panelkit.llm.whitening import whiten_vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    decoded = decode_documents(encoded, path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "literal")
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interleaved_shards(table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), min_count=10, max_words=3, covered_percent=50, top=2000)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten_vectors(table(spark, sf_dir, "embeddings"), components=8)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_lattice_dedup": op3_lattice_dedup,
    "op4_packing": op4_packing,
    "op5_simhash": op5_simhash,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality": op8_quality,
    "op9_interleaved_shards": op9_interleaved_shards,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_collocations": op11_collocations,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op10_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same
                 AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ),
        worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
        grams AS (
            SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS a
            FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded), (VALUES (1), (2), (3)) AS sizes(k)
            WHERE i + k - 1 <= len(ws)
            GROUP BY ALL
        ),
        totals AS (SELECT lang, sum(a)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
        candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, a FROM grams WHERE k >= 2 AND a >= 10),
        inside AS (
            SELECT lang, phrase, max(a) AS longer
            FROM (
                SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
                UNION ALL
                SELECT lang, array_to_string(ws[2:3], ' '), a FROM candidates WHERE k = 3
            )
            GROUP BY ALL
        ),
        kept AS (
            SELECT c.* FROM candidates c LEFT JOIN inside i ON c.k = 2 AND i.lang = c.lang AND i.phrase = c.phrase
            WHERE i.longer IS NULL OR 100 * i.longer < 50 * c.a
        ),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, cut, f.a AS l, g.a AS r, 1000000::HUGEINT * c.a * c.a // (f.a::HUGEINT * g.a) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
            JOIN grams f ON f.lang = c.lang AND f.phrase = array_to_string(c.ws[1:c.cut], ' ')
            JOIN grams g ON g.lang = c.lang AND g.phrase = array_to_string(c.ws[c.cut + 1:], ' ')
        ),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest) JOIN totals USING (lang)
        WHERE rank <= 2000
    """,
}
