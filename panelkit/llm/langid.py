"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, everything but letters becomes a space, and every 1-, 2-
and 3-gram of code points is hashed to one of DIM buckets.  Counts per
language come from a bounded sample of labelled rows (TRAIN_ROWS_PER_LANG
expected for each language; rarer languages give all their rows); languages
weigh the same beforehand.  The log-probability matrix (languages x DIM
floats, so bounded by the label set) is broadcast, and batches are scored as
sparse (document, bucket, count) triples in numpy.

Null text, empty text and text without a letter give ``und`` with score 0.
With no labelled row at all, everything is ``und``.  Ties go to the language
that sorts first.  Whole texts are read, long ones in blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import held_out, narrow, row_slices, ship_package, slices, worker_state

DIM_BITS = 15
DIM = 1 << DIM_BITS
TRAIN_ROWS_PER_LANG = 5_000
TRAIN_TASKS = 16
UNKNOWN = "und"
SMOOTHING = 0.5
BLOCK = 1 << 20


@dataclass
class LanguageModel:
    langs: list[str]
    log_prob: np.ndarray  # one row per bucket, one column per language


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def hashed_ngrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all 1-, 2- and 3-grams, block by block; nothing for a text without letters."""
    lowered = text.lower()
    for at in range(0, len(lowered), BLOCK):
        codes = np.frombuffer(lowered[max(0, at - 2) : at + BLOCK].encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        c = np.where(letter, codes, np.uint32(32))
        c = np.concatenate([np.array([32], np.uint32), c, np.array([32], np.uint32)])
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
        three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        new = 2 if at else 0  # the code points before the block were counted there
        yield np.concatenate([one[1 + new : -1], two[new:], three[new:]]) >> np.uint32(32 - DIM_BITS)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_lang: int = TRAIN_ROWS_PER_LANG) -> LanguageModel:
    """Learn from rows with text and language that are not held out."""
    labelled = narrow(docs, id_col, text_col, lang_col).toDF("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["n"] for r in labelled.where(F.col("text").isNotNull()).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], np.zeros((DIM, 0), np.float32))
    spread = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(spread))
    limit = F.create_map(*[F.lit(x) for k in langs for x in (k, min(spread, spread * rows_per_lang // sizes[k] + 1))])
    sample = labelled.where(F.col("text").isNotNull() & (draw < limit[F.col("lang")])).select("lang", "text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        counts: dict[str, np.ndarray] = {}
        for names, texts in slices(batches):
            for lang, text in zip(names, texts, strict=True):
                own = counts.setdefault(lang, np.zeros(DIM))
                for grams in hashed_ngrams(text):
                    own += np.bincount(grams, minlength=DIM)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(counts), pa.string()), "counts": pa.array([v.tobytes() for v in counts.values()], pa.binary())})

    total = np.full((len(langs), DIM), SMOOTHING)
    for r in sample.repartition(TRAIN_TASKS).mapInArrow(count, "lang string, counts binary").collect():
        total[langs.index(r["lang"])] += np.frombuffer(r["counts"])
    return LanguageModel(langs, np.log(total / total.sum(axis=1, keepdims=True)).T.astype(np.float32))


def score_texts(texts: list[str | None], model: LanguageModel) -> tuple[list[str], list[float]]:
    """Language and its posterior probability, from sparse (document, bucket, count) triples."""
    rows, cols, vals = [], [], []
    for i, text in enumerate(texts):
        for grams in hashed_ngrams(text or ""):
            if len(grams) > DIM // 8:
                counts = np.bincount(grams, minlength=DIM)
                grams = np.flatnonzero(counts)
                vals.append(counts[grams].astype(np.float32))
            else:
                vals.append(np.ones(len(grams), np.float32))
            cols.append(grams.astype(np.int64))
            rows.append(i)
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not rows or not model.langs:
        return langs, scores
    products = model.log_prob[np.concatenate(cols)].astype(np.float64) * np.concatenate(vals)[:, None]
    starts = np.cumsum([0, *map(len, cols[:-1])])
    sums = np.zeros((len(texts), len(model.langs)))
    np.add.at(sums, rows, np.add.reduceat(products, starts))
    for i in dict.fromkeys(rows):
        best = int(np.argmax(sums[i]))
        langs[i], scores[i] = model.langs[best], float(1 / np.exp(sums[i] - sums[i, best]).sum())
    return langs, scores


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        for ids, texts in slices(batches):
            langs, scores = score_texts(texts, shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    found = narrow(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language found with at least ``min_score``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        for batch in batches:
            for part in row_slices(batch, at):  # whole rows, a bounded number of bytes at a time
                langs, scores = score_texts(part.column(at).to_pylist(), shared.value)
                yield part.filter(pa.array([lang != UNKNOWN and s >= min_score for lang, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
