"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

Every text becomes a few statistics (lengths, repetition, character classes).
Random Fourier features approximate a Gaussian kernel over them; a ridge
regression on the labels is fitted from normal equations that each partition
sums over its rows; a monotone step fit (pool adjacent violators) on labelled
rows kept out of the regression turns its scores into probabilities.

Training uses at most TRAIN_ROWS labelled rows, the first by a hash of the
id; a third of them calibrate.  Rows whose crc32(doc_id) modulo 4 is 2 are
never learnt from.  Null labels are skipped; of several labels of one id the
largest counts.  Null text counts as empty, and empty text is scored like any
other.  Without labels every score is 0.5.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import held_out, narrow, slices
from panelkit.session import cut_lineage

TRAIN_ROWS = 20_000
TRAIN_TASKS = 8
FEATURES = 256
RIDGE = 1e-3
THRESHOLD = 0.7

_CLASSES = np.zeros((256, 7))
_CLASSES[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"], 0] = 1
_CLASSES[[ord(c) for c in "0123456789"], 1] = 1
_CLASSES[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]"], 2] = 1
_CLASSES[[ord(c) for c in ".,;:'\"()-"], 3] = 1
_CLASSES[[ord(c) for c in "!?"], 4] = 1
_CLASSES[[ord(c) for c in "\n\r"], 5] = 1
_CLASSES[128:, 6] = 1


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps_x: np.ndarray
    steps_y: np.ndarray


def statistics(text: str | None) -> list[float]:
    """Fixed-length statistics of one whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    shares = np.bincount(raw, minlength=256) @ _CLASSES / max(1, len(raw))
    words = text.split()
    n = len(words)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    lengths = np.fromiter(map(len, words), float, n) if n else np.zeros(1)
    return [
        np.log1p(n),
        np.log1p(len(lines)),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        len(seen) / max(1, n),
        (max(seen.values()) if seen else 0) / max(1, n),
        np.sqrt(sum(v * v for v in seen.values())) / max(1, n),
        pairs / max(1, n - 1),
        sum(1 for a, b in zip(words, words[1:]) if a == b) / max(1, n - 1),
        len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)) / (10 + n / max(1, len(lines))),
        sum(v for w, v in seen.items() if not w[-1].isalnum()) / max(1, n),
        sum(v for w, v in seen.items() if w.isupper()) / max(1, n),
        sum(v for w, v in seen.items() if not any(map(str.isalpha, w))) / max(1, n),
        sum(v for w, v in seen.items() if "://" in w or "www." in w or "@" in w) / max(1, n),
        *np.sqrt(shares),
    ]


def fourier(x: np.ndarray, m: QualityModel) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    z = np.cos((x - m.mean) / m.scale @ m.directions + m.phases) * np.sqrt(2 / m.directions.shape[1])
    return np.hstack([z, np.ones((len(x), 1))])


def pool_adjacent(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the least-squares non-decreasing fit of y over x; equal x are pooled first."""
    xs, at = np.unique(x, return_inverse=True)
    blocks: list[list[float]] = []  # sum of y, weight, sum of x*weight
    for s, w, v in zip(np.bincount(at, y), np.bincount(at), xs, strict=True):
        blocks.append([s, w, v * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, w2, v2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + w2, blocks[-1][2] + v2]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS, seed: int = 8) -> QualityModel:
    """Fit on at most ``rows`` labelled documents that are not held out."""
    marked = narrow(labels, id_col, label_col).toDF("doc_id", "label").where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
    # A threshold on the hash first, so that the sort for the exact bound sees few more rows than it keeps.
    spread = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality sample")), F.lit(spread))
    enough = min(spread, int(spread * (1.25 * rows + 1000) / max(1, marked.count())))
    drawn = marked.where(draw <= enough).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = drawn.orderBy(draw, "doc_id").limit(rows)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k["label"] for k in keys], pa.float64()), pa.array([k["calibrate"] for k in keys], pa.bool_()), pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))], ["label", "calibrate", "x"]
            )

    key = F.struct(F.col("label").cast("double").alias("label"), (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3)) == 0).alias("calibrate"))
    # At most ``rows`` ids are broadcast, so only the chosen texts leave the scan.
    texts = narrow(docs, id_col, text_col).toDF("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(key.alias("key"), "text")
    measured = cut_lineage(texts.mapInArrow(measure, "label double, calibrate boolean, x array<double>").repartition(TRAIN_TASKS))

    def sums(of):
        """Collect one packed array per partition: what ``of`` gives for its fitted rows."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                if b.num_rows:
                    part = of(np.array(b.column("x").to_pylist()), b.column("label").to_numpy())
                    total = part if total is None else total + part
            yield pa.RecordBatch.from_pydict({"total": pa.array([] if total is None else [total.tobytes()], pa.binary())})

        found = measured.where("not calibrate").mapInArrow(run, "total binary").collect()
        return sum(np.frombuffer(r["total"]) for r in found) if found else None

    size = len(statistics(""))
    first = sums(lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]))
    rng = np.random.default_rng(seed)
    if first is None:
        return QualityModel(np.zeros(size), np.ones(size), np.zeros((size, FEATURES)), np.zeros(FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    mean = first[1 : size + 1] / first[0]
    scale = np.sqrt(np.maximum(first[size + 1 :] / first[0] - mean**2, 1e-8))
    m = QualityModel(mean, scale, rng.normal(0, 1 / np.sqrt(size), (size, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier(x, m)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    total = sums(normal)
    k = FEATURES + 1
    gram = total[: k * k].reshape(k, k)
    m.weights = np.linalg.solve(gram + RIDGE * first[0] * np.eye(k), total[k * k :])

    def raw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(fourier(np.array(b.column("x").to_pylist()), m) @ m.weights), b.column("label")], ["score", "label"])

    held = measured.where("calibrate").mapInArrow(raw, "score double, label double").toArrow()
    if held.num_rows:
        m.steps_x, m.steps_y = pool_adjacent(held["score"].to_numpy(), held["label"].to_numpy())
    return m


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for ids, texts in slices(batches):
            value = np.interp(fourier(np.array([statistics(t) for t in texts]), m) @ m.weights, m.steps_x, m.steps_y)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.clip(value, 0, 1))], ["doc_id", "score"])

    scored = narrow(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
