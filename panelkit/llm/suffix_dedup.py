"""Removal of repeated passages by suffix arrays.

Texts are UTF-8 bytes.  A byte goes if it lies in a window of ``length`` bytes
that also starts earlier in the corpus: in a document of smaller doc_id, or
earlier in the same one.  Windows never cross documents and are judged on the
input, not on what is left.

Equal windows must meet in one task, and few others with them:

1. Each window is named by its anchor, the smallest hash of its stretches of
   ANCHOR bytes.  Equal windows have equal anchors, and neighbouring windows
   mostly share theirs, so a document becomes runs: passages of some windows
   with one anchor.  Only those matter whose anchor opens several runs or
   occurs twice in its run (``looped``); a bitmap of bounded size lets them
   through, and what it lets through in error changes nothing.
2. Runs with equal passages (128-bit BLAKE2) are grouped: the earliest stays in
   question, every later one is covered whole.  Only hashes and places move,
   and thousands of copies are one row a task after map-side aggregation.
3. The different passages of an anchor, each from its earliest place, are
   sorted into one suffix array in a task: suffixes smaller than their
   successor are sorted directly, all others are induced by scans over the
   buckets of first bytes (``suffix_array``).  Adjacent common prefixes of
   ``length`` bytes give the classes of equal windows; all but the earliest of a
   class are covered.
4. An anchor with over HOT different passages (a phrase common to many
   contexts) would not fit a task; its passages are cut into their single
   windows, which are grouped as in step 2 and leave nothing to compare.
5. Earliest places and covered spans go to their documents, where the runs are
   found again: those that are not the earliest go, and the spans of 3 and 4.

Documents of one doc_id are ordered by a hash of their texts; rows equal in id
and text are one document, listed twice: both get its result.  A null id comes
before all others, a null text counts as empty.  Texts shorter than ``length``
lose nothing.  No input gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import in_bitmap, key_bitmap, narrow, ranges, row_slices
from panelkit.session import cut_lineage, scratch_path

LENGTH = 100
ANCHOR = 24
RUN_WINDOWS = 256
HOT = 4096
SEGMENT = 1 << 15
SLICE = 1 << 20
BLOCK = 1 << 20
BITMAP_BITS = 28
SEEN = 100_000

_BASE = 0x9E3779B97F4A7C15
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Anchors:
    """The anchor of every window of ``length`` bytes."""

    def __init__(self, length: int, size: int):
        self.length, self.size, self.width = length, size, min(ANCHOR, max(1, length // 2))
        self.up = _powers(_BASE, size + length)
        self.down = _powers(pow(_BASE, -1, 1 << 64), size + length)

    def lowest(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all stretches, and the lowest of each window starting at 0 .. len(data) - length."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SEEDS[data] * self.up[: len(data)], out=sums[1:])
        count = len(data) - self.width + 1
        hashed = _mixed((sums[self.width :] - sums[:count]) * self.down[:count])
        # Sliding minimum: of each block of ``span`` hashes the minima up to, and from, every place.
        span = self.length - self.width + 1
        blocks = np.full(-(-count // span) * span, np.iinfo(np.uint64).max)
        blocks[:count] = hashed
        blocks = blocks.reshape(-1, span)
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(data) - self.length + 1
        return hashed, np.minimum(behind[:windows], before[span - 1 : span - 1 + windows])

    def looped(self, hashed: np.ndarray, lowest: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Runs that hold their anchor more than once: without that, no two of their windows are equal."""
        span, size = self.length - self.width + 1, len(hashed)
        edges = np.arange(0, size, span)
        highest = np.maximum.reduceat(np.append(lowest, np.zeros(size - len(lowest), np.uint64)), edges)
        bound = np.maximum(highest, np.append(np.uint64(0), highest[:-1]))
        places = np.flatnonzero(hashed <= np.repeat(bound, np.diff(np.append(edges, size))))
        values, rank = np.unique(hashed[places], return_inverse=True)
        listed = np.sort(rank * size + places)
        own = np.searchsorted(values, lowest[first]) * size + first
        return (count > 1) & (np.searchsorted(listed, own + count + span - 2, "right") - np.searchsorted(listed, own) > 1)

    def runs(self, data: np.ndarray, offsets: np.ndarray, loops: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
        """(first window, number of windows, anchor, and looped if asked for) of the runs in the documents ``data[offsets[i]:offsets[i + 1]]``.

        Every ``size`` windows of a document a run ends, wherever the document
        lies in ``data``: each pass finds the same runs, in whatever slices it
        gets the documents.
        """
        pieces = -(-np.diff(offsets) // self.size)
        cuts = np.append(np.repeat(offsets[:-1], pieces) + ranges(np.zeros(len(pieces), np.int64), pieces) * self.size, len(data))
        end = 0
        while end < len(data):
            begin, low = end, np.searchsorted(cuts, end, "right")
            end = int(cuts[np.searchsorted(cuts, begin + self.size, "right") - 1])
            inner = cuts[low : np.searchsorted(cuts, end)] - begin
            part = data[begin : end + self.length - 1]
            if len(part) < self.length:
                continue
            hashed, keys = self.lowest(part)
            # Windows may start where the document goes on for another ``length`` bytes.
            low, high = np.searchsorted(offsets, [begin, begin + len(keys)], "right")
            edges = np.concatenate([[begin], offsets[low:high], [begin + len(keys)]])
            ends = np.repeat(offsets[np.minimum(np.arange(low, low + len(edges) - 1), len(offsets) - 1)], np.diff(edges))
            whole = np.arange(begin, begin + len(keys)) + self.length <= ends
            opens = whole.copy()
            opens[1:] &= (keys[1:] != keys[:-1]) | ~whole[:-1]
            inner = inner[inner < len(keys)]
            opens[inner] = whole[inner]
            closes = whole.copy()
            closes[:-1] &= opens[1:] | ~whole[1:]
            first = np.flatnonzero(opens)
            count = np.flatnonzero(closes) - first + 1
            pieces = -(-count // RUN_WINDOWS)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, count = np.repeat(first, pieces) + nth * RUN_WINDOWS, np.minimum(np.repeat(count, pieces) - nth * RUN_WINDOWS, RUN_WINDOWS)
            yield begin + first, count, _mixed(keys[first]).view(np.int64), *([self.looped(hashed, keys, first, count)] if loops else [])


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and where each row's begin."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _sort_directly(words: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` by the ``depth`` bytes from there on; equal ones in any order."""
    first = words[positions].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    out, first = positions[order], first[order]
    same = first[1:] == first[:-1]
    for at in range(8, depth, 8):
        pairs = np.flatnonzero(same)
        if not len(pairs):
            break
        tied = np.union1d(pairs, pairs + 1)
        group = np.cumsum(~np.append(False, same))[tied]
        word = words[out[tied] + at].astype(np.uint64)
        order = np.lexsort((word, group))
        out[tied], word = out[tied][order], word[order]
        left = np.searchsorted(tied, pairs)
        same[pairs] = word[left] == word[left + 1]
    return out


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int, wanted: np.ndarray) -> np.ndarray:
    """The suffixes of ``text`` in the order of their first ``depth`` bytes, by two-stage sorting.

    Only ``wanted`` ones (a mask) are placed, and those behind them from which
    they are induced: up to the next suffix smaller than its successor.
    ``words[i]`` holds the bytes i .. i + 7 of the text as a big-endian number.
    The buckets of first bytes hold the suffixes greater than their successor
    before those smaller than it.  Scanned from the left, each entry puts the
    suffix one byte longer, if that one is greater, at the head of its bucket.
    """
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.append(text[change + 1] > text[change], False)
    smaller = np.repeat(rises, np.diff(np.concatenate([[-1], change, [n - 1]])))
    # Behind each greater suffix comes the chain that induces it; the last of a chain is sorted directly, or ends the text.
    stop = np.flatnonzero(smaller | (np.arange(n) == n - 1))
    last = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
    placed = wanted.copy()
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, last, 1)
    np.add.at(change, stop[np.searchsorted(stop, last)] + 1, -1)
    placed |= np.cumsum(change[:-1]) > 0
    follows = placed & ~smaller
    total, greater = np.bincount(text[placed], minlength=256), np.bincount(text[follows], minlength=256)
    head = np.cumsum(total) - total
    middle, end = head + greater, head + total
    out = np.empty(total.sum(), np.int64)
    direct = _sort_directly(words, np.flatnonzero(placed & smaller), depth)
    number = total - greater
    out[np.repeat(middle - (np.cumsum(number) - number), number) + np.arange(len(direct))] = direct

    def induce(scanned: np.ndarray) -> None:
        longer = scanned[scanned > 0] - 1
        longer = longer[follows[longer]]
        if not len(longer):
            return
        order = np.argsort(text[longer], kind="stable")
        count = np.bincount(text[longer], minlength=256)
        out[np.repeat(head - (np.cumsum(count) - count), count) + np.arange(len(longer))] = longer[order]
        head[:] += count

    induce(np.array([n]))
    for byte in np.flatnonzero(total).tolist():
        done = end[byte] - total[byte]
        while done < head[byte]:
            upto = head[byte]
            induce(out[done:upto])
            done = upto
        induce(out[middle[byte] : end[byte]])
    return out


def common_prefixes(words: np.ndarray, left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Equal bytes from ``left[i]`` and ``right[i]`` on, ``limit`` at most."""
    out = np.zeros(len(left), np.int64)
    alive = np.arange(len(left))
    for at in range(0, limit, 8):
        differ = words[left[alive] + at].astype(np.uint64) ^ words[right[alive] + at].astype(np.uint64)
        out[alive] += np.sum([differ >> np.uint64(8 * k) == 0 for k in range(8)], axis=0)
        alive = alive[differ == 0]
    return np.minimum(out, limit)


def covered_windows(passages: list[bytes], length: int) -> np.ndarray:
    """Starts, in the joined passages, of the windows that also start earlier there."""
    joined = b"".join(passages)
    text = np.frombuffer(joined + bytes(length), np.uint8)
    words = np.ndarray(len(text), ">u8", joined + bytes(length + 8), strides=(1,))
    ends = np.cumsum([len(p) for p in passages])
    room = np.repeat(ends, [len(p) for p in passages]) - np.arange(len(joined))
    wanted = np.append(room >= length, np.zeros(length, bool))
    ordered = suffix_array(text, words, length, wanted)
    ordered = ordered[wanted[ordered]]
    if not len(ordered):
        return ordered
    equal = common_prefixes(words, ordered[:-1], ordered[1:], length) == length
    begins = np.flatnonzero(~np.append(False, equal))
    earliest = np.repeat(np.minimum.reduceat(ordered, begins), np.diff(np.append(begins, len(ordered))))
    return np.sort(ordered[ordered != earliest])


_COVERED = "d0 long, d1 long, doc_id long, th long, a long, b long"
_RUN = "key long, d0 long, d1 long, looped boolean, doc_id long, th long, start long"
_PASSAGE = "key long, doc_id long, th long, start long, passage binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _digests(passages: Iterable[bytes]) -> list[pa.Array]:
    """The two halves of each passage's 128-bit hash."""
    joined = b"".join(hashlib.blake2b(p, digest_size=16).digest() for p in passages)
    halves = np.frombuffer(joined, np.int64).reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)]


def _runs_of(part: pa.RecordBatch, finder: Anchors, bitmap: tuple, loops: bool = False) -> Iterator[tuple]:
    """(slice, first byte in it, bytes, row, start, anchor, and looped if asked for) of the runs of a (doc_id, th, text) slice that the bitmap lets through."""
    data, offsets = _buffer(part.column(2))
    for run in finder.runs(data, offsets, loops):
        first, count, *rest = (c[in_bitmap(*bitmap, run[2])] for c in run)
        row = np.searchsorted(offsets, first, "right") - 1
        yield data, first, count + finder.length - 1, row, first - offsets[row], *rest


def _cut(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[bytes]:
    return [data[a : a + n].tobytes() for a, n in zip(first.tolist(), size.tolist())]


def _spans_of_block(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Covered spans of (doc_id, th, start, passage) rows in the order of the corpus."""
    bases = np.cumsum([0] + [len(r[3]) for r in rows])
    hits = covered_windows([r[3] for r in rows], length)
    own = np.searchsorted(bases, hits, "right") - 1
    opens = np.flatnonzero((np.diff(hits, prepend=-2) != 1) | (np.diff(own, prepend=-1) != 0)) if len(hits) else hits
    last = np.append(opens[1:], len(hits)) - 1 if len(hits) else hits
    picked = [rows[k] for k in own[opens].tolist()]
    shift = np.array([r[2] for r in picked], np.int64) - bases[own[opens]]
    none = pa.nulls(len(picked), pa.int64())
    return pa.RecordBatch.from_arrays([none, none, *[pa.array([r[k] for r in picked], pa.int64()) for k in (0, 1)], pa.array(hits[opens] + shift), pa.array(hits[last] + length + shift)], _names(_COVERED))


def _windows_of(rows: list[tuple], length: int) -> pa.RecordBatch:
    """The hash and place of every window of (doc_id, th, start, passage) rows."""
    cuts = [(i, h, s + o, t[o : o + length]) for i, h, s, t in rows for o in range(len(t) - length + 1)]
    *places, windows = zip(*cuts)
    return pa.RecordBatch.from_arrays([*_digests(windows), *[pa.array(c, pa.int64()) for c in places], pa.nulls(len(cuts), pa.int64())], _names(_COVERED))


def _compared(rows: DataFrame, length: int, crowded) -> DataFrame:
    """Stored table of what the places' passages cover.

    ``rows`` are places (null passage) and passages; only a passage at a listed
    place counts, once.  The passages of an anchor give covered spans (a, b);
    whole anchors are sorted together, BLOCK bytes or one anchor at a time.
    Those of a crowded anchor give the hashes (d0, d1) of their windows at a.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, rows, singles = None, [], []
        size, key = 0, None
        for batch in batches:
            many = in_bitmap(*crowded.value, batch.column(0).to_numpy()).tolist()
            for crowd, k, doc_id, th, start, passage in zip(many, *[c.to_pylist() for c in batch.columns]):
                if passage is None:
                    listed = (k, doc_id, th, start)
                    continue
                if listed != (k, doc_id, th, start):
                    continue
                listed = None
                if crowd:
                    singles.append((doc_id, th, start, passage))
                    if len(singles) == 1000:
                        yield _windows_of(singles, length)
                        singles = []
                    continue
                if size >= BLOCK and k != key:
                    yield _spans_of_block(rows, length)
                    rows, size = [], 0
                key = k
                rows.append((doc_id, th, start, passage))
                size += len(passage)
        if singles:
            yield _windows_of(singles, length)
        if rows:
            yield _spans_of_block(rows, length)

    # Places sort before their passages.
    ordered = rows.repartition("key", "salt").sortWithinPartitions("key", "doc_id", "th", "start", F.col("passage").isNotNull())
    path = scratch_path(rows.sparkSession, "covered")
    ordered.select(*_names(_PASSAGE)).mapInArrow(run, _COVERED).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _later_windows(windows: DataFrame, length: int) -> DataFrame:
    """Spans of the windows (d0, d1 at a) that are not the earliest of their hash."""
    earliest = windows.groupBy("d0", "d1").agg(F.min(F.struct("doc_id", "th", "a")).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    # The side of the groups has one row a key: AQE splits a hot window on the other side.
    later = windows.drop("b").join(earliest, ["d0", "d1"]).where(~F.struct("doc_id", "th", "a").eqNullSafe(F.col("first")))
    return later.select("doc_id", "th", "a", (F.col("a") + length).alias("b"))


def _earliest_runs(texts: DataFrame, length: int, shared) -> DataFrame:
    """Stored table of the earliest run of each different passage: key, looped, doc_id, th, start."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, SEGMENT)
        for batch in batches:
            for part in row_slices(batch, 2, SLICE):
                for data, first, size, row, start, own, looped in _runs_of(part, finder, shared.value, loops=True):
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), *_digests(_cut(data, first, size)), pa.array(looped), part.column(0).take(row), part.column(1).take(row), pa.array(start)], _names(_RUN)
                    )

    groups = texts.mapInArrow(run, _RUN).groupBy("key", "d0", "d1").agg(F.min(F.struct("doc_id", "th", "start")).alias("first"), F.max("looped").alias("looped"))
    path = scratch_path(texts.sparkSession, "earliest-runs")
    groups.select("key", "looped", "first.*").write.parquet(path)
    return texts.sparkSession.read.parquet(path)


def _passages_at(texts: DataFrame, places: DataFrame, length: int, shared) -> DataFrame:
    """The passages of the runs that start at ``places`` (th, start); a bitmap spares most others the way."""
    listed = _bitmap(_place_keys(places))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, SEGMENT)
        seen: set = set()
        for batch in batches:
            # A document that is listed many times sends its passages about once a task.
            new = []
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(pair not in seen)
                seen.add(pair)
            if len(seen) > SEEN:
                seen.clear()
            for part in row_slices(batch.filter(pa.array(new)), 2, SLICE):
                hashes = part.column(1).to_numpy()
                for data, first, size, row, start, own in _runs_of(part, finder, shared.value):
                    found = in_bitmap(*listed.value, _place(hashes[row], start))
                    row = pa.array(row[found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[found]), part.column(0).take(row), part.column(1).take(row), pa.array(start[found]), pa.array(_cut(data, first[found], size[found]), pa.binary())], _names(_PASSAGE)
                    )

    return texts.mapInArrow(run, _PASSAGE)


def _place(th: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a place in a document."""
    return _mixed(th.view(np.uint64) + start.astype(np.uint64) * np.uint64(_BASE)).view(np.int64)


def _bitmap(keys: DataFrame):
    """A broadcast bitmap of the 64-bit keys (column ``fp``) of a stored table."""
    return keys.sparkSession.sparkContext.broadcast(key_bitmap(keys, keys.count(), BITMAP_BITS))


def _place_keys(places: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place(batch.column(0).to_numpy(), batch.column(1).to_numpy()))], ["fp"])

    return places.select("th", "start").mapInArrow(run, "fp long")


def _repeated_anchors(texts: DataFrame, length: int) -> DataFrame:
    """Checkpointed table (column ``fp``) of the anchors of several runs, and of looped ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, SEGMENT)
        for batch in batches:
            for part in row_slices(batch, 0, SLICE):
                for _, _, own, looped in finder.runs(*_buffer(part.column(0))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.append(own, own[looped]))], ["fp"])

    return cut_lineage(texts.select("text").mapInArrow(run, "fp long").groupBy("fp").count().where("count > 1").select("fp"))


def _marks(texts: DataFrame, length: int, hot: int, shared) -> DataFrame:
    """For each document (doc_id, th) the list ``marks`` of (a, b): covered spans, and with null b the starts of the runs that are the earliest."""
    groups = _earliest_runs(texts, length, shared)
    kinds = cut_lineage(groups.groupBy(F.col("key").alias("fp")).agg(F.count("*").alias("kinds"), F.max("looped").alias("looped")).where("kinds > 1 OR looped"))
    several, crowded = _bitmap(kinds), _bitmap(kinds.where(F.col("kinds") > hot))

    def sorted_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(*several.value, batch.column(0).to_numpy())))

    def salted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spread = _place(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            salt = np.where(in_bitmap(*crowded.value, batch.column(0).to_numpy()), spread, 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(salt)], [*_names(_PASSAGE), "salt"])

    schema = "key long, doc_id long, th long, start long"
    places = cut_lineage(groups.select(*_names(schema)).mapInArrow(sorted_out, schema))
    rows = places.withColumn("passage", F.lit(None).cast("binary")).union(_passages_at(texts, places, length, shared))
    covered = _compared(rows.mapInArrow(salted, f"{_PASSAGE}, salt long"), length, crowded)
    spans = covered.where("b IS NOT NULL").select("doc_id", "th", "a", "b").union(_later_windows(covered.where("b IS NULL"), length))
    marks = groups.select("doc_id", "th", F.col("start").alias("a"), F.lit(None).cast("long").alias("b")).union(spans.distinct())
    return marks.groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "b")).alias("marks"))


_RESULT = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<array<long>>"


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (the bytes that stay), n_bytes, n_removed, spans (maximal removed runs, as [begin, end]) for every row."""
    texts = narrow(docs, id_col, text_col).toDF("doc_id", "text")
    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    shared = _bitmap(_repeated_anchors(texts, length))
    marks = _marks(texts, length, hot, shared).select(F.col("doc_id").alias("own_id"), F.col("th").alias("own_th"), "marks")
    joined = texts.join(marks, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("th") == F.col("own_th")), "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, SEGMENT)
        for batch in batches:
            for part in row_slices(batch, 2, SLICE):
                yield _cut_out(part, finder, shared.value)

    return joined.select("doc_id", "th", "text", "marks").mapInArrow(run, _RESULT)


def _cut_out(part: pa.RecordBatch, finder: Anchors, bitmap: tuple) -> pa.RecordBatch:
    """Results of a (doc_id, th, text, marks) slice."""
    data, offsets = _buffer(part.column(2))
    marks = part.column(3)
    base = np.repeat(offsets[:-1], marks.value_lengths().fill_null(0).to_numpy())
    a, b = (marks.flatten().field(k) for k in (0, 1))
    earliest = b.is_null().to_numpy(zero_copy_only=False)
    a = a.to_numpy() + base
    change = np.zeros(len(data) + 1, np.int32)
    for _, first, size, *_ in _runs_of(part, finder, bitmap):
        later = ~np.isin(first, a[earliest])
        np.add.at(change, first[later], 1)
        np.add.at(change, (first + size)[later], -1)
    np.add.at(change, a[~earliest], 1)
    np.add.at(change, b.drop_null().to_numpy() + base[~earliest], -1)
    gone = np.cumsum(change[:-1]) > 0
    removed = np.concatenate([[0], np.cumsum(gone)])[offsets]
    kept_at = offsets - removed
    kept = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(kept_at.astype(np.int64).tobytes()), pa.py_buffer(data[~gone].tobytes())])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone[:-1])))
    closes = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False))) + 1
    row = np.searchsorted(offsets, opens, "right") - 1
    pairs = np.stack([opens - offsets[row], closes - offsets[row]], 1).ravel()
    inner = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(opens) + 1, 2, dtype=np.int32)), pa.array(pairs))
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(opens, offsets).astype(np.int32)), inner)
    return pa.RecordBatch.from_arrays([part.column(0), kept.cast(pa.binary()), pa.array(np.diff(offsets)), pa.array(np.diff(removed)), spans], _names(_RESULT))
