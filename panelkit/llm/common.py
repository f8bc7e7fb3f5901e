"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import panelkit

from panelkit.session import cut_lineage

HELD_OUT_REMAINDER = 2
BATCH_ROWS = 1000


def narrow(docs: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, so that extra columns can never clash with an operator's own names."""
    ship_package(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`").alias(c) for c in cols])


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python import this package, once per Spark application (Spark serves the file).

    Rows hold whole texts here, so Arrow batches get BATCH_ROWS rows at most
    (the session's own setting, if it is smaller).
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    sc = spark.sparkContext
    if "panelkit.zip" in sc._python_includes:
        return
    root = os.path.dirname(os.path.abspath(panelkit.__file__))
    path = os.path.join(tempfile.mkdtemp(), "panelkit.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def held_out(id_col: str = "doc_id"):
    """True for the documents no model may learn from: crc32 of the id as text, modulo 4, is 2.

    A null id has no remainder and counts as not held out.
    """
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def row_slices(batch: pa.RecordBatch, column: int, chars: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose text in ``column`` holds about ``chars`` bytes each, or one longer text."""
    start, total = 0, 0
    for i, size in enumerate(np.diff(_offsets(batch.column(column))) if batch.num_rows else []):
        if i > start and total + size > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def slices(batches: Iterable[pa.RecordBatch], chars: int = 1 << 20) -> Iterator[tuple[list, list[str | None]]]:
    """(first column, second column as text) lists holding about ``chars`` bytes each, or one longer text."""
    for batch in batches:
        for part in row_slices(batch, 1, chars):
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def _offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], dtype=kind, count=len(col) + 1, offset=col.offset * np.dtype(kind).itemsize).astype(np.int64)


def key_bitmap(keys: DataFrame, rows: int, max_bits: int = 26) -> tuple[np.ndarray, int]:
    """(bitmap, bits): a bit for the leading ``bits`` digits of every 64-bit key in ``keys`` (column ``fp``).

    Built by a grouped ``bit_or``; it has at most 2**max_bits bits (26: 8 MB),
    so collecting and broadcasting it is bounded.  Past that size it lets more
    keys through.
    """
    bits = min(max_bits, max(12, (64 * rows).bit_length()))
    spot = F.shiftrightunsigned("fp", 64 - bits)
    mask = F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(fp, {64 - bits}) & 63 AS int)))")
    table = keys.groupBy(F.shiftright(spot, 6).alias("word")).agg(mask.alias("mask")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return bitmap, bits


def in_bitmap(bitmap: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """False only for keys (long) that the bitmap's keys lack."""
    at = keys.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_filter(keys: DataFrame, rows: int, max_bits: int = 26):
    """A boolean function of a 64-bit key column that is false only for keys that ``keys`` (column ``fp``) lacks."""
    bitmap, bits = key_bitmap(keys, rows, max_bits)
    shared = keys.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def listed(fp: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, bits, fp.to_numpy()))

    return listed


_state: list = [None, None]


def give_back() -> None:
    """Return freed memory to the system: a worker lives on, and may idle, while other stages run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def worker_state(key=None, make=None):
    """What ``make()`` gave for ``key``, kept in this Python worker until another key is asked for.

    A worker serves one operator after the other, so the caches of the one
    before go first; without a key they only go.
    """
    if _state[0] != key:
        _state[:] = [None, None]
        give_back()
        if make:
            _state[:] = [key, make()]
    return _state[1]


class WordCache:
    """A bounded map from a word to what was computed for it; the older half goes when it is full.

    Words of more than ``longest`` characters are held for one call only.
    """

    def __init__(self, entries: int, longest: int = 64):
        self.half, self.longest = entries // 2, longest
        self.young: dict = {}
        self.old: dict = {}
        self.passing: list = []

    def get(self, word):
        """What is held for ``word``, or None."""
        return self.young.get(word) or self.old.get(word)

    def table(self, groups: Iterable[Iterable], compute) -> dict:
        """The whole map, after adding what ``compute(list of missing words)`` gives for those it lacks of all groups."""
        for w in self.passing:
            self.young.pop(w, None)
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        missing = []
        young, old = self.young, self.old
        for w in set().union(*groups).difference(young):
            if (v := old.get(w)) is None:
                missing.append(w)
            else:
                young[w] = v
        if missing:
            young.update(zip(missing, compute(missing), strict=True))
        self.passing = [w for w in missing if len(w) > self.longest]
        return young


class IdCache:
    """The token ids of words: words in one Arrow array, ids in one arena with an offset index.

    Entry i is word i with the ids ``arena[offsets[i] : offsets[i + 1]]``;
    lookups are Arrow's.  Past ``limit`` bytes (words, offsets and ids) the
    entries that were not asked for lately go, about half of all.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.round = 0
        self._clear()

    def _clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.offsets = np.zeros(1, np.int64)
        self.used = np.zeros(0, np.int32)
        self.arena = np.zeros(0, np.uint32)

    @property
    def size(self) -> int:
        return self.words.nbytes + 12 * len(self.used) + 4 * len(self.arena)

    def trim(self) -> None:
        """Start a round; entries of earlier rounds may go here and only here."""
        self.round += 1
        if self.size <= self.limit:
            return
        kept = np.flatnonzero(self.used > np.partition(self.used, len(self.used) // 2)[len(self.used) // 2])
        words, used, (ids, sizes) = self.words.take(pa.array(kept)), self.used[kept], self.gather(kept)
        self._clear()
        self.add(words, ids, sizes)
        self.used = used

    def add(self, words: pa.Array | list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """New words with their ids, one after the other in ``ids``, ``sizes`` of each."""
        words = pa.array(words, pa.large_string()) if isinstance(words, list) else words
        self.words = pa.concat_arrays([self.words, words])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.used = np.concatenate([self.used, np.full(len(words), self.round, np.int32)])
        self.arena = np.concatenate([self.arena, ids.astype(np.uint32)])

    def numbers(self, words: pa.Array, first: int = 0) -> np.ndarray:
        """The entry, from ``first`` on, of each word; -1 for one that is not held.  Every call reads all those entries."""
        found = pc.index_in(words, value_set=self.words[first:]).to_numpy(zero_copy_only=False)
        found = np.where(np.isnan(found), -1, found + first).astype(np.int64) if found.dtype.kind == "f" else found + np.int64(first)
        self.used[found[found >= 0]] = self.round
        return found

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries one after the other, and how many each has."""
        begins = self.offsets[entries]
        sizes = self.offsets[entries + 1] - begins
        return self.arena[ranges(begins, sizes)], sizes


def ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... of ``sizes[0]`` numbers, then those of the next."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def lone_spaces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of spaces with a character that is not white space on either side, within one text.

    Where the neighbour is a character that begins with a byte under which
    Unicode has white space (U+0080-00BF, U+1000-3FFF), the space is not
    listed, to be on the safe side.
    """
    padded = np.concatenate([np.full(3, 0x20, np.uint8), data, np.full(1, 0x20, np.uint8)])
    space = padded == 0x20
    plain = ((padded > 0x20) & (padded < 0x7F)) | (padded >= 0x80)
    doubtful = (padded == 0xC2) | ((padded >= 0xE1) & (padded <= 0xE3))
    n = len(data)
    lone = space[3 : n + 3] & plain[2 : n + 2] & plain[4 : n + 4] & ~doubtful[4 : n + 4] & ~(doubtful[1 : n + 1] & (padded[2 : n + 2] >= 0x80)) & ~(doubtful[:n] & (padded[2 : n + 2] >= 0x80))
    inner = offsets[(offsets > 0) & (offsets < n)]
    lone[inner] = False
    lone[inner - 1] = False
    return np.flatnonzero(lone)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: none), and where each text's begin."""
    texts = texts.fill_null("").cast(pa.large_string()) if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(batches: Iterable[pa.RecordBatch], column: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose text in ``column`` holds up to ``chars`` bytes, or one longer text; batches are joined."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in row_slices(batch, column, chars):
            if held and size + part.column(column).nbytes > chars:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += part.column(column).nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def stems(words: pa.Array, ends: str) -> pa.Array:
    """The different words without their last character, of those that end with one of ``ends``."""
    ending = pc.match_substring_regex(words, f"[{re.escape(ends)}]$")
    return pc.unique(pc.utf8_slice_codeunits(words.filter(ending), 0, -1))


def encode_cached(texts: pa.Array, cache: IdCache, ends: str, encode_heads, add_missing) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and where each text's begin.

    Texts are cut at lone spaces.  ``encode_heads(list)`` gives (ids, sizes) of
    the parts without a space in front; ``add_missing(list, held)`` puts the
    ids of " " + part for parts that the cache lacks into it.  ``held`` has the
    entries of the parts' stems that the cache knows, where the part ends with
    one of ``ends``.
    """
    data, offsets = text_buffer(texts)
    spaces = lone_spaces(data, offsets)
    head_ends = np.append(spaces, len(data))[np.searchsorted(spaces, offsets[:-1])]
    head_ends = np.minimum(head_ends, offsets[1:])
    heads = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), head_ends.tolist())]
    head_ids, head_sizes = encode_heads(heads)
    # The parts behind the spaces, as one Arrow array over the bytes they cover.
    part_ends = np.minimum(np.append(spaces[1:], len(data)), offsets[np.searchsorted(offsets, spaces, "right")])
    inside = np.ones(len(data), bool)
    inside[spaces] = False
    for a, b in zip(offsets[:-1].tolist(), head_ends.tolist()):
        inside[a:b] = False
    edges = np.append(0, np.cumsum(part_ends - spaces - 1))
    parts = pa.LargeStringArray.from_buffers(len(spaces), pa.py_buffer(edges), pa.py_buffer(data[inside])).dictionary_encode()
    del inside, edges, part_ends
    cache.trim()
    known = len(cache.words)
    roots = stems(parts.dictionary, ends)
    entries = cache.numbers(pa.concat_arrays([parts.dictionary, roots]))
    entries, of_roots = entries[: len(parts.dictionary)], entries[len(parts.dictionary) :]
    if len(missing := np.flatnonzero(entries < 0)):
        lacking = parts.dictionary.take(pa.array(missing))
        held = np.flatnonzero(of_roots >= 0)
        add_missing(lacking.to_pylist(), dict(zip(roots.take(pa.array(held)).to_pylist(), of_roots[held].tolist())))
        entries[missing] = cache.numbers(lacking, known)
    ids, counts = cache.gather(entries[parts.indices.to_numpy()])
    # Each text: its head, then its parts.
    per_text = np.append(0, np.cumsum(counts))[np.searchsorted(spaces, offsets)]
    begins = np.append(0, np.cumsum(head_sizes + np.diff(per_text)))
    out = np.empty(int(begins[-1]), np.uint32)
    out[ranges(begins[:-1], head_sizes)] = head_ids
    out[ranges(begins[:-1] + head_sizes, np.diff(per_text))] = ids
    return out, begins


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b): component is the smallest node reachable.

    Each partition first replaces its edges by a star on its local smallest
    nodes, then large-star and small-star rounds run until the set of edges
    stays the same.  Only (long, long) rows move; every round is cut by a
    reliable checkpoint in the shared folder.
    """
    star = cut_lineage(edges.select("a", "b").mapInArrow(_local_stars, "a long, b long").distinct())
    seen = None
    while True:
        mark = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        star = cut_lineage(_small_star(_large_star(star)))
    return star.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours over to the smallest node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, over to the smallest of them."""
    down = edges.select("a", "b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    handed = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.union(least.select("a", F.col("m").alias("b"))).distinct()


def _local_stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}
    for batch in batches:
        union_all(parent, batch.column(0).to_pylist(), batch.column(1).to_pylist())
    nodes = [n for n in parent if find(parent, n) != n]
    yield pa.RecordBatch.from_pydict({"a": pa.array(nodes, pa.int64()), "b": pa.array([parent[n] for n in nodes], pa.int64())})


def find(parent: dict[int, int], n: int) -> int:
    root = n
    while (p := parent.setdefault(root, root)) != root:
        root = p
    while n != root:
        parent[n], n = root, parent[n]
    return root


def union_all(parent: dict[int, int], a: Iterable[int], b: Iterable[int]) -> None:
    """Join the classes of each pair; the smaller root stays the root."""
    for x, y in zip(a, b, strict=True):
        x, y = find(parent, x), find(parent, y)
        if x != y:
            parent[max(x, y)] = min(x, y)
