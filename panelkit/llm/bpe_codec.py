"""Byte-level BPE encoding and decoding by DuckDB queries inside each task.

Encoding: a task cuts its texts by the pre-token pattern and hands the
distinct pre-tokens it has not met lately to an in-process DuckDB.  There a
recursive query holds the tokens of a pre-token and the ranks of its neighbours;
each step contracts, in every pre-token, the leftmost pair of minimum rank and
joins the two pairs that this brings with the merge table, until no pair merges
(the fixpoint).

The tokens of all steps grow with the square of a pre-token's length, so one of
more than WINDOW bytes is cut into windows that overlap by half, and each goes
through the same query.  A sequence of tokens is the encoding of its bytes if
every two neighbours are the encoding of theirs.  So where two windows share a
token (same begin, same end), the left one's tokens up to it and the right
one's from it on are the encoding of both together.  If two windows share none,
the pre-token is cut again into windows twice as long.

Decoding: token rows join the vocabulary and an aggregation ordered by
position puts each document's bytes together again.

Each task's DuckDB has one thread, MEMORY and no spill folder; what it gets at
once is bounded by BATCH_ROWS and BATCH_TOKENS.  What a worker remembers is
bounded by CACHE_BYTES.  Null text counts as empty and has no token.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import IdCache, encode_cached, give_back, narrow, ranges, row_slices, text_blocks, worker_state

MEMORY = "200MB"
WINDOW = 96
BATCH_ROWS = 1 << 20
BATCH_TOKENS = 1 << 17
CACHE_BYTES = 48 << 20
SLICE = 1 << 22
ROWS_OUT = 128

# No pair: larger than any rank.
NONE = (1 << 31) - 1

# ``ranks`` has the rank of each token with its right neighbour.  A contraction of the pair at ``seat`` brings two new
# pairs, looked up in the merge table; all others stay.
_ENCODE = f"""
WITH RECURSIVE state AS (
    SELECT w, ids, ranks, coalesce(list_min(ranks), {NONE}) AS best FROM spelled
    UNION ALL
    (
        WITH lowest AS (
            SELECT w, ids, ranks, best, list_position(ranks, best) AS seat FROM state WHERE best < {NONE}
        ),
        contracted AS (
            SELECT w,
                   list_concat(CASE WHEN seat > 1 THEN ids[:seat - 1] END, [best], ids[seat + 2:]) AS ids,
                   list_concat(
                       CASE WHEN seat > 2 THEN ranks[:seat - 2] END,
                       CASE WHEN seat > 1 THEN [coalesce(a.rank, {NONE})] END,
                       CASE WHEN seat < len(ranks) THEN [coalesce(b.rank, {NONE})] END,
                       ranks[seat + 2:]
                   ) AS ranks
            FROM lowest
            LEFT JOIN merges a ON a.pair = ids[seat - 1]::BIGINT << 32 | best
            LEFT JOIN merges b ON b.pair = best::BIGINT << 32 | ids[seat + 2]
        )
        SELECT w, ids, ranks, coalesce(list_min(ranks), {NONE}) FROM contracted
    )
)
SELECT w, ids FROM state WHERE best = {NONE} ORDER BY w
"""

_DECODE = """
SELECT d, string_agg(v.hex, '' ORDER BY t.pos) AS bytes
FROM tokens t JOIN vocab v ON v.id = t.id
GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pieces_of(word: bytes, window: int) -> list[tuple[int, bytes]]:
    """(begin, bytes) of the windows of a word: all of it, or windows that overlap by half."""
    if len(word) <= window:
        return [(0, word)]
    return [(at, word[at : at + window]) for at in range(0, len(word) - window // 2, window // 2)]


def stitched(windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray | None:
    """The ids of a word from the (ids, begins, ends) of its windows in order; None if two neighbours share no token."""
    out, begin = [], 0
    for i, (ids, begins, ends) in enumerate(windows):
        if i + 1 == len(windows):
            out.append(ids[np.searchsorted(begins, begin) :])
            break
        _, next_begins, next_ends = windows[i + 1]
        _, own, other = np.intersect1d(begins, next_begins, assume_unique=True, return_indices=True)
        shared = begins[own][ends[own] == next_ends[other]]
        if not len(shared):
            return None
        # Up to the shared token from this window, from it on from the next.
        out.append(ids[np.searchsorted(begins, begin) : np.searchsorted(begins, shared[0])])
        begin = shared[0]
    return np.concatenate(out)


class DuckCodec:
    """One DuckDB with the merge table and vocabulary of a rank file, and a cache bounded in bytes.

    The cache holds parts, which stand behind a space, and pre-tokens.  A
    pre-token that begins with a space has the key of the part behind it, any
    other the key " x" + pre-token, with which no part begins.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.pattern = regex.compile(pattern)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.spell = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        rows = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None:
                    rows.append((left, right, rank))
        left, right, rank = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
        self._table("merges", pair=left << 32 | right, rank=rank.astype(np.int32))
        self.of_bytes = np.array([ranks.get(bytes([a, b]), NONE) for a in range(256) for b in range(256)], np.int32)
        self._table("vocab", id=np.array(list(ranks.values()), np.int32), hex=[t.hex() for t in ranks])
        self.size_of = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size_of[list(ranks.values())] = [len(t) for t in ranks]
        self.cache = IdCache(CACHE_BYTES)

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces one after the other, and how many each has, by the recursive query."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        offsets = np.cumsum([0, *map(len, pieces)])
        inner = np.ones(len(data), bool)
        inner[offsets[1:] - 1] = False  # the last byte of a piece has no right neighbour in it
        at = np.flatnonzero(inner)
        ids = pa.LargeListArray.from_arrays(offsets, self.spell[data])
        ranks = pa.LargeListArray.from_arrays(np.searchsorted(at, offsets), self.of_bytes[data[at].astype(np.int64) << 8 | data[at + 1]])
        self.db.register("spelled", pa.table({"w": np.arange(len(pieces), dtype=np.int32), "ids": ids, "ranks": ranks}))
        found = self.db.sql(_ENCODE).to_arrow_table()["ids"].combine_chunks()
        self.db.unregister("spelled")
        return found.flatten().to_numpy(), found.value_lengths().to_numpy().astype(np.int64)

    def _contract_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same in batches: a query's tokens go with the square of the pieces' lengths."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(lengths, kind="stable")
        batch = np.cumsum((lengths[order] + 1) ** 2 // 2) // BATCH_ROWS
        found = [self._contract([pieces[i] for i in part.tolist()]) for part in np.split(order, np.flatnonzero(np.diff(batch)) + 1) if len(part)]
        ids, sizes = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int32) for k in (0, 1))
        # Back to the order of the pieces.
        place = np.argsort(order, kind="stable")
        begins = np.cumsum(sizes) - sizes
        return ids[ranges(begins[place], sizes[place])], sizes[place]

    def merge(self, words: list[bytes], window: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pre-tokens one after the other, and how many each has, whatever their length."""
        window = window or WINDOW
        cut = [pieces_of(w, window) if len(w) > window else None for w in words]
        ids, sizes = self._contract_all([p for w, pieces in zip(words, cut) for _, p in (pieces or [(0, w)])])
        if not any(cut):
            return ids, sizes
        ends = np.cumsum(sizes)
        out, n = [], 0
        for w, pieces in zip(words, cut, strict=True):
            windows = []
            for begin, _ in pieces or [(0, w)]:
                own = ids[ends[n] - sizes[n] : ends[n]]
                upto = begin + np.cumsum(self.size_of[own])
                windows.append((own, upto - self.size_of[own], upto))
                n += 1
            whole = stitched(windows)
            out.append(self.merge([w], 2 * window)[0] if whole is None else whole)
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _entries(self, pretokens: set[str], held: dict[str, int]) -> dict[str, int]:
        """An entry of the cache for every pre-token: that of ``held``, or a new one."""
        key_of = {t: t[1:] if t[0] == " " else f" x{t}" for t in pretokens}
        entries = {t: e for t, k in key_of.items() if (e := held.get(k)) is not None}
        # The others are contracted again rather than looked up among all entries; of equal keys the first counts.
        raw = {t: t.encode("utf-8", "replace") for t in pretokens.difference(entries)}
        plain = [t for t, w in raw.items() if len(w) <= WINDOW]
        for new in (plain, [t for t, w in raw.items() if len(w) > WINDOW] if len(plain) < len(raw) else []):  # long ones apart
            if new:
                first = len(self.cache.words)
                self.cache.add([key_of[t] for t in new], *self.merge([raw[t] for t in new]))
                entries |= dict(zip(new, range(first, first + len(new))))
        return entries

    def _joined(self, lists: list[list[str]], entries: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lists of pre-tokens one after the other, and how many each list has."""
        ids, sizes = self.cache.gather(np.array([entries[t] for own in lists for t in own], np.int64))
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(own) for own in lists], dtype=np.int64))]
        return ids, np.diff(ends)

    def _encode_heads(self, heads: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [self.pattern.findall(h) for h in heads]
        return self._joined(lists, self._entries(set().union(*lists), {}))

    def _add_missing(self, parts: list[str], held: dict[str, int]) -> None:
        """Ids of " " + part: one pre-token if the part is all letters, else by the pattern."""
        lists = [[f" {p}"] if p.isalpha() and p.isascii() else self.pattern.findall(f" {p}") for p in parts]
        entries = self._entries(set().union(*lists), held)
        several = [k for k, own in enumerate(lists) if len(own) > 1]
        self.cache.add([parts[k] for k in several], *self._joined([lists[k] for k in several], entries))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin.

        Pre-tokens never reach over a lone space, so the parts between such spaces are cached.
        """
        return encode_cached(texts, self.cache, ".,;:!?", self._encode_heads, self._add_missing)

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes that the ids stand for; an unknown id is an error."""
        sizes = np.fromiter((len(e) // 4 for e in encoded), np.int64, len(encoded))
        flat = np.frombuffer(b"".join(encoded), "<u4")
        doc = np.repeat(np.arange(len(encoded)), sizes)
        parts: list[list[bytes]] = [[] for _ in encoded]
        for at in range(0, len(flat), BATCH_TOKENS):
            ids, own = flat[at : at + BATCH_TOKENS], doc[at : at + BATCH_TOKENS]
            unknown = ids[(ids >= len(self.size_of)) | (self.size_of[np.minimum(ids, len(self.size_of) - 1)] == 0)]
            if len(unknown):
                raise ValueError(f"id {unknown[0]} is not in the vocabulary")
            self.db.register("tokens", pa.table({"d": own, "pos": np.arange(len(ids), dtype=np.int32), "id": ids.astype(np.int32)}))
            for d, text in self.db.execute(_DECODE).fetchall():
                parts[d].append(bytes.fromhex(text))
            self.db.unregister("tokens")
        return [b"".join(p) for p in parts]


def codec(packed: tuple[bytes, str]) -> DuckCodec:
    """One codec per Python worker and rank file."""

    def make() -> DuckCodec:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in packed[0].splitlines() if line.strip())}
        return DuckCodec(ranks, packed[1])

    return worker_state(("codec", zlib.crc32(packed[0] + packed[1].encode())), make)


def _shared(df: DataFrame, ranks_path: str, pattern: str):
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast((f.read(), pattern))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit) for every row."""
    shared = _shared(docs, ranks_path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for block in text_blocks(batches, 1, SLICE):
            ids, begins = own.encode(block.column(1))
            packed = pa.Array.from_buffers(pa.large_binary(), block.num_rows, [None, pa.py_buffer(4 * begins), pa.py_buffer(ids.astype("<u4"))])
            done = pa.RecordBatch.from_arrays([block.column(0), packed.cast(pa.binary())], ["doc_id", "ids"])
            for at in range(0, done.num_rows, ROWS_OUT):
                yield done.slice(at, ROWS_OUT)
        give_back()

    return narrow(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str = "") -> DataFrame:
    """doc_id, ids, decoded (bytes) for every row of ``encoded``; null ids count as none.

    With the encoder's pattern the two share one codec in a worker.
    """
    shared = _shared(encoded, ranks_path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            for part in row_slices(batch, 1, 4 * BATCH_TOKENS):
                decoded = own.decode([b or b"" for b in part.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return narrow(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
