"""Token counts of a SentencePiece BPE model by rank-synchronous array merging.

The text becomes units of white-space marks followed by other characters; no
piece of the model holds a mark behind another character, so units are
independent.  So are the parts of a unit between two characters that stand side
by side in no piece: no merge joins them.  Batches of distinct units lie as
ragged arrays of symbols.  In every round each part finds the lowest rank among
its neighbouring pairs and merges at once all pairs of that rank that do not
overlap, from the left.  Where a merge could make a pair of an equal or lower
rank (known from the model beforehand), only the leftmost pair of the part is
merged in that round, so the result is that of merging one best pair after the
other.  Pairs of the last rank, white space above all, are many of one rank;
where they alone are left and make no other, a part is folded from the left in
one pass.  A part without a pair is done, and its surviving symbols are counted; a
character that the model lacks counts one token for each of its UTF-8 bytes.

Supported are BPE models with byte fallback, identity normalisation, a dummy
prefix and kept white space; others are refused.  Null text counts as empty
and has no token.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import WordCache, narrow, slices, worker_state

MARK = "▁"
LIMIT = 4096
CACHE_WORDS = 400_000
BATCH_SYMBOLS = 1 << 18
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")
_NONE = np.iinfo(np.int64).max


class MergeTable:
    """Pairs of piece ids that merge, with rank and merged id, sorted by pair."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        """``pieces``: id and score of every mergeable piece."""
        self.size = max((i for i, _ in pieces.values()), default=0) + 1
        scores = sorted({s for _, s in pieces.values()}, reverse=True)
        rank_of = {s: k for k, s in enumerate(scores)}
        rows = []
        for piece, (number, score) in pieces.items():
            for cut in range(1, len(piece)):
                if (left := pieces.get(piece[:cut])) and (right := pieces.get(piece[cut:])):
                    rows.append((left[0] * (self.size + 1) + right[0], rank_of[score], number, left[0], right[0]))
        rows.sort()
        pairs, ranks, merged, lefts, rights = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5
        self.pairs, self.ranks, self.merged = pairs, ranks, merged
        # A merge of rank r is safe if every pair with its result on either side ranks above r.
        least = np.full(self.size + 1, _NONE)
        np.minimum.at(least, lefts, ranks)
        np.minimum.at(least, rights, ranks)
        shared = np.zeros(len(scores) + 1, np.int64)
        for p, (_, s) in pieces.items():
            if len(p) > 1:
                shared[rank_of[s]] += 1
        self.safe = (least[merged] > ranks) & (shared[ranks] == 1)
        self.symbol = np.full(0x110000, self.size, np.int64)  # size: a character without a piece
        for piece, (number, _) in pieces.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = number

        # Merges of the last rank, if they never make a pair of a rank before it.
        self.last = len(scores) - 1
        final = ranks == self.last
        closed = bool(final.any() and (least[merged[final]] >= self.last).all())
        self.fold = dict(zip(zip(lefts[final].tolist(), rights[final].tolist()), merged[final].tolist())) if closed else {}
        side_by_side = {(p[k], p[k + 1]) for p in pieces for k in range(len(p) - 1)}
        joins = [self.symbol[ord(a)] * (self.size + 1) + self.symbol[ord(b)] for a, b in side_by_side]
        self.joins = np.array(sorted(joins), np.int64)

    def parts(self, symbols: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """The number of each character's part: a new one with each unit and where no piece holds both neighbours."""
        if not len(symbols) or not len(self.joins):
            return np.arange(len(symbols))
        key = symbols[:-1] * (self.size + 1) + symbols[1:]
        joined = self.joins[np.minimum(np.searchsorted(self.joins, key), len(self.joins) - 1)] == key
        joined &= (unit[1:] == unit[:-1]) & (symbols[:-1] != self.size) & (symbols[1:] != self.size)
        return np.cumsum(np.r_[False, ~joined])

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (_NONE without one) and its row in the table."""
        key = left * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], _NONE), at


def count_units(units: list[str], table: MergeTable) -> np.ndarray:
    """Surviving tokens of each unit."""
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    codes = np.frombuffer("".join(units).encode("utf-32-le", "replace"), np.uint32)
    symbols = table.symbol[codes]
    unit = np.repeat(np.arange(len(units)), lengths)
    unknown = symbols == table.size
    counts = np.bincount(unit[unknown], minlength=len(units))
    for limit in (0x80, 0x800, 0x10000):  # further bytes of characters that have no piece
        counts += np.bincount(unit[unknown & (codes >= limit)], minlength=len(units))
    if not len(table.pairs):
        return counts + np.bincount(unit[~unknown], minlength=len(units))
    part = table.parts(symbols, unit)
    alone = np.r_[True, part[1:] != part[:-1]] & np.r_[part[1:] != part[:-1], True] if len(part) else np.zeros(0, bool)
    counts += np.bincount(unit[alone & ~unknown], minlength=len(units))
    owner, symbols, part = unit[~alone], symbols[~alone], part[~alone]
    if not len(symbols):
        return counts
    # Parts are numbered through, and each knows its unit.
    new_part = np.r_[True, part[1:] != part[:-1]]
    owner, unit = owner[new_part], np.cumsum(new_part) - 1
    survivors = merged_symbols(symbols, unit, len(owner), table)
    return counts + np.bincount(owner, weights=survivors, minlength=len(units)).astype(np.int64)


def merged_symbols(symbols: np.ndarray, unit: np.ndarray, n: int, table: MergeTable) -> np.ndarray:
    """Symbols that survive in each of the ``n`` parts; ``unit`` numbers each symbol's part."""
    counts = np.zeros(n, np.int64)
    rank, at = _neighbours(symbols, unit, table)
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        low = np.minimum.reduceat(rank, starts)
        spread = np.repeat(low, np.diff(np.append(starts, len(unit))))
        folded = spread == table.last if table.fold else np.zeros(len(symbols), bool)
        if folded.any():
            counts += _folded(symbols[folded], unit[folded], n, table.fold)
        done = (spread == _NONE) | folded
        if done.any():
            counts += np.bincount(unit[done & ~folded], minlength=n)
            keep = ~done
            symbols, unit, rank, at, spread = symbols[keep], unit[keep], rank[keep], at[keep], spread[keep]
            if not len(symbols):
                break
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        # Of overlapping pairs every second one, from the left; unsafe ones only as the part's leftmost.
        hits = np.flatnonzero(rank == spread)
        new_run = np.r_[True, np.diff(hits) > 1]
        run_start = hits[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
        leftmost = np.r_[True, unit[hits[1:]] != unit[hits[:-1]]]
        hits = hits[np.where(table.safe[at[hits]], (hits - run_start) % 2 == 0, leftmost)]
        # An unsafe pair keeps its part to one merge in this round.
        first = np.r_[True, unit[hits[1:]] != unit[hits[:-1]]]
        single = ~table.safe[at[hits]]
        blocked = np.zeros(n, bool)
        blocked[unit[hits[first & single]]] = True
        hits = hits[first | ~blocked[unit[hits]]]
        symbols[hits] = table.merged[at[hits]]
        stay = np.ones(len(symbols), bool)
        stay[hits + 1] = False
        place = np.cumsum(stay) - 1
        symbols, unit, rank, at = symbols[stay], unit[stay], rank[stay], at[stay]
        moved = place[hits]
        again = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
        rank[again], at[again] = _pairs_at(again, symbols, unit, table)
    return counts


def _folded(symbols: np.ndarray, unit: np.ndarray, n: int, fold: dict[tuple[int, int], int]) -> np.ndarray:
    """Symbols left of each part after merging its leftmost pair again and again, all pairs being of one rank.

    Left of the current symbol no pair merges, so a stack holds what is final so far.
    """
    counts = np.zeros(n, np.int64)
    stack: list[int] = []
    before = -1
    for s, u in zip(symbols.tolist(), unit.tolist()):
        if u != before:
            if stack:
                counts[before] = len(stack)
            stack, before = [], u
        while stack and (joined := fold.get((stack[-1], s))) is not None:
            s = joined
            stack.pop()
        stack.append(s)
    if stack:
        counts[before] = len(stack)
    return counts


def _neighbours(symbols: np.ndarray, unit: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    return _pairs_at(np.arange(len(symbols)), symbols, unit, table)


def _pairs_at(i: np.ndarray, symbols: np.ndarray, unit: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Rank and table row of the pair that begins at each position."""
    j = np.minimum(i + 1, len(symbols) - 1)
    rank, at = table.lookup(symbols[i], symbols[j])
    return np.where((j > i) & (unit[i] == unit[j]), rank, _NONE), at


class TokenCounter:
    """Counts tokens of whole texts, with a bounded cache of units."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        if sp.encode(" a  ", out_type=str) != sp.encode("a", out_type=str) and "".join(sp.encode(" a  ", out_type=str)) == f"{MARK * 2}a{MARK * 2}":
            pieces = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        else:
            raise ValueError("only models with a dummy prefix and kept white space are supported")
        if any(MARK in p.lstrip(MARK) for p in pieces) or not any(sp.is_byte(i) for i in range(sp.get_piece_size())):
            raise ValueError("only models with byte fallback whose pieces begin at white space are supported")
        self.merges = MergeTable(pieces)
        self.cache = WordCache(CACHE_WORDS)

    def _count(self, words: list[str]) -> list[int]:
        out: list[int] = []
        batch: list[str] = []
        size = 0
        for w in words:
            batch.append(MARK + w)
            size += len(w) + 1
            if size >= BATCH_SYMBOLS:
                out += count_units(batch, self.merges).tolist()
                batch, size = [], 0
        return out + count_units(batch, self.merges).tolist() if batch else out

    def count(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        units = []
        for text in texts:
            if not text:
                units.append([])
            elif MARK in text or "  " in text or text[0] == " ":
                # Units with several marks: the first mark is implied by the cache's keys.
                units.append([u[1:] for u in _UNIT.findall(MARK + text.replace(" ", MARK))])
            else:
                units.append(text.split(" "))
        table = self.cache.table(units, self._count)
        return [sum(map(table.__getitem__, own)) for own in units]


def counter(model: bytes) -> TokenCounter:
    """One counter, with its cache, per Python worker and model."""
    return worker_state(("counts", zlib.crc32(model)), lambda: TokenCounter(model))


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model.value)
        for ids, texts in slices(batches):
            texts = [t or "" for t in texts]
            sizes = [len(t.encode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(own.count(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = narrow(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
