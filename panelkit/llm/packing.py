"""Packing documents into fixed-length sequences by order-preserving dynamic programming.

The documents of a partition, in their order, form one stream of tokens; a
sequence is a window of at most ``length`` tokens of it.  Windows may be cut
at document ends (free), at sentence ends (SENTENCE_PENALTY) and, where a
sentence goes on for more than STRIDE tokens, at every STRIDE tokens of it
(TRUNCATION_PENALTY).  With p the positions of the allowed cuts, the least
total of padding and penalties up to cut j is

    cost[j] = penalty[j] + length - p[j] + min(cost[i] + p[i])  over p[i] >= p[j] - length

and the minimum slides over i, so a monotone queue makes every transition
constant.  The programme runs over blocks of BLOCK tokens; the last window of
a block goes on into the next one, so memory is bounded by the block and the
longest document.  No row moves between tasks.

Null text counts as empty: such a document is its end token alone.  Repeated
rows are packed each.  Sequence numbers hold the partition's number; give a
table or a checkpoint as input, so that a lost task comes back the same.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import IdCache, encode_cached, give_back, narrow, text_blocks, worker_state

LENGTH = 2048
END_ID = 1
STRIDE = 128
SENTENCE_PENALTY = 2
TRUNCATION_PENALTY = 24
BLOCK = 1 << 20
CACHE_BYTES = 48 << 20
SLICE = 1 << 22
_JOINED = 2_000


class CachedEncoder:
    """Token ids of whole texts by a ``tokenizers`` byte-level BPE, word by word with a cache bounded in bytes.

    Its pre-tokens never hold a space behind their first character, so a text
    can be cut at every space between two characters that are not white
    space; each cut part is encoded with its space by the library.
    """

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec.decode("utf-8"))
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.opens = np.array([n.startswith("Ġ") for n in names])
        self.ends_sentence = np.array([n.endswith((".", "!", "?")) or "Ċ" in n for n in names])
        self.stops = {c: int(self.encode_all([c])[0][0]) for c in ".,"}
        self.cache = IdCache(CACHE_BYTES)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def _add_encoded(self, words: list[str]) -> dict[str, int]:
        """Put in the ids of " " + word, and return the entries; plain words are encoded many at a time and told apart by their leading space."""
        done, ids_of, sizes_of = [], [], []
        plain = [w for w in words if w and " " not in w and not w[0].isspace() and not w[-1].isspace()]
        rest = set(words).difference(plain) if len(plain) < len(words) else set()
        for at in range(0, len(plain), _JOINED):
            part = plain[at : at + _JOINED]
            ids, _ = self.encode_all([" " + " ".join(part)])
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(part):
                done += part
                ids_of.append(ids)
                sizes_of.append(np.diff(np.append(starts, len(ids))))
            else:
                rest.update(part)
        others = sorted(rest)
        ids, sizes = self.encode_all([" " + w for w in others])
        first = len(self.cache.words)
        self.cache.add(done + others, np.concatenate([*ids_of, ids]), np.concatenate([*sizes_of, sizes]))
        return dict(zip(done + others, range(first, len(self.cache.words))))

    def _add_missing(self, words: list[str], held: dict[str, int]) -> None:
        # A Latin word and the full stop or comma behind it are two pre-tokens: only the word needs encoding.
        stemmed = [w for w in words if w[-1:] in self.stops and w[:-1].isalpha() and max(w) < "\u0250"]
        whole = set(words).difference(stemmed)
        held = held | self._add_encoded(list(whole.union(w[:-1] for w in stemmed if w[:-1] not in held)))
        if stemmed:
            ids, sizes = self.cache.gather(np.array([held[w[:-1]] for w in stemmed]))
            self.cache.add(stemmed, np.insert(ids, np.cumsum(sizes), [self.stops[w[-1]] for w in stemmed]), sizes + 1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        return encode_cached(texts, self.cache, "".join(self.stops), self.encode_all, self._add_missing)


def cached_encoder(spec: bytes) -> CachedEncoder:
    """One encoder, with its cache, per Python worker and vocabulary."""
    return worker_state(("packing", zlib.crc32(spec)), lambda: CachedEncoder(spec))


def cut_points(ids: np.ndarray, ends_sentence: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Positions behind which a document may be cut, its end last, and their penalties."""
    known = np.minimum(ids, len(ends_sentence) - 1)
    soft = np.flatnonzero(ends_sentence[known][:-1]) + 1
    marks = np.concatenate([[0], soft, [len(ids)]])
    gaps = np.diff(marks)
    points, penalties = [soft, [len(ids)]], [np.full(len(soft), SENTENCE_PENALTY), [0]]
    for k in np.flatnonzero(gaps > stride):
        hard = np.arange(marks[k] + stride, marks[k + 1], stride)
        points.append(hard)
        penalties.append(np.full(len(hard), TRUNCATION_PENALTY))
    at, cost = np.concatenate(points), np.concatenate(penalties)
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


def best_windows(points: list[int], penalties: list[int], length: int) -> list[int]:
    """Indices of the chosen cuts, the last point included: least padding plus penalties.

    ``points`` increase, start behind position 0 and are at most ``length`` apart.
    """
    p = [0, *points]
    value = [0] * len(p)  # cost + position, as the transition needs it
    back = [0] * len(p)
    queue: deque[int] = deque([0])
    for j in range(1, len(p)):
        low = p[j] - length
        while p[queue[0]] < low:
            queue.popleft()
        best = queue[0]
        back[j] = best
        v = value[j] = penalties[j - 1] + length + value[best]
        while queue and value[queue[-1]] > v:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(p) - 1
    while j:
        cuts.append(j - 1)
        j = back[j]
    return cuts[::-1]


class _Stream:
    """Documents waiting to be packed; emits the pieces of finished windows."""

    def __init__(self, ends_sentence: np.ndarray, length: int, first_sequence: int):
        self.ends_sentence, self.length, self.sequence = ends_sentence, length, first_sequence
        self.docs: deque[list] = deque()  # doc_id, ids, tokens already packed, cut points, penalties
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at, cost = cut_points(ids, self.ends_sentence)
        self.docs.append([doc_id, ids, 0, at, cost])
        self.waiting += len(ids)

    def pack(self, last: bool) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        points, penalties, base = [], [], 0
        for _, ids, done, at, cost in self.docs:
            left = np.searchsorted(at, done, "right")
            points.append(at[left:] - done + base)
            penalties.append(cost[left:])
            base += len(ids) - done
        if not points:
            return out
        points = np.concatenate(points).tolist()
        cuts = best_windows(points, np.concatenate(penalties).tolist(), self.length)
        begin = 0
        for cut in cuts if last else cuts[:-1]:
            room = points[cut] - begin
            begin = points[cut]
            offset = 0
            while room:
                doc = self.docs[0]
                take = min(room, len(doc[1]) - doc[2])
                piece = doc[1][doc[2] : doc[2] + take]
                for k, v in zip(out, (doc[0], doc[2], take, zlib.crc32(piece), len(doc[1]), self.sequence, offset), strict=True):
                    out[k].append(v)
                offset += take
                room -= take
                doc[2] += take
                if doc[2] == len(doc[1]):
                    self.docs.popleft()
            self.sequence += 1
            self.waiting -= offset
        return out


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if length < STRIDE:
        raise ValueError(f"length must be at least {STRIDE}")
    with open(tokenizer_path, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    fields = pa.schema([(c.split()[0], pa.int64()) for c in schema.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = cached_encoder(spec.value)
        stream = _Stream(encoder.ends_sentence, length, TaskContext.get().partitionId() << 40)
        for part in text_blocks(batches, 1, SLICE):
            ids, begins = encoder.encode(part.column(1))
            for doc_id, a, b in zip(part.column(0).to_pylist(), begins.tolist(), begins[1:].tolist()):
                stream.add(doc_id, np.append(ids[a:b], np.uint32(end_id)))
                if stream.waiting >= block:
                    yield pa.RecordBatch.from_pydict(stream.pack(last=False), schema=fields)
        yield pa.RecordBatch.from_pydict(stream.pack(last=True), schema=fields)
        del stream
        give_back()

    return narrow(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
