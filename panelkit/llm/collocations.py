"""Phrase collocations by top-order marginalisation.

Texts are lower-cased (A-Z only) and cut into pieces and words.  Every word
opens one window: the word itself and, as lead columns, the next ones of its
piece, padded with "" behind the piece's end.  Only these longest windows are
counted, first within blocks of texts, then over all blocks.  ROLLUP then sums
the counts over successively shorter prefixes, so one aggregate holds the
occurrences of every phrase of every length, and of all words of a language,
without exploding each length of its own.  Windows that no phrase of
``min_count`` occurrences can come from are added up under their longest prefix
that still matters before ROLLUP sees them; the sums stay the same.

Candidates are phrases of 2 to ``max_words`` words with at least ``min_count``
occurrences.  One whose words lie inside a longer candidate that has at least
``covered_percent`` percent of its occurrences is dropped.  The others are cut
after each of their words into two parts with l and r occurrences; the score is
the lowest floor(SCALE * a * a / (l * r)), in exact decimals (up to 10**14
occurrences), of the first such cut on ties.

How it scales: a block sends its different windows once, those of one first
word together.  They meet by (lang, first word), and for first words with over
1 / HOT_SHARE of all windows also by a hash of the second word into HOT_SALTS
shares (at most 2 * HOT_SHARE such words are collected), so no word makes one
large group.  A task reads its groups in order, BLOCK_WINDOWS windows or one
group at a time.  The parts' occurrences are joined by phrase; the phrase side
has one row a key, so AQE splits a hot part.  The first ``top`` of a language
are found within SALTS shares of its phrases, then among those at most
SALTS * top rows.

Null text counts as empty, a null language as ``und``; texts without words
count nothing.  Repeated rows count each.  No input gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import narrow, text_blocks
from panelkit.session import scratch_path

MIN_COUNT = 10
MAX_WORDS = 3
COVERED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
SALTS = 16
SLICE = 1 << 22
BLOCK_WINDOWS = 1 << 19
TASK_WINDOWS = 1 << 21
HOT_SHARE = 1024
HOT_SALTS = 64
_EXACT = "decimal(14,0)"
_BLOCKS = "lang string, first string, salt int, tails string, counts array<int>"

# What parts words (space, tab) and what ends a piece.
GAPS, PIECE_ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(GAPS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """All words of the texts in order, the row of each, and whether the next word belongs to the same piece."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    kind = _KIND[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] |= inside[offsets[:-1][offsets[:-1] < len(data)]]
    begins = np.flatnonzero(begins)
    kept = np.append(0, np.cumsum(inside))
    edges = np.append(kept[begins], kept[-1])
    ends = np.cumsum(kind == 2, dtype=np.int32)[begins]
    row = np.searchsorted(offsets, begins, "right") - 1
    same = np.append((ends[1:] == ends[:-1]) & (row[1:] == row[:-1]), False)
    words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data[inside]))
    return words.dictionary_encode(), row, same[: len(begins)]


def unique_rows(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of non-negative integer columns, in order, and their summed counts."""
    packed, limit = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        width = int(c.max(initial=0)) + 1
        if limit * width >= 1 << 62:
            # Too wide for one number: ranks take the place of what is packed so far.
            seen, packed = np.unique(packed, return_inverse=True)
            limit = len(seen)
        packed, limit = packed * width + c, limit * width
    order = np.argsort(packed, kind="stable")
    opens = np.flatnonzero(np.diff(packed[order], prepend=-1))
    return [c[order[opens]] for c in columns], np.add.reduceat(counts[order], opens) if len(opens) else counts[:0]


def _leads(code: np.ndarray, same: np.ndarray, max_words: int) -> list[np.ndarray]:
    """The lead columns of every word: codes counted from 1, and 0 behind the end of the piece."""
    columns, goes_on = [code + 1], np.ones(len(code), bool)
    for k in range(1, max_words):
        goes_on = goes_on & np.append(same[k - 1 :], np.zeros(min(k - 1, len(code)), bool))[: len(code)]
        columns.append(np.where(goes_on, np.append(code[k:], np.zeros(min(k, len(code)), code.dtype)) + 1, 0))
    return columns


def hot_words(texts: DataFrame) -> tuple[int, set[tuple[str, str]]]:
    """The number of all words, and the (lang, word) pairs with over 1 / (2 * HOT_SHARE) of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 0, SLICE):
            words, row, _ = words_of(block.column(0))
            langs = block.column(1).dictionary_encode()
            (lang, code), n = unique_rows([langs.indices.to_numpy()[row], words.indices.to_numpy()], np.ones(len(words), np.int64))
            often = n * HOT_SHARE >= len(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([langs.dictionary.cast(pa.string()).take(pa.array(lang[often])), pa.nulls(1, pa.string())]),
                    pa.concat_arrays([words.dictionary.cast(pa.string()).take(pa.array(code[often])), pa.nulls(1, pa.string())]),
                    pa.array(np.append(n[often], len(words))),
                ],
                ["lang", "word", "n"],
            )

    sums = texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # The first row is the total; any other has a share of it, so at most 2 * HOT_SHARE rows have enough.
    rows = sums.orderBy(F.desc("n"), F.col("word").isNotNull()).limit(2 * HOT_SHARE + 1).collect()
    total = rows[0].n if rows else 0
    return total, {(r.lang, r.word) for r in rows if r.word is not None and r.n * 2 * HOT_SHARE >= total}


def _sent_windows(texts: DataFrame, max_words: int, hot: set[tuple[str, str]]) -> DataFrame:
    """Each block's windows with their counts: those of one language and first word (and salt) as one row of joined tails."""
    shared = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 0, SLICE):
            words, row, same = words_of(block.column(0))
            if not len(words):
                continue
            langs = block.column(1).dictionary_encode()
            lang_names, names = langs.dictionary.to_pylist(), words.dictionary.to_pylist()
            columns, counts = unique_rows([langs.indices.to_numpy()[row], *_leads(words.indices.to_numpy(), same, max_words)], np.ones(len(words), np.int64))
            lang, first, second = columns[0], columns[1] - 1, columns[2]
            at = {w: i for i, w in enumerate(names)}
            salted = np.zeros((len(lang_names), len(names)), bool)
            for own_lang, word in shared.value:
                if own_lang in lang_names and word in at:
                    salted[lang_names.index(own_lang), at[word]] = True
            salt = np.zeros(len(lang), np.int64)
            spread = salted[lang, first]
            hashes = {c: zlib.crc32(names[c - 1].encode()) % HOT_SALTS for c in np.unique(second[spread]).tolist() if c}
            salt[spread] = [hashes.get(c, 0) for c in second[spread].tolist()]
            order = np.lexsort((salt, first, lang))
            keys = [c[order] for c in (lang, first, salt)]
            opens = np.flatnonzero(np.any([np.diff(k, prepend=-1) != 0 for k in keys], axis=0))
            lists = np.append(opens, len(order)).astype(np.int32)
            padded = pa.concat_arrays([pa.array([""], pa.large_string()), words.dictionary])
            tails = padded.take(pa.array(np.stack([c[order] for c in columns[2:]], 1).ravel()))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(lists * (max_words - 1)), tails.cast(pa.string())), " ")
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.cast(pa.string()).take(pa.array(keys[0][opens])),
                    words.dictionary.cast(pa.string()).take(pa.array(keys[1][opens])),
                    pa.array(keys[2][opens].astype(np.int32)),
                    joined,
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(counts[order].astype(np.int32))),
                ],
                [c.split()[0] for c in _BLOCKS.split(", ")],
            )

    return texts.mapInArrow(run, _BLOCKS)


def marginal_rows(table: pa.Table, min_count: int, max_words: int) -> pa.RecordBatch:
    """(lang, w1 .. , a) from whole groups of sent windows, equal groups next to each other.

    A window keeps its words up to the longest prefix that has ``min_count``
    occurrences in the group; behind it comes padding.
    """
    lang, first, salt, tails, counts = (c.combine_chunks() for c in table.columns)
    change = [np.append(True, pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)) for c in (lang, first, salt)]
    group = np.cumsum(np.any(change, axis=0)) - 1
    size = counts.value_lengths().to_numpy()
    words = pc.split_pattern(tails, " ").flatten().dictionary_encode()
    codes = words.indices.to_numpy().reshape(-1, max_words - 1)
    columns, a = unique_rows([np.repeat(group, size), *codes.T], counts.flatten().to_numpy().astype(np.int64))
    empty = pc.index(words.dictionary, "").as_py()
    left, parts = a.copy(), []
    for k in range(max_words - 1, -1, -1):
        opens = np.flatnonzero(np.any([np.diff(c, prepend=-1) != 0 for c in columns[: k + 1]], axis=0))
        keep = np.ones(len(opens), bool)
        if k:
            keep = (np.add.reduceat(a, opens) >= min_count) & (columns[k][opens] != empty)
        own = np.add.reduceat(left, opens)
        left[np.repeat(keep, np.diff(np.append(opens, len(a))))] = 0
        rows = opens[keep & (own > 0)]
        parts.append(([columns[0][rows], *[columns[j][rows] if j <= k else np.full(len(rows), -1) for j in range(1, max_words)]], own[keep & (own > 0)]))
    groups = np.concatenate([p[0][0] for p in parts])
    at = pa.array(np.flatnonzero(np.any(change, axis=0))[groups])
    dictionary = pa.concat_arrays([words.dictionary, pa.array([""], words.dictionary.type)])
    codes = [np.concatenate([p[0][j] for p in parts]) for j in range(1, max_words)]
    others = [dictionary.take(pa.array(np.where(c < 0, len(words.dictionary), c))) for c in codes]
    return pa.RecordBatch.from_arrays([lang.take(at), first.take(at), *others, pa.array(np.concatenate([p[1] for p in parts]))], ["lang", *[f"w{k + 1}" for k in range(max_words)], "a"])


def longest_windows(docs: DataFrame, min_count: int, max_words: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, w1 .. , a): the counted windows of the corpus, padded where no phrase needs their later words."""
    texts = narrow(docs, text_col, lang_col).toDF("text", "lang").select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    total, hot = hot_words(texts)
    sent = _sent_windows(texts, max_words, hot).repartition(max(1, -(-total // TASK_WINDOWS)), "lang", "first", "salt").sortWithinPartitions("lang", "first", "salt")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += len(batch.column(4).flatten())
            if size < BLOCK_WINDOWS:
                continue
            # All but the last group are whole.
            table = pa.Table.from_batches(held)
            last = [c[-1] for c in table.columns[:3]]
            same = [pc.equal(c, v).to_numpy() for c, v in zip(table.columns[:3], last)]
            whole = int(np.argmax(np.all(same, axis=0)))
            if whole:
                yield marginal_rows(table.slice(0, whole), min_count, max_words)
            held = table.slice(whole).combine_chunks().to_batches()
            size = sum(len(b.column(4).flatten()) for b in held)
        if held:
            yield marginal_rows(pa.Table.from_batches(held), min_count, max_words)

    return sent.mapInArrow(run, ", ".join(["lang string", *[f"w{k + 1} string" for k in range(max_words)], "a long"]))


def phrase_counts(longest: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, words, a): occurrences of every phrase of 1 to ``max_words`` words from ``min_count`` on, and all words of a language (no words)."""
    cols = [f"w{k + 1}" for k in range(max_words)]
    rolled = longest.rollup("lang", *cols).agg(F.sum("a").alias("a"), F.grouping_id().alias("level"))
    # Level 2**k - 1 has the last k columns summed over; a prefix that ends in padding is a shorter phrase, counted on its own level.
    size = F.lit(max_words) - F.round(F.log2(F.col("level") + 1)).cast("int")
    phrases = rolled.where(F.col("level") < 2 ** (max_words + 1) - 1).withColumn("size", size)
    whole = phrases.where((F.col("size") == 0) | ((F.col("a") >= min_count) & (F.element_at(F.array(F.lit("pad"), *cols), F.col("size") + 1) != "")))
    return whole.select("lang", F.slice(F.array(*cols), 1, F.col("size")).alias("words"), "a")


def _sub_phrases(words: Column, max_words: int) -> Column:
    """All contiguous shorter phrases of at least two words."""
    lengths = F.filter(F.sequence(F.lit(2), F.lit(max(2, max_words - 1))), lambda k: k < F.size(words))
    return F.flatten(F.transform(lengths, lambda k: F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.slice(words, i, k))))


def _uncovered(candidates: DataFrame, max_words: int, covered_percent: int) -> DataFrame:
    """Candidates that no longer candidate with enough occurrences holds."""
    longer = candidates.select("lang", F.explode(_sub_phrases(F.col("words"), max_words)).alias("words"), F.lit(None).cast("long").alias("a"), F.col("a").alias("inside"))
    both = candidates.select("lang", "words", "a", F.lit(None).cast("long").alias("inside")).union(longer)
    best = both.groupBy("lang", "words").agg(F.max("a").alias("a"), F.max("inside").alias("inside"))
    covered = F.col("inside").cast(_EXACT) * 100 >= F.col("a").cast(_EXACT) * covered_percent
    return best.where(F.col("a").isNotNull() & ~F.coalesce(covered, F.lit(False))).select("lang", "words", "a")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, words, a, l, r, score) by the lowest-scoring cut."""
    cuts = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut")
    cut = candidates.select("lang", "words", "a", cuts)
    first, rest = F.slice("words", 1, F.col("cut")), F.slice("words", F.col("cut") + 1, F.size("words"))
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), p.alias("part")) for i, p in enumerate((first, rest))])).alias("half")
    parts = cut.select("lang", "words", "a", "cut", sides).select("lang", "words", "a", "cut", "half.side", "half.part")
    known = counts.select("lang", F.col("words").alias("part"), F.col("a").alias("f"))
    # An inner join: a part occurs at least as often as its phrase, so it is among the counted phrases.
    joined = parts.join(known, ["lang", "part"])
    sided = joined.groupBy("lang", "words", "a", "cut").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    a, l, r = (F.col(c).cast(_EXACT) for c in "alr")
    sided = sided.withColumn("score", F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (a * a), l * r))
    lowest = sided.groupBy("lang", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return lowest.select("lang", "words", "a", "low.l", "low.r", "low.score")


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    covered_percent: int = COVERED_PERCENT,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by score, a (falling) and phrase."""
    if max_words < 2:
        raise ValueError("a phrase has at least two words")
    counts = _stored(phrase_counts(longest_windows(docs, min_count, max_words, text_col, lang_col), min_count, max_words))
    candidates = counts.where(F.size("words") >= 2)
    scored = _scored(_uncovered(candidates, max_words, covered_percent), counts.where(F.size("words").between(1, max_words - 1)))
    phrases = scored.select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = phrases.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top).drop("rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where(F.size("words") == 0).select("lang", F.col("a").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _stored(df: DataFrame) -> DataFrame:
    """Written into the shared folder and read again: three plans below read it."""
    path = scratch_path(df.sparkSession, "phrase-counts")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
