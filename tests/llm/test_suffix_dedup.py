import hashlib
import random

import numpy as np
import pytest

import __spark_entry__ as E
from odd_rows import SF_SMALL, no_docs, odd_docs  # noqa: F401
from panelkit.llm import suffix_dedup as S


def brute(docs, length):
    """(doc_id, text bytes) pairs in corpus order -> (bytes, removed, runs, kept) of each."""
    seen, out = set(), []
    for _, raw in docs:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in df.collect()}


def test_registered_query_matches_brute_force(spark):
    rows = E.queries()["op12_suffix_dedup"](spark, SF_SMALL).collect()
    docs = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    want = {i: (a, b, c, hashlib.sha256(d).hexdigest()) for (i, _), (a, b, c, d) in zip(docs, brute(docs, 100))}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want and len(rows) == len(want)
    assert sum(r.n_removed for r in rows) > 0


@pytest.mark.parametrize("length, hot, seed", [(100, 4096, 0), (30, 2, 1), (30, 0, 2), (8, 3, 3)])
def test_generated_texts(spark, length, hot, seed):
    """Few words, so passages, phrases and whole texts repeat in many ways; ``hot`` sends anchors through single windows."""
    rng = random.Random(seed)
    words = ["a", "bb", "ccc", "x" * 40, "né", "\0", "the", "of", " ", "\U0001f600"]
    shared = ["".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    texts = []
    for i in range(90):
        parts = [rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(0, 4))]
        texts.append("".join(parts))
    texts += [texts[3]] * 5 + [texts[5] + "tail"] + ["z" * 700, "z" * 450, "ab" * 300, "".join(chr(33 + i % 41) for i in range(180))]
    rows = list(enumerate(texts))
    docs = [(i, t.encode()) for i, t in rows]
    assert result(S.remove_repeats(frame(spark, rows), length, hot)) == dict(enumerate(brute(docs, length)))


@pytest.mark.parametrize("segment, run_windows, block", [(257, 7, 300), (1 << 19, 256, 1 << 20)])
def test_long_texts_are_cut_into_segments(spark, monkeypatch, segment, run_windows, block):
    for name, value in (("SEGMENT", segment), ("RUN_WINDOWS", run_windows), ("BLOCK", block)):
        monkeypatch.setattr(S, name, value)
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, base), (2, base[500:900] + "!" + base[1000:2500]), (3, "q" + base[50:149] + "q"), (4, base[50:150])]
    S_runs = list(S.Anchors(100, segment).runs(np.frombuffer(base.encode(), np.uint8), np.array([0, 3000])))
    assert sum(int(r[1].sum()) for r in S_runs) == 2901
    assert result(S.remove_repeats(frame(spark, rows))) == dict(zip((1, 2, 3, 4), brute([(i, t.encode()) for i, t in rows], 100)))


@pytest.mark.parametrize("segment", [257, S.SEGMENT])
def test_runs_of_a_document_do_not_depend_on_its_neighbours(segment):
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abcd ") for _ in range(n)) for n in (70_000, 0, 99, 100, 900, segment, 2 * segment + 100)] + [b"z" * 3000]

    def found(order):
        raw, out = [texts[k] for k in order], {}
        offsets = np.cumsum([0] + [len(r) for r in raw])
        for rows in S.Anchors(100, segment).runs(np.frombuffer(b"".join(raw), np.uint8), offsets):
            for first, *rest in zip(*(c.tolist() for c in rows)):
                own = int(np.searchsorted(offsets, first, "right")) - 1
                out.setdefault(order[own], []).append((first - int(offsets[own]), *rest))
        return out

    alone = {k: v for i in range(len(texts)) for k, v in found([i]).items()}
    assert [sum(r[1] for r in alone.get(k, [])) for k in range(len(texts))] == [max(0, len(t) - 99) for t in texts]
    for _ in range(5):
        order = rng.sample(range(len(texts)), len(texts))
        assert found(order) == alone


def test_passages_that_repeat_in_texts_of_many_sizes(spark):
    """The last pass meets the documents in another order and company than the first."""
    rng = random.Random(6)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(90, 6000))) for _ in range(12)]
    texts = ["".join(p for _ in range(rng.randint(1, 9)) for p in (rng.choice(shared), str(rng.random()))) for _ in range(60)]
    rows = list(enumerate(texts + ["".join(shared) + "!" + "".join(shared[::-1])]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert result(S.remove_repeats(frame(spark, rows))) == dict(enumerate(brute([(i, t.encode()) for i, t in rows], 100)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_odd_rows(odd_docs, no_docs):
    rows = S.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, len(r.spans)))
    assert by[3] == by[4] == [(0, 0, 0)] and by[2] == [(26, 0, 0)] * 2
    assert by[6] == [(360_000, 360_000 - 18, 1)] and by[7] == [(3000, 2999, 1)]
    assert by[10] == [(len("ünïcødé 漢字 😀 <|endoftext|>".encode()), 0, 0)]
    assert S.remove_repeats(no_docs).collect() == []


def test_equal_ids_and_null_ids(spark):
    long, other = "word and " * 2 + "".join(f"{i} apples " for i in range(40)), "".join(f"{i} pears " for i in range(40))
    rows = [(None, long), (1, long), (1, other), (1, other), (1, other + "!"), (2, other)]
    got = sorted(((r.doc_id is not None, r.doc_id, r.n_bytes), r.n_removed) for r in S.remove_repeats(frame(spark, rows)).collect())
    removed = {}
    for key, n in got:
        removed.setdefault(key, []).append(n)
    assert removed[(False, None, len(long))] == [0] and removed[(True, 1, len(long))] == [len(long)]
    # Of one id's texts the one with the smaller hash comes first; its repeated row shares its result.
    a, b = removed[(True, 1, len(other))], removed[(True, 1, len(other) + 1)]
    assert len(a) == 2 and a[0] == a[1] and sorted([a[0], b[0]]) in ([0, len(other)],)
    assert removed[(True, 2, len(other))] == [len(other)]


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, [2, 3, 256, 256, 4, 1][seed] or 1, 900).astype(np.uint8) if seed != 5 else np.full(900, 7, np.uint8)
    raw = text.tobytes() + bytes(100)
    words = np.ndarray(len(raw), ">u8", raw + bytes(16), strides=(1,))
    order = S.suffix_array(np.frombuffer(raw, np.uint8), words, 100, np.ones(1000, bool))
    assert sorted(order.tolist()) == list(range(1000))
    wanted = np.append(rng.random(900) < 0.2, np.zeros(100, bool))
    some = S.suffix_array(np.frombuffer(raw, np.uint8), words, 100, wanted)
    cut = [raw[i : i + 100] for i in some.tolist() if wanted[i]]
    assert cut == sorted(cut) and len(cut) == wanted.sum() and len(set(some.tolist())) == len(some)
    cut = [raw[i : i + 100] for i in order.tolist() if i < 900]
    assert cut == sorted(cut)
    inner = order[order < 900]
    prefixes = S.common_prefixes(words, inner[:-1], inner[1:], 100)
    for a, b, n in zip(inner[:-1].tolist(), inner[1:].tolist(), prefixes.tolist()):
        assert raw[a : a + n] == raw[b : b + n] and (n == 100 or raw[a + n : a + n + 1] != raw[b + n : b + n + 1])
