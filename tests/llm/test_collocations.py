import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as E
from odd_rows import SF_SMALL, no_docs, odd_docs  # noqa: F401
from panelkit.llm import collocations as C
from panelkit.registry.compare import compare, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, max_words, percent, top):
    """The contract in plain Python over (text, lang) rows."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, max_words + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) >= 2 and a >= min_count}
        best = Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    best[p[i : i + k]] = max(best[p[i : i + k]], a)
        rows = []
        for p, a in cands.items():
            if best[p] and 100 * best[p] >= percent * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def test_registered_query_matches_sql_and_brute_force(spark):
    df = E.queries()["op11_collocations"](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF_SMALL).execute(E.oracle_sql()["op11_collocations"])
    assert not compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang").collect()
    assert set(rows) == brute(docs, 10, 3, 50, 2000) and len(rows) == len(set(rows))


@pytest.mark.parametrize("max_words, top", [(2, 5), (3, 7), (4, 1000)])
def test_generated_texts(spark, max_words, top):
    rng = random.Random(max_words)
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", " ", " \U0001f600 "]
    rows = [("".join(rng.choice("aAbcÉé") * rng.randint(1, 2) + rng.choice(marks) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und"])) for _ in range(120)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    got = [tuple(r) for r in C.collocations(docs, 3, max_words, 50, top).collect()]
    assert set(got) == brute(rows, 3, max_words, 50, top) and len(got) == len(set(got))


@pytest.mark.parametrize("name, value", [("SLICE", 200), ("BLOCK_WINDOWS", 10), ("TASK_WINDOWS", 50), ("HOT_SHARE", 4)])
def test_small_blocks_and_hot_words(spark, monkeypatch, name, value):
    """Half the words are one word: blocks, tasks and salts cut its windows in every way."""
    monkeypatch.setattr(C, name, value)
    rng = random.Random(5)
    rows = [(" ".join(rng.choice(["the", rng.choice("abcdefg"), "."]) for _ in range(rng.randint(1, 90))), rng.choice(["en", "fr"])) for _ in range(80)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = [tuple(r) for r in C.collocations(docs, 4).collect()]
    assert set(got) == brute(rows, 4, 3, 50, 2000) and len(got) == len(set(got))


def test_unique_rows_of_wide_columns():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 2**40, 50)[rng.integers(0, 50, 400)] for _ in range(3)]
    got, n = C.unique_rows(columns, np.ones(400, np.int64))
    want = Counter(zip(*[c.tolist() for c in columns]))
    assert dict(zip(zip(*[c.tolist() for c in got]), n.tolist())) == want and list(zip(*[c.tolist() for c in got])) == sorted(want)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    got = [tuple(r) for r in C.collocations(odd_docs, 2).collect()]
    assert set(got) == brute(rows, 2, 3, 50, 2000)
    assert any(r[0] == "la" and r[3] > 10_000 for r in got)  # the long text counts whole
    assert C.collocations(no_docs).collect() == []


def test_exact_scores_beyond_64_bits(spark):
    """Counts of 10**13: the products need more than 64 bits, and one occurrence decides the floor."""
    big = 10**13
    counts = spark.createDataFrame([("en", ["a", "b"], big - 1), ("en", ["a"], big), ("en", ["b"], big + 3)], "lang string, words array<string>, a long")
    row = C._scored(counts.where("size(words) = 2"), counts.where("size(words) = 1")).first()
    assert row.score == 1_000_000 * (big - 1) ** 2 // (big * (big + 3))
