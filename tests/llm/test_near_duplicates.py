import itertools
import random
import re

import numpy as np
import xxhash
from pyspark.sql import types as T

import __spark_entry__ as E
from odd_rows import SF_SMALL, no_docs, odd_docs  # noqa: F401
from panelkit.llm import lattice_dedup as L
from panelkit.llm import simhash as S
from panelkit.llm.common import connected_components


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def plain_fingerprint(text, words=3):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_the_definition():
    texts = [None, "", " \t\n", "One", "One two", "ÀB c\xa0d e\x85f\x1cg", "a b c d " * 40, "É X\x0bY\x0cZ 漢字 😀 q"]
    rnd = random.Random(1)
    texts += [" ".join(rnd.choice("abcDEF") * rnd.randint(1, 3) for _ in range(rnd.randint(1, 50))) for _ in range(100)]
    assert [S.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    long = " ".join(str(i % 977) for i in range(40_000))
    assert S.fingerprint(long) == plain_fingerprint(long)


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2, 3):
        masks = S.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1 and all(0 < m < 1 << 64 for m in masks)
        for places in itertools.combinations(range(64), radius):
            difference = sum(1 << p for p in places)
            assert any(m & difference == 0 for m in masks)


def fp_frame(spark, values):
    return spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")


def test_links_with_large_buckets_dealt_out_again(spark):
    rnd = random.Random(4)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    values = {c ^ sum(1 << p for p in rnd.sample(range(64), rnd.randint(0, 4))) for c in centres for _ in range(60)} | {0, 2**64 - 1}
    values = sorted(values)
    pairs = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3]
    expected = components(values, pairs)
    for bucket_rows in (4096, 3):
        edges = connected_components(S.linking_edges(fp_frame(spark, values), 3, bucket_rows)).collect()
        groups = {}
        for r in edges:
            groups.setdefault(r.component, set()).add(r.node % (1 << 64))
        wanted = {}
        for v, c in expected.items():
            wanted.setdefault(c, set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in wanted.values() if len(g) > 1)


def test_components_of_long_chains(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(400)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    rnd.shuffle(edges)
    frame = spark.createDataFrame([e if rnd.random() < 0.5 else e[::-1] for e in edges], "a long, b long").repartition(7)
    got = {r.node: r.component for r in connected_components(frame).collect()}
    expected = components({n for e in edges for n in e}, edges)
    assert got == {n: c for n, c in expected.items()}
    assert connected_components(frame.limit(0)).collect() == []


def test_simhash_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in docs.items()}
    expected = components(fps, [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3])
    rows = E.queries()["op5_simhash"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", expected[i]) for i in fps}


def test_simhash_odd_rows(odd_docs, no_docs):
    rows = S.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert {by_id[i].component_id for i in (1, 2)} == {1}
    assert {(by_id[i].fp, by_id[i].component_id) for i in (3, 4, 5)} == {(0, 3)}
    assert by_id[None].component_id is None
    kept = S.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in rows}
    assert S.near_duplicates(no_docs).collect() == [] and S.drop_near_duplicates(no_docs).collect() == []


def test_dropping_tells_texts_of_one_id_apart_and_reduces_rows_without_id(spark):
    near, other, alone = "one two three four five six", "seven eight nine ten eleven twelve", "a row that has no like at all"
    copy = near.upper()  # same fingerprint, another text
    rows = [(1, near), (5, copy), (5, other), (7, alone), (7, alone)]
    rows += [(None, "no id here but a long text"), (None, "No id here but a long text"), (None, "No id here but a long text"), (None, near + "")]
    kept = S.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id or 0, r.text.lower()) for r in kept)
    assert got == [(0, "no id here but a long text"), (1, near), (5, other), (7, alone), (7, alone)]


def brute_vectors(rows, threshold=0.93):
    """n_links and component of each vec_id from all pairs."""
    ok = {i: (label, np.array(v, float)) for i, v, label in rows if i is not None and label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: set() for i, *_ in rows if i is not None}
    for a, b in itertools.combinations(ok, 2):
        (la, x), (lb, y) = ok[a], ok[b]
        if la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
            links[a].add(b)
            links[b].add(a)
    parts = components(links, [(a, b) for a in links for b in links[a]])
    return {i: (len(links[i]), parts[i]) for i in links}


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("cell", T.StringType()), T.StructField("rep", T.StringType())])


def near_vectors(seed=0, groups=12, size=14, alone=150, dim=64, cos=(0.95, 0.995)):
    """Groups of unit vectors at a random cosine to their centre, vectors alone, one large group."""
    rng = np.random.default_rng(seed)

    def unit(n):
        x = rng.normal(size=(n, dim))
        return x / np.linalg.norm(x, axis=1)[:, None]

    out = list(unit(alone))
    for size in [size] * groups + [120]:
        centre = unit(1)[0]
        for v in unit(size):
            v -= v @ centre * centre
            v /= np.linalg.norm(v)
            c = rng.uniform(*cos)
            out.append((c * centre + np.sqrt(1 - c * c) * v) * rng.uniform(0.1, 10))
    return [(i, [float(np.float32(x)) for x in v], int(rng.integers(2)) if i < alone else i % 2, "c", "r") for i, v in enumerate(out)]


def test_lattice_links_against_all_pairs(spark):
    rows = near_vectors()
    expected = brute_vectors([r[:3] for r in rows])
    total = sum(n for n, _ in expected.values())
    for cell_rows in (512, 10):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in L.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), cell_rows=cell_rows).collect()}
        assert got.keys() == expected.keys()
        assert all(got[i][0] <= expected[i][0] for i in got)  # no false link, none twice
        assert sum(n for n, *_ in got.values()) >= 0.99 * total > 1000
        assert all(k == (i == c) for i, (_, c, k) in got.items())
        assert np.mean([got[i][1] == expected[i][1] for i in got]) > 0.99


def test_lattice_odd_rows(spark):
    v = [0.5, -0.25, 1.0, 0.0] * 2
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, [2 * x for x in v], 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [0.0] * 8, 1), (8, [None, *v[1:]], 1)]
    rows += [(9, [float("nan"), *v[1:]], 1), (10, [float("inf"), *v[1:]], 1), (11, [], 1), (12, v[:7], 1), (None, v, 1), (13, [-x for x in v], 1), (14, [1e-30 * x for x in v], 1)]
    frame = spark.createDataFrame([(*r, "c", "r") for r in rows], SCHEMA)
    got = [tuple(r) for r in L.near_duplicate_vectors(frame).collect()]
    assert len(got) == len(rows)
    expected = {1: (3, 1), 2: (3, 1), 3: (3, 1), 14: (3, 1)} | {i: (0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None)}
    assert {i: (n, c) for i, n, c, _ in got} == expected
    assert {i for i, _, _, k in got if k} == {1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13}
    assert L.near_duplicate_vectors(frame.limit(0)).collect() == []


def test_decoding_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8))
    found = L.nearest_e8(x, 4) / 2
    whole = np.array(list(itertools.product((-1, 0, 1), repeat=8)), float)
    for row, points in zip(x, found):
        base = np.concatenate([np.rint(row) + whole, np.rint(row - 0.5) + whole + 0.5])
        valid = base[(np.rint(base - (base[:, :1] % 1)).sum(axis=1) % 2) == 0]
        assert np.isclose(((points[0] - row) ** 2).sum(), ((valid - row) ** 2).sum(axis=1).min())
        d = ((points - row) ** 2).sum(axis=1)
        assert (np.diff(d) >= -1e-12).all() and len(np.unique(points, axis=0)) == 4


def test_lattice_query_reads_every_row(spark):
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    rows = E.queries()["op3_lattice_dedup"](spark, SF_SMALL).collect()
    plain = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert len(rows) == n and {r.vec_id: (r.n_links, r.component_id) for r in rows} == brute_vectors(plain)
