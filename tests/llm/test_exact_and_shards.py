import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from odd_rows import SF_SMALL, no_docs, odd_docs  # noqa: F401
from panelkit.llm import exact_dedup as X
from panelkit.llm.sharding import interleaved_shards
from panelkit.registry.compare import compare, duck


def test_exact_dedup_matches_sql(spark):
    df = E.queries()["op10_exact_dedup"](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(E.oracle_sql()["op10_exact_dedup"])
    assert not compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cur.description], cur.fetchall())


def test_exact_dedup_odd_rows(odd_docs, no_docs):
    rows = X.exact_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    same = [r for r in rows if r.group_size == 3]
    assert [r.doc_id for r in same if r.kept] == [2] and {r.keep_id for r in same} == {2}
    empty = {r.doc_id: r.kept for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()}
    assert empty == {3: False, 4: True}  # null counts as empty
    assert [(r.group_size, r.kept) for r in rows if r.doc_id is None] == [(1, True)]
    assert X.exact_duplicates(no_docs).collect() == []


def test_drop_keeps_whole_rows(odd_docs, no_docs):
    kept = X.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i in (2, 4, 5, 6, 7, 8, 9, 10, None))
    original = {tuple(r) for r in odd_docs.collect()}
    assert all(tuple(r) in original for r in rows)
    assert X.drop_exact_duplicates(no_docs).collect() == []


def test_equal_fingerprints_are_told_apart_by_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 7}", "x", "y", 6) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    monkeypatch.setattr(X.F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    rows = X.exact_duplicates(docs).collect()
    assert sorted(r.doc_id for r in rows if r.kept) == list(range(43, 50))
    assert {r.doc_id: r.group_size for r in rows} == {i: 8 if i % 7 == 0 else 7 for i in range(50)}


def test_filters_merge_without_loss():
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 50, n).astype(np.uint64) for n in (0, 1, 100, 400)]
    merged = X.CountingQuotientFilter.merge([X.CountingQuotientFilter.unpack(*X.CountingQuotientFilter.of(p).pack()) for p in parts])
    assert dict(zip(merged.remainders.tolist(), merged.counts.tolist())) == dict(Counter(np.concatenate(parts).tolist()))
    assert (np.diff(merged.remainders.astype(np.int64)) > 0).all()


def test_repeated_fingerprints_over_blocks(spark):
    values = [(-(2**63) + i % 40) for i in range(60)] + [2**63 - 1 - i % 3 for i in range(6)] + list(range(100))
    fps = spark.createDataFrame([(v,) for v in values], "fp long").repartition(5)
    expected = {k: n for k, n in Counter(values).items() if n > 1}
    for bits in (0, 1, 5):
        assert {r.fp: r.n for r in X.repeated_fingerprints(fps, bits).collect()} == expected


def check_shards(docs, rows, shards, order):
    """Brute force: rank the shuffled rows of each source, sort by fractional rank, cut evenly."""
    total = len(docs)
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == total and max(counts.values()) - min(counts[s] for s in range(shards) if total >= shards) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    per_source = defaultdict(list)
    for d in docs:
        per_source[d["source"]].append(d)
    placed = []
    for source, own in per_source.items():
        for k, d in enumerate(sorted(own, key=order)):
            placed.append(((2 * k + 1) / (2 * len(own)), order(d)[0], d))
    placed.sort(key=lambda p: p[:2])
    expected = [(d["doc_id"], p * shards // total) for p, (_, _, d) in enumerate(placed)]
    assert sorted(expected, key=str) == sorted(((r["doc_id"], r["shard"]) for r in rows), key=str)


def draw(d, seed=9):
    name, raw = "" if d["doc_id"] is None else str(d["doc_id"]), (d["text"] or "").encode()
    return (hashlib.md5(f"{seed}:{name}:{len(raw) + 16}:{zlib.crc32(raw)}".encode()).hexdigest(), d["doc_id"] or 0)


def test_shards_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plain = [r.asDict() for r in docs.collect()]
    for bucket_rows in (7, 10_000):
        rows = [r.asDict() for r in interleaved_shards(docs, 40, bucket_rows=bucket_rows).collect()]
        check_shards(plain, rows, 40, draw)
    sizes = {d["doc_id"]: (len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode())) for d in plain}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == sizes


def test_every_shard_matches_the_mixture(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 20) END AS source")
    share = {r.source: r["count"] / 4000 for r in docs.groupBy("source").count().collect()}
    got = interleaved_shards(docs, 10, bucket_rows=100).groupBy("shard", "source").count().collect()
    assert all(abs(r["count"] - 400 * share[r.source]) <= 2 for r in got)


def test_one_id_on_a_third_of_the_rows_fills_no_bucket(spark):
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "concat('t', id) AS text", "'s' AS source")
    sized = interleaved_shards(docs, 4, bucket_rows=100).withColumn("bucket", F.expr("source_rank div 100"))
    hot = sized.where("doc_id = 7").groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert sized.count() == 6000 and hot < 60  # a third of 100, give or take


def test_shards_odd_rows(odd_docs, no_docs):
    rows = [r.asDict() for r in interleaved_shards(odd_docs, 3, bucket_rows=2).collect()]
    check_shards([r.asDict() for r in odd_docs.collect()], rows, 3, draw)
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {16}
    assert interleaved_shards(no_docs, 3).collect() == []
