from __future__ import annotations

import re
from collections import defaultdict

import duckdb
import oracle
from pyspark.sql import functions as F

from tablewright.llm import mixing, queries


def brute_targets(sizes):
    """Reshare until none is above its cap."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = want / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            want -= target[s]
        free -= over
    return target


def brute_seats(votes, seats):
    """Highest quotients, one seat at a time."""
    got = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(votes, key=lambda p: (votes[p] / (2 * got[p] + 1), -p))
        got[best] += 1
    return got


def check_mix(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    for doc_id, text, source in docs:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(rows) == len(docs)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 30), (s, taken[s], target[s])


def test_query(spark, tables):
    got = queries.op5_source_mix(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text", "source").collect()
    rows = got.collect()
    check_mix(rows, docs)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op5_source_mix(spark, tables).collect()))


def test_query_equals_its_sql_where_blocks_do_not_fit(spark, folder):
    """Sources of five short documents, of one, and of none with words, beside large ones."""
    docs = [(i, "a b c d e f g h i j " * 40, f"s{i % 3}") for i in range(2000)]
    docs += [(5000 + i, "x y z " * 9, "five") for i in range(5)] + [(6000, "one", "one"), (6001, "", "none"), (6002, "p q", None)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = queries.op5_source_mix(spark, folder)
    assert oracle.difference(got, db, queries.ORACLES["op5_source_mix"]) is None
    check_mix(got.collect(), docs)


def test_seats_by_highest_quotients(spark):
    cases = [({0: 53, 1: 24, 2: 23}, 7), ({i: (i * 37) % 101 + 1 for i in range(30)}, 50), ({0: 10**6, **{i: 1 for i in range(1, 9)}}, 5), ({0: 0, 1: 5}, 4)]
    rows = [(g, p, v, n) for g, (votes, n) in enumerate(cases) for p, v in votes.items()]
    frame = spark.createDataFrame(rows, "g int, p int, v long, n long")
    got = defaultdict(dict)
    for r in mixing.apportion(frame, ["g"], ["p"], "v", "n").collect():
        got[r.g][r.p] = r.quota
    for g, (votes, n) in enumerate(cases):
        assert got[g] == brute_seats(votes, n)


def test_edges(spark):
    text = "a b c d e f g h i j " * 20
    docs = [(i, text, f"s{i % 4}") for i in range(400)] + [(1000 + i, text, None) for i in range(40)]
    docs += [(None, "x y", "s0"), (5000, None, "s1"), (5001, "", "empty"), (7, text, "s3"), (8, " \t", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("size", F.lit("x"))
    check_mix(mixing.mix(frame).collect(), docs)
    assert mixing.mix(frame.where("false")).collect() == []
    nothing = mixing.mix(frame.where("doc_id = 5001")).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in nothing] == [(0, 0, 0.0, 0)]


def test_copies_follow_taken(spark):
    docs = [(i, "a b c d e f g h i j " * (1 + i % 5), f"s{i % 4}") for i in range(4000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(frame).collect()
    taken, copied = defaultdict(int), defaultdict(int)
    for r in rows:
        taken[r.source] += r.taken
        copied[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 2
    assert all(abs(taken[s] - copied[s]) < 0.02 * taken[s] + 60 for s in taken)


def test_small_sources_beside_a_hot_one(spark):
    hot = spark.range(40_000).selectExpr("id AS doc_id", "'hot' AS source", "2000L AS size")
    tiny = spark.range(100).selectExpr("id + 50000 AS doc_id", "'tiny' AS source", "400L AS size")
    short = spark.range(3000).selectExpr("id + 60000 AS doc_id", "'short' AS source", "10L + id % 7 AS size")
    seatless = spark.range(2).selectExpr("id + 70000 AS doc_id", "CAST(NULL AS STRING) AS source", "50L AS size")
    rows = mixing.mix_sized(hot.unionAll(tiny).unionAll(short).unionAll(seatless)).collect()
    assert len(rows) == 43_102
    sizes, taken, copied = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        copied[r.source] += r.copies * r.size
    target = brute_targets(sizes)
    for s in ("tiny", "short", None):
        assert abs(taken[s] - target[s]) <= 0.5, (s, taken[s], target[s])
        assert abs(copied[s] - target[s]) <= 400
    assert abs(taken["hot"] - target["hot"]) <= 0.01 * target["hot"]


def test_runs_across_shards_hit_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_MISSED_PERCENT", -1)  # every source is one ring
    sized = spark.range(6000).selectExpr("id AS doc_id", "concat('s', id % 7) AS source", "100L + id % 50 AS size")
    rows = mixing.mix_sized(sized).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    target = brute_targets(sizes)
    assert sum(sizes.values()) > 2 * mixing.SHARD_TOKENS
    assert any(t < 1.9 * sizes[s] for s, t in target.items())
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
