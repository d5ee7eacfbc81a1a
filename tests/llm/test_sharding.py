from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tablewright.llm import queries, sharding


def check_shards(rows, docs):
    assert len(rows) == len(docs)
    want = sorted(
        (d.doc_id is None, d.doc_id or 0, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode()))
        for d in docs
    )
    assert want == sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 16 and r.law == "bytes" and r.grown_shard is None
    for of_shard in slots.values():
        assert sorted(of_shard) == list(range(len(of_shard)))


def brute_split(points, names, depth):
    """points: dicts; the same tree by sorting whole cells."""
    cells = {0: points}
    for _ in range(depth):
        halves = {}
        for cell, rows in cells.items():
            if not rows:
                continue
            wide = max(names, key=lambda n: (max(r[n] for r in rows) - min(r[n] for r in rows), -names.index(n)))
            keyed = defaultdict(int)
            for r in rows:
                keyed[(r[wide], r["tie"])] += r["size"]
            total, upto, cut = sum(keyed.values()), 0, None
            for key in sorted(keyed):
                before, upto = upto, upto + keyed[key]
                if 2 * upto >= total:
                    cut = (key, True) if before == 0 or 2 * upto - total <= total - 2 * before else (key, False)
                    break
            for r in rows:
                key = (r[wide], r["tie"])
                high = key > cut[0] or (key == cut[0] and not cut[1])
                halves.setdefault(2 * cell + high, []).append(r)
        cells = halves
    return {r["doc_id"]: cell for cell, rows in cells.items() for r in rows}


def test_tree_against_sorting(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = ["source", "lang", "length"]
    raw = sharding.points(docs, sharding.text_dimensions(docs), "doc_id", "text")
    placed = sharding._placed(raw, names, 10_000.0)
    got = {r.doc_id: r.shard for r in sharding.split(placed, names, 16).collect()}
    assert got == brute_split([r.asDict() for r in placed.collect()], names, 4)


def test_query(spark, tables):
    rows = queries.op3_kd_tree_shards(spark, tables).collect()
    docs = spark.read.parquet(f"{tables}/documents.parquet").collect()
    check_shards(rows, docs)
    weight, largest = defaultdict(int), max(r.size for r in rows)
    for r in rows:
        weight[r.shard] += r.size
    mean = sum(weight.values()) / 16
    assert all(abs(w - mean) <= 2 * largest for w in weight.values())


def test_equal_texts_stay_together_and_heavy_groups_do_not(spark):
    rows = [(i, "copy " * 50, f"s{i % 5}", "en") for i in range(600)]
    rows += [(1000 + i, f"text {i // 3} " * 20, f"s{i % 7}", "de") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = sharding.shard_documents(docs, sharding.text_dimensions(docs)).collect()
    check_shards(got, docs.collect())
    of_group, weight = defaultdict(set), defaultdict(int)
    for r in got:
        weight[r.shard] += r.size
        of_group[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for c, s in of_group.items() if c != zlib.crc32(b"copy " * 50))
    mean = sum(weight.values()) / 16
    assert all(abs(w - mean) < 0.1 * mean for w in weight.values())


def test_sources_that_begin_alike_are_told_apart(spark):
    """Of 99 sources with one language and one length, each lies in one shard or in two that touch."""
    rows = [(i, f"{i:06d} " * 30, f"source_{i % 99:02d}", "en") for i in range(99 * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    raw = sharding.points(docs, sharding.text_dimensions(docs), "doc_id", "text")
    placed = sharding._placed(raw, ["source", "lang", "length"], 1e9)
    assert len({r.source for r in placed.select("source").distinct().collect()}) == 99
    got = {r.doc_id: r.shard for r in sharding.shard_documents(docs, sharding.text_dimensions(docs)).collect()}
    shards = defaultdict(set)
    for i, _, source, _ in rows:
        shards[source].add(got[i])
    assert all(max(s) - min(s) <= 1 for s in shards.values())
    firsts = [min(shards[s]) for s in sorted(shards)]
    assert firsts == sorted(firsts) and len(set(got.values())) == 16


def test_edges(spark):
    rows = [(1, None, None, None), (None, "", "s", "en"), (2, "é" * 5000, "s", None), (2, "é" * 5000, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs = docs.withColumns({"size": F.lit("x"), "crc": F.lit(1), "shard": F.lit(None).cast("int")})
    check_shards(sharding.shard_documents(docs, sharding.text_dimensions(docs)).collect(), docs.collect())
    assert sharding.shard_documents(docs.where("false"), sharding.text_dimensions(docs)).collect() == []
