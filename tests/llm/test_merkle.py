from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import oracle
import pytest
from pyspark.sql import functions as F

from tablewright.llm import merkle, queries

NAMES = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc, more=0):
    doc_id, source, lang, n_chars, text = doc
    n_chars = None if n_chars is None else n_chars + more

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return sha("".join(map(field, (doc_id, source, lang, n_chars, text))))


def tree(leaves):
    """The root and each leaf's siblings with their sides, level by level."""
    ways, level, members = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, joined = [], []
        for i in range(0, len(level), 2):
            run = level[i : i + 2]
            above.append(sha("".join(run)))
            joined.append([m for part in members[i : i + 2] for m in part])
            for k in range(len(run)):
                for m in members[i + k]:
                    ways[m].append([(j < k, run[j]) for j in range(len(run)) if j != k])
        level, members = above, joined
    return level[0], ways


def brute(docs):
    by_lang = defaultdict(list)
    for doc in docs:
        by_lang[doc[2]].append(doc)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subroots, inner = [], {}
    for lang in langs:
        by_lang[lang].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(d)))
        subroot, ways = tree([leaf_of(d) for d in by_lang[lang]])
        subroots.append(subroot)
        inner[lang] = ways
    if not langs:
        return []
    root, outer = tree(subroots)
    rows = []
    for lang, subroot, over in zip(langs, subroots, outer):
        for doc, way in zip(by_lang[lang], inner[lang]):
            steps = way + over
            bad = doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 7 == 0
            node = leaf_of(doc, bad)
            for run in steps:
                node = sha("".join(s for left, s in run if left) + node + "".join(s for left, s in run if not left))
            proof = sha("".join(s for run in steps for _, s in run))
            rows.append((doc[0], leaf_of(doc), subroot, root, proof, node, node == root))
    return rows


def documents(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_query(spark, tables):
    got = queries.op11_merkle_manifest(spark, tables)
    assert got.columns == NAMES
    rows = [tuple(r) for r in got.collect()]
    assert Counter(rows) == Counter(brute(documents(spark, tables)))
    assert {r[-1] for r in rows} == {True, False}


def test_query_equals_its_sql(spark, tables):
    sql = queries.ORACLES["op11_merkle_manifest"]
    assert oracle.difference(queries.op11_merkle_manifest(spark, tables), oracle.connect(tables), sql) is None


def run(spark, folder, docs):
    frame = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    for name in ("tree", "level", "pos", "id", "carried", "group", "digest", "place"):
        frame = frame.withColumn(name, F.lit("clash"))
    frame.write.parquet(f"{folder}/documents.parquet")
    return Counter(map(tuple, queries.op11_merkle_manifest(spark, folder).collect()))


def test_edges(spark, folder):
    docs = [(i, f"s{i % 3}", "en", 10 * i, f"text {i}") for i in range(131)]
    docs += [(i, None, None, None, None) for i in range(200, 205)]
    docs += [(None, "s", "de", 1, "no id"), (None, "s", "de", 2, "no id"), (7, "s", "de", 3, ""), (7, "t", "de", 3, "é𝒳")]
    docs += [(1, "alone", "fr", 2**63 - 1, "x"), (2, "s", "", 5, "empty language"), (3, "s", "日本", 5, "long " * 100_000)]
    docs += [(4, "s", "a\x00b", 5, "-"), (4, "s", "Z", 5, "1:x"), (4, "s", "z", 5, None)]
    docs += [(50, "same", "es", 5, "repeated row")] * 9
    assert run(spark, folder, docs) == Counter(brute(docs))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 65, 129])
def test_one_group_of_any_size(spark, folder, n):
    docs = [(i * 3, "s", "en", i, f"t{i}") for i in range(n)]
    assert run(spark, folder, docs) == Counter(brute(docs))


def test_a_group_for_every_row(spark, folder):
    docs = [(i, "s", f"lang{i}", i, f"t{i}") for i in range(77)]
    assert run(spark, folder, docs) == Counter(brute(docs))


def test_same_proofs_where_no_side_is_small(spark, folder, monkeypatch):
    monkeypatch.setattr(merkle, "SMALL_BYTES", 0)
    docs = [(i, "s", ("en", "de", None)[i % 7 % 3], i, f"t{i}") for i in range(300)]
    assert run(spark, folder, docs) == Counter(brute(docs))


def test_a_hot_id_spreads_over_ranges(spark):
    rows = spark.range(9000).select(F.lit(1).alias("id"), F.col("id").alias("row"))
    places = merkle.numbered(rows, "id", "row")
    assert sorted(r.place for r in places.collect()) == list(range(9000))
    assert all(r.place == r.row for r in places.collect())


def test_any_change_is_found(spark):
    docs = spark.range(500).select("id", F.lit("g").alias("g"), F.concat(F.lit("t"), "id").alias("t"))
    leaf = merkle.leaf_digest(F.col("id"), F.col("t"))
    manifest = merkle.build(docs, F.col("id"), F.col("g"), leaf)
    assert all(r.verified for r in merkle.verified(manifest, F.col("leaf")).collect())
    wrong = merkle.verified(manifest, F.unhex(F.sha2(F.col("leaf"), 256))).collect()
    assert len(wrong) == 500 and not any(r.verified for r in wrong)
    assert merkle.build(docs.where("id < 499"), F.col("id"), F.col("g"), leaf).root != manifest.root
