from __future__ import annotations

import os
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline
from test_decontaminate import brute as brute_leaks
from test_mixing import brute_targets
from test_sharding import check_shards
from test_simhash import brute_components, brute_print

from tablewright.llm import site_quality

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


@pytest.fixture(scope="module")
def documents(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet")


def test_stages_are_named_and_ordered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "simhash near-dedup", "benchmark decontamination", "source mix", "k-d tree shards"
    ]


def test_quality(spark, tables, documents):
    kept = STAGES["quality classifier"](spark, documents, tables)
    model = site_quality.fit(documents, spark.read.parquet(f"{tables}/labels.parquet"))
    found = site_quality.score(documents, model, F.col("source"), F.col("lang"))
    wanted = {r.doc_id for r in found.where("keep").collect()}
    assert kept.columns == documents.columns
    assert rows_of(kept) == rows_of(documents.where(F.col("doc_id").isin(*wanted)))
    assert 0 < len(wanted) < documents.count()


def test_near_duplicates(spark, tables, documents):
    kept = STAGES["simhash near-dedup"](spark, documents, tables)
    docs = sorted(documents.select("doc_id", "text").collect())
    roots = brute_components([brute_print(d.text) for d in docs])
    wanted = [docs[r].doc_id for r in sorted(set(roots))]
    assert kept.columns == documents.columns
    assert rows_of(kept) == rows_of(documents.where(F.col("doc_id").isin(*wanted)))
    assert len(wanted) < len(docs)


def test_decontamination(spark, tables, documents):
    kept = STAGES["benchmark decontamination"](spark, documents, tables)
    items = spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()
    docs = [tuple(d) for d in documents.select("doc_id", "text").collect()]
    leaked = {r[0] for r in brute_leaks(docs, [tuple(i) for i in items])}
    assert kept.columns == documents.columns and leaked
    assert rows_of(kept) == rows_of(documents.where(~F.col("doc_id").isin(*leaked)))


def test_mix(spark, tables, documents):
    mixed = STAGES["source mix"](spark, documents, tables)
    assert mixed.columns == documents.columns
    before, after = rows_of(documents), rows_of(mixed)
    assert all(after[row] <= 2 * before[row] for row in after)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for row, times in before.items():
        source, words = row[3], len(row[1].split())
        sizes[source] += times * words
        taken[source] += after[row] * words
        largest[source] = max(largest[source], words)
    for source, target in brute_targets(sizes).items():
        # Documents are taken whole, so a source is off by the one at each end of its run.
        assert abs(taken[source] - target) <= 2 * largest[source] + 0.02 * target


def test_run_ends_in_shards(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
    path = docs.collect()
    assert 0 < len(path)
    check_shards(corpus_pipeline.run(spark, tables).collect(), path)


def test_edges(spark, tables):
    rows = [
        (1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (None, "a b c d e f", "en", "s", 11),
        (2, None, None, None, None), (None, "nameless text of its own", "en", "t", 1), (None, "nameless text of its own", "en", "t", 1),
        (3, "", "en", "s", 0), (4, "x y z " * 100_000, "de", "u", 5),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, kind).withColumns({"fp": F.lit("clash"), "size": F.lit(1), "_rows": F.lit("x")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        got = out.collect()
        if name != "k-d tree shards":
            assert out.columns == docs.columns
        if name == "simhash near-dedup":
            ids = sorted((r.doc_id or 0, r.text or "") for r in got)
            assert [i for i, _ in ids] == [0, 1, 2, 4]  # blank texts are one group, the nameless pair another
        assert stage(spark, docs.where("false"), tables).collect() == []


def test_decontamination_judges_rows(spark, tables):
    item = spark.read.parquet(f"{tables}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first().text
    rows = [(None, f"before {item} after", "en", "s", 1), (None, "clean without a name", "en", "s", 2),
            (7, f"{item} again", "en", "s", 3), (7, "clean under the same id", "en", "s", 4), (8, None, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = STAGES["benchmark decontamination"](spark, docs.withColumn("key", F.lit("clash")), tables)
    assert sorted(r.n_chars for r in kept.collect()) == [2, 4, 5]


def test_near_duplicates_keep_one_row_of_each_component(spark, tables):
    a, b, c = ("one two three four five six", "red green blue white black grey", "north east south west up down")
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (5, c), (5, "a text of its own under five"), (5, None), (None, c), (None, "nameless and alone here")]
    docs = spark.createDataFrame([(*r, "en", "s", i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = STAGES["simhash near-dedup"](spark, docs, tables)
    assert len({brute_print(t) for _, t in rows}) == 6
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter([(1, a), (1, b), (3, c), (5, rows[6][1]), (5, None), (None, rows[9][1])])
