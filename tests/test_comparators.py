"""Comparators that are code, JSON of any shape, row numbers."""

from __future__ import annotations

import random
from functools import cmp_to_key

import pytest
from pyspark.sql import functions as F

from tablewright.operators import comparators
from tablewright.operators.comparators import comparator_ranks, with_comparator_rank
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec, SortKey
from tablewright.sources.tables import numbered_table
from tablewright.sources.variants import merged_schema, parsed, variant_cell, variant_columns, variant_path


def by_length(a: str, b: str) -> int:
    return len(a) - len(b)


def all_equal(a: str, b: str) -> int:
    return 0


def downward(a: str, b: str) -> int:
    return (a < b) - (a > b)


@pytest.mark.parametrize("compare", [by_length, all_equal, downward])
@pytest.mark.parametrize("range_values", [10, 50_000])
def test_ranks(spark, compare, range_values):
    random.seed(4)
    words = sorted({"".join(random.choice("abc") for _ in range(random.randrange(1, 7))) for _ in range(300)})
    rows = [(w,) for w in words] + [(None,), ("a",), ("a",)]
    got = {r.value: r["rank"] for r in comparator_ranks(spark.createDataFrame(rows, "w string"), "w", compare, range_values).collect()}
    wanted, before = {}, None
    for w in sorted(words, key=cmp_to_key(compare)):
        wanted[w] = 0 if before is None else wanted[before] + (compare(before, w) != 0)
        before = w
    assert got == wanted


def test_ranges_stay_small_where_all_are_equal(spark):
    frame = spark.range(2000).select(F.col("id").cast("string").alias("w"))
    ranks = comparator_ranks(frame, "w", all_equal, 100)
    assert {r["rank"] for r in ranks.collect()} == {0}


def test_a_stable_sort_by_comparator(spark, monkeypatch):
    monkeypatch.setattr(comparators, "RANGE_VALUES", 7)
    random.seed(8)
    rows = [(i, random.choice(["b", "aa", "ccc", None, "d", "ee"]), i % 3) for i in range(200)]
    frame = with_comparator_rank(spark.createDataFrame(rows, "id long, w string, n long"), "w", by_length, "rank")
    assert frame.columns == ["id", "w", "n", "rank"] and frame.count() == 200
    spec = GridSpec(columns=("id", ColumnSpec("w", sort_key="rank"), "n", ColumnSpec("rank", display="false")), row_id="id", pagination=False, sorts=(SortKey("w"), SortKey("n", "desc")))
    got = [r.id for r in Grid(frame, spec).page().collect()]
    wanted = sorted(rows, key=lambda r: (-r[2], r[0]))
    wanted.sort(key=lambda r: (r[1] is not None, len(r[1] or "")))
    assert got == [r[0] for r in wanted]
    assert with_comparator_rank(spark.createDataFrame([], "id long, w string"), "w", by_length, "rank").collect() == []


def test_numbers_and_dates_can_be_compared(spark):
    frame = spark.createDataFrame([(3.5,), (-1.0,), (2.0,)], "x double")
    ranks = comparator_ranks(frame, "x", lambda a, b: (abs(a) > abs(b)) - (abs(a) < abs(b)))
    assert {r.value: r["rank"] for r in ranks.collect()} == {-1.0: 0, 2.0: 1, 3.5: 2}


TEXTS = ['{"a": {"b": [1, {"c": "x"}]}, "d.e": 2.5}', '{"a": 7}', "[1, 2]", "no json", None, '{"a": null}', '"plain"', '{"a": {"b": []}}', ""]


def test_paths_into_json_of_any_shape(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    paths = {"b1c": "a/b/1/c", "a": "a", "de": "d.e", "second": "1"}
    got = {r.id: r for r in variant_columns(frame, "text", paths, separator="/", unparsed="left").collect()}
    assert got[0].b1c == "x" and got[0].de == "2.5" and got[0].a == '{"b":[1,{"c":"x"}]}'
    assert got[1].a == "7" and got[2].second == "2" and got[5].a is None and got[7].b1c is None
    assert [got[i].left for i in range(9)] == [None, None, None, "no json", None, None, None, None, ""]
    assert variant_path("a'b.0.c d") == "$['a\\'b'][0]['c d']"


def test_the_text_is_parsed_once(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    plan = variant_columns(frame, "text", {"a": "a", "b": "a.b", "c": "c"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson(") == 1
    typed = parsed(frame, "text").select(variant_cell(F.col("parsed"), "a", "int").alias("n"))
    assert [r.n for r in typed.collect()] == [None, 7, None, None, None, None, None, None, None]


def test_a_schema_of_all_rows(spark):
    frame = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2.5, "c": [1]}',), ("broken",)], "text string")
    schema = merged_schema(frame, "text")
    assert "a: " in schema and "b: STRING" in schema and "c: ARRAY<BIGINT>" in schema


def test_row_numbers_do_not_change_with_the_split(spark, folder):
    path = f"{folder}/rows"
    frame = spark.range(5000).selectExpr("id", "repeat('x', 40) AS text")
    frame.repartitionByRange(3, "id").sortWithinPartitions("id").write.option("parquet.block.size", 4096).parquet(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for split in ("128m", "2k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            table = numbered_table(spark, path, "n")
            found.append(sorted((r.n, r.id) for r in table.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found[0] == found[1] == [(i, i) for i in range(5000)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert numbered_table(spark, path).where("id < 0").collect() == []
