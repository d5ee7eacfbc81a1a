"""Behaviour beside the queries: streams, doubled keys, single mode, old totals, no settings."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tablewright.functions.casts import tolerant_cast
from tablewright.operators import rowset
from tablewright.operators.cells import update_cells
from tablewright.operators.facets import facet_values
from tablewright.operators.ordering import by, with_positions
from tablewright.operators.rules import Field, RecordRules
from tablewright.operators.validate import Checker
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import GridSpec, SpecError
from tablewright.streaming.guard import NeedsWholeTable

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load().withColumnRenamed("value", "id")
    grid = Grid(stream, GridSpec(columns=("id",), row_id="id"))
    for ask in (
        lambda: facet_values(grid),
        grid.page_info,
        grid.page,
        grid.with_positions,
        lambda: with_positions(stream, by("id")),
    ):
        with pytest.raises(NeedsWholeTable):
            ask()


def test_doubled_update_keys(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (2, None)], "id int, m map<string,int>")
    twice = spark.createDataFrame([(1, {"b": 2}, 1), (1, {"c": 3}, 2)], "id int, m map<string,int>, at int")
    with pytest.raises(Exception, match="more than one update of key 1"):
        update_cells(df, "id", "m", twice).collect()
    newest = update_cells(df, "id", "m", twice, latest_by="at").orderBy("id").collect()
    assert [r["m"] for r in newest] == [{"c": 3}, None]


def test_single_mode_looks_at_frames(spark):
    df = spark.range(9).select((F.col("id") * 2).alias("v"), "id")
    grid = Grid(df, GridSpec(columns=("v", "id"), row_id="id", selectable_rows="single"))
    one = spark.range(3, 4)
    assert [tuple(r) for r in rowset.selected_rows(grid, one).collect()] == [(6, 3)]
    assert rowset.selected_rows(grid, spark.range(0)).collect() == []
    with pytest.raises(Exception, match="only one row"):
        rowset.selected_rows(grid, spark.range(5)).collect()
    with pytest.raises(SpecError):
        rowset.select_range(grid, 1, 2)


@pytest.mark.parametrize("n", [3, 1000, 1001, 3000])
def test_listed_keys_keep_columns_and_types(spark, n):
    df = spark.range(5000).select(F.lit("x").alias("a.b"), F.col("id").cast("int").alias("id"))
    keys = list(range(n))
    assert rowset.select_rows(df, "id", keys).schema == df.schema
    assert rowset.select_rows(df, "id", keys).count() == n
    assert rowset.delete_rows(df, "id", keys).schema == df.schema
    assert rowset.delete_rows(df, "id", keys).count() == 5000 - n


def test_totals_do_not_outlive_a_filter():
    spec = GridSpec(columns=("a",), row_id="a", total=99)
    assert spec.with_filter("a", 1).total is None and spec.with_search("x").total is None
    assert spec.reset_filters().total is None and GridSpec.from_json(spec.to_json()).total is None
    assert spec.sort_by("a").total == 99


@pytest.mark.parametrize(
    "value, source, target, fits",
    [
        (1.9, "double", "int", False), (2.0, "double", "int", True), (1.5, "double", "boolean", False),
        ("12.345", "string", "decimal(10,2)", False), ("12.340", "string", "decimal(10,2)", True),
        (12.5, "double", "decimal(10,2)", True), (300, "int", "tinyint", False), ("7", "string", "int", True),
        (float("nan"), "double", "int", False), (0.1, "double", "float", True),
    ],
)
def test_casts_that_change_a_value_do_not_fit(spark, value, source, target, fits):
    df = spark.createDataFrame([(value,)], f"v {source}")
    got = df.select(tolerant_cast(F.col("v"), df.schema["v"].dataType, target)).first()[0]
    assert (got is not None) == fits


def test_findings_grow_with_the_conditions(spark):
    df = spark.createDataFrame([("x", 1)], "t string, n int")
    sizes = []
    for k in range(1, 9):
        rule = Field("t")
        for i in range(k):
            rule = rule.when("n", i, lambda f, i=i: f.test(f"t{i}", "m", lambda s: s.value == "x"))
        sizes.append(len(Checker(df, RecordRules((rule,))).all_findings()))
    assert sizes == list(range(1, 9))


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_merged_conditions_mean_what_branches_mean(spark, n):
    rule = (
        Field("t").max(9)
        .when("n", 1, lambda f: f.required().max(2), lambda f: f.min(1))
        .when("n", 2, lambda f: f.not_required().one_of(["ab", "abc"]))
        .when("n", 3, lambda f: f.max(1), lambda f: f.test("low", "m", lambda s: s.value == F.lower(s.value)))
    )
    rows = [(t, n) for t in (None, "", "a", "ab", "abc", "ABC", "x" * 12)]
    df = spark.createDataFrame(rows, "t string, n int")
    assert rule.merged() is not None

    def listed(checker):
        return [
            [(v["rule"], v["message"]) for v in r[0]]
            for r in checker.prepared.select(checker.violations()).collect()
        ]

    merged = listed(Checker(df, RecordRules((rule,))))
    whole = Field.merged
    try:
        Field.merged = lambda self: None
        assert listed(Checker(df, RecordRules((rule,)))) == merged
    finally:
        Field.merged = whole


def test_positions_need_no_settings(tables):
    """In a session that names no shared folder; nothing is written while the plan is built."""
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
import __spark_entry__
from tablewright.queries import QUERIES
from tablewright.session import local_session
spark = local_session(2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
for name in ("sort_string", "sort_multi", "sort_custom", "facet_names", "facet_first_seen", "csv_header",
             "select_range", "page_deep"):
    assert QUERIES[name](spark, {tables!r}).count() > 0, name
print("fine")
"""
    folder = os.path.join(ROOT, "tests", "no_settings")
    env = os.environ | {"SPARK_CONF_DIR": folder}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_the_choice_of_all_clears_a_dropdown():
    spec = GridSpec(columns=("a", "b"), row_id="a").with_filters({"a": 1, "b": ["x", "y"]})
    assert dict(spec.with_filter("a", "All").filters) == {"b": ("x", "y")}
    kept = GridSpec(columns=("a",), row_id="a", all_label=None).with_filter("a", "All")
    assert dict(kept.filters) == {"a": ("All",)}
