"""What the plans look like, and that they hold up on a large table."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from tablewright.operators.facets import facet_values
from tablewright.operators.rowset import select_rows
from tablewright.operators.validate import report, valid_rows
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec
from tablewright.queries import QUERIES
from tablewright.queries.quality import customer_rules

#: Small by design: a summary or a report is one row per table or rule.
ONE_ROW_RESULTS = {
    "summary_row", "page_info", "dq_report", "dq_describe", "select_count", "select_single_frame"
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, tables, name):
    return spark.read.parquet(f"{tables}/{name}.parquet")


def test_filters_and_columns_reach_the_scan(spark, tables):
    spec = GridSpec(
        columns=("o_orderkey", "o_orderstatus", "o_totalprice"),
        filters={"o_orderstatus": ("F",), "o_totalprice": (1.0, 2.0)},
    )
    text = plan(Grid(table(spark, tables, "orders"), spec).rows())
    assert "EqualTo(o_orderstatus,F)" in text and "In(o_totalprice" in text
    assert "o_orderpriority" not in text and "o_custkey" not in text


def test_case_sensitive_text_reaches_the_scan(spark, tables):
    spec = GridSpec(
        columns=("p_name",), filter_kind="textField", case_sensitive=True, filters={"p_name": ("x",)}
    )
    assert "StringContains(p_name,x)" in plan(Grid(table(spark, tables, "part"), spec).rows())


def test_an_often_listed_key_is_thinned_out_before_the_join(spark, tables):
    orders = table(spark, tables, "orders").withColumnRenamed("o_custkey", "c_custkey")
    text = plan(select_rows(table(spark, tables, "customer"), "c_custkey", orders))
    assert text.count("HashAggregate(keys=[c_custkey") == 2


def test_early_pages_are_a_top_k(spark, tables):
    spec = GridSpec(columns=("o_orderkey", "o_totalprice"), row_id="o_orderkey")
    for page in (0, 3):
        text = plan(Grid(table(spark, tables, "orders"), spec.sort_by("o_totalprice").go_to(page)).page())
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_facets_share_one_scan(spark, tables):
    columns = (ColumnSpec("o_orderkey", filterable=False), "o_orderstatus", "o_orderpriority")
    text = plan(facet_values(Grid(table(spark, tables, "orders"), GridSpec(columns, "o_orderkey"))))
    assert text.count("FileScan") == 1 and "partial_min" in text


def test_listed_keys_reach_the_scan(spark, tables):
    text = plan(select_rows(table(spark, tables, "customer"), "c_custkey", [1, 2, 3]))
    assert "In(c_custkey, [1,2,3])" in text


def test_checking_rows_moves_none(spark, tables):
    rules = customer_rules()
    customer = table(spark, tables, "customer")
    assert "Exchange" not in plan(valid_rows(customer, rules))
    assert plan(report(customer, rules)).count("Exchange") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_pairs_all_rows_or_runs_python_rows(name, spark, tables):
    text = plan(QUERIES[name](spark, tables))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text
    if name not in ONE_ROW_RESULTS and "TakeOrderedAndProject" not in text:
        assert "SinglePartition" not in text


def test_a_hot_value_does_not_grow_the_facet_shuffle(spark):
    df = spark.range(100_000).withColumn("v", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold"))
    spec = GridSpec(columns=(ColumnSpec("id", filterable=False), "v"), row_id="id")
    rows = {r["value"]: r["first_seen"] for r in facet_values(Grid(df, spec)).collect()}
    assert rows == {"hot": 0, "cold": 1}
