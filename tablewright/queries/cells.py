"""Scans, projections and cell operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.cells import update_cells
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec
from tablewright.queries.registry import query
from tablewright.sources.ingest import REJECTS, Repair, Typed, ingest
from tablewright.sources.tables import named_table, rows_from_arrays, rows_from_json

SUPPLIER = ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=(ColumnSpec("c_custkey", label="id"), ColumnSpec("c_name", label="name")),
        row_id="c_custkey",
    )
    return Grid(named_table(spark, folder, "customer"), spec).rows()


@query(
    """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
              CAST(NULL AS VARCHAR) AS remark, CAST(NULL AS VARCHAR) AS missing
       FROM orders"""
)
def scan_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows held as arrays: cells by position, a synthetic column, a short row."""
    packed = named_table(spark, folder, "orders").select(
        "o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("cells")
    )
    columns = ["status", ColumnSpec("remark", synthetic=True), "priority", "missing"]
    return rows_from_arrays(packed, "cells", columns)


@query(
    """SELECT event_id, json_extract_string(props, '$.k') AS k,
              CAST(NULL AS VARCHAR) AS k_z,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS payload_k,
              CAST(NULL AS VARCHAR) AS payload_none
       FROM events"""
)
def nested_access(spark: SparkSession, folder: str) -> DataFrame:
    """Paths into JSON text and into a struct; a missing step gives null."""
    events = named_table(spark, folder, "events").select("event_id", "props")
    payload = events.withColumn("payload", F.from_json("props", "k INT"))
    cells = rows_from_json(payload, "props", ["k", "k.z"])
    spec = GridSpec(
        columns=(
            "event_id",
            "k",
            ColumnSpec("k.z", label="k_z"),
            ColumnSpec("payload/k", label="payload_k"),
            ColumnSpec("payload/none", label="payload_none"),
        ),
        row_id="event_id",
        path_separator="/",
    )
    return Grid(cells, spec).rows()


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS remark, c_name FROM customer")
def empty_column(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=("c_custkey", ColumnSpec("remark", synthetic=True), "c_name"), row_id="c_custkey"
    )
    return Grid(named_table(spark, folder, "customer"), spec).rows()


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def passthrough(spark: SparkSession, folder: str) -> DataFrame:
    """Filters, search, sort and page were done elsewhere: all rows pass."""
    spec = GridSpec(
        columns=("o_orderkey", "o_orderstatus", "o_totalprice"),
        row_id="o_orderkey",
        filters={"o_orderstatus": ("F",)},
        search_text="nothing holds this",
        passthrough=True,
        total=10**9,
    ).sort_by("o_totalprice", "desc")
    return Grid(named_table(spark, folder, "orders"), spec).page()


@query(
    """WITH swapped AS (
         SELECT event_id,
                CASE WHEN event_type = 'error' THEN event_type
                     ELSE json_extract_string(props, '$.k') END AS k,
                CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k')
                     ELSE event_type END AS code
         FROM events)
       SELECT event_id, TRY_CAST(k AS INTEGER) AS k, TRY_CAST(code AS INTEGER) AS code,
              concat_ws(',', CASE WHEN TRY_CAST(k AS INTEGER) IS NULL THEN 'k' END,
                             CASE WHEN TRY_CAST(code AS INTEGER) IS NULL THEN 'code' END)
                AS rejects
       FROM swapped"""
)
def typed_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of error events stand under each other's header; ingest puts them right."""
    events = named_table(spark, folder, "events").select("event_id", "event_type", "props")
    cells = rows_from_json(events, "props", ["k"])
    repair = Repair("event_type = 'error'", (("k", "event_type"), ("event_type", "k")))
    typed = ingest(
        cells,
        [Typed("k", dtype="int"), Typed("code", "event_type", "int")],
        [repair],
        keep=["event_id"],
    )
    return typed.withColumn("rejects", F.array_join(REJECTS, ",")).drop(REJECTS)


@query("SELECT s_suppkey, s_name FROM supplier")
def hide_columns(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(columns=SUPPLIER, row_id="s_suppkey")
    spec = spec.toggle_column("s_acctbal").with_columns(("s_suppkey", "s_name", "s_nationkey"))
    return Grid(
        named_table(spark, folder, "supplier"), spec.toggle_column("s_nationkey")
    ).rows()


@query(
    """SELECT p_partkey, p_name, p_size FROM part
       WHERE contains(CAST(p_partkey AS VARCHAR), '1') OR contains(p_name, '1')
          OR contains(CAST(p_size AS VARCHAR), '1')"""
)
def display_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Hidden and excluded columns are neither shown nor searched."""
    spec = GridSpec(
        columns=(
            "p_partkey",
            "p_name",
            ColumnSpec("p_brand", display="false"),
            ColumnSpec("p_type", display="excluded"),
            ColumnSpec("p_size", display="always"),
        ),
        row_id="p_partkey",
        search_text="1",
    )
    return Grid(named_table(spark, folder, "part"), spec).rows()


@query("SELECT s_acctbal, s_suppkey, s_nationkey, s_name FROM supplier")
def column_order(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(columns=SUPPLIER, row_id="s_suppkey").with_column_order((3, 0, 2, 1))
    return Grid(named_table(spark, folder, "supplier"), spec).rows()


@query("SELECT s_name, s_nationkey, s_acctbal, s_suppkey FROM supplier")
def column_move(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(columns=SUPPLIER, row_id="s_suppkey").move_column("s_suppkey", "s_acctbal")
    return Grid(named_table(spark, folder, "supplier"), spec).rows()


def _part_spec(**column) -> GridSpec:
    return GridSpec(
        columns=("p_partkey", "p_type", ColumnSpec("p_brand", **column)), row_id="p_partkey"
    )


@query(
    """SELECT p_partkey, p_type, p_brand || ' ' || p_type AS p_brand FROM part
       WHERE p_brand || ' ' || p_type IN ('Brand#1 ECONOMY', 'Brand#2 SMALL')"""
)
def derived_cell(spark: SparkSession, folder: str) -> DataFrame:
    """The filter sees the derived value."""
    spec = _part_spec(derive=lambda value, row: F.concat(value, F.lit(" "), row("p_type")))
    spec = spec.with_filter("p_brand", ["Brand#1 ECONOMY", "Brand#2 SMALL"])
    return Grid(named_table(spark, folder, "part"), spec).rows()


@query(
    """SELECT p_partkey, p_type, p_brand || ' ' || p_type AS p_brand FROM part
       WHERE p_brand = 'Brand#1'"""
)
def derived_cell_late(spark: SparkSession, folder: str) -> DataFrame:
    """The filter sees the raw value, the reader the derived one."""
    spec = _part_spec(derive_late="concat(p_brand, ' ', p_type)").with_filter("p_brand", "Brand#1")
    return Grid(named_table(spark, folder, "part"), spec).rows()


@query(
    """SELECT c_custkey, c_name,
              CASE WHEN c_custkey = 3 THEN 'X' WHEN c_custkey = 7 THEN NULL ELSE c_mktsegment END
                AS c_mktsegment
       FROM customer"""
)
def cell_update(spark: SparkSession, folder: str) -> DataFrame:
    customer = named_table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return update_cells(customer, "c_custkey", "c_mktsegment", {3: "X", 7: None})


@query(
    """WITH changed AS (SELECT l_orderkey, max(l_linestatus) AS s FROM lineitem
                        WHERE l_returnflag = 'R' GROUP BY l_orderkey)
       SELECT o_orderkey, o_orderpriority,
              CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE s END AS o_orderstatus
       FROM orders LEFT JOIN changed ON o_orderkey = l_orderkey"""
)
def cell_update_many(spark: SparkSession, folder: str) -> DataFrame:
    """New values come from another table; of several for one key the last in their order stays."""
    orders = named_table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus"
    )
    lines = named_table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    updates = lines.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus")
    )
    return update_cells(orders, "o_orderkey", "o_orderstatus", updates, latest_by="o_orderstatus")
