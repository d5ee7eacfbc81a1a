"""Column lists, names and parsed texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import shape
from tablewright.queries.registry import query
from tablewright.sources.tables import named_table


@query("SELECT s_suppkey, s_name FROM supplier")
def shape_pick(spark: SparkSession, folder: str) -> DataFrame:
    return shape.pick(named_table(spark, folder, "supplier"), ["s_name", "s_suppkey", "absent"])


@query("SELECT s_suppkey, s_acctbal FROM supplier")
def shape_omit(spark: SparkSession, folder: str) -> DataFrame:
    return shape.omit(named_table(spark, folder, "supplier"), ["s_name", "s_nationkey"])


@query(
    """SELECT s_suppkey, s_name AS supplier_name, s_nationkey, s_acctbal,
              s_acctbal AS balance FROM supplier"""
)
def shape_rename(spark: SparkSession, folder: str) -> DataFrame:
    renamed = shape.rename(named_table(spark, folder, "supplier"), "s_name", "supplier_name")
    return shape.rename(renamed, "s_acctbal", "balance", keep_old=True)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def shape_snake(spark: SparkSession, folder: str) -> DataFrame:
    supplier = named_table(spark, folder, "supplier")
    camel = supplier.toDF("sSuppkey", "SName", "s nationkey", "s-Acctbal")
    return shape.rename_all(camel, shape.snake_case)


@query(
    """SELECT s_suppkey AS "sSuppkey", s_name AS "sName", s_nationkey AS "sNationkey",
              s_acctbal AS "sAcctbal" FROM supplier"""
)
def shape_camel(spark: SparkSession, folder: str) -> DataFrame:
    return shape.rename_all(named_table(spark, folder, "supplier"), shape.camel_case)


@query(
    """SELECT s_suppkey AS "S_SUPPKEY", s_name AS "S_NAME", s_nationkey AS "S_NATIONKEY",
              s_acctbal AS "S_ACCTBAL" FROM supplier"""
)
def shape_constant(spark: SparkSession, folder: str) -> DataFrame:
    return shape.rename_all(named_table(spark, folder, "supplier"), shape.constant_case)


@query(
    """SELECT event_id,
              CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER)
              END AS k,
              event_type = 'error' AS bad
       FROM events"""
)
def shape_json(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of error events lost their closing brace and do not parse."""
    events = named_table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.rtrim("props", F.lit("}")))
        .otherwise(F.col("props"))
        .alias("props"),
    )
    parsed = shape.parse_json(events, "props", "k INT", "payload", "bad")
    return parsed.select("event_id", "payload.k", "bad")
