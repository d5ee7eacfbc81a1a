"""Saved views: a grid's state as JSON text under a key, one file each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.plans.compiler import Grid
from tablewright.plans.spec import GridSpec


def save_view(spark: SparkSession, folder: str, key: str, spec: GridSpec) -> None:
    """Write the view's state (never rows or selection) under the key."""
    state = spark.range(1).select(F.lit(spec.to_json()).alias("value"))
    state.coalesce(1).write.mode("overwrite").text(f"{folder.rstrip('/')}/{key}")


def load_view(
    spark: SparkSession, folder: str, key: str, code: GridSpec | None = None
) -> GridSpec:
    """The saved state; functions in specs come from ``code``."""
    row = spark.read.text(f"{folder.rstrip('/')}/{key}", wholetext=True).first()
    return GridSpec.from_json(row["value"], code)


def register_view(source: DataFrame, spec: GridSpec, name: str) -> DataFrame:
    """Make the displayed rows of a view available to SQL under a name."""
    rows = Grid(source, spec).rows()
    rows.createOrReplaceTempView(name)
    return rows
