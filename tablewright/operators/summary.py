"""Summary row under a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from tablewright.operators.cells import code


def summary_row(df: DataFrame, cells: Mapping[str, Column | str]) -> DataFrame:
    """One row of aggregates over all rows of ``df``, one per named cell."""
    return df.agg(*[code(c).alias(name) for name, c in cells.items()])
