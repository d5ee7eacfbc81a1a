"""The check that stands before every operator that needs a finished table."""

from __future__ import annotations

from pyspark.sql import DataFrame


class NeedsWholeTable(ValueError):
    """Asked of a stream: something only a finished table can give."""


def finished(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, unless it is unbounded."""
    if df.isStreaming:
        raise NeedsWholeTable(f"a stream has no last row, so {what} cannot be had")
    return df
