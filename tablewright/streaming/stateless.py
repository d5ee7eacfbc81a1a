"""Table views and validation on unbounded tables.

Derived cells, filters, search and validation look at one row at a time and run
on a stream unchanged.  Sorting, paging, positions and facets need the whole
table; asking for them on a stream is an error, not an approximation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.rules import RecordRules
from tablewright.operators.validate import VALID, annotate
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import GridSpec
from tablewright.streaming.guard import NeedsWholeTable


def stream_rows(source: DataFrame, spec: GridSpec) -> DataFrame:
    """The displayed rows of an unbounded table, as they arrive."""
    if spec.sorts or spec.custom_sort is not None:
        raise NeedsWholeTable("a stream has no last row, so it cannot be sorted")
    if spec.pagination:
        raise NeedsWholeTable("a stream has no pages; set pagination=False")
    if source.isStreaming and spec.row_id is None:
        raise NeedsWholeTable("a stream needs a row key of its own; set row_id")
    return Grid(source, spec).rows()


def stream_validated(
    source: DataFrame, rules: RecordRules, folder: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Write checked rows to ``folder``, split into ``_valid=true`` and ``_valid=false``.

    Rows are checked once, and the file sink writes each batch exactly once, so a
    restart neither loses nor repeats a row.
    """
    return (
        annotate(source, rules)
        .writeStream.format("parquet")
        .partitionBy(VALID)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(folder)
    )
