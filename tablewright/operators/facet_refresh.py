"""Facets that follow an update without reading the table again.

Facets are kept with the number of rows of each value. An update adds one for the value
a cell gets and takes one for the value it had; values without rows go. The first row
of a value is looked up again only where that row itself has changed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import quoted
from tablewright.operators.cells import update_cells
from tablewright.operators.facet_counts import facet_texts, named_entries
from tablewright.operators.rowset import key_frame
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import SpecError
from tablewright.sources.literals import small_frame
from tablewright.sources.scratch import scratch_path
from tablewright.streaming.guard import finished

_KEY, _OLD = "_tw_key", "_tw_old"


def counted_facets(grid: Grid) -> DataFrame:
    """``(column, value, rows, first_seen)`` of every filterable column, over all rows, in one pass."""
    finished(grid.source, "a facet")
    columns = [c for c in grid.spec.columns if c.filterable]
    key = grid.derived.schema[grid.row_id].dataType
    if not columns:
        return small_frame(
            grid.source.sparkSession, [], f"column string, value string, rows long, first_seen {key.simpleString()}"
        )
    entries = [named_entries(c.name, facet_texts(grid.shown(c), grid.shown_type(c))) for c in columns]
    long = grid.derived.select(quoted(grid.row_id).alias(_KEY), F.explode(F.concat(*entries)).alias("entry"))
    return long.groupBy("entry.column", "entry.value").agg(F.count("*").alias("rows"), F.min(_KEY).alias("first_seen"))


def update_with_facets(
    grid: Grid, facets: DataFrame, column: str, updates, latest_by: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The source with some cells of one column replaced, and its :func:`counted_facets`.

    ``updates`` is as for :func:`update_cells`; ``facets`` are those before the update.
    The table is read once, for the cells that change; they are kept aside, no more
    rows than there are updates. Where a value's first row was given another value, that
    value's rows are read again to find the next one, and no others.
    """
    if any(c.derive is not None for c in grid.spec.columns):
        raise SpecError("facets of derived cells cannot be kept up: a cell may hang on others")
    key = grid.row_id
    updated = update_cells(grid.source, key, column, updates, latest_by)
    if column not in [c.name for c in grid.spec.columns if c.filterable]:
        return updated, facets
    spark, types = grid.source.sparkSession, grid.source.schema
    if isinstance(updates, DataFrame):
        touched = updates.select(quoted(key).alias(_KEY)).distinct()
    else:
        touched = key_frame(grid.source, key, list(updates)).select(quoted(key).alias(_KEY))
    # Only the rows that are touched, with the cell as it was and as it is.
    before = grid.source.select(quoted(key).alias(_KEY), quoted(column).alias(_OLD)).join(touched, _KEY, "left_semi")
    before = before.select(F.col(_KEY).alias(key), _OLD, F.col(_OLD).alias(column))
    after = update_cells(before, key, column, updates, latest_by)
    old, new = (facet_texts(c, types[column].dataType) for c in (F.col(_OLD), quoted(column)))
    changes = _kept_aside(
        after.select(quoted(key).alias(_KEY), F.array_except(old, new).alias("left"), F.array_except(new, old).alias("came")),
        "changes",
    )
    left = changes.select(_KEY, F.explode("left").alias("value"))
    came = changes.select(_KEY, F.explode("came").alias("value"))

    # Values whose first row holds them no more: a few of the facets.
    gone = left.select(F.col("value").alias("_value"), F.col(_KEY).alias("_first"))
    own = facets.where(F.col("column") == column)
    orphans = own.join(gone, F.col("value").eqNullSafe(F.col("_value")) & (F.col("first_seen") == F.col("_first")))
    orphans = _kept_aside(orphans.select(F.col("value").alias("_value")), "orphans")
    same = F.col("value").eqNullSafe(F.col("_value"))
    no_key = F.lit(None).cast(types[key].dataType)
    parts = [
        own.join(orphans, same, "left_anti").select("value", "rows", "first_seen"),
        own.join(orphans, same, "left_semi").select("value", "rows", no_key.alias("first_seen")),
        left.select("value", F.lit(-1).cast("long").alias("rows"), no_key.alias("first_seen")),
        came.select("value", F.lit(1).cast("long").alias("rows"), F.col(_KEY).alias("first_seen")),
    ]
    if not orphans.isEmpty():
        cells = updated.select(
            quoted(key).alias("first_seen"), F.explode(facet_texts(quoted(column), types[column].dataType)).alias("value")
        )
        again = cells.join(orphans, same, "left_semi")
        parts.append(again.select("value", F.lit(0).cast("long").alias("rows"), "first_seen"))
    merged = reduce(DataFrame.unionByName, parts).groupBy("value")
    merged = merged.agg(F.sum("rows").alias("rows"), F.min("first_seen").alias("first_seen")).where("rows > 0")
    others = facets.where(F.col("column") != column)
    return updated, others.unionByName(merged.select(F.lit(column).alias("column"), "value", "rows", "first_seen"))


def _kept_aside(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
