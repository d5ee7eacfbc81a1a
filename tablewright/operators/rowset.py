"""Selecting and deleting rows by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators.cells import code
from tablewright.operators.paging import rows_at
from tablewright.operators.predicates import as_held
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import SpecError
from tablewright.sources.literals import small_frame

#: Up to this many listed keys become an IN list, which reaches the scan; the rows are
#: the same either way.
MAX_LISTED_KEYS = 1000
_CHOSEN = "_tw_chosen"


def select_rows(df: DataFrame, key: str, keys, mode: str = "multiple") -> DataFrame:
    """The rows whose key is selected.  ``keys`` is a list or a frame with the key column."""
    keys = _checked(keys, mode)
    if mode == "none" or (isinstance(keys, list) and not keys):
        return df.filter(F.lit(False))
    if isinstance(keys, list) and len(keys) <= MAX_LISTED_KEYS:
        return df.filter(_listed(df, key, keys))
    return _joined(df, key, keys, "left_semi")


def delete_rows(
    df: DataFrame, key: str, keys, veto: Callable[[DataFrame], bool] | None = None
) -> DataFrame:
    """The rows whose key is not selected; ``veto(remaining)`` may return False to keep all.

    The veto sees the lazy frame of the remaining rows, not the rows themselves.
    """
    keys = _checked(keys, "multiple")
    if isinstance(keys, list) and len(keys) <= MAX_LISTED_KEYS:
        left = df.filter(~F.coalesce(_listed(df, key, keys), F.lit(False)))
    else:
        left = _joined(df, key, keys, "left_anti")
    return df if veto is not None and veto(left) is False else left


def _listed(df: DataFrame, key: str, keys: list) -> Column:
    """The key is one of these, as values of the key's own type; null is never selected."""
    dtype = df.schema[key].dataType
    held = _held(keys, dtype)
    return quoted(key).isin(*[F.lit(k).cast(dtype) for k in held]) if held else F.lit(False)


def _held(keys, dtype: T.DataType) -> list:
    """The keys that a cell of this type can equal; a key that a cast would change equals none."""
    return [k for k in dict.fromkeys(as_held(k, dtype) for k in keys) if k is not None]


def _joined(df: DataFrame, key: str, keys, how: str) -> DataFrame:
    """The same by a join; a join by name would move the key to the front."""
    chosen = key_frame(df, key, keys).withColumnRenamed(key, _CHOSEN)
    return df.join(chosen, quoted(key) == F.col(_CHOSEN), how)


def toggle_row(keys: list, row, mode: str = "multiple") -> list:
    """Select a row, or deselect it if it is selected; "single" holds one row."""
    if mode == "none":
        return list(keys)
    if row in keys:
        return [k for k in keys if k != row]
    return [row] if mode == "single" else [*keys, row]


def toggle_displayed(grid: Grid, keys, selectable=None) -> DataFrame:
    """The selection after the header box is pressed, as a frame of row keys.

    With something selected, but no more rows than are displayed, the displayed
    selectable rows leave the selection; otherwise they become the selection.
    """
    if grid.spec.selectable_rows == "none":
        raise SpecError("rows of this table cannot be selected")
    selected = key_frame(grid.source, grid.row_id, _checked(keys, "multiple"))
    displayed = grid.displayed
    counts = (
        selected.select(F.lit(1).alias("s"), F.lit(0).alias("d"))
        .unionByName(displayed.select(F.lit(0).alias("s"), F.lit(1).alias("d")))
        .agg(F.sum("s").alias("s"), F.sum("d").alias("d"))
        .first()
    )
    if selectable is not None:
        displayed = displayed.filter(code(selectable, quoted))
    candidates = displayed.select(quoted(grid.row_id))
    if 0 < (counts["s"] or 0) <= (counts["d"] or 0):
        return selected.join(candidates, grid.row_id, "left_anti")
    return candidates


def select_range(grid: Grid, first: int, last: int, selectable=None) -> DataFrame:
    """Displayed rows between two places (from 1, both included) that may be selected."""
    mode = grid.spec.selectable_rows
    if mode == "none":
        raise SpecError("rows of this table cannot be selected")
    low, high = sorted((first, last))
    if mode == "single" and low != high:
        raise SpecError("only one row may be selected in single mode")
    rows = rows_at(grid.displayed, grid.order, low, high)
    return rows if selectable is None else rows.filter(code(selectable, quoted))


def add_range(grid: Grid, keys, first: int, last: int, selectable=None) -> DataFrame:
    """The selection with a range added, as a frame of distinct row keys."""
    selected = key_frame(grid.source, grid.row_id, _checked(keys, "multiple"))
    added = select_range(grid, first, last, selectable).select(quoted(grid.row_id))
    if grid.spec.selectable_rows == "single":
        return added  # the row that was selected gives way
    return selected.unionByName(added).distinct()


def selected_rows(grid: Grid, keys) -> DataFrame:
    """The source rows that are selected, under the table's own selection mode."""
    return select_rows(grid.source, grid.row_id, keys, grid.spec.selectable_rows)


def selected_count(df: DataFrame, key: str, keys) -> DataFrame:
    """One row: how many rows of the table are selected."""
    return select_rows(df, key, keys).agg(F.count(F.lit(1)).alias("selected"))


def key_frame(df: DataFrame, key: str, keys) -> DataFrame:
    """The distinct keys as a frame of one column, of the type the key has in ``df``.

    A key that is listed very often shrinks to one row per task before it is
    shuffled, and the join that follows finds the keys where it needs them.
    """
    if isinstance(keys, DataFrame):
        return keys.select(quoted(key)).distinct()
    wanted = df.schema[key].dataType
    return small_frame(
        df.sparkSession, [(k,) for k in _held(keys, wanted)], T.StructType([T.StructField(key, wanted)])
    )


def _checked(keys, mode: str):
    if isinstance(keys, DataFrame):
        return _at_most_one(keys) if mode == "single" else keys
    keys = list(dict.fromkeys(keys))
    if mode == "single" and len(keys) > 1:
        raise SpecError("only one row may be selected in single mode")
    return keys


def _at_most_one(keys: DataFrame) -> DataFrame:
    """The frame; the query fails once it meets a second row, so nothing is fetched here.

    Two rows are all that is looked at, however many there are.
    """
    few = keys.limit(2)
    found = few.agg(F.count("*").alias("_tw_n"), F.first(F.struct(*[quoted(c) for c in keys.columns])).alias("_tw_row"))
    message = F.lit("only one row may be selected in single mode")
    held = F.when(F.col("_tw_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.col("_tw_n") > 0)
    return found.filter(held).select("_tw_row.*")


def selectable_rows(df: DataFrame, test: Column | str) -> DataFrame:
    """The rows a reader may select."""
    return df.filter(code(test, quoted))
