"""Typed ingest with repair.

Files give text cells, at times under the wrong header or shifted by a column.
Ingest renames, repairs and casts in one projection and lists per row which
columns would not cast, instead of failing the job or dropping the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.casts import tolerant_cast
from tablewright.functions.dates import iso_parts, timestamp_of
from tablewright.functions.text import quoted, trimmed
from tablewright.operators.cells import code

REJECTS = "_rejects"
_CELL = "_tw_cell_"
_PARTS = "_tw_parts_"
_TYPED = "_tw_typed_"


@dataclass(frozen=True)
class Typed:
    """One output column: where it comes from and which type it gets.

    ``source`` is a column name, or code for anything else.  Empty text counts as
    missing.  ``split_on`` turns a text into an array of its non-empty parts.
    """

    name: str
    source: str | Column | None = None
    dtype: str = "string"
    split_on: str | None = None


@dataclass(frozen=True)
class Repair:
    """Where ``when`` holds, cells are replaced; all new values see the old row."""

    when: str | Column
    cells: tuple[tuple[str, str | Column], ...]


def repaired(df: DataFrame, repairs: Sequence[Repair]) -> DataFrame:
    for repair in repairs:
        test = F.coalesce(code(repair.when), F.lit(False))
        df = df.withColumns(
            {
                name: F.when(test, code(value)).otherwise(quoted(name))
                for name, value in repair.cells
            }
        )
    return df


def ingest(
    df: DataFrame,
    columns: Sequence[Typed],
    repairs: Sequence[Repair] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns and ``_rejects``, the names of the columns that did not cast.

    Cells, typed cells and rejects are projections on top of each other, so that
    a cell that is costly to get at is computed once.
    """
    df = repaired(df, repairs)
    cells = df.select(
        *[quoted(k) for k in keep], *[_source(df, c).alias(_CELL + c.name) for c in columns]
    )
    cells = cells.withColumns(
        {
            _PARTS + c.name: iso_parts(quoted(_CELL + c.name).cast("string"))
            for c in columns
            if c.dtype == "timestamp"
        }
    )
    typed = cells.withColumns({_TYPED + c.name: _cast(cells, c) for c in columns})
    failed = [
        F.when(
            quoted(_CELL + c.name).isNotNull() & quoted(_TYPED + c.name).isNull(), F.lit(c.name)
        )
        for c in columns
    ]
    return typed.select(
        *[quoted(k) for k in keep],
        *[quoted(_TYPED + c.name).alias(c.name) for c in columns],
        F.array_compact(F.array(*failed)).alias(REJECTS),
    )


def _source(df: DataFrame, c: Typed) -> Column:
    source = c.source if c.source is not None else c.name
    cell = source if isinstance(source, Column) else quoted(source)
    if isinstance(source, Column) or isinstance(df.schema[source].dataType, T.StringType):
        return F.nullif(trimmed(cell.cast("string")), F.lit(""))
    return cell


def _cast(cells: DataFrame, c: Typed) -> Column:
    cell = quoted(_CELL + c.name)
    if c.split_on is not None:
        parts = F.split(cell.cast("string"), c.split_on)
        return F.filter(F.transform(parts, trimmed), lambda p: p != "")
    if c.dtype == "timestamp":
        return timestamp_of(quoted(_PARTS + c.name))
    return tolerant_cast(cell, cells.schema[_CELL + c.name].dataType, c.dtype)
