"""CSV export of a table view."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import csv_cell, csv_line, quoted
from tablewright.operators.ordering import Key, ordered
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec

LINE_END = "\r\n"
_HEAD = "_tw_head"


def export_columns(grid: Grid) -> list[ColumnSpec]:
    """Downloadable columns in column order; hidden ones too unless the spec says no."""
    return [
        c
        for c in grid.spec.ordered_columns
        if c.downloadable and (c.visible or not grid.spec.download.displayed_columns_only)
    ]


def export_rows(grid: Grid) -> DataFrame:
    """The exported rows: the whole table, or the displayed rows if the spec says so."""
    return grid.displayed if grid.spec.download.displayed_rows_only else grid.derived


def _cell(grid: Grid, c: ColumnSpec) -> tuple[Column, T.DataType]:
    """Raw value, or the displayed one when only displayed rows are exported."""
    if grid.spec.download.displayed_rows_only:
        return grid.shown(c), grid.shown_type(c)
    return quoted(c.name), grid.table.schema[c.name].dataType


def body_line(grid: Grid) -> Column:
    """The line of a row, out of the row's own columns."""
    cells = [csv_cell(*_cell(grid, c)) for c in export_columns(grid)]
    return csv_line(cells, grid.spec.download.separator)


def header_line(grid: Grid) -> Column:
    text = T.StringType()
    cells = [csv_cell(F.lit(c.title), text) for c in export_columns(grid)]
    return csv_line(cells, grid.spec.download.separator)


def csv_lines(grid: Grid) -> DataFrame:
    """``(row key, line)`` of every exported row, in no order."""
    return export_rows(grid).select(quoted(grid.row_id), body_line(grid).alias("line"))


@dataclass(frozen=True)
class CsvFrame:
    """Header and body in one frame, the keys that put it in order, and the line.

    The header is a row of nulls that a flag sorts first; the body follows in the
    current sort order.  Lines are only made after the sort, so that the sort
    moves cells, not texts, and sampling for it makes no lines at all.
    """

    rows: DataFrame
    order: list[Key]
    line: Column


def csv_frame(grid: Grid) -> CsvFrame:
    rows = export_rows(grid)
    names = [f"_tw_order{i}" for i in range(len(grid.order))]
    keys = [k.expr.alias(n) for k, n in zip(grid.order, names)]
    body = rows.select(F.lit(1).alias(_HEAD), *keys, *[quoted(c) for c in rows.columns])
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in body.schema.fields[1:]]
    head = grid.source.sparkSession.range(1).select(F.lit(0).alias(_HEAD), *blanks)
    order = [Key(F.col(_HEAD))]
    order += [Key(F.col(n), k.descending) for k, n in zip(grid.order, names)]
    line = F.when(F.col(_HEAD) == 0, header_line(grid)).otherwise(body_line(grid))
    return CsvFrame(head.unionByName(body), order, line.alias("line"))


def write_csv(
    grid: Grid,
    folder: str,
    transform: Callable[[DataFrame], DataFrame | bool] | None = None,
    mode: str = "errorifexists",
) -> str | None:
    """Write the export below ``folder`` under the spec's file name; returns its path.

    Spark writes one text part per task; read in name order they give the whole
    file.  ``transform`` gets the lazy frame of ordered lines (column ``line``) and
    may replace it, or return False to cancel.  Cells keep line feeds inside them;
    every line ends with CRLF.
    """
    csv = csv_frame(grid)
    lines: DataFrame | bool = ordered(csv.rows, csv.order).select(csv.line)
    if transform is not None:
        lines = transform(lines)
        if lines is False:
            return None
    path = f"{folder.rstrip('/')}/{grid.spec.download.filename}"
    lines.write.mode(mode).option("lineSep", LINE_END).text(path)
    return path
