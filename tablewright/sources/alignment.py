"""Rows whose cells have shifted, put back under their headers without rules for each fault.

Every header says what its cells look like. A row is aligned to the headers at the least
cost: a cell under a header that it does not fit, a header whose cell was lost, and a
cell too many each cost something, an empty cell nothing. Rows that fit as they stand,
the bulk of a table, are told first and go through no alignment.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import quoted

#: What a misfit, a lost cell, a cell missing at a row's end and a cell too many cost.
MISFIT, LOST, ENDED, EXTRA = 3, 2, 1, 2

#: What cells of a type look like.
SHAPES = {
    "string": r"(?s).*",
    "int": r"[+-]?[0-9]+",
    "double": r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "boolean": r"(?i:true|false)",
}


@dataclass(frozen=True)
class Header:
    """A column and the shape of its cells: a pattern for the whole cell, or a type's."""

    name: str
    dtype: str = "string"
    pattern: str | None = None

    @property
    def shape(self) -> str:
        return self.pattern if self.pattern is not None else SHAPES[self.dtype]


def align(cells: Sequence[str | None], shapes: Sequence[re.Pattern]) -> tuple[list[str | None], int, list[str]]:
    """The cell of each header (None where it was lost), the cost, and the cells too many.

    Of equally cheap ways the one counts in which cells stay under their headers
    longest; then one that takes a cell for lost rather than one for too many.
    """
    n, m = len(cells), len(shapes)
    fits = [[not c or s.fullmatch(c) is not None for c in cells] for s in shapes]
    # The least cost from header i and cell j on.
    ahead = [[0] * (n + 1) for _ in range(m + 1)]
    for j in range(n - 1, -1, -1):
        ahead[m][j] = ahead[m][j + 1] + (EXTRA if cells[j] else 0)
    for i in range(m - 1, -1, -1):
        ahead[i][n] = ahead[i + 1][n] + ENDED
        for j in range(n - 1, -1, -1):
            ahead[i][j] = min(
                ahead[i + 1][j + 1] + (0 if fits[i][j] else MISFIT),
                ahead[i + 1][j] + LOST,
                ahead[i][j + 1] + (EXTRA if cells[j] else 1),
            )
    placed: list[str | None] = []
    extra: list[str] = []
    i = j = 0
    while i < m or j < n:
        if i < m and j < n and ahead[i][j] == ahead[i + 1][j + 1] + (0 if fits[i][j] else MISFIT):
            placed.append(cells[j] or None)
            i, j = i + 1, j + 1
        elif i < m and (j == n or ahead[i][j] == ahead[i + 1][j] + LOST):
            placed.append(None)
            i += 1
        else:
            if cells[j]:
                extra.append(cells[j])
            j += 1
    return placed, ahead[0][0], extra


def _stands(cells: Column, headers: Sequence[Header]) -> Column:
    """The row has a cell for every header, and each is empty or fits."""

    def fits(i: int, header: Header) -> Column:
        cell = F.get(cells, F.lit(i))
        return F.coalesce(cell, F.lit("")).rlike(rf"\A(?:{header.shape})?\z")

    tests = [fits(i, h) for i, h in enumerate(headers)]
    return (F.size(cells) == len(headers)) & reduce(and_, tests, F.lit(True))


def _costs(cells: Column, fits: Column, headers: int) -> Column:
    """As ``ahead`` of :func:`align`: for each header, and one beyond, the least cost from each cell on."""
    size = F.size(cells)

    def extra(j: Column, empty: int) -> Column:
        return F.when(F.get(cells, j) != "", F.lit(EXTRA)).otherwise(F.lit(empty))

    def backwards(first: Column, step) -> Column:
        """A row of costs, from the end on: ``first`` beyond the last cell, ``step`` at each other."""

        def put(row: Column, j: Column) -> Column:
            return F.when(j == size, F.array(first)).otherwise(F.array_prepend(row, step(row, j)))

        places = F.sequence(size, F.lit(0), F.lit(-1))
        return F.aggregate(places, F.array().cast("array<int>"), put)

    def header(rows: Column, i: Column) -> Column:
        after = F.get(rows, F.lit(0))

        def cheapest(row: Column, j: Column) -> Column:
            misfit = F.when(F.get(F.get(fits, i), j), F.lit(0)).otherwise(F.lit(MISFIT))
            return F.least(F.get(after, j + 1) + misfit, F.get(after, j) + LOST, F.get(row, F.lit(0)) + extra(j, 1))

        return F.array_prepend(rows, backwards(F.get(after, size) + ENDED, cheapest))

    last = backwards(F.lit(0), lambda row, j: F.get(row, F.lit(0)) + extra(j, 0))
    order = F.array(*[F.lit(i) for i in reversed(range(headers))]).cast("array<int>")
    return F.aggregate(order, F.array(last), header)


_STATE = "struct<i:int,j:int,cells:array<string>,extra:array<string>>"


def _placed(cells: Column, fits: Column, costs: Column, headers: int) -> Column:
    """The way of :func:`align`, a step at a time: the cell of each header, and the cells too many."""
    size = F.size(cells)

    def step(state: Column, _: Column) -> Column:
        i, j = state["i"], state["j"]
        cell, here = F.get(cells, j), F.get(F.get(costs, i), j)
        misfit = F.when(F.get(F.get(fits, i), j), F.lit(0)).otherwise(F.lit(MISFIT))
        below = F.get(costs, i + 1)

        def now(di: int, dj: int, placed: Column, extra: Column) -> Column:
            return F.struct(i + di, j + dj, placed, extra).cast(_STATE)

        stays = (i < headers) & (j < size) & (here == F.get(below, j + 1) + misfit)
        lost = (i < headers) & ((j >= size) | (here == F.get(below, j) + LOST))
        kept = F.when(cell != "", F.array_append(state["extra"], cell)).otherwise(state["extra"])
        return (
            F.when((i >= headers) & (j >= size), state)
            .when(stays, now(1, 1, F.array_append(state["cells"], F.nullif(cell, F.lit(""))), state["extra"]))
            .when(lost, now(1, 0, F.array_append(state["cells"], F.lit(None).cast("string")), state["extra"]))
            .otherwise(now(0, 1, state["cells"], kept))
        )

    none = F.array().cast("array<string>")
    start = F.struct(F.lit(0), F.lit(0), none, none).cast(_STATE)
    return F.aggregate(F.sequence(F.lit(0), size + headers), start, step)


def aligned(df: DataFrame, array: str, headers: Sequence[Header], cost: str = "_shift", extra: str = "_extra") -> DataFrame:
    """One text column per header in place of an array of cells, with the cost and the cells too many.

    ``cost`` is 0 where the row stood as it should; ``extra`` holds cells that found no
    header. A null array is a row without cells. Empty cells are null. Rows are put
    right as :func:`align` does it, by column expressions, those that stand by none.
    """
    kept = [quoted(c) for c in df.columns if c != array]
    cells = F.coalesce(quoted(array), F.array().cast("array<string>"))
    held = df.select(*kept, cells.alias("_tw_cells")).withColumn("_tw_stands", _stands(F.col("_tw_cells"), headers))
    stands, cells = F.col("_tw_stands"), F.col("_tw_cells")

    def fitting(header: Header) -> Column:
        shape = rf"\A(?:{header.shape})?\z"
        return F.transform(cells, lambda c: F.coalesce(c, F.lit("")).rlike(shape))

    fits = F.array(*[fitting(h) for h in headers]).cast("array<array<boolean>>")
    held = held.withColumn("_tw_fits", F.when(~stands, fits))
    held = held.withColumn("_tw_costs", F.when(~stands, _costs(cells, F.col("_tw_fits"), len(headers))))
    mended = _placed(cells, F.col("_tw_fits"), F.col("_tw_costs"), len(headers))
    held = held.withColumn("_tw_mended", F.when(~stands, mended))

    def cell(i: int) -> Column:
        own = F.nullif(F.get("_tw_cells", F.lit(i)), F.lit(""))
        return F.when(stands, own).otherwise(F.get("_tw_mended.cells", F.lit(i)))

    return held.select(
        *kept,
        *[cell(i).alias(h.name) for i, h in enumerate(headers)],
        F.when(stands, 0).otherwise(F.get(F.get("_tw_costs", F.lit(0)), F.lit(0))).alias(cost),
        F.when(stands, F.array().cast("array<string>")).otherwise(F.col("_tw_mended.extra")).alias(extra),
    )
