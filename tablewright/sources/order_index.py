"""A view stored in its order, so that a page anywhere is one lookup and one read.

The displayed rows are sorted in sampled ranges and written, a folder per range, each
row with its place in the range. How many rows come before a range is kept beside
them. A page is then a span of places in one range, or in two that touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators import paging
from tablewright.operators.ordering import sort_columns
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import clamp_page
from tablewright.sources.listing import fingerprint
from tablewright.sources.literals import small_frame

_PART, _AT, _PLACE = "_tw_part", "_tw_at", "_tw_place"
_ROW_BITS = 33  # of monotonically_increasing_id


def _signature(grid: Grid) -> str:
    """What decides the rows and their order: tests, sort keys and stored columns."""
    tests = [] if grid.spec.passthrough else [str(t) for t in grid.filter_tests()]
    keys = [f"{k.expr} {'desc' if k.descending else 'asc'}" for k in grid.order]
    return "\n".join([*tests, *keys, *grid.derived.columns])


def build_order_index(grid: Grid, table: str, index: str, ranges: int | None = None) -> None:
    """Store the displayed rows of a view of the table at path ``table`` in the folder ``index``.

    The row key closes the order, so a hot sort value spreads over as many ranges as
    its rows need. ``ranges`` is the number of shuffle partitions if not given.
    """
    spark = grid.source.sparkSession
    state = fingerprint(spark, table)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = {i: f"_tw_by{i}" for i in range(len(grid.order))}
    keyed = grid.displayed.withColumns({named[i]: k.expr for i, k in enumerate(grid.order)})
    by = sort_columns(grid.order, named)
    number = F.monotonically_increasing_id()
    placed = keyed.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn(_AT, number)
    placed = placed.withColumn(_PART, F.shiftright(_AT, _ROW_BITS).cast("int"))
    placed = placed.withColumn(_AT, F.col(_AT).bitwiseAND((1 << _ROW_BITS) - 1)).drop(*named.values())
    placed.write.partitionBy(_PART).parquet(f"{index}/rows")
    stored = spark.read.schema(placed.schema).parquet(f"{index}/rows")
    # One row per range.
    sizes = sorted(map(tuple, stored.groupBy(_PART).agg(F.count("*")).collect()))
    starts, before = [], 0
    for part, size in sizes:
        starts.append((part, before, size))
        before += size
    small_frame(spark, starts, "part int, before long, size long").coalesce(1).write.parquet(f"{index}/ranges")
    files, length, hashed = state
    built = [(files, length, hashed, _signature(grid))]
    small_frame(spark, built, "files long, length long, hash long, signature string").write.parquet(f"{index}/built")


def _fresh(grid: Grid, table: str, index: str) -> bool:
    built = grid.source.sparkSession.read.parquet(f"{index}/built").first()
    return tuple(built)[:3] == fingerprint(grid.source.sparkSession, table) and built["signature"] == _signature(grid)


def _ranges(grid: Grid, index: str) -> list[tuple[int, int, int]]:
    return sorted(map(tuple, grid.source.sparkSession.read.parquet(f"{index}/ranges").collect()))


def _rows_at(grid: Grid, index: str, ranges: list, first: int, last: int) -> DataFrame:
    """Stored rows at the places ``first`` to ``last`` (from 1), in order; only their ranges are read."""
    spark = grid.source.sparkSession
    derived = grid.derived.schema
    stored = T.StructType([*derived.fields, T.StructField(_AT, T.LongType()), T.StructField(_PART, T.IntegerType())])
    held = spark.read.schema(stored).parquet(f"{index}/rows")
    wanted = [r for r in ranges if r[1] < last and r[1] + r[2] >= first]
    test, place = F.lit(False), F.lit(None).cast("long")
    for part, before, _ in wanted:
        here = F.col(_PART) == part
        test = test | (here & F.col(_AT).between(first - 1 - before, last - 1 - before))
        place = F.when(here, F.col(_AT) + before + 1).otherwise(place)
    rows = held.where(F.col(_PART).isin([r[0] for r in wanted]) & test) if wanted else held.where(F.lit(False))
    return rows.orderBy(place).limit(last - first + 1).select(*[quoted(f.name) for f in derived])


def indexed_page(grid: Grid, table: str, index: str) -> DataFrame:
    """The rows of the view's page, as :meth:`Grid.page` gives them.

    An index of other files, another order or other filters is not used.
    """
    spec = grid.spec
    if spec.passthrough or not spec.pagination or not _fresh(grid, table, index):
        return grid.page()
    ranges = _ranges(grid, index)
    total = sum(r[2] for r in ranges)
    page = clamp_page(total, spec.rows_per_page, spec.page)
    first = page * spec.rows_per_page + 1
    return grid.project(_rows_at(grid, index, ranges, first, first + spec.rows_per_page - 1))


def indexed_page_info(grid: Grid, table: str, index: str) -> DataFrame:
    """The footer of the page; the table is not counted again."""
    spec = grid.spec
    if spec.passthrough or not _fresh(grid, table, index):
        return grid.page_info()
    total = sum(r[2] for r in _ranges(grid, index))
    return paging.page_info(grid.displayed, spec.page, spec.rows_per_page, total)
