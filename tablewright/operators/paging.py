"""Pages of an ordered table.

What a page costs depends on where it lies.  Near the front or the end it is a
top-k: every task keeps its own best rows and one task merges these few.  In
between that merge would grow with the page number, so samples narrow the table down
to the rows around the page, and only these are sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.ordering import Key, ordered, sort_columns, stretch
from tablewright.plans.spec import clamp_page
from tablewright.streaming.guard import finished

#: A top-k may hold up to this many rows; no more than that pass through one task.
SHALLOW_ROWS = 1000

_AT = "_tw_at"
_TOTAL = "_tw_total"


def page_rows(
    df: DataFrame,
    order: list[Key],
    page: int,
    size: int,
    total: int | None = None,
    shallow_rows: int = SHALLOW_ROWS,
) -> DataFrame:
    """The rows of one page, in order; a page beyond the end gives the last one.

    ``order`` must end in a unique key.  Rows are counted only for a page
    that is neither the first nor near the front, unless ``total`` is given.
    """
    finished(df, "a page")
    if page == 0:
        return rows_at(df, order, 1, size, total, shallow_rows)
    if total is None and (page + 1) * size <= shallow_rows:
        return _front_page(df, order, page, size)
    total = df.count() if total is None else total
    page = clamp_page(total, size, page)
    return rows_at(df, order, page * size + 1, (page + 1) * size, total, shallow_rows)


def _front_page(df: DataFrame, order: list[Key], page: int, size: int) -> DataFrame:
    """A page out of the leading rows, which also tell whether the table ends earlier."""
    leading = ordered(df, order).limit((page + 1) * size)
    keys = Window.orderBy(*sort_columns(order))
    held = F.count(F.lit(1)).over(Window.partitionBy())
    counted = leading.select("*", F.row_number().over(keys).alias(_AT), held.alias(_TOTAL))
    last_page = F.greatest(F.ceil(F.col(_TOTAL) / size), F.lit(1)) - 1
    shown = F.least(F.lit(page), last_page)
    wanted = F.floor((F.col(_AT) - 1) / size) == shown
    return counted.filter(wanted).orderBy(_AT).limit(size).drop(_AT, _TOTAL)


def rows_at(
    df: DataFrame,
    order: list[Key],
    first: int,
    last: int,
    total: int | None = None,
    shallow_rows: int = SHALLOW_ROWS,
) -> DataFrame:
    """The rows at places ``first`` to ``last`` (from 1, both included), in order."""
    size = last - first + 1
    if last <= shallow_rows:
        front = ordered(df, order)
        return (front.offset(first - 1) if first > 1 else front).limit(size)
    if total is not None and 0 <= total - first < shallow_rows:
        back = ordered(df, [k.reversed() for k in order]).limit(total - first + 1)
        return ordered(back, order).limit(size)
    around, skipped = stretch(df, order, first, last, shallow_rows)
    return ordered(around, order).offset(first - 1 - skipped).limit(size)


def page_info(df: DataFrame, page: int, size: int, total: int | None = None) -> DataFrame:
    """One row: total rows, pages, the page shown, and its first and last place."""
    finished(df, "a footer")
    if total is None:
        counted = df.agg(F.count(F.lit(1)).alias("total"))
    else:
        counted = df.sparkSession.range(1).select(F.lit(total).cast("bigint").alias("total"))
    n = F.lit(size).cast("bigint")
    pages = F.greatest(F.ceil(F.col("total") / n), F.lit(1).cast("bigint"))
    shown = F.least(F.lit(page).cast("bigint"), F.col("pages") - 1)
    return (
        counted.withColumn("pages", pages)
        .withColumn("page", shown)
        .select(
            "total",
            "pages",
            "page",
            F.when(F.col("total") == 0, 0).otherwise(F.col("page") * n + 1).alias("first"),
            F.least("total", (F.col("page") + 1) * n).alias("last"),
        )
    )
