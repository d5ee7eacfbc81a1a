"""How many rows each facet value would leave, given the filters on the other columns.

Counts come either from one pass over the table, or from bitmaps that are stored once:
for every column and value the places of its rows, in blocks of 32,768 places. Chosen
values of a column are joined by or, columns by and; what a value leaves is the number
of bits it shares with the other columns' result. A value with few rows in a block is
stored as places, so that a column of nearly unique values costs what its rows cost.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import cell_text, contains_text, quoted, raw_text
from tablewright.operators import predicates
from tablewright.operators.ordering import Key, with_positions
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, SpecError
from tablewright.sources.literals import small_frame
from tablewright.sources.text_index import has_bit
from tablewright.streaming.guard import finished

#: Rows of a value in a block from which on they are bits, not places.
DENSE = 256
#: Stands for the search among the columns that have a test.
_SEARCH = "\0search"
_PLACE = "_tw_place"


def _facet_columns(grid: Grid) -> list[ColumnSpec]:
    return [c for c in grid.spec.columns if c.filterable]


def facet_texts(cell: Column, dtype: T.DataType) -> Column:
    """The facet values of a cell, as an array: an array's distinct elements, none for a null array."""
    if not isinstance(dtype, T.ArrayType):
        return F.array(raw_text(cell, dtype))
    element = dtype.elementType
    texts = F.transform(cell, lambda x: F.when(x.isNotNull(), cell_text(x, element)))
    return F.array_distinct(F.coalesce(texts, F.array().cast("array<string>")))


def named_entries(column: str, texts: Column, *more: Column) -> Column:
    """An array's texts as structs with the name of their column."""
    return F.transform(texts, lambda v: F.struct(F.lit(column).alias("column"), v.alias("value"), *more))


def _texts(grid: Grid, c: ColumnSpec) -> Column:
    return facet_texts(grid.shown(c), grid.shown_type(c))


def _tests(grid: Grid) -> dict[str, Column]:
    """One test per filtered column, by name, and the search's."""
    if grid.spec.passthrough:
        return {}
    return {**grid.column_tests(), **({_SEARCH: grid.search_test()} if grid.spec.search_text else {})}


def facet_counts(grid: Grid) -> DataFrame:
    """``(column, value, rows)`` of every facet value, in one pass over the table.

    ``rows`` is the number of rows with the value that pass the search and the filters
    of all other columns: what choosing the value alone would show. Values that leave
    none are there with 0.
    """
    finished(grid.source, "a facet")
    columns, tests = _facet_columns(grid), _tests(grid)
    if not columns:
        return small_frame(grid.source.sparkSession, [], "column string, value string, rows long")
    passed = {name: F.coalesce(test, F.lit(False)).alias(f"_tw_passes{i}") for i, (name, test) in enumerate(tests.items())}
    flags = {name: F.col(f"_tw_passes{i}") for i, name in enumerate(tests)}
    cells = {c.name: _texts(grid, c).alias(f"_tw_cell{i}") for i, c in enumerate(columns)}
    rows = grid.derived.select(*passed.values(), *cells.values())
    entries = []
    for i, c in enumerate(columns):
        others = reduce(and_, [f for n, f in flags.items() if n != c.name], F.lit(True))
        entries.append(named_entries(c.name, F.col(f"_tw_cell{i}"), others.cast("long").alias("rows")))
    long = rows.select(F.explode(F.concat(*entries)).alias("_tw_entry")).select("_tw_entry.*")
    return long.groupBy("column", "value").agg(F.sum("rows").alias("rows"))


def build_facet_bitmaps(grid: Grid, index: str) -> None:
    """Store the bitmaps of all facet columns of a view's source in the folder ``index``.

    Places follow the row key. A value's rows are counted per task before anything is
    shuffled; a block is 32,768 places, so nothing grows with a hot value.
    """
    finished(grid.source, "a facet")
    spark = grid.source.sparkSession
    with_positions(grid.derived, [Key(quoted(grid.row_id))], _PLACE).write.parquet(f"{index}/rows")
    rows = spark.read.parquet(f"{index}/rows")
    columns = _facet_columns(grid)
    entries = [named_entries(c.name, _texts(grid, c)) for c in columns]
    long = rows.select(
        F.bitmap_bucket_number(_PLACE).alias("block"),
        F.bitmap_bit_position(_PLACE).alias("bit"),
        F.explode(F.concat(*entries)).alias("entry"),
    ).select("entry.*", "block", "bit")
    long.write.parquet(f"{index}/entries")
    long = spark.read.parquet(f"{index}/entries")
    keys = ["column", "value", "block"]
    sizes = long.groupBy(*keys).agg(F.count("*").alias("rows"))
    dense = sizes.where(F.col("rows") >= DENSE).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    many = long.join(dense, same, "left_semi").groupBy(*keys).agg(F.bitmap_construct_agg("bit").alias("bits"))
    few = long.join(dense, same, "left_anti")
    for name, frame in (("dense", many), ("sparse", few)):
        # Each file in order of the value, so that looking some up reads a few row groups.
        frame.sortWithinPartitions("column", "value", "block").write.parquet(f"{index}/{name}")


def _value_tests(grid: Grid, c: ColumnSpec) -> list[Column] | None:
    """Tests of stored values, all of which a row's values must meet, or None if the cell itself must be asked."""
    spec, dtype = grid.spec, grid.shown_type(c)
    values, kind = spec.filters.get(c.name, ()), spec.kind_of(c.name)
    listed = isinstance(dtype, T.ArrayType)
    if c.drop_when is not None or kind == "custom" or listed and (kind == "textField" or None in values):
        return None
    if kind == "textField":
        wanted = ",".join("" if v is None else str(v) for v in values)
        return [contains_text(F.coalesce("value", F.lit("")), wanted, spec.case_sensitive)]
    element = dtype.elementType if listed else dtype

    def is_value(value) -> Column:
        held = predicates.as_held(value, element)
        return F.lit(False) if held is None else F.col("value") == raw_text(F.lit(held).cast(element), element)

    tests = [F.col("value").isNull() if v is None else is_value(v) for v in values]
    return tests if listed and spec.array_match_all else [reduce(or_, tests)]


def _selected(grid: Grid, name: str, test: Column, index: str) -> DataFrame:
    """``block`` and ``bits`` of the rows that pass one column's filter, or the search."""
    spark = grid.source.sparkSession
    value_tests = None if name == _SEARCH else _value_tests(grid, grid.spec.column(name))
    if value_tests is None:
        # A test of the cell: the places of the rows that pass it, from the columns it needs.
        rows = spark.read.parquet(f"{index}/rows").where(test)
        bits = rows.groupBy(F.bitmap_bucket_number(_PLACE).alias("block"))
        return bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(_PLACE)).alias("bits"))
    dense, sparse = spark.read.parquet(f"{index}/dense"), spark.read.parquet(f"{index}/sparse")
    parts = []
    for value_test in value_tests:
        of_column = (F.col("column") == name) & value_test
        few = sparse.where(of_column).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        both = dense.where(of_column).select("block", "bits").unionByName(few)
        parts.append(both.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")))
    return _all_of(parts)


def _all_of(parts: list[DataFrame]) -> DataFrame:
    """The bits that are in every part; a block that one part lacks has none."""
    together = reduce(DataFrame.unionByName, parts)
    held = together.groupBy("block").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    return held.where(F.col("n") == len(parts)).select("block", "bits")


def counted_by_bitmaps(grid: Grid, index: str) -> DataFrame:
    """:func:`facet_counts` from the stored bitmaps.

    The table is not read for filters that choose values or hold a text; custom tests,
    a null chosen among arrays and the search read the columns they ask, nothing else.
    """
    spark = grid.source.sparkSession
    dense, sparse = spark.read.parquet(f"{index}/dense"), spark.read.parquet(f"{index}/sparse")
    columns, tests = _facet_columns(grid), _tests(grid)
    known = spark.read.parquet(f"{index}/rows").columns
    missing = [c.name for c in columns if c.name not in known]
    if missing:
        raise SpecError(f"the bitmaps know no column {missing[0]!r}")
    selected = {name: _selected(grid, name, test, index) for name, test in tests.items()}
    named = [c.name for c in columns]
    # Columns without a filter of their own share one mask.
    groups = [([n for n in named if n not in tests], list(tests))]
    groups += [([n], [t for t in tests if t != n]) for n in named if n in tests]
    counts = []
    for members, others in groups:
        many, few = (t.where(F.col("column").isin(members)) for t in (dense, sparse))
        if not members:
            continue
        if not others:
            counts.append(many.groupBy("column", "value").agg(F.sum(F.bitmap_count("bits")).alias("rows")))
            counts.append(few.groupBy("column", "value").agg(F.count("*").alias("rows")))
            continue
        mask = _all_of([selected[t] for t in others]).withColumnRenamed("bits", "mask")
        shared = many.join(mask, "block").withColumn("bits", F.explode(F.array("bits", "mask")))
        shared = shared.groupBy("column", "value", "block").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("rows"))
        counts.append(shared.groupBy("column", "value").agg(F.sum("rows").alias("rows")))
        hit = few.join(mask, "block").where(has_bit(F.col("mask"), F.col("bit")))
        counts.append(hit.groupBy("column", "value").agg(F.count("*").alias("rows")))
        # Values that share nothing are shown as well.
        every = many.select("column", "value").unionByName(few.select("column", "value"))
        counts.append(every.distinct().withColumn("rows", F.lit(0).cast("long")))
    if not counts:
        return small_frame(spark, [], "column string, value string, rows long")
    together = reduce(DataFrame.unionByName, counts)
    return together.groupBy("column", "value").agg(F.sum("rows").alias("rows"))


def displayed_by_bitmaps(grid: Grid, index: str) -> DataFrame:
    """One row, ``total``: how many rows pass all filters and the search."""
    spark = grid.source.sparkSession
    tests = _tests(grid)
    if not tests:
        return spark.read.parquet(f"{index}/rows").agg(F.count("*").alias("total"))
    held = _all_of([_selected(grid, name, test, index) for name, test in tests.items()])
    # Tasks add up their blocks under one key; a 0 of it is there if no block is left.
    counts = held.select(F.lit(_PLACE).alias("key"), F.bitmap_count("bits").alias("rows"))
    counts = counts.unionByName(small_frame(spark, [(_PLACE, 0)], "key string, rows long"))
    return counts.groupBy("key").agg(F.sum("rows").alias("total")).select("total")
