"""Distinct values per column, the choices a filter offers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import cell_text, natural_key, quoted, raw_text
from tablewright.operators.cells import code
from tablewright.operators.ordering import Key, with_positions
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec
from tablewright.sources.literals import small_frame
from tablewright.sources.scratch import scratch_path
from tablewright.streaming.guard import finished



def facet_values(grid: Grid) -> DataFrame:
    """``(column, value, first_seen)`` of every filterable column, over all rows.

    Values are texts; a null cell gives one null value, an array cell its
    elements.  ``first_seen`` is the smallest row key that holds the value.  All
    plain columns share one pass: rows are unpivoted and aggregated per task
    before anything is shuffled, so a hot value costs one row per task.
    """
    finished(grid.source, "a facet")
    plain, parts = [], []
    for c in grid.spec.columns:
        if not c.filterable:
            continue
        if c.facet_names is not None:
            parts.append(_named(grid, c))
        elif isinstance(grid.shown_type(c), T.ArrayType):
            parts.append(_elements(grid, c))
        else:
            plain.append(c)
    if plain:
        texts = [raw_text(grid.shown(c), grid.shown_type(c)).alias(c.name) for c in plain]
        row_id = quoted(grid.row_id).alias("_tw_row")
        long = grid.derived.select(row_id, *texts).unpivot(
            "_tw_row", [quoted(c.name) for c in plain], "column", "value"
        )
        parts.insert(0, _distinct(long))
    if not parts:
        return small_frame(grid.source.sparkSession, [], _schema(grid))
    return reduce(DataFrame.unionByName, parts)


def ordered_facets(grid: Grid) -> DataFrame:
    """``(column, value, label, pos)``: facets with their place within the column.

    Values stand in natural order (digits by value, case and accents ignored, ties
    as first seen), or as first seen if the spec does not sort facets.
    """
    spec = grid.spec
    spark = grid.source.sparkSession
    # Aggregated once: numbering reads the values several times, and they are few beside the rows.
    path = scratch_path(spark, "facets")
    facet_values(grid).write.parquet(path)
    facets = spark.read.parquet(path)
    text = F.coalesce("value", F.lit(""))
    keys = [Key(quoted("column"))]
    if spec.sort_facets:
        keys.append(Key(natural_key(text), costly=True))
    keys += [Key(_listed_place(grid)), Key(F.col("first_seen")), Key(F.col("value"))]
    placed = with_positions(facets, keys, "_tw_place")
    # One number per column, so this is as small as the spec.
    sizes = {r["column"]: r["count"] for r in facets.groupBy("column").count().collect()}
    start, before = F.lit(None).cast("bigint"), 0
    for name in sorted(sizes, key=str.encode):
        start = F.when(quoted("column") == name, F.lit(before)).otherwise(start)
        before += sizes[name]
    label = F.col("value")
    for c in spec.columns:
        if c.facet_label is not None:
            label = F.when(
                quoted("column") == c.name, code(c.facet_label, F.col("value"))
            ).otherwise(label)
    return placed.select(
        "column",
        "value",
        label.alias("label"),
        (F.col("_tw_place") - start).alias("pos"),
    )


def _distinct(long: DataFrame) -> DataFrame:
    return long.groupBy("column", "value").agg(F.min("_tw_row").alias("first_seen"))


def _elements(grid: Grid, c: ColumnSpec) -> DataFrame:
    dtype = grid.shown_type(c)
    element = F.explode(grid.shown(c))
    values = grid.derived.select(
        quoted(grid.row_id).alias("_tw_row"), element.alias("value")
    )
    as_text = F.when(
        F.col("value").isNotNull(), cell_text(F.col("value"), dtype.elementType)
    )
    return _distinct(values.select("_tw_row", F.lit(c.name).alias("column"), as_text.alias("value")))


def _schema(grid: Grid) -> T.StructType:
    """First seen is a row key, of whatever type that has."""
    text = T.StringType()
    key = grid.derived.schema[grid.row_id].dataType
    return T.StructType().add("column", text).add("value", text).add("first_seen", key)


def _named(grid: Grid, c: ColumnSpec) -> DataFrame:
    """Listed values; first seen is the place in the list where row keys are numbers, else null."""
    schema = _schema(grid)
    counted = isinstance(schema["first_seen"].dataType, T.NumericType)
    rows = [
        (c.name, None if v is None else str(v), i if counted else None)
        for i, v in enumerate(c.facet_names)
    ]
    long = T.LongType() if counted else T.NullType()
    plain = small_frame(
        grid.source.sparkSession, rows, T.StructType([*schema.fields[:2], T.StructField("first_seen", long)])
    )
    return plain.withColumn("first_seen", F.col("first_seen").cast(schema["first_seen"].dataType))


def _listed_place(grid: Grid) -> Column:
    """Place of a value in its column's fixed list, null where the column has none."""
    place = F.lit(None).cast("bigint")
    for c in grid.spec.columns:
        if c.facet_names is not None:
            names = F.array(*[F.lit(None if v is None else str(v)).cast("string") for v in c.facet_names])
            found = F.array_position(F.transform(names, _held), _held(F.col("value")))
            place = F.when(quoted("column") == c.name, found).otherwise(place)
    return place


def _held(text: Column) -> Column:
    """A text that can be looked for, null too."""
    return F.coalesce(F.concat(F.lit("="), text), F.lit(""))
