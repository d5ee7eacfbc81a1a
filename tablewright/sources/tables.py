"""Reading tables and bringing their rows into shape."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators.cells import json_path
from tablewright.plans.spec import ColumnSpec
from tablewright.sources.literals import small_frame

_TOP = "_tw_top_"
FORMATS = ("parquet", "orc", "json", "csv", "text")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Read a table from files.  Text formats need a schema: nothing is inferred."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if fmt in ("json", "csv") and schema is None:
        raise ValueError(f"{fmt} needs a schema; inferring one reads the data twice")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def named_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a folder of tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def numbered_table(spark: SparkSession, path: str, name: str = "_row_id") -> DataFrame:
    """A Parquet table with its rows numbered 0, 1, 2 and so on, files in order of their paths.

    A number is the row's place in its file, which Parquet knows, behind the rows of
    the files before. So numbers have no gaps and are the same however files are split
    among tasks. Rows are not shuffled: each file's length, one number, comes to the
    driver, and its start is joined to them.
    """
    file, place = "_tw_file", "_tw_place"
    held = spark.read.parquet(path)
    rows = held.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    sizes = sorted(tuple(r) for r in rows.groupBy(file).agg(F.max(place) + 1).collect())
    before = accumulate((size for _, size in sizes), initial=0)
    starts = small_frame(spark, [(of, start) for (of, _), start in zip(sizes, before)], "_tw_of string, _tw_before long")
    joined = rows.join(F.broadcast(starts), F.col(file) == F.col("_tw_of"))
    return joined.select(*[quoted(c) for c in held.columns], (F.col("_tw_before") + F.col(place)).alias(name))


def rows_from_arrays(df: DataFrame, array: str, columns: Sequence[ColumnSpec | str]) -> DataFrame:
    """Columns by position out of an array column.

    Column *i* takes element *i*; a short array leaves nulls, extra elements are
    dropped and a synthetic column takes no position.
    """
    specs = [c if isinstance(c, ColumnSpec) else ColumnSpec(c) for c in columns]
    kept = [quoted(c) for c in df.columns if c != array]
    cells, place = [], 0
    for c in specs:
        if c.synthetic:
            cells.append(F.lit(None).cast(c.dtype).alias(c.name))
            continue
        cells.append(F.get(quoted(array), F.lit(place)).alias(c.name))
        place += 1
    return df.select(*kept, *cells)


def rows_from_literals(
    spark: SparkSession, rows: Iterable[Sequence], columns: Sequence[ColumnSpec | str]
) -> DataFrame:
    """A small table written out in code, every cell as text, with its row key.

    For tables that live in files use :func:`read_table` and
    :func:`rows_from_arrays`.
    """
    texts = [(i, [None if v is None else str(v) for v in row]) for i, row in enumerate(rows)]
    df = small_frame(spark, texts, "_row_id bigint, cells array<string>")
    return rows_from_arrays(df, "cells", columns)


def rows_from_json(df: DataFrame, text: str, fields: Sequence[str], separator: str = ".") -> DataFrame:
    """Text columns by path out of a JSON text column; a missing step gives null.

    Several top-level fields are taken out together, so the text is parsed once.
    """
    kept = [c for c in df.columns if c != text]
    flat = [f for f in fields if separator not in f]
    if len(flat) < 2:
        flat = []
    else:
        df = df.select("*", F.json_tuple(quoted(text), *flat).alias(*[_TOP + f for f in flat]))
    cells: list[Column] = [
        quoted(_TOP + f) if f in flat else json_path(quoted(text), f, separator) for f in fields
    ]
    return df.select(*[quoted(c) for c in kept], *[c.alias(f) for c, f in zip(cells, fields)])
