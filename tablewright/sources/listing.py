"""The files of a table, as a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources.literals import small_frame


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """``file_path``, ``path``, ``length`` and ``modified`` of every Parquet file below a path.

    Nothing is read from the files. ``file_path`` is written as in ``_metadata`` of rows.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
    )


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number of files, their bytes, and a hash of names, lengths and times: other files, other fingerprint."""
    found = files_of(spark, path).agg(
        F.count("*"),
        F.coalesce(F.sum("length"), F.lit(0)),
        F.coalesce(F.bit_xor(F.xxhash64("file_path", "length", "modified")), F.lit(0)),
    )
    return tuple(found.first())


def read_files(spark: SparkSession, table: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """The rows of some files of a table; columns held in folder names stay columns."""
    if not files:
        return small_frame(spark, [], schema)
    reader = spark.read.schema(schema)
    if any("=" in f.removeprefix(table) for f in files):
        reader = reader.option("basePath", table)
    return reader.parquet(*files)
