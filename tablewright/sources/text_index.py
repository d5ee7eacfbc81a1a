"""Which files of a table can hold a text, so that a search reads only these.

For every column the index holds the three-character pieces (grams) of its cells, and
for each the files it occurs in, as bits by file number. A file can hold a text only if
it has all of the text's grams in one of the searched columns. What is read is then
searched as ever, so rows are the same as without an index; a file that is new or has
changed since the index was built is always read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.text import quoted, raw_text
from tablewright.operators.ordering import Key, with_positions
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import GridSpec
from tablewright.sources.listing import files_of, read_files
from tablewright.sources.literals import small_frame

#: Characters of a gram.
GRAM = 3
_OVERLAPPING = f"(?s)(?=(.{{1,{GRAM}}}))"


def _folded(text: Column) -> Column:
    """Lower case as search compares it; the two small sigmas, whose choice hangs on what follows, are one."""
    return F.translate(F.lower(text), "ς", "σ")


def grams(text: Column) -> Column:
    """The distinct pieces that start at each character, shorter ones at the end."""
    return F.array_distinct(F.regexp_extract_all(_folded(text), F.lit(_OVERLAPPING), F.lit(1)))


def build_text_index(spark: SparkSession, table: str, columns: Sequence[str], index: str) -> None:
    """Write the index of some columns of a Parquet table to the folder ``index``.

    Grams are made distinct per task before they are shuffled; a gram that is in every
    cell costs one row per file.
    """
    files = with_positions(files_of(spark, table), [Key(F.col("file_path"))], "file_no")
    files.write.parquet(f"{index}/files")
    files = spark.read.parquet(f"{index}/files")
    source = spark.read.parquet(table)
    texts = [raw_text(quoted(c), source.schema[c].dataType).alias(c) for c in columns]
    held = source.select(F.xxhash64("_metadata.file_path").alias("file"), *texts)
    long = held.unpivot("file", [quoted(c) for c in columns], "column", "text")
    found = long.where("text <> ''").select("column", F.explode(grams(F.col("text"))).alias("gram"), "file").distinct()
    numbers = files.select(F.xxhash64("file_path").alias("file"), "file_no")
    bits = (
        found.join(numbers, "file")
        .groupBy("column", "gram", F.bitmap_bucket_number("file_no").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("file_no")).alias("bits"))
    )
    # Each file in order of the gram, so that looking some up reads a few row groups.
    bits.sortWithinPartitions("gram", "column", "bucket").write.parquet(f"{index}/grams")
    small_frame(spark, [(c,) for c in columns], "column string").write.parquet(f"{index}/columns")


def has_bit(bits: Column, place: Column) -> Column:
    """Whether a bitmap has a bit, counted from 0."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1


def _with_text(spark: SparkSession, index: str, columns: Sequence[str], text: str) -> DataFrame:
    """``bucket`` and ``bits`` of the files that have all grams of the text in one of the columns."""
    folded, pieces = small_frame(spark, [(text,)], "text string").select(_folded(F.col("text")), grams(F.col("text"))).first()
    held = spark.read.parquet(f"{index}/grams").where(F.col("column").isin(*columns))
    if len(folded) < GRAM:
        # Every character starts a gram, so a short text is the beginning of one.
        return held.where(F.startswith("gram", F.lit(folded))).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    wanted = [p for p in pieces if len(p) == GRAM]
    every = held.where(F.col("gram").isin(*wanted)).groupBy("column", "bucket")
    every = every.agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n")).where(F.col("n") == len(wanted))
    return every.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def files_with(spark: SparkSession, table: str, index: str, tests: Sequence[tuple[Sequence[str], str]]) -> list[str]:
    """Paths of the files that can hold, for each test, its text in one of its columns.

    Files that the index does not know as they are now are among them. What reaches
    the driver is one path per file, which is what Spark lists for any read.
    """
    known = spark.read.parquet(f"{index}/files").select(
        "file_no", *[F.col(c).alias(f"_{c}") for c in ("file_path", "length", "modified")]
    )
    now = files_of(spark, table)
    as_built = [F.col(c) == F.col(f"_{c}") for c in ("file_path", "length", "modified")]
    listed = now.join(known, as_built, "left").withColumn("bucket", F.bitmap_bucket_number("file_no"))
    possible, place = F.lit(True), F.bitmap_bit_position("file_no")
    for i, (columns, text) in enumerate(tests):
        listed = listed.join(_with_text(spark, index, columns, text).withColumnRenamed("bits", f"bits{i}"), "bucket", "left")
        possible = possible & F.coalesce(has_bit(F.col(f"bits{i}"), place), F.lit(False))
    return [r["path"] for r in listed.where(F.col("file_no").isNull() | possible).select("path").collect()]


def _tests(grid: Grid, indexed: set[str]) -> list[tuple[list[str], str]]:
    """The texts that every displayed row holds, each with the columns it may stand in."""
    spec, found = grid.spec, []
    if spec.passthrough:
        return found

    def usable(columns) -> bool:
        return all(c.name in indexed and c.derive is None and not c.synthetic for c in columns)

    searched = spec.searched_columns
    if spec.search_text and spec.custom_search is None and usable(searched):
        found.append(([c.name for c in searched], spec.search_text))
    for c in spec.columns:
        chosen = spec.filters.get(c.name, ())
        if chosen and spec.kind_of(c.name) == "textField" and c.drop_when is None and usable([c]):
            text = ",".join("" if v is None else str(v) for v in chosen)
            if text:
                found.append(([c.name], text))
    return found


def indexed_grid(spark: SparkSession, table: str, spec: GridSpec, index: str) -> Grid:
    """The view of a table, over the files that its search and text filters leave.

    Rows are those of ``Grid(spark.read.parquet(table), spec)``. Where the index says
    nothing (no text, a custom search, columns that are derived or not indexed), all
    files are read.
    """
    source = spark.read.parquet(table)
    indexed = {r["column"] for r in spark.read.parquet(f"{index}/columns").collect()}
    tests = _tests(Grid(source, spec), indexed)
    if not tests:
        return Grid(source, spec)
    return Grid(read_files(spark, table, files_with(spark, table, index, tests), source.schema), spec)
