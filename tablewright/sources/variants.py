"""JSON texts of any shape: parsed once, any path afterwards, no schema given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import quoted


def parsed(df: DataFrame, text: str, name: str = "parsed") -> DataFrame:
    """Adds the text as a VARIANT column; null where the text is no JSON, which stays as it is in ``text``."""
    return df.withColumn(name, F.try_parse_json(quoted(text)))


def variant_path(path: str, separator: str = ".") -> str:
    """A separated path as Spark writes it: names, and numbers as places in arrays."""
    steps = []
    for step in path.split(separator):
        escaped = step.replace("\\", "\\\\").replace("'", "\\'")
        steps.append(f"[{step}]" if step.isdigit() else f"['{escaped}']")
    return "$" + "".join(steps)


def variant_cell(c: Column, path: str, dtype: str = "string", separator: str = ".") -> Column:
    """The value a path leads to: null at a missing step, or where it is no ``dtype``.

    As ``string``, objects and arrays are JSON texts.
    """
    return F.try_variant_get(c, variant_path(path, separator), dtype)


def variant_columns(
    df: DataFrame, text: str, paths: dict[str, str], separator: str = ".", unparsed: str | None = None
) -> DataFrame:
    """One column per path, by its new name, in place of the text, which is parsed once per row.

    ``unparsed`` names a column that holds the texts that are no JSON, as they are.
    """
    kept = [quoted(c) for c in df.columns if c != text]
    held = df.select(*kept, quoted(text).alias("_tw_text"), F.try_parse_json(quoted(text)).alias("_tw_parsed"))
    cells = [variant_cell(F.col("_tw_parsed"), path, separator=separator).alias(name) for name, path in paths.items()]
    if unparsed is not None:
        cells.append(F.when(F.col("_tw_parsed").isNull(), F.col("_tw_text")).alias(unparsed))
    return held.select(*kept, *cells)


def merged_schema(df: DataFrame, text: str) -> str:
    """The schema that all texts share, as Spark writes it: fields of any row, types widened until all fit.

    It is merged by an aggregate, so one text reaches the driver.
    """
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(quoted(text)))).first()[0]
