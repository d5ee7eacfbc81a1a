"""Access to nested cells, code in specs, and changes of single cells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.sources.literals import small_frame


def nested(name: str, separator: str | None = None) -> Column:
    """The column, or the field a separated path leads to; null at a missing step."""
    if not separator or separator not in name:
        return quoted(name)
    first, *steps = name.split(separator)
    c = quoted(first)
    for step in steps:
        c = c.getField(step)
    return c


def path_type(
    schema: T.StructType, name: str, separator: str | None = None
) -> T.DataType | None:
    """Type of the column or of the field a path leads to; None if a step is missing."""
    steps = name.split(separator) if separator and separator in name else [name]
    here: T.DataType = schema
    for step in steps:
        if not isinstance(here, T.StructType) or step not in here.names:
            return None
        here = here[step].dataType
    return here


def json_path(c: Column, path: str, separator: str = ".") -> Column:
    """Text of a field inside a JSON text; null at a missing step."""
    steps = "".join(f"['{step}']" for step in path.split(separator))
    return F.get_json_object(c, "$" + steps)


def code(expression, *arguments) -> Column:
    """A column from spec code: SQL text, a Column, or a function of columns."""
    if isinstance(expression, str):
        return F.expr(expression)
    if isinstance(expression, Column):
        return expression
    made = expression(*arguments)
    return F.expr(made) if isinstance(made, str) else made


def update_cells(
    df: DataFrame,
    key: str,
    column: str,
    updates: Mapping | DataFrame,
    latest_by: str | None = None,
) -> DataFrame:
    """Replace cells of one column, row by row key.

    ``updates`` maps keys to new values, or is a frame of ``key`` and ``column``.
    A frame may hold a key more than once if ``latest_by`` names the column that
    tells which value came last; without it a doubled key is an error, raised when
    the rows are computed.
    """
    dtype = df.schema[column].dataType
    fresh, hit = "_tw_new", "_tw_of"
    if isinstance(updates, Mapping):
        if not updates:
            return df
        fields = [T.StructField(hit, df.schema[key].dataType), T.StructField(fresh, dtype)]
        changed = small_frame(df.sparkSession, updates.items(), T.StructType(fields))
    else:
        given = updates.select(
            quoted(key).alias(hit),
            quoted(column).cast(dtype).alias(fresh),
            *([quoted(latest_by).alias("_tw_when")] if latest_by else []),
        )
        if latest_by:
            changed = given.groupBy(hit).agg(F.max_by(fresh, "_tw_when").alias(fresh))
        else:
            message = F.concat(F.lit("more than one update of key "), F.col(hit).cast("string"))
            only = F.when(F.count("*") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
            changed = given.groupBy(hit).agg(F.any_value(fresh).alias(fresh), only.alias("_tw_only"))
            changed = changed.filter("_tw_only").drop("_tw_only")
    replaced = F.when(F.col(hit).isNotNull(), F.col(fresh)).otherwise(quoted(column))
    return df.join(changed, quoted(key) == F.col(hit), "left").select(
        *[replaced.alias(c) if c == column else quoted(c) for c in df.columns]
    )
