"""Small frames written out in code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def small_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A frame of a few rows that live in the driver.

    Handed over as Arrow data it becomes part of the plan: no Python worker runs,
    and Spark knows its size when it picks a join.
    """
    rows = list(rows)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    columns = {f.name: pa.array([row[i] for row in rows]) for i, f in enumerate(schema)}
    return spark.createDataFrame(pa.table(columns), schema)
