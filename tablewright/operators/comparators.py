"""Sorting by a comparator that is code: a function of two values that no key stands for.

The column's distinct values are sorted, not its rows. A sample of them, sorted on the
driver, gives bounds; every value finds its range by binary search with the comparator,
and each range is sorted in its task. Values get the place of their class (values that
the comparator holds equal share one), and with that column the table sorts, pages and
numbers like any other: rows of a hot value never meet in one task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import quoted
from tablewright.sources.literals import small_frame
from tablewright.sources.scratch import scratch_path

#: Sampled values for each range, and values that a range is meant to hold.
SAMPLES_PER_RANGE = 20
RANGE_VALUES = 50_000

Comparator = Callable[[object, object], int]


def _total(compare: Comparator):
    """A key that sorts by the comparator and then by the value's own text, which tells equals apart."""

    def both(a: tuple[object, str], b: tuple[object, str]) -> int:
        found = compare(a[0], b[0])
        return found if found else (a[1] > b[1]) - (a[1] < b[1])

    return cmp_to_key(both)


def _dealt(compare: Comparator, bounds: list):
    """The range of each value: how many bounds do not stand behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = _total(compare)
        limits = [key((b, repr(b))) for b in bounds]
        for batch in batches:
            parts = []
            for value in batch.column(0).to_pylist():
                own, low, high = key((value, repr(value))), 0, len(limits)
                while low < high:
                    middle = (low + high) // 2
                    low, high = (low, middle) if own < limits[middle] else (middle + 1, high)
                parts.append(low)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), batch.column(0)], names=["part", "value"])

    return run


def _numbered(compare: Comparator):
    """Values of each range with the number of their class in it, and how many classes it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = _total(compare)
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values.sort(key=lambda v: key((v, repr(v))))
                numbers, now = [], 0
                for i, value in enumerate(values):
                    now += i > 0 and compare(values[i - 1], value) != 0
                    numbers.append(now)
                ends = [i in (0, len(values) - 1) for i in range(len(values))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(values), pa.int32()),
                        pa.array(values, batch.column(1).type.value_type),
                        pa.array(numbers, pa.int64()),
                        pa.array(ends, pa.bool_()),
                    ],
                    names=["part", "value", "number", "at_end"],
                )

    return run


def comparator_ranks(df: DataFrame, column: str, compare: Comparator, range_values: int = RANGE_VALUES) -> DataFrame:
    """``value`` and ``rank`` (from 0) of a column's distinct values, in the comparator's order.

    ``compare(a, b)`` is negative, zero or positive and must be consistent. It is never
    asked about nulls, which have no rank. A range holds about ``range_values`` values,
    also where the comparator holds many of them equal.
    """
    spark = df.sparkSession
    # The comparator goes to the tasks with its code, so executors need no copy of its module.
    for module in {__name__, getattr(compare, "__module__", None)} - {"__main__", "builtins", None}:
        cloudpickle.register_pickle_by_value(sys.modules[module])
    dtype = df.schema[column].dataType.simpleString()
    path = scratch_path(spark, "values")
    df.select(quoted(column).alias("value")).where("value is not null").distinct().write.parquet(path)
    values = spark.read.parquet(path)
    ranges = max(1, -(-values.count() // range_values))
    # The values with the smallest random numbers: each task keeps no more than these.
    sample = values.orderBy(F.rand(17)).limit(ranges * SAMPLES_PER_RANGE) if ranges > 1 else values.limit(0)
    key = _total(compare)
    ordered = sorted((r["value"] for r in sample.collect()), key=lambda v: key((v, repr(v))))
    bounds = [ordered[len(ordered) * i // ranges] for i in range(1, ranges)] if ordered else []
    dealt = values.mapInArrow(_dealt(compare, bounds), f"part int, value {dtype}")
    sorted_out = dealt.groupBy("part").agg(F.collect_list("value").alias("values"))
    path = scratch_path(spark, "numbered")
    sorted_out.mapInArrow(_numbered(compare), f"part int, value {dtype}, number long, at_end boolean").write.parquet(path)
    numbered = spark.read.parquet(path)
    # Two values of each range: a class that goes on in the next range is one class.
    ends: dict[int, list] = {}
    for r in numbered.where("at_end").select("part", "number", "value").collect():
        ends.setdefault(r["part"], []).append((r["number"], key((r["value"], repr(r["value"]))), r["value"]))
    starts, before, last = [], 0, None
    for part in sorted(ends):
        low, high = min(ends[part], key=lambda e: e[1]), max(ends[part], key=lambda e: e[1])
        joins = last is not None and compare(last, low[2]) == 0
        starts.append((part, before - joins))
        before, last = before - joins + high[0] + 1, high[2]
    offsets = small_frame(spark, starts, "of int, before long")
    return numbered.join(offsets, F.col("part") == F.col("of")).select("value", (F.col("number") + F.col("before")).alias("rank"))


def with_comparator_rank(df: DataFrame, column: str, compare: Comparator, name: str) -> DataFrame:
    """The frame with the comparator's rank of a column beside it: null where the cell is null.

    ``ColumnSpec(column, sort_key=name)`` then sorts by the comparator, stably: ties are
    told apart by older sorts and the row key.
    """
    ranks = comparator_ranks(df, column, compare).select(F.col("value").alias("_tw_value"), F.col("rank").alias(name))
    joined = df.join(ranks, quoted(column) == F.col("_tw_value"), "left")
    return joined.select(*[quoted(c) for c in df.columns], quoted(name))
