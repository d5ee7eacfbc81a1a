"""Sort keys and row positions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.streaming.guard import finished

_PART = "_tw_part"
_KEY = "_tw_by"
#: Sampled rows for each part that a table is cut into, and the most parts.
SAMPLES_PER_PART = 40
MOST_PARTS = 400
#: Key types whose values can be written into a plan.
_LITERAL_TYPES = (
    T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType
)


@dataclass(frozen=True)
class Key:
    """One sort key.  ``costly`` keys are computed once per row, before the sort."""

    expr: Column
    descending: bool = False
    costly: bool = False

    def reversed(self) -> Key:
        return Key(self.expr, not self.descending, self.costly)


def by(*names: str) -> list[Key]:
    """Ascending keys on plain columns."""
    return [Key(quoted(n)) for n in names]


def cell_key(c: Column, dtype: T.DataType, collation: str = "UNICODE") -> Column:
    """Key of one cell: texts compare as a dictionary would, null as empty text.

    Other types compare as they are, with null first when ascending and last when
    descending, which is where an empty text stands.
    """
    if isinstance(dtype, T.StringType):
        text = F.coalesce(c, F.lit(""))
        return text if collation == "UTF8_BINARY" else F.collate(text, collation)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"a {dtype.simpleString()} column needs a sort_key expression")
    return c


def sort_columns(order: list[Key], names: dict[int, str] | None = None) -> list[Column]:
    """The keys with their directions; ``names`` holds keys that are columns by now."""
    columns = []
    for i, key in enumerate(order):
        c = F.col(names[i]) if names and i in names else key.expr
        columns.append(c.desc_nulls_last() if key.descending else c.asc_nulls_first())
    return columns


def ordered(df: DataFrame, order: list[Key]) -> DataFrame:
    """The frame in the given order."""
    names = {i: f"_tw_key{i}" for i, key in enumerate(order) if key.costly}
    if not names:
        return df.orderBy(*sort_columns(order))
    computed = df.withColumns({name: order[i].expr for i, name in names.items()})
    return computed.orderBy(*sort_columns(order, names)).drop(*names.values())


def with_positions(
    df: DataFrame, order: list[Key], name: str = "pos", parts: int | None = None
) -> DataFrame:
    """Add each row's place (from 1) in the total order ``order``.

    A window over the whole table would bring every row into one task.  Here a
    sample of bounded size gives the bounds of ``parts`` ranges (as many as there
    are shuffle partitions), one pass counts the rows in each, and rows are numbered
    within their range, behind the rows of the ranges before.  Bounds and counts are
    literals in the plan, so a repeated task cuts the table the same way and nothing
    is written.  ``order`` must end in a unique key: it keeps equal values apart, so
    one hot value spreads over many ranges.
    """
    finished(df, "positions")
    keyed, keys = _keyed(df, order)
    bounds = _bounds(keyed, keys, parts or _default_parts(df))
    held = keyed.withColumn(_PART, _part_of(keys, bounds))
    starts, before = [], 0
    for size in _part_sizes(held, len(bounds) + 1):
        starts.append(before)
        before += size
    within = Window.partitionBy(_PART).orderBy(*sort_columns(keys))
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col(_PART) + 1)
    place = start + F.row_number().over(within)
    return held.select(*[quoted(c) for c in df.columns], place.alias(name))


def stretch(
    df: DataFrame, order: list[Key], first: int, last: int, enough: int, parts: int | None = None
) -> tuple[DataFrame, int]:
    """Rows around the places ``first`` to ``last`` (from 1), and how many come before them.

    The stretch is narrowed until it holds little more than the places asked for, or
    ``enough`` rows: a sample gives the bounds of ranges within it, one pass counts
    their rows, and the ranges that hold the places are the next stretch.  Each pass
    cuts a stretch to about a ``parts``-th.  Nothing is sorted but the samples, and
    the counts are exact, so an unlucky sample costs another pass at most.
    """
    finished(df, "a page")
    keyed, keys = _keyed(df, order)
    skipped, size = 0, None
    while size is None or size > max(enough, 2 * (last - first + 1)):
        bounds = _bounds(keyed, keys, parts or _default_parts(df))
        sizes = _part_sizes(keyed.withColumn(_PART, _part_of(keys, bounds)), len(bounds) + 1)
        low, end = 0, skipped + sizes[0]
        while end < first and low < len(bounds):
            low += 1
            end += sizes[low]
        begin, high = end - sizes[low], low
        while end < last and high < len(bounds):
            high += 1
            end += sizes[high]
        if size is not None and end - begin >= size:
            break
        skipped, size = begin, end - begin
        if low:
            keyed = keyed.filter(~comes_before(keys, bounds[low - 1]))
        if high < len(bounds):
            keyed = keyed.filter(comes_before(keys, bounds[high]))
    return keyed.drop(*[f"{_KEY}{i}" for i in range(len(order))]), skipped


def _keyed(df: DataFrame, order: list[Key]) -> tuple[DataFrame, list[Key]]:
    """The frame with its sort keys as columns, and these as keys."""
    names = [f"{_KEY}{i}" for i in range(len(order))]
    keyed = df.withColumns({n: k.expr for n, k in zip(names, order)})
    return keyed, [Key(F.col(n), k.descending) for n, k in zip(names, order)]


def _default_parts(df: DataFrame) -> int:
    return max(1, min(MOST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _bounds(keyed: DataFrame, keys: list[Key], parts: int) -> list[list]:
    """Keys of up to ``parts - 1`` rows, in order, that cut the table about evenly.

    Only the leading keys whose values can be written into a plan are used: a row
    never stands before one with smaller leading keys, so that is an order still.
    """
    usable = 0
    for i in range(len(keys)):
        if not isinstance(keyed.schema[f"{_KEY}{i}"].dataType, _LITERAL_TYPES):
            break
        usable += 1
    if not usable or parts < 2:
        return []
    columns = [F.col(f"{_KEY}{i}") for i in range(usable)]
    # The rows with the smallest random numbers: each task keeps no more than these.
    sample = keyed.select(*columns).orderBy(F.rand(17)).limit(parts * SAMPLES_PER_PART)
    rows = [list(r) for r in sample.orderBy(*sort_columns(keys[:usable])).collect()]
    picked = [rows[len(rows) * i // parts] for i in range(1, parts)] if rows else []
    return [b for i, b in enumerate(picked) if not i or b != picked[i - 1]]


def _part_of(keys: list[Key], bounds: list[list]) -> Column:
    """How many bounds a row does not stand before, by halving."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        early = comes_before(keys, bounds[middle])
        return F.when(early, among(low, middle)).otherwise(among(middle + 1, high))

    return among(0, len(bounds))


def _part_sizes(held: DataFrame, parts: int) -> list[int]:
    """Rows in each part: one number per part comes to the driver."""
    sizes = {r[_PART]: r["size"] for r in held.groupBy(_PART).agg(F.count("*").alias("size")).collect()}
    return [sizes.get(i, 0) for i in range(parts)]


def comes_before(order: list[Key], values: list) -> Column:
    """The row stands before a row with these (leading) key values; never null."""
    result, equal = F.lit(False), F.lit(True)
    for key, value in zip(order, values):
        c, limit = key.expr, F.lit(value)
        if key.descending:
            closer = c.isNotNull() if value is None else F.coalesce(c > limit, F.lit(False))
        else:
            closer = F.lit(False) if value is None else F.coalesce(c < limit, F.lit(True))
        result = result | (equal & closer)
        equal = equal & c.eqNullSafe(limit)
    return result
