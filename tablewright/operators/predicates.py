"""Column filters and free-text search as boolean column expressions.

The predicates are meant for ``filter``: an unknown outcome drops the row, so
plain comparisons stay bare and can be pushed down to the scan.
"""

from __future__ import annotations

import datetime as dt
import decimal
import struct
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import contains_text, raw_text

#: Which Python values can equal a cell of a type at all.  Matching is strict:
#: the text "477" never equals the number 477.
_COMPARABLE = (
    (T.BooleanType, (bool,)),
    (T.StringType, (str,)),
    (T.NumericType, (int, float, decimal.Decimal)),
    (T.DateType, (dt.date,)),
    ((T.TimestampType, T.TimestampNTZType), (dt.datetime,)),
)


def comparable(value, dtype: T.DataType) -> bool:
    """Whether a chosen value can match a cell of this type."""
    if isinstance(value, float) and value != value:
        return False
    for types, classes in _COMPARABLE:
        if isinstance(dtype, types):
            if isinstance(value, bool) and bool not in classes:
                return False
            return isinstance(value, classes)
    return False


def as_held(value, dtype: T.DataType):
    """The value as a cell of this type would hold it; None where no cell can equal it.

    A value that a cast would change equals no cell: 0.5 is no bigint, 12.345 no
    ``decimal(10,2)``, and a number beyond a type's range is none of that type.
    """
    if value is None or not comparable(value, dtype):
        return None
    if isinstance(dtype, T.DateType):
        return None if isinstance(value, dt.datetime) else value
    if not isinstance(dtype, T.NumericType):
        return value
    if isinstance(value, (float, decimal.Decimal)) and not decimal.Decimal(value).is_finite():
        return float(value) if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType) else None
    exact = decimal.Decimal(value)
    if isinstance(dtype, T.DecimalType):
        with decimal.localcontext(prec=400):
            held = exact.quantize(decimal.Decimal(1).scaleb(-dtype.scale), rounding=decimal.ROUND_HALF_EVEN)
        # A double is meant by its shortest digits: 0.1 is a tenth.
        shown = decimal.Decimal(repr(value)) if isinstance(value, float) else exact
        return held if held == shown and abs(held) < decimal.Decimal(10) ** (dtype.precision - dtype.scale) else None
    if isinstance(dtype, T.IntegralType):
        bits = 8 * {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4}.get(type(dtype), 8)
        return int(exact) if exact == int(exact) and -(1 << bits - 1) <= exact < 1 << bits - 1 else None
    if isinstance(dtype, T.FloatType):
        try:
            held = struct.unpack("f", struct.pack("f", float(value)))[0]
        except OverflowError:
            return None
    else:
        held = float(value)
    return held if decimal.Decimal(held) == exact else None


def one_of(c: Column, values: tuple, dtype: T.DataType) -> Column:
    """The cell equals one of the chosen values; null matches a chosen null."""
    wanted = [v for v in (as_held(v, dtype) for v in values) if v is not None]
    found = c.isin(*wanted) if wanted else F.lit(False)
    return found | c.isNull() if None in values else found


def array_has(c: Column, values: tuple, dtype: T.ArrayType, match_all: bool) -> Column:
    """The array cell holds every chosen value, or any of them.

    A null cell is no array: it matches a chosen null only.
    """
    element = dtype.elementType

    def has(v) -> Column:
        if v is None:
            return F.exists(c, lambda x: x.isNull())
        held = as_held(v, element)
        if held is None:
            return F.lit(False)
        return F.coalesce(F.array_contains(c, F.lit(held).cast(element)), F.lit(False))

    held = reduce(and_ if match_all else or_, [has(v) for v in values])
    return F.when(c.isNull(), F.lit(None in values)).otherwise(held)


def text_filter(c: Column, values: tuple, dtype: T.DataType, case_sensitive: bool) -> Column:
    """The cell's text contains the filter text."""
    wanted = ",".join("" if v is None else str(v) for v in values)
    return search([(c, dtype)], wanted, case_sensitive)


def search(
    cells: list[tuple[Column, T.DataType]], text: str, case_sensitive: bool = False
) -> Column:
    """Any of the cells' texts contains the search text.

    An absent cell holds the empty text only, so it needs no care here.
    """
    if not text:
        return F.lit(bool(cells))
    tests = [contains_text(raw_text(c, t), text, case_sensitive) for c, t in cells]
    return reduce(or_, tests) if tests else F.lit(False)


def keep_unless(dropped: Column) -> Column:
    """Turn a drop test into a keep test; an unknown outcome keeps the row."""
    return ~F.coalesce(dropped, F.lit(False))
