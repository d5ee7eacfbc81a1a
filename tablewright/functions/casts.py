"""Casts that give null for a cell that does not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark reports a text that is no integer or boolean by an exception, which costs
# some 20 microseconds a cell even when ``try_cast`` catches it.  Texts that
# cannot fit are sorted out by these patterns first.
_INTEGER = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*\z"
#: Decimals beyond the target's that are looked at.
_MORE_DECIMALS = 12
_BOOLEAN = r"(?i)^[\x00-\x20]*(?:t|true|y|yes|1|f|false|n|no|0)[\x00-\x20]*\z"


def tolerant_cast(c: Column, source: T.DataType, target: str) -> Column:
    """``try_cast`` that also gives null where the cell would become another value.

    1.9 is no ``int`` and ``12.345`` no ``decimal(10,2)``: a number must come back from
    the cast as it was, a moment too when it becomes a date.  Binary fractions are
    rounded to the target's precision, as any text of them is.  Stays fast on columns
    with many misfits.
    """
    wanted = T.DataType.fromDDL(target)
    cast = c.try_cast(target)
    if isinstance(source, T.StringType):
        if isinstance(wanted, T.IntegralType):
            return F.when(c.rlike(_INTEGER), cast)
        if isinstance(wanted, T.BooleanType):
            return F.when(c.rlike(_BOOLEAN), cast)
        if isinstance(wanted, T.DecimalType):
            # With all the decimals a text can have here, nothing may be left over.
            scale = min(38, wanted.scale + _MORE_DECIMALS)
            full = c.try_cast(T.DecimalType(38, max(scale, wanted.scale)))
            return F.when(full.isNull() | (full == cast), cast)
        return cast
    exact = isinstance(wanted, (T.IntegralType, T.DecimalType, T.BooleanType))
    if isinstance(source, T.NumericType) and exact:
        return F.when(cast.cast(source) == c, cast)
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(wanted, T.DateType):
        return F.when(cast.cast(source) == c, cast)
    return cast
