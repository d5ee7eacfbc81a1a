"""Text of a cell, text tests and text sort keys, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def trimmed(c: Column) -> Column:
    """Drop Unicode white space at both ends (Spark's ``trim`` drops blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 units: a character outside the base plane counts twice."""
    return F.floor(F.octet_length(F.encode(c, "UTF-16BE")) / F.lit(2)).cast("int")


#: Whole numbers below this have one exact text as integers and as doubles.
_EXACT_WHOLE = 2.0**53


def number_text(c: Column) -> Column:
    """Shortest plain text of a floating-point number.

    ``2.0`` becomes ``2`` and ``1.23456785E7`` becomes ``12345678.5``; an exponent
    is kept only below 1e-6 and from 1e21 on, written ``1e-7`` and ``1e+21``.
    The common sizes come first, as cheap tests, because this runs on every cell
    that is searched or exported.
    """
    text = c.cast("string")
    size = F.abs(c)
    whole = F.endswith(text, F.lit(".0"))
    scientific = F.replace(F.replace(text, F.lit(".0E"), F.lit("E")), F.lit("E-"), F.lit("e-"))
    return (
        F.when(
            (size >= 1e-3) & (size < 1e7),
            F.when(whole, F.substring_index(text, ".", 1)).otherwise(text),
        )
        .when(c == 0, F.lit("0"))
        .when((size < _EXACT_WHOLE) & (c == F.floor(c)), c.cast("bigint").cast("string"))
        # At most 17 digits are significant, so these decimals hold the text exactly.
        .when((size >= 1) & (size < 1e21), _fixed_text(text.try_cast("decimal(38,16)")))
        .when((size < 1) & (size >= 1e-6), _fixed_text(text.try_cast("decimal(38,30)")))
        .otherwise(F.replace(scientific, F.lit("E"), F.lit("e+")))
    )


def _fixed_text(c: Column) -> Column:
    """Text of a decimal without trailing zeros in its fraction."""
    text = c.cast("string")
    bare = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.when(c == 0, F.lit("0")).when(F.contains(text, F.lit(".")), bare).otherwise(text)


def raw_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a cell; null stays null."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return number_text(c)
    if isinstance(dtype, T.DecimalType):
        return _fixed_text(c)
    if isinstance(dtype, T.ArrayType):
        return F.concat_ws(",", F.transform(c, lambda x: cell_text(x, dtype.elementType)))
    if isinstance(dtype, (T.StructType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def cell_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a cell as search and text filters see it; null is empty text."""
    return F.coalesce(raw_text(c, dtype), F.lit(""))


def contains_text(text: Column, wanted: str, case_sensitive: bool = False) -> Column:
    """Substring test; ``%`` and ``_`` have no special meaning."""
    if case_sensitive:
        return F.contains(text, F.lit(wanted))
    return F.contains(F.lower(text), F.lower(F.lit(wanted)))


def _sized(digits: Column) -> Column:
    """A digit run as its length (without leading zeros) followed by the digits."""
    significant = F.ltrim(digits, F.lit("0"))
    return F.concat(F.lpad(F.length(significant).cast("string"), 10, "0"), significant)


def natural_key(text: Column) -> Column:
    """Sort key that orders digit runs by value and ignores case and accents.

    Each digit run is written as its length and the digits, so that text order
    equals number order at any length.  Plain numbers, the bulk of large facets,
    take a way without pattern matching per run; both ways give the same key.
    """

    def piece(p: Column) -> Column:
        return F.when(p.rlike("^[0-9]"), _sized(p)).otherwise(p)

    pieces = F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    any_text = F.array_join(F.transform(pieces, piece), "")

    sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    whole = F.ltrim(F.substring_index(text, ".", 1), F.lit("-"))
    fraction = F.concat(F.lit("."), _sized(F.substring_index(text, ".", -1)))
    fraction = F.when(F.contains(text, F.lit(".")), fraction).otherwise(F.lit(""))
    number = F.concat(sign, _sized(whole), fraction)
    is_number = text.rlike(r"^-?[0-9]+(?:\.[0-9]+)?\z")
    return F.collate(F.when(is_number, number).otherwise(any_text), "UNICODE_CI_AI")


def csv_cell(c: Column, dtype: T.DataType) -> Column:
    """Content between the quotes of one CSV cell.

    Quotes are doubled; then a *text* starting with ``+ - = @`` gets an
    apostrophe in front, so that no spreadsheet runs it as a formula.
    """
    escaped = F.replace(cell_text(c, dtype), F.lit('"'), F.lit('""'))
    if not isinstance(dtype, T.StringType):
        return escaped
    risky = F.substring(escaped, 1, 1).isin("+", "-", "=", "@")
    return F.when(risky, F.concat(F.lit("'"), escaped)).otherwise(escaped)


def csv_line(cells: list[Column], separator: str = ",") -> Column:
    """One quoted line, without its line end."""
    return F.concat(F.lit('"'), F.concat_ws(f'"{separator}"', *cells), F.lit('"'))
