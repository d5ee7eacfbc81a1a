"""Scalar functions against values worked out by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import dates, patterns, scalars, text
from tablewright.functions.casts import tolerant_cast


def apply(spark, values, kind, function):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").coalesce(1)
    return [r["o"] for r in df.select("i", function(F.col("v")).alias("o")).sort("i").collect()]


NUMBERS = {
    0.0: "0", 2.0: "2", -2.0: "-2", 100.0: "100", 0.1: "0.1", 12345678.5: "12345678.5",
    0.0001: "0.0001", -0.00012345: "-0.00012345", 1e-6: "0.000001", 1.5e-6: "0.0000015",
    1e-7: "1e-7", 1.25e-10: "1.25e-10", 1e7: "10000000", -1.5e7: "-15000000",
    12345678.125: "12345678.125", 123456789.12345678: "123456789.12345678",
    2.0**53: "9007199254740992", 2.0**63: "9223372036854776000",
    1e20: "100000000000000000000", 1e21: "1e+21", -1.5e21: "-1.5e+21",
    float("inf"): "Infinity", float("-inf"): "-Infinity",
}


def test_number_text(spark):
    got = apply(spark, list(NUMBERS), "double", text.number_text)
    assert got == list(NUMBERS.values())
    odd = [-0.0, float("nan"), None]
    assert apply(spark, odd, "double", text.number_text) == ["0", "NaN", None]


def test_cell_text_by_type(spark):
    row = spark.sql(
        """SELECT cast(2.50 AS decimal(9, 2)) d, cast(100 AS decimal(9, 0)) w, true b, 7 i,
                  cast(null AS string) n, array(1.0D, null, 2.5D) a, array('x', 'y') s,
                  named_struct('k', 1) o, date'2024-01-02' t, array(array(1, 2), array(3)) aa"""
    )
    cells = [text.cell_text(F.col(f.name), f.dataType).alias(f.name) for f in row.schema]
    assert tuple(row.select(*cells).first()) == (
        "2.5", "100", "true", "7", "", "1,,2.5", "x,y", '{"k":1}', "2024-01-02", "1,2,3",
    )


def test_trim_knows_unicode_blanks(spark):
    got = apply(spark, ["\t a b 　﻿\n", "", "​", None], "string", text.trimmed)
    assert got == ["a b", "", "​", None]


def test_utf16_length(spark):
    assert apply(spark, ["", "aé", "\U0001f600", None], "string", text.utf16_length) == [0, 2, 2, None]


def test_natural_key_handles_any_length_of_digits(spark):
    long = "9" * 40
    names = ["x" + long + "0", "x" + long, "x10", "x9", "x", "X9a"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["n"] for r in df.orderBy(text.natural_key(F.col("n"))).collect()]
    assert got == ["x", "x9", "X9a", "x10", "x" + long, "x" + long + "0"]


def test_mask_email(spark):
    cases = {"ab@x": "ab@x", "abc@x": "a*c@x", "abcdef@x@y": "a****f@x@y", "none": "none", "": "", "@x": "@x"}
    assert apply(spark, list(cases), "string", scalars.mask_email) == list(cases.values())


@pytest.mark.parametrize(
    "seconds, parts",
    [(0.0, (0, 0, 0, 0, 0)), (0.2, (1, 0, 0, 0, 1)), (59.5, (60, 0, 0, 1, 0)),
     (86400.0, (86400, 1, 0, 0, 0)), (93784.1, (93785, 1, 2, 3, 5))],
)
def test_duration_split(spark, seconds, parts):
    assert tuple(apply(spark, [seconds], "double", scalars.duration_split)[0]) == parts


def test_clock(spark):
    at = [0.0, 11 * 3600.0, 12 * 3600.0, 13 * 3600.0 + 61]
    half = [tuple(c) for c in apply(spark, at, "double", lambda c: scalars.clock(c, True))]
    assert half == [(0, 0, 0, "am"), (11, 0, 0, "am"), (0, 0, 0, "pm"), (1, 1, 1, "pm")]
    full = [tuple(c) for c in apply(spark, at, "double", scalars.clock)]
    assert full[3] == (13, 1, 1, "")


def test_seconds_until(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stamps = ["2024-01-01 00:00:01.5", "2023-12-31 23:59:59", None]

    def until(rounded):
        return lambda c: scalars.seconds_until(c.cast("timestamp"), now, rounded)

    assert apply(spark, stamps, "string", until(False)) == [1.5, 0.0, None]
    assert apply(spark, stamps, "string", until(True)) == [2.0, 0.0, None]
    since = apply(
        spark, stamps, "string", lambda c: scalars.seconds_since(c.cast("timestamp"), now)
    )
    assert since == [0.0, 1.0, None]


def test_strength(spark):
    cases = {"": 0, "abc": 0, "abcdef": 1, "abcdefgh": 2, "abcdefg1": 3, "abcdef1!": 4, "Abcdef1!": 5, "[]": 0}
    assert apply(spark, list(cases), "string", scalars.strength_score) == list(cases.values())
    labels = apply(spark, range(0, 7), "int", scalars.strength_label)
    assert labels == ["Poor", "Poor", "Weak", "Normal", "Good", "Strong", "Poor"]


DATES = {
    "2024-02-31": "2024-03-02 00:00:00", "2024": "2024-01-01 00:00:00",
    "20240315": "2024-03-15 00:00:00", "2024-01-01T10:20:30Z": "2024-01-01 10:20:30",
    "2024-01-01T10:20:30.5Z": "2024-01-01 10:20:30.005",
    "2024-01-01T10:20:30,123456Z": "2024-01-01 10:20:30.123",
    "2024-01-01T10:20+02:00": "2024-01-01 08:20:00", "2024-01-01T10:20-0230": "2024-01-01 12:50:00",
    "2024-13-01": "2025-01-01 00:00:00", "0050-01-01": "1950-01-01 00:00:00",
    "+002024-01-01": "2024-01-01 00:00:00", "2024-01-01 10:20": "2024-01-01 10:20:00",
    "2024-00-00": "2024-01-01 00:00:00", "2024-01-01T24:00:00Z": "2024-01-02 00:00:00",
    "+999999-01-01": None, "x": None, "": None, "2024-1-1": None, "2024-01-01\n": None,
}


def test_iso_timestamps(spark):
    got = apply(spark, list(DATES), "string", lambda c: dates.iso_timestamp(c).cast("string"))
    assert got == list(DATES.values())
    parts = apply(
        spark, list(DATES), "string", lambda c: dates.timestamp_of(dates.iso_parts(c)).cast("string")
    )
    assert parts == got
    millis = apply(spark, list(DATES), "string", lambda c: dates.millis_of(dates.iso_parts(c)))
    assert [dates.iso_millis_of(text) for text in DATES] == millis


MANY = 30_000


@pytest.mark.parametrize(
    "value, good",
    [
        ("a@b", True), ("a@b.c", True), (".@x", True), ("a@", False), ("@b", False), ("a@b..c", False),
        ("a@-b", False), ("a@b-", False), ("a@b.-c", False), ("a@b-.c", False), ("a@b.", False),
        ("a b@c", False), ("a@b\n", False), ("a@@b", False), ("a@" + "x" * 63, True),
        ("a@" + "x" * 64, False), ("a@" + "x" * 63 + "." + "y" * 64, False),
        ("a@" + "b." * MANY + "c", True), ("a" * MANY + "@b", True),
    ],
)
def test_email(spark, value, good):
    assert apply(spark, [value], "string", lambda c: c.rlike(patterns.EMAIL)) == [good]


@pytest.mark.parametrize(
    "value, good",
    [
        ("http://a.b", True), ("//a.b/", True), ("HTTPS://A.B", True), ("http://1.2.3.4:80/", True),
        ("ftp://u:p@a.b:80/x/y?q=1#f", True), ("http://a.b?x=1/2?", True), ("http://a.b.", True),
        ("http://ex-ample.com:", True), ("http://é.fr/ü", True), ("http://a.b/%41", True),
        ("http://a.b/x//y", True), ("http://a", False), ("a.b", False), ("htt://a.b", False),
        ("http://a.b//x", False), ("http://a.b/%4", False), ("http://a.b/%zz", False),
        ("http://256.2.3.4", False), ("http://-a.b", False), ("http://a-.b", False),
        ("http://a.b/x y", False), ("http://a.b\n", False), ("http://a.b#x#y", False),
        ("http://" + "a." * MANY + "b", True), ("http://a.b/" + "%41/" * MANY, True),
        ("http://" + "a." * 2000 + "1", False),
    ],
)
def test_url(spark, value, good):
    assert apply(spark, [value], "string", lambda c: c.rlike(patterns.URL)) == [good]


def test_uuid(spark):
    cases = {
        "123e4567-e89b-12d3-a456-426614174000": True,
        "123E4567-E89B-52D3-B456-426614174000": True,
        "00000000-0000-0000-0000-000000000000": True,
        "123e4567-e89b-62d3-a456-426614174000": False,
        "123e4567-e89b-12d3-c456-426614174000": False,
        "123e4567e89b12d3a456426614174000": False,
    }
    got = apply(spark, list(cases), "string", lambda c: c.rlike(patterns.UUID))
    assert got == list(cases.values())


def test_tolerant_casts_equal_plain_ones(spark):
    texts = ["1", " 12 ", "+3", "-4\t", "5.0", "1e3", "", "x", "99999999999999999999", "True", "y", "no", "2", None]
    for kind in ("tinyint", "int", "bigint", "boolean", "double", "decimal(9,2)", "date"):
        plain = apply(spark, texts, "string", lambda c: c.try_cast(kind))
        got = apply(spark, texts, "string", lambda c: tolerant_cast(c, T.StringType(), kind))
        assert got == plain, kind
