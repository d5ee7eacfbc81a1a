"""Operators against small models in plain Python, on generated tables."""

import csv
import io
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.functions import text
from tablewright.operators.facets import facet_values, ordered_facets
from tablewright.operators.rules import Field, RecordRules
from tablewright.operators.validate import VIOLATIONS, annotate, rejected_rows, valid_rows
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec
from tablewright.sources.export import csv_lines
from tablewright.sources.literals import small_frame

few = settings(
    max_examples=6,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
words = st.text(alphabet="abAB01 _%\"',;+-=@\n", max_size=6)
cells = st.one_of(st.none(), words)
tables_ = st.lists(
    st.tuples(cells, st.one_of(st.none(), st.integers(-99, 99)), st.lists(cells, max_size=3)),
    min_size=1,
    max_size=40,
)
SCHEMA = "id bigint, t string, n int, a array<string>"
COLUMNS = ("id", "t", "n", "a")


def frame(spark, rows):
    return small_frame(spark, [(i, *row) for i, row in enumerate(rows)], SCHEMA)


def plain(value):
    if value is None:
        return ""
    if isinstance(value, list):
        return ",".join(plain(v) for v in value)
    return str(value)


def kept(spark, rows, **options):
    grid = Grid(frame(spark, rows), GridSpec(columns=COLUMNS, row_id="id", **options))
    return sorted(r["id"] for r in grid.displayed.select("id").collect())


@few
@given(rows=tables_, wanted=words.filter(bool))
def test_search(spark, rows, wanted):
    def found(row, i):
        return any(wanted.lower() in plain(v).lower() for v in (i, *row))

    want = [i for i, row in enumerate(rows) if found(row, i)]
    assert kept(spark, rows, search_text=wanted) == want


@few
@given(rows=tables_, chosen=st.lists(cells, min_size=1, max_size=3), every=st.booleans())
def test_filters(spark, rows, chosen, every):
    plain_column = [i for i, row in enumerate(rows) if row[0] in chosen]
    assert kept(spark, rows, filters={"t": tuple(chosen)}) == plain_column
    test = all if every else any
    arrays = [i for i, row in enumerate(rows) if test(v in row[2] for v in chosen)]
    assert kept(spark, rows, filters={"a": tuple(chosen)}, array_match_all=every) == arrays


@few
@given(rows=tables_)
def test_facets(spark, rows):
    want = {}
    for i, (t, n, a) in enumerate(rows):
        for column, value in (("t", t), ("n", None if n is None else str(n)), *[("a", v) for v in a]):
            want.setdefault((column, value), i)
    spec = GridSpec(columns=(ColumnSpec("id", filterable=False), "t", "n", "a"), row_id="id")
    got = facet_values(Grid(frame(spark, rows), spec)).collect()
    assert {(r["column"], r["value"]): r["first_seen"] for r in got} == want
    assert len(got) == len(want)


@few
@given(names=st.lists(st.text(alphabet="abAB0129", max_size=6), min_size=1, max_size=40))
def test_natural_order(spark, names):
    def key(name):
        runs = re.findall(r"[0-9]+|[^0-9]", name)
        return [(0, int(r), "") if r.isdigit() else (1, 0, r.lower()) for r in runs]

    first_seen = {name: i for i, name in reversed(list(enumerate(names)))}
    df = small_frame(spark, list(enumerate(names)), "id bigint, t string")
    spec = GridSpec(columns=(ColumnSpec("id", filterable=False), "t"), row_id="id")
    got = [r["value"] for r in ordered_facets(Grid(df, spec)).orderBy("pos").collect()]
    assert got == sorted(first_seen, key=lambda name: (key(name), first_seen[name]))


@few
@given(rows=tables_)
def test_exported_lines_read_back(spark, rows):
    grid = Grid(frame(spark, rows), GridSpec(columns=COLUMNS, row_id="id"))
    for r in csv_lines(grid).collect():
        (cells_read,) = csv.reader(io.StringIO(r["line"], newline=""))
        t, n, a = rows[r["id"]]
        guarded = "'" + t if t and t[0] in "+-=@" else plain(t)
        assert cells_read == [str(r["id"]), guarded, plain(n), plain(a)]


@few
@given(
    numbers=st.lists(
        st.builds(lambda m, e: float(f"{m}e{e}"), st.integers(-(10**9), 10**9), st.integers(-12, 9)),
        min_size=20,
        max_size=60,
    )
)
def test_number_texts(spark, numbers):
    def shortest(x):
        if x == 0:
            return "0"
        sign, digits, exponent = "-" if x < 0 else "", *re.match(r"([\d.]+)e([+-]\d+)", f"{abs(x):.16e}").groups()
        for places in range(17):
            digits, exponent = re.match(r"([\d.]+)e([+-]\d+)", f"{abs(x):.{places}e}").groups()
            if float(f"{digits}e{exponent}") == abs(x):
                break
        digits, exponent = digits.replace(".", "").rstrip("0"), int(exponent)
        if exponent < -6 or exponent > 20:
            body = digits[0] + ("." + digits[1:] if digits[1:] else "") + f"e{exponent:+d}"
        elif exponent < 0:
            body = "0." + "0" * (-exponent - 1) + digits
        elif len(digits) <= exponent + 1:
            body = digits + "0" * (exponent + 1 - len(digits))
        else:
            body = digits[: exponent + 1] + "." + digits[exponent + 1 :]
        return sign + body

    df = small_frame(spark, list(enumerate(numbers)), "id bigint, x double")
    got = df.select("id", text.number_text(F.col("x")).alias("t")).collect()
    assert {r["id"]: r["t"] for r in got} == {i: shortest(x) for i, x in enumerate(numbers)}


@few
@given(rows=tables_)
def test_valid_and_rejected_make_up_the_table(spark, rows):
    rules = RecordRules(
        (
            Field("t").trim().one_of(["", "a", "b", "ab"]).max(1).required(),
            Field("n", "int").when("t", "a", then=lambda f: f.non_nullable()),
        )
    )
    df = frame(spark, rows)
    valid = {r["id"] for r in valid_rows(df, rules).collect()}
    rejected = {r["id"] for r in rejected_rows(df, rules).collect()}
    assert valid | rejected == set(range(len(rows))) and not valid & rejected
    for r in annotate(df, rules).collect():
        t, n, _ = rows[r["id"]]
        t = None if not t else t.strip(" \n")
        want = []
        if t is None:
            want.append("required")
        elif t not in ("", "a", "b", "ab"):
            want.append("one_of")
        else:
            want += ["max"] * (len(t) > 1) + ["required"] * (t == "")
        if t == "a" and n is None:
            want.append("not_null")
        assert [v["rule"] for v in r[VIOLATIONS]] == want
