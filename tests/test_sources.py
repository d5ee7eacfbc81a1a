"""Ingest, export, saved views, shapes and streams."""

import csv
import glob

import pytest
from pyspark.sql import functions as F

from tablewright.operators import shape
from tablewright.operators.rules import Field, RecordRules
from tablewright.operators.validate import VALID, read_validated
from tablewright.plans import views
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, DownloadSpec, GridSpec, SortKey
from tablewright.sources import export
from tablewright.sources.ingest import REJECTS, Repair, Typed, ingest
from tablewright.sources.tables import (
    read_table,
    rows_from_arrays,
    rows_from_json,
    rows_from_literals,
)
from tablewright.streaming.stateless import NeedsWholeTable, stream_rows, stream_validated

# The shape of a proof table as it arrives: two headers swapped, the last column
# never filled, and rows whose code is fused into the text before it.
HEADERS = ["no", "defects", "name", "haplotype", "month", "milk", "fat", "sire", "aaa", "dms", "note"]
PROOFS = [
    ["K1", "Meadow", None, "Q1", "202412", "1248", 0.06, "Oak x Birch {6}", None, None],
    ["K2", "Harbor", "AB CD", "Q1 Q7", 202412, 897, ".2", "Elm x Ash", 234165, "126,561"],
    ["K3", "Lantern", None, "Q1 Q2", "202412", -20, 0.1, "Fir x Yew x Larch N400,243", "561,126"],
    ["K4", "Pebble", "AB", "Q1", "n/a", "x", None, "Hazel x  x Rowan", 243, None],
]


@pytest.fixture(scope="module")
def proofs(spark):
    columns = [*HEADERS[:-1], ColumnSpec("note", synthetic=True)]
    return rows_from_literals(spark, PROOFS, columns)


def test_short_rows_leave_nulls(proofs):
    rows = proofs.orderBy("_row_id").collect()
    assert rows[2]["dms"] is None and rows[2]["aaa"] == "561,126"
    assert [r["note"] for r in rows] == [None] * 4
    assert [r["_row_id"] for r in rows] == [0, 1, 2, 3]


def test_extra_elements_are_dropped(spark):
    df = spark.sql("select 1 id, array('a', 'b', 'c') cells")
    assert tuple(rows_from_arrays(df, "cells", ["x", "y"]).first()) == (1, "a", "b")


def test_typed_ingest_repairs_and_reports(proofs):
    fused = Repair(
        "sire RLIKE ',[0-9]{3}$'",
        (
            ("sire", "regexp_replace(sire, ' ?N?[0-9]+,[0-9]{3}$', '')"),
            ("aaa", "regexp_extract(sire, '([0-9]+,[0-9]{3})$', 1)"),
            ("dms", "aaa"),
        ),
    )
    typed = ingest(
        proofs,
        [
            Typed("no"),
            Typed("name", "defects"),  # the headers are swapped
            Typed("defects", "name", split_on=" "),
            Typed("haplotype", split_on=" "),
            Typed("month", dtype="int"),
            Typed("milk", dtype="int"),
            Typed("fat", dtype="double"),
            Typed("sires", "sire", split_on="x "),
            Typed("aaa"),
            Typed("dms", split_on=","),
        ],
        [fused],
        keep=["_row_id"],
    )
    rows = [r.asDict() for r in typed.orderBy("_row_id").collect()]
    assert [r["name"] for r in rows] == ["Meadow", "Harbor", "Lantern", "Pebble"]
    assert [r["defects"] for r in rows] == [None, ["AB", "CD"], None, ["AB"]]
    assert [r["month"] for r in rows] == [202412, 202412, 202412, None]
    assert [r["milk"] for r in rows] == [1248, 897, -20, None]
    assert [r["fat"] for r in rows] == [0.06, 0.2, 0.1, None]
    assert (rows[2]["aaa"], rows[2]["dms"]) == ("400,243", ["561", "126"])
    assert rows[2]["sires"] == ["Fir", "Yew", "Larch"]
    assert rows[3]["sires"] == ["Hazel", "Rowan"]
    assert [r[REJECTS] for r in rows] == [[], [], [], ["month", "milk"]]


def test_ingest_reads_iso_times(spark):
    df = spark.createDataFrame([("2024-01-31T10:00Z",), ("soon",), ("",)], "t string").coalesce(1)
    typed = ingest(df, [Typed("t", dtype="timestamp")])
    rows = typed.select(F.col("t").cast("string"), REJECTS).collect()
    assert [tuple(r) for r in rows] == [("2024-01-31 10:00:00", []), (None, ["t"]), (None, [])]


def test_json_paths(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":"x"},"c.d":2}'), (2, "bad"), (3, None)], "id int, j string")
    rows = rows_from_json(df, "j", ["a/b", "a/z/y", "c.d"], "/").orderBy("id").collect()
    assert [tuple(r)[1:] for r in rows] == [("x", None, "2"), (None, None, None), (None, None, None)]


def test_top_level_json_fields_are_parsed_together(spark):
    texts = ['{"a":1,"b":"x","c":[1,2],"d":{"e":null,"f":true}}', '{"b":null}', "bad", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    got = rows_from_json(df, "j", ["b", "a", "c", "d.f", "d"])
    assert got.columns == ["id", "b", "a", "c", "d.f", "d"]
    one_by_one = {f: rows_from_json(df, "j", [f]).orderBy("id").collect() for f in got.columns[1:]}
    for i, row in enumerate(got.orderBy("id").collect()):
        assert tuple(row)[1:] == tuple(one_by_one[f][i][1] for f in got.columns[1:])
    assert tuple(got.orderBy("id").first()) == (0, "x", "1", "[1,2]", "true", '{"e":null,"f":true}')


def test_readers(spark, folder):
    df = spark.range(5).select("id", F.concat(F.lit("n"), "id").alias("n"))
    for fmt in ("parquet", "orc", "json", "csv"):
        df.write.format(fmt).save(f"{folder}/{fmt}")
        got = read_table(spark, f"{folder}/{fmt}", fmt, "id bigint, n string")
        assert sorted(got.collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        read_table(spark, f"{folder}/csv", "csv")
    with pytest.raises(ValueError):
        read_table(spark, folder, "xls")


# -- export ---------------------------------------------------------------------


def parts_text(folder):
    return "".join(
        open(p, encoding="utf8", newline="").read() for p in sorted(glob.glob(folder + "/part-*"))
    )


@pytest.fixture(scope="module")
def notes(spark):
    rows = [
        (0, 'a"b', -5, 2.0),
        (1, None, None, None),
        (2, "=x", 1, 0.5),
        (3, "-5", 2, 12345678.5),
        (4, "line\nfeed, +", 3, -1.0),
        (5, "@\"q", 4, 1e21),
    ]
    return spark.createDataFrame(rows, "id bigint, t string, n int, d double")


def test_csv_file_is_ordered_quoted_and_guarded(notes, folder):
    spec = GridSpec(
        columns=(ColumnSpec("id", label="+key"), "t", "n", ColumnSpec("d", display="false")),
        row_id="id",
        filters={"n": (1,)},
        sorts=(SortKey("id", "desc"),),
    )
    out = export.write_csv(Grid(notes, spec), folder)
    assert out == folder + "/tableDownload.csv"
    lines = parts_text(out).split("\r\n")
    assert lines == [
        '"\'+key","t","n","d"',
        '"5","\'@""q","4","1e+21"',
        '"4","line\nfeed, +","3","-1"',
        '"3","\'-5","2","12345678.5"',
        '"2","\'=x","1","0.5"',
        '"1","","",""',
        '"0","a""b","-5","2"',
        "",
    ]
    parsed = list(csv.reader(lines[1:2]))
    assert parsed == [["5", "'@\"q", "4", "1e+21"]]


def test_csv_of_many_parts_stays_in_order(spark, folder):
    df = spark.range(3000).repartition(6).withColumn("k", F.col("id") % 7)
    grid = Grid(df, GridSpec(columns=("k", "id"), row_id="id", sorts=(SortKey("k", "desc"),)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = export.write_csv(grid, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(out + "/part-*")) > 1
    rows = list(csv.reader(parts_text(out).split("\r\n")[:-1]))
    want = sorted(((i % 7, i) for i in range(3000)), key=lambda t: (-t[0], t[1]))
    assert rows == [["k", "id"], *[[str(k), str(i)] for k, i in want]]


def test_export_hook_may_change_or_cancel(notes, folder):
    grid = Grid(notes, GridSpec(columns=("id",), row_id="id"))
    assert export.write_csv(grid, folder + "/no", lambda lines: False) is None
    assert not glob.glob(folder + "/no")
    out = export.write_csv(grid, folder, lambda lines: lines.filter("line <> '\"3\"'"))
    assert parts_text(out).count("\r\n") == 6


def test_displayed_rows_and_columns_only(notes):
    spec = GridSpec(
        columns=("id", ColumnSpec("t", derive="upper(t)"), ColumnSpec("n", display="excluded"),
                 ColumnSpec("d", derive_late="'shown'")),
        row_id="id",
        filters={"t": ("=X",)},
        download=DownloadSpec(separator=";;", displayed_rows_only=True, displayed_columns_only=True),
    )
    lines = [r["line"] for r in export.csv_lines(Grid(notes, spec)).collect()]
    assert lines == ['"2";;"\'=X";;"0.5"']
    frame = export.csv_frame(Grid(notes, spec))
    head = frame.rows.filter("_tw_head = 0").select(frame.line).first()["line"]
    assert head == '"id";;"t";;"d"'


# -- views ----------------------------------------------------------------


def test_views_are_saved_and_restored(spark, notes, folder):
    spec = GridSpec(columns=("id", "t"), row_id="id", filters={"t": ("=x", None)}, search_text="2")
    views.save_view(spark, folder, "mine", spec)
    views.save_view(spark, folder, "mine", spec.close_search())
    restored = views.load_view(spark, folder, "mine")
    assert restored == spec.close_search()
    views.register_view(notes, restored, "mine")
    assert spark.sql("SELECT count(*) FROM mine").first()[0] == 2


# -- shapes ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, snake, camel",
    [
        ("fooBar", "foo_bar", "fooBar"), ("FooBAR", "foo_bar", "fooBar"),
        ("foo_bar baz", "foo_bar_baz", "fooBarBaz"), ("XMLHttp", "xml_http", "xmlHttp"),
        ("a1B2", "a_1_b_2", "a1B2"), ("--x--", "x", "x"), ("Élan vital", "élan_vital", "élanVital"),
        ("번호 ID", "번호_id", "번호Id"), ("1st Place", "1st_place", "1stPlace"), ("", "", ""),
        ("don't stop", "don't_stop", "don'tStop"), ("they\u2019ve", "they\u2019ve", "they\u2019ve"),
        ("o'clock", "o_clock", "oClock"), ("4TH row", "4th_row", "4thRow"), ("x2th", "x_2_th", "x2Th"),
    ],
)
def test_names(name, snake, camel):
    assert (shape.snake_case(name), shape.camel_case(name)) == (snake, camel)
    assert shape.constant_case(name) == snake.upper()


def test_column_lists(spark):
    df = spark.sql("select 1 a, 2 b, 3 c")
    assert shape.pick(df, ["c", "a", "x"]).columns == ["a", "c"]
    assert shape.omit(df, ["c", "x"]).columns == ["a", "b"]
    assert shape.rename(df, "a", "z").columns == ["z", "b", "c"]
    assert shape.rename(df, "x", "z").columns == ["a", "b", "c"]
    assert shape.rename(df, "a", "b").first().asDict() == {"b": 1, "c": 3}
    assert shape.rename(df, "a", "z", keep_old=True).first().asDict() == {"a": 1, "b": 2, "c": 3, "z": 1}
    with pytest.raises(ValueError):
        shape.rename_all(spark.sql("select 1 `a b`, 2 `a_b`"), shape.snake_case)


def test_json_that_does_not_fit(spark):
    texts = ['{"k":1}', '{"k":"x"}', "bad", None, "{}", '{"k":2,"z":3}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = shape.parse_json(df, "t", "k INT", "p", "bad").orderBy("id").collect()
    assert [r["bad"] for r in rows] == [False, True, True, False, False, False]
    assert [r["p"] and r["p"]["k"] for r in rows] == [1, None, None, None, None, 2]
    assert rows[4]["p"] is not None and rows[3]["p"] is None


# -- streams -----------------------------------------------------------------------


def test_stream_gives_the_rows_of_the_batch(spark, tables, folder):
    schema = spark.read.parquet(f"{tables}/customer.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{tables}/customer.parquet*")
    batch = spark.read.parquet(f"{tables}/customer.parquet")
    spec = GridSpec(
        columns=("c_custkey", ColumnSpec("c_name", derive="lower(c_name)"), "c_mktsegment"),
        row_id="c_custkey",
        filters={"c_mktsegment": ("BUILDING",)},
        search_text="CUSTOMER#",
        pagination=False,
    )
    query = (
        stream_rows(stream, spec)
        .writeStream.format("parquet")
        .option("checkpointLocation", folder + "/state")
        .trigger(availableNow=True)
        .start(folder + "/out")
    )
    query.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(folder + "/out").collect())
    assert got == sorted(tuple(r) for r in Grid(batch, spec).rows().collect()) and got


def test_stream_is_validated_once(spark, tables, folder):
    schema = spark.read.parquet(f"{tables}/orders.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{tables}/orders.parquet*")
    rules = RecordRules((Field("o_orderstatus").one_of(["F", "O"]),))
    query = stream_validated(stream, rules, folder + "/out", folder + "/state")
    query.awaitTermination(120)
    out = read_validated(spark, folder + "/out")
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    assert out.count() == orders.count()
    assert out.filter(~F.col(VALID)).count() == orders.filter("o_orderstatus = 'P'").count()


def test_streams_refuse_what_needs_the_whole_table(spark, tables):
    schema = spark.read.parquet(f"{tables}/region.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{tables}/region.parquet*")
    spec = GridSpec(columns=("r_name",), row_id="r_regionkey", pagination=False)
    for wrong in (
        spec.sort_by("r_name"),
        GridSpec(columns=("r_name",), row_id="r_regionkey"),
        GridSpec(columns=("r_name",), pagination=False),
    ):
        with pytest.raises(NeedsWholeTable):
            stream_rows(stream, wrong)
