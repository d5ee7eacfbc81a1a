"""What is stored for a view gives the view's own results, and spares reading."""

from __future__ import annotations

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import facet_counts as counts
from tablewright.operators.facet_refresh import counted_facets, update_with_facets
from tablewright.operators.predicates import as_held
from tablewright.operators.rowset import MAX_LISTED_KEYS, delete_rows, select_rows
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec, SortKey, SpecError
from tablewright.sources.listing import files_of, fingerprint
from tablewright.sources.order_index import build_order_index, indexed_page, indexed_page_info
from tablewright.sources.text_index import build_text_index, files_with, indexed_grid

WORDS = ["Amber", "STRASSE", "straße", "ΟΔΟΣ", "οδοσα", "İstanbul", "naïve", "x", "", None, "𝒳𝒴𝒵", "a%b_c", "12.50", "tab\tline\n"]


def texts(spark, folder, files=9, rows=20):
    """A table in files, most of whose words stand in one file only."""
    random.seed(5)
    data = []
    for f in range(files):
        for i in range(rows):
            word = random.choice(WORDS)
            data.append((f * rows + i, f"file{f}" if i == 3 else word, f * 1000.5 + i, f))
    path = f"{folder}/texts"
    frame = spark.createDataFrame(data, "id long, word string, amount double, f int")
    frame.repartitionByRange(files, "f").drop("f").write.parquet(path)
    return path


SPEC = GridSpec(columns=("id", "word", "amount"), row_id="id")


def same_rows(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("cased", [False, True])
def test_search_gives_the_same_rows(spark, folder, cased):
    path, index = texts(spark, folder), f"{folder}/index"
    build_text_index(spark, path, ["id", "word", "amount"], index)
    table = spark.read.parquet(path)
    sought = ["FILE3", "3", "ss", "ΟΔΟΣ", "δοσ", "i̇st", "𝒴𝒵", "_", "1003.5", "nothing here"]
    for text in sought[3:5] if cased else sought:
        spec = GridSpec(columns=SPEC.columns, row_id="id", case_sensitive=cased).with_search(text)
        grid = indexed_grid(spark, path, spec, index)
        assert same_rows(grid.rows(), Grid(table, spec).rows()), text


def test_few_files_are_read(spark, folder):
    path, index = texts(spark, folder), f"{folder}/index"
    build_text_index(spark, path, ["id", "word", "amount"], index)
    whole = len(spark.read.parquet(path).inputFiles())
    assert whole == 9

    def read(spec):
        return len(indexed_grid(spark, path, spec, index).source.inputFiles())

    assert read(SPEC.with_search("file3")) == 1
    assert read(SPEC.with_search("no such text")) == 0
    assert read(SPEC.with_search("file")) == 9
    as_text = SPEC.with_column("word", filter_kind="textField")
    assert read(as_text.with_filter("word", "FILE7")) == 1
    # Both must hold, in one file.
    assert read(as_text.with_filter("word", "file7").with_search("file2")) == 0
    # The index says nothing about these.
    assert read(SPEC) == whole
    custom = GridSpec(columns=SPEC.columns, row_id="id", custom_search=lambda t, row: row("word") == t)
    assert read(custom.with_search("file3")) == whole
    assert read(SPEC.with_column("word", derive="upper(word)").with_search("FILE3")) == whole
    partly = f"{folder}/partly"
    build_text_index(spark, path, ["word"], partly)
    assert len(indexed_grid(spark, path, SPEC.with_search("file3"), partly).source.inputFiles()) == whole


def test_files_that_the_index_does_not_know_are_read(spark, folder):
    path, index = texts(spark, folder), f"{folder}/index"
    build_text_index(spark, path, ["id", "word", "amount"], index)
    spark.createDataFrame([(9000, "late file3", 0.0), (9001, "other", 0.0)], "id long, word string, amount double").coalesce(1).write.mode("append").parquet(path)
    grid = indexed_grid(spark, path, SPEC.with_search("file3"), index)
    assert len(grid.source.inputFiles()) == 2
    assert same_rows(grid.rows(), Grid(spark.read.parquet(path), SPEC.with_search("file3")).rows())
    assert 9000 in {r.id for r in grid.rows().collect()}
    # A file written anew counts as unknown, whatever the index holds for its name.
    known = spark.read.parquet(f"{index}/files")
    other = f"{folder}/other"
    for part in ("grams", "columns"):
        spark.read.parquet(f"{index}/{part}").write.parquet(f"{other}/{part}")
    known.withColumn("length", F.col("length") + 1).write.parquet(f"{other}/files")
    assert len(files_with(spark, path, other, [(["word"], "no such text")])) == 10


def test_more_files_than_a_bitmap_block(spark, folder):
    """File numbers beyond the first block of bits."""
    from tablewright.sources.text_index import has_bit

    numbers = spark.createDataFrame([(1,), (32768,), (32769,), (70000,)], "n long")
    bits = numbers.groupBy(F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")
    )
    asked = spark.range(1, 70010, 1).select(F.col("id").alias("n"), F.bitmap_bucket_number("id").alias("bucket"))
    found = asked.join(bits, "bucket").where(has_bit(F.col("bits"), F.bitmap_bit_position("n")))
    assert sorted(r.n for r in found.collect()) == [1, 32768, 32769, 70000]


def test_partitioned_tables_keep_their_columns(spark, folder):
    path, index = f"{folder}/parts", f"{folder}/index"
    spark.range(40).selectExpr("id", "concat('w', id % 4) AS word", "id % 4 AS kind").write.partitionBy("kind").parquet(path)
    build_text_index(spark, path, ["id", "word", "kind"], index)
    spec = GridSpec(columns=("id", "word", "kind"), row_id="id").with_search("w3")
    grid = indexed_grid(spark, path, spec, index)
    assert {r.kind for r in grid.rows().collect()} == {3} and grid.rows().count() == 10


# -- stored order ----------------------------------------------------------------


def numbers(spark, folder, n=1000):
    path = f"{folder}/numbers"
    rows = spark.range(n).selectExpr("id", "CASE WHEN id % 7 <> 0 THEN id % 5 END AS n", "concat('t', id % 3) AS t")
    rows.repartition(3).write.parquet(path)
    return path


ORDERED = GridSpec(columns=("id", "n", "t"), row_id="id", rows_per_page=30, sorts=(SortKey("n", "desc"), SortKey("t")))


def test_pages_of_a_stored_order(spark, folder):
    path, index = numbers(spark, folder), f"{folder}/order"
    grid = Grid(spark.read.parquet(path), ORDERED)
    build_order_index(grid, path, index, ranges=7)
    for page in (0, 16, 33, 99):
        asked = Grid(grid.source, ORDERED.go_to(page))
        assert indexed_page(asked, path, index).collect() == asked.page().collect()
        assert indexed_page_info(asked, path, index).collect() == asked.page_info().collect()
    bigger = Grid(grid.source, GridSpec(**{**ORDERED.__dict__, "rows_per_page": 400, "page": 1}))
    assert indexed_page(bigger, path, index).collect() == bigger.page().collect()


def test_a_page_reads_one_range(spark, folder):
    path, index = numbers(spark, folder), f"{folder}/order"
    grid = Grid(spark.read.parquet(path), ORDERED)
    build_order_index(grid, path, index, ranges=7)
    page = indexed_page(Grid(grid.source, ORDERED.go_to(10)), path, index)
    assert len(page.inputFiles()) == 7  # listed, before partitions are pruned
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(_tw_at" in plan
    assert "_tw_part" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    # One sampled range holds the hot value in pieces.
    sizes = [r["count"] for r in spark.read.parquet(f"{index}/rows").groupBy("_tw_part").count().collect()]
    assert len(sizes) == 7 and max(sizes) < 400


def test_a_stale_order_is_not_used(spark, folder):
    path, index = numbers(spark, folder), f"{folder}/order"
    grid = Grid(spark.read.parquet(path), ORDERED)
    build_order_index(grid, path, index)
    other = [ORDERED.sort_by("id", "desc"), ORDERED.with_filter("t", "t1"), ORDERED.with_search("9")]
    for spec in other:
        asked = Grid(grid.source, spec.go_to(1))
        assert indexed_page(asked, path, index).collect() == asked.page().collect()
    before = fingerprint(spark, path)
    spark.createDataFrame([(5000, 4, "t0")], "id long, n long, t string").write.mode("append").parquet(path)
    assert fingerprint(spark, path) != before
    fresh = Grid(spark.read.parquet(path), ORDERED)
    assert 5000 in {r.id for p in range(6) for r in indexed_page(Grid(fresh.source, ORDERED.go_to(p)), path, index).collect()}


def test_an_empty_order(spark, folder):
    path, index = numbers(spark, folder, 0), f"{folder}/order"
    grid = Grid(spark.read.schema("id long, n long, t string").parquet(path), ORDERED)
    build_order_index(grid, path, index)
    assert indexed_page(grid, path, index).collect() == []
    assert indexed_page_info(grid, path, index).collect() == grid.page_info().collect()


# -- counts of combined filters ----------------------------------------------------


def brute_counts(rows, tests, columns):
    """``tests`` maps a column (or None for the search) to a Python test of a row."""
    found = {}
    for row in rows:
        for c in columns:
            passes = all(t(row) for name, t in tests.items() if name != c)
            values = row[c] if isinstance(row[c], list) else [] if c == "tags" else [row[c]]
            for v in dict.fromkeys(values):
                key = (c, None if v is None else str(v))
                found[key] = found.get(key, 0) + passes
    return found


def many_rows(n=3000):
    random.seed(11)
    rows = []
    for i in range(n):
        tags = random.choice([None, [], ["a"], ["a", "b"], ["b", None], ["c", "c", "a"]])
        rows.append({"id": i, "kind": random.choice(["x", "y", None]), "size": random.choice([1, 2, 3, None]), "tags": tags, "name": f"n{i % 700}"})
    return rows


def test_counts_by_one_pass_and_by_bitmaps(spark, folder):
    rows = many_rows()
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], "id long, kind string, size int, tags array<string>, name string")
    base = GridSpec(columns=(ColumnSpec("id", filterable=False), "kind", "size", "tags", "name"), row_id="id")
    index = f"{folder}/bitmaps"
    counts.build_facet_bitmaps(Grid(frame, base), index)
    assert spark.read.parquet(f"{index}/dense").count() > 0 and spark.read.parquet(f"{index}/sparse").count() > 0
    names = ["kind", "size", "tags", "name"]
    cases = [
        (base.with_filters({"kind": ["y", None], "size": [1, 2.0, "3", 2.5]}),
         {"kind": lambda r: r["kind"] in ("y", None), "size": lambda r: r["size"] in (1, 2)}),
        (GridSpec(**{**base.__dict__, "array_match_all": False}).with_filters({"tags": ["b", "c"], "size": 3}),
         {"tags": lambda r: bool({"b", "c"} & set(r["tags"] or [])), "size": lambda r: r["size"] == 3}),
        (base.with_column("name", filter_kind="textField").with_filters({"name": "N69", "kind": "no such kind", "tags": ["a", "b"]}),
         {"name": lambda r: "n69" in r["name"], "kind": lambda r: False, "tags": lambda r: {"a", "b"} <= set(r["tags"] or [])}),
        (base.with_column("size", filter_kind="custom", drop_when="size > 2").with_search("n12").with_filter("tags", [None]),
         {"tags": lambda r: r["tags"] is None or None in r["tags"], "size": lambda r: r["size"] is None or r["size"] <= 2, None: lambda r: "n12" in r["name"]}),
    ]
    for spec, tests in cases:
        grid = Grid(frame, spec)
        wanted = brute_counts(rows, tests, names)
        for found in (counts.facet_counts(grid), counts.counted_by_bitmaps(grid, index)):
            got = {(r["column"], r["value"]): r["rows"] for r in found.collect()}
            assert got == wanted, spec.filters
        total = sum(all(t(r) for t in tests.values()) for r in rows)
        assert counts.displayed_by_bitmaps(grid, index).collect() == [(total,)]
        assert grid.displayed.count() == total


def test_bitmaps_of_several_blocks(spark, folder):
    frame = spark.range(80_000).selectExpr("id", "id % 3 AS a", "CASE WHEN id < 40000 THEN id % 2 END AS b")
    grid = Grid(frame, GridSpec(columns=(ColumnSpec("id", filterable=False), "a", "b"), row_id="id").with_filters({"a": 1, "b": [0]}))
    counts.build_facet_bitmaps(grid, f"{folder}/bitmaps")
    one_pass = {(r["column"], r["value"]): r["rows"] for r in counts.facet_counts(grid).collect()}
    by_bits = {(r["column"], r["value"]): r["rows"] for r in counts.counted_by_bitmaps(grid, f"{folder}/bitmaps").collect()}
    assert one_pass == by_bits and one_pass["b", None] == len([i for i in range(40_000, 80_000) if i % 3 == 1])


def test_chosen_values_alone_do_not_read_the_rows(spark, folder):
    frame = spark.createDataFrame([(i, "xy"[i % 2], i % 3) for i in range(50)], "id long, kind string, size int")
    spec = GridSpec(columns=(ColumnSpec("id", filterable=False), "kind", "size"), row_id="id").with_filters({"kind": "x", "size": 1})
    index = f"{folder}/bitmaps"
    counts.build_facet_bitmaps(Grid(frame, spec), index)
    plan = counts.counted_by_bitmaps(Grid(frame, spec), index)._jdf.queryExecution().executedPlan().toString()
    assert f"{index}/rows" not in plan and f"{index}/dense" in plan
    with pytest.raises(SpecError):
        counts.counted_by_bitmaps(Grid(frame.withColumn("other", F.lit(1)), GridSpec(columns=("id", "other"), row_id="id")), index)


# -- facets through an update ------------------------------------------------------


@pytest.mark.parametrize("as_frame", [False, True])
def test_kept_facets_equal_new_ones(spark, as_frame):
    random.seed(2)
    rows = [(i, random.choice("abc"), random.choice([None, ["p"], ["p", "q"], []])) for i in range(200)]
    source = spark.createDataFrame(rows, "id long, kind string, tags array<string>")
    spec = GridSpec(columns=(ColumnSpec("id", filterable=False), "kind", "tags"), row_id="id")
    grid = Grid(source, spec)
    facets = counted_facets(grid)
    first = {r["value"]: r["first_seen"] for r in facets.where("`column` = 'kind'").collect()}
    steps = [("kind", {first["a"]: "new", first["b"]: None, 199: rows[199][1], 77_777: "no such row"}),
             ("tags", {0: ["q", "q"], 1: None, 2: ["r", None]}), ("kind", {k: "c" for k in range(200)})][slice(1, 3) if as_frame else slice(2)]
    for column, updates in steps:
        given = updates
        if as_frame:
            given = spark.createDataFrame(list(updates.items()), source.select("id", column).schema)
        updated, facets = update_with_facets(Grid(source, spec), facets, column, given)
        wanted = counted_facets(Grid(updated, spec))
        assert same_rows(facets.select("column", "value", "rows", "first_seen"), wanted.select("column", "value", "rows", "first_seen"))
        source = updated


def test_facets_of_derived_cells_are_refused(spark):
    grid = Grid(spark.range(3).selectExpr("id", "id AS n"), GridSpec(columns=("id", ColumnSpec("n", derive="n + id")), row_id="id"))
    with pytest.raises(SpecError):
        update_with_facets(grid, counted_facets(grid), "n", {1: 5})


# -- keys that a cast would change ---------------------------------------------------


@pytest.mark.parametrize("n", [3, MAX_LISTED_KEYS + 1])
def test_keys_that_a_cast_would_change_equal_no_row(spark, n):
    df = spark.range(3000).withColumn("t", F.col("id").cast("string"))
    odd = [i + 0.5 for i in range(n)]
    assert select_rows(df, "id", odd).count() == 0
    assert delete_rows(df, "id", odd).count() == 3000
    mixed = [5, 6.0, decimal.Decimal(7), "8", True, None, float("nan"), float("inf"), 2**70, *odd]
    assert {r.id for r in select_rows(df, "id", mixed).collect()} == {5, 6, 7}
    assert delete_rows(df, "id", mixed).count() == 2997
    assert {r.t for r in select_rows(df, "t", ["5", 6, None, "x", *map(str, odd)]).collect()} == {"5"}


def test_values_as_a_cell_holds_them(spark):
    types = spark.createDataFrame([], "i int, l long, f float, d double, m decimal(5,2), s string, b boolean, day date, at timestamp").schema
    kept = [("i", 3, 3), ("i", 3.0, 3), ("i", 2**31, None), ("i", -(2**31), -(2**31)), ("l", 2**53 + 1, 2**53 + 1), ("f", 0.5, 0.5), ("f", 0.1, None),
            ("f", 1e300, None), ("d", 0.1, 0.1), ("d", 2**53 + 1, None), ("m", 1.5, decimal.Decimal("1.50")), ("m", 0.1, decimal.Decimal("0.10")),
            ("m", decimal.Decimal("1.234"), None), ("m", 1000, None), ("s", "a", "a"), ("s", 1, None), ("b", True, True), ("b", 1, None), ("i", True, None),
            ("day", dt.date(2020, 1, 2), dt.date(2020, 1, 2)), ("day", dt.datetime(2020, 1, 2), None), ("i", None, None), ("d", float("nan"), None)]
    for name, value, held in kept:
        assert as_held(value, types[name].dataType) == held, (name, value)


def test_facets_read_the_table_once(spark, tables):
    from tablewright.operators.facets import ordered_facets

    orders = spark.read.parquet(f"{tables}/orders.parquet")
    spec = GridSpec(columns=(ColumnSpec("o_orderkey", filterable=False), "o_orderstatus"), row_id="o_orderkey")
    plan = ordered_facets(Grid(orders, spec))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<column:string,value:string,first_seen:bigint>" in plan


def test_listing(spark, folder):
    path = numbers(spark, folder)
    listed = files_of(spark, path).collect()
    assert len(listed) == 3 and {r.file_path for r in listed} == {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
