"""Filters, search, facets, sorts, pages and selections on small frames."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import ordering
from tablewright.operators.cells import update_cells
from tablewright.operators.facets import facet_values, ordered_facets
from tablewright.operators.ordering import Key, by, stretch, with_positions
from tablewright.operators.paging import page_info, page_rows, rows_at
from tablewright.operators.rowset import (
    delete_rows,
    select_range,
    select_rows,
    toggle_displayed,
)
from tablewright.operators.summary import summary_row
from tablewright.plans.compiler import Grid, with_row_id
from tablewright.plans.spec import ColumnSpec, GridSpec, SortKey, SpecError


@pytest.fixture(scope="module")
def cells(spark):
    rows = [
        (0, "b", 2.0, ["x", "y"], 1),
        (1, "A", 12345678.5, ["x"], 2),
        (2, None, None, None, None),
        (3, "a", 0.0001, [], 3),
        (4, "B", -5.0, ["y", None], 477),
        (5, "é", float("nan"), ["z", "x"], 5),
        (6, "a_%", 1.0, ["y"], 6),
    ]
    return spark.createDataFrame(
        rows, "id bigint, text string, num double, tags array<string>, n int"
    ).coalesce(1)


def ids(grid):
    return sorted(r["id"] for r in grid.displayed.collect())


def grid(cells, columns=("id", "text", "num", "tags", "n"), **options):
    return Grid(cells, GridSpec(columns=columns, row_id="id", **options))


@pytest.mark.parametrize(
    "filters, kept",
    [
        ({"text": ("a",)}, [3]),
        ({"text": (None,)}, [2]),
        ({"text": ("a", None)}, [2, 3]),
        ({"n": (477,)}, [4]),
        ({"n": ("477",)}, []),
        ({"n": (True,)}, []),
        ({"n": (2.0, 3)}, [1, 3]),
        ({"num": (2, float("nan"))}, [0]),
        ({"tags": ("x",)}, [0, 1, 5]),
        ({"tags": ("x", "y")}, [0]),
        ({"tags": ("y", None)}, [2, 4]),
        ({"text": ("a",), "n": (3,)}, [3]),
        ({"text": ("a",), "n": (4,)}, []),
    ],
)
def test_column_filters(cells, filters, kept):
    assert ids(grid(cells, filters=filters)) == kept


def test_array_filter_any(cells):
    assert ids(grid(cells, filters={"tags": ("y", "z")}, array_match_all=False)) == [0, 4, 5, 6]
    assert ids(grid(cells, filters={"tags": (None,)}, array_match_all=False)) == [2, 4]


@pytest.mark.parametrize(
    "column, text, kept",
    [
        ("text", "A", [1, 3, 6]),
        ("text", "_%", [6]),
        ("num", "12345678.5", [1]),
        ("num", "0.0001", [3]),
        ("num", "e", []),
        ("tags", "x,y", [0]),
        ("tags", "Z,X", [5]),
    ],
)
def test_text_filter(cells, column, text, kept):
    assert ids(grid(cells, filter_kind="textField", filters={column: (text,)})) == kept


def test_text_filter_case_sensitive(cells):
    options = dict(filter_kind="textField", case_sensitive=True)
    assert ids(grid(cells, filters={"text": ("A",)}, **options)) == [1]


def test_search_looks_at_every_visible_searchable_column(cells):
    assert ids(grid(cells, search_text="5")) == [1, 4, 5]
    columns = ("id", "text", ColumnSpec("num", searchable=False), "tags", "n")
    assert ids(grid(cells, columns, search_text="5")) == [5]
    columns = ("id", "text", ColumnSpec("num", display="excluded"), "tags", "n")
    assert ids(grid(cells, columns, search_text="5")) == [5]
    columns = ("id", "text", ColumnSpec("num", display=False), "tags", "n")
    assert ids(grid(cells, columns, search_text="5")) == [5]


def test_custom_search_replaces_the_search(cells):
    found = grid(cells, search_text="7", custom_search=lambda text, row: row("n") < int(text))
    assert ids(found) == [0, 1, 3, 5, 6]
    with pytest.raises(SpecError):
        ids(grid(cells, search_text="7", custom_search=lambda text, row: row("n")))


def test_custom_filter_drops_and_keeps_the_unknown(cells):
    column = ColumnSpec("n", drop_when="n < 3", filter_kind="custom")
    assert ids(grid(cells, ("id", column))) == [2, 3, 4, 5, 6]
    with pytest.raises(SpecError):
        ids(grid(cells, ("id", ColumnSpec("n", filter_kind="custom"))))
    unused = ColumnSpec("n", drop_when="n < 3")
    assert ids(grid(cells, ("id", unused))) == list(range(7))


def test_derived_cells(cells):
    early = ColumnSpec("text", derive="upper(text)")
    late = ColumnSpec("text", derive_late="upper(text)")
    assert ids(grid(cells, ("id", early), filters={"text": ("A",)})) == [1, 3]
    assert ids(grid(cells, ("id", late), filters={"text": ("A",)})) == [1]
    shown = grid(cells, ("id", late), filters={"text": ("a",)}).rows().collect()
    assert [tuple(r) for r in shown] == [(3, "A")]


def test_passthrough_keeps_everything(cells):
    spec = GridSpec(
        columns=("id",), row_id="id", search_text="9", passthrough=True, total=1000
    )
    assert Grid(cells, spec).page().count() == 7
    assert Grid(cells, spec).page_info().first()["total"] == 1000


def ordered_ids(g):
    return [r["id"] for r in g.sorted().select("id").collect()]


def test_string_sort_follows_the_dictionary(cells):
    up = grid(cells, sorts=(SortKey("text"),))
    assert ordered_ids(up) == [2, 3, 1, 6, 0, 4, 5]
    down = grid(cells, sorts=(SortKey("text", "desc"),))
    assert ordered_ids(down) == [5, 4, 0, 6, 1, 3, 2]


def test_number_sort_puts_null_where_empty_text_would_be(cells):
    assert ordered_ids(grid(cells, sorts=(SortKey("n"),))) == [2, 0, 1, 3, 5, 6, 4]
    assert ordered_ids(grid(cells, sorts=(SortKey("n", "desc"),))) == [4, 6, 5, 3, 1, 0, 2]


def test_ties_keep_the_source_order_in_both_directions(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(6)], "id bigint, k int")
    spec = GridSpec(columns=("id", "k"), row_id="id")
    assert ordered_ids(Grid(df, spec.sort_by("k"))) == [0, 2, 4, 1, 3, 5]
    assert ordered_ids(Grid(df, spec.sort_by("k", "desc"))) == [1, 3, 5, 0, 2, 4]
    assert ordered_ids(Grid(df, spec.sort_by("k", "none"))) == [0, 1, 2, 3, 4, 5]


def test_arrays_need_a_sort_key(cells):
    with pytest.raises(TypeError):
        grid(cells, sorts=(SortKey("tags"),)).sorted()
    column = ColumnSpec("tags", sort_key=lambda value, row: [F.size(value), row("n")])
    assert ordered_ids(grid(cells, ("id", column, "n"), sorts=(SortKey("tags"),)))[:2] == [2, 3]


def test_a_row_key_is_needed_for_order_only(cells):
    bare = Grid(cells, GridSpec(columns=("text",), filters={"text": ("a",)}))
    assert bare.rows().count() == 1
    with pytest.raises(SpecError):
        bare.sorted()
    numbered = Grid(with_row_id(cells), GridSpec(columns=("text",)))
    assert numbered.sorted().count() == 7


def test_facets_keep_null_and_explode_arrays(cells):
    values = {
        (r["column"], r["value"]): r["first_seen"]
        for r in facet_values(grid(cells, ("id", "num", "tags"), filters={"num": (1,)})).collect()
        if r["column"] != "id"
    }
    assert values == {
        ("num", "2"): 0, ("num", "12345678.5"): 1, ("num", None): 2, ("num", "0.0001"): 3,
        ("num", "-5"): 4, ("num", "NaN"): 5, ("num", "1"): 6,
        ("tags", "x"): 0, ("tags", "y"): 0, ("tags", None): 4, ("tags", "z"): 5,
    }


def test_facets_in_natural_order(spark):
    texts = ["a10", "a9", "A2", "á2", "a2", "b", None, "a010"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    columns = (ColumnSpec("id", filterable=False), "t")
    rows = ordered_facets(grid(df, columns)).orderBy("pos").collect()
    assert [r["value"] for r in rows] == [None, "A2", "á2", "a2", "a9", "a10", "a010", "b"]
    seen = ordered_facets(grid(df, columns, sort_facets=False)).orderBy("pos").collect()
    assert [r["value"] for r in seen] == texts


def test_nothing_to_filter_gives_no_facets(cells):
    assert facet_values(grid(cells, (ColumnSpec("id", filterable=False),))).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one sort value."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 101)
    return spark.range(5000).repartition(5).withColumn("k", key)


def test_positions_across_many_parts(skewed, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_positions(skewed, [Key(F.col("k"), True), *by("id")]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted(((r["k"], r["id"]) for r in placed), key=lambda t: (-t[0], t[1]))
    got = [(r["k"], r["id"]) for r in sorted(placed, key=lambda r: r["pos"])]
    assert got == want
    assert [r["pos"] for r in sorted(placed, key=lambda r: r["pos"])] == list(range(1, 5001))


@pytest.mark.parametrize("parts", [2, 7, 50])
@pytest.mark.parametrize("down", [False, True])
def test_a_stretch_holds_its_places(skewed, parts, down):
    order = [Key(F.col("k"), down), *by("id")]
    pairs = [(r["k"], r["id"]) for r in skewed.collect()]
    everything = sorted(pairs, key=lambda t: (-t[0] if down else t[0], t[1]))
    for first, last in ((1, 10), (990, 1310), (1800, 1801), (4990, 5200)):
        rows, skipped = stretch(skewed, order, first, last, 100, parts)
        got = sorted(((r["k"], r["id"]) for r in rows.collect()), key=lambda t: (-t[0] if down else t[0], t[1]))
        assert got == everything[skipped : skipped + len(got)]
        assert skipped < first and skipped + len(got) >= min(last, 5000)
        assert len(got) < 5000 // parts + 700


def test_a_misleading_sample_does_no_harm(skewed, monkeypatch):
    order = [Key(F.col("k")), *by("id")]
    monkeypatch.setattr(ordering, "_bounds", lambda *a: [[100, 0]])
    rows = rows_at(skewed, order, 5, 6, shallow_rows=1)
    want = [(r["id"]) for r in skewed.orderBy("k", "id").limit(6).collect()][4:]
    assert [r["id"] for r in rows.collect()] == want


def test_deep_places_in_dictionary_order(spark):
    letters = F.element_at(F.array(*[F.lit(x) for x in "bAaBéÉzZ"]), (F.col("id") % 8 + 1).cast("int"))
    df = spark.range(4000).withColumn("t", F.when(F.col("id") % 9 > 0, letters))
    spec = GridSpec(columns=("t", "id"), row_id="id").sort_by("t", "desc")
    g = Grid(df, spec)
    everything = [(r["t"], r["id"]) for r in g.sorted().collect()]
    got = rows_at(g.displayed, g.order, 2000, 2050, shallow_rows=10).collect()
    assert [r["id"] for r in got] == [i for _, i in everything[1999:2050]]
    placed = {r["id"]: r["pos"] for r in g.with_positions().collect()}
    assert [placed[i] for _, i in everything] == list(range(1, 4001))


def test_comparing_rows_with_nulls(cells):
    for down in (False, True):
        for column in ("text", "num", "n"):
            order = [Key(F.col(column), down), *by("id")]
            rows = ordering.ordered(cells, order).collect()
            for i, row in enumerate(rows):
                early = cells.filter(ordering.comes_before(order, [row[column], row["id"]]))
                assert {r["id"] for r in early.collect()} == {r["id"] for r in rows[:i]}


@pytest.mark.parametrize("shallow", [1, 60, 10_000])
def test_pages_cover_the_table_however_they_are_found(skewed, shallow):
    order = [Key(F.col("k")), *by("id")]
    everything = [
        (r["k"], r["id"]) for r in skewed.filter("id < 130").orderBy("k", "id").collect()
    ]
    pages = []
    for page in range(5):
        rows = page_rows(
            skewed.filter("id < 130"), order, page, 30, shallow_rows=shallow
        ).collect()
        pages += [(r["k"], r["id"]) for r in rows]
    assert pages == everything
    beyond = page_rows(skewed.filter("id < 130"), order, 9, 30, shallow_rows=shallow)
    assert [(r["k"], r["id"]) for r in beyond.collect()] == everything[120:]


@pytest.mark.parametrize("shallow", [1, 10_000])
def test_page_of_an_empty_table(skewed, shallow):
    empty = skewed.filter("id < 0")
    assert page_rows(empty, by("id"), 3, 10, shallow_rows=shallow).count() == 0
    info = page_info(empty, 3, 10).first()
    assert tuple(info) == (0, 1, 0, 0, 0)


def test_page_info_clamps(skewed):
    assert tuple(page_info(skewed, 0, 10).first()) == (5000, 500, 0, 1, 10)
    assert tuple(page_info(skewed, 900, 15).first()) == (5000, 334, 333, 4996, 5000)
    assert tuple(page_info(skewed, 2, 10, total=21).first()) == (21, 3, 2, 21, 21)


def test_rows_at_a_long_stretch(skewed):
    rows = rows_at(skewed, [Key(F.col("k")), *by("id")], 11, 2500, shallow_rows=5)
    everything = [(r["k"], r["id"]) for r in skewed.orderBy("k", "id").collect()]
    assert [(r["k"], r["id"]) for r in rows.collect()] == everything[10:2500]


def test_select_and_delete_make_up_the_table(skewed, spark):
    frame = spark.createDataFrame([(i,) for i in range(0, 6000, 7)], "id bigint")
    for keys in ([1, 5, 99999], list(range(0, 3000)), frame):
        kept = select_rows(skewed, "id", keys)
        left = delete_rows(skewed, "id", keys)
        assert kept.count() + left.count() == 5000
        assert kept.join(left, "id").count() == 0
    assert select_rows(skewed, "id", []).count() == 0
    assert delete_rows(skewed, "id", []).count() == 5000
    assert select_rows(skewed, "id", [1], mode="none").count() == 0
    with pytest.raises(SpecError):
        select_rows(skewed, "id", [1, 2], mode="single")


def test_delete_may_be_vetoed(skewed):
    assert delete_rows(skewed, "id", [1], veto=lambda left: False).count() == 5000
    assert delete_rows(skewed, "id", [1], veto=lambda left: None).count() == 4999


def test_header_box(cells):
    g = grid(cells, filters={"n": (1, 2, 3)})

    def keys(frame):
        return sorted(r["id"] for r in frame.collect())

    assert keys(toggle_displayed(g, [])) == [0, 1, 3]
    assert keys(toggle_displayed(g, [0])) == []
    assert keys(toggle_displayed(g, [0, 6])) == [6]
    assert keys(toggle_displayed(g, [3, 4, 5, 6])) == [0, 1, 3]  # more than are displayed
    assert keys(toggle_displayed(g, [], "n > 1")) == [1, 3]
    with pytest.raises(SpecError):
        toggle_displayed(grid(cells, selectable_rows="none"), [])


def test_range_runs_over_displayed_places(cells):
    g = grid(cells, sorts=(SortKey("n", "desc"),))
    assert [r["id"] for r in select_range(g, 4, 2).collect()] == [6, 5, 3]
    assert [r["id"] for r in select_range(g, 2, 4, "n <> 5").collect()] == [6, 3]


def test_cell_updates(cells, spark):
    def texts(df):
        return {r["id"]: r["text"] for r in df.collect()}

    few = texts(update_cells(cells, "id", "text", {0: "X", 1: None}))
    assert (few[0], few[1], few[2], few[3]) == ("X", None, None, "a")
    many = texts(update_cells(cells, "id", "text", {i: f"t{i}" for i in range(3, 2000)}))
    assert (many[0], many[3], many[6], len(many)) == ("b", "t3", "t6", 7)
    changes = spark.createDataFrame(
        [(0, "old", 1), (0, "new", 2), (1, None, 1)], "id bigint, text string, at int"
    )
    frame = texts(update_cells(cells, "id", "text", changes, latest_by="at"))
    assert (frame[0], frame[1], frame[3]) == ("new", None, "a")
    assert update_cells(cells, "id", "text", {}) is cells


def test_summary_of_displayed_rows(cells):
    g = grid(cells, filters={"n": (1, 2, 3)})
    assert tuple(summary_row(g.displayed, {"n": F.count("*"), "s": "sum(n)"}).first()) == (3, 6)


def test_nested_columns(spark):
    df = spark.sql("select 1 id, named_struct('b', named_struct('c', 5)) a, 7 as `x.y`")
    spec = GridSpec(columns=("id", "a.b.c", "a.b.z", "a.q.c"), row_id="id", path_separator=".")
    assert tuple(Grid(df, spec).rows().first()) == (1, 5, None, None)
    flat = GridSpec(columns=("id", "x.y"), row_id="id")
    assert tuple(Grid(df, flat).rows().first()) == (1, 7)
    with pytest.raises(SpecError):
        Grid(df, GridSpec(columns=("id", "nope"), row_id="id")).rows()
