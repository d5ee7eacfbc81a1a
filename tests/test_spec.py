"""Changes of a view's state, without Spark."""

import datetime as dt
from decimal import Decimal

import pytest

from tablewright.operators.rowset import toggle_row
from tablewright.plans.spec import (
    ColumnSpec,
    GridSpec,
    SortKey,
    SpecError,
    clamp_page,
)

SPEC = GridSpec(columns=("a", "b", "c", "d"), row_id="a")


@pytest.mark.parametrize(
    "total, size, page, shown",
    [(0, 10, 0, 0), (0, 10, 5, 0), (10, 10, 1, 0), (11, 10, 1, 1), (11, 10, 9, 1), (30, 10, 2, 2)],
)
def test_clamp_page(total, size, page, shown):
    assert clamp_page(total, size, page) == shown


def test_sort_cycle():
    spec = SPEC.toggle_sort("b")
    assert spec.sorts[0] == SortKey("b", "asc")
    assert spec.toggle_sort("b").sorts[0].direction == "desc"
    assert spec.toggle_sort("b").toggle_sort("b").sorts[0].direction == "asc"
    first = GridSpec(columns=(ColumnSpec("a", descending_first=True, reset_on_third=True),))
    directions = []
    for _ in range(4):
        first = first.toggle_sort("a")
        directions.append(first.sorts[0].direction)
    assert directions == ["desc", "asc", "none", "desc"]


def test_sorts_are_stable_and_none_forgets_them():
    spec = SPEC.sort_by("b").sort_by("c", "desc").sort_by("b", "desc")
    assert spec.sorts == (SortKey("b", "desc"), SortKey("c", "desc"))
    assert spec.sort_by("c", "none").sorts == (SortKey("c", "none"),)
    assert spec.sort_by("c", "none").sort_by("d").sorts == (SortKey("d", "asc"),)


def test_unsortable_column_and_table():
    with pytest.raises(SpecError):
        GridSpec(columns=(ColumnSpec("a", sortable=False),)).toggle_sort("a")
    with pytest.raises(SpecError):
        GridSpec(columns=("a",), sortable=False).toggle_sort("a")


def test_move_column_takes_the_target_place():
    def names(spec):
        return [c.name for c in spec.ordered_columns]

    assert names(SPEC.move_column("a", "c")) == ["b", "c", "a", "d"]
    assert names(SPEC.move_column("d", "b")) == ["a", "d", "b", "c"]
    assert names(SPEC.move_column("b", "b")) == ["a", "b", "c", "d"]
    with pytest.raises(SpecError):
        SPEC.move_column("a", "x")


def test_order_survives_only_an_equal_column_count():
    moved = SPEC.with_column_order((3, 2, 1, 0))
    assert moved.with_columns(("w", "x", "y", "z")).column_order == (3, 2, 1, 0)
    assert moved.with_columns(("w", "x")).column_order is None


def test_toggle_column():
    hidden = SPEC.toggle_column("b")
    assert [c.name for c in hidden.visible_columns] == ["a", "c", "d"]
    assert hidden.toggle_column("b") == SPEC
    with pytest.raises(SpecError):
        GridSpec(columns=(ColumnSpec("a", display="always"),)).toggle_column("a")


def test_filters_and_pages():
    spec = SPEC.go_to(4)
    assert spec.with_filter("b", 1).page == 0
    assert spec.with_search("x").page == 0
    assert spec.close_search().page == 4
    assert spec.sort_by("b").page == 4
    assert spec.with_rows_per_page(100, total=250).page == 2
    assert spec.with_filter("b", 1).with_filter("b", "").filters == {}
    both = spec.with_filters({"b": [1, 2], "c": None})
    assert both.filters == {"b": (1, 2), "c": (None,)}
    assert both.with_search("x").reset_filters().search_text == "x"
    assert both.with_search("").search_text is None


def test_filter_values_toggle_by_type():
    spec = SPEC.toggle_filter_value("b", 1).toggle_filter_value("b", "1")
    assert spec.filters["b"] == (1, "1")
    assert spec.toggle_filter_value("b", 1).filters["b"] == ("1",)
    assert spec.remove_filter_value("b", "1").filters["b"] == (1,)


def test_remove_with_update_rewrites_all_filters():
    spec = SPEC.with_filters({"b": [1, 2], "c": [3]})
    changed = spec.remove_filter_value("b", 1, lambda filters, name, value: {"c": filters["c"]})
    assert changed.filters == {"c": (3,)}


def test_toggle_row_modes():
    assert toggle_row([1], 2) == [1, 2]
    assert toggle_row([1, 2], 1) == [2]
    assert toggle_row([1], 2, "single") == [2]
    assert toggle_row([], 2, "none") == []


def test_json_keeps_state_and_takes_functions_from_code():
    derive = lambda value, row: value
    spec = GridSpec(
        columns=(ColumnSpec("a", label="A", drop_when="a > 1"), ColumnSpec("b", derive=derive)),
        row_id="a",
        filters={"a": (1, None, "x")},
        search_text="é",
        sorts=(SortKey("b", "desc"),),
        column_order=(1, 0),
        page=3,
    )
    restored = GridSpec.from_json(spec.to_json(), code=spec)
    assert restored == spec
    bare = GridSpec.from_json(spec.to_json())
    assert bare.column("b").derive is None and bare.column("a").drop_when == "a > 1"
    assert GridSpec.from_json(bare.to_json()) == bare


def test_json_keeps_dates_and_decimals():
    chosen = (dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 6), Decimal("1.50"), True, None)
    spec = GridSpec(columns=("a",), filters={"a": chosen}, custom_sort=("length(a)", "a"))
    restored = GridSpec.from_json(spec.to_json())
    assert restored == spec
    assert [type(v) for v in restored.filters["a"]] == [type(v) for v in chosen]


@pytest.mark.parametrize(
    "bad",
    [
        {"columns": ("a", "a")},
        {"columns": ("a",), "filters": {"b": (1,)}},
        {"columns": ("a", "b"), "column_order": (0,)},
        {"columns": ("a",), "filter_kind": "slider"},
        {"columns": ("a",), "page": -1},
        {"columns": ("a",), "selectable_rows": "some"},
    ],
)
def test_bad_specs(bad):
    with pytest.raises(SpecError):
        GridSpec(**bad)
