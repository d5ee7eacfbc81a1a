"""Declarative description of a table view, and the pure functions that change it.

Nothing here touches Spark: a spec can be built, changed, saved and restored
without a session.  Every change returns a new spec.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields, replace
from decimal import Decimal
from typing import Any

# The names of options and modes.
DISPLAY_MODES = ("true", "false", "excluded", "always")
FILTER_KINDS = ("dropdown", "checkbox", "multiselect", "textField", "custom")
DIRECTIONS = ("asc", "desc", "none")
SELECTION_MODES = ("multiple", "single", "none")

#: Column settings that may hold code.  SQL text is saved with a view, callables
#: and Column objects are not.
_CODE_FIELDS = ("derive", "derive_late", "drop_when", "sort_key", "facet_label")


_GRID_CODE = ("custom_search", "custom_sort")

#: Filter values that JSON has no type for, under the name they are saved by.
_SAVED_TYPES = {
    "timestamp": (dt.datetime, dt.datetime.isoformat, dt.datetime.fromisoformat),
    "date": (dt.date, dt.date.isoformat, dt.date.fromisoformat),
    "decimal": (Decimal, str, Decimal),
}


class SpecError(ValueError):
    """The spec asks for something the table does not allow."""


@dataclass(frozen=True)
class ColumnSpec:
    """How one column takes part in the view.

    ``derive`` replaces the value that filters, search and facets see;
    ``derive_late`` only changes what is shown.  Both are SQL text, or a
    function ``(value, row) -> Column`` where ``row(name)`` is another raw cell.
    ``drop_when`` is a custom filter, SQL text or ``(value, chosen, row) ->
    Column``; true means *drop the row*.  ``sort_key`` is SQL text or ``(value,
    row) -> Column | list[Column]``.
    """

    name: str
    label: str | None = None
    display: str = "true"
    filterable: bool = True
    sortable: bool = True
    searchable: bool = True
    downloadable: bool = True
    choosable: bool = True
    synthetic: bool = False
    dtype: str = "string"
    filter_kind: str | None = None
    facet_names: tuple | None = None
    facet_label: Any = None
    drop_when: Any = None
    derive: Any = None
    derive_late: Any = None
    sort_key: Any = None
    descending_first: bool = False
    reset_on_third: bool = False
    collation: str = "UNICODE"

    def __post_init__(self):
        display = str(self.display).lower() if isinstance(self.display, bool) else self.display
        object.__setattr__(self, "display", display)
        if display not in DISPLAY_MODES:
            raise SpecError(f"display of {self.name!r} must be one of {DISPLAY_MODES}")
        if self.filter_kind is not None and self.filter_kind not in FILTER_KINDS:
            raise SpecError(f"filter_kind of {self.name!r} must be one of {FILTER_KINDS}")
        if self.facet_names is not None:
            object.__setattr__(self, "facet_names", tuple(self.facet_names))

    @property
    def title(self) -> str:
        return self.label or self.name

    @property
    def visible(self) -> bool:
        return self.display in ("true", "always")


@dataclass(frozen=True)
class SortKey:
    column: str
    direction: str = "asc"

    def __post_init__(self):
        if self.direction not in DIRECTIONS:
            raise SpecError(f"direction must be one of {DIRECTIONS}")


@dataclass(frozen=True)
class DownloadSpec:
    filename: str = "tableDownload.csv"
    separator: str = ","
    displayed_rows_only: bool = False
    displayed_columns_only: bool = False


@dataclass(frozen=True)
class GridSpec:
    """Everything that decides which rows and columns are seen, and in which order.

    ``row_id`` names a unique column of the source.  It fixes the source order,
    breaks ties in sorts and identifies rows in selections.  ``sorts`` holds the
    newest key first: sorting is stable, so earlier sorts still decide ties.
    ``all_label`` is the dropdown's choice that clears its filter; None if a column
    holds that text.
    ``custom_search`` is SQL text or ``(text, row) -> Column``; ``custom_sort`` is SQL
    texts or ``(column, row) -> Column | list[Column]``, used for columns without a
    ``sort_key``.
    """

    columns: tuple[ColumnSpec, ...] = ()
    row_id: str | None = None
    filters: Mapping[str, tuple] = field(default_factory=dict)
    filter_kind: str = "dropdown"
    array_match_all: bool = True
    search_text: str | None = None
    custom_search: Any = None
    case_sensitive: bool = False
    sorts: tuple[SortKey, ...] = ()
    custom_sort: Any = None
    sortable: bool = True
    page: int = 0
    rows_per_page: int = 10
    rows_per_page_options: tuple[int, ...] = (10, 15, 100)
    pagination: bool = True
    column_order: tuple[int, ...] | None = None
    path_separator: str | None = None
    passthrough: bool = False
    total: int | None = None
    selectable_rows: str = "multiple"
    sort_facets: bool = True
    all_label: str | None = "All"
    download: DownloadSpec = field(default_factory=DownloadSpec)

    def __post_init__(self):
        columns = tuple(c if isinstance(c, ColumnSpec) else ColumnSpec(c) for c in self.columns)
        names = [c.name for c in columns]
        if len(set(names)) != len(names):
            raise SpecError("column names must be unique")
        object.__setattr__(self, "columns", columns)
        object.__setattr__(
            self, "filters", {k: _as_values(v) for k, v in dict(self.filters).items()}
        )
        object.__setattr__(self, "sorts", tuple(self.sorts))
        if isinstance(self.custom_sort, list):
            object.__setattr__(self, "custom_sort", tuple(self.custom_sort))
        for name in [*self.filters, *(s.column for s in self.sorts)]:
            self.column(name)
        if self.filter_kind not in FILTER_KINDS:
            raise SpecError(f"filter_kind must be one of {FILTER_KINDS}")
        if self.selectable_rows not in SELECTION_MODES:
            raise SpecError(f"selectable_rows must be one of {SELECTION_MODES}")
        if self.page < 0 or self.rows_per_page < 1:
            raise SpecError("page must be >= 0 and rows_per_page >= 1")
        if self.column_order is not None:
            order = tuple(self.column_order)
            if sorted(order) != list(range(len(columns))):
                raise SpecError("column_order must hold every column index once")
            object.__setattr__(self, "column_order", order)

    # -- lookups ----------------------------------------------------------

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise SpecError(f"no column {name!r}")

    def index_of(self, name: str) -> int:
        self.column(name)
        return [c.name for c in self.columns].index(name)

    @property
    def ordered_columns(self) -> tuple[ColumnSpec, ...]:
        order = self.column_order or range(len(self.columns))
        return tuple(self.columns[i] for i in order)

    @property
    def visible_columns(self) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.ordered_columns if c.visible)

    @property
    def searched_columns(self) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.columns if c.searchable and c.visible)

    # -- columns ----------------------------------------------------------

    def with_column(self, name: str, **changes) -> GridSpec:
        i = self.index_of(name)
        columns = list(self.columns)
        columns[i] = replace(columns[i], **changes)
        return replace(self, columns=tuple(columns))

    def toggle_column(self, name: str) -> GridSpec:
        column = self.column(name)
        if column.display == "always" or not column.choosable:
            raise SpecError(f"column {name!r} cannot be hidden")
        return self.with_column(name, display="false" if column.display == "true" else "true")

    def with_columns(self, columns: Iterable[ColumnSpec | str]) -> GridSpec:
        """Replace the column list; the order survives if the count agrees."""
        columns = tuple(columns)
        kept = {c.name if isinstance(c, ColumnSpec) else c for c in columns}
        return replace(
            self,
            columns=columns,
            column_order=self.column_order if len(columns) == len(self.columns) else None,
            filters={k: v for k, v in self.filters.items() if k in kept},
            sorts=tuple(s for s in self.sorts if s.column in kept),
        )

    def with_column_order(self, order: Iterable[int]) -> GridSpec:
        return replace(self, column_order=tuple(order))

    def move_column(self, name: str, to: str) -> GridSpec:
        """Take a column out of the order and put it where another one stands."""
        order = list(self.column_order or range(len(self.columns)))
        moved, target = self.index_of(name), self.index_of(to)
        place = order.index(target)
        order.remove(moved)
        order.insert(place, moved)
        return replace(self, column_order=tuple(order))

    # -- filters ----------------------------------------------------------

    def kind_of(self, name: str) -> str:
        return self.column(name).filter_kind or self.filter_kind

    def with_filter(self, name: str, values) -> GridSpec:
        """Set the chosen values of one column; nothing chosen clears it."""
        return self.with_filters({name: values})

    def with_filters(self, chosen: Mapping[str, Any]) -> GridSpec:
        """Apply several edits together, as after confirming staged filters."""
        merged = dict(self.filters)
        for name, values in chosen.items():
            self.column(name)
            values = _as_values(values)
            if self.kind_of(name) == "dropdown" and values == (self.all_label,):
                values = ()  # the choice that stands for no choice
            if values:
                merged[name] = values
            else:
                merged.pop(name, None)
        return replace(self, filters=merged, page=0, total=None)

    def toggle_filter_value(self, name: str, value) -> GridSpec:
        """Add the value to the column's set, or take it out if it is there."""
        current = self.filters.get(name, ())
        kept = tuple(v for v in current if not _same(v, value))
        return self.with_filter(name, kept if len(kept) < len(current) else (*current, value))

    def remove_filter_value(self, name: str, value, update=None) -> GridSpec:
        """Remove one chosen value; ``update(filters, name, value)`` may rewrite all."""
        if update is not None:
            rewritten = {k: _as_values(v) for k, v in update(dict(self.filters), name, value).items()}
            kept = {k: v for k, v in rewritten.items() if v}
            return replace(self, filters=kept, page=0, total=None)
        kept = tuple(v for v in self.filters.get(name, ()) if not _same(v, value))
        return self.with_filter(name, kept)

    def reset_filters(self) -> GridSpec:
        """Clear every column filter; search text and page stay."""
        return replace(self, filters={}, total=None)

    # -- search -----------------------------------------------------------

    def with_search(self, text: str | None) -> GridSpec:
        return replace(self, search_text=text or None, page=0, total=None)

    def close_search(self) -> GridSpec:
        return replace(self, search_text=None, total=None)

    # -- sorts ------------------------------------------------------------

    def toggle_sort(self, name: str) -> GridSpec:
        column = self.column(name)
        cycle = ["desc", "asc"] if column.descending_first else ["asc", "desc"]
        if column.reset_on_third:
            cycle.append("none")
        direction = cycle[0]
        if self.sorts and self.sorts[0].column == name:
            at = cycle.index(self.sorts[0].direction) if self.sorts[0].direction in cycle else -1
            direction = cycle[(at + 1) % len(cycle)]
        return self.sort_by(name, direction)

    def sort_by(self, name: str, direction: str = "asc") -> GridSpec:
        if not self.sortable or not self.column(name).sortable:
            raise SpecError(f"column {name!r} is not sortable")
        key = SortKey(name, direction)
        if direction == "none":
            return replace(self, sorts=(key,))
        earlier = tuple(s for s in self.sorts if s.column != name and s.direction != "none")
        return replace(self, sorts=(key, *earlier))

    # -- paging -----------------------------------------------------------

    def go_to(self, page: int) -> GridSpec:
        return replace(self, page=page)

    def with_rows_per_page(self, size: int, total: int) -> GridSpec:
        """Change the page size and keep the page within the rows there are."""
        return replace(self, rows_per_page=size, page=clamp_page(total, size, self.page))

    # -- saved views ------------------------------------------------------

    def to_json(self) -> str:
        """The view without rows or selection.  Code that is not SQL text is left out."""
        state = {f.name: getattr(self, f.name) for f in fields(self)}
        state["columns"] = [_saved_column(c) for c in self.columns]
        state["sorts"] = [{"column": s.column, "direction": s.direction} for s in self.sorts]
        state["filters"] = {k: [_saved_value(x) for x in v] for k, v in self.filters.items()}
        state["download"] = dict(vars(self.download))
        state.pop("total")  # the table may have grown by the time the view is opened
        for name in _GRID_CODE:
            if not _is_text(state[name]):
                state.pop(name)
        return json.dumps(state, ensure_ascii=False, sort_keys=True)

    @classmethod
    def from_json(cls, text: str, code: GridSpec | None = None) -> GridSpec:
        """Restore a view; functions left out of it are taken from ``code``."""
        state = json.loads(text)
        from_code = {c.name: c for c in code.columns} if code else {}
        columns = []
        for saved in state["columns"]:
            known = from_code.get(saved["name"])
            for name in _CODE_FIELDS:
                if known is not None and name not in saved:
                    saved[name] = getattr(known, name)
            columns.append(ColumnSpec(**saved))
        state["columns"] = tuple(columns)
        state["sorts"] = tuple(SortKey(**s) for s in state["sorts"])
        state["filters"] = {
            k: tuple(_restored_value(x) for x in v) for k, v in state["filters"].items()
        }
        state["download"] = DownloadSpec(**state["download"])
        state["rows_per_page_options"] = tuple(state["rows_per_page_options"])
        if code is not None:
            for name in _GRID_CODE:
                state.setdefault(name, getattr(code, name))
        return cls(**state)


def clamp_page(total: int, size: int, page: int) -> int:
    """The page asked for, or the last one there is."""
    pages = 1 if total <= size else math.ceil(total / size)
    return min(page, pages - 1)


def _as_values(values) -> tuple:
    if isinstance(values, (list, tuple, set, frozenset)):
        return tuple(values)
    return () if values == "" else (values,)


def _same(a, b) -> bool:
    return type(a) is type(b) and a == b


def _saved_column(column: ColumnSpec) -> dict:
    saved = {f.name: getattr(column, f.name) for f in fields(column)}
    for name in _CODE_FIELDS:
        if not _is_text(saved[name]):
            saved.pop(name)
    return saved


def _is_text(code) -> bool:
    """Whether code can be saved: SQL text, several of them, or none at all."""
    if isinstance(code, (list, tuple)):
        return all(isinstance(c, str) for c in code)
    return code is None or isinstance(code, str)


def _saved_value(value):
    for name, (kind, write, _) in _SAVED_TYPES.items():
        if isinstance(value, kind):
            return {name: write(value)}
    return value


def _restored_value(value):
    if isinstance(value, dict):
        ((name, text),) = value.items()
        return _SAVED_TYPES[name][2](text)
    return value
