"""From a spec and a source frame to one lazy DataFrame.

The order of steps is fixed: declared columns -> derived cells -> filters and
search -> sort -> page -> late derived cells -> visible columns under their
labels.  Filters come before the sort; with the row key as the last sort key the
result is the same as sorting first, and the sort sees fewer rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators import paging, predicates
from tablewright.operators.cells import code, nested, path_type
from tablewright.operators.ordering import Key, cell_key, ordered, with_positions
from tablewright.plans.spec import ColumnSpec, GridSpec, SpecError

#: Column that identifies rows when the source names no key of its own.
ROW_ID = "_row_id"
_SHOWN = "_tw_shown_"


def with_row_id(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Number the rows of a source once, at ingest.

    Numbers rise in file order and are unique, but have gaps.  They depend on how
    the files are split and keep filters from reaching the scan, so write the
    numbered table and work on that. Parquet tables can be numbered without gaps
    (:func:`tablewright.sources.tables.numbered_table`).
    """
    return df.withColumn(name, F.monotonically_increasing_id())


class Grid:
    """The plans behind one view of one table."""

    def __init__(self, source: DataFrame, spec: GridSpec):
        self.source = source
        self.spec = spec
        self._row_id = spec.row_id or (ROW_ID if ROW_ID in source.columns else None)

    @property
    def row_id(self) -> str:
        """The unique column that fixes the order and identifies rows."""
        if self._row_id is None:
            raise SpecError("set row_id, or add a key at ingest with with_row_id")
        return self._row_id

    @property
    def _total(self) -> int | None:
        """The caller's row count, which counts only where no filter or search is applied here."""
        return self.spec.total if self.spec.passthrough or not self.filter_tests() else None

    # -- rows ------------------------------------------------------------

    @cached_property
    def table(self) -> DataFrame:
        """Declared columns with their raw values, and the row key."""
        source, spec = self.source, self.spec
        columns = {}
        for c in spec.columns:
            if c.synthetic:
                columns[c.name] = F.lit(None).cast(c.dtype)
            elif path_type(source.schema, c.name, spec.path_separator) is not None:
                columns[c.name] = nested(c.name, spec.path_separator)
            elif spec.path_separator and spec.path_separator in c.name:
                columns[c.name] = F.lit(None).cast(c.dtype)
            else:
                raise SpecError(f"the table has no column {c.name!r}")
        if self._row_id is not None:
            columns.setdefault(self._row_id, quoted(self._row_id))
        return source.select(*[v.alias(k) for k, v in columns.items()])

    @cached_property
    def derived(self) -> DataFrame:
        """The table with derived cells beside the raw ones."""
        shown = {
            _SHOWN + c.name: code(c.derive, quoted(c.name), quoted)
            for c in self.spec.columns
            if c.derive is not None
        }
        return self.table.withColumns(shown) if shown else self.table

    @cached_property
    def displayed(self) -> DataFrame:
        """The rows that pass every filter and the search, in no order."""
        if self.spec.passthrough:
            return self.derived
        rows = self.derived
        for test in self.filter_tests():
            rows = rows.filter(test)
        return rows

    def shown(self, c: ColumnSpec) -> Column:
        """The cell as filters, search and facets see it."""
        return quoted(_SHOWN + c.name) if c.derive is not None else quoted(c.name)

    def shown_type(self, c: ColumnSpec) -> T.DataType:
        name = _SHOWN + c.name if c.derive is not None else c.name
        return self.derived.schema[name].dataType

    def filter_tests(self) -> list[Column]:
        """One test per filtered column, and one for the search."""
        tests = list(self.column_tests().values())
        return [*tests, self.search_test()] if self.spec.search_text else tests

    def column_tests(self) -> dict[str, Column]:
        """The test of each filtered column, by its name."""
        spec, tests = self.spec, {}
        for c in spec.columns:
            chosen = spec.filters.get(c.name, ())
            kind = spec.kind_of(c.name)
            if chosen or kind == "custom":
                tests[c.name] = self._column_test(c, chosen, kind)
        return tests

    def _column_test(self, c: ColumnSpec, chosen: tuple, kind: str) -> Column:
        cell, dtype = self.shown(c), self.shown_type(c)
        if c.drop_when is not None:
            return predicates.keep_unless(code(c.drop_when, cell, chosen, quoted))
        if not chosen:
            raise SpecError(f"custom filter of {c.name!r} needs drop_when or chosen values")
        if kind == "textField":
            return predicates.text_filter(cell, chosen, dtype, self.spec.case_sensitive)
        if isinstance(dtype, T.ArrayType):
            return predicates.array_has(cell, chosen, dtype, self.spec.array_match_all)
        return predicates.one_of(cell, chosen, dtype)

    def search_test(self) -> Column:
        spec = self.spec
        if spec.custom_search is None:
            cells = [(self.shown(c), self.shown_type(c)) for c in spec.searched_columns]
            return predicates.search(cells, spec.search_text, spec.case_sensitive)
        test = code(spec.custom_search, spec.search_text, quoted)
        if not isinstance(self.derived.select(test).schema[0].dataType, T.BooleanType):
            raise SpecError("custom_search must be boolean")
        return test

    # -- order -----------------------------------------------------------

    @cached_property
    def order(self) -> list[Key]:
        """Sort keys, newest first, closed by the row key."""
        keys = []
        for sort in self.spec.sorts:
            c = self.spec.column(sort.column)
            if not self.spec.sortable or not c.sortable:
                raise SpecError(f"column {c.name!r} is not sortable")
            if sort.direction == "none":
                break
            down = sort.direction == "desc"
            if c.sort_key is not None:
                keys += _custom_keys(c.sort_key, down, quoted(c.name), quoted)
            elif self.spec.custom_sort is not None:
                keys += _custom_keys(self.spec.custom_sort, down, c.name, quoted)
            else:
                dtype = self.table.schema[c.name].dataType
                keys.append(Key(cell_key(quoted(c.name), dtype, c.collation), down))
        return [*keys, Key(quoted(self.row_id))]

    def sorted(self) -> DataFrame:
        """All displayed rows in order."""
        return self.displayed if self.spec.passthrough else ordered(self.displayed, self.order)

    def with_positions(self, name: str = "pos") -> DataFrame:
        """All displayed rows with their place in the order."""
        return with_positions(self.displayed, self.order, name)

    # -- results ---------------------------------------------------------

    def page(self) -> DataFrame:
        """The rows of the current page, as shown."""
        spec = self.spec
        if spec.passthrough:
            return self.project(self.displayed)
        if not spec.pagination:
            return self.project(self.sorted())
        rows = paging.page_rows(
            self.displayed, self.order, spec.page, spec.rows_per_page, self._total
        )
        return self.project(rows)

    def rows(self) -> DataFrame:
        """All displayed rows, as shown, in no order."""
        return self.project(self.displayed)

    def page_info(self) -> DataFrame:
        spec = self.spec
        return paging.page_info(self.displayed, spec.page, spec.rows_per_page, self._total)

    def project(self, rows: DataFrame, *extra: str) -> DataFrame:
        """Visible columns in order, under their labels; ``extra`` columns go along."""
        cells = []
        for c in self.spec.visible_columns:
            cell = self.shown(c)
            if c.derive_late is not None:
                cell = code(c.derive_late, quoted(c.name), quoted)
            cells.append(cell.alias(c.title))
        return rows.select(*[quoted(e) for e in extra], *cells)

    def keys(self) -> DataFrame:
        """Row keys of the displayed rows."""
        return self.displayed.select(quoted(self.row_id))


def _custom_keys(made, down: bool, *arguments) -> list[Key]:
    """Keys out of spec code that gives one expression or several."""
    if callable(made) and not isinstance(made, Column):
        made = made(*arguments)
    made = made if isinstance(made, (list, tuple)) else [made]
    return [Key(code(key), down, costly=True) for key in made]
