"""CSV export and saved views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.ordering import with_positions
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, DownloadSpec, GridSpec, SortKey
from tablewright.queries.filters import CUSTOMER
from tablewright.queries.registry import query
from tablewright.sources import export
from tablewright.sources.tables import named_table


def _sql_cell(text: str) -> str:
    """SQL of one quoted cell that holds a text."""
    doubled = f"replace(coalesce({text}, ''), '\"', '\"\"')"
    return f"""'"' || regexp_replace({doubled}, '^([-+=@])', '''\\1') || '"'"""


def _sql_plain(number: str) -> str:
    return f"""'"' || coalesce(CAST({number} AS VARCHAR), '') || '"'"""


_ACCTBAL = r"""'"' || regexp_replace(CAST({} AS VARCHAR), '\.0$', '') || '"'"""


@query(
    "SELECT doc_id, "
    + " || ',' || ".join(
        [_sql_plain("doc_id"), _sql_cell("text"), _sql_cell("lang"), _sql_cell("source"),
         _sql_plain("n_chars")]
    )
    + " AS line FROM documents"
)
def csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All rows, filters and search ignored, hidden columns included."""
    spec = GridSpec(
        columns=("doc_id", "text", ColumnSpec("lang", display="false"), "source", "n_chars"),
        row_id="doc_id",
        filters={"source": ("src1",)},
        search_text="the",
    )
    return export.csv_lines(Grid(named_table(spark, folder, "documents"), spec))


@query(
    f"""SELECT CAST(1 AS BIGINT) AS pos, '"key","Name","''=s_nationkey"' AS line
        UNION ALL
        SELECT 1 + row_number() OVER (ORDER BY s_nationkey DESC, s_suppkey),
               {_sql_plain("s_suppkey")} || ',' || {_sql_cell("s_name")} || ','
               || {_sql_plain("s_nationkey")}
        FROM supplier"""
)
def csv_header(spark: SparkSession, folder: str) -> DataFrame:
    """The header line first, then the body in the current sort order."""
    spec = GridSpec(
        columns=(
            ColumnSpec("s_suppkey", label="key"),
            ColumnSpec("s_name", label="Name"),
            ColumnSpec("s_nationkey", label="=s_nationkey"),
        ),
        row_id="s_suppkey",
        sorts=(SortKey("s_nationkey", "desc"),),
    )
    csv = export.csv_frame(Grid(named_table(spark, folder, "supplier"), spec))
    return with_positions(csv.rows, csv.order).select("pos", csv.line)


@query(
    "SELECT s_suppkey, "
    + " || ';' || ".join(
        [_sql_plain("s_suppkey"), _sql_cell("s_name"), _ACCTBAL.format("s_acctbal")]
    )
    + " AS line FROM supplier"
)
def csv_separator(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=(
            "s_suppkey",
            "s_name",
            ColumnSpec("s_nationkey", downloadable=False),
            "s_acctbal",
        ),
        row_id="s_suppkey",
        download=DownloadSpec(separator=";"),
    )
    return export.csv_lines(Grid(named_table(spark, folder, "supplier"), spec))


@query(
    "SELECT c_custkey, "
    + " || ',' || ".join(
        [
            _sql_plain("c_custkey"),
            _sql_cell("lower(c_name)"),
            _ACCTBAL.format("c_acctbal"),
            _sql_cell("c_mktsegment"),
        ]
    )
    + " AS line FROM customer WHERE c_mktsegment = 'BUILDING'"
)
def csv_displayed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Filtered rows with displayed values; a value derived late is exported raw."""
    spec = GridSpec(
        columns=(
            "c_custkey",
            ColumnSpec("c_name", derive="lower(c_name)"),
            ColumnSpec("c_acctbal", derive_late="concat('$', c_acctbal)"),
            "c_mktsegment",
        ),
        row_id="c_custkey",
        filters={"c_mktsegment": ("BUILDING",)},
        download=DownloadSpec(displayed_rows_only=True),
    )
    return export.csv_lines(Grid(named_table(spark, folder, "customer"), spec))


@query(
    "SELECT c_custkey, "
    + " || ',' || ".join([_sql_cell("c_mktsegment"), _sql_cell("c_name")])
    + " AS line FROM customer"
)
def csv_displayed_cols(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=(
            ColumnSpec("c_custkey", display="excluded"),
            "c_name",
            ColumnSpec("c_acctbal", display="false"),
            "c_mktsegment",
        ),
        row_id="c_custkey",
        column_order=(3, 2, 1, 0),
        download=DownloadSpec(displayed_columns_only=True),
    )
    return export.csv_lines(Grid(named_table(spark, folder, "customer"), spec))


_PREFIXED = """CASE o_orderstatus WHEN 'P' THEN '=' WHEN 'F' THEN '-' ELSE 'x@' END
               || o_orderpriority || '"'"""


@query(
    "SELECT o_orderkey, "
    + " || ',' || ".join([_sql_cell(f"({_PREFIXED})"), _sql_plain("-o_orderkey")])
    + " AS line FROM orders"
)
def csv_formula_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that a spreadsheet would run are guarded; negative numbers are not."""
    orders = named_table(spark, folder, "orders").select(
        "o_orderkey",
        F.expr(
            "case o_orderstatus when 'P' then '=' when 'F' then '-' else 'x@' end"
            " || o_orderpriority || '\"'"
        ).alias("note"),
        (-F.col("o_orderkey")).alias("negative"),
    )
    spec = GridSpec(
        columns=(ColumnSpec("o_orderkey", downloadable=False), "note", "negative"),
        row_id="o_orderkey",
    )
    return export.csv_lines(Grid(orders, spec))


@query(
    """SELECT c_custkey, c_name AS customer, c_nationkey, c_acctbal, c_mktsegment
       FROM customer
       WHERE c_mktsegment = 'BUILDING' AND contains(c_name, '00') AND c_acctbal <= 5000
       ORDER BY c_acctbal DESC, c_custkey LIMIT 100"""
)
def saved_view(spark: SparkSession, folder: str) -> DataFrame:
    """A view saved as JSON and restored gives the same page."""
    spec = (
        CUSTOMER.with_column("c_name", label="customer")
        .with_column("c_custkey", searchable=False)
        .with_column("c_nationkey", searchable=False)
        .with_column("c_acctbal", searchable=False, drop_when="c_acctbal > 5000")
        .with_filters({"c_mktsegment": "BUILDING", "c_acctbal": "at most 5000"})
        .with_search("00")
        .sort_by("c_acctbal", "desc")
        .with_rows_per_page(100, total=0)
    )
    restored = GridSpec.from_json(spec.to_json())
    return Grid(named_table(spark, folder, "customer"), restored).page()
