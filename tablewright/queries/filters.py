"""Column filters and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec
from tablewright.queries.registry import query
from tablewright.sources.tables import named_table

CUSTOMER = GridSpec(
    columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    row_id="c_custkey",
)
PART = GridSpec(
    columns=("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    row_id="p_partkey",
)
ORDERS = GridSpec(
    columns=("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
    row_id="o_orderkey",
)
LINES = GridSpec(
    columns=(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
    )
)
# The text of a double in DuckDB, without a zero fraction.
_ACCTBAL = r"regexp_replace(CAST(c_acctbal AS VARCHAR), '\.0$', '')"
_ANY_CUSTOMER = f"""(contains(CAST(c_custkey AS VARCHAR), '{{0}}') OR contains(lower(c_name), '{{0}}')
   OR contains(CAST(c_nationkey AS VARCHAR), '{{0}}') OR contains({_ACCTBAL}, '{{0}}')
   OR contains(lower(c_mktsegment), '{{0}}'))"""


def _rows(spark: SparkSession, folder: str, table: str, spec: GridSpec) -> DataFrame:
    return Grid(named_table(spark, folder, table), spec).rows()


@query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_dropdown(spark: SparkSession, folder: str) -> DataFrame:
    return _rows(spark, folder, "customer", CUSTOMER.with_filter("c_mktsegment", "BUILDING"))


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '5-LOW')"""
)
def filter_checkbox(spark: SparkSession, folder: str) -> DataFrame:
    spec = ORDERS.with_column("o_orderpriority", filter_kind="checkbox")
    for value in ("1-URGENT", "2-HIGH", "5-LOW", "2-HIGH"):  # the second click clears 2-HIGH
        spec = spec.toggle_filter_value("o_orderpriority", value)
    return _rows(spark, folder, "orders", spec)


@query("SELECT * FROM customer WHERE c_nationkey IN (1, 2, 3)")
def filter_multiselect(spark: SparkSession, folder: str) -> DataFrame:
    spec = CUSTOMER.with_column("c_nationkey", filter_kind="multiselect")
    # Matching is strict: the text "7" is no nation key.
    return _rows(spark, folder, "customer", spec.with_filter("c_nationkey", [1, 2, 3, "7"]))


@query("SELECT * FROM part WHERE contains(lower(p_name), 'ring')")
def filter_text(spark: SparkSession, folder: str) -> DataFrame:
    spec = PART.with_column("p_name", filter_kind="textField").with_filter("p_name", "RING")
    return _rows(spark, folder, "part", spec)


@query("SELECT * FROM part WHERE contains(p_brand, 'Brand#2') AND contains(p_name, 'ring')")
def filter_text_cs(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(columns=PART.columns, row_id="p_partkey", filter_kind="textField",
                    case_sensitive=True)
    spec = spec.with_filters({"p_brand": "Brand#2", "p_name": "ring"})
    return _rows(spark, folder, "part", spec)


def _tagged(spark: SparkSession, folder: str, match_all: bool) -> DataFrame:
    part = named_table(spark, folder, "part").withColumn("tags", F.split("p_name", " "))
    spec = GridSpec(
        columns=("p_partkey", "p_name", ColumnSpec("tags", display="false")),
        row_id="p_partkey",
        array_match_all=match_all,
    )
    return Grid(part, spec.with_filter("tags", ["red", "ring"])).rows()


@query(
    """SELECT p_partkey, p_name FROM part
       WHERE list_has_all(string_split(p_name, ' '), ['red', 'ring'])"""
)
def filter_array_all(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged(spark, folder, True)


@query(
    """SELECT p_partkey, p_name FROM part
       WHERE list_has_any(string_split(p_name, ' '), ['red', 'ring'])"""
)
def filter_array_any(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged(spark, folder, False)


def _outside(value: Column, chosen: tuple, row) -> Column:
    low, high = chosen
    return (value < low) | (value > high)


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus
       FROM lineitem WHERE l_extendedprice BETWEEN 20000 AND 40000"""
)
def filter_custom_range(spark: SparkSession, folder: str) -> DataFrame:
    spec = LINES.with_column("l_extendedprice", filter_kind="custom", drop_when=_outside)
    spec = spec.with_filter("l_extendedprice", (20000, 40000))
    return _rows(spark, folder, "lineitem", spec)


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus
       FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity IN (10, 20, 30)"""
)
def filter_and(spark: SparkSession, folder: str) -> DataFrame:
    """Staged edits of several columns, confirmed together."""
    staged = {"l_returnflag": "R", "l_linestatus": "F", "l_quantity": [10, 20, 30]}
    return _rows(spark, folder, "lineitem", LINES.with_filters(staged))


@query("SELECT * FROM customer WHERE " + _ANY_CUSTOMER.format("00"))
def filter_reset(spark: SparkSession, folder: str) -> DataFrame:
    """Filters go, the search text stays."""
    spec = CUSTOMER.with_filter("c_mktsegment", "BUILDING").with_search("00").reset_filters()
    return _rows(spark, folder, "customer", spec)


@query("SELECT * FROM customer WHERE " + _ANY_CUSTOMER.format("12"))
def search_any(spark: SparkSession, folder: str) -> DataFrame:
    return _rows(spark, folder, "customer", CUSTOMER.with_search("12"))


@query(
    """SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part
       WHERE contains(lower(p_name), 'm') OR contains(lower(p_type), 'm')"""
)
def search_visible_only(spark: SparkSession, folder: str) -> DataFrame:
    spec = (
        PART.with_column("p_size", display="false")
        .with_column("p_brand", searchable=False)
        .with_search("M")
    )
    return _rows(spark, folder, "part", spec)


@query("SELECT * FROM customer WHERE starts_with(c_mktsegment, 'MA') AND c_acctbal > 0")
def search_custom(spark: SparkSession, folder: str) -> DataFrame:
    def starts_and_owes(text: str, row) -> Column:
        return F.startswith(row("c_mktsegment"), F.lit(text)) & (row("c_acctbal") > 0)

    spec = GridSpec(columns=CUSTOMER.columns, row_id="c_custkey", custom_search=starts_and_owes)
    return _rows(spark, folder, "customer", spec.with_search("MA"))


@query(
    "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND "
    + _ANY_CUSTOMER.format("77")
)
def search_and_filter(spark: SparkSession, folder: str) -> DataFrame:
    spec = CUSTOMER.with_filter("c_mktsegment", ["BUILDING", "MACHINERY"]).with_search("77")
    return _rows(spark, folder, "customer", spec)


@query("SELECT * FROM customer")
def search_empty(spark: SparkSession, folder: str) -> DataFrame:
    return _rows(spark, folder, "customer", CUSTOMER.with_search("12").with_search(""))
