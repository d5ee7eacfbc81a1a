"""Selections, deletions and the summary row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import rowset
from tablewright.operators.summary import summary_row as summary_of
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import GridSpec, SortKey
from tablewright.queries.filters import CUSTOMER, ORDERS
from tablewright.queries.registry import query
from tablewright.sources.tables import named_table

# Customers with an order of more than this form the selection.
_LARGE = 450000
_SELECTED = f"SELECT o_custkey FROM orders WHERE o_totalprice > {_LARGE}"


def _selection(spark: SparkSession, folder: str) -> DataFrame:
    orders = named_table(spark, folder, "orders").filter(F.col("o_totalprice") > _LARGE)
    return orders.select(F.col("o_custkey").alias("c_custkey"))


@query(f"SELECT * FROM customer WHERE c_custkey IN ({_SELECTED})")
def select_rows(spark: SparkSession, folder: str) -> DataFrame:
    customer = named_table(spark, folder, "customer")
    return rowset.select_rows(customer, "c_custkey", _selection(spark, folder))


@query("SELECT * FROM customer WHERE c_custkey IN (1, 5, 99)")
def select_listed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ticked one by one."""
    keys: list = []
    for row in (1, 5, 42, 99, 42):
        keys = rowset.toggle_row(keys, row)
    return rowset.select_rows(named_table(spark, folder, "customer"), "c_custkey", keys)


@query(f"SELECT * FROM customer WHERE c_custkey NOT IN ({_SELECTED})")
def delete_rows(spark: SparkSession, folder: str) -> DataFrame:
    customer = named_table(spark, folder, "customer")
    return rowset.delete_rows(customer, "c_custkey", _selection(spark, folder))


@query(f"SELECT count(*) AS selected FROM customer WHERE c_custkey IN ({_SELECTED})")
def select_count(spark: SparkSession, folder: str) -> DataFrame:
    customer = named_table(spark, folder, "customer")
    return rowset.selected_count(customer, "c_custkey", _selection(spark, folder))


@query("SELECT * FROM customer WHERE c_acctbal > 0 AND c_nationkey <> 3")
def select_predicate(spark: SparkSession, folder: str) -> DataFrame:
    return rowset.selectable_rows(
        named_table(spark, folder, "customer"), "c_acctbal > 0 AND c_nationkey <> 3"
    )


_SHOWN = "c_mktsegment IN ('BUILDING', 'MACHINERY')"


def _shown(spark: SparkSession, folder: str) -> Grid:
    spec = CUSTOMER.with_filter("c_mktsegment", ["BUILDING", "MACHINERY"])
    return Grid(named_table(spark, folder, "customer"), spec)


@query(f"SELECT c_custkey FROM customer WHERE {_SHOWN} AND c_acctbal > 0")
def select_all_displayed(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing is selected: the header box selects all displayed selectable rows."""
    return rowset.toggle_displayed(_shown(spark, folder), [], "c_acctbal > 0")


@query(
    f"""SELECT c_custkey FROM customer WHERE c_nationkey = 3
          AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE {_SHOWN} AND c_acctbal > 0)"""
)
def deselect_displayed(spark: SparkSession, folder: str) -> DataFrame:
    """Something is selected: the displayed selectable rows leave the selection."""
    selected = named_table(spark, folder, "customer").filter("c_nationkey = 3")
    return rowset.toggle_displayed(_shown(spark, folder), selected, "c_acctbal > 0")


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority
       FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders)
       WHERE n BETWEEN 1001 AND 1300 AND o_orderstatus <> 'P'"""
)
def select_range(spark: SparkSession, folder: str) -> DataFrame:
    """Rows between two clicked places, those that may be selected."""
    spec = GridSpec(
        columns=ORDERS.columns, row_id="o_orderkey", sorts=(SortKey("o_totalprice"),)
    )
    grid = Grid(named_table(spark, folder, "orders"), spec)
    return rowset.select_range(grid, 1300, 1001, "o_orderstatus <> 'P'")


@query(
    """SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price,
              min(l_discount) AS least_discount, max(l_discount) AS most_discount,
              round(avg(l_quantity), 6) AS mean_quantity, count(*) AS n
       FROM lineitem WHERE l_returnflag = 'R'"""
)
def summary_row(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=("l_quantity", "l_extendedprice", "l_discount", "l_returnflag"),
        filters={"l_returnflag": ("R",)},
    )
    cells = {
        "quantity": "cast(sum(cast(l_quantity as decimal(18, 2))) as double)",
        "price": "cast(sum(cast(l_extendedprice as decimal(18, 2))) as double)",
        "least_discount": "min(l_discount)",
        "most_discount": "max(l_discount)",
        "mean_quantity": "round(avg(l_quantity), 6)",
        "n": "count(*)",
    }
    return summary_of(Grid(named_table(spark, folder, "lineitem"), spec).displayed, cells)
