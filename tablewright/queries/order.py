"""Facets, sorts and pages.

Results are compared as sets, so queries about order carry each row's place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.facets import facet_values as facets_of
from tablewright.operators.facets import ordered_facets
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec, SortKey
from tablewright.queries.filters import CUSTOMER, ORDERS, PART
from tablewright.queries.registry import query
from tablewright.sources.tables import named_table

SUPPLIER = GridSpec(
    columns=("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), row_id="s_suppkey"
)


def _facet_spec(row_id: str, *columns: ColumnSpec, **options) -> GridSpec:
    return GridSpec(
        columns=(ColumnSpec(row_id, filterable=False), *columns), row_id=row_id, **options
    )


# -- facets -------------------------------------------------------------------


@query(
    """SELECT 'c_mktsegment' AS "column", nullif(c_mktsegment, 'BUILDING') AS value,
              min(c_custkey) AS first_seen FROM customer GROUP BY ALL
       UNION ALL
       SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), min(c_custkey)
       FROM customer GROUP BY ALL"""
)
def facet_values(spark: SparkSession, folder: str) -> DataFrame:
    """All filterable columns in one pass, null kept, filters ignored."""
    customer = named_table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    spec = _facet_spec(
        "c_custkey",
        ColumnSpec("c_name", filterable=False),
        ColumnSpec("c_nationkey"),
        ColumnSpec("c_mktsegment"),
    ).with_filter("c_nationkey", 3)
    return facets_of(Grid(customer, spec))


@query(
    """SELECT 'words' AS "column", word AS value, min(p_partkey) AS first_seen
       FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
       GROUP BY word"""
)
def facet_array(spark: SparkSession, folder: str) -> DataFrame:
    part = named_table(spark, folder, "part").withColumn("words", F.split("p_name", " "))
    return facets_of(Grid(part, _facet_spec("p_partkey", ColumnSpec("words"))))


@query(
    """SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, o_orderpriority AS label,
              row_number() OVER (ORDER BY o_orderpriority) AS pos
       FROM orders GROUP BY o_orderpriority
       UNION ALL SELECT * FROM (VALUES ('o_orderstatus', 'O', 'O', 1), ('o_orderstatus', 'P', 'P', 2),
                                       ('o_orderstatus', 'X', 'X', 3)) AS t"""
)
def facet_names(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed list takes the place of one column's values."""
    spec = _facet_spec(
        "o_orderkey",
        ColumnSpec("o_orderstatus", facet_names=("X", "P", "O")),
        ColumnSpec("o_orderpriority"),
    )
    return ordered_facets(Grid(named_table(spark, folder, "orders"), spec))


@query(
    r"""SELECT 'p_brand' AS "column", p_brand AS value, p_brand AS label,
               row_number() OVER (ORDER BY CAST(regexp_extract(p_brand, '\d+') AS INTEGER)) AS pos
        FROM part GROUP BY p_brand
        UNION ALL
        SELECT 'p_size', CAST(p_size AS VARCHAR), CAST(p_size AS VARCHAR),
               row_number() OVER (ORDER BY p_size)
        FROM part GROUP BY p_size
        UNION ALL
        SELECT 'p_partkey', CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR),
               row_number() OVER (ORDER BY p_partkey)
        FROM part GROUP BY p_partkey"""
)
def facet_natural_order(spark: SparkSession, folder: str) -> DataFrame:
    """Digit runs by value; one column is unique, so places are counted across parts."""
    spec = GridSpec(columns=("p_partkey", "p_brand", "p_size"), row_id="p_partkey")
    return ordered_facets(Grid(named_table(spark, folder, "part"), spec))


@query(
    """SELECT c AS "column", v AS value, v AS label,
              row_number() OVER (PARTITION BY c ORDER BY min(o_orderkey)) AS pos
       FROM (SELECT 'o_orderstatus' AS c, o_orderstatus AS v, o_orderkey FROM orders
             UNION ALL SELECT 'o_orderpriority', o_orderpriority, o_orderkey FROM orders)
       GROUP BY c, v"""
)
def facet_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    spec = _facet_spec(
        "o_orderkey",
        ColumnSpec("o_orderstatus"),
        ColumnSpec("o_orderpriority"),
        sort_facets=False,
    )
    return ordered_facets(Grid(named_table(spark, folder, "orders"), spec))


@query(
    """SELECT 'o_orderstatus' AS "column", o_orderstatus AS value,
              'Status ' || lower(o_orderstatus) AS label,
              row_number() OVER (ORDER BY o_orderstatus) AS pos
       FROM orders GROUP BY o_orderstatus"""
)
def facet_label(spark: SparkSession, folder: str) -> DataFrame:
    label = "concat('Status ', lower(value))"
    spec = _facet_spec("o_orderkey", ColumnSpec("o_orderstatus", facet_label=label))
    return ordered_facets(Grid(named_table(spark, folder, "orders"), spec))


@query(
    """SELECT 'p_brand' AS "column", p_brand || ' ' || p_type AS value,
              min(p_partkey) AS first_seen
       FROM part GROUP BY p_brand || ' ' || p_type"""
)
def facet_derived(spark: SparkSession, folder: str) -> DataFrame:
    derived = "concat(p_brand, ' ', p_type)"
    spec = _facet_spec(
        "p_partkey",
        ColumnSpec("p_type", filterable=False),
        ColumnSpec("p_brand", derive=derived),
    )
    return facets_of(Grid(named_table(spark, folder, "part"), spec))


# -- sorts --------------------------------------------------------------------


def _placed(df: DataFrame, spec: GridSpec) -> DataFrame:
    grid = Grid(df, spec)
    return grid.project(grid.with_positions(), "pos")


@query(
    """SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) AS pos
       FROM part"""
)
def sort_string(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(columns=("p_partkey", "p_name"), row_id="p_partkey").sort_by("p_name")
    return _placed(named_table(spark, folder, "part"), spec)


@query(
    """SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS pos
       FROM customer"""
)
def sort_numeric(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(columns=("c_custkey", "c_acctbal"), row_id="c_custkey").sort_by("c_acctbal")
    return _placed(named_table(spark, folder, "customer"), spec)


@query(
    """SELECT o_orderkey, o_totalprice,
              row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos FROM orders"""
)
def sort_desc(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(columns=("o_orderkey", "o_totalprice"), row_id="o_orderkey")
    spec = spec.toggle_sort("o_totalprice").toggle_sort("o_totalprice")
    return _placed(named_table(spark, folder, "orders"), spec)


@query(
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
              row_number() OVER (ORDER BY nullif(c_mktsegment, 'BUILDING') DESC NULLS LAST,
                                 c_custkey) AS pos
       FROM customer"""
)
def sort_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Null stands where an empty text would: first ascending, last descending."""
    customer = named_table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    spec = GridSpec(columns=("c_custkey", "c_mktsegment"), row_id="c_custkey")
    return _placed(customer, spec.sort_by("c_mktsegment", "desc"))


@query(
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS pos
       FROM orders"""
)
def sort_none(spark: SparkSession, folder: str) -> DataFrame:
    """The third toggle brings back the source order."""
    column = ColumnSpec("o_orderstatus", reset_on_third=True)
    spec = GridSpec(columns=("o_orderkey", column), row_id="o_orderkey")
    for _ in range(3):
        spec = spec.toggle_sort("o_orderstatus")
    return _placed(named_table(spark, folder, "orders"), spec)


@query(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice,
              row_number() OVER (ORDER BY o_orderpriority, o_orderstatus DESC, o_totalprice,
                                 o_orderkey) AS pos
       FROM orders"""
)
def sort_multi(spark: SparkSession, folder: str) -> DataFrame:
    """Sorts are stable: the newest decides, earlier ones break its ties."""
    spec = (
        ORDERS.sort_by("o_totalprice").sort_by("o_orderstatus", "desc").sort_by("o_orderpriority")
    )
    return _placed(named_table(spark, folder, "orders"), spec)


@query(
    """SELECT o_orderkey, o_orderpriority,
              row_number() OVER (ORDER BY CAST(substr(o_orderpriority, 1, 1) AS INTEGER) DESC,
                                 o_orderkey) AS pos
       FROM orders"""
)
def sort_key_expr(spark: SparkSession, folder: str) -> DataFrame:
    column = ColumnSpec("o_orderpriority", sort_key="cast(substr(o_orderpriority, 1, 1) as int)")
    spec = GridSpec(columns=("o_orderkey", column), row_id="o_orderkey")
    return _placed(named_table(spark, folder, "orders"), spec.sort_by("o_orderpriority", "desc"))


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice,
              row_number() OVER (ORDER BY length(CAST(o_orderkey AS VARCHAR)), o_totalprice,
                                 o_orderkey) AS pos
       FROM orders"""
)
def sort_custom(spark: SparkSession, folder: str) -> DataFrame:
    """A whole-table sort gives a list of keys."""

    def keys(column: str, row) -> list:
        return [F.length(row("o_orderkey").cast("string")), row(column)]

    spec = GridSpec(
        columns=("o_orderkey", "o_orderstatus", "o_totalprice"),
        row_id="o_orderkey",
        custom_sort=keys,
    )
    return _placed(named_table(spark, folder, "orders"), spec.sort_by("o_totalprice"))


@query(
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal,
              row_number() OVER (ORDER BY s_nationkey DESC, s_suppkey) AS pos FROM supplier"""
)
def sort_initial(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=SUPPLIER.columns, row_id="s_suppkey", sorts=(SortKey("s_nationkey", "desc"),)
    )
    return _placed(named_table(spark, folder, "supplier"), spec)


# -- pages --------------------------------------------------------------------

_BY_PRICE = """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
               ORDER BY o_totalprice DESC, o_orderkey"""


def _by_price(page: int, size: int) -> GridSpec:
    return GridSpec(
        columns=ORDERS.columns,
        row_id="o_orderkey",
        sorts=(SortKey("o_totalprice", "desc"),),
        page=page,
        rows_per_page=size,
    )


@query(_BY_PRICE + " LIMIT 15 OFFSET 45")
def page_slice(spark: SparkSession, folder: str) -> DataFrame:
    return Grid(named_table(spark, folder, "orders"), _by_price(3, 15)).page()


@query(_BY_PRICE + " LIMIT 100 OFFSET (SELECT CAST(count(*) // 200 * 100 AS BIGINT) FROM orders)")
def page_deep(spark: SparkSession, folder: str) -> DataFrame:
    """A page in the middle: only row keys are sorted, then the page is fetched."""
    orders = named_table(spark, folder, "orders")
    middle = orders.count() // 200
    return Grid(orders, _by_price(middle, 100)).page()


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority
       FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n,
                    count(*) OVER () AS total
             FROM orders)
       WHERE (n - 1) // 15 = (total - 1) // 15"""
)
def page_last(spark: SparkSession, folder: str) -> DataFrame:
    """A page beyond the end shows the last one."""
    return Grid(named_table(spark, folder, "orders"), _by_price(10**9, 15)).page()


@query(
    """SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey
       LIMIT 100 OFFSET (SELECT (count(*) - 1) // 100 * 100 FROM customer
                         WHERE c_mktsegment = 'BUILDING')"""
)
def page_clamp(spark: SparkSession, folder: str) -> DataFrame:
    """A filter left fewer pages than the page asked for."""
    spec = CUSTOMER.with_filter("c_mktsegment", "BUILDING")
    customer = named_table(spark, folder, "customer")
    total = Grid(customer, spec).displayed.count()
    spec = spec.go_to(10**6).with_rows_per_page(100, total)
    return Grid(customer, spec).page()


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_size < 10")
def page_off(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=(*PART.columns[:4], ColumnSpec("p_size", drop_when="p_size >= 10"), PART.columns[5]),
        row_id="p_partkey",
        pagination=False,
        filters={"p_size": ("below 10",)},
        sorts=(SortKey("p_name"),),
    )
    return Grid(named_table(spark, folder, "part"), spec).page()


@query(_BY_PRICE + " LIMIT 10")
def topk(spark: SparkSession, folder: str) -> DataFrame:
    return Grid(named_table(spark, folder, "orders"), _by_price(0, 10)).page()


@query(
    """WITH c AS (SELECT count(*) AS total FROM orders WHERE o_orderstatus = 'F')
       SELECT total, CAST(greatest((total + 14) // 15, 1) AS BIGINT) AS pages, CAST(2 AS BIGINT) AS page,
              CAST(31 AS BIGINT) AS first, least(total, 45) AS last FROM c"""
)
def page_info(spark: SparkSession, folder: str) -> DataFrame:
    spec = GridSpec(
        columns=ORDERS.columns,
        row_id="o_orderkey",
        filters={"o_orderstatus": ("F",)},
        page=2,
        rows_per_page=15,
    )
    return Grid(named_table(spark, folder, "orders"), spec).page_info()
