"""Views read through what was stored for them, row numbers, comparators, JSON of any shape, shifted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.comparators import with_comparator_rank
from tablewright.operators.facet_counts import (
    build_facet_bitmaps,
    counted_by_bitmaps,
    displayed_by_bitmaps,
)
from tablewright.operators.facet_counts import facet_counts as counts_of
from tablewright.operators.facet_refresh import counted_facets, update_with_facets
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec, SortKey
from tablewright.queries.filters import _ANY_CUSTOMER, CUSTOMER, ORDERS
from tablewright.queries.registry import query
from tablewright.sources.alignment import Header, aligned
from tablewright.sources.order_index import build_order_index, indexed_page, indexed_page_info
from tablewright.sources.scratch import scratch_path
from tablewright.sources.tables import named_table, numbered_table
from tablewright.sources.text_index import build_text_index, indexed_grid
from tablewright.sources.variants import variant_columns

#: Files that a table is dealt to before it is indexed.
FILES = 16


def _dealt(spark: SparkSession, folder: str, name: str, key: str) -> str:
    """A path with the table in files by ranges of a key."""
    path = scratch_path(spark, name)
    named_table(spark, folder, name).repartitionByRange(FILES, key).write.parquet(path)
    return path


def _indexed_customer(spark: SparkSession, folder: str, spec: GridSpec) -> DataFrame:
    path, index = _dealt(spark, folder, "customer", "c_custkey"), scratch_path(spark, "grams")
    build_text_index(spark, path, [c.name for c in CUSTOMER.columns], index)
    return indexed_grid(spark, path, spec, index).rows()


@query("SELECT * FROM customer WHERE " + _ANY_CUSTOMER.format("0012"))
def search_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Only files with all of the text's grams in one column are read."""
    return _indexed_customer(spark, folder, CUSTOMER.with_search("0012"))


@query("SELECT * FROM customer WHERE " + _ANY_CUSTOMER.format("77"))
def search_indexed_short(spark: SparkSession, folder: str) -> DataFrame:
    """A text shorter than a gram: the beginnings of grams."""
    return _indexed_customer(spark, folder, CUSTOMER.with_search("77"))


@query(
    """SELECT * FROM customer
       WHERE contains(lower(c_name), '#00000001') AND contains(lower(c_mktsegment), 'auto')"""
)
def filter_text_indexed(spark: SparkSession, folder: str) -> DataFrame:
    spec = CUSTOMER.with_column("c_name", filter_kind="textField").with_column("c_mktsegment", filter_kind="textField")
    return _indexed_customer(spark, folder, spec.with_filters({"c_name": "#00000001", "c_mktsegment": "AUTO"}))


def _ordered_orders(spark: SparkSession, folder: str, spec: GridSpec) -> tuple[Grid, str, str]:
    path, index = f"{folder}/orders.parquet", scratch_path(spark, "order")
    orders = spark.read.parquet(path).withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    )
    grid = Grid(orders, spec)
    build_order_index(grid, path, index, ranges=8)
    return grid, path, index


_BY_PRIORITY = """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority
    FROM orders ORDER BY o_orderpriority DESC NULLS LAST, o_orderkey"""


@query(f"""{_BY_PRIORITY} LIMIT 100 OFFSET (SELECT CAST(count(*) // 200 * 100 AS BIGINT) FROM orders)""")
def page_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """A page in the middle of an order with ties and nulls: one range of the stored order is read."""
    spec = GridSpec(columns=ORDERS.columns, row_id="o_orderkey", sorts=(SortKey("o_orderpriority", "desc"),), rows_per_page=100)
    grid, path, index = _ordered_orders(spark, folder, spec)
    middle = grid.source.count() // 200
    return indexed_page(Grid(grid.source, spec.go_to(middle)), path, index)


@query(
    """SELECT total, pages, pages - 1 AS page, (pages - 1) * 7 + 1 AS first, total AS last
       FROM (SELECT count(*) AS total, CAST(ceil(count(*) / 7.0) AS BIGINT) AS pages
             FROM orders WHERE o_orderstatus = 'F')"""
)
def page_info_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The footer of a page beyond the end, from the stored ranges of a filtered view."""
    spec = GridSpec(columns=ORDERS.columns, row_id="o_orderkey", rows_per_page=7).with_filter("o_orderstatus", "F")
    grid, path, index = _ordered_orders(spark, folder, spec)
    return indexed_page_info(Grid(grid.source, spec.go_to(10**6)), path, index)


_COUNTED = GridSpec(
    columns=(
        ColumnSpec("o_orderkey", filterable=False),
        ColumnSpec("o_orderstatus"),
        ColumnSpec("o_orderpriority", filter_kind="multiselect"),
        ColumnSpec("o_custkey", filterable=False),
        ColumnSpec("clerk", filter_kind="textField"),
    ),
    row_id="o_orderkey",
)


def _with_clerk(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a null status here and there and a column of many values."""
    return named_table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
        "o_custkey",
        F.concat(F.lit("Clerk "), F.col("o_custkey") % 97).alias("clerk"),
    )


_CLERKS = """orders_in AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS o_orderstatus, o_orderpriority,
             'Clerk ' || CAST(o_custkey % 97 AS VARCHAR) AS clerk FROM orders),
    tested AS (
      SELECT *, coalesce(o_orderstatus = 'F', true) AS s, o_orderpriority IN ('1-URGENT', '3-MEDIUM') AS p,
             contains(lower(clerk), 'k 1') AS c FROM orders_in)"""
_COUNTS_SQL = f"""WITH {_CLERKS}
    SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, CAST(sum(CAST(p AND c AS INT)) AS BIGINT) AS rows
    FROM tested GROUP BY o_orderstatus
    UNION ALL SELECT 'o_orderpriority', o_orderpriority, CAST(sum(CAST(s AND c AS INT)) AS BIGINT)
    FROM tested GROUP BY o_orderpriority
    UNION ALL SELECT 'clerk', clerk, CAST(sum(CAST(s AND p AS INT)) AS BIGINT) FROM tested GROUP BY clerk"""


def _counted_spec() -> GridSpec:
    chosen = {"o_orderstatus": ["F", None], "o_orderpriority": ["1-URGENT", "3-MEDIUM", 7], "clerk": "K 1"}
    return _COUNTED.with_filters(chosen)


@query(_COUNTS_SQL)
def facet_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each value would leave under the other columns' filters, in one pass."""
    return counts_of(Grid(_with_clerk(spark, folder), _counted_spec()))


@query(_COUNTS_SQL)
def facet_counts_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """The same from stored bitmaps."""
    grid, index = Grid(_with_clerk(spark, folder), _counted_spec()), scratch_path(spark, "bitmaps")
    build_facet_bitmaps(grid, index)
    return counted_by_bitmaps(grid, index)


@query(
    """WITH parts AS (SELECT p_partkey, p_size, p_name, string_split(p_name, ' ') AS words FROM part),
       tested AS (SELECT *, list_has_any(words, ['red', 'ring']) AS w, p_size BETWEEN 10 AND 30 AS s,
                         contains(lower(p_name), 'e') OR contains(CAST(p_partkey AS VARCHAR), 'e') AS found FROM parts)
       SELECT 'words' AS "column", word AS value, CAST(sum(CAST(s AND found AS INT)) AS BIGINT) AS rows
       FROM (SELECT s, found, unnest(list_distinct(words)) AS word FROM tested) GROUP BY word
       UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), CAST(sum(CAST(w AND found AS INT)) AS BIGINT)
       FROM tested GROUP BY p_size"""
)
def facet_counts_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """An array column, a custom test and a search, by bitmaps."""
    part = named_table(spark, folder, "part").withColumn("words", F.split("p_name", " "))
    spec = GridSpec(
        columns=(
            ColumnSpec("p_partkey", filterable=False),
            ColumnSpec("p_name", filterable=False),
            ColumnSpec("words", display="false"),
            ColumnSpec("p_size", filter_kind="custom", display="false", drop_when="p_size NOT BETWEEN 10 AND 30"),
        ),
        row_id="p_partkey",
        array_match_all=False,
    ).with_filter("words", ["red", "ring"]).with_search("E")
    grid, index = Grid(part, spec), scratch_path(spark, "bitmaps")
    build_facet_bitmaps(grid, index)
    return counted_by_bitmaps(grid, index)


@query(f"WITH {_CLERKS} SELECT count(*) AS total FROM tested WHERE s AND p AND c")
def displayed_count_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows all filters leave, from the bits alone."""
    grid, index = Grid(_with_clerk(spark, folder), _counted_spec()), scratch_path(spark, "bitmaps")
    build_facet_bitmaps(grid, index)
    return displayed_by_bitmaps(grid, index)


@query(
    """WITH updated AS (
         SELECT c_custkey, c_nationkey,
                CASE WHEN c_custkey % 10 = 3 THEN 'SEGMENT ' || CAST(c_nationkey % 3 AS VARCHAR)
                     WHEN c_custkey <= 40 AND c_mktsegment = 'BUILDING' THEN NULL
                     ELSE c_mktsegment END AS c_mktsegment
         FROM customer)
       SELECT 'c_mktsegment' AS "column", c_mktsegment AS value, count(*) AS rows, min(c_custkey) AS first_seen
       FROM updated GROUP BY c_mktsegment
       UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*), min(c_custkey)
       FROM updated GROUP BY c_nationkey"""
)
def cell_update_facets(spark: SparkSession, folder: str) -> DataFrame:
    """Facets kept up through an update that ends one value's first rows and brings new values."""
    customer = named_table(spark, folder, "customer")
    spec = GridSpec(
        columns=(ColumnSpec("c_custkey", filterable=False), "c_nationkey", "c_mktsegment"), row_id="c_custkey"
    )
    grid = Grid(customer, spec)
    path = scratch_path(spark, "facets")
    counted_facets(grid).write.parquet(path)
    moved = F.col("c_custkey") % 10 == 3
    ended = (F.col("c_custkey") <= 40) & (F.col("c_mktsegment") == "BUILDING")
    fresh = F.when(moved, F.concat(F.lit("SEGMENT "), F.col("c_nationkey") % 3))
    updates = customer.where(moved | ended).select("c_custkey", fresh.alias("c_mktsegment"))
    return update_with_facets(grid, spark.read.parquet(path), "c_mktsegment", updates)[1]


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer")
def scan_row_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    """Rows numbered by file and place in it, files in key order."""
    path = scratch_path(spark, "customer")
    customer = named_table(spark, folder, "customer")
    customer.repartitionByRange(FILES, "c_custkey").sortWithinPartitions("c_custkey").write.parquet(path)
    return numbered_table(spark, path, "place").select("c_custkey", "c_name", "place")


@query(
    """WITH texts AS (
         SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '{broken ' || props
                               ELSE '{"in": {"a b": [' || CAST(user_id AS VARCHAR) || ', "' || event_type || '"]}, "props": ' || props || '}' END AS text
         FROM events)
       SELECT event_id,
              CASE WHEN event_id % 9 <> 0 THEN json_extract_string(text, '$.props.k') END AS k,
              CASE WHEN event_id % 9 <> 0 THEN json_extract_string(text, '$.in."a b"[1]') END AS kind,
              CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract_string(text, '$.in."a b"[0]') AS VARCHAR) END AS who,
              CAST(NULL AS VARCHAR) AS none,
              CASE WHEN event_id % 9 = 0 THEN text END AS unparsed
       FROM texts"""
)
def json_any_path(spark: SparkSession, folder: str) -> DataFrame:
    """Paths into JSON of no known shape, through objects and arrays; what is no JSON stays a text."""
    whole = F.concat(
        F.lit('{"in": {"a b": ['), F.col("user_id").cast("string"), F.lit(', "'), "event_type", F.lit('"]}, "props": '), "props", F.lit("}")
    )
    broken = F.concat(F.lit("{broken "), "props")
    texts = named_table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 9 == 0, broken).otherwise(whole).alias("text"))
    paths = {"k": "props.k", "kind": "in.a b.1", "who": "in.a b.0", "none": "in.c"}
    return variant_columns(texts, "text", paths, unparsed="unparsed")


def _version_order(a: str, b: str) -> int:
    """Releases by their numbers; a release in the making stands before the release."""
    (a_number, _, a_early), (b_number, _, b_early) = a.partition("-"), b.partition("-")
    left, right = ([int(x) for x in t.split(".")] for t in (a_number, b_number))
    if left != right:
        return -1 if left < right else 1
    if a_early == b_early:
        return 0
    if not a_early or not b_early:
        return -1 if a_early else 1
    return -1 if a_early < b_early else 1


_VERSIONS = """SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN
         CAST(p_size % 12 AS VARCHAR) || '.' || CAST(p_partkey % 11 AS VARCHAR) ||
         CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '-beta' ELSE '-alpha' END END AS version FROM part"""


@query(
    f"""SELECT p_partkey, version, row_number() OVER (ORDER BY
          CAST(split_part(version, '.', 1) AS INTEGER) DESC NULLS LAST,
          CAST(split_part(split_part(version, '-', 1), '.', 2) AS INTEGER) DESC NULLS LAST,
          CASE WHEN version IS NULL THEN NULL WHEN contains(version, '-') THEN split_part(version, '-', 2) ELSE 'zz' END DESC NULLS LAST,
          p_partkey) AS pos
        FROM ({_VERSIONS})"""
)
def sort_comparator(spark: SparkSession, folder: str) -> DataFrame:
    """Version order with pre-releases, by a comparator that is code; descending, ties by key."""
    early = F.element_at(F.array(F.lit(""), F.lit("-beta"), F.lit("-alpha")), (F.col("p_partkey") % 3 + 1).cast("int"))
    version = F.concat((F.col("p_size") % 12).cast("string"), F.lit("."), (F.col("p_partkey") % 11).cast("string"), early)
    part = named_table(spark, folder, "part").select("p_partkey", F.when(F.col("p_partkey") % 13 != 0, version).alias("version"))
    ranked = with_comparator_rank(part, "version", _version_order, "rank")
    spec = GridSpec(
        columns=("p_partkey", ColumnSpec("version", sort_key="rank"), ColumnSpec("rank", display="false")),
        row_id="p_partkey",
        sorts=(SortKey("version", "desc"),),
    )
    return Grid(ranked, spec).with_positions().select("p_partkey", "version", "pos")


@query(
    """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
              CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation,
              'N' || CAST(c_nationkey + 100 AS VARCHAR) AS code,
              CASE WHEN c_custkey % 7 <> 2 THEN c_mktsegment END AS segment,
              CASE c_custkey % 7 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS cost,
              CASE WHEN c_custkey % 7 = 1 THEN '?!' ELSE '' END AS extra
       FROM customer"""
)
def ingest_aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a cell lost, one too many or one missing at the end, found by the shapes of cells alone."""
    nation = F.col("c_nationkey").cast("string")
    key, code = F.col("c_custkey").cast("string"), F.concat(F.lit("N"), F.col("c_nationkey") + 100)
    whole = [key, F.col("c_name"), nation, code, F.col("c_mktsegment")]
    fault = F.col("c_custkey") % 7
    cells = (
        F.when(fault == 0, F.array(*whole[:2], *whole[3:]))
        .when(fault == 1, F.array(*whole[:2], F.lit("?!"), *whole[2:]))
        .when(fault == 2, F.array(*whole[:4]))
        .otherwise(F.array(*whole))
    )
    rows = named_table(spark, folder, "customer").select("c_custkey", cells.alias("cells"))
    headers = [
        Header("key", "int"),
        Header("name", pattern="Customer#[0-9]+"),
        Header("nation", "int"),
        Header("code", pattern="N[0-9]{3}"),
        Header("segment", pattern="[A-Z ]+"),
    ]
    found = aligned(rows, "cells", headers, cost="cost", extra="extra")
    return found.withColumn("extra", F.array_join("extra", ","))
