"""Operators at their edges: many keys, text keys, changed views, sinks read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import rowset
from tablewright.operators.cells import update_cells
from tablewright.operators.facets import facet_values, ordered_facets
from tablewright.operators.rules import Field, RecordRules
from tablewright.operators.validate import (
    VALID,
    VIOLATIONS,
    annotate,
    read_validated,
    valid_rows,
    write_validated,
)
from tablewright.plans.compiler import Grid
from tablewright.plans.spec import ColumnSpec, GridSpec, SortKey, SpecError
from tablewright.queries.filters import CUSTOMER, ORDERS
from tablewright.queries.registry import query
from tablewright.sources.export import write_csv
from tablewright.sources.ingest import REJECTS, Typed, ingest
from tablewright.sources.scratch import scratch_path
from tablewright.sources.tables import named_table, rows_from_literals

# -- sources and sinks -----------------------------------------------------------


@query(
    """SELECT s.place, s.code, s.meaning, count(o_orderkey) AS orders
       FROM (VALUES (0, 'F', 'filled'), (1, 'O', 'open'), (2, 'X', 'unused')) AS s(place, code, meaning)
       LEFT JOIN orders ON o_orderstatus = s.code GROUP BY ALL"""
)
def embedded_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table written out in code, joined to one of files."""
    meanings = [["F", "filled"], ["O", "open"], ["X", "unused"]]
    small = rows_from_literals(spark, meanings, ["code", "meaning"])
    orders = named_table(spark, folder, "orders")
    joined = small.join(orders, F.col("o_orderstatus") == F.col("code"), "left")
    return joined.groupBy(F.col("_row_id").alias("place"), "code", "meaning").agg(
        F.count("o_orderkey").alias("orders")
    )


_SUPPLIER_LINE = """'"' || s_suppkey || '";"' || s_name || '";"' || s_nationkey || '"'"""


def _supplier_grid(spark: SparkSession, folder: str) -> Grid:
    spec = GridSpec(columns=("s_suppkey", "s_name", "s_nationkey"), row_id="s_suppkey")
    spec = spec.with_filter("s_nationkey", [1, 2, 3, 4, 5, 6])
    return Grid(named_table(spark, folder, "supplier"), spec)


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").alias("line"))


@query(
    f"""SELECT '"s_suppkey";"s_name";"s_nationkey"' AS line
        UNION ALL SELECT {_SUPPLIER_LINE} FROM supplier WHERE s_nationkey BETWEEN 1 AND 6"""
)
def csv_written(spark: SparkSession, folder: str) -> DataFrame:
    """An export, written and read back."""
    grid = _supplier_grid(spark, folder)
    download = grid.spec.download.__class__(separator=";", displayed_rows_only=True)
    grid = Grid(grid.source, GridSpec(**{**vars(grid.spec), "download": download}))
    return _read_lines(spark, write_csv(grid, scratch_path(spark, "csv")))


@query(
    """SELECT upper('"s_suppkey","s_name","s_nationkey"') AS line
       UNION ALL SELECT upper('"' || s_suppkey || '","' || s_name || '","' || s_nationkey || '"') FROM supplier"""
)
def csv_transformed(spark: SparkSession, folder: str) -> DataFrame:
    """The download hook rewrites the lines before they are written."""
    path = write_csv(
        _supplier_grid(spark, folder),
        scratch_path(spark, "csv"),
        transform=lambda lines: lines.select(F.upper("line").alias("line")),
    )
    return _read_lines(spark, path)


@query(
    """SELECT c_custkey, c_acctbal >= 0 AS ok,
              CASE WHEN c_acctbal >= 0 THEN '' ELSE 'covered' END AS rules FROM customer"""
)
def dq_written(spark: SparkSession, folder: str) -> DataFrame:
    """Checked rows, written in one pass and read back from both sides."""
    path = scratch_path(spark, "validated")
    covered = Field("c_acctbal", "double").test("covered", "${path}", lambda s: s.value >= 0)
    write_validated(named_table(spark, folder, "customer"), RecordRules((covered,)), path)
    names = F.array_join(F.transform(VIOLATIONS, lambda v: v["rule"]), ",")
    return read_validated(spark, path).select(
        "c_custkey", F.col(VALID).alias("ok"), names.alias("rules")
    )


@query(
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_quantity / 4 = floor(l_quantity / 4) THEN CAST(l_quantity / 4 AS INTEGER) END AS share,
              CASE WHEN l_quantity / 4 = floor(l_quantity / 4) THEN '' ELSE 'share' END
                || CASE WHEN l_linenumber = 3 THEN (CASE WHEN l_quantity / 4 = floor(l_quantity / 4)
                                                    THEN 'price' ELSE ',price' END) ELSE '' END AS rejects,
              CASE WHEN l_linenumber <> 3 THEN CAST(12.25 AS DOUBLE) END AS price
       FROM lineitem"""
)
def typed_ingest_lossy(spark: SparkSession, folder: str) -> DataFrame:
    """A cell that a cast would change does not fit: 1.75 is no int, 12.345 no decimal(10,2)."""
    cells = named_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") / 4).alias("share"),
        F.when(F.col("l_linenumber") == 3, "12.345").otherwise("12.25").alias("price"),
    )
    typed = ingest(
        cells,
        [Typed("share", dtype="int"), Typed("price", dtype="decimal(10,2)")],
        keep=["l_orderkey", "l_linenumber"],
    )
    return typed.select(
        "l_orderkey",
        "l_linenumber",
        "share",
        F.array_join(REJECTS, ",").alias("rejects"),
        F.col("price").cast("double").alias("price"),
    )


# -- views that change -------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM
         (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n, count(*) OVER () AS total
          FROM orders WHERE o_orderstatus = 'F')
       WHERE floor((n - 1) / 10) = ceil(total / 10.0) - 1"""
)
def page_stale_total(spark: SparkSession, folder: str) -> DataFrame:
    """A count from before the filter does not decide what the last page is."""
    orders = named_table(spark, folder, "orders")
    spec = GridSpec(columns=ORDERS.columns, row_id="o_orderkey", total=10**9)
    return Grid(orders, spec.with_filter("o_orderstatus", "F").go_to(10**8)).page()


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority
       FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 10"""
)
def filter_first_page(spark: SparkSession, folder: str) -> DataFrame:
    """A filter brings the view back to its first page."""
    spec = GridSpec(columns=ORDERS.columns, row_id="o_orderkey", page=7)
    return Grid(named_table(spark, folder, "orders"), spec.with_filter("o_orderstatus", "O")).page()


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')")
def filter_value_removed(spark: SparkSession, folder: str) -> DataFrame:
    """One of several chosen values is taken out, another by the caller's own function."""
    spec = GridSpec(columns=("c_custkey", "c_mktsegment"), row_id="c_custkey")
    chosen = ["BUILDING", "MACHINERY", "FURNITURE", "AUTOMOBILE"]
    spec = spec.with_filter("c_mktsegment", chosen).remove_filter_value("c_mktsegment", "MACHINERY")

    def without(filters: dict, name: str, value) -> dict:
        return {**filters, name: [v for v in filters[name] if v != value]}

    spec = spec.remove_filter_value("c_mktsegment", "AUTOMOBILE", without)
    return Grid(named_table(spark, folder, "customer"), spec).rows()


@query("SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) AS pos FROM supplier")
def sort_refused(spark: SparkSession, folder: str) -> DataFrame:
    """A column that is not sortable leaves the order as it was."""
    spec = GridSpec(columns=("s_suppkey", ColumnSpec("s_name", sortable=False)), row_id="s_suppkey")
    try:
        spec = spec.toggle_sort("s_name")
    except SpecError:
        grid = Grid(named_table(spark, folder, "supplier"), spec)
        return grid.project(grid.with_positions(), "pos")
    raise AssertionError("the sort was not refused")


@query(
    """SELECT 'o_orderstatus' AS "column", o_orderstatus AS value,
              min('ORD-' || o_orderkey) AS first_seen FROM orders GROUP BY o_orderstatus"""
)
def facet_text_key(spark: SparkSession, folder: str) -> DataFrame:
    """Rows named by a text: the first one to hold a value is the least text."""
    return facet_values(_text_keyed(spark, folder))


@query(
    """SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, o_orderstatus AS label,
              row_number() OVER (ORDER BY min('ORD-' || o_orderkey)) AS pos
       FROM orders GROUP BY o_orderstatus"""
)
def facet_text_key_order(spark: SparkSession, folder: str) -> DataFrame:
    return ordered_facets(_text_keyed(spark, folder))


def _text_keyed(spark: SparkSession, folder: str) -> Grid:
    key = F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))
    orders = named_table(spark, folder, "orders").withColumn("name", key)
    columns = (ColumnSpec("name", filterable=False), "o_orderstatus")
    return Grid(orders, GridSpec(columns=columns, row_id="name", sort_facets=False))


# -- many keys ---------------------------------------------------------------------


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """The key does not stand first, and one name holds a dot."""
    return named_table(spark, folder, "orders").select(
        "o_orderstatus", "o_orderkey", F.col("o_totalprice").alias("total.price")
    )


_ORDERS = 'SELECT o_orderstatus, o_orderkey, o_totalprice AS "total.price" FROM orders'


@query(f"{_ORDERS} WHERE o_orderkey % 3 = 0 AND o_orderkey < 6000")
def select_many_listed(spark: SparkSession, folder: str) -> DataFrame:
    """Two thousand listed keys select as a few do."""
    return rowset.select_rows(_orders(spark, folder), "o_orderkey", list(range(0, 6000, 3)))


@query(f"{_ORDERS} WHERE o_orderkey % 3 <> 0 OR o_orderkey >= 6000")
def delete_many_listed(spark: SparkSession, folder: str) -> DataFrame:
    return rowset.delete_rows(_orders(spark, folder), "o_orderkey", list(range(0, 6000, 3)))


@query(
    """SELECT o_orderstatus, o_orderkey,
              CASE WHEN o_orderkey < 300 THEN o_orderkey / 2.0 ELSE o_totalprice END AS "total.price"
       FROM orders"""
)
def cell_update_listed(spark: SparkSession, folder: str) -> DataFrame:
    """Three hundred listed updates of a column with a dot in its name."""
    updates = {i: i / 2 for i in range(300)}
    return update_cells(_orders(spark, folder), "o_orderkey", "total.price", updates)


@query(
    """SELECT o_orderkey AS "order.key", CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE o_orderstatus END
                AS status FROM orders"""
)
def cell_update_frame(spark: SparkSession, folder: str) -> DataFrame:
    """A frame of updates, each key once; the key's name holds a dot."""
    orders = named_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order.key"), F.col("o_orderstatus").alias("status")
    )
    even = orders.filter("`order.key` % 2 = 0").withColumn("status", F.lit("even"))
    return update_cells(orders, "order.key", "status", even)


@query(f"{_ORDERS} WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'F')")
def select_single_frame(spark: SparkSession, folder: str) -> DataFrame:
    """A frame with one key, in a table that lets one row be selected."""
    orders = _orders(spark, folder)
    first = orders.filter("o_orderstatus = 'F'").agg(F.min("o_orderkey").alias("o_orderkey"))
    columns = ("o_orderstatus", "o_orderkey", "total.price")
    grid = Grid(orders, GridSpec(columns=columns, row_id="o_orderkey", selectable_rows="single"))
    return rowset.selected_rows(grid, first)


@query(
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'
       UNION SELECT o_orderkey FROM
         (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders)
       WHERE n BETWEEN 11 AND 40 AND o_orderstatus <> 'O'"""
)
def select_range_added(spark: SparkSession, folder: str) -> DataFrame:
    """A range joins what is selected already."""
    orders = named_table(spark, folder, "orders")
    spec = GridSpec(columns=ORDERS.columns, row_id="o_orderkey", sorts=(SortKey("o_totalprice"),))
    chosen = orders.filter("o_orderstatus = 'P'")
    return rowset.add_range(Grid(orders, spec), chosen, 40, 11, "o_orderstatus <> 'O'")


@query("SELECT c_custkey, c_name, FALSE AS selected FROM customer")
def select_none_mode(spark: SparkSession, folder: str) -> DataFrame:
    """A table whose rows cannot be selected has no selected rows, whatever is listed."""
    spec = GridSpec(columns=CUSTOMER.columns, row_id="c_custkey", selectable_rows="none")
    customer = named_table(spark, folder, "customer")
    listed = customer.where("c_custkey % 2 = 0")
    chosen = rowset.selected_rows(Grid(customer, spec), listed).select(F.col("c_custkey").alias("chosen"))
    marked = customer.join(chosen, F.col("c_custkey") == F.col("chosen"), "left")
    return marked.select("c_custkey", "c_name", F.col("chosen").isNotNull().alias("selected"))


# -- rules -------------------------------------------------------------------------


def _found(df: DataFrame, rules: RecordRules, key: str) -> DataFrame:
    names = F.array_join(F.transform(VIOLATIONS, lambda v: F.concat_ws(":", v["field"], v["rule"])), ",")
    return annotate(df, rules).select(key, names.alias("found"))


@query(
    """SELECT p_partkey, array_to_string(list_filter([
         CASE WHEN p_size = 1 AND length(p_name) < 12 THEN 'p_name:min' END,
         CASE WHEN p_size = 2 AND length(p_name) > 11 THEN 'p_name:max' END,
         CASE WHEN p_size IN (3, 4, 5, 6, 7) AND NOT contains(p_name, 'e') THEN 'p_name:has' || p_size END
       ], lambda x: x IS NOT NULL), ',') AS found FROM part"""
)
def dq_when_many(spark: SparkSession, folder: str) -> DataFrame:
    """Seven conditions on one field, each with a test of its own."""

    def has(f: Field, n: int) -> Field:
        return f.test(f"has{n}", "${path}", lambda s: F.contains(s.value, F.lit("e")))

    rule = Field("p_name").when("p_size", 1, lambda f: f.min(12)).when("p_size", 2, lambda f: f.max(11))
    for n in range(3, 8):
        rule = rule.when("p_size", n, lambda f, n=n: has(f, n))
    return _found(named_table(spark, folder, "part"), RecordRules((rule,)), "p_partkey")


@query(
    """SELECT p_partkey, CASE WHEN length(p_name) < p_size THEN 'p_name:min' ELSE '' END AS found FROM part"""
)
def dq_when_built(spark: SparkSession, folder: str) -> DataFrame:
    """A rule built from another field's value."""
    rule = Field("p_name").when_built("p_size", lambda f, least: f.min(least))
    return _found(named_table(spark, folder, "part"), RecordRules((rule,)), "p_partkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity / 4 = floor(l_quantity / 4) AS ok FROM lineitem"""
)
def dq_type_lossy(spark: SparkSession, folder: str) -> DataFrame:
    """1.75 is of another type than int."""
    lines = named_table(spark, folder, "lineitem").withColumn("share", F.col("l_quantity") / 4)
    checked = annotate(lines, RecordRules((Field("share", "int"),)))
    return checked.select("l_orderkey", "l_linenumber", F.col(VALID).alias("ok"))


_SEGMENTS = """SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 2 THEN c_mktsegment END AS c_mktsegment,
       c_nationkey % 5 AS region FROM customer"""


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    region = F.col("c_nationkey") % 5
    segment = F.when(region != 2, F.col("c_mktsegment")).alias("c_mktsegment")
    return named_table(spark, folder, "customer").select("c_custkey", segment, region.alias("region"))


@query(
    f"""SELECT c_custkey, array_to_string(list_filter([
          CASE WHEN length(c_mktsegment) > 8 THEN 'c_mktsegment:max' END,
          CASE WHEN region NOT IN (1, 2) THEN 'region:one_of' END
        ], lambda x: x IS NOT NULL), ',') AS found FROM ({_SEGMENTS})"""
)
def dq_concat_partial(spark: SparkSession, folder: str) -> DataFrame:
    """Two rule sets joined, the later one's field winning, and none of them required."""
    one = RecordRules((Field("c_mktsegment").max(8).required(), Field("region", "int").one_of([9])))
    other = RecordRules((Field("region", "int").one_of([1, 2]).non_nullable(),))
    rules = one.concat(other)
    rules = RecordRules((rules["c_mktsegment"].not_required(), rules["region"])).partial()
    return _found(_segments(spark, folder), rules, "c_custkey")


@query("SELECT c_custkey, region, CAST(NULL AS VARCHAR) AS remark FROM (" + _SEGMENTS + ") WHERE region < 2")
def dq_shape_strip(spark: SparkSession, folder: str) -> DataFrame:
    """A shape replaces and adds fields; a stripped field is checked and left out."""
    rules = RecordRules((Field("region", "int"), Field("c_mktsegment").required()))
    rules = rules.shape(
        Field("region", "int").test("low", "${path}", lambda s: s.value < 3),
        Field("c_mktsegment").required().strip(),
        Field("remark").nullable(),
    )
    return valid_rows(_segments(spark, folder).withColumn("remark", F.lit(None).cast("string")), rules)


@query(
    f"""SELECT c_custkey, upper(c_mktsegment) AS c_mktsegment, coalesce(note, '') AS note
        FROM (SELECT c_custkey, lower(coalesce(c_mktsegment, 'none')) AS c_mktsegment,
                     CASE WHEN c_mktsegment IS NOT NULL THEN 'seen' END AS note FROM ({_SEGMENTS}))"""
)
def dq_uppercase_ensure(spark: SparkSession, folder: str) -> DataFrame:
    """Capitals as a transform, and an empty text for an absent one."""
    note = F.when(F.col("c_mktsegment").isNotNull(), F.lit("seen"))
    lower = _segments(spark, folder).select(
        "c_custkey", F.lower(F.coalesce("c_mktsegment", F.lit("none"))).alias("c_mktsegment"), note.alias("note")
    )
    return valid_rows(lower, RecordRules((Field("c_mktsegment").uppercase(), Field("note").ensure())))


@query(
    f"""SELECT c_custkey, c_mktsegment IS NOT NULL AS strict, TRUE AS loose, 'region' AS unknown FROM ({_SEGMENTS})"""
)
def dq_optional(spark: SparkSession, folder: str) -> DataFrame:
    """A rule of presence, taken back by nullable and optional; columns that no rule names."""
    strict = RecordRules((Field("c_mktsegment").defined(), Field("c_custkey", "int")))
    loose = RecordRules((Field("c_mktsegment").defined().nullable(), Field("c_custkey", "int").optional()))
    segments = _segments(spark, folder)
    unknown = F.lit(",".join(strict.unknown_columns(segments)))
    first = annotate(segments, strict).withColumnRenamed(VALID, "strict").drop(VIOLATIONS)
    both = annotate(first, loose)
    return both.select("c_custkey", "strict", F.col(VALID).alias("loose"), unknown.alias("unknown"))
