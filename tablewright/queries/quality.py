"""Data quality: single rules as flags, then whole rule sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.rules import Field, RecordRules, Ref
from tablewright.operators.rulesets import equal_to, not_padded
from tablewright.operators.validate import (
    VALID,
    VIOLATIONS,
    annotate,
    cast_rows,
    first_messages,
    flag_rows,
    rejected_rows,
    report,
    unknown_keys,
    unknown_message,
    valid_rows,
)
from tablewright.queries.registry import query
from tablewright.queries.scalars import EMAIL_IN_TEXT
from tablewright.sources.tables import named_table


def _flag(df: DataFrame, rules: RecordRules | Field, *keys: str) -> DataFrame:
    """The key columns and whether the row is valid."""
    rules = RecordRules((rules,)) if isinstance(rules, Field) else rules
    return flag_rows(df, rules).select(*keys, F.col(VALID).alias("ok"))


def _blanked(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with absent and empty market segments and some spoilt names."""
    customer = named_table(spark, folder, "customer")
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(
        F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    spoilt = F.concat(F.lit(" "), F.col("c_name"))
    return customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 7, spoilt).otherwise(F.col("c_name")).alias("c_name"),
        segment.alias("c_mktsegment"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
    )


_BLANKED = """SELECT c_custkey,
    CASE WHEN c_nationkey = 7 THEN ' ' || c_name ELSE c_name END AS c_name,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE nullif(c_mktsegment, 'BUILDING') END
      AS c_mktsegment,
    c_acctbal
  FROM customer"""

# -- single rules -------------------------------------------------------------


@query(f"SELECT c_custkey, coalesce(length(c_mktsegment) > 0, false) AS ok FROM ({_BLANKED})")
def dq_required(spark: SparkSession, folder: str) -> DataFrame:
    rule = Field("c_mktsegment").required()
    return _flag(_blanked(spark, folder), rule, "c_custkey")


@query("SELECT s_suppkey, nullif(s_nationkey, 15) IS NOT NULL AS ok FROM supplier")
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    supplier = named_table(spark, folder, "supplier").withColumn(
        "s_nationkey", F.nullif("s_nationkey", F.lit(15))
    )
    return _flag(supplier, Field("s_nationkey", "int").non_nullable(), "s_suppkey")


@query("SELECT p_partkey, length(p_name) BETWEEN 8 AND 10 AS ok FROM part")
def dq_length(spark: SparkSession, folder: str) -> DataFrame:
    rule = Field("p_name").min(8).max(10)
    return _flag(named_table(spark, folder, "part"), rule, "p_partkey")


@query(
    f"""SELECT c_custkey, regexp_full_match(c_name, 'Customer#[0-9]{{9}}') AS ok
        FROM ({_BLANKED})"""
)
def dq_matches(spark: SparkSession, folder: str) -> DataFrame:
    rule = Field("c_name").matches(r"^Customer#[0-9]{9}\z")
    return _flag(_blanked(spark, folder), rule, "c_custkey")


# What an e-mail address is to the rule, as SQL.
_EMAIL = (
    r"[a-zA-Z0-9.!#$%&''*+/=?^_`{|}~-]+@[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
    r"(?:\.[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*"
)


@query(
    rf"""WITH found AS (
           SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL_IN_TEXT}')) AS email
           FROM documents),
         cases AS (SELECT doc_id, email FROM found
                   UNION ALL SELECT doc_id, email || '@' FROM found
                   UNION ALL SELECT doc_id, replace(email, '.', '..') FROM found)
         SELECT doc_id, email, regexp_full_match(email, '{_EMAIL}') AS ok FROM cases"""
)
def dq_email(spark: SparkSession, folder: str) -> DataFrame:
    found = F.explode(F.regexp_extract_all("text", F.lit(EMAIL_IN_TEXT), F.lit(0)))
    # A plain search sorts out the texts that cannot hold an address.
    documents = named_table(spark, folder, "documents").filter(F.contains("text", F.lit("@")))
    emails = documents.select("doc_id", found.alias("email"))
    email = F.col("email")
    spoilt = F.array(
        email, F.concat(email, F.lit("@")), F.replace(email, F.lit("."), F.lit(".."))
    )
    cases = emails.select("doc_id", F.explode(spoilt).alias("email"))
    return _flag(cases, Field("email").email(), "doc_id", "email")


# The same language in the dialect of the checking engine, which has no
# look-ahead and needs none: it matches repeated groups in linear time.
_WIDE = r"\x{A0}-\x{D7FF}\x{F900}-\x{FDCF}\x{FDF0}-\x{FFEF}"
_CHAR = rf"(?:[a-z\d._~{_WIDE}!$&''()*+,;=:@-]|%[\da-f]{{2}})"
_HOST = (
    rf"(?:(?:[a-z\d{_WIDE}]|[a-z\d{_WIDE}][a-z\d._~{_WIDE}-]*[a-z\d{_WIDE}])\.)+"
    rf"(?:[a-z{_WIDE}]|[a-z{_WIDE}][a-z\d._~{_WIDE}-]*[a-z{_WIDE}])\.?"
)
# What a URL is to the rule, as SQL.
_URL = (
    rf"(?:(?:https?|ftp):)?//{_HOST}(?::\d*)?(?:/(?:{_CHAR}+(?:/{_CHAR}*)*)?)?"
    rf"(?:\?(?:{_CHAR}|/|\?)*)?(?:#(?:{_CHAR}|/|\?)*)?"
)


@query(
    rf"""WITH cases AS (SELECT page_id, url FROM pages
                        UNION ALL SELECT page_id, substr(url, 6) FROM pages
                        UNION ALL SELECT page_id, url || '%4' FROM pages)
         SELECT page_id, url, regexp_full_match(url, '{_URL}', 'i') AS ok FROM cases"""
)
def dq_url(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    spoilt = F.array(url, F.substr(url, F.lit(6)), F.concat(url, F.lit("%4")))
    cases = named_table(spark, folder, "pages").select("page_id", F.explode(spoilt).alias("url"))
    return _flag(cases, Field("url").url(), "page_id", "url")


@query(
    """WITH h AS (SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS m FROM customer),
            u AS (SELECT c_custkey, substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-'
                         || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21)
                         AS id FROM h)
       SELECT c_custkey, id, regexp_matches(substr(id, 15, 1), '[1-5]')
                             AND regexp_matches(substr(id, 20, 1), '[89ab]') AS ok
       FROM u"""
)
def dq_uuid(spark: SparkSession, folder: str) -> DataFrame:
    digest = F.md5(F.col("c_custkey").cast("string"))
    dashed = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    cases = named_table(spark, folder, "customer").select("c_custkey", dashed.alias("id"))
    return _flag(cases, Field("id").uuid(), "c_custkey", "id")


@query(
    """WITH t AS (SELECT event_id, user_id % 4 AS kind,
                         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS s FROM events)
       SELECT event_id, s || CASE kind WHEN 0 THEN 'Z' WHEN 1 THEN '' WHEN 2 THEN '.123Z'
                                       ELSE '+02:00' END AS stamp,
              kind IN (0, 2) AS ok, kind = 2 AS ok_precise, kind <> 1 AS ok_offset
       FROM t"""
)
def dq_datetime(spark: SparkSession, folder: str) -> DataFrame:
    """Plain, with exactly three fraction digits, and with offsets allowed."""
    suffixes = F.array(*[F.lit(s) for s in ("Z", "", ".123Z", "+02:00")])
    suffix = F.get(suffixes, (F.col("user_id") % 4).cast("int"))
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), suffix)
    cases = named_table(spark, folder, "events").select("event_id", stamp.alias("stamp"))
    checked = annotate(
        cases.withColumns({"precise": F.col("stamp"), "offset": F.col("stamp")}),
        RecordRules(
            (
                Field("stamp").datetime(),
                Field("precise").datetime(precision=3),
                Field("offset").datetime(allow_offset=True),
            )
        ),
    )
    failed = F.transform(VIOLATIONS, lambda v: v["field"])
    return checked.select(
        "event_id",
        "stamp",
        (~F.array_contains(failed, "stamp")).alias("ok"),
        (~F.array_contains(failed, "precise")).alias("ok_precise"),
        (~F.array_contains(failed, "offset")).alias("ok_offset"),
    )


_PADDED = """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN chr(9) || upper(p_name) || chr(160)
                                    ELSE p_name END AS p_name FROM part"""


def _padded(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit("\t"), F.upper("p_name"), F.lit("\u00a0"))
    return named_table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 2 == 0, padded).otherwise(F.col("p_name")).alias("p_name"),
    )


@query("SELECT p_partkey, p_name FROM part")
def dq_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """White space and case are put right before anything is tested."""
    rules = RecordRules((Field("p_name").trim().lowercase(),))
    return valid_rows(_padded(spark, folder), rules)


@query(f"SELECT p_partkey, p_name = lower(p_name) AS ok FROM ({_PADDED})")
def dq_strict(spark: SparkSession, folder: str) -> DataFrame:
    """In strict mode the cell is tested as it is."""
    rule = Field("p_name").trim().lowercase().strict()
    return _flag(_padded(spark, folder), rule, "p_partkey")


@query(f"SELECT p_partkey, p_name = lower(p_name) AS ok FROM ({_PADDED})")
def dq_trimmed(spark: SparkSession, folder: str) -> DataFrame:
    return _flag(_padded(spark, folder), not_padded(Field("p_name"), "padded"), "p_partkey")


@query(
    f"""SELECT c_custkey, c_name, coalesce(nullif(c_mktsegment, ''), 'UNKNOWN') AS c_mktsegment,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal FROM ({_BLANKED})"""
)
def dq_default(spark: SparkSession, folder: str) -> DataFrame:
    rules = RecordRules((Field("c_mktsegment").default("UNKNOWN"),))
    return cast_rows(_blanked(spark, folder), rules)


@query("SELECT conv_id, turn, role, role IN ('user', 'assistant') AS ok FROM conversations")
def dq_one_of(spark: SparkSession, folder: str) -> DataFrame:
    rule = Field("role").one_of(["user", "assistant"])
    return _flag(named_table(spark, folder, "conversations"), rule, "conv_id", "turn", "role")


@query(
    """SELECT conv_id, turn, role,
              role <> 'system' AND text <> role AS ok FROM conversations"""
)
def dq_not_one_of(spark: SparkSession, folder: str) -> DataFrame:
    """Denied values may come from a sibling field."""
    rules = RecordRules(
        (Field("role").not_one_of(["system"]), Field("text").not_one_of([Ref("role")]))
    )
    return _flag(named_table(spark, folder, "conversations"), rules, "conv_id", "turn", "role")


@query(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL
                        AND TRY_CAST(event_type AS INTEGER) IS NOT NULL AS ok,
              'event_type must be a `int` type, but the final value was: `NaN` (cast from the value `"'
                || event_type || '"`).' AS message
       FROM events"""
)
def dq_type(spark: SparkSession, folder: str) -> DataFrame:
    events = named_table(spark, folder, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").alias("k")
    )
    checked = annotate(events, RecordRules((Field("k", "int"), Field("event_type", "int"))))
    message = first_messages(F.col(VIOLATIONS))["event_type"]
    return checked.select("event_id", F.col(VALID).alias("ok"), message.alias("message"))


@query(
    """SELECT o_orderkey, o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
              AS ok FROM orders"""
)
def dq_date_range(spark: SparkSession, folder: str) -> DataFrame:
    rule = Field("o_orderdate", "date").min("1996-01-01").max("1998-12-31")
    return _flag(named_table(spark, folder, "orders"), rule, "o_orderkey")


@query(
    """SELECT o_orderkey, stamp, CASE WHEN o_orderkey % 3 = 0 THEN NULL
              ELSE CAST(o_orderdate AS TIMESTAMP) END AS parsed
       FROM (SELECT o_orderkey, o_orderdate,
                    CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y')
                         WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
                         ELSE strftime(o_orderdate, '%Y%m%d') END AS stamp
             FROM orders)"""
)
def dq_date_cast(spark: SparkSession, folder: str) -> DataFrame:
    """ISO texts become timestamps, others are no date."""
    form = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd.MM.yyyy"))
    form = form.when(
        F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    texts = named_table(spark, folder, "orders").select(
        "o_orderkey", form.alias("stamp"), form.alias("parsed")
    )
    parsed = cast_rows(texts, RecordRules((Field("parsed", "date"),)))
    return parsed.withColumn("parsed", F.col("parsed").cast("timestamp_ntz"))


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount <= 3000 AS ok
       FROM lineitem"""
)
def dq_custom(spark: SparkSession, folder: str) -> DataFrame:
    rule = Field("l_extendedprice", "double").test(
        "rebate",
        "${path} gives a rebate above ${limit}",
        lambda s: s.value * s.sibling("l_discount") <= s.resolve(Ref("$limit")),
        limit=Ref("$limit"),
    )
    rules = RecordRules((rule,), context={"limit": 3000})
    return _flag(named_table(spark, folder, "lineitem"), rules, "l_orderkey", "l_linenumber")


@query(
    """SELECT l_orderkey, l_linenumber, l_returnflag = l_linestatus AS ok FROM lineitem"""
)
def dq_cross_field(spark: SparkSession, folder: str) -> DataFrame:
    rule = equal_to(Field("l_returnflag"), "l_linestatus", "flags differ")
    return _flag(named_table(spark, folder, "lineitem"), rule, "l_orderkey", "l_linenumber")


@query(
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_returnflag = 'R' THEN l_linestatus = 'F' ELSE l_linestatus <> 'X' END
                AS ok FROM lineitem"""
)
def dq_when(spark: SparkSession, folder: str) -> DataFrame:
    rule = Field("l_linestatus").when(
        "l_returnflag",
        "R",
        then=lambda f: f.one_of(["F"]),
        otherwise=lambda f: f.not_one_of(["X"]),
    )
    return _flag(named_table(spark, folder, "lineitem"), rule, "l_orderkey", "l_linenumber")


# -- whole rule sets ------------------------------------------------------------


def customer_rules() -> RecordRules:
    return RecordRules(
        (
            Field("c_name")
            .titled("Name")
            .max(18)
            .matches(r"^Customer#[0-9]{9}\z", "${path} has a wrong form")
            .required("${path} is needed"),
            Field("c_mktsegment")
            .one_of(["AUTOMOBILE", "FURNITURE"])
            .min(10)
            .required("Segment is needed"),
            Field("c_acctbal", "double").test(
                "covered",
                "${path} must be at least ${least}",
                lambda s: s.value >= s.resolve(1000),
                least=1000,
            ),
        )
    )


# Every broken rule of every customer.  Fixed values: the messages are the rules' own.  The length of a segment is only tested
# where the segment is an allowed one.
_FINDINGS = f"""
  WITH b AS ({_BLANKED}),
  found AS (
    SELECT c_custkey, 1 AS n, 'c_name' AS field, 'max' AS rule,
           'Name must be at most 18 characters' AS message FROM b WHERE length(c_name) > 18
    UNION ALL
    SELECT c_custkey, 2, 'c_name', 'matches', 'Name has a wrong form' FROM b
    WHERE NOT regexp_full_match(c_name, 'Customer#[0-9]{{9}}')
    UNION ALL
    SELECT c_custkey, 4, 'c_mktsegment', 'required', 'Segment is needed' FROM b
    WHERE coalesce(c_mktsegment, '') = ''
    UNION ALL
    SELECT c_custkey, 5, 'c_mktsegment', 'one_of',
           'c_mktsegment must be one of the following values: AUTOMOBILE, FURNITURE' FROM b
    WHERE c_mktsegment <> '' AND c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE')
    UNION ALL
    SELECT c_custkey, 6, 'c_mktsegment', 'min',
           'c_mktsegment must be at least 10 characters' FROM b
    WHERE c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') AND length(c_mktsegment) < 10
    UNION ALL
    SELECT c_custkey, 8, 'c_acctbal', 'covered', 'c_acctbal must be at least 1000' FROM b
    WHERE c_acctbal < 1000)"""


@query(
    _FINDINGS
    + """ SELECT c_custkey, row_number() OVER (PARTITION BY c_custkey ORDER BY n) AS nr,
                 field, rule, message FROM found"""
)
def dq_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Every violation with its message, in field order."""
    rejected = rejected_rows(_blanked(spark, folder), customer_rules())
    listed = rejected.select("c_custkey", F.posexplode(VIOLATIONS).alias("at", "v"))
    return listed.select("c_custkey", (F.col("at") + 1).cast("bigint").alias("nr"), "v.*")


@query(
    _FINDINGS
    + """ SELECT c_custkey, field, arg_min(message, n) AS message FROM found
          GROUP BY c_custkey, field"""
)
def dq_first_message(spark: SparkSession, folder: str) -> DataFrame:
    """The message a reader is shown per field: the first one."""
    rejected = rejected_rows(_blanked(spark, folder), customer_rules())
    messages = F.explode(first_messages(F.col(VIOLATIONS))).alias("field", "message")
    return rejected.select("c_custkey", messages)


@query(
    f"""SELECT c_custkey, c_mktsegment,
               CASE WHEN coalesce(c_mktsegment, '') = '' THEN 'required'
                    WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE') THEN 'one_of'
                    WHEN length(c_mktsegment) < 10 THEN 'min' ELSE '' END AS rules
        FROM ({_BLANKED})"""
)
def dq_two_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Length is tested only where type, presence and allowed values are fine."""
    checked = annotate(_blanked(spark, folder), customer_rules().pick(["c_mktsegment"]))
    names = F.array_join(F.transform(VIOLATIONS, lambda v: v["rule"]), ",")
    return checked.select("c_custkey", "c_mktsegment", names.alias("rules"))


@query(
    _FINDINGS
    + """ SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM b
          WHERE c_custkey NOT IN (SELECT c_custkey FROM found)"""
)
def dq_valid(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that break no rule, with cast cells."""
    return valid_rows(_blanked(spark, folder), customer_rules())


@query(
    _FINDINGS
    + """ SELECT b.c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
                 count(*) AS violations
          FROM b JOIN found ON b.c_custkey = found.c_custkey GROUP BY ALL"""
)
def dq_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that break a rule, as they came."""
    rejected = rejected_rows(_blanked(spark, folder), customer_rules())
    violations = F.size(VIOLATIONS).cast("bigint")
    return rejected.withColumn("violations", violations).drop(VIOLATIONS)


_RULES = """(VALUES (1, 'c_name', 'max'), (2, 'c_name', 'matches'), (3, 'c_name', 'required'),
     (4, 'c_mktsegment', 'required'), (5, 'c_mktsegment', 'one_of'), (6, 'c_mktsegment', 'min'),
     (7, 'c_acctbal', 'type'), (8, 'c_acctbal', 'covered')) AS r(n, field, rule)"""


@query(
    _FINDINGS
    + f""" SELECT r.field, r.rule, count(found.n) AS failures
           FROM {_RULES} LEFT JOIN found ON r.field = found.field AND r.rule = found.rule
           GROUP BY ALL"""
)
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """Failures per rule in one pass, rules that never fail included."""
    return report(_blanked(spark, folder), customer_rules()).drop("pos")


@query(
    _FINDINGS
    + f""" SELECT r.field, r.rule,
                  CASE r.n WHEN 1 THEN 'max=18' WHEN 2 THEN 'regex=^Customer#[0-9]{{9}}\\z'
                           WHEN 5 THEN 'values=AUTOMOBILE, FURNITURE' WHEN 6 THEN 'min=10'
                           WHEN 7 THEN 'type=double' WHEN 8 THEN 'least=1000' ELSE '' END AS params,
                  count(found.n) AS failures
           FROM {_RULES} LEFT JOIN found ON r.field = found.field AND r.rule = found.rule
           GROUP BY ALL"""
)
def dq_describe(spark: SparkSession, folder: str) -> DataFrame:
    """The listing of the rules, beside how often each is broken."""
    rules = customer_rules()
    counts = report(_blanked(spark, folder), rules).drop("pos")
    # One row per rule on either side.
    return rules.rules_frame(spark).drop("pos").join(counts, ["field", "rule"])


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'note' WHEN 'F' THEN 'flag,note' ELSE '' END
                AS unknown,
              'record field has unspecified keys: '
                || CASE o_orderstatus WHEN 'P' THEN 'note' WHEN 'F' THEN 'flag, note' ELSE '' END
                AS message
       FROM orders"""
)
def dq_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of JSON records that no rule names."""
    status = F.col("o_orderstatus")
    record = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.when(status == "F", F.lit(1)).alias("flag"),
            F.col("o_totalprice").alias("price"),
            F.when(status.isin("P", "F"), F.lit("x")).alias("note"),
        )
    )
    orders = named_table(spark, folder, "orders").select("o_orderkey", record.alias("record"))
    unknown = unknown_keys(F.col("record"), ["id", "price"])
    return orders.select(
        "o_orderkey",
        F.array_join(unknown, ",").alias("unknown"),
        unknown_message(unknown, "record").alias("message"),
    )
