"""Per-row functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import scalars
from tablewright.functions.text import number_text
from tablewright.queries.registry import query
from tablewright.sources.tables import named_table

EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
DAY = "2024-01-01 00:00:00"


@query(
    rf"""WITH found AS (
           SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL_IN_TEXT}')) AS email
           FROM documents)
         SELECT doc_id, email,
                CASE WHEN instr(email, '@') >= 4
                     THEN substr(email, 1, 1) || repeat('*', CAST(instr(email, '@') - 3 AS INTEGER))
                          || substr(email, instr(email, '@') - 1)
                     ELSE email END AS masked
         FROM found"""
)
def mask_email(spark: SparkSession, folder: str) -> DataFrame:
    found = F.explode(F.regexp_extract_all("text", F.lit(EMAIL_IN_TEXT), F.lit(0)))
    # A plain search sorts out the texts that cannot hold an address.
    documents = named_table(spark, folder, "documents").filter(F.contains("text", F.lit("@")))
    emails = documents.select("doc_id", found.alias("email"))
    return emails.withColumn("masked", scalars.mask_email(F.col("email")))


def _elapsed():
    """Seconds since the first day began, with fractions."""
    start = F.lit(DAY).cast("timestamp_ntz").cast("timestamp")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(start)
    return micros / F.lit(1000000.0)


@query(
    f"""WITH e AS (SELECT event_id, CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '{DAY}'))
                                              / 1000000.0) AS BIGINT) AS t FROM events)
        SELECT event_id, t AS total_seconds, t // 86400 AS days, t % 86400 // 3600 AS hours,
               t % 3600 // 60 AS minutes, t % 60 AS seconds
        FROM e"""
)
def duration_split(spark: SparkSession, folder: str) -> DataFrame:
    events = named_table(spark, folder, "events")
    parts = scalars.duration_split(_elapsed())
    return events.select("event_id", parts.alias("d")).select("event_id", "d.*")


@query(
    """WITH e AS (SELECT event_id,
                         epoch_ms(TIMESTAMP '2024-01-05 12:00:00') - epoch_us(ts) // 1000 AS gap
                  FROM events)
       SELECT event_id, CASE WHEN gap > 0 THEN gap / 1000.0 ELSE 0.0 END AS remaining,
              CAST(CASE WHEN gap > 0 THEN floor(gap / 1000.0 + 0.5) ELSE 0.0 END AS DOUBLE)
                AS remaining_rounded,
              CASE WHEN gap < 0 THEN -gap / 1000.0 ELSE 0.0 END AS passed
       FROM e"""
)
def seconds_until(spark: SparkSession, folder: str) -> DataFrame:
    """The present moment is an argument, so that runs repeat."""
    events = named_table(spark, folder, "events")
    expiry = F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")
    now = F.col("ts")
    return events.select(
        "event_id",
        scalars.seconds_until(expiry, now).alias("remaining"),
        scalars.seconds_until(expiry, now, rounded=True).alias("remaining_rounded"),
        scalars.seconds_since(expiry, now).alias("passed"),
    )


@query(
    f"""WITH e AS (SELECT event_id, CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '{DAY}'))
                                              / 1000000.0) AS BIGINT) AS t FROM events)
        SELECT event_id, t % 86400 // 3600 % 12 AS hours, t % 3600 // 60 AS minutes,
               t % 60 AS seconds,
               CASE WHEN t % 86400 // 3600 >= 12 THEN 'pm' ELSE 'am' END AS ampm
        FROM e"""
)
def clock_12h(spark: SparkSession, folder: str) -> DataFrame:
    events = named_table(spark, folder, "events")
    reading = scalars.clock(_elapsed(), twelve_hour=True)
    return events.select("event_id", reading.alias("c")).select("event_id", "c.*")


_SCORE = """CAST(length({0}) > 5 AS INTEGER) + CAST(length({0}) > 7 AS INTEGER)
  + CAST(regexp_matches({0}, '[0-9]') AS INTEGER)
  + CAST(regexp_matches({0}, '[!#@$%^&*)(+=._-]') AS INTEGER)
  + CAST(regexp_matches({0}, '[a-z]') AND regexp_matches({0}, '[A-Z]') AS INTEGER)"""


@query(f"SELECT c_custkey, {_SCORE.format('c_name')} AS score FROM customer")
def strength_score(spark: SparkSession, folder: str) -> DataFrame:
    score = scalars.strength_score(F.col("c_name"))
    return named_table(spark, folder, "customer").select("c_custkey", score.alias("score"))


@query(
    f"""WITH s AS (SELECT {_SCORE.format('p_name')} AS score FROM part
                   UNION ALL SELECT {_SCORE.format('p_brand')} FROM part
                   UNION ALL SELECT {_SCORE.format('p_type')} FROM part)
        SELECT CASE WHEN score < 2 THEN 'Poor' WHEN score < 3 THEN 'Weak'
                    WHEN score < 4 THEN 'Normal' WHEN score < 5 THEN 'Good'
                    WHEN score < 6 THEN 'Strong' ELSE 'Poor' END AS label, count(*) AS n
        FROM s GROUP BY ALL"""
)
def strength_label(spark: SparkSession, folder: str) -> DataFrame:
    """How many texts of each strength a table holds."""
    part = named_table(spark, folder, "part").select("p_name", "p_brand", "p_type")
    texts = part.unpivot([], ["p_name", "p_brand", "p_type"], "column", "text")
    label = scalars.strength_label(scalars.strength_score(F.col("text")))
    return texts.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    r"""SELECT l_orderkey, l_linenumber,
               regexp_replace(CAST(l_extendedprice AS VARCHAR), '\.0$', '') AS price,
               regexp_replace(CAST(l_discount AS VARCHAR), '\.0$', '') AS discount,
               CAST(CAST(l_quantity * 1000000 AS BIGINT) AS VARCHAR) AS large
        FROM lineitem"""
)
def cell_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers as search and export write them."""
    return named_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        number_text(F.col("l_extendedprice")).alias("price"),
        number_text(F.col("l_discount")).alias("discount"),
        number_text(F.col("l_quantity") * 1000000).alias("large"),
    )
