"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Tokens are handed out in equal blocks. Sources get whole numbers of blocks by
highest quotients, then each source's number is shared among its shards the same
way. In a shard the documents of a source, in seeded order, form a ring of tokens;
the shard's quota is that many neighbouring blocks of the ring from a seeded start.

The block suits sources of a fair size. A source whose runs would miss its target by
more than ``MOST_MISSED_PERCENT``, as its rings hold few blocks or it has no seat, is
one ring instead, its shards behind one another, and its run is its target to the token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.shared import written

# Fixed values of the mix: weights in turn, tokens wanted per token there, repeats at most.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_PASSES = 2

#: Tokens a shard is meant to hold, and the most shards, beyond which they hold more.
SHARD_TOKENS = 250_000
MOST_SHARDS = 1 << 16
#: Blocks that a shard of an average source is cut into.
BLOCKS_PER_SHARD = 64
#: Share of a source's target by which its blocks may miss it.
MOST_MISSED_PERCENT = 1
SEED = "mix-1"

#: Words: what stands between 0x20 and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` holds ``source`` (null allowed) and ``size`` (tokens); adds ``weight`` and ``target``.

    Weights go round by code point, null last. Targets are proportional to weight
    but stop at ``MOST_PASSES`` times the size; what is cut off goes to the others
    by weight. With sources in order of ``cap / weight``, the first k are cut off,
    where k is the smallest number whose common level does not lift the next one
    above its cap. One row per source goes through one task here.
    """
    in_turn = W.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = W.orderBy("ratio", "turn")
    sized = sources.withColumn("turn", F.row_number().over(in_turn) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("turn") % len(WEIGHTS) + 1)
    ranked = sized.withColumn("weight", weight.cast("long")).withColumn(
        "ratio", F.col("size") * F.lit(MOST_PASSES) / F.col("weight")
    )
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    left_over = F.sum("size").over(whole) * SHARE_PERCENT - 100 * MOST_PASSES * F.coalesce(
        F.sum("size").over(before), F.lit(0)
    )
    level = left_over / 100.0 / F.sum("weight").over(onward)
    levelled = ranked.withColumn("level", level).withColumn(
        "level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole)
    )
    cap = (F.col("size") * MOST_PASSES).cast("double")
    return levelled.select(
        "source",
        F.col("size").alias("source_size"),
        "weight",
        F.least(cap, F.coalesce(F.col("weight") * F.col("level"), cap)).alias("target"),
    )


def apportion(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë: ``quota`` for each party, ``seats`` in all for its group.

    A party's k-th seat has the quotient ``votes / (2k - 1)``. At the level
    ``sum(votes) / (2 seats)`` every party holds its share rounded to the nearest
    whole; the seats too many or too few against that are taken back or handed out
    by quotient. Only quotients as good as the last needed one among the parties'
    first can be among them, so few are ranked. ``seats`` must be the same in all
    rows of a group.
    """
    of_group = W.partitionBy(*group)
    shared = parties.withColumn("_all", F.sum(votes).over(of_group)).withColumn(
        "_near",
        F.when(F.col("_all") > 0, F.floor(F.col(votes) * F.col(seats) / F.col("_all") + 0.5)).otherwise(0),
    )
    open_seats = F.when(F.col("_all") > 0, F.col(seats)).otherwise(0) - F.sum("_near").over(of_group)
    shared = shared.withColumn("_open", open_seats.cast("long"))
    order = [F.col(c).asc_nulls_last() for c in party]
    getting = F.col("_open") > 0
    # The first quotient each party could move by, and the last of those that are enough.
    first = F.when(getting, F.col(votes) / (2 * F.col("_near") + 1)).when(
        F.col("_near") > 0, F.col(votes) / (2 * F.col("_near") - 1)
    )
    ranked = shared.where("_open <> 0").withColumn("_first", first)
    by_first = of_group.orderBy(
        F.when(getting, -F.col("_first")).otherwise(F.col("_first")).asc_nulls_last(), *order
    )
    enough = F.row_number().over(by_first) == F.abs("_open")
    ranked = ranked.withColumn("_enough", enough).withColumn(
        "_pivot", F.max(F.when(F.col("_enough"), F.col("_first"))).over(of_group)
    )
    # Seats of a party on the better side of the pivot, one more against rounding.
    level = F.floor((F.col(votes) / F.col("_pivot") + 1) / 2)
    steps = F.when(getting, level - F.col("_near") + 1).otherwise(F.col("_near") - level + 1)
    steps = F.when(F.col("_pivot") > 0, F.greatest(F.lit(0), steps)).otherwise(F.abs("_open"))
    steps = F.least(F.abs("_open"), steps, F.when(getting, F.abs("_open")).otherwise(F.col("_near")))
    tried = ranked.withColumn("_steps", steps.cast("int")).where("_steps > 0").withColumn(
        "_step", F.explode(F.sequence(F.lit(1), F.col("_steps")))
    )
    seat = F.when(F.col("_open") > 0, F.col("_near") + F.col("_step")).otherwise(
        F.col("_near") - F.col("_step") + 1
    )
    tried = tried.withColumn("_quotient", F.col(votes) / (2 * seat - 1))
    by_quotient = of_group.orderBy(
        F.when(getting, -F.col("_quotient")).otherwise(F.col("_quotient")), *order, "_step"
    )
    moved = (
        tried.withColumn("_rank", F.row_number().over(by_quotient))
        .where("_rank <= abs(_open)")
        .groupBy(*group, *party)
        .agg(F.sum(F.signum("_open")).cast("long").alias("_moved"))
        .withColumnsRenamed({c: f"_of_{c}" for c in [*group, *party]})
    )
    key = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*group, *party]]
    quota = (F.col("_near") + F.coalesce(F.col("_moved"), F.lit(0))).cast("long")
    return shared.join(moved, key, "left").select(*parties.columns, quota.alias("quota"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """The mix of all documents: one row for each, with what the mix takes of it.

    Columns: ``doc_id``, ``source``, ``size`` (words; a null text has none),
    ``source_size``, ``target`` (its source's), ``taken`` (words, repeats
    counted) and ``copies`` (how often the run covers its first word). A document
    at an end of its ring's run is taken in part; none is taken more than twice. Null sources are one source, rows without an id are
    placed by their size alone, repeated rows are separate documents, and texts
    without words take part with nothing, and texts count whole, however long. Other columns are not read, whatever they are called; an empty table gives an empty result. No seed but the given one enters, so
    reruns agree.

    A hot source lies in as many shards as any other, each of a bounded number of
    tokens, and every window but those over one row per source or per source and
    shard runs within one source and shard.
    """
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
    )
    return mix_sized(written(sized, "sizes").table, seed)


def mix_sized(sized: DataFrame, seed: str = SEED) -> DataFrame:
    """:func:`mix` of rows ``doc_id``, ``source`` and ``size``."""
    digest = F.md5(F.concat_ws("/", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    facts = sized.agg(F.sum("size"), F.countDistinct(F.coalesce("source", F.lit(""))), F.count("*")).first()
    total, n_sources = facts[0] or 0, max(1, facts[1])
    shards = min(MOST_SHARDS, max(1, -(-total // SHARD_TOKENS)))
    block = max(1, total // (n_sources * shards * BLOCKS_PER_SHARD))
    keyed = sized.withColumn("_order", digest).withColumn(
        "_shard", F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % shards
    )
    rings = keyed.groupBy("source", "_shard").agg(F.sum("size").alias("ring"))
    wanted = targets(rings.groupBy("source").agg(F.sum("ring").alias("size")))
    # Sources: as many blocks as all targets make, by targets.
    seats = F.round(F.sum("target").over(W.partitionBy()) / block).cast("long")
    wanted = apportion(
        wanted.withColumns({"_seats": seats, "_one": F.lit(1)}), ["_one"], ["source"], "target", "_seats"
    ).select("source", "source_size", "target", F.col("quota").alias("_seats"))
    # Shards: each source's blocks, by the tokens there.
    rings = rings.withColumnRenamed("source", "_source")
    shared = apportion(
        rings.join(wanted, F.col("_source").eqNullSafe(F.col("source"))).drop("_source"),
        ["source"],
        ["_shard"],
        "ring",
        "_seats",
    )
    run = F.least(F.col("quota") * F.lit(block), F.col("ring") * MOST_PASSES)

    def seeded_start(*of: str) -> Column:
        digits = F.md5(F.concat_ws("/", F.lit(seed), *of).cast("binary"))
        return F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")

    # Where blocks miss the target, the source's shards behind one another are its ring.
    of_source = W.partitionBy("source")
    before = of_source.orderBy("_shard").rowsBetween(W.unboundedPreceding, -1)
    missed = F.abs(F.sum(run).over(of_source) - F.col("target"))
    shared = shared.withColumn("_whole", missed * 100 > F.col("target") * MOST_MISSED_PERCENT)
    blocks = F.greatest(F.lit(1), F.floor(F.col("ring") / F.lit(block)))

    def either(whole: Column, by_shard: Column) -> Column:
        return F.when(F.col("_whole"), whole).otherwise(by_shard)

    runs = shared.select(
        F.col("source").alias("_source"),
        F.col("_shard").alias("_ring"),
        "source_size",
        "target",
        either(F.col("source_size"), F.col("ring")).alias("ring"),
        either(F.round("target").cast("long"), run).alias("_run"),
        either(
            seeded_start("source") % F.greatest(F.lit(1), F.col("source_size")),
            (seeded_start("source", "_shard") % blocks) * F.lit(block),
        ).alias("_start"),
        either(F.coalesce(F.sum("ring").over(before), F.lit(0)), F.lit(0)).alias("_offset"),
    )
    # The place of each document in its ring.
    seeded = W.partitionBy("source", "_shard").orderBy("_order", "doc_id", "size")
    placed = keyed.withColumn("_end", F.sum("size").over(seeded.rowsBetween(W.unboundedPreceding, 0)))
    joined = placed.join(
        runs, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_ring"))
    )
    ring = F.greatest(F.col("ring"), F.lit(1))
    passes = F.floor(F.col("_run") / ring)
    rest = F.col("_run") - passes * ring
    high = F.col("_offset") + F.col("_end")
    low = high - F.col("size")

    def overlap(first: Column, last: Column) -> Column:
        return F.greatest(F.lit(0), F.least(high, last) - F.greatest(low, first))

    wrap = F.col("_start") + rest - F.col("ring")
    once = overlap(F.col("_start"), F.col("_start") + rest) + overlap(F.lit(0), wrap)
    begins = ((low >= F.col("_start")) & (low < F.col("_start") + rest)) | (low < wrap)
    begins = begins.cast("int")
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + once).cast("long").alias("taken"),
        (passes + begins).cast("int").alias("copies"),
    )
