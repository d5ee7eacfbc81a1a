"""Shards of near equal bytes by a k-d tree over metadata, in DataFrame functions only.

Every document is a point of a few metadata dimensions with a weight, its size.
The tree starts with one cell; a cell above the target size is cut at the weighted
median of its widest dimension. Medians of all cells of a level are found together
by narrowing: the weights are summed by the leading digits of a sort key, the
digit that holds the median is taken, and the next digits are summed within it.
What reaches the driver is one row per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.merkle import numbered
from tablewright.llm.shared import written

SHARDS = 16
LAW = "bytes"

#: Bits of a sort key: the dimension's place, then a digest that parts what is equal there.
PLACE_BITS, TIE_BITS = 30, 32
#: Bits that one pass over the points narrows a median by.
STEP_BITS = 16
#: A group of equal texts heavier than this part of a shard's target is dealt by row.
GROUP_PARTS = 8
#: Rows that a numbering task is meant to get.
SLOT_ROWS = 20_000


def text_crc(text: Column) -> Column:
    """CRC-32 of the UTF-8 text, an empty one for a null."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def _place(value: Column, low: Column, high: Column) -> Column:
    """A number's place between low and high, as a whole number of ``PLACE_BITS`` bits."""
    top = (1 << PLACE_BITS) - 1
    return F.when(high > low, F.floor((value - low) / (high - low) * top)).otherwise(0).cast("long")


def points(
    docs: DataFrame, dimensions: dict[str, Column], id_col: str, text_col: str
) -> DataFrame:
    """Rows ``doc_id``, ``size``, ``crc`` and one column per dimension, a number or a name.

    A null in a dimension is the lowest place, below all values.
    """
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        text_crc(text).alias("crc"),
        *[_plain(docs, value).alias(name) for name, value in dimensions.items()],
    )


def _plain(docs: DataFrame, value: Column) -> Column:
    """Numbers as doubles, anything else as text."""
    kind = docs.select(value).schema[0].dataType
    return value.cast("double") if isinstance(kind, T.NumericType) else value.cast("string")


def _ranked(raw: DataFrame, name: str) -> DataFrame:
    """Names become their rank among the distinct ones, so that as many as there are stand apart.

    Names are made distinct per task first; ranks are written, so that Spark knows
    their size and sends them to the tasks where they are few.
    """
    names = raw.select(F.col(name).alias("_name")).where("_name is not null").distinct()
    ranks = written(numbered(names, "_name"), "ranks").table
    joined = raw.join(ranks, F.col(name) == F.col("_name"), "left")
    return joined.select(*[F.col("place").cast("double").alias(name) if c == name else c for c in raw.columns])


def _placed(raw: DataFrame, names: Sequence[str], heavy: float) -> DataFrame:
    """Numbers and the ranks of names become places; equal texts get one point, unless they weigh too much together.

    Texts are held equal by length and checksum: two texts that agree in both are
    merely kept together. Only groups of more than one row are joined back.
    """
    for n in names:
        if isinstance(raw.schema[n].dataType, T.StringType):
            raw = _ranked(raw, n)
    bounds = raw.agg(
        *[F.min(n).alias(f"low_{n}") for n in names], *[F.max(n).alias(f"high_{n}") for n in names]
    ).first()
    places = []
    for n in names:
        low, high = bounds[f"low_{n}"], bounds[f"high_{n}"]
        if low is None:
            places.append(F.lit(0).cast("long").alias(n))
        else:
            places.append(F.coalesce(_place(F.col(n), F.lit(low), F.lit(high)) + 1, F.lit(0)).alias(n))
    placed = raw.select("doc_id", "size", "crc", *places)
    groups = (
        placed.groupBy(F.col("crc").alias("of_crc"), F.col("size").alias("of_size"))
        .agg(F.count("*").alias("copies"), *[F.min(n).alias(f"of_{n}") for n in names])
        .where("copies > 1")
        .withColumn("apart", F.col("of_size") * F.col("copies") > heavy)
        .drop("copies")
    )
    # Once written its size is known: a small table is sent to the tasks, and no row of a hot group moves.
    joined = placed.join(
        written(groups, "groups").table, (F.col("crc") == F.col("of_crc")) & (F.col("size") == F.col("of_size")), "left"
    )
    own = F.crc32(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("crc").cast("string")).cast("binary"))
    return joined.select(
        "doc_id",
        "size",
        "crc",
        F.when(F.col("apart"), own).otherwise(F.col("crc")).alias("tie"),
        *[F.when(~F.col("apart"), F.col(f"of_{n}")).otherwise(F.col(n)).alias(n) for n in names],
    )


def _sort_key(dimension: Column) -> Column:
    return dimension * F.lit(1 << TIE_BITS) + F.col("tie")


def _choose(of: Column, pairs: dict[int, Column]) -> Column:
    chosen = F.lit(None).cast("long")
    for cell, value in pairs.items():
        chosen = F.when(of == cell, value).otherwise(chosen)
    return chosen


def _medians(table: DataFrame, along: dict[int, str]) -> dict[int, int]:
    """The key of each cell up to which its lower side holds half its weight, or next to it.

    Of the two keys around the half, the one that leaves the sides nearer to equal
    is taken, the lower one on a tie.
    """
    bits = PLACE_BITS + 1 + TIE_BITS
    keyed = table.select(
        "cell", "size", _choose(F.col("cell"), {c: _sort_key(F.col(d)) for c, d in along.items()}).alias("key")
    ).where("key is not null")
    known = {c: 0 for c in along}  # leading digits of the median
    below = {c: 0 for c in along}  # weight below them
    whole: dict[int, int] = {}
    last_below: dict[int, int | None] = {c: None for c in along}
    shift = bits
    while shift:
        step = min(STEP_BITS, shift)
        shift -= step
        digits = F.shiftright(keyed["key"], shift)
        if whole:
            inside = _choose(F.col("cell"), {c: F.lit(p) for c, p in known.items()})
            narrowed = keyed.where(F.shiftright("key", shift + step) == inside)
        else:
            narrowed = keyed
        sums = narrowed.groupBy("cell", digits.alias("digit")).agg(F.sum("size").alias("weight"))
        in_order = W.partitionBy("cell").orderBy("digit")
        if not whole:
            totals = {r["cell"]: r["weight"] for r in sums.groupBy("cell").agg(F.sum("weight").alias("weight")).collect()}
            whole = {c: totals.get(c, 0) for c in along}
        start = _choose(F.col("cell"), {c: F.lit(b) for c, b in below.items()})
        half = _choose(F.col("cell"), {c: F.lit(w) for c, w in whole.items()})
        running = sums.withColumn("upto", F.sum("weight").over(in_order) + start)
        # The first digit whose running weight reaches half.
        hit = running.where(2 * F.col("upto") >= half).groupBy("cell").agg(
            F.min_by(F.struct("digit", "upto", "weight"), "digit").alias("at")
        )
        for r in hit.collect():
            known[r["cell"]] = r["at"]["digit"]
            below[r["cell"]] = r["at"]["upto"] - r["at"]["weight"]
            last_below[r["cell"]] = r["at"]["upto"]
    # At the last digit, ``known`` is the key that reaches half; the other choice stops before it.
    cuts = {}
    for c in along:
        over, under = 2 * last_below[c] - whole[c], whole[c] - 2 * below[c]
        cuts[c] = known[c] if below[c] == 0 or over <= under else known[c] - 1
    return cuts


def split(table: DataFrame, names: Sequence[str], shards: int) -> DataFrame:
    """Adds ``shard`` to placed points: the leaf of the k-d tree they fall into.

    A cell that stands for n shards (a power of two) is halved until it stands for
    one, whose target is the total over ``shards``.
    """
    depth = shards.bit_length() - 1
    if shards != 1 << depth:
        raise ValueError("the number of shards must be a power of two")
    cells = table.withColumn("cell", F.lit(0).cast("long"))
    for level in range(depth):
        spans = cells.groupBy("cell").agg(
            F.sum("size").alias("weight"), *[(F.max(n) - F.min(n)).alias(n) for n in names]
        ).collect()
        # The widest dimension; the first of them on a tie.
        along = {r["cell"]: max(names, key=lambda n, r=r: (r[n], -names.index(n))) for r in spans}
        if not along:
            break
        cuts = _medians(cells, along)
        side = _choose(
            F.col("cell"),
            {c: (_sort_key(F.col(along[c])) > F.lit(k)).cast("long") for c, k in cuts.items()},
        )
        cells = cells.withColumn("cell", (F.col("cell") * 2 + F.coalesce(side, F.lit(0))).cast("long"))
        # Else every level's rule would be part of the next one's expression.
        cells = written(cells, f"cells{level}").table
    return cells.withColumnRenamed("cell", "shard")


def number(sharded: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds ``slot``, 0, 1, 2 and so on within each shard.

    Rows are numbered within buckets of a bounded number of rows and shifted by the
    sizes of the buckets before, so no task holds a shard.
    """
    rows = sharded.count()
    buckets = max(1, -(-rows // (SLOT_ROWS * shards)) * 4)
    bucket = F.pmod(F.xxhash64("doc_id", "crc", "size"), F.lit(buckets))
    dealt = sharded.withColumn("bucket", bucket)
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = W.partitionBy("shard", "bucket").orderBy("doc_id", "crc", "size")
    numbered = dealt.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "bucket"]).withColumn(
        "slot", (F.col("offset") + F.col("place")).cast("long")
    )


def shard_documents(
    docs: DataFrame,
    dimensions: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
) -> DataFrame:
    """Rows ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the text's UTF-8 bytes plus one (one for a null). The law is
    ``bytes``: shards are near equal in bytes, as near as the document on a cut
    allows. Equal texts stay together, save for groups heavier than an eighth of a
    shard, which are dealt by row.
    Rows without an id are placed like others; repeated rows are separate rows and
    get slots of their own. A shard is empty only where there are fewer rows than
    shards or equal rows outweigh it; an empty table gives an empty result.
    Texts are read whole, however long, and other
    columns are not read, whatever they are called.
    """
    names = list(dimensions)
    raw = written(points(docs, dimensions, id_col, text_col), "points").table
    total = raw.agg(F.sum("size")).first()[0] or 0
    placed = written(_placed(raw, names, total / shards / GROUP_PARTS), "placed").table
    return number(split(placed, names, shards), shards).select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def text_dimensions(docs: DataFrame, source_col: str = "source", lang_col: str = "lang", text_col: str = "text") -> dict[str, Column]:
    """The metadata of a documents table: its source and language, by name, and the text's length.

    Names stand by their rank among the distinct ones, the length by its logarithm.
    """
    length = F.log2(F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 1.0)
    return {"source": F.col(source_col).cast("string"), "lang": F.col(lang_col).cast("string"), "length": length}
