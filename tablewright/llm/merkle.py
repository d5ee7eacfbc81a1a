"""Merkle manifest of a dataset: one tree per group, one over the groups' roots, a proof per row.

Rows are numbered in order, and pieces of 64 neighbouring nodes are hashed up six
levels at a time, so a tree of any height needs a few passes and no task holds a
level. Proofs are found by pointer jumping: every node starts with a segment, the one
sibling on the way to its parent; a self-join replaces a node's pointer by the pointer
of the node it leads to and appends that node's segment, so the distance doubles each
round until all leaves reach the root. A round keeps only the nodes that a later one
starts from or passes through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import Written, written
from tablewright.sources.literals import small_frame

#: Levels that one pass hashes: pieces of two to this power nodes.
LEVELS = 6
#: A side of a self-join up to so many bytes, counted first, is sent to the tasks whole.
SMALL_BYTES = 8 << 20
#: The tree over the groups' roots.
TOP = -1

_BITS = 33  # of the row's place in monotonically_increasing_id
_LEFT, _RIGHT = b"L", b"R"
_GROWN = "tree long, height int, level int, pos long, top boolean, step binary, digest binary, id long, carried binary"


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for a null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256, 32 bytes, of the values' fields one behind the other."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def numbered(df: DataFrame, *keys: str) -> DataFrame:
    """Adds ``place``, 0, 1, 2 and so on in the order of ``keys`` (null first), which tell rows apart.

    Rows are sorted in sampled ranges and written with their place in the range; the
    ranges' sizes, one number each, are then added up.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    held = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges").table
    part = F.shiftright("_at", _BITS)
    sizes = sorted(map(tuple, held.groupBy(part.alias("part")).agg(F.count("*")).collect()))
    starts, before = [], 0
    for number, size in sizes:
        starts.append((number, before))
        before += size
    offsets = small_frame(spark, starts, "_part long, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << _BITS) - 1)
    return held.join(offsets, part == F.col("_part")).select(*df.columns, place.alias("place"))


def _parent(left: bytes, right: bytes | None) -> bytes:
    return hashlib.sha256((left.hex() + (right.hex() if right else "")).encode()).digest()


def _grower(base: int):
    """The function that hashes pieces of a level up: steps of the nodes below, digests of those on top."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(3)
            ends = (nodes.offsets.to_numpy() - nodes.offsets[0].as_py()).tolist()
            flat = nodes.flatten()
            digests, ids, carried = (flat.field(i).to_pylist() for i in (1, 2, 3))
            out: list[tuple] = []
            for row, (tree, height, chunk) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)):
                start, end = ends[row], ends[row + 1]
                level, now = base, digests[start:end]
                while level < min(base + LEVELS, height):
                    first = chunk << (LEVELS - level + base)
                    for i, digest in enumerate(now):
                        other = now[i ^ 1] if i ^ 1 < len(now) else None
                        step = b"" if other is None else (_LEFT if i & 1 else _RIGHT) + other
                        # Leaves go on with what they carry; a node above is known by its place.
                        own = (digest, ids[start + i], carried[start + i]) if level == 0 else (None, None, None)
                        out.append((tree, height, level, first + i, False, step, *own))
                    now = [_parent(now[i], now[i + 1] if i + 1 < len(now) else None) for i in range(0, len(now), 2)]
                    level += 1
                # A tree's only leaf is its root.
                own = (ids[start], carried[start]) if height == 0 else (None, None)
                out.append((tree, height, level, chunk, True, None, now[0], *own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW, strict=True)], names=_NAMES
            )

    return grow


_ARROW = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
_NAMES = [c.split()[0] for c in _GROWN.split(", ")]


def _grown(level_nodes: DataFrame, tallest: int) -> list[Written]:
    """All nodes of the trees whose leaves are given as ``tree, height, pos, digest, id, carried``."""
    found, base = [], 0
    while True:
        node = F.struct("pos", "digest", "id", "carried")
        pieces = level_nodes.groupBy("tree", "height", F.shiftright("pos", LEVELS).alias("chunk")).agg(
            F.sort_array(F.collect_list(node)).alias("nodes")
        )
        found.append(written(pieces.mapInArrow(_grower(base), _GROWN), f"nodes{base}"))
        base += LEVELS
        if base >= tallest:
            return found
        level_nodes = found[-1].table.where(F.col("top") & (F.col("level") < F.col("height")))


def _height(leaves: int) -> int:
    return max(0, leaves - 1).bit_length()


def _union(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole


class Manifest(NamedTuple):
    """The digest of a table, and the way from each of its rows to it.

    ``proofs`` holds ``id``, ``leaf``, ``carried``, ``group``, ``subroot`` and
    ``segment``: one binary per level up to the root, ``L`` or ``R`` (the side on which
    the sibling stands) and the sibling's 32 bytes, or nothing where a node has none.
    """

    root: str | None
    proofs: DataFrame


def _pointers(nodes: DataFrame) -> DataFrame:
    """Each node with its parent and the one step there; a tree's root is a leaf of the top tree."""
    ends = (F.col("tree") != TOP) & (F.col("level") + 1 == F.col("height"))
    return nodes.select(
        "tree",
        "level",
        "pos",
        F.when(ends, TOP).otherwise(F.col("tree")).cast("long").alias("to_tree"),
        F.when(ends, 0).otherwise(F.col("level") + 1).alias("to_level"),
        F.when(ends, F.col("tree")).otherwise(F.shiftright("pos", 1)).alias("to_pos"),
        F.array("step").alias("segment"),
        "digest",
        "id",
        "carried",
    )


def _jump(now: DataFrame, distance: int, top_height: int) -> DataFrame:
    """Pointers of twice the distance, of the nodes that later rounds need."""
    of_top = F.col("tree") == TOP
    starts = now.where(of_top | (F.col("level") % (2 * distance) == 0))
    middle = now.where(of_top | (F.col("level") % (2 * distance) == distance))
    ended = (F.col("to_tree") == TOP) & (F.col("to_level") == top_height)
    row_bytes = 80 + 40 * distance
    few = middle.count() * row_bytes <= SMALL_BYTES
    middle = middle.select(
        F.col("tree").alias("m_tree"),
        F.col("level").alias("m_level"),
        F.col("pos").alias("m_pos"),
        F.col("to_tree").alias("m_to_tree"),
        F.col("to_level").alias("m_to_level"),
        F.col("to_pos").alias("m_to_pos"),
        F.col("segment").alias("m_segment"),
    )
    # Nodes that are there already would all meet at the root's key.
    joined = starts.where(~ended).join(
        F.broadcast(middle) if few else middle,
        (F.col("to_tree") == F.col("m_tree")) & (F.col("to_level") == F.col("m_level")) & (F.col("to_pos") == F.col("m_pos")),
    )
    moved = joined.select(
        "tree",
        "level",
        "pos",
        F.col("m_to_tree").alias("to_tree"),
        F.col("m_to_level").alias("to_level"),
        F.col("m_to_pos").alias("to_pos"),
        F.concat("segment", "m_segment").alias("segment"),
        "digest",
        "id",
        "carried",
    )
    return moved.unionByName(starts.where(ended))


def build(docs: DataFrame, id_col: Column, group: Column, leaf: Column, carried: Column | None = None) -> Manifest:
    """Trees over the rows of each group, in order of id, and one over the groups in order of name.

    ``id_col`` is a long, ``group`` a string, ``leaf`` the 32 bytes of a row's digest,
    ``carried`` a binary that comes back with its proof. In a tree every two
    neighbouring nodes become the digest of their hex digests, a last one without a
    neighbour the digest of its own, until one node remains; a lone leaf is its own
    root. A null group comes first, as does a row without an id; rows of one id are
    ordered by their digests, and rows that agree in that too are leaves of their own
    that stand side by side. An empty table has no root and no proofs.

    Hot groups lie in as many ranges and pieces as their rows need, and so do rows
    that share an id. What reaches the driver is one row per range and one for the
    whole table.
    """
    spark = docs.sparkSession
    rows = docs.select(
        group.cast("string").alias("group"),
        id_col.cast("long").alias("id"),
        leaf.alias("digest"),
        (carried if carried is not None else F.lit(None)).cast("binary").alias("carried"),
    )
    # Written with a number of its own, so that equal rows are told apart alike each time they are read.
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves").table
    placed = numbered(rows, "group", "id", "digest", "row")
    groups = placed.groupBy("group").agg(F.count("*").alias("n"), F.min("place").alias("start"))
    groups = written(numbered(groups, "start"), "groups").table
    n_groups, most = groups.agg(F.count("*"), F.max("n")).first()
    if not n_groups:
        empty = "id long, leaf binary, carried binary, group string, subroot binary, segment array<binary>"
        return Manifest(None, small_frame(spark, [], empty))
    top_height, tallest = _height(n_groups), _height(most)
    # The bits of n - 1: how often it is halved until one node remains.
    bits = F.when(F.col("n") == 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))
    of_group = groups.select(
        F.col("group").alias("_group"), F.col("place").alias("tree"), "start", bits.cast("int").alias("height")
    )
    leaves = placed.join(of_group, F.col("group").eqNullSafe(F.col("_group"))).select(
        "tree", "height", (F.col("place") - F.col("start")).alias("pos"), "digest", "id", "carried"
    )
    trees = _grown(leaves, tallest)
    tops = _union([t.table.where("top and level = height") for t in trees])
    subroots = written(tops.select("tree", "digest"), "subroots").table
    top_leaves = subroots.select(
        F.lit(TOP).cast("long").alias("tree"),
        F.lit(top_height).alias("height"),
        F.col("tree").alias("pos"),
        "digest",
        F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("binary").alias("carried"),
    )
    over = _grown(top_leaves, top_height)
    root = over[-1].table.where(F.col("top") & (F.col("level") == top_height)).first()["digest"]

    steps = _union([_pointers(t.table.where("not top")) for t in trees + over])
    # The only leaf of a tree is a leaf of the top tree: no step, and it stands there already.
    alone = tops.where("height = 0").select(
        "tree",
        "level",
        "pos",
        F.lit(TOP).cast("long").alias("to_tree"),
        F.lit(0).alias("to_level"),
        F.col("tree").alias("to_pos"),
        F.array().cast("array<binary>").alias("segment"),
        "digest",
        "id",
        "carried",
    )
    now = written(steps.unionByName(alone), "pointers")
    distance = 1
    while distance < tallest + top_height + 1:
        after = written(_jump(now.table, distance, top_height), f"pointers{distance}")
        now.drop()
        now, distance = after, 2 * distance
    names = of_group.join(subroots.withColumnsRenamed({"tree": "_tree", "digest": "subroot"}), F.col("tree") == F.col("_tree"))
    names = written(names.select("_tree", "_group", "subroot"), "names").table
    at_root = now.table.where((F.col("tree") != TOP) & (F.col("level") == 0))
    proofs = at_root.join(names, F.col("tree") == F.col("_tree")).select(
        "id", F.col("digest").alias("leaf"), "carried", F.col("_group").alias("group"), "subroot", "segment"
    )
    return Manifest(bytes(root).hex(), proofs)


def proof_digest(segment: Column) -> Column:
    """SHA-256 of all siblings of a way, as hex texts one behind the other."""
    return F.sha2(F.array_join(F.transform(segment, lambda s: _hex(F.substring(s, 2, 32))), ""), 256)


def fold(leaf: Column, segment: Column) -> Column:
    """The root, as hex text, that a leaf and the siblings on its way lead to."""

    def up(node: Column, step: Column) -> Column:
        sibling = _hex(F.substring(step, 2, 32))
        on_left = F.hex(F.substring(step, 1, 1)) == F.lit(_LEFT.hex().upper())
        return F.sha2(F.when(on_left, F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)

    return F.aggregate(segment, _hex(leaf), up)


def verified(manifest: Manifest, claimed: Column) -> DataFrame:
    """The proofs with ``folded_root``, from ``claimed`` digests, and whether it is the root."""
    root = F.lit(manifest.root)
    folded = manifest.proofs.select(
        F.col("id").alias("doc_id"),
        _hex(F.col("leaf")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        proof_digest(F.col("segment")).alias("proof_sha256"),
        fold(claimed, F.col("segment")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
