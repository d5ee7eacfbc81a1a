"""Near-duplicate texts by SimHash, found through segment bit counts.

A fingerprint is cut into segments; the vector of their bit counts moves by at
most one, in one place, for every differing bit, so the Manhattan distance of two
vectors is never above the Hamming distance of the fingerprints. Vectors are
points of a grid. Two points at Manhattan distance two or less have a point
between them at distance one or less from both, so every fingerprint is entered
at its own grid point and the points next to it, and pairs meet there. Only the
pairs that meet are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.components import connected_components
from tablewright.llm.shared import word_chunks, written

BITS = 64
#: Differing bits up to which the grid is laid out.
GRID_REACH = 2
SEED = 42
SHINGLE_WORDS = 3
#: Fingerprints at one grid point up to which they are compared in pairs; beyond,
#: they are entered again by their single bits (segments of one bit), where
#: meeting is proof and no pair needs a look.
CROWD = 64

_ONES = np.uint64(0x5555555555555555)
_TWOS = np.uint64(0x3333333333333333)
_SEGMENTS = np.uint64(1) << np.arange(0, BITS, 4, dtype=np.uint64)
_SINGLE_BITS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def fingerprint(data: bytes, size: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half the hashes of the text's word shingles."""
    tally, count, held = np.zeros(BITS, np.int64), 0, []
    for words in word_chunks(data):
        held += words
        if len(held) >= size:
            hashes = _hashes(held, size)
            bits = np.unpackbits(
                hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            tally += bits.sum(axis=0, dtype=np.int64)
            count += len(hashes)
            held = held[len(held) - size + 1 :]
    if not count and held:
        return xxhash.xxh64_intdigest(b" ".join(held), SEED)
    return int(np.packbits(2 * tally > count, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS
) -> DataFrame:
    """Rows ``(doc_id, fp)``: one for every row, a null text as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, size) if t else 0 for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, fp long")


@F.pandas_udf(T.LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint of a text as a column, a null text as an empty one."""
    found = [fingerprint(t.encode()) if t else 0 for t in texts]
    return pd.Series(np.array(found, np.uint64).view(np.int64))


def embed(fps: np.ndarray) -> np.ndarray:
    """The bit counts of the sixteen four-bit segments, four bits each in one word."""
    pairs = fps - ((fps >> np.uint64(1)) & _ONES)
    return (pairs & _TWOS) + ((pairs >> np.uint64(2)) & _TWOS)


def _grid_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        home = embed(fps)
        points, owners = [home], [fps]
        for unit in _SEGMENTS:
            counts = (home // unit) & np.uint64(15)
            for kept, moved in ((counts < 4, home + unit), (counts > 0, home - unit)):
                points.append(moved[kept])
                owners.append(fps[kept])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (points, owners)],
            names=["point", "fp"],
        )


def _bit_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        points = np.concatenate([fps[:, None], fps[:, None] ^ _SINGLE_BITS[None, :]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(points.ravel().view(np.int64)),
                pa.array(np.repeat(fps, BITS + 1).view(np.int64)),
            ],
            names=["point", "fp"],
        )


def _meet(points: np.ndarray, fps: np.ndarray, reach: int, crowd: int) -> list[np.ndarray]:
    """Verified pairs of one sorted run of grid points, then those in crowds beside themselves."""
    edges = np.flatnonzero(np.diff(points)) + 1
    sizes = np.diff(np.concatenate([[0], edges, [len(points)]]))
    of_run = np.repeat(sizes, sizes)
    crowded = fps[of_run > crowd]
    quiet = (of_run > 1) & (of_run <= crowd)
    points, fps = points[quiet], fps[quiet]
    home = embed(fps)
    left, right = [crowded], [crowded]
    for step in range(1, crowd):
        together = points[step:] == points[:-step] if step < len(points) else np.zeros(0, bool)
        if not together.any():
            break
        at = np.flatnonzero(together)
        a, b = fps[at], fps[at + step]
        # Equal vectors meet at many points: only the pair's own point speaks for it.
        first = (home[at] != home[at + step]) | (home[at] == points[at])
        near = first & (np.bitwise_count(a ^ b) <= reach) & (a != b)
        left.append(a[near])
        right.append(b[near])
    return [np.concatenate(left), np.concatenate(right)]


def _links(reach: int, crowd: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, fps = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        shed = None  # the grid point of a crowd that has been passed on in part

        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)]
            points, fps = np.concatenate([points, new[0]]), np.concatenate([fps, new[1]])
            if not len(points):
                continue
            if shed is not None:
                of_shed = points == shed
                yield out(fps[of_shed], fps[of_shed])
                if of_shed.all():
                    points, fps = points[:0], fps[:0]
                    continue
                points, fps, shed = points[~of_shed], fps[~of_shed], None
            others = points[::-1] != points[-1]
            last = len(points) - int(np.argmax(others)) if others.any() else 0
            if last:
                yield out(*_meet(points[:last], fps[:last], reach, crowd))
                points, fps = points[last:], fps[last:]
            if len(points) > crowd:
                yield out(fps, fps)
                shed, points, fps = points[-1], points[:0], fps[:0]
        if len(points):
            yield out(*_meet(points, fps, reach, crowd))

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    reach: int = GRID_REACH,
    crowd: int = CROWD,
) -> DataFrame:
    """Rows ``(doc_id, fp, component_id, root)``, one for every row of the table.

    ``fp`` is the fingerprint as a signed long and ``root`` the smallest one of its
    component; fingerprints at ``reach`` (two at
    most) or fewer differing bits are linked, and ``component_id`` is the smallest
    id among the documents reachable. Null, empty and blank texts have fingerprint
    zero, which is linked like any other. Rows without an id get a component but
    name none; a component of such rows only has a null ``component_id``. Repeated
    rows stay. An empty table gives an empty result. Texts are read whole, however long, and other
    columns are not read, whatever they are called.

    Equal fingerprints are one point, whatever the number of copies. The grid join
    has at most 33 rows per distinct fingerprint; a crowded grid point is resolved
    by single bits, in 65 rows for each of its fingerprints and without pairs.
    """
    if not 0 <= reach <= GRID_REACH:
        raise ValueError(f"reach goes up to {GRID_REACH}")
    marked = written(fingerprints(docs, id_col, text_col, size), "fingerprints").table
    points = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    met = points.select("fp").mapInArrow(_grid_points, "point long, fp long")
    met = met.repartition("point").sortWithinPartitions("point", "fp")
    pairs = written(met.mapInArrow(_links(reach, crowd), "a long, b long"), "pairs").table
    links = pairs.where("a <> b")
    crowded = pairs.where("a = b").select(F.col("a").alias("fp")).distinct()
    if reach == GRID_REACH:
        entered = crowded.mapInArrow(_bit_points, "point long, fp long")
        hubs = entered.groupBy("point").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        met_there = entered.join(hubs.where("low < high"), "point").select(
            F.col("fp").alias("a"), F.col("low").alias("b")
        )
    else:
        # A crowd at a smaller reach: fingerprints one bit apart, from the one to the other.
        entered = crowded.mapInArrow(_bit_points, "point long, fp long")
        met_there = entered.join(crowded.withColumnRenamed("fp", "point"), "point").select(
            F.col("fp").alias("a"), F.col("point").alias("b")
        ).where(F.lit(reach > 0))
    roots = connected_components(links.unionByName(met_there), "a", "b").table
    rooted = points.join(roots, points.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id", "root")
