"""Test items inside long documents, by MinHash containment search.

An item is contained in a document if the document has at least ``threshold`` of
the item's distinct word shingles. Items are partitioned by their number of
shingles. A shingle's hash is its place in one random order, and an item's sketch
is its smallest hashes: in a partition of items of up to n shingles the sketch
holds ``n - ceil(threshold * n) + 1`` of them, one more than a contained item may
miss, so at least one is in every document that contains the item. Documents are
not sketched: however long, all their shingles are held against the sketches, so
an item's share of the document's length plays no part. What is found is verified
by counting exact shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import word_chunks, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Bits of the hash that index the filter of sketched hashes: 2**24 bits are two
#: megabytes, however many items there are. A fuller filter lets more rows pass to
#: the join; it never loses one.
FILTER_BITS = 24
#: Upper bounds of the partitions by size grow by this factor.
SIZE_STEP = 1.25


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(0)), np.uint64)


def shingle_hashes(data: bytes, size: int) -> np.ndarray:
    """Distinct hashes of all shingles of ``size`` words of a text, ascending."""
    parts, held = [np.zeros(0, np.uint64)], []
    for words in word_chunks(data):
        held += words
        if len(held) >= size:
            parts.append(np.unique(_hashes(held, size)))
            held = held[len(held) - size + 1 :]
    return parts[1] if len(parts) == 2 else np.unique(np.concatenate(parts))


def size_bounds(most: int) -> list[int]:
    """Upper bounds of the size partitions, up to the largest item."""
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, math.floor(bounds[-1] * SIZE_STEP)))
    return bounds


def sketch_length(bound: int, threshold: float) -> int:
    """Hashes that items of up to ``bound`` shingles are sketched with."""
    return bound - math.ceil(threshold * bound - 1e-9) + 1


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """Rows ``item_id``, ``words`` (of each shingle), ``count`` and ``hashes`` (all, ascending).

    An item of fewer words than a shingle has is one shingle of all of them; one
    without words has none and is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(
                batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True
            ):
                n = 0
                for words in word_chunks(text or b""):
                    n += len(words)
                    if n >= size:
                        break
                if n and item is not None:
                    n = min(n, size)
                    hashes = shingle_hashes(text, n)
                    rows.append((item, n, len(hashes), hashes.view(np.int64)))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["item_id", "words", "count", "hashes"],
            )

    picked = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "item_id long, words int, count int, hashes array<long>")


def _filter(sketches: DataFrame) -> tuple[np.ndarray, list[int]]:
    """One bit for each leading ``FILTER_BITS`` bits that a sketched hash begins with; shingle lengths."""
    lead = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    cells = sketches.groupBy(F.shiftright(lead, 6).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 as int)))").alias("bits")
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in cells.collect():  # 2**18 rows at most
        table[row["word"]] = row["bits"]
    lengths = sorted(r["words"] for r in sketches.select("words").distinct().collect())
    return table.view(np.uint64), lengths


def _probe(table: np.ndarray, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, low, six, one = np.uint64(64 - FILTER_BITS), np.uint64(63), np.uint64(6), np.uint64(1)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            docs, sizes, found = [], [], []
            for doc, text in zip(ids, texts, strict=True):
                for size in lengths:
                    hashes = shingle_hashes(text, size) if text else np.zeros(0, np.uint64)
                    at = hashes >> lead
                    hit = hashes[(table[at >> six] >> (at & low)) & one != 0]
                    docs += [doc] * len(hit)
                    sizes += [size] * len(hit)
                    found.append(hit)
            hits = np.concatenate([np.zeros(0, np.uint64), *found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(sizes, pa.int32()), pa.array(hits.view(np.int64))],
                names=["doc_id", "words", "hash"],
            )

    return run


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, last, known = [], None, {}
            for doc, item, n, text, item_text in zip(
                *(batch.column(i).to_pylist() for i in range(3)),
                *(batch.column(i).cast(pa.binary()).to_pylist() for i in (3, 4)),
                strict=True,
            ):
                if text is not last:
                    known = {} if text != last else known
                    last = text
                if n not in known:
                    known[n] = _exact(text, n)
                wanted = _exact(item_text, n)
                shared = len(wanted & known[n])
                if shared >= threshold * len(wanted) - 1e-9:
                    rows.append((doc, item, len(wanted), shared))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns],
                names=["doc_id", "item_id", "item_shingles", "shared"],
            )

    return run


def _exact(data: bytes, size: int) -> set[bytes]:
    found, held = set(), []
    for words in word_chunks(data):
        held += words
        found.update(map(b" ".join, zip(*(held[i:] for i in range(size)), strict=False)))
        held = held[max(0, len(held) - size + 1) :]
    return found


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Rows ``doc_id``, ``item_id``, ``item_shingles``, ``shared``, ``containment``.

    One row for each document and item it contains; a search, so every document is
    held against every item. Texts are lower-cased in A-Z and cut at white space.
    An item of fewer than ``size`` words is one shingle of all its words, looked
    up among the documents' shingles of that many words. Null, blank and
    wordless items and documents match nothing; documents and items without an id
    are left out, as no row could name them. Repeated rows of a document (same
    id, same text) give one row; texts that share an id are judged each and give
    the row of the best. Empty tables give an empty result. Texts are
    read whole, however long, and other columns are not read, whatever they are called.
    """
    known = written(item_shingles(items, item_id_col, item_text_col, size), "items").table
    most = known.agg(F.max("count")).first()[0] or 1
    bound, length = F.lit(None).cast("int"), F.lit(None).cast("int")
    for upper in reversed(size_bounds(most)):
        bound = F.when(F.col("count") <= upper, F.lit(upper)).otherwise(bound)
        length = F.when(F.col("count") <= upper, F.lit(sketch_length(upper, threshold))).otherwise(length)
    # Hashes are kept as signed longs; their order as such is as random as any.
    sketches = written(
        known.select(
            "item_id",
            "words",
            bound.alias("bound"),
            F.explode(F.slice(F.array_sort("hashes"), F.lit(1), length)).alias("hash"),
        ),
        "sketches",
    ).table
    table, lengths = _filter(sketches)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    shared = docs.sparkSession.sparkContext.broadcast(table)  # of fixed size

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _probe(shared.value, lengths)(batches)

    hits = texts.mapInArrow(probe, "doc_id long, words int, hash long")
    candidates = written(
        hits.join(sketches, ["words", "hash"]).select("doc_id", "item_id", "words").distinct(), "candidates"
    ).table
    item_texts = items.select(
        F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("item_text")
    )
    pairs = (
        texts.join(candidates, "doc_id")
        .join(item_texts, "item_id")
        .select("doc_id", "item_id", "words", "text", "item_text")
    )
    verified = pairs.mapInArrow(
        _verify(threshold), "doc_id long, item_id long, item_shingles long, shared long"
    )
    best = verified.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("shared", "item_shingles")).alias("at")
    )
    return best.select(
        "doc_id",
        "item_id",
        F.col("at.item_shingles").alias("item_shingles"),
        F.col("at.shared").alias("shared"),
        (F.col("at.shared") / F.col("at.item_shingles")).alias("containment"),
    )
