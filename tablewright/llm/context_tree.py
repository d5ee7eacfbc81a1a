"""Language model scores by context-tree weighting, beside a unigram base.

A byte is eight binary decisions, each a node of a binary tree. Every node has its
own context tree over the last ``DEPTH`` bytes, with a Krichevsky-Trofimov
estimator at each context; a context's weighted probability is the mean of its own
estimate and the product of its children's. A byte is then predicted by the mixture
over all depths that these weights make, with the counts of the training texts.

Training counts strings of ``DEPTH + 1`` bytes. All deeper contexts of two bytes
meet in one group, whose size is bounded by the alphabet, and the two levels above
are summed from the groups. The common strings and words are sent to all tasks, up
to a fixed number; what is rarer is joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import word_chunks, written

#: Bytes of context.
DEPTH = 5
#: Strings, and words, that are sent to all tasks at most: 16 bytes each.
COMMON_STRINGS, COMMON_WORDS = 1 << 21, 1 << 20
#: Bytes of text whose strings are counted at a time, and strings weighted at a time.
COUNT_BYTES, WEIGHT_ROWS = 4 << 20, 1 << 19
#: Bytes of texts, of one or of many documents, whose strings are looked up at a time.
SCORE_BYTES = 1 << 20

# Fixed values of the base score and of the held-out part.
BASE_PRIOR = 0.1
FOLDS = 10

WORD, STRING = 0, 1
_HALF = np.log(0.5)


def strings(data: bytes) -> np.ndarray:
    """Each byte with the ``DEPTH`` bytes before it, zeros before the first, as one number."""
    row = np.frombuffer(bytes(DEPTH) + data, np.uint8).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for i in range(DEPTH + 1):
        out = (out << np.uint64(8)) | row[i : i + len(data)]
    return out


def _parts(data: bytes) -> Iterator[np.ndarray]:
    for at in range(0, len(data), COUNT_BYTES):
        head = max(0, at - DEPTH)
        yield strings(data[head : at + COUNT_BYTES])[at - head :]


def _word_hashes(words: Counter[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(0)), np.uint64, len(words))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and strings with their training counts; strings of held-out texts with none."""

    def out(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(keys), kind, np.int8)),
                pa.array(keys.view(np.int64)),
                pa.array(counts.astype(np.int64)),
            ],
            names=["kind", "key", "n"],
        )

    def flush(parts: list[np.ndarray], train: bool) -> Iterator[pa.RecordBatch]:
        if parts:
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield out(STRING, keys, counts if train else np.zeros(len(keys)))

    for batch in batches:
        texts, held = batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()
        words: Counter[bytes] = Counter()
        parts: dict[bool, list[np.ndarray]] = {True: [], False: []}
        sizes = {True: 0, False: 0}
        for i, held_out in enumerate(held):
            data, train = texts[i].as_py() or b"", not held_out
            if train:
                for chunk in word_chunks(data):
                    words.update(chunk)
            for part in _parts(data):
                parts[train].append(part)
                sizes[train] += len(part)
                if sizes[train] >= COUNT_BYTES:
                    yield from flush(parts[train], train)
                    parts[train], sizes[train] = [], 0
            if len(words) > WEIGHT_ROWS:
                yield out(WORD, _word_hashes(words), np.fromiter(words.values(), np.int64))
                words = Counter()
        for train in (True, False):
            yield from flush(parts[train], train)
        if words:
            yield out(WORD, _word_hashes(words), np.fromiter(words.values(), np.int64))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers, by Stirling's series from x + 8 on."""
    y = x + 8
    z = 1 / (y * y)
    # The series' first six terms.
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z * (1 / 1188 - z * 691 / 360360))))) / y
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


class _Level:
    """Contexts of one depth and node: counts, own estimate, weighted probability."""

    def __init__(self, keys: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None):
        self.keys, self.a, self.b = keys, a, b
        own = log_kt(a, b)
        self.weighted = own if below is None else np.logaddexp(_HALF + own, _HALF + below)
        #: How much of the mixture stops here, and what it says then.
        self.stop = np.ones_like(own) if below is None else np.exp(_HALF + own - self.weighted)
        self.one = (b + 0.5) / (a + b + 1)


def _levels(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[_Level], list[np.ndarray]]:
    """Levels from ``DEPTH`` to 2, the level's row of each string's decisions, of each row's parent.

    ``keys`` must hold every string whose last two context bytes are among them.
    """
    byte = (keys & np.uint64(255)).astype(np.int64)
    context = np.zeros(len(keys), np.int64)  # the nearest byte first
    for i in range(1, DEPTH + 1):
        context = (context << 8) | ((keys >> np.uint64(8 * i)) & np.uint64(255)).astype(np.int64)
    steps = np.arange(8)
    nodes = (1 << steps) | (byte[:, None] >> (8 - steps))
    bits = (byte[:, None] >> (7 - steps)) & 1
    rows, of = np.unique((context[:, None] << 8 | nodes).ravel(), return_inverse=True)
    weight = np.repeat(n.astype(float), 8)
    ones = np.bincount(of, weight * bits.ravel(), len(rows))
    levels = [_Level(rows, np.bincount(of, weight, len(rows)) - ones, ones, None)]
    parents = []
    for _ in range(DEPTH - 2):
        last = levels[-1]
        rows, parent = np.unique(((last.keys >> 16) << 8) | (last.keys & 255), return_inverse=True)
        sums = [np.bincount(parent, x, len(rows)) for x in (last.a, last.b, last.weighted)]
        levels.append(_Level(rows, *sums))
        parents.append(parent)
    return of.reshape(-1, 8), bits, levels, parents


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings and counts in lots that do not break a group of two context bytes."""
    keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        n = np.concatenate([n, batch.column(2).to_numpy(zero_copy_only=False)])
        if len(keys) >= WEIGHT_ROWS:
            pair = (keys >> np.uint64(8)) & np.uint64(0xFFFF)
            others = np.flatnonzero(pair != pair[-1])
            if len(others):
                cut = int(others[-1]) + 1
                yield keys[:cut], n[:cut]
                keys, n = keys[cut:], n[cut:]
    if len(keys):
        yield keys, n


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, n in _grouped(batches):
        top = _levels(keys, n)[2][-1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(top.keys >> 16),
                pa.array(top.keys & 255),
                pa.array(top.a),
                pa.array(top.b),
                pa.array(top.weighted),
            ],
            names=["near", "node", "a", "b", "weighted"],
        )


def _roots(groups: DataFrame) -> tuple[np.ndarray, ...]:
    """Stop and prediction of the levels of no and of one byte, as tables by byte and node.

    65,536 rows at most come to the driver.
    """
    sums = groups.groupBy("near", "node").agg(*[F.sum(c).alias(c) for c in ("a", "b", "weighted")])
    a, b, below = (np.zeros((256, 256)) for _ in range(3))
    for r in sums.collect():
        at = r["near"], r["node"]
        a[at], b[at], below[at] = r["a"], r["b"], r["weighted"]
    one = _Level(np.zeros(0), a, b, below)
    none = _Level(np.zeros(0), a.sum(axis=0), b.sum(axis=0), one.weighted.sum(axis=0))
    return none.stop, none.one, one.stop, one.one


def _predict(roots: tuple[np.ndarray, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop_none, one_none, stop_one, one_one = roots
        for keys, n in _grouped(batches):
            of, bits, levels, parents = _levels(keys, n)
            said = levels[0].one
            at = np.arange(len(said))
            for level, parent in zip(levels[1:], parents, strict=True):
                at = parent[at]
                said = level.stop[at] * level.one[at] + (1 - level.stop[at]) * said
            # Up to here a context's own row; now by its nearest byte and node.
            near, node = levels[0].keys >> (8 * DEPTH), levels[0].keys & 255
            said = stop_one[near, node] * one_one[near, node] + (1 - stop_one[near, node]) * said
            said = stop_none[node] * one_none[node] + (1 - stop_none[node]) * said
            of_bits = np.where(bits == 1, said[of], 1 - said[of])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(n), pa.array(np.log10(of_bits).sum(axis=1))],
                names=["key", "n", "value"],
            )

    return run


def predictions(counted: DataFrame) -> DataFrame:
    """Rows ``key``, ``n``, ``value`` (log10 of the last byte's probability) of all counted strings."""
    pair = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    grouped = counted.select(pair.alias("pair"), "key", "n").repartition("pair").sortWithinPartitions("pair")
    tops = grouped.mapInArrow(_tops, "near long, node long, a double, b double, weighted double")
    return grouped.mapInArrow(_predict(_roots(tops)), "key long, n long, value double")


def _common(table: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys (ascending) and values of the rows counted ``least`` times or more, and ``least``.

    ``least`` is the smallest power of two, or zero, that leaves ``most`` rows at most.
    """
    ladder = [0] + [1 << i for i in range(50)]
    found = table.agg(*[F.count(F.when(F.col("n") >= step, 1)) for step in ladder]).first()
    least = next(step for step, rows in zip(ladder, found, strict=True) if rows <= most)
    rows = table.where(F.col("n") >= least).select("key", "value").toArrow()
    keys = rows.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows.column(1).to_numpy()[order], least


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys, and which of them are there."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


def _add_strings(
    waiting: list[tuple[int, np.ndarray]], keys: np.ndarray, values: np.ndarray, scores: np.ndarray, rests: list[list[tuple]]
) -> None:
    """Add the values of some texts' strings to their rows' scores, and what is not there to their rests.

    The texts' strings are made distinct together, so one that many documents share is
    looked up once.
    """
    if not waiting:
        return
    of = np.repeat([i for i, _ in waiting], [len(part) for _, part in waiting])
    found, at = np.unique(np.concatenate([part for _, part in waiting]), return_inverse=True)
    value, here = _look_up(keys, values, found)
    scores += np.bincount(of, np.where(here, value, 0.0)[at], len(scores))
    if not here.all():
        missing = ~here[at]
        pairs, times = np.unique(of[missing] * len(found) + at[missing], return_counts=True)
        rows, strings_of = pairs // len(found), found[pairs % len(found)]
        firsts = np.append(np.flatnonzero(np.diff(rows, prepend=-1)), len(rows))
        for first, last in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            rests[rows[first]].append((STRING, strings_of[first:last], times[first:last]))


def _score(words: tuple, tree: tuple):
    """A row for each text: sums over its common words and strings, and what is left to join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (word_keys, word_counts), (keys, values) = words.value, tree.value
        row = TaskContext.get().partitionId() << 40  # written with the row, so it stays its name
        names = ["row", "doc_id", "held_out", "n_bytes", "tokens", "known", "base", "score", "rest"]
        rest_kind = pa.struct([("kind", pa.int8()), ("key", pa.int64()), ("times", pa.int64())])
        kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
        for batch in batches:
            texts, rows = batch.column(2).cast(pa.binary()), []
            rests: list[list[tuple]] = [[] for _ in range(batch.num_rows)]
            scores, waiting, size = np.zeros(batch.num_rows), [], 0
            for i in range(batch.num_rows):
                data = texts[i].as_py() or b""
                counted: Counter[bytes] = Counter()
                for chunk in word_chunks(data):
                    counted.update(chunk)
                hashes, times = _word_hashes(counted), np.fromiter(counted.values(), np.int64, len(counted))
                count, there = _look_up(word_keys, word_counts, hashes)
                base = float(np.log10(count[there] + BASE_PRIOR) @ times[there])
                rests[i].append((WORD, hashes[~there], times[~there]))
                for part in _parts(data):
                    waiting.append((i, part))
                    size += len(part)
                    if size >= SCORE_BYTES:
                        _add_strings(waiting, keys, values, scores, rests)
                        waiting, size = [], 0
                rows.append([row, None, None, len(data), int(times.sum()), int(times[there].sum()), base, 0.0])
                row += 1
            _add_strings(waiting, keys, values, scores, rests)
            for r, score in zip(rows, scores.tolist(), strict=True):
                r[-1] = score
            bounds = np.append(0, np.cumsum([sum(len(x) for _, x, _ in of_row) for of_row in rests]))
            rests = [r for of_row in rests for r in of_row if len(r[1])]
            columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in kinds]
            flat = [
                np.concatenate([np.zeros(0, np.int8), *[np.full(len(x), k, np.int8) for k, x, _ in rests]]),
                np.concatenate([np.zeros(0, np.uint64), *[x for _, x, _ in rests]]).view(np.int64),
                np.concatenate([np.zeros(0, np.int64), *[t for _, _, t in rests]]),
            ]
            rest = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()),
                pa.StructArray.from_arrays([pa.array(f) for f in flat], fields=list(rest_kind)),
            )
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            arrays[1:3] = [batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays([*arrays, rest], names=names)

    return run


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    common_strings: int = COMMON_STRINGS,
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """Rows ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``, ``n_bytes``, ``bits_per_byte``; one for every document.

    Documents are held out where the CRC-32 of their id, as text, is divisible by
    ten; the others train both models. ``score`` is the context tree's log10
    probability of the text's bytes, ``bits_per_byte`` its code length over their
    number (null if there are none). ``base_score`` is a unigram's over lower-cased
    words and one end. A null text is an empty one: one token, a score of zero. A row
    without an id is held out. Repeated rows count and are scored each. With nothing
    to train on every bit is even. An empty table gives an empty result.
    Texts are read whole, however long, and other
    columns are not read, whatever they are called.

    Counts cover all training texts. How many strings and words are common enough to
    be sent to the tasks changes where a value comes from, never what it is.
    """
    crc = F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (crc % FOLDS == 0).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    counted = keyed.select("text", "held_out").mapInArrow(_counts, "kind tinyint, key long, n long")
    counted = written(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts").table
    train_docs = keyed.where(~F.col("held_out")).count()
    word_counts = counted.where(F.col("kind") == WORD).select("key", "n", F.col("n").cast("double").alias("value"))
    tokens, distinct = word_counts.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = (tokens or 0) + train_docs, distinct + (train_docs > 0)
    tree = written(predictions(counted.where(F.col("kind") == STRING)), "tree").table

    context = docs.sparkSession.sparkContext
    *words, _ = _common(word_counts, common_words)
    *nodes, _ = _common(tree, common_strings)
    scored = keyed.mapInArrow(
        _score(context.broadcast(tuple(words)), context.broadcast(tuple(nodes))),
        "row long, doc_id long, held_out boolean, n_bytes long, tokens long, known long, base double, "
        "score double, rest array<struct<kind:tinyint,key:bigint,times:bigint>>",
    )
    scored = written(scored, "scored").table
    rest = scored.select("row", F.explode("rest").alias("r")).select("row", "r.kind", "r.key", "r.times")
    known = word_counts.select(F.lit(WORD).cast("tinyint").alias("kind"), "key", "value").unionByName(
        tree.select(F.lit(STRING).cast("tinyint").alias("kind"), "key", "value")
    )
    joined = rest.join(known, ["kind", "key"], "left")
    is_word = F.col("kind") == WORD
    count = F.coalesce("value", F.lit(0.0))
    late = joined.groupBy("row").agg(
        F.sum(F.when(is_word & (count > 0), F.col("times")).otherwise(0)).alias("late_known"),
        F.sum(F.when(is_word, F.col("times") * F.log10(count + BASE_PRIOR)).otherwise(0.0)).alias("late_base"),
        F.sum(F.when(~is_word, F.col("times") * F.col("value")).otherwise(0.0)).alias("late_score"),
    )
    whole = float(np.log10(tokens + BASE_PRIOR * (distinct + 1)))
    end = float(np.log10(train_docs + BASE_PRIOR))
    n_tokens = F.col("tokens") + 1
    score = F.col("score") + F.coalesce("late_score", F.lit(0.0))
    return scored.drop("rest").join(late, "row", "left").select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("late_known", F.lit(0)) + F.lit(int(train_docs > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("late_base", F.lit(0.0)) + F.lit(end) - n_tokens * F.lit(whole)).alias("base_score"),
        score.alias("score"),
        "n_bytes",
        F.when(F.col("n_bytes") > 0, -score / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
