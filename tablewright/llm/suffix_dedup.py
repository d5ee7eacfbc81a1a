"""Removal of repeated passages by suffix arrays.

A passage is repeated if a string of ``LENGTH`` bytes in it also starts elsewhere.
Texts are brought together by content: every window of ``LENGTH`` bytes is assigned
to one of the short strings in it, the one whose hash is least, so equal windows
have equal short strings. Short strings that occur once cannot lie in a repeated
window and drop out; the stretches of text around the others are dealt to shards by
the short string. Each shard sorts the suffixes of its stretches with
Larsson-Sadakane refinement, and Kasai's common prefixes tell which windows are
repeated. A short string with too many occurrences for one shard is spread over
several; these are merged by binary search among the digests of their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import written

#: Bytes of a window, and of the short strings it is assigned by.
LENGTH = 200
SHORT = 32
#: Windows that one stretch holds at most; only texts that repeat themselves have longer runs.
RUN_WINDOWS = 4096
#: Occurrences of one short string that a shard takes.
SHARD_STRETCHES = 4000
#: Bytes of different stretches that are sorted at a time (a shard more at most), bytes
#: of stretches passed on at a time, and bytes of texts that are hashed at a time.
SORT_BYTES, PASS_BYTES = 512 << 10, 4 << 20
HASH_BITS = 17
#: Low bits of the hash that index the filter of short strings that repeat: a fixed
#: sixteen megabytes (the high ones are small in every least hash). A fuller filter lets strings through that occur once; none is held back.
FILTER_BITS = 27
#: Bits that a position among the sorted bytes fits in, so that two ranks and a position
#: are one number; longer inputs are sorted through an index.
PLACE_BITS = 21

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << HASH_BITS) - 1)


def _pieces(sizes: np.ndarray) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """Documents and their parts that are hashed together: document, first and last byte.

    A long document comes in parts that overlap by all but one byte of a window.
    """
    docs, first, last, held, room = [], [], [], 0, 1 << HASH_BITS
    for doc, size in enumerate(sizes.tolist()):
        at = 0
        while size - at >= LENGTH:
            take = min(size - at, room)
            if held + take > room:
                yield docs, first, last
                docs, first, last, held = [], [], [], 0
            docs.append(doc)
            first.append(at)
            last.append(at + take)
            held += take
            if at + take == size:
                break
            at += take - LENGTH + 1
    if docs:
        yield docs, first, last


def short_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``SHORT`` bytes from every position on."""
    hashes, power, step = data.astype(np.uint64) + np.uint64(1), int(_MULTIPLIER), 1
    while step < SHORT:
        hashes = hashes[:-step] * np.uint64(power) + hashes[step:]
        power, step = power * power % (1 << 64), 2 * step
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIXER
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _assign(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one short string, of texts laid end to end at ``bounds``.

    A text that repeats itself may hold the string at several places of one run, which
    stays a run then (in pieces, if it is long). Returns the text, the first and last
    window start in it, the string's hash, and whether it has several places there.
    """
    hashes = short_hashes(data)
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    reach, span = 1, LENGTH - SHORT + 1
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    chosen = (least & _PLACE).astype(np.int64)
    starts, ends = bounds[:-1], bounds[1:] - LENGTH + 1
    valid = np.zeros(len(chosen) + 1, np.int8)
    np.add.at(valid, starts, 1)
    np.add.at(valid, ends, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    short = hashes[chosen]
    change, moved = np.empty(len(chosen), bool), np.zeros(len(chosen), np.int64)
    change[0] = True
    np.not_equal(short[1:], short[:-1], out=change[1:])
    change[starts] = True
    np.cumsum(chosen[1:] != chosen[:-1], out=moved[1:])

    def bounded(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = np.searchsorted(starts, first, "right") - 1
        return text, np.minimum(np.append(first[1:], len(chosen)), ends[text]) - 1

    first = np.flatnonzero(change & valid)
    text, last = bounded(first)
    long = last - first >= RUN_WINDOWS
    if long.any():
        pieces = [np.arange(a, b + 1, RUN_WINDOWS) for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True)]
        first = np.sort(np.concatenate([first[~long], *pieces]))
        text, last = bounded(first)
    return text, first - starts[text], last - starts[text], short[first], moved[last] > moved[first]


def _runs_of(batch: pa.RecordBatch, column: int) -> Iterator[tuple[list[bytes], np.ndarray, ...]]:
    """The texts of a batch, and of each run of windows the text, first and last start, hash, several places."""
    texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
    for docs, first, last in _pieces(np.array([len(t) for t in texts], np.int64)):
        joined = b"".join(texts[d][a:b] for d, a, b in zip(docs, first, last, strict=True))
        sizes = np.array(last) - np.array(first)
        text, low, high, hashes, several = _assign(
            np.frombuffer(joined, np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        )
        base = np.array(first)[text]
        yield texts, np.array(docs)[text], low + base, high + base, hashes, several


def _short_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for *_, hashes, several in _runs_of(batch, 0):
            # A string with several places in one run occurs twice there already.
            found = np.repeat(hashes, 1 + several)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["short"])


def _filter(shorts: DataFrame) -> np.ndarray:
    """One bit for each ending of ``FILTER_BITS`` bits that a listed hash has."""
    place = F.col("short").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("bit_or(shiftleft(1L, cast(short & 63 as int)))")
    rows = shorts.groupBy(F.shiftright(place, 6).alias("word")).agg(bit.alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[rows.column(0).to_numpy()] = rows.column(1).to_numpy()  # 2**21 rows at most
    return table.view(np.uint64)


def _stretches(table):
    names = ["short", "stretch", "id_key", "text_key", "low", "several"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            ids, keys, rows, held = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], 0
            for texts, of, low, high, hashes, several in _runs_of(batch, 2):
                at = hashes & np.uint64((1 << FILTER_BITS) - 1)
                again = (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
                found = (x[again].tolist() for x in (of, low, high, hashes.view(np.int64), several))
                for i, a, b, short, more in zip(*found, strict=True):
                    rows.append((short, texts[i][a : b + LENGTH], ids[i], keys[i], a, more))
                    held += b + LENGTH - a
                if held >= PASS_BYTES:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    return run


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number in their order."""
    words, bits, step = data.astype(np.uint64), 8, 1
    while step < 8:
        words = (words[:-step] << np.uint64(bits)) | words[step:]
        bits, step = 2 * bits, 2 * step
    return words


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: where each one's group begins, and whether it has company."""
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    begins = np.flatnonzero(new)
    company = np.repeat(np.diff(np.append(begins, len(keys))) > 1, np.diff(np.append(begins, len(keys))))
    return np.repeat(begins, np.diff(np.append(begins, len(keys)))), company


def _sorted(keys: np.ndarray, among: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and what is ``among`` them, each a number of ``PLACE_BITS`` bits.

    A key of ``bits`` bits and its place in one number sort several times faster than
    through an index.
    """
    if bits + PLACE_BITS > 64 or len(keys) > 1 << PLACE_BITS:
        order = np.argsort(keys)
        return keys[order], among[order]
    packed = np.sort((keys << np.uint64(PLACE_BITS)) | np.arange(len(keys), dtype=np.uint64))
    order = (packed & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    return packed >> np.uint64(PLACE_BITS), among[order]


def sort_windows(words: np.ndarray, is_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts by the ``LENGTH`` bytes from there, by Larsson-Sadakane refinement.

    Suffixes are sorted by five bytes, and groups of equal ones again and again by
    the ranks of what follows, which doubles the depth; sorted groups are left
    alone. The last step reaches just ``LENGTH`` and takes window starts only. Also
    gives which of the starts, in order, share all ``LENGTH`` bytes with another.
    """
    size = len(is_start)
    rank_bits = max(1, int(size + LENGTH).bit_length())
    keys, order = _sorted(words[:size] >> np.uint64(24), np.arange(size), 40)
    begins, company = _groups(keys)
    rank = np.zeros(size + LENGTH, np.uint64)
    rank[order] = begins
    slots = np.flatnonzero(company)
    depth = 5
    while depth < LENGTH and len(slots):
        offset = min(depth, LENGTH - depth)
        among = order[slots]
        if depth + offset == LENGTH:
            # Only starts count now; within a group they take the first slots.
            wanted = is_start[among]
            groups = rank[among]
            among = np.concatenate([among[wanted], among[~wanted]])
            by_group = np.argsort(np.concatenate([groups[wanted], groups[~wanted]]), kind="stable")
            order[slots] = among[by_group]
            chosen = by_group < int(wanted.sum())
            slots, among = slots[chosen], among[by_group][chosen]
        keys = (rank[among] << np.uint64(rank_bits)) | rank[among + offset]
        keys, among = _sorted(keys, among, 2 * rank_bits)
        order[slots] = among
        begins, company = _groups(keys)
        rank[among] = slots[begins]
        slots = slots[company]
        depth += offset
    alike = np.zeros(size, bool)
    alike[slots] = True
    at = np.flatnonzero(is_start[order])
    return order[at], alike[at]


def common_prefixes(words: np.ndarray, starts: np.ndarray, counts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every window start, the bytes it shares with its predecessor in ``order``, by Kasai.

    Stretch i has ``counts[i]`` window starts from ``starts[i]`` on. All stretches are
    walked in step: from one start to the next a common prefix loses one byte at most,
    if the predecessor's next window is there and still sorts before. Prefixes are
    followed up to ``LENGTH``.
    """
    size = int(starts[-1] + counts[-1]) + LENGTH if len(starts) else 0
    slot = np.full(size + 1, -1, np.int64)
    slot[order] = np.arange(len(order))
    before = np.full(size + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(size + 1, np.int64)
    by_count = np.argsort(-counts, kind="stable")
    starts, counts = starts[by_count], counts[by_count]
    known = np.zeros(len(starts), np.int64)
    for step in range(int(counts[0]) if len(counts) else 0):
        active = int(np.searchsorted(-counts, -step, "left"))
        at, known = starts[:active] + step, known[:active]
        other = before[at]
        if step:
            last = before[at - 1]
            holds = (last >= 0) & (slot[last + 1] >= 0) & (slot[last + 1] < slot[at])
            known = np.where(holds, np.maximum(known - 1, 0), 0)
        open_ = np.flatnonzero((other >= 0) & (known < LENGTH))
        while len(open_):
            differ = words[at[open_] + known[open_]] ^ words[other[open_] + known[open_]]
            bytes_ = differ.astype(">u8").view(np.uint8).reshape(-1, 8) != 0
            same = np.where(differ == 0, 8, bytes_.argmax(axis=1))
            known[open_] += same
            open_ = open_[(same == 8) & (known[open_] < LENGTH)]
        known = np.where(other >= 0, np.minimum(known, LENGTH), 0)
        shared[at] = known
    return shared[order]


def repeated_windows(
    stretches: list[bytes], shorts: list[int], several: list[bool] | None = None
) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different stretches' number for each, and which of their windows occur twice among all.

    Equal stretches speak for each other. Suffixes are sorted where a stretch stands
    alone beside others of its short string, or holds it at several places.
    """
    known: dict[bytes, int] = {}
    of = np.array([known.setdefault(s, len(known)) for s in stretches])
    times = np.bincount(of, minlength=len(known))
    short = np.zeros(len(known), np.int64)
    short[of] = shorts
    _, group = np.unique(short, return_inverse=True)
    alone = np.bincount(group, times == 1)
    itself = np.zeros(len(known), bool)
    itself[of] = False if several is None else several
    open_ = np.flatnonzero((alone > 0)[group] & (np.bincount(group) > 1)[group] | itself & (times == 1))
    masks = [np.full(len(s) - LENGTH + 1, t > 1) for s, t in zip(known, times.tolist(), strict=True)]
    if len(open_):
        texts = list(known)
        found = _sorted_out([texts[i] for i in open_])
        for i, mask in zip(open_.tolist(), found, strict=True):
            if times[i] == 1:
                masks[i] = mask
    return of, masks


def _sorted_out(stretches: list[bytes]) -> list[np.ndarray]:
    """:func:`repeated_windows` of different stretches, by their suffix array."""
    joined = b"\0".join(stretches) + bytes(LENGTH + 8)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(s) for s in stretches])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    counts = sizes - LENGTH + 1
    steps = np.zeros(len(data) - LENGTH - 8 + 1, np.int8)
    steps[starts] += 1
    steps[starts + counts] -= 1
    is_start = np.cumsum(steps[:-1], dtype=np.int8) > 0
    words = _words(data)
    order, alike = sort_windows(words, is_start)
    twice = np.zeros(len(is_start), bool)
    # Prefixes are followed in the stretches that have a window like another.
    candidate = np.zeros(len(is_start), np.int64)
    candidate[order[alike]] = 1
    wanted = np.add.reduceat(np.append(candidate, 0), starts) > 0
    if wanted.any():
        kept_steps = np.zeros(len(is_start) + 1, np.int8)
        kept_steps[starts[wanted]] += 1
        kept_steps[starts[wanted] + counts[wanted]] -= 1
        kept = np.cumsum(kept_steps[:-1], dtype=np.int8) > 0
        order = order[kept[order]]
        shared = common_prefixes(words, starts[wanted], counts[wanted], order)
        at = np.flatnonzero(shared >= LENGTH)
        twice[order[at]] = True
        twice[order[at - 1]] = True
    return [twice[s : s + c] for s, c in zip(starts.tolist(), counts.tolist(), strict=True)]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted stretches in; repeated runs out, and digests of windows for spread strings."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["id_key", "text_key", "first", "last", "of_shard", "digest"]

    def resolve(rows: dict[str, list]) -> pa.RecordBatch:
        out: list[tuple] = []
        told: set[tuple[int, int, bytes]] = set()
        whole: set[tuple[int, int, int]] = set()  # stretches all of whose windows are told
        of, masks = repeated_windows(rows["stretch"], rows["short"], rows["several"])
        spans = [
            [(0, len(m))] if m.all() else list(zip(*(x.tolist() for x in _runs(m)), strict=True)) for m in masks
        ]
        for i, number in enumerate(of.tolist()):
            key, low = (rows["id_key"][i], rows["text_key"][i]), rows["low"][i]
            for a, b in spans[number]:
                out.append((*key, low + a, low + b - 1 + LENGTH, None, None))
            if rows["part"][i] < 0 or (rows["short"][i], rows["part"][i], number) in whole:
                continue
            if masks[number].all():
                whole.add((rows["short"][i], rows["part"][i], number))
            # One digest for every distinct window of this shard; where it stands if it is single.
            data = rows["stretch"][i]
            for start, again in enumerate(masks[number].tolist()):
                digest = hashlib.blake2b(data[start : start + LENGTH], digest_size=16).digest()
                if again:
                    if (rows["short"][i], rows["part"][i], digest) in told:
                        continue
                    told.add((rows["short"][i], rows["part"][i], digest))
                at = None if again else low + start
                out.append((*key, at, None, rows["part"][i], digest))
        columns = list(zip(*out, strict=True)) or [[] for _ in kinds]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    fields = ["short", "part", "stretch", "id_key", "text_key", "low", "several"]
    held: dict[str, list] = {f: [] for f in fields}
    known: set[bytes] = set()
    size = 0
    for batch in batches:
        new = {f: batch.column(i).to_pylist() for i, f in enumerate(fields)}
        begin = 0
        for i, stretch in enumerate(new["stretch"]):
            shard = (new["short"][i], new["part"][i])
            before = (new["short"][i - 1], new["part"][i - 1]) if i else held["short"] and (held["short"][-1], held["part"][-1])
            if size >= SORT_BYTES and shard != before:
                yield resolve({f: held[f] + new[f][begin:i] for f in fields})
                held, known, size, begin = {f: [] for f in fields}, set(), 0, i
            if stretch not in known:
                known.add(stretch)
                size += len(stretch)
        held = {f: held[f] + new[f][begin:] for f in fields}
    if held["short"]:
        yield resolve(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests in order, from several shards: those found more than once by binary search."""
    held = [np.zeros(0, "S16"), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        digests, ids, keys, at = columns
        times = np.searchsorted(digests, digests, "right") - np.searchsorted(digests, digests, "left")
        found = (times > 1) & (at >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (ids[found], keys[found], at[found], at[found] + LENGTH)],
            names=["id_key", "text_key", "first", "last"],
        )

    for batch in batches:
        new = [np.array([d.hex() for d in batch.column(0).to_pylist()], "S32")]
        new += [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3)]
        held = [np.concatenate([a.astype(b.dtype) if not len(a) else a, b]) for a, b in zip(held, new, strict=True)]
        if len(held[0]):
            last = int(np.searchsorted(held[0], held[0][-1], "left"))
            yield out([x[:last] for x in held])
            held = [x[last:] for x in held]
    if len(held[0]):
        yield out(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        texts, runs = batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()
        rows = []
        for text, of_text in zip(texts, runs, strict=True):
            data, kept, at, spans, end = text or b"", [], 0, 0, -1
            for run in sorted((r["first"], r["last"]) for r in of_text or ()):
                if run[0] > end:  # runs that touch are one
                    kept.append(data[at : run[0]])
                    spans += 1
                at = end = max(end, run[1])
            kept.append(data[at:])
            rest = b"".join(kept)
            rows.append((rest, len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]],
            names=names,
        )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_stretches: int = SHARD_STRETCHES
) -> DataFrame:
    """Rows ``doc_id``, ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
    else, in the same document too, is removed; ``n_spans`` counts the maximal runs of
    them. Strings are judged on the input and do not cross documents. ``kept`` may
    break a character in two and so is binary. A null text is an empty one; texts
    shorter than a window stay whole; repeated rows are documents of their own and so
    remove each other; rows without an id are treated like others. An empty table
    gives an empty result. Texts are read whole, however long, in parts that overlap;
    other columns are not read, whatever they are called.

    Nothing is sampled or capped: strings with many occurrences are spread over
    shards by document and merged by the digests of their windows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        F.coalesce("doc_id", F.lit(0)).alias("id_key"), F.xxhash64("text").alias("text_key"), "text", "doc_id"
    )
    long_enough = keyed.where(F.octet_length("text") >= LENGTH)
    shorts = long_enough.select("text").mapInArrow(_short_strings, "short long")
    again = shorts.groupBy("short").agg(F.count("*").alias("times")).where("times > 1")
    again = written(again, "short").table
    table = docs.sparkSession.sparkContext.broadcast(_filter(again))  # of fixed size
    stretches = long_enough.select("id_key", "text_key", "text").mapInArrow(
        _stretches(table), "short long, stretch binary, id_key long, text_key long, low long, several boolean"
    )
    # Strings for more than one shard; written, so that Spark knows how few they are.
    crowded = written(again.where(F.col("times") > shard_stretches).withColumnRenamed("short", "crowd"), "crowded").table
    parts = F.ceil(F.col("times") / shard_stretches)
    part = F.when(F.col("crowd").isNull(), -1).otherwise(F.pmod(F.xxhash64("id_key", "text_key"), parts))
    stretches = stretches.join(crowded, F.col("short") == F.col("crowd"), "left").select(
        "short", part.cast("int").alias("part"), "stretch", "id_key", "text_key", "low", "several"
    )
    found = (
        stretches.repartition("short", "part")
        .sortWithinPartitions("short", "part")
        .mapInArrow(_shards, "id_key long, text_key long, first long, last long, of_shard long, digest binary")
    )
    found = written(found, "found").table
    within = found.where("digest is null").select("id_key", "text_key", "first", "last")
    digests = found.where("digest is not null").select(
        "digest", "id_key", "text_key", F.coalesce("first", F.lit(-1)).alias("first")
    )
    across = (
        digests.repartition("digest")
        .sortWithinPartitions("digest")
        .mapInArrow(_merge, "id_key long, text_key long, first long, last long")
    )
    runs = (
        within.unionByName(across)
        .groupBy("id_key", "text_key")
        .agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    )
    cut = keyed.join(runs, ["id_key", "text_key"], "left").select("doc_id", "text", "runs")
    return cut.mapInArrow(
        _cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
