"""Exact top-k search by BM25 with block-max WAND pruning.

The rows searched are cut into shards, each an inverted index written as one row.
In a shard, documents that share frequent words stand in groups, and in blocks of
``BLOCK`` of about the same length; a group has a table of what its frequent terms
contribute to its documents, and the highest contribution in each block. Queries are
asked many together: the lists of their rare terms, which are short, are added up for
all documents, and with the blocks' maxima bound the scores of each block. Blocks whose
bound does not reach the k-th best score so far are left; a group of which many blocks
are open gets its documents' sums from its table in single precision, and only
documents whose sums still reach that score are scored, from the postings they share
with the query. Statistics (number of documents, mean length, document frequencies)
are global, so scores of all shards compare and their best merge exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.shared import word_chunks, written

K1, B = 1.2, 0.75
TOP = 10
#: Documents a block holds, and documents and bytes of text a shard takes; a task's last one takes half as
#: many more, rather than that they make a small shard.
BLOCK = 32
SHARD_DOCS, SHARD_BYTES = 6144, 24 << 20
#: Terms of queries that are sent to the tasks in one piece: 12 bytes each, and 8 for each different one.
QUERY_TERMS = 1 << 21
#: Documents of a shard stand in so many groups at most, of so many on average at least, by so many
#: terms that are frequent in so many documents, found in so many rounds.
GROUPS, GROUP_ROWS, GROUP_TERMS, GROUP_SAMPLE, GROUP_ROUNDS = 6, 512, 256, 512, 4
#: A term is frequent in a group that one in so many of its documents has, and so many at least; their
#: contributions stand in tables of so many bytes at most, the most frequent first.
FREQUENT, FEWEST, TABLE_BYTES = 16, 8, 32 << 20
#: Lengths to which lists of rare terms are filled up; shorter ones than `SHORT` stand in columns,
#: longer ones in rows, as numpy is slow along short ones.
LIST_SIZES, SHORT = np.array([2, 8, 16, 24, *(x << i for i in range(3, 21) for x in (4, 5, 6, 7))]), 16
#: Blocks that are scored without closer bounds, and documents from which on a group's own best say
#: how good the others must be.
FEW_BLOCKS, MANY_DOCS = 2, 16
#: Postings of lists that are added up at a time.
LIST_VALUES = 1 << 20
#: Queries that are asked together, and terms of them at most.
TOGETHER, TOGETHER_TERMS = 512, 1 << 18
#: Shards are searched in parts, so many at most first, and then so many times those before.
PILOT_SHARDS, PILOT_PARTS = 8, 8


def terms_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's distinct words, ascending, and how often each occurs."""
    counted: Counter[bytes] = Counter()
    for chunk in word_chunks(data):
        counted.update(chunk)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, counted, repeat(0)), np.uint64, len(counted))
    order = np.argsort(hashes)
    return hashes[order], np.fromiter(counted.values(), np.int32, len(counted))[order]


def _alike(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of texts, given by their terms one after another, the group of those that share frequent terms."""
    count, groups = len(sizes), min(GROUPS, len(sizes) // GROUP_ROWS)
    group = np.zeros(count, np.int64)
    if groups < 2:
        return group
    ends = np.cumsum(sizes)
    sample = np.linspace(0, count - 1, min(count, GROUP_SAMPLE)).astype(np.int64)
    terms, df = np.unique(np.concatenate([hashes[ends[i] - sizes[i] : ends[i]] for i in sample]), return_counts=True)
    common = np.sort(np.argsort(-df, kind="stable")[:GROUP_TERMS])
    terms, weights = terms[common], np.log(len(sample) / df[common]) + 0.01
    if not len(terms):
        return group
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    here = np.flatnonzero(terms[at] == hashes)
    has = np.zeros((count, len(terms)), np.float32)
    has[np.repeat(np.arange(count), sizes)[here], at[here]] = weights[at[here]]
    has /= np.maximum(np.linalg.norm(has, axis=1, keepdims=True), 1e-9)
    # Each centre is the row of the sample that is least like those before.
    drawn = has[sample]
    centres = [drawn.mean(axis=0)]
    nearest = np.where(drawn.any(axis=1), drawn @ centres[0], 2)
    while len(centres) <= groups:
        centres.append(drawn[np.argmin(nearest)])
        nearest = np.maximum(nearest, drawn @ centres[-1])
    middle = np.array(centres[1:])
    for _ in range(GROUP_ROUNDS):
        group = np.argmax(has @ middle.T, axis=1)
        for i in range(groups):
            own = has[group == i].sum(axis=0)
            middle[i] = own / max(float(np.linalg.norm(own)), 1e-9)
    return np.argmax(has @ middle.T, axis=1)


def _build(ids: list[int], texts: list[bytes]) -> tuple:
    """One shard's postings, by term and then document, as arrays."""
    return _postings(ids, [terms_of(t) for t in texts], np.zeros(1, np.int64))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _wide(data: bytes | pa.Buffer | np.ndarray, count: int) -> np.ndarray:
    """So many numbers as `_narrow` left them."""
    size = memoryview(data).nbytes // max(1, count)
    return np.frombuffer(data, f"u{size}" if size else np.uint8)


def _postings(ids: list[int], found: list[tuple[np.ndarray, np.ndarray]], groups: np.ndarray) -> tuple:
    """The same from each text's terms, a list that is emptied, as it is held twice otherwise."""
    sizes = [len(h) for h, _ in found]
    lengths = np.array([int(t.sum()) for _, t in found], np.int64)
    hashes = np.concatenate([np.zeros(0, np.uint64), *[h for h, _ in found]])
    times = np.concatenate([np.zeros(0, np.int32), *[t for _, t in found]])
    found.clear()
    # Documents ascend as they stand.
    order = np.argsort(hashes, kind="stable")
    hashes, times = hashes[order], times[order]
    docs = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    starts = np.flatnonzero(new)
    edges = _narrow(np.append(starts, len(docs)))
    return np.array(ids, np.int64), lengths, hashes[starts], edges, _narrow(docs), _narrow(times), groups


#: Where each term's postings start, and where the last ones end; where each group of documents starts.
_FIELDS = ("ids", "lengths", "terms", "starts", "docs", "times", "groups")
_INDEX = ", ".join(f"{f} binary" for f in _FIELDS)


def _cell(values: np.ndarray) -> pa.Array:
    """One binary value: the bytes of an array, not copied."""
    ends = pa.py_buffer(np.array([0, values.nbytes], np.int32))
    return pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(values)])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(ids: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        # Texts of the same words stand together, so that a table of their frequent ones is small, and
        # among them those of about as many words, so that maxima are close to contributions.
        sizes = np.array([len(h) for h, _ in found])
        group = _alike(np.concatenate([h for h, _ in found]), sizes)
        order = np.lexsort(([int(t.sum()) for _, t in found], group))
        groups = np.flatnonzero(np.diff(group[order], prepend=-1))
        ids, found[:] = [ids[i] for i in order], [found[i] for i in order]
        return pa.RecordBatch.from_arrays([_cell(x) for x in _postings(ids, found, groups)], names=list(_FIELDS))

    # What fills a shard, and the bytes of what came since.
    ids, found, full, held = [], [], 0, 0
    for batch in batches:
        column = batch.column(1).cast(pa.binary())
        for i, doc in enumerate(batch.column(0).to_pylist()):
            data = column[i].as_py() or b""
            ids.append(doc)
            found.append(terms_of(data))
            held += len(data)
            since = len(ids) - full
            if not full and (since >= SHARD_DOCS or held >= SHARD_BYTES):
                full, held = len(ids), 0
            elif full and (2 * since >= SHARD_DOCS or 2 * held >= SHARD_BYTES):
                rest = ids[full:], found[full:]
                del ids[full:], found[full:]
                yield out(ids, found)
                (ids, found), full = rest, 0
    if ids:
        yield out(ids, found)


class Group(NamedTuple):
    """Documents of a shard that share frequent terms, and what these contribute to them."""

    begin: int  # among the places of documents
    coarse: np.ndarray  # of each frequent term the contributions to all documents, in single precision
    maxima: np.ndarray  # and the highest in each block


class Shard(NamedTuple):
    """A shard ready to be searched: postings with contributions, tables of frequent terms, lists of rare ones."""

    ids: np.ndarray
    terms: np.ndarray
    docs: np.ndarray
    gains: np.ndarray
    firsts: np.ndarray  # of each term's postings
    edges: np.ndarray  # of each document's postings in the next two
    own_terms: np.ndarray  # postings by document: terms
    own_gains: np.ndarray  # and contributions
    holds: np.ndarray  # the document at each place, -1 where a group's last block has no more
    columns: np.ndarray  # of each term that is frequent in a group among those, -1 for others
    rows: np.ndarray  # of each such term in each group's table, -1 where it is rare
    groups: list[Group]
    kinds: np.ndarray  # of each term the lists among which its postings outside of tables stand
    slots: np.ndarray  # and where
    lists: list[tuple[np.ndarray, np.ndarray] | None]  # places and contributions, filled up to one length

    @property
    def spans(self) -> np.ndarray:
        """Of each term, and of the end, among ``firsts``."""
        return np.arange(len(self.firsts))


def load(row: dict[str, bytes | pa.Buffer | np.ndarray], mean_length: float) -> Shard:
    ids, lengths, begins = (np.frombuffer(row[f], np.int64) for f in ("ids", "lengths", "groups"))
    terms = np.frombuffer(row["terms"], np.uint64)
    firsts = _wide(row["starts"], len(terms) + 1).astype(np.int64)
    docs, times = (_wide(row[f], int(firsts[-1])) for f in ("docs", "times"))
    share = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
    gains = share[docs]
    gains += times
    np.divide(times, gains, out=gains)
    gains *= K1 + 1
    df = np.diff(firsts)
    of = np.repeat(np.arange(len(terms), dtype=np.int32), df)
    # The documents' places: in each group the first ones of all blocks, then the second ones, since
    # numpy finds maxima faster across rows than along short ones.
    sizes = np.diff(np.append(begins, len(ids)))
    widths = -(-sizes // BLOCK) * BLOCK
    corners = np.cumsum(widths) - widths
    group_of = np.repeat(np.arange(len(sizes)), sizes)
    block, inner = np.divmod(np.arange(len(ids)) - begins[group_of], BLOCK)
    place = corners[group_of] + inner * (widths // BLOCK)[group_of] + block
    holds = np.full(int(widths.sum()), -1, np.int32)
    holds[place] = np.arange(len(ids))
    # What can be frequent somewhere, and how often it is in each group.
    least = np.maximum(-(-sizes // FREQUENT), FEWEST)
    maybe = np.flatnonzero(df >= least.min(initial=len(ids) + 1))
    spans = _spread(firsts[maybe], df[maybe])
    term = np.repeat(np.arange(len(maybe), dtype=np.int32), df[maybe])
    inside = group_of.astype(np.uint8)[docs[spans]]
    counts = np.bincount(inside.astype(np.int64) * len(maybe) + term, minlength=len(sizes) * len(maybe)).reshape(len(sizes), -1)
    rows = np.full(counts.shape, -1, np.int32)
    for own, row_of, need in zip(counts, rows, least):
        frequent = np.flatnonzero(own >= need)
        frequent = frequent[np.argsort(-own[frequent], kind="stable")[: TABLE_BYTES // (4 * max(1, len(ids)))]]
        row_of[frequent] = np.arange(len(frequent))
    at_row = rows[inside, term]
    tabled = np.flatnonzero(at_row >= 0)
    inside, spans, at_row = inside[tabled], spans[tabled], at_row[tabled].astype(np.int64)
    heights = rows.max(axis=1, initial=-1).astype(np.int64) + 1
    bases = np.cumsum(heights * widths) - heights * widths
    at_row *= widths[inside]
    at_row += (bases - corners)[inside]
    at_row += place[docs[spans]]
    table = np.zeros(int((heights * widths).sum()), np.float32)
    table[at_row] = gains[spans]
    groups = []
    for corner, width, base, height in zip(corners.tolist(), widths.tolist(), bases.tolist(), heights.tolist()):
        coarse = table[base : base + height * width].reshape(height, width)
        groups.append(Group(corner, coarse, _highest(coarse)))
    somewhere = (rows >= 0).any(axis=0)
    columns = np.full(len(terms), -1, np.int32)
    columns[maybe[somewhere]] = np.arange(np.count_nonzero(somewhere))
    # The others, in lists of a few lengths.
    rest = np.ones(len(docs), bool)
    rest[spans] = False
    left = np.add.reduceat(rest, firsts[:-1], dtype=np.int64) if len(terms) else df
    others, amounts = place.astype(np.min_scalar_type(len(holds)))[docs[rest]], gains[rest].astype(np.float32)
    starts = np.cumsum(left) - left
    kinds = np.searchsorted(LIST_SIZES, left).astype(np.uint8)
    kinds[left == 0] = len(LIST_SIZES)
    slots, lists = np.zeros(len(terms), np.int32), []
    order = np.argsort(kinds, kind="stable")
    bounds = np.searchsorted(kinds[order], np.arange(len(LIST_SIZES) + 1))
    for size, first, last in zip(LIST_SIZES, bounds[:-1], bounds[1:]):
        if first == last:
            lists.append(None)
            continue
        turn = order[first:last]
        slots[turn] = np.arange(len(turn))
        at = starts[turn, None] + np.arange(size)
        empty = np.arange(size) >= left[turn, None]
        at[empty] = 0
        own, amount = others[at], amounts[at]
        # What fills them up is added behind the last place.
        own[empty], amount[empty] = len(holds), 0
        lists.append(tuple(np.ascontiguousarray(x.T) if size < SHORT else x for x in (own, amount)))
    order = np.argsort(docs, kind="stable")
    own_terms, own_gains = of[order], gains[order]
    edges = np.append(0, np.cumsum(np.bincount(docs, minlength=len(ids))))
    return Shard(
        ids, terms, docs, gains, firsts, edges, own_terms, own_gains, holds, columns, rows[:, somewhere], groups, kinds, slots, lists
    )


def _highest(values: np.ndarray) -> np.ndarray:
    """The highest of each row's values in each block of a group's places."""
    return values.reshape(len(values), BLOCK, values.shape[1] // BLOCK).max(axis=1)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of spans all the places, one span after another."""
    ends = np.cumsum(sizes)
    out = np.repeat(starts - (ends - sizes), sizes)
    out += np.arange(len(out))
    return out


def best(
    shard: Shard, terms: np.ndarray, weights: np.ndarray, top: int, floor: float = 0.0
) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the shard's best documents for a query, and the blocks scored.

    Only documents that share a term with the query count, and none below ``floor``;
    of equal scores the smaller id comes first.
    """
    at = places(shard, terms)
    _, ids, scores, blocks = answers(shard, at, weights, np.zeros(len(at), np.int64), np.array([floor]), top)
    return ids, scores, blocks


def places(shard: Shard, terms: np.ndarray) -> np.ndarray:
    """Where terms stand among the shard's, -1 for those it does not have."""
    if not len(shard.terms):
        return np.full(len(terms), -1)
    at = np.minimum(np.searchsorted(shard.terms, terms), len(shard.terms) - 1)
    return np.where(shard.terms[at] == terms, at, -1)


def _listed(shard: Shard, at: np.ndarray, weights: np.ndarray, query: np.ndarray, count: int) -> np.ndarray:
    """What the lists of some queries' terms add up to, by query and place, and more for what fills them up."""
    width = len(shard.holds) + 1
    sums = np.zeros(count * width, np.float32)
    kinds = shard.kinds[at]
    order = np.argsort(kinds, kind="stable")
    at, weights, shifts = shard.slots[at[order]], weights[order].astype(np.float32), query[order] * width
    first = 0
    amounts = np.bincount(kinds, minlength=len(LIST_SIZES)).tolist()
    for size, amount, held in zip(LIST_SIZES.tolist(), amounts, shard.lists):
        # Not more at a time than what a cache holds.
        step = max(1, LIST_VALUES // size)
        for begin in range(first, first + amount, step):
            span = slice(begin, min(begin + step, first + amount))
            shift, weight, axis = shifts[span], weights[span], 1
            if size >= SHORT:
                shift, weight, axis = shift[:, None], weight[:, None], 0
            places = held[0].take(at[span], axis=axis) + shift
            values = held[1].take(at[span], axis=axis)
            values *= weight
            np.add.at(sums, places.ravel(), values.ravel())
        first += amount
    return sums.reshape(count, width)


def answers(
    shard: Shard, at: np.ndarray, weights: np.ndarray, query: np.ndarray, floors: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The best documents of some queries: queries by their number, ids, scores, and the blocks scored.

    ``at`` are the queries' terms as they stand in the shard, those of a query together
    and queries ascending, ``floors`` each query's least score.
    """
    here = at >= 0
    at, weights, query = at[here].astype(np.int32), weights[here], query[here]
    count, levels = len(floors), floors.astype(float)
    # A part in 2 ** 24 is lost with each sum and product.
    slack = 1 + (int(np.bincount(query, minlength=1).max()) + 8) * 2.0**-22
    listed = _listed(shard, at, weights, query, count)
    column = shard.columns[at]
    common = np.flatnonzero(column >= 0)
    column, wide, asking = column[common], weights[common], query[common]
    pairs, stands = [], []
    for group, row_of in zip(shard.groups, shard.rows):
        row = row_of[column]
        held = np.flatnonzero(row >= 0)
        stands.append((float(wide[held].sum()), group, row, held))
    # The groups that share most with the queries tell first how good the documents of others must be.
    for _, group, row, held in sorted(stands, key=lambda x: -x[0]):
        spread = np.zeros((count, len(group.coarse)), np.float32)
        spread[asking[held], row[held]] = wide[held]
        width = group.coarse.shape[1]
        part = listed[:, group.begin : group.begin + width]
        least = _least(levels, slack)
        bounds = spread @ group.maxima
        live = bounds + _highest(part) >= least
        blocks = np.count_nonzero(live, axis=1)
        few, turn = np.flatnonzero((blocks > 0) & (blocks <= FEW_BLOCKS)), np.flatnonzero(blocks > FEW_BLOCKS)
        if len(few):
            whose, block = np.nonzero(live[few])
            whose, near = np.repeat(few[whose], BLOCK), (block[:, None] + np.arange(0, width, width // BLOCK)).ravel()
            upper = part[whose, near] + bounds[whose, near % (width // BLOCK)]
            reach = np.flatnonzero(upper >= least[whose, 0])
            pairs.append((whose[reach], near[reach] + group.begin, upper[reach], np.zeros(len(reach), bool)))
        if len(turn):
            own = spread[turn] if len(turn) < count else spread
            used = np.flatnonzero(own.any(axis=0))
            sums = own[:, used] @ group.coarse[used] if 4 * len(used) < 3 * len(group.coarse) else own @ group.coarse
            sums += part[turn] if len(turn) < count else part
            reach = sums >= least[turn]
            for i in np.flatnonzero(np.count_nonzero(reach, axis=1) > max(top, MANY_DOCS)).tolist():
                # So many are as good as the last of the best.
                last = float(np.partition(sums[i], width - top)[width - top]) / slack
                levels[turn[i]] = max(levels[turn[i]], last)
                reach[i] = sums[i] >= _least(levels[turn[i : i + 1]], slack)[0]
            some = np.flatnonzero(reach.any(axis=1))
            whose, near = np.nonzero(reach[some])
            whose = some[whose]
            pairs.append((turn[whose], near + group.begin, sums[whose, near], np.ones(len(whose), bool)))
    if pairs:
        whose, docs, upper, close = (np.concatenate(x) for x in zip(*pairs))
        # What is the last of the best in all groups, by sums that are no mere bounds.
        order = np.flatnonzero(close)
        order = order[np.lexsort((-upper[order], whose[order]))]
        last = order[np.arange(len(order)) - np.searchsorted(whose[order], whose[order]) == top - 1]
        levels[whose[last]] = np.maximum(levels[whose[last]], upper[last] / slack)
        reach = upper >= _least(levels, slack)[whose, 0]
        whose, docs = whose[reach], shard.holds[docs[reach]]
    else:
        whose, docs = np.zeros(0, np.int64), np.zeros(0, np.int32)
    whose, docs = whose[docs >= 0], docs[docs >= 0]
    scores = _scores(shard, at, weights, query, whose, docs)
    good = scores >= np.maximum(floors[whose], 1e-300)
    whose, ids, scores = whose[good], shard.ids[docs[good]], scores[good]
    order = np.lexsort((ids, -scores, whose))
    whose, ids, scores = whose[order], ids[order], scores[order]
    keep = np.arange(len(whose)) - np.searchsorted(whose, whose) < top
    return whose[keep], ids[keep], scores[keep], len(np.unique(docs // BLOCK))


def _least(levels: np.ndarray, slack: float) -> np.ndarray:
    """Sums in single precision below which no score reaches its level."""
    return np.maximum(levels / slack * (1 - 1e-6), 1e-30)[:, None].astype(np.float32)


def _scores(
    shard: Shard, at: np.ndarray, weights: np.ndarray, query: np.ndarray, whose: np.ndarray, docs: np.ndarray
) -> np.ndarray:
    """The scores of pairs of a query and a document, from the postings they share."""
    bounds = np.searchsorted(query, np.arange(int(whose.max(initial=-1)) + 2))
    scores = np.zeros(len(docs))
    for i, (one, doc) in enumerate(zip(whose.tolist(), docs.tolist())):
        asked, has = slice(bounds[one], bounds[one + 1]), slice(shard.edges[doc], shard.edges[doc + 1])
        few, many = (at[asked], weights[asked]), (shard.own_terms[has], shard.own_gains[has])
        if len(few[0]) > len(many[0]):
            few, many = many, few
        # Both ascend.
        found = np.searchsorted(many[0], few[0])
        found = np.minimum(found, len(many[0]) - 1)
        same = np.flatnonzero(many[0][found] == few[0])
        scores[i] = few[1][same] @ many[1][found[same]]
    return scores


class Lot(NamedTuple):
    """Queries that are sent to the tasks in one piece."""

    numbers: np.ndarray
    offsets: np.ndarray  # of each query's terms
    vocabulary: np.ndarray
    terms: np.ndarray  # of queries, among the vocabulary
    weights: np.ndarray


def _lot(queries: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> Lot:
    """Rows of a query, a term and its weight in one piece, like queries next to each other."""
    order = np.lexsort((terms, queries))
    queries, terms, weights = queries[order], terms[order], weights[order]
    numbers, starts = np.unique(queries, return_index=True)
    sizes = np.diff(np.append(starts, len(queries)))
    # Where queries that are asked together share words, less of a shard's tables is opened.
    order = np.lexsort((sizes, _alike(terms, sizes)))
    rows = _spread(starts[order], sizes[order])
    vocabulary, place = np.unique(terms, return_inverse=True)
    return Lot(numbers[order], np.append(0, np.cumsum(sizes[order])), vocabulary, place[rows].astype(np.int32), weights[rows])


def _turns(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Queries that are asked together: so many, and of so many terms, at most."""
    begin = 0
    while begin < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[begin] + TOGETHER_TERMS, "right")) - 1
        end = min(max(end, begin + 1), begin + TOGETHER, len(offsets) - 1)
        yield begin, end
        begin = end


def _search(lots: list, floors, mean_length: float, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = floors.value.copy()
        for batch in batches:
            for i in range(batch.num_rows):
                shard = load({f: batch.column(j)[i].as_buffer() for j, f in enumerate(_FIELDS)}, mean_length)
                base = 0
                for sent in lots:
                    lot = Lot(*sent.value)
                    # One lot is held at a time.
                    vars(sent).pop("_value", None)
                    own = level[base : base + len(lot.numbers)]
                    base += len(lot.numbers)
                    at = places(shard, lot.vocabulary).astype(np.int32)
                    found = []
                    for begin, end in _turns(lot.offsets):
                        span = slice(lot.offsets[begin], lot.offsets[end])
                        query = np.repeat(np.arange(end - begin), np.diff(lot.offsets[begin : end + 1]))
                        stand = at[lot.terms[span]]
                        whose, ids, scores, _ = answers(shard, stand, lot.weights[span], query, own[begin:end], top)
                        found.append((lot.numbers[begin:end][whose], ids, scores))
                        # What comes last of a query's best: none below it is wanted from other shards.
                        last = np.flatnonzero(np.arange(len(whose)) - np.searchsorted(whose, whose) == top - 1)
                        # The same sum in another shard may differ in its last digits.
                        own[begin + whose[last]] = np.maximum(own[begin + whose[last]], scores[last] * (1 - 1e-9))
                    del lot, at
                    if found:
                        columns = [pa.array(np.concatenate(x)) for x in zip(*found)]
                        yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])
                # Before the next one is loaded.
                del shard

    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for i, query in enumerate(batch.column(0).to_pylist()):
            hashes, times = terms_of(texts[i].as_py() or b"")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(hashes), query, np.int64)), pa.array(hashes.view(np.int64)), pa.array(times)],
                names=["query", "term", "times"],
            )


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies within each shard of all its terms, whether queries ask for them or not."""
    for batch in batches:
        for terms, starts in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            df = np.diff(_wide(starts, len(terms) // 8 + 1).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(terms, np.int64)), pa.array(df)], names=["term", "df"]
            )


def search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """Rows ``query_id``, ``rank``, ``doc_id``, ``score``: the ``top`` best documents of each query.

    ``queries`` has the same columns as ``docs``. Words are lower-cased in A-Z and cut
    at white space; a word that a query repeats counts as often. Every document that
    shares a word with the query is a candidate, the query's own row too; of equal
    scores the smaller id comes first. A query without words, or whose words no
    document has, gives no rows. Null texts are empty; rows and queries without an id
    are left out, as no result could name them; a repeated row is a document of its
    own, a repeated query is asked once for each text. Empty tables give an empty
    result. Words are told apart by 64-bit hashes. Texts are read whole, however long,
    and other columns are not read, whatever they are called.

    Queries go to the tasks in lots of a bounded number of terms, one held at a time, and
    each shard is loaded once for all of them: the work is queries times shards, as the task is.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    index = texts.where("doc_id is not null").mapInArrow(_index, _INDEX)
    index = written(index.withColumn("shard", F.xxhash64("ids")), "index").table
    asked = (
        queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(text_col).cast("string").alias("text"))
        .where("query_id is not null")
        .withColumn("query", F.xxhash64("query_id", "text"))
    )
    terms = written(asked.select("query", "text").mapInArrow(_query_terms, "query long, term long, times int").distinct(), "asked").table
    context = docs.sparkSession.sparkContext
    frequencies = index.select("terms", "starts").mapInArrow(_frequencies, "term long, df long")
    # Lengths and ids are arrays of eight-byte numbers.
    count, length, shards = (
        index.select(F.octet_length("ids").alias("n"), "lengths")
        .mapInArrow(_lengths, "n long, length long")
        .agg(F.sum("n"), F.sum("length"), F.count("*"))
        .first()
    )
    count, length = count or 0, length or 0
    known = frequencies.groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log1p((F.lit(count) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(known, "term").select("query", "term", (F.col("times") * idf).alias("weight"))
    by_score = W.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    # Lots by the hash of the query: about as many terms each.
    total = terms.count()
    pieces = max(1, -(-total * 5 // (query_terms * 4)))
    weighted = written(weighted.withColumn("lot", F.pmod(F.xxhash64("query"), F.lit(pieces))), "weights").table
    mean = length / count if count else 0.0
    lots, numbers = [], []
    for piece in range(pieces):
        rows = weighted.where(F.col("lot") == piece).select("query", "term", "weight").toArrow()
        columns = [rows.column(i).to_numpy() for i in range(3)]
        lot = _lot(columns[0], columns[1].view(np.uint64), columns[2])
        numbers.append(lot.numbers)
        # No class of this package, which tasks may have by value only.
        lots.append(context.broadcast(tuple(lot)))
        del rows, columns, lot
    every = np.concatenate(numbers)
    order = np.argsort(every)
    # The shards of each part are so many times those before.
    last = max(1, -(-shards // PILOT_SHARDS))
    ends = [1]
    while ends[-1] < last:
        ends.append(min(last, ends[-1] * PILOT_PARTS))
    place = F.pmod(F.xxhash64("shard"), F.lit(last))
    floors, found = np.zeros(len(every)), []
    for begin, end in zip([0, *ends], ends):
        if found:
            # The shards so far tell how good a document must be to be worth a row elsewhere.
            ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(by_score))
            kept = ranked.where(F.col("rank") == top).select("query", "score").toArrow()
            # The same sum in another shard may differ in its last digits.
            at = order[np.searchsorted(every, kept.column(0).to_numpy(), sorter=order)]
            floors[at] = kept.column(1).to_numpy() * (1 - 1e-9)
        task = _search(lots, context.broadcast(floors), mean, top)
        part = index.where((place >= begin) & (place < end)).select(*_FIELDS)
        found.append(written(part.mapInArrow(task, "query long, doc_id long, score double"), "found").table)
    results = reduce(DataFrame.unionByName, found)
    ranked = results.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return ranked.join(asked.select("query", "query_id").distinct(), "query").select("query_id", "rank", "doc_id", "score")


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [int(np.frombuffer(x, np.int64).sum()) for x in batch.column(1).to_pylist()]
        counts = [n // 8 for n in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(lengths, pa.int64())], names=["n", "length"]
        )
