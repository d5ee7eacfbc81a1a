from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import context_tree as ct
from tablewright.llm import queries


D = ct.DEPTH


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


class BruteTree:
    """Context-tree weighting by recursion over dictionaries."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])  # (context, node)
        self.children = defaultdict(set)
        for data in texts:
            padded = bytes(D) + data
            for i, byte in enumerate(data):
                for d in range(D + 1):
                    context = padded[i + D - d : i + D]
                    if d < D:
                        self.children[context].add(padded[i + D - 1 - d : i + D])
                    for k in range(8):
                        self.counts[context, 1 << k | byte >> 8 - k][byte >> 7 - k & 1] += 1
        self.memo = {}

    def kt(self, context, node):
        a, b = self.counts.get((context, node), (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, context, node):
        if (context, node) not in self.memo:
            value = self.kt(context, node)
            if len(context) < D:
                below = sum(self.weighted(c, node) for c in self.children.get(context, ()))
                value = float(np.logaddexp(value, below)) - math.log(2)
            self.memo[context, node] = value
        return self.memo[context, node]

    def one(self, context, node, past):
        a, b = self.counts.get((context, node), (0, 0))
        own = (b + 0.5) / (a + b + 1)
        if len(context) == D:
            return own
        stop = math.exp(self.kt(context, node) - math.log(2) - self.weighted(context, node))
        longer = past[len(past) - len(context) - 1 :]
        return stop * own + (1 - stop) * self.one(longer, node, past)

    def score(self, data):
        padded, total = bytes(D) + data, 0.0
        for i, byte in enumerate(data):
            for k in range(8):
                p = self.one(b"", 1 << k | byte >> 8 - k, padded[i : i + D])
                total += math.log10(p if byte >> 7 - k & 1 else 1 - p)
        return total


def brute_base(rows):
    tokens = {i: (t or "").encode().lower().split() for i, (_, t) in enumerate(rows)}
    counts, ends = Counter(), 0
    for i, (doc_id, _) in enumerate(rows):
        if not held(doc_id):
            counts.update(tokens[i])
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for i in range(len(rows)):
        seen = [counts[w] for w in tokens[i]] + [ends]
        out.append((len(seen), sum(c > 0 for c in seen), n, sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in seen)))
    return out


def check(rows, got, trees=True):
    assert len(got) == len(rows)
    base = brute_base(rows)
    tree = BruteTree([(t or "").encode() for i, t in rows if not held(i)]) if trees else None
    want = defaultdict(list)
    for (doc_id, text), b in zip(rows, base):
        want[doc_id].append((b, tree.score((text or "").encode()) if trees else None))
    for r in got:
        assert r.held_out == held(r.doc_id)
        options = want[r.doc_id]
        assert any(
            (r.n_tokens, r.n_known, r.train_tokens) == b[:3]
            and r.base_score == pytest.approx(b[3], rel=1e-9)
            and (not trees or r.score == pytest.approx(s, rel=1e-9, abs=1e-9))
            for b, s in options
        ), (r, options)


def small_rows(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60)
    return [(d.doc_id, d.text[:400]) for d in docs.collect()]


@pytest.mark.parametrize("common", [(1 << 21, 1 << 20), (300, 20), (0, 0)])
def test_against_recursion(spark, tables, common):
    rows = small_rows(spark, tables) + [(None, "Aé a"), (3, None), (4, ""), (5, "x y x"), (5, "x y x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("k"))
    check(rows, ct.score_documents(frame, common_strings=common[0], common_words=common[1]).collect())


def test_query_base_and_held_out_gain(spark, tables):
    rows = [tuple(d) for d in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op7_context_tree_scores(spark, tables).collect()
    check(rows, got, trees=False)
    apart = [r for r in got if r.held_out]
    # Held-out texts cost far less than eight bits a byte.
    bits = -sum(r.score for r in apart) / math.log10(2) / sum(r.n_bytes for r in apart)
    assert bits < 4


def test_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = ct.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 2.0, 10.5, 1e3, 1e9])
    assert np.allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_long_text_in_parts():
    data = bytes(range(1, 200)) * 30_000
    assert np.array_equal(np.concatenate(list(ct._parts(data))), ct.strings(data))


def test_edges(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert ct.score_documents(frame).collect() == []
    alone = spark.createDataFrame([(None, "ab")], "doc_id long, text string")
    row = ct.score_documents(alone).collect()[0]
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 2, 0, 0)
    assert row.score == pytest.approx(16 * math.log10(0.5)) and row.base_score == pytest.approx(0.0)
