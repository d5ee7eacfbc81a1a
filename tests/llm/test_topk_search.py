from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries
from tablewright.llm import topk_search as ts


def brute(docs, asked, top=10):
    docs = [(i, Counter((t or "").encode().lower().split())) for i, t in docs if i is not None]
    n = len(docs)
    df = Counter(w for _, c in docs for w in c)
    mean = sum(sum(c.values()) for _, c in docs) / max(1, n)
    out = defaultdict(list)
    for q, text in set(asked):
        if q is None:
            continue
        scores = []
        for i, c in docs:
            score = 0.0
            for w, times in Counter((text or "").encode().lower().split()).items():
                if c[w]:
                    idf = math.log1p((n - df[w] + 0.5) / (df[w] + 0.5))
                    score += times * idf * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
            if score:
                scores.append((-score, i))
        out[q] += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return out


def check(got, want):
    by_query = defaultdict(list)
    for r in got:
        by_query[r.query_id].append((r.rank, r.doc_id, r.score))
    assert set(by_query) == {q for q in want if want[q]}
    for q, rows in by_query.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(want[q]) + 1))
        assert [r[2] for r in rows] == pytest.approx([w[3] for w in want[q]], rel=1e-9, abs=1e-6)
        # Where scores are apart, the documents agree; the sums' last digits may swap equal ones.
        for (_, doc, score), w in zip(rows, want[q]):
            tied = [x[2] for x in want[q] if x[3] == pytest.approx(score, rel=1e-9, abs=1e-6)]
            assert doc in tied or len(want[q]) == 10 and score == pytest.approx(want[q][-1][3], rel=1e-9, abs=1e-6), w


def test_query(spark, tables):
    got = queries.op2_block_max_search(spark, tables).collect()
    docs = [tuple(d) for d in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    check(got, brute(docs, [d for d in docs if d[0] % 50 == 0]))


@pytest.mark.parametrize("lot", [1 << 20, 40])
def test_many_shards_and_lots(spark, lot):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    docs = [
        (i, " ".join(rng.choice(vocabulary, rng.integers(0, 60), p=share / share.sum()))) for i in range(700)
    ] + [(900, None), (901, ""), (None, "w1 w2"), (5, "w1 w390"), (902, "nowhere"), (903, "W3 w3")]
    asked = [d for d in docs if d[0] is None or d[0] % 50 == 0] + [(902, "unheard"), (100, docs[100][1])]
    kind = "doc_id long, text string"
    frame = spark.createDataFrame(docs, kind).repartition(7).withColumns({"terms": F.lit(1), "score": F.lit("x")})
    got = ts.search(frame, spark.createDataFrame(asked, kind), query_terms=lot).collect()
    check(got, brute(docs, asked))


def test_blocks_are_skipped_and_nothing_is_lost():
    rng = np.random.default_rng(4)
    texts = [b" ".join(b"t%d" % x for x in rng.zipf(1.3, rng.integers(5, 80)) % 3000) for _ in range(3000)]
    shard = ts.load(dict(zip(ts._FIELDS, ts._build(list(range(3000)), texts))), 40.0)
    skipped = 0
    for q in range(0, 3000, 100):
        terms, times = (x[: 3 + q % 5] for x in ts.terms_of(texts[q]))
        weights = times * rng.uniform(0.1, 8, len(terms))
        ids, scores, scored = ts.best(shard, terms, weights, 10)
        exact = np.zeros(3000)
        at = np.searchsorted(shard.terms, terms)
        edges = shard.firsts[shard.spans]
        for t, w in zip(at, weights):
            span = slice(edges[t], edges[t + 1])
            exact[shard.docs[span]] += w * shard.gains[span]
        want = np.lexsort((np.arange(3000), -exact))[:10]
        want = want[exact[want] > 0]
        assert np.allclose(scores, exact[want]) and ids.tolist() == want.tolist()
        skipped += scored < -(-3000 // ts.BLOCK)
    assert skipped > 5


def test_edges(spark):
    kind = "doc_id long, text string"
    docs = spark.createDataFrame([(1, "a b"), (2, None)], kind)
    assert ts.search(docs, docs.where("false")).collect() == []
    assert ts.search(docs.where("false"), docs).collect() == []
    assert [(r.query_id, r.doc_id) for r in ts.search(docs, docs).collect()] == [(1, 1)]


def test_few_documents_of_a_long_query_are_scored():
    rng = np.random.default_rng(6)
    share = 1 / np.arange(1, 2001)
    texts = [b" ".join(b"w%d" % x for x in rng.choice(2000, 200, p=share / share.sum())) for _ in range(1600)]
    shard = ts.load(dict(zip(ts._FIELDS, ts._build(list(range(1600)), texts))), 200.0)
    assert (shard.columns >= 0).any()
    edges = shard.firsts[shard.spans]
    df = np.diff(edges)
    blocks = 0
    for q in range(0, 1600, 50):
        terms, times = ts.terms_of(texts[q])
        at = np.searchsorted(shard.terms, terms)
        weights = times * np.log1p((1600 - df[at] + 0.5) / (df[at] + 0.5))
        exact = np.zeros(1600)
        for t, w in zip(at, weights):
            span = slice(edges[t], edges[t + 1])
            exact[shard.docs[span]] += w * shard.gains[span]
        want = np.lexsort((np.arange(1600), -exact))[:10]
        for floor in (0.0, exact[want[-1]] * (1 - 1e-9)):
            ids, scores, scored = ts.best(shard, terms, weights, 10, floor)
            assert np.allclose(scores, exact[want], rtol=1e-12) and ids.tolist() == want.tolist()
        blocks += scored
    # Ten documents stand in as many blocks of the fifty; blocks' maxima alone rule out hardly one.
    assert blocks < 32 * 25


def test_every_term_of_a_shard_is_a_row_of_document_frequencies(spark):
    docs = [(1, "a b"), (2, "b c"), (3, None), (4, "a a b")]
    index = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).mapInArrow(ts._index, ts._INDEX)
    rows = (
        index.select("terms", "starts", F.octet_length("docs").alias("size"))
        .mapInArrow(ts._frequencies, "term long, df long")
        .collect()
    )
    hashes = ts.terms_of(b"a b c")[0].view(np.int64).tolist()
    want = {h: {b"a": 2, b"b": 3, b"c": 1}[w] for w in (b"a", b"b", b"c") for h in ts.terms_of(w)[0].view(np.int64).tolist()}
    assert sorted(hashes) == sorted(r.term for r in rows) and {r.term: r.df for r in rows} == want


def test_parts_of_the_shards_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(ts, "PILOT_SHARDS", 1)
    monkeypatch.setattr(ts, "PILOT_PARTS", 2)
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{x}" for x in rng.zipf(1.4, 20) % 90)) for i in range(300)]
    asked = [d for d in docs if d[0] % 20 == 0]
    kind = "doc_id long, text string"
    got = ts.search(spark.createDataFrame(docs, kind).repartition(9), spark.createDataFrame(asked, kind)).collect()
    check(got, brute(docs, asked))


def two_languages(n, seed):
    """Texts whose words are those of one of two languages, one for another, some long and some short."""
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, 901)
    share /= share.sum()
    return [" ".join(f"{'ab'[i % 2]}{x}" for x in rng.choice(900, rng.integers(3, 150), p=share)) for i in range(n)]


def test_queries_asked_together_get_what_each_gets_alone(monkeypatch):
    monkeypatch.setattr(ts, "GROUP_ROWS", 128)
    texts = two_languages(900, 2) + ["a1 " * 300 + "b7", "", "b3 " * 70000]
    ids = list(range(len(texts)))
    (row,) = ts._index(iter([pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], names=["doc_id", "text"])]))
    row = {f: row.column(j)[0].as_buffer() for j, f in enumerate(ts._FIELDS)}
    mean = sum(len(t.split()) for t in texts) / len(texts)
    shard = ts.load(row, mean)
    assert len(shard.groups) > 1
    # A language's words have no rows in tables of documents of the other one.
    assert sum(g.coarse.size for g in shard.groups) < 0.7 * len(ids) * shard.rows.shape[1]
    want = brute(list(zip(ids, texts)), [(i, texts[i]) for i in ids[::7]])
    df = dict(zip(shard.terms.tolist(), np.diff(shard.firsts).tolist()))
    at, weights, query = [], [], []
    for number, i in enumerate(ids[::7]):
        terms, times = ts.terms_of(texts[i].encode())
        idf = np.array([math.log1p((len(ids) - df[t] + 0.5) / (df[t] + 0.5)) for t in terms.tolist()])
        at.append(ts.places(shard, terms))
        weights.append(times * idf)
        query.append(np.full(len(terms), number))
    for floor in (0.0, 1.0):
        floors = np.array([floor * want[i][-1][3] * (1 - 1e-9) if want[i] else 0.0 for i in ids[::7]])
        got = ts.answers(shard, np.concatenate(at), np.concatenate(weights), np.concatenate(query), floors, 10)
        for number, i in enumerate(ids[::7]):
            mine = got[0] == number
            assert got[1][mine].tolist() == [w[2] for w in want[i]]
            assert got[2][mine].tolist() == pytest.approx([w[3] for w in want[i]], rel=1e-12)


class Sent:
    """What a task sees of a broadcast value."""

    def __init__(self, value):
        self.stored = value

    @property
    def value(self):
        self._value = self.stored
        return self._value


def test_a_shard_is_loaded_once_for_all_lots(monkeypatch):
    texts = two_languages(200, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts)], names=["doc_id", "text"])
    (row,) = ts._index(iter([batch]))
    loads, load = [], ts.load
    monkeypatch.setattr(ts, "load", lambda *x: loads.append(1) or load(*x))
    lots = []
    for i in range(0, 200, 20):
        terms, times = ts.terms_of(texts[i].encode())
        lots.append(Sent(tuple(ts._lot(np.full(len(terms), i), terms, times.astype(float)))))
    rows = list(ts._search(lots, Sent(np.zeros(10)), 70.0, 10)(iter([row])))
    assert loads == [1] and len(rows) == 10
    # No lot is held once the next one is asked.
    assert not any("_value" in vars(x) for x in lots)
    for i, found in zip(range(0, 200, 20), rows):
        assert found.column(0).to_pylist() == [i] * 10 and found.column(1).to_pylist()[0] == i


def test_a_task_leaves_no_small_shard(monkeypatch):
    monkeypatch.setattr(ts, "SHARD_DOCS", 100)
    for n, want in ((149, [149]), (150, [100, 50]), (260, [100, 100, 60]), (1, [1]), (249, [100, 149])):
        batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(two_languages(n, 4))], names=["doc_id", "text"])
        shards = [np.frombuffer(row.column(0)[0].as_py(), np.int64) for row in ts._index(iter([batch]))]
        assert [len(x) for x in shards] == want
        assert sorted(np.concatenate(shards).tolist()) == list(range(n))


def test_equal_documents_of_many_shards_stand_by_their_ids(spark):
    text = " ".join(f"w{i % 37}" for i in range(500))
    docs = [(i, text) for i in range(60)] + [(100 + i, f"w{i} other") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = ts.search(frame, spark.createDataFrame([docs[7]], "doc_id long, text string")).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.rank)] == list(range(10))
