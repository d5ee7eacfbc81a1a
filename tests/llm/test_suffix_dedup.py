from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries
from tablewright.llm import suffix_dedup as sd


def brute(rows):
    """Count every window of 200 bytes of every text."""
    times = Counter()
    datas = [(i, (t or "").encode()) for i, t in rows]
    for _, d in datas:
        times.update(d[s : s + 200] for s in range(len(d) - 199))
    out = []
    for i, d in datas:
        gone = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - 199):
            if times[d[s : s + 200]] > 1:
                gone[s : s + 200] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries.op6_suffix_array_dedup(spark, tables)) == brute([tuple(d) for d in docs])


def planted(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [prose(60) for _ in range(5)]
    docs = []
    for i in range(150):
        parts = [prose(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 150)
            parts += [p[cut : cut + rng.randrange(150, 300)], prose(rng.randrange(0, 40))]
        docs.append((i, " ".join(parts)))
    docs += [(200, "a" * 700), (201, "ab" * 200), (202, "a" * 199), (203, "a" * 200), (204, docs[3][1]), (3, docs[3][1])]
    return docs


@pytest.mark.parametrize("shard", [4096, 3])
def test_planted_passages(spark, shard):
    docs = planted(7)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(sd.remove_repeats(frame, shard_stretches=shard).drop("kept")) == brute(docs)


def test_windows_of_stretches():
    rng = random.Random(2)
    base = bytes(rng.randrange(97, 100) for _ in range(900))
    stretches = [base[a : a + rng.randrange(200, 380)] for a in range(0, 520, 13)] + [b"x" * 350, base[:200], base[:200]]
    times = Counter()
    for s in stretches:
        times.update(s[i : i + 200] for i in range(len(s) - 199))
    of, masks = sd.repeated_windows(stretches, [1] * len(stretches))
    for s, number in zip(stretches, of):
        assert masks[number].tolist() == [times[s[i : i + 200]] > 1 for i in range(len(s) - 199)]


def test_long_inputs_are_sorted_through_an_index(monkeypatch):
    monkeypatch.setattr(sd, "PLACE_BITS", 4)
    test_windows_of_stretches()


def test_long_texts_in_parts(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh ") for _ in range((1 << sd.HASH_BITS) * 3))
    at = (1 << sd.HASH_BITS) - 150
    docs = [(1, long), (2, "START|" + long[at : at + 320] + "|END"), (3, "|" + long[10:260] + "|")]
    got = {r.doc_id: r for r in sd.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 570 and got[1].n_spans == 2
    assert got[2].n_removed == 320 and bytes(got[2].kept) == b"START||END" and got[3].n_removed == 250


def test_long_texts_that_repeat_themselves(spark):
    n = 5 << 20
    period = "".join(random.Random(1).choice("abcdefgh ") for _ in range(50))
    docs = [(1, "x" * n), (2, period * (n // 50)), (3, "q" * 301 + "START" + period[7:] * 3), (4, "only once " + "y" * 200)]
    got = {r.doc_id: r for r in sd.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).drop("kept").collect()}
    assert got[1].n_removed == n and got[2].n_removed == n // 50 * 50
    assert got[3].n_removed == 301 and got[4].n_removed == 0
    data = np.frombuffer(docs[0][1].encode(), np.uint8)[: 1 << 17]
    text, low, high, _, several = sd._assign(data, np.array([0, len(data)]))
    assert len(text) == 32 and several.all() and (high - low).max() < sd.RUN_WINDOWS


@pytest.mark.parametrize("run", [7, 4096])
def test_runs_in_pieces(spark, monkeypatch, run):
    monkeypatch.setattr(sd, "RUN_WINDOWS", run)
    rng = random.Random(3)
    docs = []
    for i in range(60):
        period = "".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 40, 90, 190, 250])))
        docs.append((i, "".join(rng.choice("abc") for _ in range(rng.randrange(50))) + (period * 500)[: rng.randrange(150, 700)]))
    found = sd.repeated_windows([d.encode() for _, d in docs if len(d) >= 200], [1] * sum(len(d) >= 200 for _, d in docs))
    assert len(found[1]) <= 60
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    if run == 4096:  # pieces of other lengths are not known to tasks
        assert rows_of(sd.remove_repeats(frame).drop("kept")) == brute(docs)
    data = np.frombuffer("".join(d for _, d in docs).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(d) for _, d in docs])
    keep = [k for k in range(60) if bounds[k + 1] - bounds[k] >= 200]
    sizes = np.cumsum([0] + [bounds[k + 1] - bounds[k] for k in keep])
    joined = np.concatenate([data[bounds[k] : bounds[k + 1]] for k in keep])
    text, low, high, short, _ = sd._assign(joined, sizes)
    starts = sorted((t, s) for t, a, b in zip(text, low, high) for s in range(a, b + 1))
    assert starts == [(t, s) for t in range(len(keep)) for s in range(sizes[t + 1] - sizes[t] - 199)]
    by_window = {}
    for t, a, b, h in zip(text, low, high, short):
        for at in range(a, b + 1):
            window = joined[sizes[t] + at : sizes[t] + at + 200].tobytes()
            assert by_window.setdefault(window, h) == h  # equal windows, equal short strings


def test_edges(spark):
    docs = [(None, None), (1, ""), (None, "z" * 300), (2, "q " * 400), (2, "q " * 400), (3, "short")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"runs": F.lit(1), "short": F.lit("x")})
    assert rows_of(sd.remove_repeats(frame).drop("kept")) == brute(docs)
    assert sd.remove_repeats(frame.where("false")).collect() == []
