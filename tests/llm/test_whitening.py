from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries, whitening
from tablewright.llm.whitening import Spectrum, rank_one, secular_roots

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, most=16):
    """Components by one dense decomposition; rows of (vec_id, vector)."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    fit = np.array(sorted(set(map(tuple, x))), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    out = []
    for (vec_id, _), row in zip(kept, x):
        off = n * np.array(row, dtype=np.int64) - sums
        out.append((vec_id, int((off * off).sum()), (off / n) @ vectors[:, :k] / np.sqrt(values[:k])))
    return n, values[:k] / values.sum(), out


def check(got, rows):
    n, explained, want = brute(rows)
    k = len(explained)
    assert len(got) == len(want) * k
    by_component = {}
    for r in got:
        assert r.n == n and 1 <= r.component <= k
        assert abs(r.explained - explained[r.component - 1]) <= 1e-10 * explained[r.component - 1]
        assert r.identity_error <= 1e-9
        by_component.setdefault(r.component, []).append((str(r.vec_id), r.deviation, r.whitened))
    for c, found in by_component.items():
        wanted = [(str(i), dev, w[c - 1]) for i, dev, w in want]
        assert Counter(f[:2] for f in found) == Counter(w[:2] for w in wanted)
        found, wanted = sorted(found, key=lambda t: t[:2]), sorted(wanted, key=lambda t: t[:2])
        a, b = np.array([f[2] for f in found]), np.array([w[2] for w in wanted])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7


def test_query(spark, tables):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    check(queries.op13_embedding_whitening(spark, tables).collect(), rows)


def vectors(n, size, seed=3):
    rng = np.random.default_rng(seed)
    spread = rng.normal(size=(size, size)) * np.linspace(0.2, 2, size)
    return (rng.normal(size=(n, size)) @ spread).astype(np.float32).tolist()


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(whitening, "JOINED", 2)
    inf, nan = float("inf"), float("nan")
    many = vectors(300, 20)
    rows = [(i, v) for i, v in enumerate(many)] + [(1000 + i, many[7]) for i in range(150)] + [(5, many[5]), (None, many[6])]
    rows += [(2000, None), (2001, []), (2002, [nan] + many[0][1:]), (2003, [inf] + many[0][1:]), (2004, [None] + many[0][1:])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(7)
    for name in ("x", "vector", "n", "part", "size"):
        frame = frame.withColumn(name, F.lit("clash"))
    check(whitening.whiten(frame).collect(), rows)
    # Another length than most is left out; the longer of two lengths on a tie.
    odd = spark.createDataFrame([(3000, many[0][:4], 0)], SCHEMA)
    check(whitening.whiten(frame.unionByName(odd, allowMissingColumns=True)).collect(), rows)
    tie = spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0), (3, [5.0], 0), (4, [7.0, -2.0], 0)], SCHEMA)
    assert {r.vec_id for r in whitening.whiten(tie).collect()} == {2, 4}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_no_variance_no_rows(spark, rows):
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    assert got.columns == "vec_id component n deviation whitened explained identity_error".split() and got.collect() == []


def test_fewer_components_than_asked_for(spark):
    flat = [(i, [float(i), 2.0 * i, 3.0, float(i % 5)]) for i in range(40)]  # two dimensions at most
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in flat], SCHEMA)).collect()
    check(got, flat)
    assert {r.component for r in got} == {1, 2}


def test_huge_entries(spark):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [0.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert {r.deviation for r in got} == {None} or all(r.deviation is None for r in got if r.vec_id < 2)
    assert all(math.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("seed", range(5))
def test_secular_roots(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 40))
    d = np.sort(rng.normal(size=k)) * 10.0 ** rng.integers(-3, 4)
    d = d + np.arange(k) * 1e-3 * np.ptp(d if k > 1 else [0, 1])
    z, rho = rng.normal(size=k) * 10.0 ** rng.uniform(-4, 1, k), float(rng.uniform(0.1, 5))
    roots, apart = secular_roots(d, z * z, rho)
    exact = np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z))
    assert np.allclose(roots, exact, rtol=1e-12, atol=1e-12 * np.abs(exact).max())
    assert np.allclose(apart, d - roots[:, None], atol=1e-9 * np.abs(exact).max())


@pytest.mark.parametrize("case", ["plain", "equal", "zero", "same direction", "near equal", "graded"])
def test_rank_one_with_deflation(case):
    rng = np.random.default_rng(9)
    size = 24
    vectors = np.linalg.qr(rng.normal(size=(size, size)))[0]
    values, v = np.sort(rng.uniform(0, 9, size)), rng.normal(size=size)
    if case == "equal":
        values = np.sort(np.repeat([1.0, 4.0, 7.0], 8))
    elif case == "zero":
        values = np.zeros(size)
    elif case == "same direction":
        v = vectors[:, 3] * 2.5
    elif case == "near equal":
        values = 1 + np.arange(size) * 1e-15
    elif case == "graded":
        values = 10.0 ** np.arange(-18, 6)
    got, turned = rank_one(values, vectors, v, 0.7)
    whole = vectors * values @ vectors.T + 0.7 * np.outer(v, v)
    scale = np.abs(whole).max()
    assert (np.diff(got) >= -1e-12 * scale).all()
    assert np.abs(turned.T @ turned - np.eye(size)).max() < 1e-12
    assert np.abs(turned * got @ turned.T - whole).max() < 1e-12 * scale


def test_spectra_by_vectors_and_joined():
    x = np.array(vectors(400, 12))
    whole, parts = Spectrum.of_nothing(12), []
    for k, row in enumerate(x):
        whole = whole.with_vector(row)
        if k % 130 == 0:
            parts.append(Spectrum.of_nothing(12))
        parts[-1] = parts[-1].with_vector(row)
    joined = Spectrum.of_nothing(12)
    for p in parts:
        joined = joined.joined(p)
    centred = x - x.mean(axis=0)
    exact = np.linalg.eigvalsh(centred.T @ centred)
    for s in (whole, joined):
        assert s.n == 400 and np.allclose(s.mean, x.mean(axis=0))
        assert np.allclose(s.values, exact, rtol=1e-10)
        assert np.abs(s.vectors.T @ s.vectors - np.eye(12)).max() < 1e-11


def test_exact_sums():
    big = np.array([[1 << 62, -(1 << 62)]] * 9, dtype=np.int64)
    assert whitening._total(big) == [9 << 62, -(9 << 62)]
