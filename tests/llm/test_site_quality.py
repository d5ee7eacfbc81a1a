from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries
from tablewright.llm import site_quality as sq


def brute_rates(rows):
    """Posteriors of hosts and paths by the formulas, over (host, path, evidence)."""

    def strength(sites):  # (n, bad, mean)
        total, groups = sum(n for n, _, _ in sites), len(sites)
        spread = sum(n * (b / n - m) ** 2 for n, b, m in sites)
        noise = sum(m * (1 - m) for _, _, m in sites) / groups
        room = noise * (total - sum(n * n for n, _, _ in sites) / total - (groups - 1))
        share = (spread - (groups - 1) * noise) / room if room > 0 else 0.0
        return 1 / min(max(share, 1e-4), 0.9999) - 1

    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for host, path, p in rows:
        for site in (hosts[host], paths[host, path]):
            site[0] += 1
            site[1] += p
    mean = sum(p for *_, p in rows) / len(rows)
    pull = strength([(n, b, mean) for n, b in hosts.values()])
    of_host = {h: (b + pull * mean) / (n + pull) for h, (n, b) in hosts.items()}
    pull = strength([(n, b, of_host[h]) for (h, _), (n, b) in paths.items()])
    return of_host, {(h, q): (b + pull * of_host[h]) / (n + pull) for (h, q), (n, b) in paths.items()}


def test_rates_against_formulas(spark):
    rng = np.random.default_rng(1)
    rows = []
    for h in range(30):
        rate = rng.beta(2, 6)
        for p in range(int(rng.integers(1, 5))):
            for _ in range(int(rng.integers(1, 40))):
                rows.append((f"h{h}" if h else None, f"p{p}" if p else None, float(rng.random() < rate) * 0.9 + 0.05))
    got = sq.site_rates(spark.createDataFrame(rows, "host string, path string, evidence double")).collect()
    hosts, paths = brute_rates(rows)
    assert len(got) == len(paths)
    for r in got:
        assert r.host_rate == pytest.approx(hosts[r._host]) and r.path_rate == pytest.approx(paths[r._host, r._path])
    # Sparse paths lie nearer to their host than their own mean does.
    raw = defaultdict(list)
    for h, p, e in rows:
        raw[h, p].append(e)
    for r in got:
        own = np.mean(raw[r._host, r._path])
        assert abs(r.path_rate - r.host_rate) <= abs(own - r.host_rate) + 1e-12


def test_posterior(spark):
    frame = spark.range(1).select(sq.posterior(F.lit(0.7), 0.2, F.lit(0.4)).alias("p"))
    odds = 0.7 / 0.3 / (0.2 / 0.8) * (0.4 / 0.6)
    assert frame.first().p == pytest.approx(odds / (1 + odds))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = sq.fit(docs, labels.where("doc_id % 2 = 0"))
    found = sq.score(docs, model, F.col("source"), F.col("lang")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = found.collect()
    junk = [r for r in rows if r.quality == 0]
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    assert sum(not r.keep for r in junk) >= 0.9 * len(junk)
    assert sum(r.keep for r in clean) >= 0.98 * len(clean)


def test_query_scores_every_row(spark, tables):
    got = queries.op8_site_quality(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert got.count() == docs.count()
    for r in got.collect():
        assert 0 <= r.bad <= 1 and r.keep == (r.bad < sq.REJECT_FROM)


def test_edges(spark):
    rows = [(1, None, None, None), (2, "", "h", "p"), (None, "x " * 500_000, "h", "p"), (3, "a b", "h", None), (3, "a b", "h", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, _path string").withColumn("evidence", F.lit("x"))
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 1, 1), (3, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    model = sq.fit(docs, labels)
    assert sq.score(docs, model, F.col("host"), F.col("_path")).count() == 5
    kept = sq.kept_documents(docs, model, F.col("host"), F.col("_path"))
    assert kept.columns == docs.columns and kept.count() <= 5
    assert sq.score(docs.where("false"), model, F.col("host"), F.col("_path")).collect() == []
    blank = sq.fit(docs, labels.where("false"))
    assert all(r.keep for r in sq.score(docs, blank, F.col("host"), F.col("_path")).collect())
    assert not math.isnan(sum(r.bad for r in sq.score(docs, blank, F.col("host"), F.col("_path")).collect()))


def test_training_rows_are_bounded_where_an_id_repeats(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(sq, "_regression", lambda rows, truth: seen.append((len(rows), truth.sum())) or np.zeros(rows.shape[1]))
    docs = spark.range(600).selectExpr("IF(id < 500, 7L, id) AS doc_id", "concat('text number ', IF(id < 100, 0, id)) AS text")
    labels = spark.range(600).selectExpr("id AS doc_id", "IF(id = 7, 0, 1) AS quality", "CAST(id % 2 AS INT) AS toxic")
    sq.fit(docs, labels, train_rows=1000)
    # One id with 401 different texts, and a hundred others.
    assert seen[0] == (501, 401)
    seen.clear()
    sq.fit(docs, labels.where("doc_id = 7 OR doc_id >= 500"), train_rows=150)
    assert seen[0] == (150, 50)
    seen.clear()
    model = sq.fit(docs, labels.where("doc_id IN (7, 500)"), train_rows=20)
    assert [n for n, _ in seen] == [20, 20] and abs(model.base - 19 / 20) < 1e-9


def test_query_against_plain_python(spark, tables):
    """Every number of the query from the fitted classifier's evidence, text by text."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = sq.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    rows = docs.select("doc_id", "text", "source", "lang").collect()
    evidence = [float(model.bad([r.text.encode() if r.text else None])[0]) for r in rows]
    host_rate, path_rate = brute_rates([(r.source, r.lang, e) for r, e in zip(rows, evidence)])

    def logit(p):
        p = min(max(p, 1e-9), 1 - 1e-9)
        return math.log(p / (1 - p))

    got = {r.doc_id: r for r in queries.op8_site_quality(spark, tables).collect()}
    assert len(got) == len(rows)
    for r, e in zip(rows, evidence):
        odds = logit(e) - logit(model.base) + logit(path_rate[r.source, r.lang])
        bad, found = 1 / (1 + math.exp(-odds)), got[r.doc_id]
        wanted = (e, host_rate[r.source], path_rate[r.source, r.lang], bad)
        assert all(abs(a - b) < 1e-9 for a, b in zip((found.evidence, found.host_rate, found.path_rate, found.bad), wanted))
        assert found.keep == (bad < sq.REJECT_FROM)
