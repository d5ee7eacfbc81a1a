"""Quality of documents from their text and from the sites they lie on.

A document classifier, fitted on a bounded sample of labelled rows, gives each
document a probability of being bad (junk or toxic). Hosts and the paths below them
get posteriors by empirical Bayes: a host's mean is drawn towards the global one
and a path's towards its host's, the more so the fewer documents it has, with
strengths estimated from the spread between hosts and paths. A document's final
odds are its own evidence times the odds of its path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.shared import word_chunks, written

#: Labelled rows the classifier is fitted on at most (the least by a hash of the id).
TRAIN_ROWS = 20_000
#: Telling words per kind of badness, and the documents one must be in.
TELLING_WORDS, LEAST_DOCS = 128, 3
#: Bytes of a word's beginnings, which may tell where its endings vary.
STEM_BYTES = (4, 6)
#: Likelihood ratio statistic that a telling word must reach.
LEAST_G2 = 15.0
PENALTY = 0.3
#: A document is rejected from this probability of being bad on; a little under even,
#: as a bad document kept does more harm than a clean one lost.
REJECT_FROM = 0.4

KINDS = ("junk", "toxic")
_MARKS = b"!#$%&*+<=>@^_`{|}~"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS, _HIGH = b"0123456789", bytes(range(128, 256))
_EDGES = b".,;:!?\"'()[]#$%&*|"


def _shape(data: bytes) -> list[float]:
    """Numbers about a text's form."""
    size = len(data)
    words = same = pairs = distinct = length = 0
    for part in word_chunks(data, lower=False):
        words += len(part)
        length += sum(map(len, part))
        same += sum(map(eq, part, part[1:]))
        pairs += len(set(zip(part, part[1:], strict=False)))
        distinct += len(set(part))

    def share(characters: bytes) -> float:
        return (size - len(data.translate(None, characters))) / max(1, size)

    upper, lower, high = share(_UPPER), share(_LOWER), share(_HIGH)
    lines = [x for x in data.split(b"\n") if x]
    shouted = upper / max(1e-9, upper + lower + high)
    marks, again = share(_MARKS), same / max(1, words)
    old_pairs = 1 - pairs / max(1, words - 1) if words > 1 else 0.0
    return [
        math.log1p(words),
        shouted,
        marks,
        share(_DIGITS),
        again,
        old_pairs,
        1 - distinct / max(1, words),
        1 - len(set(lines)) / max(1, len(lines)),
        length / max(1, words),
        high,
        math.sqrt(shouted),
        math.sqrt(marks),
        math.sqrt(again),
        math.sqrt(max(0.0, old_pairs)),
        float(words == 0),
    ]


def _vocabulary(data: bytes) -> set[bytes]:
    """The text's words without punctuation at the ends, and the beginnings of the longer ones."""
    found: set[bytes] = set()
    for part in word_chunks(data):
        found.update(part)
    words = {w.strip(_EDGES) for w in found}
    return words | {w[:n] + b"*" for n in STEM_BYTES for w in words if len(w) > n}


class Model(NamedTuple):
    """Weights of one classifier per kind over form and telling words, and base odds."""

    words: dict[bytes, int]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # a column per kind, the last row for the intercept
    base: float

    def bad(self, texts: list[bytes | None]) -> np.ndarray:
        """The probability of each text being bad in any way."""
        rows = np.zeros((len(texts), len(self.weights)))
        rows[:, -1] = 1
        forms = len(self.centre)
        for i, data in enumerate(texts):
            rows[i, :forms] = _shape(data or b"")
            told = _vocabulary(data or b"").intersection(self.words)
            rows[i, [forms + self.words[w] for w in told]] = 1
        rows[:, :forms] = (rows[:, :forms] - self.centre) / self.scale
        logits = np.clip(rows @ self.weights, -30, 30)
        return 1 - np.prod(1 / (1 + np.exp(logits)), axis=1)


def _g2(hits: Column, rows: Column, of_kind: float, total: float) -> Column:
    """Likelihood ratio of a word's share among one kind against the others."""
    expected = rows * (of_kind / total)
    others = rows - hits

    def term(seen: Column, hoped: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / hoped)).otherwise(0.0)

    value = 2 * (term(hits, expected) + term(others, rows - expected))
    return F.when(hits > expected, value).otherwise(0.0)


def _emit_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        sets = [sorted(_vocabulary(t or b"") - {b""}) for t in texts]
        words = [w for s in sets for w in s]
        sizes = [len(s) for s in sets]
        kinds = [np.repeat(batch.column(i).to_numpy(zero_copy_only=False), sizes) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), *[pa.array(k, pa.int32()) for k in kinds]],
            names=["word", *KINDS],
        )


def _regression(rows: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge penalty, by Newton's method."""
    weights = np.zeros(rows.shape[1])
    ridge = np.full(rows.shape[1], PENALTY)
    ridge[-1] = 1e-6
    for _ in range(40):
        odds = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (odds - truth) + ridge * weights
        bend = (rows * (odds * (1 - odds))[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _bounded(labelled: DataFrame, most: int) -> DataFrame:
    """``most`` of the rows, each distinct by ``_id`` and ``_print``; all ids' first rows come before others.

    Ids and hashes alone are ordered, and at most ``most`` of them sent to the tasks.
    """
    firsts = labelled.groupBy("_id").agg(F.min("_print").alias("_first"))
    picked = (
        labelled.select("_id", "_print")
        .join(firsts, "_id")
        .orderBy(F.col("_print") != F.col("_first"), F.xxhash64("_id", "_print"), "_id", "_print")
        .limit(most)
        .select("_id", "_print")
    )
    return labelled.join(F.broadcast(picked), ["_id", "_print"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Fit the document classifier on at most ``train_rows`` labelled rows.

    ``labels`` holds ``doc_id``, ``quality`` (0 is junk) and ``toxic`` (1 is toxic);
    rows with a null are left out, and of labels that contradict each other the bad
    one counts. Repeated rows of a document (same id, same text) are one row. Which
    rows are taken depends on ids and texts alone: a text of each labelled id comes
    before further texts of any. Without labelled rows, or with rows of one kind
    only, that kind's probability is constant.
    """
    wanted = (
        labels.select(
            F.col("doc_id").cast("long").alias("_of"),
            (F.col("quality") == 0).cast("int").alias("junk"),
            (F.col("toxic") == 1).cast("int").alias("toxic"),
        )
        .dropna()
        .groupBy("_of")
        .agg(F.max("junk").alias("junk"), F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("_of"), "_of")
        .limit(train_rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    # At most train_rows rows of three numbers.
    labelled = texts.join(F.broadcast(wanted), F.col("_id") == F.col("_of"))
    labelled = labelled.select("_id", F.xxhash64("text").alias("_print"), "text", *KINDS)
    labelled = written(labelled.dropDuplicates(["_id", "_print"]), "labelled").table
    if labelled.count() > train_rows:
        labelled = written(_bounded(labelled, train_rows), "bounded").table
    sample = labelled.select("text", *KINDS)
    counts = sample.agg(F.count("*"), *[F.sum(k) for k in KINDS]).first()
    total, of_kind = counts[0], [c or 0 for c in counts[1:]]
    forms = len(_shape(b""))
    if not total:
        return Model({}, np.zeros(forms), np.ones(forms), np.zeros((forms + 1, 2)) - 20.0 * np.eye(forms + 1)[:, -1:], 1e-6)
    stats = sample.mapInArrow(_emit_words, "word binary, junk int, toxic int")
    stats = stats.groupBy("word").agg(F.count("*").alias("rows"), *[F.sum(k).alias(k) for k in KINDS])
    chosen: dict[bytes, int] = {}
    scores = [
        _g2(F.col(k).cast("double"), F.col("rows").cast("double"), max(n, 0.5), total).alias(f"g_{k}")
        for k, n in zip(KINDS, of_kind, strict=True)
    ]
    telling = written(
        stats.where(F.col("rows") >= LEAST_DOCS).select("word", *scores).where(
            f"g_junk >= {LEAST_G2} or g_toxic >= {LEAST_G2}"
        ),
        "telling",
    ).table
    for k in KINDS:
        best = telling.where(F.col(f"g_{k}") >= LEAST_G2).orderBy(F.desc(f"g_{k}"), "word").limit(TELLING_WORDS)
        for row in best.collect():
            chosen.setdefault(bytes(row["word"]), len(chosen))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            told = [sorted(chosen[w] for w in _vocabulary(t).intersection(chosen)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([_shape(t) for t in texts], pa.list_(pa.float64())),
                    pa.array(told, pa.list_(pa.int32())),
                ],
                names=[*KINDS, "form", "told"],
            )

    # Bounded by the number of labelled rows, the form's numbers and the telling words.
    seen = sample.mapInArrow(measure, "junk int, toxic int, form array<double>, told array<int>").collect()
    rows = np.zeros((len(seen), forms + len(chosen) + 1))
    rows[:, -1] = 1
    for i, r in enumerate(seen):
        rows[i, :forms] = r["form"]
        rows[i, [forms + t for t in r["told"]]] = 1
    centre, scale = rows[:, :forms].mean(axis=0), np.maximum(rows[:, :forms].std(axis=0), 1e-3)
    rows[:, :forms] = (rows[:, :forms] - centre) / scale
    weights = []
    for k, n in zip(KINDS, of_kind, strict=True):
        if 0 < n < total:
            weights.append(_regression(rows, np.array([r[k] for r in seen], float)))
        else:
            constant = np.zeros(rows.shape[1])
            constant[-1] = 20.0 if n else -20.0
            weights.append(constant)
    bad = np.mean([r["junk"] or r["toxic"] for r in seen])
    return Model(chosen, centre, scale, np.stack(weights, axis=1), float(np.clip(bad, 1e-6, 1 - 1e-6)))


def evidence_of(model: Model):
    """A column function: the classifier's probability of a text being bad."""

    @F.pandas_udf(T.DoubleType())
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series(model.bad([t.encode() if t else None for t in texts]))

    return evidence


def _strength(sites: DataFrame, mean: Column) -> float:
    """How many documents a parent's mean is worth, by the spread of the sites' means around it.

    Method of moments: the squared deviations beyond what sampling alone makes.
    """
    between = sites.select(
        F.col("n"), mean.alias("mu"), (F.col("bad") / F.col("n")).alias("rate")
    ).agg(
        F.sum(F.col("n") * (F.col("rate") - F.col("mu")) ** 2),
        F.avg(F.col("mu") * (1 - F.col("mu"))),
        F.count("*"),
        F.sum("n"),
        F.sum(F.col("n").cast("double") ** 2),
    ).first()
    spread, noise, sites_n, rows, squares = (float(x or 0) for x in between)
    room = noise * (rows - squares / max(rows, 1.0) - (sites_n - 1))
    share = (spread - (sites_n - 1) * noise) / room if room > 0 else 0.0
    share = min(max(share, 1e-4), 0.9999)
    return 1 / share - 1


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.log(p / (1 - p))


def posterior(evidence: Column, base: float, path_rate: Column) -> Column:
    """Probability of being bad: odds of the evidence against the base, times the path's odds."""
    odds = _logit(evidence) - _logit(F.lit(base)) + _logit(path_rate)
    return 1 / (1 + F.exp(-odds))


def site_rates(scored: DataFrame) -> DataFrame:
    """Rows ``_host``, ``_path``, ``host_rate``, ``path_rate`` from ``host``, ``path``, ``evidence``.

    Sums are taken per task before the shuffle, so a hot site is one row a task.
    The table is written: its size is then known, and Spark sends it to the tasks
    whole only where it is small.
    """
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("bad"))
    paths = written(paths, "paths").table
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = hosts.agg(F.sum("bad"), F.sum("n")).first()
    overall = min(max((whole[0] or 0.0) / max(1, whole[1] or 0), 1e-6), 1 - 1e-6)
    pull = _strength(hosts, F.lit(overall))
    hosts = hosts.select(
        F.col("host").alias("_host"),
        ((F.col("bad") + pull * overall) / (F.col("n") + pull)).alias("host_rate"),
    )
    below = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    pull = _strength(below, F.col("host_rate"))
    rates = below.select(
        F.col("host").alias("_host"),
        F.col("path").alias("_path"),
        "host_rate",
        ((F.col("bad") + pull * F.col("host_rate")) / (F.col("n") + pull)).alias("path_rate"),
    )
    return written(rates, "rates").table


def _evidence(docs: DataFrame, model: Model, host: Column, path: Column, text_col: str, *kept: Column) -> DataFrame:
    return docs.select(
        *kept,
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        evidence_of(model)(F.col(text_col).cast("string")).alias("evidence"),
    )


def _at_site() -> Column:
    return F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))


def score(
    docs: DataFrame,
    model: Model,
    host: Column,
    path: Column,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Rows ``doc_id``, ``evidence``, ``host_rate``, ``path_rate``, ``bad`` and ``keep``.

    One row per document. ``evidence`` is the classifier's probability of being bad,
    the rates are the posteriors of its host and path, ``bad`` joins them:
    odds(evidence) / odds(base rate) * odds(path rate). ``keep`` is false from
    ``REJECT_FROM`` on.
    Texts are judged whole, however long; other columns are not read, whatever they are called.
    A null host or path is a site like any other. A null or empty text is judged by
    its form like any text. Repeated rows count each, and get a row each; an empty
    table gives an empty result.
    """
    named = F.col(id_col).cast("long").alias("doc_id")
    scored = written(_evidence(docs, model, host, path, text_col, named), "evidence").table
    joined = scored.join(site_rates(scored), _at_site())
    bad = posterior(F.col("evidence"), model.base, F.col("path_rate"))
    return joined.select("doc_id", "evidence", "host_rate", "path_rate", bad.alias("bad")).withColumn(
        "keep", F.col("bad") < REJECT_FROM
    )


def kept_documents(
    docs: DataFrame, model: Model, host: Column, path: Column, text_col: str = "text"
) -> DataFrame:
    """The documents that :func:`score` keeps, row by row, with their columns."""
    scored = written(_evidence(docs, model, host, path, text_col), "evidence").table
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = _evidence(docs, model, host, path, text_col, whole).join(site_rates(scored), _at_site())
    bad = posterior(F.col("evidence"), model.base, F.col("path_rate"))
    return judged.where(bad < REJECT_FROM).select("row.*")
