"""Whitening of embeddings from a spectrum that is built up vector by vector.

A spectrum is a count, a mean and the eigenpairs of the scatter around it. Each task
starts from nothing and takes up its vectors one at a time: a vector is a rank-one
update of the scatter, centred on the mean so far, and the new eigenvalues are the
roots of a secular equation, solved all together between their poles after parts that
do not move are deflated. Spectra are joined the same way, one rank-one update per
eigenpair and one for the distance of the means, eight at a time in rounds. The joined
eigenvectors are a basis of the whole space; a Rayleigh-Ritz step in it, over exactly
centred vectors, gives the components to double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import written
from tablewright.sources.literals import small_frame

#: Fixed values of the grid that entries are rounded down to, and components returned at most.
STEPS, SHIFT = 64, 1_000_000
COMPONENTS = 16

#: Spectra that one task joins at a time.
JOINED = 8
#: Components with less than this part of the first one's variance have none to scale by.
LEAST_PART = 1e-12
#: Entries are kept within this, so that the shift cannot overflow.
MOST_STEP = 1 << 62

_EPS = np.finfo(float).eps
_SPECTRUM = "part int, n long, sums array<string>, mean array<double>, spectrum array<double>, vectors array<double>"
_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z2 / (d - root)) = 0`` for rising, distinct ``d`` and positive ``z2``.

    Each root lies between neighbouring poles, the last within ``rho * sum(z2)`` above the
    last one. Returns the roots and the matrix ``d[j] - root[i]``, which is taken from the
    nearer pole and so keeps its digits. The next guess solves the equation with the
    poles on either side as they are and the rest matched in value and slope; a guess
    outside the bracket is replaced by its middle.
    """
    k = len(d)
    w = rho * z2
    reach = np.append(np.diff(d), w.sum())
    rows = np.arange(k)
    # Which pole is nearer: the sign of the function in the middle tells.
    middle = d + reach / 2
    nearer_low = 1 + (w / (d - middle[:, None])).sum(axis=1) >= 0
    nearer_low[-1] = True
    origin = np.where(nearer_low, rows, np.minimum(rows + 1, k - 1))
    gaps = d - d[origin][:, None]
    low = np.where(nearer_low, 0.0, -reach / 2)
    high = np.where(nearer_low, reach / 2, 0.0)
    high[-1] = reach[-1]
    mu = (low + high) / 2
    below = np.tril(np.ones((k, k)))
    upper = np.minimum(rows + 1, k - 1)
    sides = np.stack([rows, upper])
    for _ in range(80):
        apart = gaps - mu[:, None]
        terms = w / apart
        # Sums over the poles up to a root, which are negative, and over all.
        under, whole = np.einsum("ij,ij->i", terms, below), terms.sum(axis=1)
        f = 1 + whole
        noise = 8 * _EPS * (1 + whole - 2 * under)
        low, high = np.where(f <= 0, mu, low), np.where(f >= 0, mu, high)
        open_ = (np.abs(f) > noise) & (high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if not open_.any():
            break
        terms /= apart
        psi = np.einsum("ij,ij->i", terms, below)
        slope = terms.sum(axis=1)
        left, right = apart[rows, sides]
        c = f - left * psi - right * (slope - psi)
        both = left * right
        a = (left + right) * f - both * slope
        b = both * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = left[-1] * (1 + left[-1] * psi[-1] / (f[-1] - left[-1] * psi[-1]))
            guess = mu + step
        inside = (guess > low) & (guess < high)
        mu = np.where(open_, np.where(inside, guess, (low + high) / 2), mu)
    return d[origin] + mu, gaps - mu[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``vectors @ diag(values) @ vectors.T + rho * v v^T``; ``values`` rise, ``rho`` is not negative.

    Where eigenvalues agree to rounding, a reflection turns their vectors so that one of
    them alone moves; a vector that ``v`` does not touch stays as it is.
    """
    z = vectors.T @ v
    most = rho * (z @ z)
    if not most:
        return values, vectors
    tolerance = 8 * _EPS * max(abs(values[0]), abs(values[-1]), most)
    close = np.diff(values) <= tolerance
    if close.any():
        vectors, starts = vectors.copy(), np.flatnonzero(np.append(True, ~close))
        for start, end in zip(starts, np.append(starts[1:], len(values)), strict=True):
            if end - start > 1:
                part = z[start:end].copy()
                length = np.sqrt(part @ part)
                if length:
                    mirror = part.copy()
                    mirror[-1] += np.copysign(length, part[-1])
                    mirror /= np.sqrt(mirror @ mirror)
                    block = vectors[:, start:end]
                    vectors[:, start:end] = block - 2 * np.outer(block @ mirror, mirror)
                    z[start:end] = 0
                    z[end - 1] = -np.copysign(length, part[-1])
    moves = rho * np.abs(z) * np.sqrt(z @ z) > tolerance
    if not moves.any():
        return values, vectors
    d, zk = values[moves], z[moves]
    roots, apart = secular_roots(d, zk * zk, rho)
    # The vector whose exact roots these are: its eigenvectors are orthogonal whatever the roots' errors.
    spread = d[:, None] - d
    np.fill_diagonal(spread, 1)
    z2 = np.prod(-apart / spread, axis=0) / rho
    turned = np.copysign(np.sqrt(np.maximum(z2, 0)), zk) / apart
    turned /= np.sqrt((turned * turned).sum(axis=1))[:, None]
    moved = vectors[:, moves] @ turned.T
    if moves.all():
        return roots, moved
    joined = np.append(values[~moves], roots)
    order = np.argsort(joined, kind="stable")
    return joined[order], np.hstack([vectors[:, ~moves], moved])[:, order]


class Spectrum(NamedTuple):
    """Count, mean and eigenpairs of the scatter of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of_nothing(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def with_vector(self, x: np.ndarray) -> Spectrum:
        away = x - self.mean
        values, vectors = rank_one(self.values, self.vectors, away, self.n / (self.n + 1))
        return Spectrum(self.n + 1, self.mean + away / (self.n + 1), values, vectors)

    def joined(self, other: Spectrum) -> Spectrum:
        if not self.n or not other.n:
            return self if self.n else other
        values, vectors = self.values, self.vectors
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                values, vectors = rank_one(values, vectors, vector, value)
        n, away = self.n + other.n, other.mean - self.mean
        values, vectors = rank_one(values, vectors, away, self.n * other.n / n)
        return Spectrum(n, self.mean + away * (other.n / n), values, vectors)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column as a matrix of one row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _row(part: int, s: Spectrum, sums: list[int]) -> pa.RecordBatch:
    values = [[part], [s.n], [[str(x) for x in sums]], [s.mean], [s.values], [s.vectors.ravel()]]
    doubles = pa.list_(pa.float64())
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.string()), doubles, doubles, doubles]
    names = [c.split()[0] for c in _SPECTRUM.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)


def _total(x: np.ndarray) -> list[int]:
    """Exact sums of the columns: high and low halves are summed apart, so neither overflows."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)]


def _builder(size: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = Spectrum.of_nothing(size), [0] * size
        for batch in batches:
            x = _matrix(batch.column(0), size)
            sums = [a + b for a, b in zip(sums, _total(x), strict=True)]
            # From the grid's middle, so that means keep their digits.
            for row in (x - SHIFT).astype(float):
                held = held.with_vector(row)
        if held.n:
            yield _row(TaskContext.get().partitionId(), held, sums)

    return build


def _joiner(size: int):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.to_pylist():
                held, sums = Spectrum.of_nothing(size), [0] * size
                for r in group["spectra"]:
                    vectors = np.array(r["vectors"]).reshape(size, size)
                    held = held.joined(Spectrum(r["n"], np.array(r["mean"]), np.array(r["spectrum"]), vectors))
                    sums = [a + int(b) for a, b in zip(sums, r["sums"], strict=True)]
                yield _row(group["group"], held, sums)

    return join


def spectrum_of(fit: DataFrame, size: int) -> tuple[Spectrum, list[int]] | None:
    """The spectrum of ``x``, arrays of ``size`` longs, and their exact sums; None without rows.

    What reaches the driver is one spectrum.
    """
    now = written(fit.select("x").mapInArrow(_builder(size), _SPECTRUM), "spectra").table
    while now.count() > 1:
        groups = now.groupBy(F.expr(f"part div {JOINED}").cast("int").alias("group")).agg(
            F.sort_array(F.collect_list(F.struct("part", "n", "sums", "mean", "spectrum", "vectors"))).alias("spectra")
        )
        now = written(groups.mapInArrow(_joiner(size), _SPECTRUM), "spectra").table
    row = now.first()
    if row is None:
        return None
    vectors = np.array(row["vectors"]).reshape(size, size)
    spectrum = Spectrum(row["n"], np.array(row["mean"]), np.array(row["spectrum"]), vectors)
    return spectrum, [int(s) for s in row["sums"]]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray | None]:
    """``x - sums / n``, and ``n * x - sums`` where 64 bits hold it."""
    top = max([abs(int(x.min())), abs(int(x.max())), *(abs(s) // n + 1 for s in sums)]) if x.size else 0
    if 2 * n * top < 1 << 63:
        whole = n * x - np.array(sums, dtype=np.int64)
        return whole / n, whole
    centre = [divmod(s, n) for s in sums]
    return (x - np.array([q for q, _ in centre], dtype=np.int64)) - np.array([r / n for _, r in centre]), None


def _product_of(size: int, n: int, sums: list[int], basis: np.ndarray):
    """The function that gives each task's sums of ``y`` and of ``y y^T``, y the centred vectors along a basis."""
    width = basis.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product, line = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            y = _centred(_matrix(batch.column(0), size), n, sums)[0] @ basis
            product += y.T @ y
            line += y.sum(axis=0)
        entries = np.append(product.ravel(), line)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(entries)), pa.int32()), pa.array(entries)], names=["entry", "value"])

    return multiply


def covariance(fit: DataFrame, n: int, sums: list[int], basis: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the vectors ``x`` along the basis' columns, centred before they are multiplied.

    Tasks send one sum per entry; entries are added up by Spark.
    """
    size, width = basis.shape
    parts = fit.select("x").mapInArrow(_product_of(size, n, sums, basis), "entry int, value double")
    total = np.zeros(width * width + width)
    for entry, value in parts.groupBy("entry").agg(F.sum("value")).collect():
        total[entry] = value
    product, mean = total[:-width].reshape(width, width) / n, total[-width:] / n
    return product - np.outer(mean, mean)


class Whitening(NamedTuple):
    """Unit components by falling variance, as columns, of ``n`` vectors with sums ``sums``."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit_whitening(fit: DataFrame, size: int, most: int = COMPONENTS) -> Whitening | None:
    """Components of the rows ``x`` of ``fit``; None without rows or without any variance.

    A component with (next to) no variance is left out, as nothing can be scaled by it.
    A component's largest entry is positive. Matrices of ``size`` by ``size`` are held by
    every task and the driver; nothing else grows with the vectors' length, and nothing
    with their number.
    """
    found = spectrum_of(fit, size)
    if found is None:
        return None
    spectrum, sums = found
    basis = np.linalg.qr(spectrum.vectors)[0]
    inner = covariance(fit, spectrum.n, sums, basis)
    values, turned = np.linalg.eigh((inner + inner.T) / 2)
    whole = values.sum()
    kept = [i for i in range(size - 1, -1, -1) if values[i] > LEAST_PART * values[-1] and values[-1] > 0][:most]
    if not kept:
        return None
    components = basis @ turned[:, kept]
    components *= np.sign(components[np.abs(components).argmax(axis=0), np.arange(len(kept))])
    variances = values[kept]
    error = np.abs(covariance(fit, spectrum.n, sums, components / np.sqrt(variances)) - np.eye(len(kept))).max()
    return Whitening(spectrum.n, sums, variances, components, variances / whole, float(error))


def _whitener(w: Whitening):
    size, width = w.components.shape
    scaled = w.components / np.sqrt(w.variances)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), size)
            rows = len(x)
            if not rows:
                continue
            centred, whole = _centred(x, w.n, w.sums)
            fits = whole is not None and size * int(np.abs(whole).max()) ** 2 < 1 << 63
            if fits:
                deviation = pa.array(np.repeat((whole * whole).sum(axis=1), width))
            else:
                exact = [sum((w.n * int(a) - s) ** 2 for a, s in zip(r, w.sums, strict=True)) for r in x]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact for _ in range(width)], pa.int64())
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), width))),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * width, w.n)),
                deviation,
                pa.array((centred @ scaled).ravel()),
                pa.array(np.tile(w.explained, rows)),
                pa.array(np.full(rows * width, w.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")])

    return whiten


def gridded(docs: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows ``vec_id`` and ``x``: the entries as whole steps of the grid; vectors with a gap are left out."""

    def finite(entry: Column) -> Column:
        return entry.isNotNull() & ~F.isnan(entry) & (F.abs(entry) < F.lit(float("inf")))

    def step(entry: Column) -> Column:
        return F.greatest(F.lit(-MOST_STEP), F.least(F.lit(MOST_STEP), F.floor(entry * STEPS))) + SHIFT

    vectors = docs.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    whole = F.col("vector").isNotNull() & F.forall("vector", finite)
    return vectors.where(whole).select("vec_id", F.transform("vector", step).alias("x"))


def whiten(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row for each row of ``docs`` and component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null, empty or holds null or non-finite entries are left out,
    as are those of another length than most (the longer of two equally common ones).
    The fit takes each distinct vector once, so copies, however many, change nothing;
    they are reduced per task before they are shuffled. Repeated rows and rows without
    an id get rows of their own. Without variance (an empty table, one distinct
    vector) the result is empty; with fewer dimensions than ``most`` it has fewer
    components. ``deviation`` is null where a long cannot hold it. Other columns are
    not read, whatever they are called.
    """
    held = written(gridded(docs, id_col, vector_col), "vectors").table
    sizes = held.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("rows"))
    commonest = sizes.where("size > 0").orderBy(F.desc("rows"), F.desc("size")).first()
    nothing = small_frame(docs.sparkSession, [], _RESULT)
    if commonest is None:
        return nothing
    held = held.where(F.size("x") == commonest["size"])
    fit = written(held.select("x").distinct(), "fit").table
    whitening = fit_whitening(fit, commonest["size"], most)
    return nothing if whitening is None else held.mapInArrow(_whitener(whitening), _RESULT)
