"""Embedding whitening: leading components of the covariance by spectrum slicing.

Vectors are quantised (``x = floor(scale * c) + shift``), so counts, sums and products
are whole numbers and every sum over the table is exact, in any order of rows and on any
number of tasks. The covariance is summed about the whole number next below the mean,
and the rest of the mean is taken out exactly afterwards.

Its leading eigenvalues are found one by one by inertia: an LDLᵀ factorisation of
``V - s I`` (symmetric pivots of order one and two) counts the eigenvalues above ``s``, and
halving keeps the interval that holds the k-th one until nothing else lies in it. There
Rayleigh quotient iteration takes over; a result outside of the interval is thrown away and
the interval halved again. At the end two counts, just below and just above each
eigenvalue, certify its number. Eigenvalues that no double tells apart are one cluster; their
eigenvectors are any orthonormal basis of the common space.

Only sums of the dimension's square go to the driver, nothing that grows with the rows.

Defined cases: a NULL vector, one with a NULL or non-finite entry, an entry of 2**40 or more in size,
an empty vector and one of another length than most (ties: the shorter length) are left
out; a NULL ``vec_id`` stays; repeated rows count each time and return each time; components past the
rank of the covariance don't exist and have no rows, so a table whose vectors are all equal gives
none; so does an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_package

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
LARGEST = 2.0**40  # entries from this size on count as not finite
EXACT = 2.0**53  # whole numbers below it are exact in a double
STEP_ROWS = 2048  # rows of one product, and of one piece of the output


# ------------------------------------------------------------------ rows


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a batch as doubles, the first entry of each row, and its length (-1: row is left out)."""
    column = batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    first = np.cumsum(lengths) - lengths
    with np.errstate(invalid="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(flat) < LARGEST))])
    ok = (lengths > 0) & (bad[first + lengths] == bad[first])
    return flat, first, np.where(ok, lengths, -1)


def _whole(flat: np.ndarray, first: np.ndarray, dim: int, scale: int, shift: int) -> np.ndarray:
    """Quantised vectors of the rows that begin at ``first``."""
    return np.floor(scale * flat[first[:, None] + np.arange(dim)]).astype(np.int64) + shift


def _decimals(values: Iterable[int]) -> pa.Array:
    return pa.array([int(v) for v in values], pa.decimal128(38, 0))


def _sums(batches: Iterable[pa.RecordBatch], scale: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Per length of vector: number of rows and exact sum of every dimension."""
    totals: dict[int, list] = {}
    for batch in batches:
        flat, first, lengths = _vectors(batch)
        for dim in np.unique(lengths[lengths > 0]).tolist():
            mine = first[lengths == dim]
            held = totals.setdefault(dim, [0, np.zeros(dim, object)])
            for k in range(0, len(mine), STEP_ROWS):
                held[1] += _whole(flat, mine[k : k + STEP_ROWS], dim, scale, shift).sum(axis=0).astype(object)
            held[0] += len(mine)
    for dim, (n, total) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), _decimals(total)],
            names=["dim", "i", "n", "total"],
        )


def _product(d: np.ndarray) -> np.ndarray:
    """``dᵀ d`` of whole numbers, exact."""
    size = float(np.abs(d).max(initial=0))
    if size * size >= EXACT:
        wide = d.astype(object)
        return wide.T @ wide
    rows = int(min(len(d), max(1, EXACT // max(1.0, size * size))))
    out = np.zeros((d.shape[1], d.shape[1]), object)
    for k in range(0, len(d), rows):
        part = d[k : k + rows].astype(float)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _products(batches: Iterable[pa.RecordBatch], centre: np.ndarray, scale: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Sums of products of the centred dimensions, upper triangle."""
    dim = len(centre)
    total, seen = np.zeros((dim, dim), object), False
    for batch in batches:
        flat, first, lengths = _vectors(batch)
        mine = first[lengths == dim]
        for k in range(0, len(mine), STEP_ROWS):
            total += _product(_whole(flat, mine[k : k + STEP_ROWS], dim, scale, shift) - centre)
            seen = True
    if seen:
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(total[i, j])], names=["i", "j", "total"]
        )


# ------------------------------------------------------------------ spectrum of a symmetric matrix


def above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues greater than ``shift``: positive inertia of LDLᵀ of ``matrix - shift I``.

    Bunch and Kaufman's choice of pivots of order one and two; a pivot of order two has one
    eigenvalue of each sign.
    """
    a = np.array(matrix, float)
    a[np.diag_indices_from(a)] -= shift
    bound = (1 + 17**0.5) / 8
    nothing = 1e-20 * np.abs(a).max(initial=0.0)  # far below rounding: a pivot of zero
    k, n, positive = 0, len(a), 0
    while k < n:
        size = 1
        column = np.abs(a[k + 1 :, k])
        most = column.max(initial=0.0)
        if max(abs(a[k, k]), most) <= nothing:
            k += 1
            continue
        if abs(a[k, k]) < bound * most:
            r = k + 1 + int(column.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            other = row.max()
            if abs(a[k, k]) * other < bound * most * most:
                size = 1 if abs(a[r, r]) >= bound * other else 2
                to = k + size - 1
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        rest = a[k + size :, k : k + size]
        if size == 1:
            positive += a[k, k] > 0
            a[k + 1 :, k + 1 :] -= np.outer(rest[:, 0], rest[:, 0] / a[k, k])
        else:
            positive += 1
            p, q, r = a[k, k], a[k + 1, k], a[k + 1, k + 1]
            inverse = np.array([[r, -q], [-q, p]]) / (p * r - q * q)
            taken = rest @ inverse @ rest.T
            a[k + 2 :, k + 2 :] -= (taken + taken.T) / 2
        k += size
    return int(positive)


class Spectrum:
    """Counts of eigenvalues above shifts of one matrix; every count narrows later searches too."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        radius = np.abs(matrix).sum(axis=1)
        self.size = float(radius.max(initial=0.0))
        self.tolerance = 8 * np.finfo(float).eps * len(matrix) * self.size
        edge = self.size + self.tolerance
        self.counts = {-edge: len(matrix), edge: 0}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """Shifts with at least k eigenvalues above the first and fewer above the second, as close as known."""
        low = max(s for s, c in self.counts.items() if c >= k)
        return low, min(s for s, c in self.counts.items() if c < k and s > low)

    def isolate(self, k: int) -> tuple[float, float]:
        """Halve the interval of the k-th eigenvalue until it stands alone, or until doubles end."""
        while True:
            low, high = self.interval(k)
            middle = low + (high - low) / 2
            alone = self.above(low) == k and self.above(high) == k - 1
            if alone or high - low <= self.tolerance or middle in (low, high):
                return low, high
            self.above(middle)

    def certain(self, k: int, value: float) -> bool:
        """Whether ``value`` is the k-th eigenvalue: fewer than k stand above it, k or more above what lies just below."""
        slack = 2 * self.tolerance
        return self.above(value + slack) < k <= self.above(value - slack)


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, nudge: float) -> np.ndarray:
    """``(matrix - shift I)⁻¹ right``; a shift that is an eigenvalue to the last bit is moved by ``nudge``."""
    for _ in range(60):
        try:
            out = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
            if np.isfinite(out).all():
                return out
        except np.linalg.LinAlgError:
            pass
        shift, nudge = shift + nudge, 2 * nudge
    raise ArithmeticError("no shift near the eigenvalue can be solved for")


def _rayleigh(matrix: np.ndarray, start: float, near: np.ndarray, nudge: float, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from a shift; ``near`` are the vectors of close eigenvalues found before."""

    draw = np.random.default_rng(seed)

    def unit(v):
        v = v / (np.abs(v).max() or 1.0)  # no overflow in the norm
        for _ in range(2):
            v = v - near @ (near.T @ v)
        size = np.linalg.norm(v)
        return v / size if size > 0 and np.isfinite(size) else unit(draw.standard_normal(len(matrix)))

    v = unit(draw.standard_normal(len(matrix)))
    for _ in range(2):  # towards the eigenvalue next to the shift
        v = unit(_solve(matrix, start, v, nudge))
    best = (np.inf, start, v)
    for _ in range(24):
        value = float(v @ matrix @ v)
        off = float(np.linalg.norm(matrix @ v - value * v))
        if off >= best[0]:
            break
        best = (off, value, v)
        v = unit(_solve(matrix, value, v, nudge))
    return best[1], best[2]


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns.

    Eigenvalues that are zero to the precision of doubles are left out.
    """
    dim = len(matrix)
    values, vectors = [], np.zeros((dim, 0))
    size = np.abs(matrix).max(initial=0.0)
    if size == 0:
        return np.array(values), vectors
    matrix = matrix / size
    spectrum = Spectrum(matrix)
    while len(values) < min(components, dim):
        k = len(values) + 1
        low, high = spectrum.isolate(k)
        if high <= 2 * spectrum.tolerance:
            break
        several = spectrum.above(low) - len(values)
        if several == 1:
            # vectors of close values stay orthogonal
            near = vectors[:, np.abs(np.array(values) - (low + high) / 2) <= (high - low) + 1e-3 * spectrum.size] if k > 1 else vectors
            value, vector = _rayleigh(matrix, (low + high) / 2, near, spectrum.tolerance / dim, k)
            middle = low + (high - low) / 2
            if high - low > spectrum.tolerance and middle not in (low, high) and not spectrum.certain(k, value):
                spectrum.above(middle)
                continue
            found, block = [value], vector[:, None]
        else:
            block = np.linalg.qr(np.random.default_rng(k).standard_normal((dim, several)))[0]
            for _ in range(4):
                block = _solve(matrix, (low + high) / 2, block, spectrum.tolerance / dim)
                block = np.linalg.qr(block - vectors @ (vectors.T @ block))[0]
            found = [float(b @ matrix @ b) for b in block.T]
        values += found
        vectors = np.concatenate([vectors, block], axis=1)
    order = np.argsort(-np.array(values), kind="stable")[: min(components, dim)]
    values, vectors = np.array(values)[order], vectors[:, order]
    keep = values > 2 * spectrum.tolerance
    values, vectors = values[keep], vectors[:, keep]
    for k, value in enumerate(values.tolist(), 1):
        if not spectrum.certain(k, value):
            raise ArithmeticError(f"component {k} does not stand at its place of the spectrum")
    return values * size, vectors


# ------------------------------------------------------------------ the operator


@dataclass
class Whitening:
    """What the fit list tells: exact sums, components and what one row needs to be whitened."""

    n: int
    total: list[int]  # exact sum of each dimension
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int
    shift: int

    @property
    def centre(self) -> np.ndarray:
        return np.array([t // self.n for t in self.total], np.int64)

    @property
    def rest(self) -> list[int]:
        """``n`` times what the mean has above the centre."""
        return [t % self.n for t in self.total]

    def whitened(self, d: np.ndarray) -> np.ndarray:
        """Projections of rows given as whole distances from the centre."""
        return (d - np.array([r / self.n for r in self.rest])) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, d: np.ndarray) -> list[int]:
        """Sum over dimensions of ``(n x - S)**2``, exact."""
        rest = self.rest
        if (self.n * (float(np.abs(d).max(initial=0)) + 1.0)) ** 2 * len(rest) < 2.0**62:
            return ((self.n * d - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        return ((self.n * d.astype(object) - np.array(rest, object)) ** 2).sum(axis=1).tolist()


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Components of ``rows`` (id, vector); None where no vector is left."""
    sums = rows.mapInArrow(lambda b: _sums(b, scale, shift), "dim int, i int, n bigint, total decimal(38,0)")
    found = sums.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow().to_pylist()
    if not found:
        return None
    _, short = max((r["n"], -r["dim"]) for r in found)
    mine = sorted((r["i"], r["n"], int(r["total"])) for r in found if r["dim"] == -short)
    model = Whitening(mine[0][1], [t for _, _, t in mine], np.zeros(0), np.zeros((len(mine), 0)), 0.0, scale, shift)
    centre, rest, n, dim = model.centre, model.rest, model.n, len(mine)
    products = rows.mapInArrow(lambda b: _products(b, centre, scale, shift), "i int, j int, total decimal(38,0)")
    covariance = np.zeros((dim, dim))
    summed = products.groupBy("i", "j").agg(F.sum("total").alias("total")).toArrow()
    for i, j, total in zip(*(summed[c].to_pylist() for c in ("i", "j", "total")), strict=True):
        covariance[i, j] = covariance[j, i] = (n * int(total) - rest[i] * rest[j]) / (n * n)
    model.trace = float(np.trace(covariance))
    model.values, model.vectors = leading(covariance, components)
    return model


def _white_sums(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Sums and sums of products of the whitened components of a task."""
    m: Whitening = model.value
    k, dim, centre = len(m.values), len(m.total), m.centre
    moments, seen = np.zeros((k + 1, k)), False
    for batch in batches:
        flat, first, lengths = _vectors(batch)
        mine = first[lengths == dim]
        for at in range(0, len(mine), STEP_ROWS):
            w = m.whitened(_whole(flat, mine[at : at + STEP_ROWS], dim, m.scale, m.shift) - centre)
            moments[0] += w.sum(axis=0)
            moments[1:] += w.T @ w
            seen = True
    if seen:
        i, j = np.indices(moments.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(moments.ravel())], names=["i", "j", "total"]
        )


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured over all rows."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    sums = rows.mapInArrow(lambda b: _white_sums(b, sent), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    moments = np.zeros((len(model.values) + 1, len(model.values)))
    got = sums.toArrow()
    moments[got["i"].to_numpy(), got["j"].to_numpy()] = got["total"].to_numpy()
    mean = moments[0] / model.n
    return float(np.abs(moments[1:] / model.n - np.outer(mean, mean) - np.eye(len(mean))).max())


OUTPUT = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _rows(batches: Iterable[pa.RecordBatch], model, error: float) -> Iterator[pa.RecordBatch]:
    m: Whitening = model.value
    k, dim, centre = len(m.values), len(m.total), m.centre
    explained = m.values / m.trace
    for batch in batches:
        flat, first, lengths = _vectors(batch)
        places = np.flatnonzero(lengths == dim)
        for at in range(0, len(places), STEP_ROWS):
            some = places[at : at + STEP_ROWS]
            d = _whole(flat, first[some], dim, m.scale, m.shift) - centre
            each = np.repeat(np.arange(len(some)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(some)).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), len(some)), pa.int32()),
                    pa.array(np.full(len(each), m.n), pa.int64()),
                    _decimals(m.deviation(d)).take(pa.array(each)),
                    pa.array(m.whitened(d).ravel()),
                    pa.array(np.tile(explained, len(some))),
                    pa.array(np.full(len(each), error)),
                ],
                names=[f.split()[0] for f in OUTPUT.split(", ")],
            )


def whiten(
    docs: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    with_package(docs)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).alias("vector"))
    model = fit(rows, components, scale, shift)
    if model is None or not len(model.values):
        return spark.createDataFrame([], OUTPUT)
    error = identity_error(rows, model)
    sent = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda b: _rows(b, sent, error), OUTPUT)
