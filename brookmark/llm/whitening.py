"""Embedding whitening by spectrum slicing.

Entries become whole numbers, x = floor(1024 * entry) + 100000, so sums and products are exact and do not
depend on how rows are dealt to tasks:

1. A scan sums count and entries per vector length; a second one sums the products of vectors centred on
   the rounded mean. Tasks send one row per dimension; the driver holds one matrix of the dimensions.
2. Eigenvalues of the covariance V are isolated from the top. The signs of the pivots of V - s I = L D L^T
   count the eigenvalues above s (Sylvester's law of inertia), so bisection on s ends with intervals that
   hold one eigenvalue each, numbered by the counts at their ends.
3. Rayleigh quotient iteration converges cubically inside the interval. A pair that leaves its interval
   is dropped and the interval halved again; a final count on both sides of each value certifies its number.
   Values closer than the resolution are taken as one cluster: its vectors are iterated together, each kept
   orthogonal to those before it.
4. A last scan projects the rows; before it, one more measures the covariance of the projections themselves,
   for the largest deviation from the identity.

Pivots are 1 x 1 or 2 x 2 (Bunch and Kaufman), so no shift can break the factorisation down.

Rows whose vector is null or holds null or non-finite entries are left out, and entries of 2**43 or more in
size, whose x a double does not hold. If vectors differ in length, those of the most frequent length are
used (the longer one of equals), the others are left out. Repeated rows each count. A component without variance
(beyond rounding) has nothing to scale and is left out; an empty table gives no rows. Only the id and the
vector are read, so further columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import map_batches

SCALE, OFFSET = 1024, 100_000
#: Entries stay below this, so that x is exact as a double.
LIMIT = float(1 << 43)
_EPS = np.finfo(float).eps


def vectors_of(column: pa.Array, length: int | None = None) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Rows that may be used and, per vector length, (rows, x) of them."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = np.asarray(column.value_lengths().fill_null(-1), np.int64)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(values) < LIMIT)  # also nulls, which come as NaN
    ends = np.cumsum(np.maximum(sizes, 0))
    starts = ends - np.maximum(sizes, 0)
    wrong = np.r_[0, np.cumsum(bad)]
    usable = (sizes >= 0) & (wrong[ends] == wrong[starts])
    found = {}
    for n in np.unique(sizes[usable]) if length is None else [length]:
        rows = np.flatnonzero(usable & (sizes == n))
        entries = values[starts[rows, None] + np.arange(n)] if n else np.zeros((len(rows), 0))
        found[int(n)] = (rows, np.floor(SCALE * entries).astype(np.int64) + OFFSET)
    return usable, found


def totals(vectors: DataFrame, column: str) -> tuple[int, list[int]] | None:
    """(n, S) of the most frequent vector length; one row per length reaches the driver."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for size, (rows, x) in vectors_of(batch.column(0))[1].items():
            if len(rows):
                at = np.arange(-1, size)
                sums = [len(rows), *(sum(c.tolist()) for c in x.T)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size + 1, size)), pa.array(at), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))],
                    names=["size", "at", "value"],
                )

    sums = map_batches(vectors.select(column), run, "size long, at long, value decimal(38,0)")
    found = sums.groupBy("size", "at").agg(F.sum("value").alias("value"))
    counts = found.where("at = -1").orderBy(F.desc("value"), F.desc("size")).first()
    if counts is None:
        return None
    own = {r["at"]: int(r["value"]) for r in found.where(F.col("size") == counts["size"]).collect()}
    return own[-1], [own[i] for i in range(counts["size"])]


def covariance(vectors: DataFrame, column: str, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the rows; products are of differences from the rounded mean, summed exactly."""
    size = len(sums)
    middle = [(2 * s + n) // (2 * n) for s in sums]  # rounded mean
    centre = np.array(middle, np.int64)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, x = vectors_of(batch.column(0), size)[1][size]
        if not len(rows):
            return
        y = x - centre
        # whole numbers below 2**53 are exact in doubles; beyond that Python's own are used
        if len(rows) * float(np.abs(y).max(initial=0)) ** 2 < 2.0**53:
            product = (y.T.astype(float) @ y.astype(float)).astype(np.int64)
        else:
            product = y.T.astype(object) @ y.astype(object)
        at, also = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(also), pa.array([Decimal(int(v)) for v in product[at, also]], pa.decimal128(38, 0))],
            names=["at", "also", "value"],
        )

    made = map_batches(vectors.select(column), run, "at long, also long, value decimal(38,0)")
    products = np.zeros((size, size), object)
    for r in made.groupBy("at", "also").agg(F.sum("value").alias("value")).collect():  # size * (size + 1) / 2 rows
        products[r["at"], r["also"]] = products[r["also"], r["at"]] = int(r["value"])
    off = [s - n * m for s, m in zip(sums, middle)]  # n times the distance of mean and rounded mean
    exact = [[(n * products[i, j] - off[i] * off[j]) / (n * n) for j in range(size)] for i in range(size)]
    return np.array(exact, float).reshape(size, size)


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above the shift: positive pivots of its L D L^T."""
    a = np.array(matrix, float)
    a[np.diag_indices_from(a)] -= shift
    n, k, above = len(a), 0, 0
    alpha = (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1 :, k])
        most = column.max(initial=0.0)
        pivot = abs(a[k, k])
        two = False
        if most > 0 and pivot < alpha * most:
            r = k + 1 + int(column.argmax())
            other = np.abs(a[k:, r])
            other[r - k] = 0
            widest = other.max()
            if pivot * widest < alpha * most * most:
                if abs(a[r, r]) >= alpha * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            block, rest = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            below = rest @ np.linalg.inv(block)
            a[k + 2 :, k + 2 :] -= below @ rest.T
            above += 1  # such a block has one pivot of each sign
            k += 2
        else:
            d = a[k, k]
            above += d > 0
            if d != 0:
                rest = a[k + 1 :, k]
                a[k + 1 :, k + 1 :] -= np.outer(rest / d, rest)
            k += 1
    return int(above)


def _start(size: int, k: int) -> np.ndarray:
    """Fixed starting vector of the k-th component."""
    v = np.random.default_rng(k).normal(size=size)
    return v / np.linalg.norm(v)


def _apart(v: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for q in before:
            v = v - (q @ v) * q
    return v / np.linalg.norm(v)


def _solve(matrix: np.ndarray, shift: float, v: np.ndarray, unit: float) -> np.ndarray:
    a = np.array(matrix)
    a[np.diag_indices_from(a)] -= shift
    try:
        return np.linalg.solve(a, v)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        a[np.diag_indices_from(a)] += unit
        return np.linalg.solve(a, v)


def rayleigh(matrix: np.ndarray, low: float, high: float, before: list[np.ndarray], k: int, unit: float):
    """Rayleigh quotient iteration inside (low, high]; None if it leaves the interval."""
    v, value = _apart(_start(len(matrix), k), before), (low + high) / 2
    for step in range(60):
        # two steps at the middle first, which turn the vector towards the isolated value
        v = _apart(_solve(matrix, value, v, unit), before)
        if step < 2:
            continue
        value = float(v @ matrix @ v)
        if not low - unit <= value <= high + unit:
            return None
        if np.linalg.norm(matrix @ v - value * v) <= 4 * unit:
            # one more step costs nothing and settles the last bits
            v = _apart(_solve(matrix, value, v, unit), before)
            return float(v @ matrix @ v), v
    return None


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenvalues (falling) and unit vectors (columns), with the count that numbers each."""

    values: np.ndarray
    vectors: np.ndarray
    trace: float


def slices(matrix: np.ndarray, most: int) -> Spectrum:
    """Leading eigenpairs of a covariance by spectrum slicing."""
    size = len(matrix)
    trace = float(np.trace(matrix))
    bound = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    unit = max(size * _EPS * bound, np.finfo(float).tiny)  # what rounding can do to an eigenvalue
    values: list[float] = []
    vectors: list[np.ndarray] = []
    known = {bound + unit: 0, unit * 8: inertia(matrix, unit * 8) if size else 0}
    wanted = min(most, known[unit * 8])

    def ends(k: int) -> tuple[float, float]:
        """Closest known shifts below and above the k-th value."""
        return max(s for s, c in known.items() if c >= k), min(s for s, c in known.items() if c < k)

    for k in range(1, wanted + 1):
        while True:
            low, high = ends(k)
            alone = known[low] == k and known[high] == k - 1
            close = high - low <= 64 * unit  # a cluster, or as near as counts can tell
            if alone or close:
                found = rayleigh(matrix, low, high, vectors, k, unit)
                if found:
                    break
                if close:
                    found = _clustered(matrix, (low + high) / 2, vectors, k, unit)
                    break
            middle = (low + high) / 2
            known[middle] = inertia(matrix, middle)
        value, v = found
        # certify the number of the value by counts on both its sides
        slack = 64 * unit
        if not (inertia(matrix, value - slack) >= k > inertia(matrix, value + slack)):
            raise ArithmeticError(f"component {k} could not be certified")
        values.append(value)
        vectors.append(v if v[np.abs(v).argmax()] > 0 else -v)
    order = np.argsort(-np.array(values), kind="stable")
    stacked = np.array(vectors).T.reshape(size, len(values)) if values else np.zeros((size, 0))
    return Spectrum(np.array(values)[order], stacked[:, order], trace)


def _clustered(matrix: np.ndarray, shift: float, before: list[np.ndarray], k: int, unit: float):
    """Inverse iteration at a cluster, orthogonal to the vectors before."""
    v = _apart(_start(len(matrix), k), before)
    for _ in range(8):
        v = _apart(_solve(matrix, shift, v, unit), before)
    return float(v @ matrix @ v), v


@dataclass(frozen=True)
class Whitening:
    """What a whole table was fitted to; ``n`` is 0 for a table without usable rows."""

    n: int
    sums: list[int]
    spectrum: Spectrum | None

    @property
    def components(self) -> int:
        return 0 if self.spectrum is None else len(self.spectrum.values)


def fit(vectors: DataFrame, column: str = "embedding", components: int = 8) -> Whitening:
    found = totals(vectors, column)
    if found is None:
        return Whitening(0, [], None)
    n, sums = found
    return Whitening(n, sums, slices(covariance(vectors, column, n, sums), components))


def _project(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Whitened coordinates and exact squared deviations of rows."""
    n, sums = model.n, model.sums
    reach = n * (int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) // n + 1)
    if reach * reach * max(len(sums), 1) < 1 << 62:
        away = n * x - np.array(sums, np.int64)
        square = (away * away).sum(axis=1).tolist()
    elif reach < 1 << 62:
        away = n * x - np.array(sums, np.int64)
        wide = away.astype(object)
        square = (wide * wide).sum(axis=1).tolist()
    else:
        away = n * x.astype(object) - np.array(sums, object)
        square = (away * away).sum(axis=1).tolist()
    spectrum = model.spectrum
    whitened = (away.astype(float) / n) @ (spectrum.vectors / np.sqrt(spectrum.values))
    return whitened, [int(s) for s in square]


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest entry by which the covariance of the projected rows is off the identity."""
    m = model.components

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, x = vectors_of(batch.column(0), len(model.sums))[1][len(model.sums)]
        if len(rows):
            w = _project(model, x)[0]
            at, also = np.divmod(np.arange(m * m), m)
            table = [np.r_[at, np.arange(m)], np.r_[also, np.full(m, -1)], np.r_[(w.T @ w).ravel(), w.sum(axis=0)]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table], names=["at", "also", "value"])

    made = map_batches(vectors.select(column), run, "at long, also long, value double")
    product, mean = np.zeros((m, m)), np.zeros(m)
    for r in made.groupBy("at", "also").agg(F.sum("value").alias("value")).collect():  # m * (m + 1) rows
        if r["also"] < 0:
            mean[r["at"]] = r["value"] / model.n
        else:
            product[r["at"], r["also"]] = r["value"] / model.n
    return float(np.abs(product - np.outer(mean, mean) - np.eye(m)).max(initial=0.0))


def transform(vectors: DataFrame, model: Whitening, ident: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(ident, component, n, deviation, whitened, explained), one row per used row and component.

    ``deviation`` is exact as decimal(38,0); beyond that it is null.
    """
    kind = dict(vectors.dtypes)[ident]
    m = model.components
    explained = model.spectrum.values / model.spectrum.trace if m else np.zeros(0)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not m:
            return
        rows, x = vectors_of(batch.column(1), len(model.sums))[1][len(model.sums)]
        if not len(rows):
            return
        whitened, square = _project(model, x)
        exact = [Decimal(s) if s < 10**38 else None for s in square]
        each = np.repeat(np.arange(len(rows)), m)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(each), model.n, np.int64)), pa.array(exact, pa.decimal128(38, 0)).take(pa.array(each)),
                pa.array(whitened.ravel()), pa.array(np.tile(explained, len(rows))),
            ],
            names=[ident, "component", "n", "deviation", "whitened", "explained"],
        )

    schema = f"`{ident}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double"
    return map_batches(vectors.select(ident, column), run, schema)


def whiten(vectors: DataFrame, ident: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """Whitened leading components of every row, with the fit's largest deviation from the identity."""
    model = fit(vectors, column, components)
    error = identity_error(vectors, model, column) if model.components else 0.0
    return transform(vectors, model, ident, column).withColumn("identity_error", F.lit(error))
