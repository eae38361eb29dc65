"""Whitening of vectors: leading components of a covariance by spectrum slicing.

Spark sums vectors and their centred products; the covariance itself has one row per dimension, so
its size does not grow with the data. Its leading eigenvalues are isolated by counts: by Sylvester's
law the shifted matrix V - s I = L D L' has as many positive pivots in D as V has eigenvalues above
s. Bisection with these counts gives each leading eigenvalue an interval of its own; Rayleigh
quotient iteration, which converges cubically, finds it with its vector; and counts just below
and above the result certify its number. Eigenvalues that rounding cannot tell apart share an
interval: each gets its vector orthogonal to those already found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.sources.scratch import materialize

COMPONENTS, GRID, OFFSET = 8, 1024, 100_000
ROUNDS = 40
# Bytes of partial matrices that the driver adds up, and rows whose products are taken at once.
DRIVER_BYTES, ROWS = 32 * 1024 * 1024, 4_096
_LARGEST = 2.0**52  # of scaled entries; beyond it a double has no exact grid
_PIVOT = (1 + np.sqrt(17)) / 8


def inertia(matrix: np.ndarray) -> int:
    """The number of positive eigenvalues: the positive pivots of L D L', with 1 x 1 and 2 x 2
    pivots chosen by the largest entry of a column (Bunch and Kaufman)."""
    a, positive = matrix.astype(np.float64).copy(), 0
    while len(a):
        n = len(a)
        below = np.abs(a[1:, 0])
        r = 1 + int(below.argmax()) if n > 1 else 0
        top = below[r - 1] if n > 1 else 0.0
        pair = False
        if abs(a[0, 0]) < _PIVOT * top:
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() < _PIVOT * top * top:
                if abs(a[r, r]) >= _PIVOT * row.max():
                    _swap(a, 0, r)
                else:
                    _swap(a, 1, r)
                    pair = True
        if pair:
            d, c = a[:2, :2], a[2:, :2]
            # A pivot of this kind has one positive and one negative eigenvalue.
            positive += 1
            a = a[2:, 2:] - c @ np.linalg.solve(d, c.T)
        else:
            d, c = a[0, 0], a[1:, 0]
            positive += d > 0
            a = a[1:, 1:] - np.outer(c, c / d) if d else a[1:, 1:]
    return int(positive)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    a[[i, j]] = a[[j, i]]
    a[:, [i, j]] = a[:, [j, i]]


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenvalues, falling, with unit vectors as rows; ``certified`` tells for each
    whether counts on both sides of it confirm its number."""

    values: np.ndarray
    vectors: np.ndarray
    certified: np.ndarray


def leading(matrix: np.ndarray, count: int) -> Spectrum:
    """The ``count`` largest eigenvalues of a positive semi-definite matrix that are not zero."""
    n = len(matrix)
    scale = float(np.abs(matrix).sum(1).max()) if n else 0.0
    if not scale > 0:
        return Spectrum(np.empty(0), np.empty((0, n)), np.empty(0, bool))
    eye, noise = np.eye(n), 8 * n * np.finfo(float).eps * scale
    known: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = inertia(matrix - shift * eye)
        return known[shift]

    # The spectrum lies within the largest row sum; what is below the floor is zero.
    floor, top = 4 * noise, scale + noise
    wanted = min(count, above(floor))
    values, vectors, certified = [], [], []
    rng = np.random.default_rng(17)
    for k in range(1, wanted + 1):
        # Known counts bracket the k-th eigenvalue: more than k - 1 above low, fewer than k above high.
        low = max([s for s, c in known.items() if c >= k] + [floor])
        high = min([s for s, c in known.items() if c < k and s > low] + [top])
        while True:
            alone = above(low) == k and above(high) == k - 1
            close = high - low <= 4 * noise
            if alone or close:
                found = _rayleigh(matrix, low, high, vectors, rng, noise, close)
                if found is not None:
                    break
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        value, vector = found
        values.append(value)
        vectors.append(vector)
        near = 2 * noise
        certified.append(above(value - near) >= k > above(value + near))
    return Spectrum(np.array(values), np.array(vectors).reshape(-1, n), np.array(certified, bool))


def _rayleigh(matrix, low, high, before, rng, noise, close):
    """The eigenpair in an interval, or None if the iteration ends elsewhere.

    The first steps keep the middle of the interval as their shift, which turns the vector towards
    the eigenvalue in it; then the shift is the Rayleigh quotient. Vectors stay orthogonal to those
    found before.
    """
    n = len(matrix)
    done = np.array(before).reshape(-1, n)
    x = rng.standard_normal(n)
    shift = (low + high) / 2
    for step in range(ROUNDS):
        x = x - done.T @ (done @ x)
        x /= np.linalg.norm(x)
        value = float(x @ matrix @ x)
        rest = float(np.linalg.norm(matrix @ x - value * x))
        if step and rest <= noise and low - noise <= value <= high + noise:
            return value, x
        if step > 2 and not close:
            shift = value
        for nudge in (0.0, noise, -noise, 3 * noise):
            try:
                y = np.linalg.solve(matrix - (shift + nudge) * np.eye(n), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                x = y / np.linalg.norm(y)
                break
        else:
            return None
    return None


# --- over Spark


def _matrices(batch: pa.RecordBatch, at: int, size: int | None) -> Iterator[tuple]:
    """Row numbers and grid vectors of the valid rows of a batch, by vector length."""
    column = batch.column(at)
    if not len(column):
        return
    offsets = column.offsets.to_numpy()
    values = column.values
    good = column.is_valid().to_numpy(zero_copy_only=False)
    entry = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        grid = np.floor(GRID * entry)
        odd = ~np.isfinite(entry) | ~(np.abs(grid) < _LARGEST)
    if values.null_count:
        odd |= values.is_null().to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(odd)])
    lengths = np.diff(offsets)
    good &= (lengths > 0) & (before[offsets[1:]] == before[offsets[:-1]])
    for length in np.unique(lengths[good]) if size is None else [size]:
        rows = np.flatnonzero(good & (lengths == length))
        if len(rows):
            flat = grid[offsets[rows][:, None] + np.arange(length)]
            yield rows, flat.astype(np.int64) + OFFSET


def _totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number and exact sums of the valid vectors of the most frequent length (ties: shortest)."""

    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for rows, x in _matrices(batch, 0, None):
                n, total = found.get(x.shape[1], (0, 0))
                # Entries stay below 2^53, so a sum of 2^9 rows is exact in 64 bits.
                for k in range(0, len(x), 512):
                    total = total + x[k : k + 512].sum(0).astype(object)
                found[x.shape[1]] = [n + len(rows), total]
        if found:
            yield pa.RecordBatch.from_pydict({
                "size": pa.array(list(found), pa.int32()),
                "n": pa.array([n for n, _ in found.values()], pa.int64()),
                "total": pa.array([[str(v) for v in t] for _, t in found.values()],
                                  pa.list_(pa.string()))})

    parts = vectors.mapInArrow(run, "size int, n long, total array<string>")
    sums = parts.select("size", "n", F.posexplode("total").alias("at", "value")).groupBy(
        "size", "at").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)"))
                          .alias("total"))
    # One row per dimension of the chosen length reaches the driver.
    best = sums.where("at = 0").orderBy(F.desc("n"), "size").head()
    if best is None:
        return 0, []
    rows = sums.where(F.col("size") == best["size"]).orderBy("at").collect()
    return best["n"], [int(r["total"]) for r in rows]


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of a table of ``(matrix binary)`` rows, by two levels of tasks."""

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(data).reshape(size, size)
        yield pa.RecordBatch.from_pydict({"matrix": pa.array([total.tobytes()], pa.binary())})

    tasks = max(1, min(16, DRIVER_BYTES // (8 * size * size)))
    rows = parts.repartition(tasks).mapInArrow(run, "matrix binary").collect()
    return sum((np.frombuffer(bytes(r[0])).reshape(size, size) for r in rows),
               np.zeros((size, size)))


def _products(rows: DataFrame, size: int, centred) -> np.ndarray:
    """The sum of x x' over the vectors that ``centred`` takes from batches."""

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for x in centred(batch):
                for k in range(0, len(x), ROWS):
                    total += x[k : k + ROWS].T @ x[k : k + ROWS]
        yield pa.RecordBatch.from_pydict({"matrix": pa.array([total.tobytes()], pa.binary())})

    return _added(rows.mapInArrow(run, "matrix binary"), size)


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S/n in doubles, from integers: the whole part is taken off first."""
    whole = np.array([s // n for s in total], np.int64)
    part = np.array([(s % n) / n for s in total])
    return (x - whole) - part


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """The sum over dimensions of (n x - S)^2, exact."""
    reach = max(max(abs(n * int(v) - s) for v, s in zip(part, total))
                for part in (x.max(0), x.min(0)))
    if reach * reach * x.shape[1] < 2**63 and n * int(np.abs(x).max()) < 2**63:
        d = n * x - np.array(total, np.int64)
        return (d * d).sum(1).tolist()
    d = n * x.astype(object) - np.array(total, object)
    return (d * d).sum(1).tolist()


@dataclass(frozen=True)
class Whitening:
    """What is learned from all vectors."""

    n: int
    total: list[int]
    spectrum: Spectrum
    trace: float


def fit_whitening(vectors: DataFrame, column: str = "embedding",
                  components: int = COMPONENTS) -> Whitening:
    """Learn from every valid vector; see ``whiten`` for which these are."""
    vectors = vectors.select(column)
    n, total = _totals(vectors)
    if not n:
        return Whitening(0, [], leading(np.zeros((0, 0)), 0), 0.0)
    size = len(total)

    def centred(batch):
        for _, x in _matrices(batch, 0, size):
            yield _centred(x, n, total)

    covariance = _products(vectors, size, centred) / n
    covariance = (covariance + covariance.T) / 2
    return Whitening(n, total, leading(covariance, components), float(np.trace(covariance)))


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """``(key, deviation decimal(38,0), whitened array<double>)`` per valid vector, stored.

    A vector counts if it and its entries are not null, all entries are finite and below 2^42, and
    its length is the most frequent one of the table. A null key stays null, equal rows get
    equal rows, other columns are not looked at. Components without variance are left out, so
    equal vectors have an empty array; an empty table has no rows.
    """
    rows = vectors.select(F.col(key).alias("key"), column)
    kind = rows.schema["key"]
    schema = T.StructType([T.StructField(key, kind.dataType),
                           T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("whitened", T.ArrayType(T.DoubleType(), False))])
    n, total, found = model.n, model.total, model.spectrum
    turn = (found.vectors / np.sqrt(found.values)[:, None]).T if n else None
    width = len(found.values)
    list_type = pa.list_(pa.field("element", pa.float64(), False))

    def run(batches):
        for batch in batches:
            for at, x in _matrices(batch, 1, len(total)) if n else ():
                data = (_centred(x, n, total) @ turn).ravel()
                white = pa.ListArray.from_arrays(
                    np.arange(len(x) + 1, dtype=np.int32) * width, pa.array(data), type=list_type)
                wide = pa.array(map(str, _deviations(x, n, total)), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), wide.cast(pa.decimal128(38, 0)), white],
                    names=schema.names)

    return materialize(rows.mapInArrow(run, schema), "whitened")


def identity_error(white: DataFrame, n: int, width: int) -> float | None:
    """The largest distance of an entry of the covariance of ``whitened`` from the identity."""
    if not n or not width:
        return None
    rows = white.select("whitened")
    # One row per component.
    sums = rows.select(F.posexplode("whitened").alias("at", "value")).groupBy("at").agg(
        F.sum("value").alias("total")).orderBy("at").collect()
    mean = np.array([r["total"] for r in sums]) / n

    def centred(batch):
        column = batch.column(0)
        if len(column):
            yield column.flatten().to_numpy().reshape(-1, width) - mean

    return float(np.abs(_products(rows, width, centred) / n - np.eye(width)).max())


def whitened_components(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """One row per valid vector and component: ``key, component`` (from 1, by falling eigenvalue),
    ``n, deviation, whitened, explained, identity_error``, and ``certified``."""
    model = fit_whitening(vectors, column, components)
    white = whiten(vectors, model, key, column)
    error = identity_error(white, model.n, len(model.spectrum.values))
    share = model.spectrum.values / model.trace if model.trace else np.empty(0)
    number = F.col("at") + 1
    pick = lambda values, kind: F.element_at(
        F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), number)
    rows = white.select(key, "deviation", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        key, number.cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", F.col("value").alias("whitened"),
        pick(share.tolist(), "double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        pick(model.spectrum.certified.tolist(), "boolean").alias("certified"))
