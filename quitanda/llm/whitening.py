"""Whitening of embeddings by spectrum slicing of their covariance.

The covariance is summed up over all rows in whole numbers. Its leading eigenvalues are isolated by
inertia counts: the signs in D of V - s I = L D Lt say how many eigenvalues lie above s. From
an isolating interval, Rayleigh quotient iteration finds the eigenvector, and two counts around
the value found certify its number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMPONENTS = 32

# An entry is this many times larger as a whole number, and moved by the offset.
SCALE = 64
OFFSET = 1_000_000

# An eigenvalue below this part of the trace is rounding: its direction has no variance.
ZERO_SHARE = 1e-12

_LARGEST = 2.0**31
_EXACT = 2.0**53
_ROWS = 4096
_STEPS = 30
_PANEL = 48
_LOW = 1 << 32


# Whole-number vectors.


def whole_vectors(column: pa.Array, length: int | None = None) -> tuple[np.ndarray, list]:
    """Places of the usable vectors, and by length the (places, whole numbers) of these.

    A vector is usable if neither it nor an entry is null, all entries are finite and so are,
    within 32 bits, the whole numbers they become.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    places = np.flatnonzero(lengths >= 0)
    flat = column.flatten()
    entries = np.asarray(flat.cast(pa.float64()).fill_null(float("nan")), np.float64)
    starts = np.cumsum(lengths[places]) - lengths[places]
    found = []
    for n in np.unique(lengths[places]).tolist():
        if length not in (None, n):
            continue
        own = lengths[places] == n
        rows = entries[starts[own][:, None] + np.arange(n)]
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(rows * SCALE)
            usable = (np.abs(scaled) < _LARGEST).all(axis=1)
        found.append((places[own][usable], scaled[usable].astype(np.int64) + OFFSET))
    return places, found


def _blocks(batches: Iterator[pa.RecordBatch], place: int, length: int | None = None):
    """Batches of at most ``_ROWS`` rows with their whole-number vectors by length."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part, whole_vectors(part.column(place), length)[1]


def _over_vectors(
    vectors: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return vectors.mapInArrow(run, schema)


def _halves(value: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Whole numbers of any size as high * 2^32 + low, which longs add up exactly."""
    high, low = zip(*(divmod(int(v), _LOW) for v in value)) if len(value) else ((), ())
    return pa.array(high, pa.int64()), pa.array(low, pa.int64())


def _added(sums: DataFrame, *keys: str) -> DataFrame:
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    return sums.groupBy(*keys).agg(*wide)


def vector_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number and sum of the usable vectors of the most frequent length (of equals the longest)."""

    def run(batches):
        counts: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for _, found in _blocks(batches, 0):
            for places, x in found:
                n = x.shape[1]
                counts[n] = counts.get(n, 0) + len(x)
                # A block's sum fits a long; a task's need not.
                sums[n] = sums.get(n, 0) + x.sum(axis=0).astype(object)
        for n, count in counts.items():
            # The count goes along as the entry before the first.
            high, low = _halves(np.array([count, *sums[n]], object))
            place = pa.array(range(-1, n), pa.int32())
            length = pa.array([n] * (n + 1), pa.int32())
            yield pa.RecordBatch.from_arrays([length, place, high, low], ["length", "place", "high", "low"])

    found = _over_vectors(vectors, run, "length int, place int, high bigint, low bigint")
    entry = F.struct("place", "high", "low")
    sums = _added(found, "length", "place").groupBy("length")
    sums = sums.agg(F.array_sort(F.collect_list(entry)).alias("sums"))
    rows = (F.col("sums")[0]["high"] * F.lit(_LOW) + F.col("sums")[0]["low"]).alias("rows")
    best = sums.select("*", rows).where("rows > 0").orderBy(F.desc("rows"), F.desc("length")).first()
    if best is None:
        return 0, []
    values = [int(entry.high) * _LOW + int(entry.low) for entry in best["sums"]]
    return values[0], values[1:]


def product_sums(y: np.ndarray) -> np.ndarray:
    """The exact sums of y_i * y_j over the rows of whole numbers."""
    largest = float(np.abs(y).max(initial=0))
    if largest**2 >= _EXACT:
        y = y.astype(object)
        return y.T @ y
    rows, total = max(1, int(_EXACT // max(1.0, largest**2))), 0
    for start in range(0, len(y), rows):
        part = y[start : start + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def covariance(vectors: DataFrame, n: int, sums: Sequence[int]) -> np.ndarray:
    """Covariance of the usable vectors, divisor n, each entry rounded once.

    The vectors are centred by the whole number next to their mean before they are multiplied, and
    what is left of the mean is taken off in whole numbers. So the result does not depend on
    the order in which tasks end, and a task run again changes nothing. One task sends the
    entries above the diagonal, of all its rows together.
    """
    d = len(sums)
    center = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    left = [s - n * int(c) for s, c in zip(sums, center)]
    first, second = np.triu_indices(d)

    def run(batches):
        total = 0
        for _, found in _blocks(batches, 0, d):
            for _, x in found:
                total = total + product_sums(x - center)
        if isinstance(total, np.ndarray):
            high, low = _halves(total[first, second])
            i, j = pa.array(first, pa.int32()), pa.array(second, pa.int32())
            yield pa.RecordBatch.from_arrays([i, j, high, low], ["i", "j", "high", "low"])

    # Few tasks, as each sends d * (d + 1) / 2 sums however few rows it has.
    tasks = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    found = _over_vectors(vectors.coalesce(tasks), run, "i int, j int, high bigint, low bigint")
    v = np.zeros((d, d))
    for row in _added(found, "i", "j").toLocalIterator():
        product = int(row.high) * _LOW + int(row.low)
        v[row.i, row.j] = v[row.j, row.i] = float(
            Fraction(n * product - left[row.i] * left[row.j], n * n)
        )
    return v


# Spectrum slicing.


def inertia(v: np.ndarray, shift: float) -> tuple[int, float]:
    """Number of eigenvalues above ``shift``, and the growth in V - shift I = L D Lt.

    The factors are worked out by panels of columns. No pivots are sought: where a pivot is so
    small that entries grow, the growth tells, and the caller takes another shift.
    """
    a = v - shift * np.eye(len(v))
    size = float(np.abs(a).max(initial=0)) or 1.0
    above, growth = 0, 1.0
    for start in range(0, len(a), _PANEL):
        end = min(start + _PANEL, len(a))
        for k in range(start, end):
            pivot = float(a[k, k])
            if pivot == 0.0:
                return above, float("inf")
            above += pivot > 0
            column = a[k + 1 :, k] / pivot
            # Inside the panel at once; what lies right of it waits for the whole panel.
            a[k + 1 :, k + 1 : end] -= np.outer(column, a[k, k + 1 : end])
            a[k, k + 1 : end] /= pivot
        if end < len(a):
            below = a[end:, start:end]
            pivots = np.diag(a)[start:end]
            a[end:, end:] -= (below / pivots) @ below.T
            growth = max(growth, float(np.abs(a[end:, end:]).max()) / size)
        panel = np.abs(np.tril(a[start:, start:end])).max()
        growth = max(growth, float(panel) / size)
    return above, growth


# Growth at which counts at a shift are taken: they hold but for eigenvalues so many roundings near.
_GROWTH = 1e3


def count_above(v: np.ndarray, low: float, high: float) -> tuple[float, int]:
    """A shift well inside (low, high) and the number of eigenvalues above it."""
    best = (float("inf"), 0.0, 0)
    for part in (0.5, 0.47, 0.53, 0.44, 0.56, 0.41, 0.59, 0.38, 0.62):
        shift = low + part * (high - low)
        above, growth = inertia(v, shift)
        if growth < _GROWTH:
            return shift, above
        best = min(best, (growth, shift, above))
    return best[1], best[2]


def rayleigh(
    v: np.ndarray, value: float, found: np.ndarray, scale: float, seed: int
) -> tuple[float, np.ndarray, float]:
    """An eigenvalue near ``value``, its vector and the residual |V x - value x|.

    The vector is orthogonal to the columns of ``found``.

    Inverse iteration at the given value picks the vector; then the shift follows the Rayleigh
    quotient, which converges cubically.
    """
    eye = np.eye(len(v))
    x = np.random.default_rng(seed).standard_normal(len(v))

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        for bump in (0.0, 4e-16, 1e-14):
            try:
                y = np.linalg.solve(v - (shift + bump * scale) * eye, x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                break
        else:
            return x
        y = y / np.abs(y).max()
        for _ in range(2):
            y = y - found @ (found.T @ y)
        return y / np.linalg.norm(y)

    x = x - found @ (found.T @ x)
    for _ in range(3):
        x = solved(value, x)
    best = (float("inf"), value, x)
    for _ in range(_STEPS):
        rho = float(x @ (v @ x))
        residual = float(np.linalg.norm(v @ x - rho * x))
        if residual >= best[0]:
            break
        best = residual, rho, x
        x = solved(rho, x)
    residual, rho, x = best
    return rho, x, residual


def leading_components(
    v: np.ndarray, count: int = COMPONENTS, zero_share: float = ZERO_SHARE
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns.

    Counts halve the spectrum until each wanted eigenvalue has an interval of its own, which is
    narrow enough for the iteration to find it; where it finds another one, its interval is
    halved further. Values that stay together down to rounding share an interval: their vectors
    are found one by one, each orthogonal to those before. Eigenvalues of ``zero_share`` of
    the trace or less are left out.
    """
    d = len(v)
    trace = float(np.trace(v)) if d else 0.0
    if not trace > 0:
        return np.zeros(0), np.zeros((d, 0))
    scale = float(np.abs(v).sum(axis=1).max())
    floor, tiny = zero_share * trace, 64 * np.finfo(float).eps * scale
    # (shift, eigenvalues above it), from high to low; none lies above the first.
    top = scale * (1 + 1e-9)
    _, positive = count_above(v, 0.5 * floor, 1.5 * floor)
    wanted = min(count, positive)
    slices: dict[float, int] = {top: 0, floor: positive}

    def interval(k: int) -> tuple[float, float]:
        """The narrowest known interval with the k-th eigenvalue (from 1)."""
        low = max(s for s, above in slices.items() if above >= k)
        high = min(s for s, above in slices.items() if above < k and s > low)
        return low, high

    def halve(low: float, high: float) -> None:
        shift, above = count_above(v, low, high)
        # Rounding must not turn the counts around.
        slices[shift] = min(max(above, slices[high]), slices[low])

    values, vectors = np.zeros(wanted), np.zeros((d, wanted))
    k = 1
    while k <= wanted:
        low, high = interval(k)
        together = slices[low] - slices[high]
        while together > 1 and high - low > tiny:
            halve(low, high)
            low, high = interval(k)
            together = slices[low] - slices[high]
        if together > 1:
            # One value of a multiplicity, as far as rounding can tell.
            for i in range(k, min(k + together, wanted + 1)):
                near = (low + high) / 2
                values[i - 1], vectors[:, i - 1], _ = rayleigh(
                    v, near, vectors[:, : i - 1], scale, i
                )
            k += together
            continue
        while True:
            low, high = interval(k)
            value, x, residual = rayleigh(v, (low + high) / 2, vectors[:, : k - 1], scale, k)
            inside = low - tiny <= value <= high + tiny
            if inside and residual <= tiny and certified(v, value, k, tiny):
                break
            if high - low <= tiny:
                break
            halve(low, high)
        values[k - 1], vectors[:, k - 1] = value, x
        k += 1
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def certified(v: np.ndarray, value: float, k: int, width: float) -> bool:
    """Whether counts on both sides say that the k-th eigenvalue is at ``value``.

    Neighbours less than ``width`` away are counted with it; the interval tells them apart.
    """
    _, under = count_above(v, value - 1.5 * width, value - 0.5 * width)
    _, over = count_above(v, value + 0.5 * width, value + 1.5 * width)
    return over < k <= under


# The operator.


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: number and sums of the fitted vectors, and the components."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """x - S / n on each component, over the root of its eigenvalue."""
        # n * x - S in whole numbers first, as x and S / n are far larger than what they differ by.
        return (self.moved(x).astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.values))

    def moved(self, x: np.ndarray) -> np.ndarray:
        """n * x - S in whole numbers; as Python's where a long is too short."""
        if self.n * (_LARGEST + OFFSET) * 2 < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of the squares of n * x - S; null where a long can't hold them."""
        moved = self.moved(x)
        largest = max(1, int(np.abs(moved).max(initial=0)))
        if largest**2 * moved.shape[1] < 2**63:
            return (moved.astype(np.int64) ** 2).sum(axis=1).tolist()
        exact = (moved.astype(object) ** 2).sum(axis=1).tolist()
        return [value if value < 2**63 else None for value in exact]


def fit_whitening(docs: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Components of all usable vectors, by two passes over them: sums, then products.

    Only sums come to the driver, whose number depends on the vectors' length, not on their
    number. Vectors of another length than most have no place in the covariance.
    """
    vectors = docs.select(F.col(f"`{vector}`").alias("v"))
    n, sums = vector_sums(vectors)
    v = covariance(vectors, n, sums) if n else np.zeros((0, 0))
    values, found = leading_components(v, components)
    return Whitening(n, tuple(sums), values, found, float(np.trace(v)) if len(v) else 0.0)


def identity_error(docs: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest entry of (covariance of the whitened vectors - identity), measured on all rows."""
    k, d = len(model.values), len(model.sums)
    first, second = np.triu_indices(k)

    def run(batches):
        total, sums, rows = np.zeros((k, k)), np.zeros(k), 0
        for _, found in _blocks(batches, 0, d):
            for _, x in found:
                w = model.whitened(x)
                total, sums, rows = total + w.T @ w, sums + w.sum(axis=0), rows + len(x)
        if rows:
            # Sums of the components go along as products with one more, which is 1.
            i = pa.array(np.r_[first, np.arange(k)], pa.int32())
            j = pa.array(np.r_[second, np.full(k, k)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [i, j, pa.array(np.r_[total[first, second], sums])], ["i", "j", "product"]
            )

    vectors = docs.select(F.col(f"`{vector}`").alias("v"))
    tasks = 4 * docs.sparkSession.sparkContext.defaultParallelism
    found = _over_vectors(vectors.coalesce(tasks), run, "i int, j int, product double")
    # Added up in a fixed order, so that a rerun gives the same last digits.
    ordered = F.array_sort(F.collect_list("product"))
    added = F.aggregate(ordered, F.lit(0.0), lambda a, b: a + b)
    table, mean = np.zeros((k, k)), np.zeros(k)
    for row in found.groupBy("i", "j").agg(added.alias("product")).toLocalIterator():
        if row.j == k:
            mean[row.i] = row.product / model.n
        else:
            table[row.i, row.j] = table[row.j, row.i] = row.product / model.n
    return float(np.abs(table - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def whiten(
    docs: DataFrame,
    keep: Sequence[str] = ("vec_id",),
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Whitened vectors, one row for each usable vector and leading component of their covariance.

    Columns: those in ``keep``, then component (from 1, by falling eigenvalue), n (vectors
    fitted), deviation (sum over the dimensions of (n x - S)^2, exact), whitened (x - S / n on
    the component over the root of its eigenvalue), explained (eigenvalue over trace) and
    identity_error, one value measured on all rows. x is floor(64 c) + 1000000 of an entry c, and S
    the sum of all x.

    A vector that is null, or has an entry that is null, not finite or 2^25 or more in size, is
    left out, and so is one of another length than most vectors (of equally frequent lengths the
    longest stays). Repeated rows count and return as often as they are there. Equal eigenvalues
    have some orthogonal vectors of theirs, the same for all rows. Directions without variance
    (equal or too few vectors) have no component, so a table without usable vectors, or of equal
    ones, gives no rows. A deviation beyond a long is null. Other columns are not read.
    """
    model = fit_whitening(docs, vector, components)
    error, k, d = 0.0, len(model.values), len(model.sums)
    if k:
        error = identity_error(docs, model, vector)
    kinds, kept = dict(docs.dtypes), list(keep)
    made = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    names = [f"k{i} {kinds[name]}" for i, name in enumerate(kept)]
    schema = ", ".join([*names, made])
    shares = model.values / model.trace if k else model.values

    def run(batches):
        for batch, found in _blocks(batches, len(kept), d):
            for places, x in found:
                if not k or not len(x):
                    continue
                rows = len(x) * k
                again = pa.array(np.repeat(places, k))
                columns = [batch.column(i).take(again) for i in range(len(kept))]
                deviations = pa.array(model.deviations(x), pa.int64())
                columns += [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(rows, model.n, np.int64)),
                    deviations.take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(rows, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, result_names)

    result_names = StructType.fromDDL(schema).names
    read = [F.col(f"`{name}`").alias(f"r{i}") for i, name in enumerate([*kept, vector])]
    whitened = docs.select(*read).mapInArrow(run, schema)
    return whitened.toDF(*kept, *StructType.fromDDL(made).names)
