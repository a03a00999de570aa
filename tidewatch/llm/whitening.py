"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers, so the covariance is exact: every task adds up products of entries centred on the whole
part of the mean, the remainders of the mean are taken off as whole numbers, and the result is rounded once. It does not
depend on partitions. The eigenvalues of this matrix are sliced: the pivots of an LDLᵀ factorisation of the shifted
covariance count the eigenvalues above a shift, bisection by such counts leaves one eigenvalue in an interval, Rayleigh
quotient iteration finds it together with its vector, and counts on both sides of the result certify its number. What
counts cannot part (equal to double precision) is one invariant space, from which any orthonormal vectors are taken.

What reaches the driver are one number per dimension and one per pair of dimensions, whatever the number of rows.

Edge cases: a vector that is null, empty or holds null or non-finite entries takes no part, nor does one of another length
than most (of equally frequent lengths the shorter counts), nor one with an entry whose whole number does not fit a long; rows without an id and repeated rows take
part like others; components whose eigenvalue is zero to rounding (constant dimensions, fewer rows than dimensions) do
not exist, so one row or equal rows alone give no rows; a deviation that does not fit a long is null; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import stage

# Fixed values of the contract.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32

_PART = 31  # whole numbers travel in parts of 31 bits, whose sums do not overflow
_MASK = (1 << _PART) - 1
_EXACT = 1 << 53  # up to here doubles are whole numbers
_BLOCK = 4096  # rows multiplied at once
_ALPHA = (1 + 17**0.5) / 8  # fixed value: the pivot rule that bounds the growth of entries


# ---- eigenvalues of one matrix ----------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than the shift: the positive pivots of LDLᵀ of the shifted matrix."""
    a = matrix - shift * np.eye(len(matrix))
    d, k, count = len(a), 0, 0
    while k < d:
        below = np.abs(a[k + 1 :, k])
        two = False
        if len(below) and below.max() > 0:
            r, most = k + 1 + int(below.argmax()), below.max()
            if abs(a[k, k]) < _ALPHA * most:
                row = np.abs(a[k:, r])
                row[r - k] = 0
                if abs(a[k, k]) * row.max() < _ALPHA * most**2:
                    two = abs(a[r, r]) < _ALPHA * row.max()
                    _exchange(a, k + two, r)
        if two:
            pivot = a[k : k + 2, k : k + 2]
            det, trace = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] ** 2, pivot[0, 0] + pivot[1, 1]
            count += 1 if det < 0 else 2 * (trace > 0)
            left = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= left @ np.linalg.solve(pivot, left.T)
            k += 2
        else:
            pivot = a[k, k]
            if pivot != 0:
                count += pivot > 0
                left = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(left, left / pivot)
            k += 1
    return int(count)


def _exchange(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def _apart(block: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """The columns, less their parts along the vectors found."""
    for _ in range(2 if found else 0):
        basis = np.column_stack(found)
        block = block - basis @ (basis.T @ block)
    return block


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, size: float) -> np.ndarray:
    """(matrix - shift)^-1 right; a shift that is an eigenvalue is moved by one rounding error."""
    for moved in (0.0, 1.0, 4.0, 16.0):
        try:
            done = np.linalg.solve(matrix - (shift + moved * 2**-52 * size) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(done).all():
            return done
    return right


class Spectrum:
    """Eigenvalues of a symmetric matrix by number, 1 for the largest, with unit eigenvectors."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.d = matrix, len(matrix)
        self.size = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
        self.tight = self.size * 2.0**-46
        self.counts = {2 * self.size + 1.0: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def leading(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Values and vectors (columns) of the first ``wanted`` components that are not zero to rounding."""
        least = self.size * self.d * 2.0**-44
        wanted = min(wanted, self.count(least)) if self.size > 0 else 0
        values: list[float] = []
        vectors: list[np.ndarray] = []
        while len(values) < wanted:
            new_values, new_vectors = self._next(len(values) + 1, vectors)
            for value, vector in list(zip(new_values, new_vectors))[: wanted - len(values)]:
                values.append(value)
                vectors.append(vector if vector[np.abs(vector).argmax()] > 0 else -vector)
        return np.array(values), np.column_stack(vectors) if vectors else np.zeros((self.d, 0))

    def _next(self, number: int, found: list[np.ndarray]) -> tuple[list[float], list[np.ndarray]]:
        while True:
            low = max(s for s, n in self.counts.items() if n >= number)
            high = min(s for s, n in self.counts.items() if n < number and s > low)
            held = self.count(low) - self.count(high)
            if held == 1:
                one = self._isolated(number, low, high, found)
                if one:
                    return [one[0]], [one[1]]
            if high - low <= self.tight:
                return self._cluster(low, high, held, found)
            self.count((low + high) / 2)

    def _isolated(self, number: int, low: float, high: float, found: list[np.ndarray]):
        """The only eigenvalue in the interval, or None if the iteration ends elsewhere."""
        start = np.random.default_rng(number).standard_normal((self.d, 1))
        shift, u = (low + high) / 2, _apart(start, found)[:, 0]
        for _ in range(12):
            u = _apart(_solved(self.matrix, shift, u, self.size)[:, None], found)[:, 0]
            u /= np.linalg.norm(u)
            image = self.matrix @ u
            shift = float(u @ image)
            error = float(np.linalg.norm(image - shift * u))
            if not low <= shift <= high:
                return None
            if error <= self.size * 2.0**-50:
                break
        margin = max(2 * error, self.tight)
        certain = error <= self.tight and self.count(shift + margin) == number - 1 and self.count(shift - margin) == number
        return (shift, u) if certain else None

    def _cluster(self, low: float, high: float, held: int, found: list[np.ndarray]):
        """Orthonormal vectors of eigenvalues that counts cannot part."""
        block = np.random.default_rng(held).standard_normal((self.d, held))
        for _ in range(4):
            block = np.linalg.qr(_apart(_solved(self.matrix, (low + high) / 2, block, self.size), found))[0]
        return [float(u @ self.matrix @ u) for u in block.T], list(block.T)


# ---- passes over the rows ---------------------------------------------------


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the vectors, all entries times the scale, and which vectors are sound."""
    column = batch.column(batch.schema.get_field_index("vector"))
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE  # a null entry comes as NaN
    starts, lengths = offsets[:-1], np.diff(offsets)
    bad = np.concatenate(([0], np.cumsum(~(np.abs(values) < 2.0**62))))
    sound = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0) & (bad[offsets[1:]] == bad[starts])
    return starts, lengths, values, sound


def _whole(values: np.ndarray, starts: np.ndarray, d: int) -> np.ndarray:
    return np.floor(values[starts[:, None] + np.arange(d)]).astype(np.int64) + SHIFT


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, whole numbers) of the sound vectors of length d, some thousand at a time."""
    starts, lengths, values, sound = _batch(batch)
    rows = np.flatnonzero(sound & (lengths == d))
    for i in range(0, len(rows), _BLOCK):
        yield rows[i : i + _BLOCK], _whole(values, starts[rows[i : i + _BLOCK]], d)


def _parts(cells: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(cell, part, value) of whole numbers of any size: 31 bits a part, the last one signed, parts of zero left out."""
    for cell, total in enumerate(cells.tolist()):
        part = 0
        while total:
            value = total if -_MASK <= total <= _MASK else total & _MASK
            yield cell, part, value
            total, part = (total - value) >> _PART, part + 1


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length and dimension: rows, sum in two parts, largest entry in size."""
    held: dict[int, list] = {}
    for batch in batches:
        starts, lengths, values, sound = _batch(batch)
        for d in np.unique(lengths[sound]).tolist():
            rows = np.flatnonzero(sound & (lengths == d))
            for i in range(0, len(rows), _BLOCK):
                x = _whole(values, starts[rows[i : i + _BLOCK]], d)
                own = held.setdefault(d, [0, np.zeros(d, np.int64), np.zeros(d, np.int64), 0])
                own[0] += len(x)
                own[1] += (x >> _PART).sum(axis=0)
                own[2] += (x & _MASK).sum(axis=0)
                own[3] = max(own[3], int(np.abs(x).max()))
    for d, (n, high, low, most) in held.items():
        yield pa.RecordBatch.from_pydict(
            {"length": pa.array([d] * d, pa.int32()), "dimension": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()),
             "high": pa.array(high), "low": pa.array(low), "most": pa.array([most] * d, pa.int64())}
        )


@dataclass(frozen=True)
class Fit:
    """Rows, exact sums per dimension and the largest entry in size of the vectors that take part."""

    n: int
    sums: tuple[int, ...]
    most: int

    @property
    def middle(self) -> np.ndarray:
        """The whole part of each mean."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the mean exceeds its whole part by."""
        return [s % self.n for s in self.sums]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, as doubles."""
        return (x - self.middle).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2; Python's whole numbers where a long might not do."""
        if len(self.sums) * (2 * self.n * (self.most + 1)) ** 2 < 1 << 63:
            return ((self.n * x - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        off = self.n * (x - self.middle).astype(object) - np.array(self.rest, dtype=object)
        return [v if v < 1 << 63 else None for v in (off**2).sum(axis=1).tolist()]


def _products(fit: Fit):
    """Per pair of dimensions the sum of products of entries less the whole part of the mean, in parts."""
    d = len(fit.sums)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            for _, x in _blocks(batch, d):
                y = x - fit.middle
                if int(np.abs(y).max()) ** 2 * len(y) < _EXACT:
                    f = y.astype(np.float64)
                    total = total + (f.T @ f).astype(np.int64)  # whole numbers below 2^53: no rounding
                else:
                    y = y.astype(object)
                    total = total + y.T.dot(y)
        cells, parts, values = zip(*_parts(total[upper])) if total.any() else ((), (), ())
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int32()), "part": pa.array(parts, pa.int32()), "value": pa.array(values, pa.int64())})

    return run


def _spread(fit: Fit, project: np.ndarray):
    """Sums and sums of products of the whitened rows: cells of the upper triangle, then one per component."""
    upper = np.triu_indices(project.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((project.shape[1],) * 2), np.zeros(project.shape[1])
        for batch in batches:
            for _, x in _blocks(batch, len(project)):
                w = fit.centred(x) @ project
                products += w.T @ w
                sums += w.sum(axis=0)
        cells = np.concatenate((products[upper], sums))
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(len(cells)), pa.int32()), "total": pa.array(cells)})

    return run


def _whitened(fit: Fit, project: np.ndarray, explained: np.ndarray, identity_error: float):
    k = project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for rows, x in _blocks(batch, len(project)):
                m = len(rows)
                deviation = pa.array(fit.deviations(x), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": ids.take(pa.array(rows)).take(each),
                        "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        "n": pa.array(np.full(m * k, fit.n, dtype=np.int64)),
                        "deviation": deviation.take(each),
                        "whitened": pa.array((fit.centred(x) @ project).ravel()),
                        "explained": pa.array(np.tile(explained, m)),
                        "identity_error": pa.array(np.full(m * k, identity_error)),
                    }
                )

    return run


_ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def covariance(rows: DataFrame, fit: Fit) -> np.ndarray:
    """The covariance with divisor n, each entry the nearest double."""
    d = len(fit.sums)
    parts = rows.mapInArrow(_products(fit), "cell int, part int, value long").groupBy("cell", "part").agg(F.sum("value").alias("value"))
    totals, rest = [0] * (d * (d + 1) // 2), fit.rest
    for row in parts.collect():  # a few rows per pair of dimensions
        totals[row.cell] += row.value << (_PART * row.part)
    out = np.zeros((d, d))
    for total, i, j in zip(totals, *np.triu_indices(d), strict=True):
        out[i, j] = out[j, i] = (fit.n * total - rest[i] * rest[j]) / (fit.n * fit.n)
    return out


def fitted(rows: DataFrame) -> Fit | None:
    """Sums over all vectors of the most frequent length; None if there are none."""
    sums = rows.mapInArrow(_sums, "length int, dimension int, n long, high long, low long, most long").groupBy("length", "dimension")
    totals = stage(sums.agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"), F.max("most").alias("most")), "sums")
    best = totals.where("dimension = 0").orderBy(F.desc("n"), "length").first()
    if best is None:
        return None
    found = totals.where(F.col("length") == best["length"]).orderBy("dimension").collect()  # one row per dimension
    return Fit(best["n"], tuple((r.high << _PART) + r.low for r in found), max(r.most for r in found))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: the whitened coordinate, and figures of the fit."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    empty = embeddings.sparkSession.createDataFrame([], _ROW)
    fit = fitted(rows.select("vector"))
    if fit is None:
        return empty
    matrix = covariance(rows.select("vector"), fit)
    values, vectors = Spectrum(matrix).leading(components)
    k = len(values)
    if not k:
        return empty
    project = vectors / np.sqrt(values)
    cells = rows.select("vector").mapInArrow(_spread(fit, project), "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    total = np.zeros(k * (k + 1) // 2 + k)
    for row in cells.collect():  # one row per pair of components
        total[row.cell] = row.total
    means = total[-k:] / fit.n
    spread, (i, j) = total[:-k] / fit.n, np.triu_indices(k)
    identity_error = float(np.abs(spread - means[i] * means[j] - (i == j)).max())
    explained = values / np.trace(matrix)
    return rows.mapInArrow(_whitened(fit, project, explained, identity_error), _ROW)
