"""Whitening of embeddings by a bidiagonal qd solver.

The rows are whole numbers, so their count and sums are exact, and a row is centred exactly, as n * x - sum,
before it becomes floating point. Each task reduces its centred rows block by block to a triangle
R by QR; triangles are stacked and reduced again, ``FAN`` at a time, until one is left, which has
as many rows as vectors have entries. Its singular values and right singular vectors
are those of all centred rows; the covariance is never formed, so nothing is squared before it is known.

Householder reflections turn R into an upper bidiagonal B. dqds (the differential quotient-difference
transform with shifts) finds the squares of its singular values to high relative accuracy; shifts are
Newton's lower bound for the least one. For each of them the factorisations of B'B - value from
the top and from the bottom are twisted together where they leave the least, which gives
the vector at once. Vectors of values that nearly agree are made orthogonal to each other.

Vectors that are shorter than others are filled up with ``missing``. A null vec_id is kept as it is; rows that
are repeated count and come back as often; other columns are not looked at. Directions without
variance (constant entries, fewer rows than entries) cannot be scaled to 1 and are left out. An empty table, or
one without variance, gives no component. Vectors of more than ``WIDEST`` entries are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.sources import stored

#: Entries of the longest vector: a triangle of them is what one task and the driver hold.
WIDEST = 2048
#: Triangles that are reduced to one at a time.
FAN = 16
#: Numbers of a block of rows.
BLOCK = 1 << 20
#: Values closer than this, relative to their size, have vectors made orthogonal explicitly.
CLOSE = 1e-3
EPS = float(np.finfo(np.float64).eps)
#: What stands for a zero, relative to the largest value, so that quotients exist.
ZERO = 1e-200
#: Entries beyond this in size do not fit a long with room to spare.
LARGEST = float(1 << 62)


@dataclass
class Whitening:
    """``sums`` and ``least`` are whole numbers by entry; ``directions`` are scaled, a column per component."""

    n: int
    sums: list[int]
    least: list[int]
    most: list[int]
    missing: int
    directions: np.ndarray
    explained: list[float]

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums: exact, in longs where they hold it, else in Python's numbers."""
        reach = max((self.n * (b - a) for a, b in zip(self.least, self.most)), default=0)
        kind = np.int64 if reach < 1 << 62 else object
        base = np.array(self.least, dtype=kind)
        off = np.array([s - self.n * a for s, a in zip(self.sums, self.least)], dtype=kind)
        return self.n * (x.astype(kind) - base) - off

    def deviations(self, centred: np.ndarray) -> pa.Array:
        largest = max((self.n * (b - a) for a, b in zip(self.least, self.most)), default=0)
        if self.width * largest**2 < 1 << 62:
            return pa.array((centred * centred).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = (centred.astype(object) ** 2).sum(axis=1)
        # Sums that 38 digits cannot hold are null.
        return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))

    def rows(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) / max(self.n, 1)


def integer_vectors(table: DataFrame, scale: int, offset: int, vector: str = "embedding") -> DataFrame:
    """vec_id, x: floor(scale * c) + offset of each entry c.

    Rows go whose vector is null or holds an entry that is null, not finite or too large for a long.
    """
    good = F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)) & ~F.isnan(c)
    )
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))
    return table.where(F.col(vector).isNotNull() & good).select("vec_id", x.alias("x"))


def fit(vectors: DataFrame, components: int, missing: int = 0) -> Whitening:
    """What whitens ``x`` of ``vectors``; runs jobs. ``vectors`` is read twice."""
    found = _counted(vectors, missing)
    if not found.n or not found.width:
        return found
    values, directions = singular(_triangle(vectors, found))
    kept = values > (found.width * EPS) ** 2 * values[0] if values[0] > 0 else values > 0
    kept &= np.arange(len(values)) < components
    values, total = values[kept], values.sum()
    found.directions = directions[:, kept] * np.sqrt(found.n / values)
    found.explained = (values / total).tolist()
    return found


def whitened(vectors: DataFrame, by: Whitening) -> DataFrame:
    """vec_id, deviation, whitened: per row the sum of (n * x - sums)**2, exact, and its components."""
    kind = vectors.schema["vec_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _blocks(batch, by.width, by.missing):
                centred = by.centred(x)
                parts = by.rows(centred) @ by.directions
                ends = np.arange(len(ids) + 1, dtype=np.int32) * parts.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(parts.reshape(-1)))
                columns = [ids, by.deviations(centred), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    schema = f"vec_id {kind.simpleString()}, deviation decimal(38,0), whitened array<double>"
    return vectors.select("vec_id", "x").mapInArrow(run, schema)


def identity_error(vectors: DataFrame, by: Whitening) -> float:
    """The largest entry, in size, of the covariance of all whitened rows minus the identity; a job.

    Each block is centred on its own mean and blocks are put together from their means, so nothing
    large is subtracted.
    """
    width = by.directions.shape[1]
    if not width:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for _, x in _blocks(batch, by.width, by.missing):
                parts = by.rows(by.centred(x)) @ by.directions
                n, mean, spread = _merged(n, mean, spread, *_moments(parts))
        if n:
            yield _row(n, [*mean, *spread[np.triu_indices(width)]])

    parts = vectors.select("vec_id", "x").mapInArrow(run, "n long, numbers array<double>")
    # One row per task; added up number by number, means weighted by their rows.
    parts = stored(parts, "whiten-moments")
    by_place = parts.select("n", F.posexplode("numbers").alias("place", "value"))
    first = F.col("place") < width
    means = by_place.where(first).groupBy("place").agg(
        (F.sum(F.col("n") * F.col("value")) / by.n).alias("value")
    )
    mean = _by_place(means, width)
    names = np.triu_indices(width)
    centre = F.array(*(F.lit(float(m)) for m in mean))
    apart = F.zip_with(F.slice("numbers", 1, width), centre, lambda a, b: a - b)
    rows = parts.select("n", apart.alias("apart"), F.slice("numbers", width + 1, len(names[0])).alias("spread"))
    pairs = F.array(*(F.struct(F.lit(int(i)).alias("i"), F.lit(int(j)).alias("j")) for i, j in zip(*names)))
    rows = rows.select("n", "apart", F.posexplode(F.arrays_zip("spread", pairs.alias("pair"))).alias("place", "at"))
    between = F.col("n") * F.get("apart", F.col("at.pair.i")) * F.get("apart", F.col("at.pair.j"))
    sums = rows.groupBy("place").agg((F.sum(F.col("at.spread") + between) / by.n).alias("value"))
    wanted = np.eye(width)[names]
    return float(np.abs(_by_place(sums, len(wanted)) - wanted).max())


def _by_place(rows: DataFrame, size: int) -> np.ndarray:
    found = np.zeros(size)
    for row in rows.collect():
        found[row["place"]] = row["value"]
    return found


def _moments(rows: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = rows.mean(axis=0)
    apart = rows - mean
    return len(rows), mean, apart.T @ apart


def _merged(n, mean, spread, m, other, more) -> tuple[int, np.ndarray, np.ndarray]:
    gap, total = other - mean, n + m
    return total, mean + gap * (m / total), spread + more + np.outer(gap, gap) * (n * m / total)


def _row(n: int, numbers: list[float]) -> pa.RecordBatch:
    columns = [pa.array([n], pa.int64()), pa.array([numbers], pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(columns, names=["n", "numbers"])


def _blocks(batch: pa.RecordBatch, width: int, missing: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors of some rows at a time, all ``width`` wide."""
    step = max(BLOCK // max(width, 1), 1)
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        lists = part.column(1)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        if (lengths == width).all():
            x = values.reshape(len(lengths), width)
        else:
            x = np.full((len(lengths), width), missing, dtype=np.int64)
            x[np.arange(width)[None, :] < lengths[:, None]] = values
        yield part.column(0), x


def _counted(vectors: DataFrame, missing: int) -> Whitening:
    """Number of rows, and by entry the exact sum, the least and the largest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, stats = 0, []  # by entry: how many rows have it, sum, least, largest
        for batch in batches:
            n += batch.num_rows
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            wide = int(lengths.max()) if len(lengths) else 0
            stats += [[0, 0, None, None] for _ in range(wide - len(stats))]
            for _, x in _blocks(batch, wide, missing):
                least, most = x.min(axis=0).tolist(), x.max(axis=0).tolist()
                # Halves of the numbers, so that sums of a block cannot overflow.
                high, low = (x >> 31).sum(axis=0).tolist(), (x & 0x7FFFFFFF).sum(axis=0).tolist()
                for k in range(wide):
                    s = stats[k]
                    s[0] += len(x)
                    s[1] += (high[k] << 31) + low[k]
                    s[2] = least[k] if s[2] is None else min(s[2], least[k])
                    s[3] = most[k] if s[3] is None else max(s[3], most[k])
        for k, (count, total, least, most) in enumerate(stats):
            # Rows of other batches that are too short for this entry.
            total += (n - count) * missing
            if count < n:
                least, most = min(least, missing), max(most, missing)
            yield _stat(k, n, total, least, most)
        if n:
            yield _stat(-1, n, 0, 0, 0)

    schema = "k int, n long, total decimal(38,0), least long, most long"
    parts = vectors.select("vec_id", "x").mapInArrow(run, schema)
    rows = parts.groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    # One row per entry and one for all; more entries than a triangle may have are an error.
    rows = {row["k"]: row for row in rows.orderBy("k").limit(WIDEST + 2).collect()}
    if len(rows) > WIDEST + 1:
        raise ValueError(f"vectors of more than {WIDEST} entries")
    n = rows.pop(-1)["n"] if rows else 0
    found = Whitening(n, [], [], [], missing, np.zeros((len(rows), 0)), [])
    for k in range(len(rows)):
        row = rows[k]
        short = n - row["n"]  # rows of tasks whose vectors all end before this entry
        found.sums.append(int(row["total"]) + short * missing)
        found.least.append(min(row["least"], missing) if short else row["least"])
        found.most.append(max(row["most"], missing) if short else row["most"])
    return found


def _stat(k: int, n: int, total: int, least: int, most: int) -> pa.RecordBatch:
    columns = [
        pa.array([k], pa.int32()), pa.array([n], pa.int64()), pa.array([Decimal(total)], pa.decimal128(38, 0)),
        pa.array([least], pa.int64()), pa.array([most], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["k", "n", "total", "least", "most"])


def _triangle(vectors: DataFrame, by: Whitening) -> np.ndarray:
    """R of all centred rows: by task, then ``FAN`` triangles at a time."""
    width = by.width

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            for _, x in _blocks(batch, width, by.missing):
                r = np.linalg.qr(np.vstack([r, by.rows(by.centred(x))]), mode="r")
        if len(r):
            yield _packed(TaskContext.get().partitionId(), r)

    parts = stored(
        vectors.select("vec_id", "x").mapInArrow(reduce_rows, "part long, r binary"), "whiten-triangles"
    )
    while (count := parts.count()) > 1:
        groups = -(-count // FAN)
        # Numbered without gaps, so that no group gets more than its share.
        parts = stored(_numbered(parts, groups).groupBy("part").applyInArrow(_stacked(width), "part long, r binary"), "whiten-triangles")
    row = parts.first()
    return np.frombuffer(row["r"], dtype="<f8").reshape(-1, width)


def _numbered(parts: DataFrame, groups: int) -> DataFrame:
    """Task numbers may have gaps; the few rows get the numbers of their order, dealt to groups."""
    order = {row["part"]: k % groups for k, row in enumerate(parts.select("part").orderBy("part").toLocalIterator())}
    pairs = [F.lit(v).cast("long") for pair in order.items() for v in pair]
    return parts.withColumn("part", F.element_at(F.create_map(*pairs), F.col("part")))


def _stacked(width: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(r.as_py(), dtype="<f8").reshape(-1, width) for r in group.column("r")]
        return pa.Table.from_batches([_packed(group.column("part")[0].as_py(), np.linalg.qr(np.vstack(parts), mode="r"))])

    return run


def _packed(part: int, r: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int64()), pa.array([r.astype("<f8").tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["part", "r"])


# The solver, on one triangle


def singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the singular values of ``r``, falling, and the right singular vectors as columns."""
    width = r.shape[1]
    square = np.zeros((width, width))
    square[: min(len(r), width)] = r[:width]
    scale = float(np.abs(square).max()) or 1.0
    a, b, right = bidiagonal(square / scale)
    values, vectors = np.zeros(width), np.zeros((width, width))
    q, e = a * a, b * b
    # Where an off-diagonal entry is nothing beside its neighbours the matrix falls apart.
    cuts = np.flatnonzero(b <= EPS * np.sqrt(a[:-1] * a[1:])) if width > 1 else []
    for start, end in zip([0, *(c + 1 for c in cuts)], [*(c + 1 for c in cuts), width]):
        part = np.sort(dqds(q[start:end], e[start : end - 1]))[::-1]
        values[start:end] = part
        vectors[start:end, start:end] = twisted(a[start:end], b[start : end - 1], part)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale**2, (right @ vectors)[:, order]


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, entries beside it and right transform: r = U B V', with nothing negative in B."""
    r, width = r.copy(), r.shape[1]
    right = np.eye(width)
    for k in range(width):
        if (v := _reflector(r[k:, k])) is not None:
            r[k:, k:] -= 2 * np.outer(v, v @ r[k:, k:])
        if k < width - 2 and (v := _reflector(r[k, k + 1 :])) is not None:
            r[k:, k + 1 :] -= 2 * np.outer(r[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    a, b = np.diag(r).copy(), np.diag(r, 1).copy()
    signs, row = np.ones(width), 1.0
    for k in range(width):
        row = signs[k] if a[k] >= 0 else -signs[k]
        if k < width - 1:
            signs[k + 1] = row if b[k] >= 0 else -row
    return np.abs(a), np.abs(b), right * signs


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """A unit vector whose reflection leaves only the first entry; None if that is so already."""
    size = np.linalg.norm(x[1:])
    if not size:
        return None
    v = x.copy()
    v[0] += np.copysign(np.hypot(x[0], size), x[0])
    return v / np.linalg.norm(v)


def dqds(q: np.ndarray, e: np.ndarray) -> list[float]:
    """The eigenvalues of B'B from the squares of B's diagonal and of the entries beside it."""
    found: list[float] = []
    top = max(max(q, default=0.0), max(e, default=0.0))
    if not top > 0:
        return [0.0] * len(q)
    waiting = [([max(float(v), ZERO * top) for v in q], [float(v) for v in e], 0.0)]
    while waiting:
        q, e, shifted = waiting.pop()
        while len(q) > 1:
            # One that hardly touches the rest is found.
            if e[-1] <= EPS**2 * (shifted + q[-1]):
                found.append(q.pop() + shifted)
                e.pop()
                continue
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS**2 * min(q[k], q[k + 1])), None)
            if cut is not None:
                waiting.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            shift = _shift(q, e)
            step = _transformed(q, e, shift)
            if step is None:  # rounding took the shift past the least value
                shift, step = 0.0, _transformed(q, e, 0.0)
            q, e = step
            shifted += shift
        found.append(q[0] + shifted)
    return found


def _shift(q: list[float], e: list[float]) -> float:
    """Newton's lower bound: the reciprocals of all eigenvalues add up to those of d below."""
    d, total = q[0], 1.0 / q[0]
    for k in range(len(e)):
        d = d / (d + e[k]) * q[k + 1]
        if d <= 0:
            return 0.0
        total += 1.0 / d
    # A little less, against rounding.
    return (1 - 8 * EPS * len(q)) / total


def _transformed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    new_q, new_e = [], []
    d = q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        total = d + e[k]
        ratio = q[k + 1] / total if total > 0 else 0.0
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def twisted(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B as columns, for falling eigenvalues."""
    width = len(a)
    vectors = np.zeros((width, len(values)))
    first = 0  # of the values that nearly agree with this one
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            first = k
        z = _orthogonal(_vector(a, b, float(value)), vectors[:, first:k])
        if z is None:
            z = _another(a, b, float(value), vectors[:, first:k])
        vectors[:, k] = z
    return vectors


def _orthogonal(z: np.ndarray, others: np.ndarray) -> np.ndarray | None:
    """The unit vector that is left beside the others; None if hardly anything is."""
    for _ in range(2):
        z = z - others @ (others.T @ z)
        size = np.linalg.norm(z)
        if not size > 0.1:
            return None
        z = z / size
    return z


def _another(a: np.ndarray, b: np.ndarray, value: float, others: np.ndarray) -> np.ndarray:
    """One more vector for a value whose own one is known already: inverse iteration beside the others."""
    beside = 1 - (others**2).sum(axis=1)
    z = np.zeros(len(a))
    z[np.argmax(beside)] = 1.0
    for _ in range(4):
        for _ in range(2):
            z = z - others @ (others.T @ z)
            z = z / np.linalg.norm(z)
        best, z = z, _solved(a, b, value, z)
        if not np.isfinite(z).all():
            break
        z = z / np.abs(z).max()
    return best


def _solved(a: np.ndarray, b: np.ndarray, value: float, z: np.ndarray) -> np.ndarray:
    """Solves (B'B - value) x = z by the factorisation from the top."""
    d, ld, lld, tiny = _squares(a, b)
    size, x, s = len(a), z.tolist(), -value
    pivots, lower = [], []
    for i in range(size):
        pivot = d[i] + s
        pivots.append(pivot if abs(pivot) > EPS * value + tiny else -(EPS * value + tiny))
        if i < size - 1:
            lower.append(ld[i] / pivots[i])
            s = lld[i] / d[i] * (d[i] / pivots[i]) * s - value
            x[i + 1] -= lower[i] * x[i]
    x[-1] /= pivots[-1]
    for i in range(size - 2, -1, -1):
        x[i] = x[i] / pivots[i] - lower[i] * x[i + 1]
    return np.array(x)


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[list[float], list[float], list[float], float]:
    """Squares of the diagonal, products with what is beside it, squares of that, and next to nothing."""
    top = max(float(a.max()), float(b.max(initial=0.0)))
    a = np.maximum(a, np.sqrt(ZERO) * top)
    return (a * a).tolist(), (a[:-1] * b).tolist(), (b * b).tolist(), ZERO * top * top


def _vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    width = len(a)
    d, ld, lld, tiny = _squares(a, b)

    def safe(x: float) -> float:
        return x if abs(x) > tiny else -tiny

    down, up = [0.0] * width, [0.0] * width
    lower, upper = [0.0] * width, [0.0] * width
    s = down[0] = -value
    for i in range(width - 1):
        pivot = safe(d[i] + s)
        lower[i] = ld[i] / pivot
        s = down[i + 1] = lld[i] / d[i] * (d[i] / pivot) * s - value
    p = up[-1] = d[-1] - value
    for i in range(width - 2, -1, -1):
        pivot = safe(lld[i] + p)
        upper[i] = ld[i] / pivot
        p = up[i] = d[i] / pivot * p - value
    left = np.abs(np.array(down) + np.array(up) + value)
    twist = int(np.nanargmin(left)) if not np.isnan(left).all() else 0
    z = np.zeros(width)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(twist, width - 1):
        z[i + 1] = -upper[i] * z[i]
    size = np.abs(z).max()
    z = z / size
    return z / np.linalg.norm(z)
