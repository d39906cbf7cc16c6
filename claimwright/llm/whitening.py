"""Operator 11: embedding whitening by a bidiagonal qd solver.

Fit. One pass adds up the entries exactly. Then every task reduces its centred rows to a triangle, block after
block: the QR decomposition of the triangle so far on top of the next block. Triangles are merged in the same way,
in a bounded number of tasks and at last on the driver; what travels there is at most ``MERGERS`` triangles, whose
size depends on the dimensions alone.

Solve. Householder reflections make the triangle bidiagonal. dqds, the differential quotient-difference iteration
with shifts, finds the squares of its singular values; it subtracts nothing but the shift, so that small values keep
their digits. The direction that belongs to one comes from the two factorisations of the shifted matrix, from the
top and from the bottom, glued at the place with the smallest remainder (twisted factorisation).

Apply. Rows are projected in place, without a shuffle; the covariance of the result is measured in a further pass.

Vectors that are null or hold null or non-finite entries take no part, nor do those whose entries, as fixed-point
numbers, exceed a long. Vectors shorter than the longest count as 0 in the entries they lack. Repeated rows (or
ids) count and come out each; a null id stays null. Equal variances have no directions of their own: any of their
space. A direction without variance (one row, copies of one row, fewer rows than dimensions) has null as whitened
value; ``identity_error`` is measured over the others and null if there are none, as is ``explained`` where all
rows are equal. ``deviation`` is null where it exceeds a long. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SCALE, BASE = 1024, 100_000
MERGERS = 16
_EPS = float(np.finfo(float).eps)
_LARGEST = 1 << 62

# Rows --------------------------------------------------------------------------------------------


def fixed_point(vectors: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that take part, and floor(1024 c) of their entries, missing ones as 0."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    scaled = np.floor(np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=float) * SCALE)
    row = np.repeat(np.arange(len(vectors)), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    keep = vectors.is_valid().to_numpy(zero_copy_only=False).astype(bool)
    keep[row[~(np.abs(scaled) < _LARGEST)]] = False
    places = np.flatnonzero(keep)
    out = np.zeros((len(places), width if width is not None else int(lengths[keep].max(initial=0))), dtype=np.int64)
    inside = keep[row]
    out[(np.cumsum(keep) - 1)[row[inside]], column[inside]] = scaled[inside].astype(np.int64)
    return places, out


def offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as 64-bit integers where they hold it, else as Python's."""
    reach = max([abs(s) for s in sums], default=0) + n * int(np.abs(x).max(initial=0))
    if reach < _LARGEST:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squared_lengths(off: np.ndarray) -> list[int | None]:
    most = int(np.abs(off).max(initial=0))
    exact = off if most * most * max(1, off.shape[1]) < _LARGEST else off.astype(object)
    return [v if (v := int(s)) < 1 << 63 else None for s in (exact * exact).sum(axis=1)]


# Partial results of tasks, merged ----------------------------------------------------------------


def _folded(vectors: DataFrame, block: Callable, merge: Callable, tasks: int = MERGERS):
    """One partial result over all rows: ``block`` of each Arrow batch, merged within a task, then by ``tasks``
    tasks, then on the driver, always in the order of the partitions. Partial results are tuples of float arrays."""

    def pack(part: int, state) -> pa.RecordBatch:
        shapes = [list(a.shape) for a in state]
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([shapes], pa.list_(pa.list_(pa.int64()))), pa.array([[a.tobytes() for a in state]], pa.list_(pa.binary()))],
            names=["part", "shapes", "state"],
        )

    def unpack(shapes, state):
        return tuple(np.frombuffer(b).reshape(s) for s, b in zip(shapes, state))

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows and (found := block(batch)) is not None:
                state = found if state is None else merge(state, found)
        if state is not None:
            yield pack(TaskContext.get().partitionId(), state)

    def then(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, least = None, None
        for batch in batches:
            for row in batch.to_pylist():
                found = unpack(row["shapes"], row["state"])
                state, least = (found, row["part"]) if state is None else (merge(state, found), least)
        if state is not None:
            yield pack(least, state)

    schema = "part bigint, shapes array<array<bigint>>, state array<binary>"
    merged = vectors.mapInArrow(first, schema).repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(then, schema)
    state = None
    for row in sorted(merged.collect(), key=lambda r: r.part):
        found = unpack(row.shapes, row.state)
        state = found if state is None else merge(state, found)
    return state


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors that take part and the exact sum of each dimension's x."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, []
        for batch in batches:
            places, x = fixed_point(batch.column("vector"))
            n += len(places)
            # High and low halves add up without overflow.
            part = [(int(h) << 32) + int(low) for h, low in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
            sums += [0] * (len(part) - len(sums))
            sums = [a + b for a, b in zip(sums, part + [0] * (len(sums) - len(part)))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[Decimal(s) for s in sums]], pa.list_(pa.decimal128(38, 0)))], names=["n", "sums"])

    parts = vectors.mapInArrow(run, "n bigint, sums array<decimal(38,0)>")
    # Place -1 carries the number of vectors.
    rows = parts.select(F.posexplode(F.concat(F.array(F.col("n").cast("decimal(38,0)")), "sums")).alias("place", "value"))
    found = {r.place: int(r.value) for r in rows.groupBy("place").agg(F.sum("value").alias("value")).collect()}
    n = found.pop(0, 0)
    return n, [found[i] + n * BASE for i in sorted(found)]


def stacked(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The triangle of two blocks of rows, one on top of the other."""
    return np.linalg.qr(np.vstack([upper, lower]), mode="r")


def triangle(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR decomposition of all centred rows."""

    def block(batch: pa.RecordBatch):
        places, x = fixed_point(batch.column("vector"), len(sums))
        if not len(places):
            return None
        return (np.linalg.qr((offsets(x + BASE, n, sums) / n).astype(float), mode="r"),)

    found = _folded(vectors, block, lambda a, b: (stacked(a[0], b[0]),))
    out = np.zeros((len(sums), len(sums)))
    if found is not None:
        out[: len(found[0])] = found[0]
    return out


# Bidiagonal form, qd iteration, twisted factorisation --------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vector v and value b with (I - 2 v v') x = b e1."""
    scale = float(np.abs(x).max(initial=0.0))
    if scale < 1e-290:
        return np.zeros_like(x), 0.0
    v = x / scale  # so that no square underflows
    b = -float(np.linalg.norm(v)) if v[0] >= 0 else float(np.linalg.norm(v))
    v[0] -= b
    return v / np.linalg.norm(v), b * scale


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of r = U B V'."""
    a, d = r.astype(float).copy(), len(r)
    v = np.eye(d)
    upper = np.zeros(max(0, d - 1))
    diagonal = np.zeros(d)
    for k in range(d):
        h, diagonal[k] = _reflector(a[k:, k])
        a[k:, k + 1:] -= 2 * np.outer(h, h @ a[k:, k + 1:])
        if k < d - 1:
            h, upper[k] = _reflector(a[k, k + 1:])
            a[k + 1:, k + 1:] -= 2 * np.outer(a[k + 1:, k + 1:] @ h, h)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ h, h)
    return diagonal, upper, v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; none if the shift was too large."""
    d, new_q, new_e = q[0] - shift, [], []
    for i, link in enumerate(e):
        if d < 0:
            return None
        new = d + link
        ratio = q[i + 1] / new if new else 0.0
        new_q.append(new)
        new_e.append(link * ratio)
        d = (d * ratio if new else q[i + 1]) - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def _safe_shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the least eigenvalue: one over the trace of the inverse, added up without subtraction."""
    column, trace = 0.0, 0.0
    for i, value in enumerate(q):
        if value == 0:
            return 0.0
        column = (1 + (e[i - 1] * column if i else 0.0)) / value
        trace += column
    return (1 - 16 * len(q) * _EPS) / trace if np.isfinite(trace) else 0.0


def qd_eigenvalues(diagonal: Iterable[float], upper: Iterable[float]) -> list[float]:
    """Squares of the singular values of a bidiagonal matrix, falling."""
    tolerance = (100 * _EPS) ** 2
    found: list[float] = []
    segments = [([float(a) ** 2 for a in diagonal], [float(b) ** 2 for b in upper], 0.0)]
    while segments:
        q, e, moved = segments.pop()
        for _ in range(200 * len(q) + 200):
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tolerance * (moved + min(q[i], q[i + 1])) or e[i] < 1e-290), None)
            if cut is not None:  # a negligible link: two matrices
                segments.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if len(q) <= 1:
                found += [moved + a for a in q]
                break
            if q[0] < q[-1] / 1.5:  # the least ones belong at the end
                q, e = q[::-1], e[::-1]
            shift = _safe_shift(q, e)
            if shift <= _EPS / 4 * moved:
                shift = 0.0
            new = _step(q, e, shift)
            if new is None:
                shift, new = 0.0, _step(q, e, 0.0)
            (q, e), moved = new, moved + shift
        else:
            raise ArithmeticError("the qd iteration did not end")
    return sorted(found, reverse=True)


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B at ``value`` by its twisted factorisation."""
    q, e, coupling = diagonal**2, upper**2, diagonal[:-1] * upper
    n, tiny = len(q), _EPS * max(abs(value), float(q.max(initial=0)), 1e-300)
    from_top, s = np.empty(n), np.empty(n)  # pivots downward, and what is left of the shift
    s[0] = -value
    for i in range(n):
        from_top[i] = q[i] + s[i] or tiny
        if i < n - 1:
            s[i + 1] = e[i] * (s[i] / from_top[i]) - value
    from_end, p = np.empty(n), np.empty(n)  # pivots upward
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        from_end[i + 1] = e[i] + p[i + 1] or tiny
        p[i] = (p[i + 1] * (q[i] / from_end[i + 1]) if e[i] else q[i]) - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -coupling[i] / from_top[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -coupling[i] / from_end[i + 1] * z[i]
    return z / np.linalg.norm(z)


def _vectors(diagonal: np.ndarray, upper: np.ndarray, values: list[float], wanted: int) -> np.ndarray:
    """Eigenvectors of B'B, as rows, of the first values. Those of close values are made orthogonal; where the
    factorisation gives a direction twice, inverse iteration finds another of the same space."""
    out = np.zeros((wanted, len(diagonal)))
    full = np.diag(diagonal) + np.diag(upper, 1)
    full = full.T @ full
    for i in range(wanted):
        z = twisted_vector(diagonal, upper, values[i])
        near = out[[j for j in range(i) if values[j] - values[i] <= 1e-3 * values[j] or values[j] <= len(z) * _EPS * values[0]]]
        for attempt in range(4):
            for _ in range(2):
                z = z - near.T @ (near @ z)
            if np.linalg.norm(z) > 0.5:
                break
            start = np.random.default_rng([i, attempt]).normal(size=len(z))
            start -= near.T @ (near @ start)
            moved = full - values[i] * (1 + 4 * _EPS) * np.eye(len(z))
            try:
                z = np.linalg.solve(moved + np.diag(np.full(len(z), _EPS * values[0])), start)
            except np.linalg.LinAlgError:
                z = start
            z /= np.linalg.norm(z)
        out[i] = z / np.linalg.norm(z)
    return out


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    #: Unit directions as rows, by falling variance, at most as many as asked for.
    directions: np.ndarray
    variances: np.ndarray
    #: Sum of the variances of all directions.
    trace: float

    def standing(self) -> np.ndarray:
        """Directions that have a variance, beyond what rounding leaves of none."""
        most = self.variances.max(initial=0.0)
        return self.variances > (len(self.sums) * 8 * _EPS) ** 2 * max(most, 1e-300)

    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace > 0 else None for v in self.variances]

    def project(self, off: np.ndarray) -> np.ndarray:
        """Whitened values of rows of n * x - S; not a number for directions without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = (off / max(self.n, 1)).astype(float) @ self.directions.T / np.sqrt(self.variances)
        return np.where(self.standing(), scaled, np.nan)


def solve(r: np.ndarray, n: int, sums: list[int], components: int) -> Whitening:
    diagonal, upper, v = bidiagonal(r)
    values = qd_eigenvalues(diagonal, upper)
    wanted = min(components, len(values))
    directions = _vectors(diagonal, upper, values, wanted) @ v.T
    for z in directions:
        z *= 1.0 if z[np.argmax(np.abs(z))] > 0 else -1.0
    return Whitening(n, sums, directions, np.array(values[:wanted]) / n, float((r * r).sum()) / n)


# Operator ----------------------------------------------------------------------------------------


def _vector_column(embeddings: DataFrame, column: str) -> DataFrame:
    return embeddings.select("vec_id", F.col(column).cast("array<double>").alias("vector"))


def fit(embeddings: DataFrame, components: int = 8, column: str = "embedding") -> Whitening | None:
    """Directions of the rows; none if no vector takes part."""
    vectors = _vector_column(embeddings, column).select("vector")
    n, sums = totals(vectors)
    return solve(triangle(vectors, n, sums), n, sums, components) if n else None


def identity_error(embeddings: DataFrame, model: Whitening, column: str = "embedding") -> float | None:
    """Largest entry of the whitened rows' covariance less the identity, measured over all rows, each block
    centred before it is multiplied."""
    use = model.standing()
    if not use.any():
        return None

    def block(batch: pa.RecordBatch):
        places, x = fixed_point(batch.column("vector"), len(model.sums))
        if not len(places):
            return None
        w = model.project(offsets(x + BASE, model.n, model.sums))[:, use]
        mean = w.mean(axis=0)
        return np.array([float(len(w))]), mean, (w - mean).T @ (w - mean)

    def merge(a, b):
        n, step = a[0] + b[0], b[1] - a[1]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)

    n, _, squares = _folded(_vector_column(embeddings, column).select("vector"), block, merge)
    return float(np.abs(squares / n[0] - np.eye(len(squares))).max())


def whitened(embeddings: DataFrame, components: int = 8, column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model = fit(embeddings, components, column)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error, explained = identity_error(embeddings, model, column), model.explained()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        for batch in batches:
            places, x = fixed_point(batch.column("vector"), len(model.sums))
            off = offsets(x + BASE, model.n, model.sums)
            m = len(places)
            ids = batch.column("vec_id").take(pa.array(np.repeat(places, k)))
            deviations = pa.array(squared_lengths(off), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n), pa.int64()), deviations,
                 pa.array(model.project(off).ravel(), pa.float64(), from_pandas=True), pa.array(explained * m, pa.float64()),
                 pa.array([error] * (m * k), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return _vector_column(embeddings, column).mapInArrow(run, schema)
