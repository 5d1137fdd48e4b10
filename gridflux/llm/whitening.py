"""Embedding whitening by a blockwise QR, a bidiagonal and the qd algorithms.

Vectors become integers on a fixed-point grid.  Their count and sums are exact, so
each task centres its rows by them and reduces blocks of rows to one triangular
factor (Householder QR of the last factor and the next block); factors meet
sixteen at a time until one is left.  What follows is of the size of a vector:
Householder reflections make the factor bidiagonal, dqds finds the squares of its
singular values to high relative accuracy, and a twisted factorisation of the
bidiagonal's shifted Gram matrix gives each wanted direction, made orthogonal
within groups of close values.  A last pass projects all rows.

Defined cases: null vectors and vectors with a null or non-finite entry are dropped
(an entry of 2**40 or more on the grid counts as non-finite); shorter vectors are
padded with zeros; repeated rows count as often as they come; a null id is kept;
equal eigenvalues have some orthonormal directions of their space, the same for all
rows; directions without variance are left out, so constant or single vectors and
an empty table give no rows; a deviation that doesn't fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import stage, table
from gridflux.llm.vectors import fixed_points

SCALE, SHIFT = 1024.0, 100_000
BLOCK_ROWS, FAN_IN = 4096, 16
#: Singular values below this share of the largest are rounding.
NO_VARIANCE = 1e-12
EPS = float(np.finfo(np.float64).eps)


@dataclass
class Centre:
    """Number of vectors and exact sums of their integers; the mean is ``whole + rest / n``."""

    n: int
    sums: list[int]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n x - S)**2; null beyond a long."""
        y, rest, n = x - self.whole, self.rest, self.n
        if not y.size:
            return [0] * len(y)
        most = n * (int(np.abs(y).max()) + 1)
        if most * most * y.shape[1] < 1 << 63:
            return ((n * y - rest) ** 2).sum(axis=1).tolist()
        if max(int(np.abs(y).max()), 1) * max(int(np.abs(y).max()), n) * y.shape[1] >= 1 << 63:
            y, rest = y.astype(object), rest.astype(object)
        squares, mixed, last = (y * y).sum(axis=1).tolist(), (y * rest).sum(axis=1).tolist(), sum(int(r) ** 2 for r in self.rest)
        found = [n * n * a - 2 * n * b + last for a, b in zip(squares, mixed, strict=True)]
        return [v if v < 1 << 63 else None for v in found]


def sums_of(vectors: DataFrame, column: str) -> Centre:
    """Count and sums of all rows that take part, by grouped sums of each batch's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = fixed_points(batch.column(0), SCALE)
            at, total = np.arange(-1, x.shape[1]), np.concatenate(([len(rows)], x.sum(axis=0)))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total, pa.int64())], names=["at", "total"])

    parts = vectors.select(column).mapInArrow(run, "at int, total long")
    got = {r["at"]: int(r["total"]) for r in parts.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    n = got.pop(-1, 0)
    return Centre(n, [got.get(i, 0) + n * SHIFT for i in range(len(got))])


def reduced(blocks: list[np.ndarray], dims: int) -> np.ndarray:
    """Triangular factor of stacked blocks."""
    return np.linalg.qr(np.concatenate(blocks), mode="r") if blocks else np.zeros((0, dims))


def triangle(vectors: DataFrame, column: str, centre: Centre) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    dims = len(centre.sums)
    kind = "part long, r binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            _, x = fixed_points(batch.column(0), SCALE, dims)
            for i in range(0, len(x), BLOCK_ROWS):
                rows = centre.centred(x[i : i + BLOCK_ROWS] + SHIFT)
                r = reduced([rows] if r is None else [r, rows], dims)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    def merge(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("part").to_numpy())
        blobs = group.column("r").to_pylist()
        r = reduced([np.frombuffer(blobs[k], np.float64).reshape(-1, dims) for k in order], dims)
        return pa.table({"part": pa.array([group.column("part")[0].as_py() // FAN_IN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    narrow = vectors.select(column)
    left, parts = narrow.rdd.getNumPartitions(), narrow.mapInArrow(run, kind)
    while left > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("meet")).applyInArrow(merge, kind)
        left = -(-left // FAN_IN)
    return reduced([np.frombuffer(r["r"], np.float64).reshape(-1, dims) for r in parts.collect()], dims)  # one row


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, right): diagonal and superdiagonal of U' r V by Householder reflections, and V."""
    n = r.shape[1]
    m = np.zeros((max(n, len(r)), n))
    m[: len(r)] = r
    right = np.eye(n)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or np.linalg.norm(x[1:]) == 0:
            return None
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = mirror(m[k:, k])
        if v is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        v = mirror(m[k, k + 1 :]) if k + 2 < n else None
        if v is not None:
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(m)[:n].copy(), np.diag(m, 1)[: n - 1].copy() if n > 1 else np.zeros(0), right


def dqds(q: np.ndarray, e: np.ndarray) -> list[float]:
    """Eigenvalues of B'B, falling, of an upper bidiagonal B with squared diagonal ``q``
    and squared superdiagonal ``e``, by differential quotient differences with shifts.

    A shift that turns a pivot negative lies above the least eigenvalue and is taken
    back to a quarter; none at all always succeeds.
    """
    found: list[float] = []
    work = [(np.array(q, np.float64).tolist(), np.array(e, np.float64).tolist(), 0.0)]
    while work:
        q, e, base = work.pop()
        if q and q[0] * 1.5 < q[-1]:  # small values converge at the end
            q, e = q[::-1], e[::-1]
        guess = 0.0
        while q:
            if len(q) == 1:
                found.append(base + q.pop())
                continue
            if e[-1] <= (EPS * EPS) * (base + q[-1]) or e[-1] <= 1e-300:
                found.append(base + q.pop())
                e.pop()
                guess = 0.0
                continue
            cut = next((i for i in range(len(e) - 1) if e[i] <= 1e-300 or e[i] <= EPS * EPS * q[i]), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            shift = guess
            while True:
                d, new_q, new_e, least = q[0] - shift, [], [], q[0] - shift
                for i in range(len(e)):
                    top = d + e[i]
                    if d < 0 or top <= 0:
                        break
                    ratio = q[i + 1] / top
                    new_q.append(top)
                    new_e.append(e[i] * ratio)
                    d = d * ratio - shift
                    least = min(least, d)
                if len(new_e) == len(e) and d >= 0:
                    new_q.append(d)
                    break
                shift = shift / 4 if shift > 1e-3 * guess else 0.0
            q, e, base = new_q, new_e, base + shift
            guess = 0.98 * max(least, 0.0)
    return sorted(found, reverse=True)


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit vector z with (B'B - value) z near 0 by the twisted factorisation whose
    middle pivot is least: stationary quotient differences from the top, progressive
    ones from the bottom."""
    n = len(a)
    tiny = EPS * EPS * max(float(np.max(a * a)), 1e-300)
    d = np.maximum(a * a, tiny)
    low = b * np.sign(np.where(a[:-1] == 0, 1.0, a[:-1])) / np.sqrt(d[:-1])
    s, up = np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i]
        up[i] = d[i] * low[i] / (pivot if abs(pivot) > tiny else tiny)
        s[i + 1] = up[i] * low[i] * s[i] - value
    p, down = np.empty(n), np.empty(max(n - 1, 0))
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] * low[i] + p[i + 1]
        ratio = d[i] / (pivot if abs(pivot) > tiny else tiny)
        down[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -up[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -down[i] * z[i]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, all): the largest eigenvalues of r'r with their unit vectors as
    columns, at most ``most``, and all eigenvalues."""
    dims = r.shape[1]
    if dims == 0:
        return np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    a, b, right = bidiagonalise(r)
    size = float(max(np.abs(a).max(), np.abs(b).max(initial=0.0)))
    if size == 0:
        return np.zeros(0), np.zeros((dims, 0)), np.zeros(dims)
    b[np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:])) / 4] = 0.0
    a, b = a / size, b / size
    starts = [0, *(np.flatnonzero(b == 0) + 1).tolist(), dims]
    pairs = [(v, i, j) for i, j in zip(starts[:-1], starts[1:], strict=True) for v in dqds(a[i:j] ** 2, b[i : j - 1] ** 2)]
    pairs.sort(key=lambda x: (-x[0], x[1]))
    every = np.array([v for v, _, _ in pairs])
    wanted = [x for x in pairs[:most] if x[0] > NO_VARIANCE**2 * every[0]]
    tri = np.diag(a * a) + np.diag(b * a[:-1], 1) + np.diag(b * a[:-1], -1)
    tri[np.arange(1, dims), np.arange(1, dims)] += b * b
    z, rng = np.zeros((dims, 0)), np.random.default_rng(7)
    for value, i, j in wanted:
        own = np.zeros(dims)
        own[i:j] = twisted(a[i:j], b[i : j - 1], value)
        near = [k for k in range(z.shape[1]) if abs(wanted[k][0] - value) <= 1e-5 * value and wanted[k][1] == i]
        bad = np.linalg.norm(tri @ own - value * own) > 1e-13 * every[0]
        for _ in range(4 if near or bad else 0):  # inverse steps within the group of close values
            own -= z[:, near] @ (z[:, near].T @ own)
            if np.linalg.norm(own) < 0.5:
                own = np.zeros(dims)
                own[i:j] = rng.standard_normal(j - i)
            own -= z[:, near] @ (z[:, near].T @ own)
            own[i:j] = np.linalg.solve(tri[i:j, i:j] - value * (1 + 4 * EPS) * np.eye(j - i) - EPS * EPS * np.eye(j - i), own[i:j])
            own /= np.linalg.norm(own)
        own -= z[:, near] @ (z[:, near].T @ own)
        z = np.column_stack((z, own / np.linalg.norm(own)))
    return np.array([v for v, _, _ in wanted]) * size * size, right @ z, every * size * size


@dataclass
class Whitener:
    centre: Centre
    values: np.ndarray  # eigenvalues of the covariance
    vectors: np.ndarray  # columns
    explained: np.ndarray


def fit(vectors: DataFrame, column: str = "embedding", most: int = 8) -> Whitener:
    """Components of all vectors of ``column``."""
    centre = sums_of(vectors, column)
    if not centre.n or not centre.sums:
        return Whitener(centre, np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    values, z, every = directions(triangle(vectors, column, centre), most)
    return Whitener(centre, values / centre.n, z, values / every.sum() if len(values) else values)


def whiten(vectors: DataFrame, model: Whitener, keep: list[str], column: str = "embedding") -> DataFrame:
    """The rows that take part: columns ``keep``, ``deviation`` and ``whitened``, an array."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    dims, k = len(model.centre.sums), len(model.values)
    turn = model.vectors / np.sqrt(model.values) if k else model.vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = fixed_points(batch.column(len(keep)), SCALE, dims)
            for i in range(0, len(rows), BLOCK_ROWS):
                part = x[i : i + BLOCK_ROWS] + SHIFT
                white = model.centre.centred(part) @ turn
                kept = [batch.column(c).take(pa.array(rows[i : i + BLOCK_ROWS])) for c in range(len(keep))]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * k, pa.int32()), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([*kept, pa.array(model.centre.deviations(part), pa.int64()), lists], names=[*keep, "deviation", "whitened"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", deviation long, whitened array<double>"
    inner = vectors.select(*keep, column)
    return (inner if k else inner.limit(0)).mapInArrow(run, schema)


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    if not pairs:
        return 0.0
    entry = [F.abs(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) - float(i == j)) for i, j in pairs]
    return float(white.agg(F.greatest(*entry, F.lit(0.0))).first()[0] or 0.0)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors)
    white = stage(whiten(vectors, model, ["vec_id"]), "whitened")
    error = identity_error(white, len(model.values))
    rows = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.element_at(F.array(*(F.lit(float(x)) for x in model.explained)).cast("array<double>"), F.col("at") + 1)
    return rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.centre.n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )
