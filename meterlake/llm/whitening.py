"""Whitening of embeddings by a bidiagonal qd solver.

Every entry ``c`` becomes the integer ``floor(64 * c) + 1,000,000``. The distinct integer vectors are the
fit list: their number and sums give exact centred rows ``(n*x - S) / n``. Each task reduces its rows to a
triangle by QR, block by block; triangles are merged in groups of ``FAN_IN`` until one is left, whose size
depends on the dimension alone. On it, Householder reflections give an upper bidiagonal matrix, dqds its
singular values to high relative accuracy, and twisted factorisations the right singular vectors (members
of a cluster by inverse iteration against the earlier ones). The covariance is never formed, so small
components keep their accuracy.

Cases: rows whose vector is null or holds a null, NaN or infinite entry are left out; a null or repeated id
stays as it is; a vector shorter than the longest counts zeros for the entries that it lacks; repeated
vectors count once in the fit and each gets its own result; an empty table, or one distinct vector, gives
an empty result, and components without variance (below rounding of the largest) are left out; entries
beyond 2**33 in size count as 2**33 of the same sign; ``deviation`` is null if it exceeds a long; other input
columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored

SCALE, OFFSET = 64.0, 1_000_000
LARGEST = float(1 << 39)
COMPONENTS = 16
#: Triangles merged in one task.
FAN_IN = 8
_EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues nearer than this share of the larger one count as a cluster.
_CLUSTER = 1e-5


# --- integer vectors ------------------------------------------------------------------------------------

def integers(vectors: pa.Array, dim: int) -> np.ndarray:
    """``floor(64 * c)`` of every entry, one row for each list; entries that a short list lacks are 0."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    inside = np.arange(dim) < length[:, None]
    out[inside] = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST)
    return out


def pack(x: np.ndarray) -> list[bytes]:
    """Equal rows as equal bytes: the width of an entry, then the entries in the narrowest type that holds all."""
    most = np.abs(x).max(axis=1, initial=0)
    kind = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    out: list[bytes] = [b""] * len(x)
    for width in (2, 4, 8):
        for i in np.flatnonzero(kind == width):
            out[i] = bytes([width]) + x[i].astype(f"<i{width}").tobytes()
    return out


def unpack(packed: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(packed), dim), dtype=np.int64)
    for i, row in enumerate(packed.to_pylist()):
        out[i] = np.frombuffer(row, dtype=f"<i{row[0]}", offset=1)
    return out


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the rows whose vector has finite entries only."""
    def finite(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return (df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("v").isNotNull() & F.forall("v", finite)))


def fit_list(rows: DataFrame, dim: int) -> DataFrame:
    """Each distinct integer vector once (``x``, packed), written to the shared folder."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pack(integers(batch.column("v"), dim)), pa.binary())], names=["x"])
    return stored(rows.select("v").mapInArrow(packed, "x binary").distinct(), "whitening-fit")


def sums(fit: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sum of every dimension (of ``floor(64 * c)``, without the offset)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim, np.int64), 0
        for batch in batches:
            total += unpack(batch.column("x"), dim).sum(axis=0)
            n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], names=["place", "part"])
    rows = fit.mapInArrow(partial, "place int, part bigint").groupBy("place").agg(F.sum("part").alias("total")).collect()
    got = {r["place"]: r["total"] for r in rows}
    return got.get(-1, 0), np.array([got.get(j, 0) for j in range(dim)], dtype=np.int64)


def scaled(v: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``n*x - S``: the same with and without the offset, and exact."""
    return v * np.int64(n) - total


# --- triangle of the centred rows -----------------------------------------------------------------------

def _triangle(rows: np.ndarray, dim: int) -> np.ndarray:
    out = np.zeros((dim, dim))
    r = np.linalg.qr(rows, mode="r")
    out[:r.shape[0]] = r
    return out


def triangle(fit: DataFrame, dim: int, n: int, total: np.ndarray, block: int = 4096) -> np.ndarray:
    """R of the QR decomposition of all centred rows, merged level by level."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting, held = np.zeros((dim, dim)), [], 0
        for batch in batches:
            waiting.append(scaled(unpack(batch.column("x"), dim), n, total) / n)
            held += batch.num_rows
            if held >= block:
                r, waiting, held = _triangle(np.vstack([r, *waiting]), dim), [], 0
        r = _triangle(np.vstack([r, *waiting]), dim)
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def merged(table: pa.Table) -> pa.Table:
        r = np.zeros((dim, dim))
        for own in table.column("r").to_pylist():
            r = _triangle(np.vstack([r, np.frombuffer(own).reshape(dim, dim)]), dim)
        return pa.table({"r": pa.array([r.tobytes()], pa.binary()), "part": table.column("part").slice(0, 1)})

    parts = max(fit.rdd.getNumPartitions(), 1)
    out = fit.mapInArrow(local, "r binary").withColumn("part", F.spark_partition_id().cast("long"))
    while parts > 1:
        parts = -(-parts // FAN_IN)
        out = out.withColumn("part", F.col("part") % parts).groupBy("part").applyInArrow(merged, "r binary, part bigint")
    return np.frombuffer(out.first()["r"]).reshape(dim, dim)


# --- bidiagonal matrix ----------------------------------------------------------------------------------

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and alpha with ``(I - beta v v') x = alpha e1``."""
    norm = float(np.linalg.norm(x))
    if norm == 0.0 or not np.any(x[1:]):
        return np.zeros_like(x), 0.0, float(x[0])
    alpha = -norm if x[0] > 0 else norm
    v = x.copy()
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, float]]]:
    """Diagonal, superdiagonal and right reflectors of Householder's reduction of a square matrix."""
    m = r.copy()
    d = len(m)
    a, b, right = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for k in range(d):
        v, beta, a[k] = _reflector(m[k:, k])
        m[k:, k + 1:] -= np.outer(beta * v, v @ m[k:, k + 1:])
        if k < d - 1:
            v, beta, b[k] = _reflector(m[k, k + 1:])
            m[k + 1:, k + 1:] -= np.outer(m[k + 1:, k + 1:] @ v, beta * v)
            right.append((v, beta))
    return a, b, right


def reflected_back(z: np.ndarray, right: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """A vector of the bidiagonal matrix as one of the original."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        v, beta = right[k]
        z[k + 1:] -= beta * (v @ z[k + 1:]) * v
    return z


# --- dqds -----------------------------------------------------------------------------------------------

def _sweep(q: list[float], e: list[float], lo: int, hi: int, shift: float):
    """One dqds transform of ``q[lo..hi], e[lo..hi-1]``; None if the shift was too large."""
    nq, ne = q[lo:hi + 1], e[lo:hi]
    d = q[lo] - shift
    if d < 0.0:
        return None
    for i in range(hi - lo):
        nq[i] = d + e[lo + i]
        if nq[i] == 0.0:
            ne[i], d = 0.0, q[lo + i + 1] - shift
        else:
            t = q[lo + i + 1] / nq[i]
            ne[i], d = e[lo + i] * t, d * t - shift
        if not d >= 0.0:
            return None
    nq[hi - lo] = d
    return nq, ne


def _shift(q: list[float], e: list[float], hi: int) -> float:
    """The smaller eigenvalue of the last two rows of ``L U``, minus the coupling that it leaves out."""
    x, y, z = q[hi - 1], q[hi], e[hi - 1]
    trace, product = x + y + z, x * y
    root = max(trace * trace - 4.0 * product, 0.0) ** 0.5
    return 2.0 * product / (trace + root) if trace + root > 0.0 else 0.0


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of an upper bidiagonal matrix, in falling order, by dqds with shifts that keep every pivot positive."""
    q, e = [float(x) ** 2 for x in a], [float(x) ** 2 for x in b]
    found, work = [], [(0, len(q) - 1, 0.0)]
    while work:
        lo, hi, gone = work.pop()
        while hi >= lo:
            if hi == lo:
                found.append(q[lo] + gone)
                hi -= 1
                continue
            if e[hi - 1] <= _EPS * _EPS * (gone + q[hi]) or e[hi - 1] == 0.0:
                found.append(q[hi] + gone)
                hi -= 1
                continue
            cut = next((i for i in range(hi - 2, lo - 1, -1) if e[i] <= _EPS * _EPS * (gone + q[i + 1])), None)
            if cut is not None:
                work.append((lo, cut, gone))
                lo = cut + 1
                continue
            shift = _shift(q, e, hi)
            for own in (shift * (1.0 - 4.0 * _EPS), shift * 0.75, shift * 0.25, 0.0):
                if (out := _sweep(q, e, lo, hi, own)) is not None:
                    break
            q[lo:hi + 1], e[lo:hi] = out
            gone += own
    return np.sqrt(np.maximum(np.sort(np.array(found))[::-1], 0.0))


# --- right singular vectors -----------------------------------------------------------------------------

def _factors(a: np.ndarray, b: np.ndarray, lam: float):
    """Stationary factors (from above) and progressive factors (from below) of ``B'B - lam``."""
    d, tiny = len(a), max(_EPS * _EPS * float(np.max(a * a, initial=0.0)), 1e-290)
    s, plus, low = np.zeros(d), np.zeros(d), np.zeros(max(d - 1, 0))
    s[0] = -lam
    for i in range(d):
        plus[i] = (s[i] + a[i] * a[i]) or tiny
        if i < d - 1:
            low[i] = a[i] * b[i] / plus[i]
            s[i + 1] = b[i] * b[i] * (s[i] / plus[i]) - lam
    p, up = np.zeros(d), np.zeros(max(d - 1, 0))
    p[d - 1] = a[d - 1] * a[d - 1] - lam
    for i in range(d - 2, -1, -1):
        minus = (b[i] * b[i] + p[i + 1]) or tiny
        up[i] = a[i] * b[i] / minus
        p[i] = a[i] * a[i] * (p[i + 1] / minus) - lam
    return plus, low, up, s + p + lam


def _twisted(low: np.ndarray, up: np.ndarray, gamma: np.ndarray) -> np.ndarray:
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(len(gamma))
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(r, len(z) - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _solved(plus: np.ndarray, low: np.ndarray, v: np.ndarray) -> np.ndarray:
    z = v.copy()
    for i in range(1, len(z)):
        z[i] -= low[i - 1] * z[i - 1]
    z /= plus
    for i in range(len(z) - 2, -1, -1):
        z[i] -= low[i] * z[i + 1]
    return z


def right_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors (columns) of the bidiagonal matrix for its falling ``values``."""
    out = np.zeros((len(a), len(values)))
    first, random = 0, np.random.default_rng(11)
    for j, lam in enumerate(values * values):
        plus, low, up, gamma = _factors(a, b, lam)
        if j == 0 or values[j - 1] ** 2 - lam > _CLUSTER * values[j - 1] ** 2:
            first = j
            out[:, j] = _twisted(low, up, gamma)
            continue
        before = out[:, first:j]
        z = random.standard_normal(len(a))
        for _ in range(4):
            z = _solved(plus, low, z / np.linalg.norm(z))
            for _ in range(2):
                z /= np.linalg.norm(z)
                z -= before @ (before.T @ z)
        out[:, j] = z / np.linalg.norm(z)
    return out


def components(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Singular values (at most ``most`` above rounding), unit directions as columns, and the sum of all squares."""
    a, b, right = bidiagonal(r)
    small = np.abs(b) <= _EPS * 0.5 * np.sqrt(np.abs(a[:-1] * a[1:]))
    b = np.where(small, 0.0, b)
    values = singular_values(a, b)
    kept = values[:most]
    kept = kept[kept > values[0] * _EPS * 8 * len(a)] if len(values) else kept
    z = right_vectors(a, b, kept)
    return kept, np.column_stack([reflected_back(z[:, j], right) for j in range(len(kept))]) if len(kept) else z, float(np.sum(values * values))


# --- operator -------------------------------------------------------------------------------------------

def identity_error(fit: DataFrame, dim: int, n: int, total: np.ndarray, weights: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = weights.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((k + 1, k))
        for batch in batches:
            w = scaled(unpack(batch.column("x"), dim), n, total) / n @ weights
            moments[:k] += w.T @ w
            moments[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(moments.size), pa.int32()), pa.array(moments.ravel())], names=["place", "part"])

    rows = fit.mapInArrow(partial, "place int, part double").groupBy("place").agg(F.sum("part").alias("total")).collect()
    moments = np.zeros((k + 1) * k)
    for r in rows:
        moments[r["place"]] = r["total"]
    moments = moments.reshape(k + 1, k) / n
    return float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())


SCHEMA = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _deviation(z: np.ndarray) -> list[int | None]:
    """Exact sums of squares of each row; None beyond a long."""
    squares = z.astype(np.float64) ** 2
    out = np.sum(z * z, axis=1).tolist()
    for i in np.flatnonzero(squares.sum(axis=1) > 2.0 ** 62):
        exact = sum(int(v) ** 2 for v in z[i])
        out[i] = exact if exact < 1 << 63 else None
    return out


def whitened(df: DataFrame, *, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` for every usable row and component."""
    rows = usable(df, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {SCHEMA}"
    dim = rows.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    nothing = df.sparkSession.createDataFrame([], schema)
    if not dim:
        return nothing
    fit = fit_list(rows, dim)
    n, total = sums(fit, dim)
    if n < 2:
        return nothing
    values, directions, everything = components(triangle(fit, dim, n, total), most)
    if not len(values):
        return nothing
    weights = directions * (np.sqrt(n) / values)
    explained, k = values * values / everything, len(values)
    error = identity_error(fit, dim, n, total, weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = scaled(integers(batch.column("v"), dim), n, total)
            m = len(z)
            row = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)), pa.array(_deviation(z), pa.int64()).take(pa.array(row)),
                pa.array((z / n @ weights).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(score, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))
