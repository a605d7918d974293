"""Embedding whitening with a bidiagonal qd solver (operator 13).

Every entry c of a vector becomes the long floor(256 c); the fit list is each
distinct vector once.  Its centred rows are reduced by blockwise QR: each task
keeps one triangle, triangles of tasks are merged in a tree.  The last triangle
is brought to bidiagonal form by Householder reflections, dqds finds its
singular values, and twisted factorisations give the right singular vectors,
which the reflections carry back to the directions of the embedding space.
Vectors of each length are fitted by themselves; what leaves the tree is one
triangle per length.

Defined cases: rows with a null vector, an empty one, or one with a null,
non-finite or beyond-long entry (|256 c| >= 2^62) are dropped; repeated rows
are fitted once and returned once each; a component without variance (above
1e-14 of the largest) has whitened null; explained is null if nothing varies; equal
variances give any orthonormal basis of their space, the same for all rows;
fewer than four dimensions give fewer components; deviation is null where it
does not fit a long; null ids are kept; an empty table gives no rows; other
columns, also those named like results, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import prepare, written

COMPONENTS = 4
EPS = np.finfo(np.float64).eps
FAN = 16  # triangles merged by one task of the tree


# --- bidiagonal form -------------------------------------------------------

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha): (I - beta v v') x = alpha e1, without cancellation."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or not np.any(x[1:]):
        return x, 0.0, float(x[0])
    v = x / scale
    norm = np.linalg.norm(v)
    alpha = -np.copysign(norm, v[0])
    v[0] -= alpha
    return v, 2.0 / float(v @ v), float(alpha * scale)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): U' r V is upper bidiagonal with diagonal a, superdiagonal b."""
    m = np.array(r, np.float64)
    d = m.shape[1]
    right = np.eye(d)
    a, b = np.zeros(d), np.zeros(max(0, d - 1))
    for k in range(d):
        v, beta, a[k] = _reflector(m[k:, k].copy())
        if beta:
            m[k:, k:] -= np.outer(v, beta * (v @ m[k:, k:]))
        if k < d - 1:
            v, beta, b[k] = _reflector(m[k, k + 1:].copy())
            if beta:
                m[k:, k + 1:] -= np.outer(m[k:, k + 1:] @ v, beta * v)
                right[:, k + 1:] -= np.outer(right[:, k + 1:] @ v, beta * v)
    return a, b, right


# --- singular values: dqds ---------------------------------------------------

def _dqds_step(q: list[float], e: list[float], shift: float):
    """One shifted qd transform; the third item is None, or the place where
    the transform lost positivity with the value found there."""
    n = len(q)
    qq, ee = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    if d < 0:
        return qq, ee, (0, d)
    for i in range(n - 1):
        qq[i] = d + e[i]
        if qq[i] > 0:
            t = q[i + 1] / qq[i]
            ee[i], d = e[i] * t, d * t - shift
        else:  # both parts are zero: the chain starts again
            ee[i], d = 0.0, q[i + 1] - shift
        if d < 0:
            return qq, ee, (i + 1, d)
    qq[n - 1] = d
    return qq, ee, None


def _corner(q: list[float], e: list[float]) -> float:
    """Smaller eigenvalue of the last two rows of the product B'B."""
    top, low, off = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (top - low) / 2
    return low - off / (half + np.copysign(np.hypot(half, np.sqrt(off)), half or 1.0)) if off else \
        min(top, low)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the upper bidiagonal matrix, falling."""
    done: list[float] = []
    stack = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    while stack:
        q, e, sigma = stack.pop()
        n = len(q)
        if n == 1:
            done.append(sigma + q[0])
            continue
        cut = next((i for i in range(n - 2, -1, -1)
                    if e[i] <= EPS * EPS * (sigma + min(q[i], q[i + 1]))), None)
        if cut is not None:
            stack += [(q[:cut + 1], e[:cut], sigma), (q[cut + 1:], e[cut + 1:], sigma)]
            continue
        if 1.5 * q[0] < q[-1]:  # reversed, the values are the same
            q, e = q[::-1], e[::-1]
        # a shift from the corner; Rutishauser: a loss in the last place alone
        # makes shift + value a lower bound
        near = e[-1] < 0.25 * q[-1]
        shift = max(0.0, _corner(q, e)) * (1 - 4 * EPS) if near else 0.0
        for _ in range(4):
            qq, ee, lost = _dqds_step(q, e, shift)
            if lost is None or shift == 0.0:
                break
            late = lost[0] == n - 1
            shift = max(0.0, (shift + lost[1]) * (1 - 4 * EPS)) if late else shift / 8
        if lost is not None:
            shift = 0.0
            qq, ee, _ = _dqds_step(q, e, 0.0)
        stack.append((qq, ee, sigma + shift))
    return np.array(sorted(done, reverse=True))


# --- singular vectors: twisted factorisations --------------------------------

def _twisted(a: np.ndarray, b: np.ndarray, lam: float) -> np.ndarray:
    """Unit vector of B'B for the value ``lam`` from the twisted factorisation
    with the smallest pivot; a holds no zero."""
    n = len(a)
    if n == 1:
        return np.ones(1)
    diag, low = a * a, b / a[:-1]
    tiny = np.finfo(np.float64).tiny / EPS
    s, up = np.zeros(n), np.zeros(n - 1)
    s[0] = -lam
    for i in range(n - 1):  # from the top: stationary
        piv = s[i] + diag[i]
        piv = piv if piv != 0 else EPS * max(lam, diag[i], tiny)
        up[i] = diag[i] * low[i] / piv
        s[i + 1] = up[i] * low[i] * s[i] - lam
    p, down = np.zeros(n), np.zeros(n - 1)
    p[n - 1] = diag[n - 1] - lam
    for i in range(n - 2, -1, -1):  # from the bottom: progressive
        piv = diag[i] * low[i] ** 2 + p[i + 1]
        piv = piv if piv != 0 else EPS * max(lam, diag[i], tiny)
        t = diag[i] / piv
        down[i] = low[i] * t
        p[i] = p[i + 1] * t - lam
    k = int(np.argmin(np.abs(s + p + lam)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -up[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -down[i] * z[i]
    return z / np.linalg.norm(z)


def _blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Ranges between superdiagonals that vanish beside the whole matrix."""
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    ends = [i + 1 for i in range(len(b)) if abs(b[i]) <= EPS * EPS * scale] + [len(a)]
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _refined(apply, value: float, z: np.ndarray, before: list[np.ndarray],
             scale: float) -> np.ndarray | None:
    """``z`` made orthogonal to the vectors found for (nearly) the same value;
    None if little is left of it."""
    for _ in range(2):
        for v in before:
            z = z - v * (v @ z)
        size = np.linalg.norm(z)
        if size < 0.1:
            return None
        z = z / size
    return z if np.linalg.norm(apply(z) - value * z) <= 1e-9 * scale else None


def leading_directions(r: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of r'r, falling, and their unit vectors as
    columns, from the triangle r."""
    d = r.shape[1]
    k = min(k, d)
    a, b, right = bidiagonalise(r)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(k), np.eye(d)[:, :k]
    a, b = a / scale, b / scale
    found = []  # (value, block)
    for lo, hi in _blocks(a, b):
        found += [(v, lo, hi) for v in dqds(a[lo:hi], b[lo:hi - 1])]
    found.sort(key=lambda f: -f[0])
    # a zero on the diagonal has no twisted factor; this change is far below EPS
    a = np.where(np.abs(a) < EPS * 1e-4, EPS * 1e-4, a)

    def square(z):
        y = a * z
        y[:-1] += b * z[1:]
        out = a * y
        out[1:] += b * y[:-1]
        return out

    values, vectors = np.zeros(k), []
    rng = np.random.Generator(np.random.Philox(13))
    for j, (lam, lo, hi) in enumerate(found[:k]):
        z = np.zeros(d)
        z[lo:hi] = _twisted(a[lo:hi], b[lo:hi - 1], lam)
        near = [v for v, old in zip(vectors, values, strict=False) if abs(old - lam) <= 1e-3 * old]
        good = _refined(square, lam, z, near, found[0][0])
        while good is None:  # a cluster: inverse iteration away from its other vectors
            z = rng.normal(size=d)
            for _ in range(4):
                for v in vectors:
                    z = z - v * (v @ z)
                z = _solve_shifted(a, b, lam, z / np.linalg.norm(z))
                z = z / np.linalg.norm(z)
            good = _refined(square, lam, z, vectors, found[0][0] * 1e4)
        values[j] = lam
        vectors.append(good)
    # one pass of orthogonalisation over the few directions removes the last bits
    full, tri = np.linalg.qr(right @ np.array(vectors).T)
    return values * scale * scale, full * np.sign(np.diag(tri))


def _solve_shifted(a, b, lam, z):
    """(B'B - lam')^-1 z with lam' moved off the value by a few ulps."""
    diag, off = a * a, a[:-1] * b
    diag[1:] += b * b
    diag = diag - lam * (1 + 8 * EPS) - EPS * 1e-3
    full = np.diag(diag) + np.diag(off, 1) + np.diag(off, -1)
    return np.linalg.lstsq(full, z, rcond=None)[0] if np.linalg.cond(full) > 1 / EPS else \
        np.linalg.solve(full, z)


# --- Spark ---------------------------------------------------------------------

def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, x array<long> of the rows that count."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * 256.0))
    fine = F.forall("embedding", lambda c: F.coalesce(
        F.abs(c.cast("double")) < float(1 << 54), F.lit(False)))  # false for NaN, infinity, null
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine).select(
        "vec_id", x.alias("x"))


def _matrix(lists, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


_MODEL = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())),
                    ("mean", pa.list_(pa.float64())),
                    ("directions", pa.list_(pa.list_(pa.float64()))),
                    ("explained", pa.list_(pa.float64()))])
_TRI = pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("r", pa.list_(pa.float64()))])


def _triangle(stacked: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stacked, mode="r")


def triangles(fit: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """One triangle (dim, part, r flat) per length and task."""

    def reduce(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tri: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                lists = b.column(1).filter(pa.array(dims == dim))
                tri[dim] = _triangle(np.vstack([tri.get(dim, np.zeros((0, dim))),
                                                centred(_matrix(lists, dim), *sums[dim])]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(tri), pa.int32()), pa.array([part] * len(tri), pa.int64()),
             pa.array([t.ravel() for t in tri.values()], pa.list_(pa.float64()))], schema=_TRI)

    return fit.mapInArrow(reduce, "dim int, part long, r array<double>")


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - s / n per entry; the difference n x - s is exact where it fits."""
    bound = n * int(np.abs(x).max(initial=0)) + max((abs(v) for v in s), default=0)
    if bound < 1 << 62:
        return (x * n - np.array(s, np.int64)).astype(np.float64) / n
    whole = np.array([v // n for v in s], dtype=object)  # split the mean: whole part first
    rest = np.array([(v % n) / n for v in s])
    return (x - whole.astype(np.int64)).astype(np.float64) - rest


def merged(tri: DataFrame, parts: int) -> DataFrame:
    """One triangle per length; each level merges ``FAN`` triangles in a task."""

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        rows = table.sort_by("part").column("r").combine_chunks().flatten().to_numpy()
        r = _triangle(rows.reshape(-1, dim))
        return pa.Table.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([key[1].as_py()], pa.int64()),
             pa.array([r.ravel()], pa.list_(pa.float64()))], schema=_TRI)

    while True:
        parts = -(-parts // FAN)
        slot = F.floor(F.col("part") / FAN).cast("long").alias("slot")
        tri = tri.select("dim", slot, "part", "r").groupBy("dim", "slot").applyInArrow(
            merge, "dim int, part long, r array<double>")
        if parts == 1:
            return tri


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    prepare(spark, 4096)
    rows = quantised(vectors).withColumn("dim", F.size("x"))
    fit = written(rows.select("dim", "x").distinct(), "whiten-fit")
    sums: dict[int, tuple[int, list[int]]] = {}
    counted = fit.select("dim", F.posexplode("x")).groupBy("dim", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    for r in counted.orderBy("dim", "pos").toLocalIterator():  # one number per dimension
        sums.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    schema = ("dim int, component int, n long, sums array<long>, mean array<double>, "
              "direction array<double>, explained double")
    if not sums:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, "
                                     "whitened double, explained double, identity_error double")
    tri = written(triangles(fit, sums), "whiten-triangles")
    tri = merged(tri, tri.agg(F.max("part")).first()[0] + 1)

    def solve(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        n, s = sums[dim]
        r = table.column("r").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        r = np.vstack([r, np.zeros((max(0, dim - len(r)), dim))])
        total = float((r * r).sum())
        values, vecs = leading_directions(r, k)
        alive = values > 1e-14 * max(values[0], 1e-300)
        model = {
            "dim": dim, "n": n, "sums": [v if abs(v) < 1 << 63 else None for v in s],
            "mean": [v / n for v in s],
            "directions": [(v / np.sqrt(e / n)).tolist() if ok else None
                           for e, v, ok in zip(values, vecs.T, alive, strict=True)],
            "explained": [float(e / total) if total > 0 else None for e in values]}
        return pa.Table.from_pylist([model], schema=_MODEL)

    # one model row per length, joined by length; Catalyst broadcasts it if its size allows
    model = written(tri.groupBy("dim").applyInArrow(
        solve, "dim int, n long, sums array<long>, mean array<double>, "
               "directions array<array<double>>, explained array<double>"), "whiten-model")
    centre = F.zip_with("x", "mean", lambda x, m: x - m)
    project = F.transform("directions", lambda d: F.aggregate(
        F.zip_with(centre, d, lambda x, v: x * v), F.lit(0.0), lambda acc, t: acc + t))
    # identity error: covariance of the whitened fit list itself, centred before multiplying
    white = fit.join(model, "dim").select("dim", *[
        F.get(project, F.lit(i)).alias(f"w{i}") for i in range(k)])
    gaps = [F.abs(F.covar_pop(f"w{i}", f"w{j}") - float(i == j))
            for i in range(k) for j in range(i, k)]
    error = white.groupBy("dim").agg(F.array_max(F.array(*gaps)).alias("identity_error"))
    model = written(model.join(error, "dim"), "whiten-fitted")
    wide = F.zip_with("x", "sums", lambda x, s: F.try_subtract(
        F.try_multiply(F.col("n"), x), s))
    deviation = F.aggregate(wide, F.lit(0).cast("long"),
                            lambda acc, t: F.try_add(acc, F.try_multiply(t, t)))
    parts = F.posexplode(F.arrays_zip(project.alias("whitened"), "explained"))
    return rows.join(model, "dim").select(
        "vec_id", "n", deviation.alias("deviation"), "identity_error", parts).select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation",
        F.col("col.whitened").alias("whitened"), F.col("col.explained").alias("explained"),
        "identity_error")
