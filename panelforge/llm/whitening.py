"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers, so that counts, sums and deviations are exact.
Every distinct vector once is the fit list.  Its centred rows are reduced by QR
in blocks: one triangle for each partition, then triangles of ``fan`` blocks
at a time until one is left.  That triangle R (dimension x dimension, whatever the
number of rows) is made bidiagonal by Householder reflections; dqds with
shifts finds the squared singular values, and twisted factorisations (a
stationary qd from the top, a progressive one from the bottom, met where
the twist is least) give the directions.  The covariance of the whitened fit
list is gathered in a last pass and compared with the identity.

Defined cases: vectors that are null or hold null or non-finite entries have no rows;
vectors of another length than the commonest one (of equally common ones the
longest) have none either; copies count once in the fit and are whitened each;
null and repeated ids are rows of their own; directions in which the fit list has
no variance (fewer vectors or dimensions than components, copies of one vector only)
have no rows; an empty table gives none; a deviation beyond a long is null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm.common import fresh
from panelforge.operators.common import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Bytes of triangles that one task stacks.
FAN_BYTES = 256 << 20
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """Fit of ``n`` vectors with these sums: directions by falling variance."""

    n: int
    sums: list[int]
    directions: np.ndarray  # dimension x component
    variance: np.ndarray
    explained: np.ndarray
    identity_error: float = math.nan

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.variance))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(float) - rest


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n*x - S)**2."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    off = x - whole
    most = n * (int(np.abs(off).max(initial=0)) + 1)
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return ((n * off - rest) ** 2).sum(1).tolist()
    exact = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in off.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Columns ``id`` and ``x`` (array of long) of the rows that can be used."""
    vec = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vec.alias("v"))
    finite = F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf))), F.lit(False))
    rows = rows.filter(finite & (F.size("v") > 0)).select("id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (common["d"] if common else 0))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows of the fit list (column ``x``), by blockwise QR."""
    d = len(sums)

    def reduce(rows: np.ndarray | None, more: np.ndarray) -> np.ndarray:
        return np.linalg.qr(more if rows is None else np.vstack([rows, more]), mode="r")

    def one(batches):
        from pyspark import TaskContext

        r = None
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            for lo in range(0, len(x), 4096):
                r = reduce(r, _centred(x[lo:lo + 4096], n, sums))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"block": pa.array([TaskContext.get().partitionId()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    def stacked(table: pa.Table) -> pa.Table:
        r = None
        for row in table.sort_by("block")["r"]:
            r = reduce(r, np.frombuffer(row.as_py()).reshape(-1, d))
        return pa.table({"block": pa.array([table["to"][0].as_py()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    blocks, left = fit.mapInArrow(one, "block long, r binary"), fit.rdd.getNumPartitions()
    fan = min(64, max(2, FAN_BYTES // (8 * d * d)))
    while left > 1:
        blocks = blocks.withColumn("to", F.floor(F.col("block") / fan)).groupBy("to").applyInArrow(stacked, "block long, r binary")
        left = -(-left // fan)
    r = np.frombuffer(blocks.first()["r"]).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def _reflector(x: np.ndarray) -> np.ndarray | None:
    norm = np.linalg.norm(x)
    if norm == 0:
        return None
    v = x / norm
    v[0] += math.copysign(1.0, v[0])
    return v / np.linalg.norm(v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of the bidiagonal form of R = U B V'; both bands are non-negative."""
    a, d = np.array(r, float), len(r)
    right = np.eye(d)
    for k in range(d):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k < d - 2 and (v := _reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ v, 2 * v)
            right[:, k + 1:] -= np.outer(right[:, k + 1:] @ v, 2 * v)
    main, upper = np.diag(a).copy(), np.diag(a, 1).copy()
    sign = np.ones(d)  # of the columns of V, so that both bands lose their signs
    for k in range(d - 1):
        sign[k + 1] = sign[k] * (1 if main[k] >= 0 else -1) * (1 if upper[k] >= 0 else -1)
    return np.abs(main), np.abs(upper), right * sign


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds step: the new q and e, and all d (a negative one: the shift was too large)."""
    d = q[0] - shift
    nq, ne, seen = [], [], [d]
    for k in range(len(e)):
        s = d + e[k]
        nq.append(s)
        if s <= 0:
            return nq, ne, [*seen, -1.0]
        t = q[k + 1] / s
        ne.append(e[k] * t)
        d = d * t - shift
        seen.append(d)
        if d < 0 and k < len(e) - 1:
            return nq, ne, seen
    nq.append(d)
    return nq, ne, seen


def dqds(main: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    found, todo = [], [([float(a) ** 2 for a in main], [float(b) ** 2 for b in upper], 0.0)]
    tiny = (8 * EPS) ** 2
    while todo:
        q, e, total = todo.pop()
        small = None
        for _ in range(200 * len(q) + 200):
            while len(q) > 1 and e[-1] <= tiny * (total + q[-1]):
                found.append(total + q.pop())
                e.pop()
                small = None
            if len(q) == 1:
                break
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= tiny * (total + min(q[k], q[k + 1]))), None)
            if cut is not None:  # what is above the cut waits
                todo.append((q[: cut + 1], e[:cut], total))
                q, e, small = q[cut + 1:], e[cut + 1:], None
                continue
            if 1.5 * q[0] < q[-1] and small is None:  # large values belong on top
                q, e = q[::-1], e[::-1]
            # the lower one of the last two; it and the least d bound the smallest value from above
            b, c = q[-1] + e[-1], q[-2] + (e[-2] if len(e) > 1 else 0.0)
            low = q[-1] * q[-2] / (0.5 * (b + c) + math.sqrt((0.5 * (b - c)) ** 2 + q[-2] * e[-1])) if b + c > 0 else 0.0
            shift = 0.0 if small is None else min(small, low)
            for attempt in range(4):
                if attempt == 3:
                    shift = 0.0
                nq, ne, seen = _sweep(q, e, shift)
                if min(seen) >= 0:
                    break
                late = len(seen) == len(q) and min(seen[:-1]) >= 0
                shift = max(0.0, (shift + seen[-1]) * (1 - 4 * EPS)) if late and shift + seen[-1] > 0.5 * shift else 0.25 * shift
            q, e, total, small = nq, ne, total + shift, min(seen)
        found += [total + v for v in q]
    return np.sort(np.array(found))[::-1]


def twisted(main: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit right singular vector of an unreduced bidiagonal matrix for a squared
    singular value, from the twisted factorisation of B'B - value."""
    d = len(main)
    pivot, low = main ** 2, upper / main[:-1]  # B'B = L D L'
    z = np.ones(1)
    for _ in range(3):
        s, p, down, up = np.empty(d), np.empty(d), np.empty(d - 1), np.empty(d - 1)
        s[0] = -value
        for i in range(d - 1):
            at = pivot[i] + s[i] or EPS * value
            down[i] = pivot[i] * low[i] / at
            s[i + 1] = down[i] * low[i] * s[i] - value
        p[-1] = pivot[-1] - value
        for i in range(d - 2, -1, -1):
            at = pivot[i] * low[i] ** 2 + p[i + 1] or EPS * value
            up[i] = low[i] * pivot[i] / at
            p[i] = p[i + 1] * pivot[i] / at - value
        gamma = s + p + value
        r = int(np.argmin(np.abs(gamma)))
        z = np.empty(d)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(r, d - 1):
            z[i + 1] = -up[i] * z[i]
        norm = z @ z
        step = gamma[r] / norm
        z = z / math.sqrt(norm)
        if abs(step) <= 4 * EPS * value or value + step <= 0:
            break
        value += step
    return z


def _cluster(main: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal directions of values too close to be told apart: inverse iteration of their space."""
    d = len(main)
    b = np.diag(main) + np.diag(upper, 1)
    z = np.linalg.qr(np.random.default_rng(d).standard_normal((d, len(values))))[0]
    gram = b.T @ b - values.mean() * (1 + 4 * EPS) * np.eye(d)
    for _ in range(4):
        z = np.linalg.qr(np.linalg.solve(gram, z))[0]
    return z


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, right singular vectors as columns) of R, the ``most`` largest with variance."""
    main, upper, right = bidiagonal(r)
    d, norm = len(main), max(main.max(initial=0), upper.max(initial=0))
    if norm == 0:
        return np.empty(0), np.empty((d, 0))
    main = np.maximum(main, EPS * norm / 8)  # a singular R: below all that counts
    upper = np.where(upper <= EPS * norm / 8, 0.0, upper)
    found, lo = [], 0
    for hi in [*(np.flatnonzero(upper == 0) + 1).tolist(), d]:
        block, band = main[lo:hi], upper[lo:hi - 1]
        values = dqds(block, band)
        found += [(v, lo, hi, k, values) for k, v in enumerate(values.tolist()) if v > (d * EPS * norm) ** 2]
        lo = hi
    found = sorted(found, key=lambda f: -f[0])[:most]
    out, made = np.zeros((d, len(found))), {}
    for c, (v, lo, hi, k, values) in enumerate(found):
        if hi - lo == 1:
            out[lo, c] = 1.0
            continue
        near = np.flatnonzero(np.abs(values - v) <= 1e-9 * v)
        if len(near) == 1:
            out[lo:hi, c] = twisted(main[lo:hi], upper[lo:hi - 1], v)
        else:
            key = (lo, int(near[0]))
            if key not in made:
                made[key] = _cluster(main[lo:hi], upper[lo:hi - 1], values[near])
            out[lo:hi, c] = made[key][:, k - near[0]]
    return np.array([f[0] for f in found]), right @ out


def _sums(fit: DataFrame, d: int) -> list[int]:
    def partial(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(np.arange(d)), "s": pa.array(_matrix(batch.column("x"), d).sum(0))})

    rows = fit.mapInArrow(partial, "dim long, s long").groupBy("dim").agg(F.sum("s").alias("s")).collect()  # one row a dimension
    return [r["s"] for r in sorted(rows, key=lambda r: r["dim"])]


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    d, k = model.directions.shape

    def partial(batches):
        for batch in batches:
            w = model.whiten(_matrix(batch.column("x"), d))
            w = np.hstack([w, np.ones((len(w), 1))])
            yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange((k + 1) ** 2)), "s": pa.array((w.T @ w).ravel())})

    cells = fit.mapInArrow(partial, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()  # (components + 1)^2 rows
    gram = np.array([r["s"] for r in sorted(cells, key=lambda r: r["cell"])]).reshape(k + 1, k + 1) / model.n
    mean = gram[-1, :-1]
    return float(np.abs(gram[:-1, :-1] - np.outer(mean, mean) - np.eye(k)).max())


def fit_vectors(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct ``x`` of ``vectors``; None without rows or variance."""
    fit = materialize(vectors.select("x").distinct())
    n = fit.count()
    if not n:
        return None
    d = len(fit.first()["x"])
    sums = _sums(fit, d)
    r = triangle(fit, n, sums)
    values, vectors_of = directions(r, components)
    if not len(values):
        return None
    model = Whitening(n, sums, vectors_of, values / n, values / float((r * r).sum()))
    return Whitening(n, sums, vectors_of, model.variance, model.explained, _identity_error(fit, model))


def fit(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> Whitening | None:
    return fit_vectors(whole_vectors(df, id_col, vec_col), components)


def transform(df: DataFrame, model: Whitening, vec_col: str = "embedding", out: str = "whitened") -> DataFrame:
    """``df`` with the whitened vector in a further column (``out`` or a free variant
    of that name); null where the vector can't be used."""
    d = len(model.sums)
    name, x = fresh(df, out), fresh(df, "x")
    vec = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    good = (F.size(vec) == d) & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf)))
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])

    def apply(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            own = column.is_valid().to_numpy(zero_copy_only=False)
            w = model.whiten(_matrix(column.drop_null(), d))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, max(1, w.shape[1]), dtype=np.int32)), pa.array(w.ravel()))
            at = pa.array(np.cumsum(own) - 1, mask=~own)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists.take(at)], names=schema.names)

    cells = F.when(good, F.transform(vec, lambda c: F.floor(c * SCALE) + SHIFT))
    return df.withColumn(x, cells).mapInArrow(apply, schema)


def digest(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: n, the exact deviation, the
    whitened coordinate, the share of variance and the fit's identity error."""
    vectors = whole_vectors(df, id_col, vec_col)
    model = fit_vectors(vectors, components)
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    types = [df.schema[id_col].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])

    def rows(batches):
        for batch in batches:
            if model is None or not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), len(model.sums))
            w = model.whiten(x)
            m, k = w.shape
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                pa.array(_deviation(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel()),
                pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error))], names=names)

    return vectors.mapInArrow(rows, schema)
