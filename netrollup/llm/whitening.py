"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson.

An entry c counts as the whole number x = floor(64 c) + 1000000.  The fit list, every distinct x
vector once, gives n and the sums S; all products use n x - S, exact in whole numbers, over n.  The
covariance matrix V is never formed: V times a narrow block of vectors is one distributed pass over
the fit list, and its result, one row for each dimension, is what the driver gets.

The eigenpairs come from a small subspace.  In each round Rayleigh-Ritz in it gives candidates u with
values t and residuals r = V u - t u; leading pairs whose residual is at double precision are locked.
For the others the correction equation (I - Q Q') (V - t I) (I - Q Q') z = -r, with the locked vectors
and u in Q, is solved by some steps of MINRES, all of them side by side so that a step is one pass;
the corrections widen the subspace, which is cut back to its best vectors when it gets too wide.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries have no result,
nor have rows whose length is not the most frequent one (of equally frequent ones the greatest);
equal vectors and repeated rows get equal results; a component without variance (not more than
rounding) is left out, so one distinct vector or an empty table give no rows; entries beyond 2^47
count as that; a deviation beyond a long is null.  Vectors longer than ``_MOST`` entries are refused with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netrollup.llm.common import map_batches, quoted, staged, whole_row

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Steps of MINRES for one correction.
INNER = 4
#: Residual, in parts of the greatest eigenvalue, that counts as double precision.
TOLERANCE = 2.0 ** -45
#: What is accepted where rounding keeps the residuals from falling further.
_FLOOR = 2.0 ** -40
_ROUNDS = 200
_MOST = 1 << 16
#: Vectors in one stored block of the fit list.
_BLOCK_BYTES = 1 << 21
_LONG = 2 ** 63
_WHOLE = 2.0 ** 53


def whole(vector: Column) -> Column:
    """x of every entry, as far as doubles hold whole numbers."""
    def of(c: Column) -> Column:
        scaled = F.greatest(F.lit(-_WHOLE), F.least(F.lit(_WHOLE), SCALE * c.cast("double")))
        return F.floor(scaled) + SHIFT

    return F.transform(vector, of)


def usable(vector: Column) -> Column:
    """Whether all entries are there and finite."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c)
                    & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype).reshape(len(column), -1)


def _summed(rows: DataFrame, width: int, work: Callable[[DataFrame], Iterator]) -> np.ndarray:
    """Adds up what ``work`` makes of the batches of a task, matrices of ``width`` columns.

    Every task sends one row for each row of its matrix; they are added by Spark.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for matrix in work(batches):
            total = matrix if total is None else total + matrix
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)),
                 *[pa.array(np.ascontiguousarray(total[:, j])) for j in range(width)]],
                ["row", *[f"c{j}" for j in range(width)]])

    names = [f"c{j}" for j in range(width)]
    made = map_batches(rows, "row int, " + ", ".join(f"{c} double" for c in names), run)
    got = made.groupBy("row").agg(*[F.sum(c).alias(c) for c in names]).collect()
    out = np.zeros((len(got), width))
    for r in got:
        out[r[0]] = r[1:]
    return out


@dataclass
class FitList:
    """The distinct vectors, centred, in stored blocks of many vectors each."""

    blocks: DataFrame
    n: int
    sums: np.ndarray       # of whole numbers
    trace: float

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """V times ``vectors``, in one pass."""
        dim, width = vectors.shape

        def work(batches):
            for batch in batches:
                for cell in batch.column("block"):
                    centred = np.frombuffer(cell.as_buffer(), np.float64).reshape(-1, dim)
                    yield centred.T @ (centred @ vectors)

        return _summed(self.blocks, width, work) / self.n

    def gram(self, vectors: np.ndarray) -> np.ndarray:
        """Covariance of the vectors' projections, in one pass."""
        dim, width = vectors.shape

        def work(batches):
            for batch in batches:
                for cell in batch.column("block"):
                    z = np.frombuffer(cell.as_buffer(), np.float64).reshape(-1, dim) @ vectors
                    yield z.T @ z

        return _summed(self.blocks, width, work) / self.n


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact; as Python's whole numbers where 64 bits might not hold it."""
    if n * int(np.abs(x).max(initial=0)) < _LONG // 4:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def fit_list(vectors: DataFrame) -> FitList | None:
    """The distinct ``x`` of ``vectors``; None if there are none."""
    distinct = staged(vectors.select("x").distinct(), "white-distinct")
    dim = distinct.select(F.size("x")).first()
    if dim is None:
        return None
    dim = dim[0]
    if dim > _MOST:
        raise ValueError(f"vectors of {dim} entries")

    def sums(batches):
        """Sums of the whole numbers in two halves, which doubles hold exactly, and the count."""
        for batch in batches:
            x = _matrix(batch.column("x"), np.int64)
            total = [int(v) for v in x.astype(object).sum(0)] if len(x) and \
                len(x) * int(np.abs(x).max()) >= _LONG else x.sum(0).tolist()
            yield np.array([[v >> 32, v & 0xFFFFFFFF, len(x)] for v in total], np.float64)

    halves = _summed(distinct, 3, sums)
    n = int(halves[0, 2])
    total = np.array([(int(a) << 32) + int(b) for a, b, _ in halves], object)

    def squares(batches):
        for batch in batches:
            centred = _deviations(_matrix(batch.column("x"), np.int64), n, total) / n
            yield np.asarray(centred, np.float64).__pow__(2).sum(0)[:, None]

    trace = float(_summed(distinct, 1, squares).sum() / n)

    def pack(batches):
        for batch in batches:
            centred = np.asarray(_deviations(_matrix(batch.column("x"), np.int64), n, total) / n,
                                 np.float64)
            step = max(1, _BLOCK_BYTES // (8 * dim))
            for at in range(0, len(centred), step):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([np.ascontiguousarray(centred[at:at + step]).tobytes()],
                              pa.binary())], ["block"])

    blocks = staged(map_batches(distinct, "block binary", pack), "white-blocks")
    return FitList(blocks.persist(StorageLevel.MEMORY_AND_DISK), n, total, trace)


def _orthonormal(basis: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Vectors that widen ``basis`` (orthonormal columns) by what is new in ``more``."""
    for _ in range(2):
        more = more - basis @ (basis.T @ more)
        norms = np.linalg.norm(more, axis=0)
        more = more[:, norms > 0] / norms[norms > 0]
        q, r = np.linalg.qr(more)
        more = q[:, np.abs(np.diag(r)) > 1e-10]
    return more[:, : basis.shape[0] - basis.shape[1]]


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int,
           enough: float = 1e-3) -> np.ndarray:
    """Least-residual solutions of one symmetric system for each column, side by side.

    ``apply`` gives the product of every column with its own matrix.
    """
    beta = np.linalg.norm(rhs, axis=0)
    v_old, v = np.zeros_like(rhs), rhs / np.where(beta > 0, beta, 1)
    w_old, w, x = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    cos_old, cos = np.ones_like(beta), np.ones_like(beta)
    sin_old, sin = np.zeros_like(beta), np.zeros_like(beta)
    left, limit, beta = beta.copy(), enough * beta, np.zeros_like(beta)
    for _ in range(steps):
        live = np.abs(left) > limit
        if not live.any():
            break
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v_old
        beta_next = np.linalg.norm(p, axis=0)
        # The rotations of the two steps before, then a new one that clears the last entry.
        diagonal = cos * alpha - cos_old * sin * beta
        above, far = sin * alpha + cos_old * cos * beta, sin_old * beta
        r = np.hypot(diagonal, beta_next)
        live &= r > 0
        r = np.where(r > 0, r, 1)
        cos_old, cos, sin_old, sin = cos, diagonal / r, sin, beta_next / r
        w_old, w = w, (v - far * w_old - above * w) / r
        x = x + np.where(live, cos * left, 0) * w
        left = np.where(live, -sin * left, 0)
        v_old, v, beta = v, p / np.where(beta_next > 0, beta_next, 1), beta_next
    return x


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], dim: int, k: int,
                  inner: int = INNER, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues, falling, and unit eigenvectors of a symmetric matrix of which
    only ``product``, its product with a block of vectors, is known."""
    k = min(k, dim)
    extra = min(dim, k + 4)
    widest = 3 * extra
    noise = np.random.default_rng(seed)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = np.linalg.qr(noise.standard_normal((dim, extra)))[0]
    image = product(basis)
    best, stuck = np.inf, 0
    for _ in range(_ROUNDS):
        # Rayleigh-Ritz beside what is locked.
        small = basis.T @ image
        t, s = np.linalg.eigh((small + small.T) / 2)
        t, s = t[::-1], s[:, ::-1]
        u, vu = basis @ s, image @ s
        resid = vu - u * t
        resid -= locked @ (locked.T @ resid)
        scale = max(np.abs(t).max(), np.abs(values).max(initial=0))
        if scale == 0:
            return np.zeros(0), np.zeros((dim, 0))
        wanted = min(k - len(values), len(t))
        size = np.linalg.norm(resid[:, :wanted], axis=0) / scale
        good = size <= TOLERANCE
        stuck = stuck + 1 if size[0] > best / 2 else 0
        best = min(best, size[0])
        if stuck >= 3 and best <= _FLOOR:
            good[0] = True       # as far as the rounding of the passes lets it fall
        # The leading pairs that are exact, up to the first that is not.
        done = wanted if good.all() else int(np.argmin(good))
        if done:
            locked, values = np.hstack([locked, u[:, :done]]), np.append(values, t[:done])
            best, stuck = np.inf, 0
        if len(values) == k:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        u, vu, t, resid = u[:, done:], vu[:, done:], t[done:], resid[:, done:]
        if u.shape[1] + k - len(values) > widest:
            u, vu, t, resid = u[:, :extra], vu[:, :extra], t[:extra], resid[:, :extra]
        now = min(k - len(values), u.shape[1])
        ritz, theta = u[:, :now], t[:now]

        def clear(z, ritz=ritz, locked=locked):
            z = z - locked @ (locked.T @ z)
            return z - ritz * (ritz * z).sum(0)

        def corrected(z, theta=theta, clear=clear):
            z = clear(z)
            return clear(product(z) - theta * z)

        taken = np.hstack([locked, u])
        if taken.shape[1] < dim:
            more = minres(corrected, -clear(resid[:, :now]), inner)
            more = _orthonormal(taken, more)
            if not more.shape[1]:
                more = _orthonormal(taken, noise.standard_normal((dim, 1)))
            basis, image = np.hstack([u, more]), np.hstack([vu, product(more)])
        else:
            # Nothing is left to widen with; a fresh image clears the rounding of the old one.
            basis, image = u, product(u)
    raise ArithmeticError("the residuals do not reach double precision")


@dataclass
class Whitening:
    n: int
    sums: np.ndarray
    values: np.ndarray       # falling
    vectors: np.ndarray      # unit columns
    trace: float
    identity_error: float


def prepared(df: DataFrame, vector: str) -> DataFrame:
    """``doc`` (the whole row) and ``x`` of the rows that have a result."""
    rows = df.select(whole_row(df), F.col(quoted(vector)).alias("v")).where(usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("len")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("len")).first()
    rows = rows.where(F.size("v") == (most.len if most else 0))
    return rows.select("doc", whole(F.col("v")).alias("x"))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The transformation that the ``x`` of ``rows`` give; None without rows."""
    fitted = fit_list(rows)
    if fitted is None:
        return None
    try:
        values, vectors = leading_pairs(fitted.product, len(fitted.sums), components)
        some = values > np.finfo(float).eps * len(fitted.sums) * max(values, default=0)
        values, vectors = values[some], vectors[:, some]
        error = 0.0
        if len(values):
            covariance = fitted.gram(vectors / np.sqrt(values))
            error = float(np.abs(covariance - np.eye(len(values))).max())
        return Whitening(fitted.n, fitted.sums, values, vectors, fitted.trace, error)
    finally:
        fitted.blocks.unpersist()


def apply(rows: DataFrame, white: Whitening) -> DataFrame:
    """For every row of :func:`prepared` and component: ``doc``, ``component`` from 1, ``deviation``
    and ``whitened``."""
    k = len(white.values)
    turn = white.vectors / np.sqrt(white.values)
    n, sums = white.n, white.sums
    made = F.lit(None).cast("struct<deviation: bigint, w: array<double>>").alias("made")
    schema = rows.select("doc", made).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gap = _deviations(_matrix(batch.column("x"), np.int64), n, sums)
            most = int(np.abs(gap).max(initial=0))
            if gap.shape[1] * most * most < _LONG:
                total = (gap.astype(np.int64) ** 2).sum(1).tolist()
            else:
                total = [sum(int(v) ** 2 for v in row) for row in gap]
                total = [v if v < _LONG else None for v in total]
            w = np.asarray(gap / n, np.float64) @ turn
            made = pa.StructArray.from_arrays(
                [pa.array(total, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * k),
                                          pa.array(w.ravel()))], ["deviation", "w"])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), made], ["doc", "made"])

    return rows.mapInArrow(work, schema).select("doc", F.col("made.deviation").alias("deviation"),
                      F.posexplode("made.w").alias("at", "whitened")).select(
        "doc", (F.col("at") + 1).alias("component"), "deviation", "whitened")


def whiten(df: DataFrame, *, vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame | None:
    """``doc``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error`` for every usable row and component."""
    rows = staged(prepared(df, vector), "white-rows")
    white = fit(rows, components)
    if white is None or not len(white.values):
        white = Whitening(1, np.zeros(1, object), np.ones(1), np.ones((1, 1)), 1.0, 0.0)
        rows = rows.limit(0)
    share = F.array(*[F.lit(float(e / white.trace)) for e in white.values])
    return apply(rows, white).select(
        "doc", "component", F.lit(white.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("component") - 1).alias("explained"),
        F.lit(white.identity_error).alias("identity_error"))
