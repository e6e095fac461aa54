"""Whitening by QDWH spectral divide and conquer.

The covariance of all vectors is summed across tasks; its eigenvectors are
found without an eigenvalue routine. The polar factor of the shifted
covariance (QDWH: dynamically weighted Halley steps, by QR while the weight is
large and by Cholesky after that) is the matrix sign, hence half of it plus
half the identity projects onto the eigenvectors above the shift. Bases of
that subspace and of its complement split the matrix into two smaller ones,
which are treated alike until every block is a number (or a multiple of the
identity). The components (d x k numbers) travel to the tasks, which project
blocks of vectors.

Only d x d sums reach the driver, whatever the number of vectors; ``n``, sums
and the products of integer vectors are exact up to 2^53 in any order, so a
recomputed task changes nothing.

Defined results: rows whose vector is NULL, empty, or holds a NULL or
non-finite entry are dropped; of several vector lengths the commonest (ties:
the longest) is fitted and rows of other lengths are dropped; a NULL id is an
id like any other and repeated rows are each a vector; components whose
eigenvalue is within rounding of zero cannot be scaled to unit variance and
are left out (one row alone, or equal rows, give none); equal eigenvalues
share their subspace, any basis of which is returned; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.sources.tables import read_table

EPS = np.finfo(float).eps
#: Rows of one block product, a memory bound.
BLOCK = 8192


def polar_factor(a: np.ndarray, smallest: float) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix (its sign); ``smallest``
    bounds the singular values from below."""
    scale = np.linalg.norm(a)
    x, low = a / scale, min(1.0, max(smallest / scale, EPS))
    eye = np.eye(len(a))
    for _ in range(60):
        d = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:len(a)] @ q[len(a):].T
        else:
            lower = np.linalg.cholesky(eye + wc * x.T @ x)
            half = np.linalg.solve(lower, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(lower.T, half).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if moved < np.cbrt(EPS) and 1 - low < 10 * EPS:
            break
    return x


def _distance(a: np.ndarray) -> float:
    """A lower bound of the smallest singular value."""
    try:
        return 1 / np.linalg.norm(np.linalg.inv(a))
    except np.linalg.LinAlgError:
        return 0.0


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bases of two invariant subspaces: eigenvalues above and below a shift.

    The mean eigenvalue lies strictly inside the spectrum; shifts within
    std / (2 sqrt(k)) of it do too, and the one farthest from any eigenvalue is taken.
    """
    k = len(a)
    mean = np.trace(a) / k
    reach = np.linalg.norm(a - mean * np.eye(k)) / (2 * k)
    trials = [(_distance(a - s * np.eye(k)), s) for s in mean + reach * np.linspace(-1, 1, 9)]
    room, shift = max(trials)
    sign = polar_factor(a - shift * np.eye(k), room)
    above = (sign + np.eye(k)) / 2
    rank = min(k - 1, max(1, int(round(np.trace(above)))))
    noise = np.random.default_rng(k).standard_normal((k, k))
    start = np.hstack([above @ noise[:, :rank], noise[:, rank:] - above @ noise[:, rank:]])
    q, _ = np.linalg.qr(start)
    q, _ = np.linalg.qr(np.hstack([above @ q[:, :rank], q[:, rank:] - above @ q[:, rank:]]))
    return q[:, :rank], q[:, rank:]


def spectrum(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    size = max(np.linalg.norm(matrix), np.finfo(float).tiny)
    values, vectors, open_ = [], [], [(matrix, np.eye(len(matrix)))]
    while open_:
        a, basis = open_.pop()
        k = len(a)
        if k == 1 or np.linalg.norm(a - np.trace(a) / k * np.eye(k)) <= EPS * size:
            values += list(np.diag(a))
            vectors += list(basis.T)
            continue
        for part in _split(a):
            own = part.T @ a @ part
            open_.append(((own + own.T) / 2, basis @ part))
    x = _refined(matrix, np.array(vectors).T)
    values = np.einsum("ij,ij->j", x, matrix @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _refined(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One first-order correction of all eigenvectors: rounding that the
    splits piled up is taken out where eigenvalues lie apart."""
    gram = np.eye(len(a)) - x.T @ x
    s = x.T @ a @ x
    value = np.diag(s) / (1 - np.diag(gram))
    gap = value[None, :] - value[:, None]
    apart = np.abs(gap) > 10 * np.sqrt(EPS) * np.linalg.norm(a)  # keeps the neglected squares below rounding
    turn = np.where(apart, (s + value[None, :] * gram) / np.where(apart, gap, 1), gram / 2)
    np.fill_diagonal(turn, np.diag(gram) / 2)
    x = x + x @ turn
    return 1.5 * x - 0.5 * x @ (x.T @ x)  # orthonormal again (one Newton-Schulz step)


@dataclass
class Fit:
    """What is known of the vectors: counts, sums, and the components.

    ``axes`` (d x k) are already divided by the roots of ``values``."""

    n: int
    sums: list
    centre: np.ndarray
    rest: np.ndarray
    trace: float
    values: np.ndarray
    axes: np.ndarray

    def project(self, rows: np.ndarray) -> np.ndarray:
        # the whole part of the mean goes first, without rounding
        return ((rows - self.centre) - self.rest) @ self.axes


def usable(vector: Column) -> Column:
    """Neither NULL nor empty, and every entry a finite number."""
    kept = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & kept, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(frame: DataFrame, dims: int, mapped, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums and products of ``mapped`` rows; every task adds up its own first."""
    def run(batches):
        total, products = 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = mapped(_matrix(batch.slice(at, BLOCK).column(0)))
                total, products = total + rows.sum(axis=0), products + rows.T @ rows
        if not isinstance(total, int):
            i, j = np.triu_indices(dims)
            values = np.concatenate([total, products[i, j]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(np.full(dims, -1), i).astype(np.int32)),
                 pa.array(np.append(np.arange(dims), j).astype(np.int32)), pa.array(values)], names=["i", "j", "v"])

    parts = frame.select("x").mapInArrow(run, f"i int, j int, v {kind}")
    sums, products = np.zeros(dims), np.zeros((dims, dims))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # d (d + 3) / 2 rows
        if i < 0:
            sums[j] = v
        else:
            products[i, j] = products[j, i] = v
    return sums, products


def prepared(frame: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``x`` of the usable rows."""
    return frame.filter(usable(F.col(vec_col))).select(F.col(id_col).alias("id"), F.col(vec_col).alias("x"))


def fit(vectors: DataFrame, components: int = 8) -> tuple[DataFrame, Fit | None]:
    """The vectors of the fitted length, and their fit (None without vectors)."""
    whole = isinstance(vectors.schema["x"].dataType.elementType, T.IntegralType)
    sized = vectors.withColumn("d", F.size("x"))
    lengths = [(r["n"], r["d"]) for r in sized.groupBy("d").agg(F.count("*").alias("n"))
               .orderBy(F.desc("n"), F.desc("d")).limit(1).collect()]
    if not lengths:
        return vectors, None
    n, dims = lengths[0]
    frame = sized.filter(F.col("d") == dims).select("id", "x")

    def partial(batches):
        total = 0
        for batch in batches:
            if batch.num_rows:
                total = total + _matrix(batch.column(0)).sum(axis=0)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(total)],
                                             names=["j", "v"])

    kind = "long" if whole else "double"
    parts = frame.select(F.col("x").cast(f"array<{kind}>").alias("x")).mapInArrow(partial, f"j int, v {kind}")
    sums = [r["v"] for r in parts.groupBy("j").agg(F.sum("v").alias("v")).orderBy("j").collect()]
    if whole:
        centre = np.array([s // n for s in sums], float)
        rest = np.array([(s % n) / n for s in sums])
    else:
        centre, rest = np.array(sums) / n, np.zeros(dims)
    drift, products = _summed(frame, dims, lambda rows: rows.astype(float) - centre, "double")
    drift = rest if whole else drift / n
    covariance = products / n - np.outer(drift, drift)
    values, axes = spectrum(covariance)
    kept = values[:components] > dims * EPS * max(values[0], 0.0)
    values, axes = values[:components][kept], axes[:, :components][:, kept]
    return frame, Fit(n, sums, centre, drift, float(np.trace(covariance)), values, axes / np.sqrt(values))


def identity_error(frame: DataFrame, model: Fit) -> float:
    """Largest entry of the whitened covariance minus the identity."""
    k = len(model.values)
    total, products = _summed(frame, k, lambda rows: model.project(rows), "double")
    mean = total / model.n
    return float(np.abs(products / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(frame: DataFrame, model: Fit) -> DataFrame:
    """``id``, ``x``, and ``whitened``: one number for every component."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows = model.project(_matrix(part.column(1)))
                ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(ends, rows.ravel())],
                    names=["id", "x", "whitened"])

    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    return frame.mapInArrow(run, f"id {kinds['id']}, x {kinds['x']}, whitened array<double>")


SCHEMA = ("vec_id {}, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def op11(spark, sf_dir: str) -> DataFrame:
    return whitened_rows(read_table(spark, sf_dir, "embeddings"))


def whitened_rows(table: DataFrame) -> DataFrame:
    """One row per vector and component. ``deviation`` is a long by contract: a
    value beyond 2^63 (above some million vectors) ends with Spark's overflow error."""
    whole = F.transform("x", lambda c: F.floor(c.cast("double") * 1024) + F.lit(100000).cast("long"))
    vectors = prepared(table, "vec_id", "embedding").withColumn("x", whole)
    frame, model = fit(vectors, 8)
    schema = SCHEMA.format(table.schema["vec_id"].dataType.simpleString())
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], schema)
    error = identity_error(frame, model)
    sums = F.array(*[F.lit(int(s)) for s in model.sums])
    n = F.lit(model.n).cast("long")
    apart = F.zip_with("x", sums, lambda x, s: (n * x - s) * (n * x - s))
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    rows = whiten(frame, model).select(
        "id", F.aggregate(apart, F.lit(0).cast("long"), lambda a, b: a + b).alias("deviation"),
        F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), n.alias("n"), "deviation",
                       "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
