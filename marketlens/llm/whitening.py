"""Whitening of embeddings, with eigenvectors refined from float32 to double precision.

* *Integers.* An entry c becomes x = floor(256 * c). The fit list holds each distinct
  x-vector once (one shuffle, after a first reduction within the tasks).
* *Covariance.* Sums first; then products of z = x - centre, where the centre is the
  mean rounded to integers, so that nothing cancels and all sums are exact integers.
  What a task gathers is d * d numbers, which add up by place in Spark; only the d * d
  totals reach the driver. From them the covariance follows as exact fractions.
* *Eigenvectors.* `numpy` solves the matrix in float32. Ogita-Aishima steps correct the
  result: with R = I - X'X and S = X'AX, X(I + E) has
  E[i, j] = (S[i, j] + l[j] R[i, j]) / (l[j] - l[i]) where the eigenvalues l[i], l[j] are
  apart, else R[i, j] / 2. Each step doubles the digits; steps run in float64 and then
  in extended precision (`numpy.longdouble`). Eigenvalues that the step's own error
  bound cannot tell apart form a cluster; the small matrix of a cluster, shifted by its
  mean, is solved by itself and turns the cluster's vectors.
* *Output.* Rows are projected where they lie; nothing is shuffled.

Edge cases: rows whose vector is null, empty, or holds null or non-finite entries are
dropped, as are those whose length is not that of most distinct vectors (ties: the
longest); repeated rows are returned as often as they occur and count once in the fit;
with fewer than ``components`` dimensions there are so many components; a component of
no variance has whitened null, explained 0 (null if there is no variance at all) and no
part in identity_error (null if there is no other); a deviation beyond a long is null;
a null id stays null; an empty table gives an empty result; other columns are ignored.
Components have either sign: the entry of largest size is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import arrow_map, materialize, out_batch, out_schema, table, utf8

SCALE = 256
COMPONENTS = 4
#: Refinement steps at most in each precision.
STEPS = 12
LARGEST = 2**63 - 1
_NUMBER = pa.decimal128(38, 0)


# --- integers --------------------------------------------------------------

def integers(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with sound vectors, their lengths, and the integers end to end."""
    column = column.cast(pa.large_list(pa.float64()))
    values = column.flatten()  # null rows have no entries here
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    v = pc.fill_null(values, np.nan).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.zeros(len(lengths), bool)
    bad[owner[~np.isfinite(v)]] = True
    good = ~bad & (lengths > 0)
    x = np.floor(scale * v[good[owner]])
    return np.flatnonzero(good), lengths[good], np.clip(x, -2.0**62, 2.0**62).astype(np.int64)


def _packed(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        _, lengths, x = integers(b.column(0), scale)
        ends = np.concatenate([[0], np.cumsum(lengths) * 8])
        if ends[-1] >= 2**31:
            raise ValueError("a batch of vectors of over 2 GB")
        raw = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32).tobytes()),
                                                                pa.py_buffer(x.astype("<i8").tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int32()), raw], ["dim", "x"])


def distinct_vectors(df: DataFrame, vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(dim, x): each distinct integer vector once, as little-endian 64-bit integers."""
    packed = arrow_map(df.select(F.col(vec_col).alias("_v")), lambda it: _packed(it, scale), "dim int, x binary")
    return packed.distinct()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(utf8(column)[0].tobytes(), "<i8").reshape(-1, dim)


# --- exact sums ------------------------------------------------------------

def exact_product(z: np.ndarray) -> np.ndarray:
    """z'z of an integer matrix, exactly: through float64 as far as that holds all digits."""
    top = int(np.abs(z).max(initial=0))
    rows = (2**53 - 1) // max(1, top * top)
    if not rows:
        o = z.astype(object)
        return o.T @ o
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i in range(0, len(z), rows):
        part = z[i:i + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(dim, object)
    for b in batches:
        x = _matrix(b.column(0), dim)
        wide = int(np.abs(x).max(initial=0)) * len(x) > LARGEST
        total = total + (x.astype(object) if wide else x).sum(0).astype(object)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()),
                                      pa.array([Decimal(int(v)) for v in total], _NUMBER)], ["i", "v"])


def _products(batches: Iterator[pa.RecordBatch], dim: int, centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = np.zeros((dim, dim), object)
    for b in batches:
        total = total + exact_product(_matrix(b.column(0), dim) - centre)
    i, j = np.triu_indices(dim)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                      pa.array([Decimal(int(v)) for v in total[i, j]], _NUMBER)], ["i", "j", "v"])


# --- eigenvectors ----------------------------------------------------------

def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One correction in the precision of ``a``: vectors, eigenvalues, which neighbours are too close, size of the change."""
    n = len(a)
    r = np.eye(n, dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    value = np.diag(s) / (1 - np.diag(r))
    order = np.argsort(-value, kind="stable")
    x, r, s, value = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], value[order]
    size = lambda m: float(np.sqrt((m.astype(np.float64) ** 2).sum()))
    bound = 2 * (size(s - np.diag(value)) + size(a) * size(r))
    gap = value[None, :] - value[:, None]
    apart = np.abs(gap) > bound
    e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, value, ~apart.diagonal(1), float(np.abs(e).max())


def _clusters(close: np.ndarray) -> Iterator[slice]:
    """Runs of eigenvalues of which each is too close to the next."""
    begin = 0
    for i, c in enumerate([*close.tolist(), False]):
        if not c:
            if i > begin:
                yield slice(begin, i + 1)
            begin = i + 1


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix in extended precision."""
    n = len(a)
    top = np.abs(a).max(initial=0)
    if not top:
        return np.zeros(n), np.eye(n)
    scale = np.longdouble(2.0) ** int(np.floor(np.log2(float(top))))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1]
    for kind in (np.float64, np.longdouble):
        work, x, solved = a.astype(kind), x.astype(kind), False
        for _ in range(STEPS):
            x, value, close, change = _step(work, x)
            # what a step leaves is of the size of its change squared
            if change <= np.sqrt(np.finfo(kind).eps) / 4 and (solved or not close.any()):
                break
            solved = True
            for c in _clusters(close):
                sub = x[:, c]
                middle = value[c].mean()
                small = sub.T @ (work @ sub - middle * sub)
                small = (small + small.T).astype(np.float64) / 2
                span = np.abs(small).max()
                if span:
                    x[:, c] = sub @ np.linalg.eigh(small / span)[1][:, ::-1].astype(kind)
    x = x + x @ (np.eye(n, dtype=x.dtype) - x.T @ x) / 2
    value = (x * (a @ x)).sum(0)
    order = np.argsort(-value, kind="stable")
    return value[order] * scale, x[:, order]


# --- fit and transform -----------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` distinct vectors with sums centre * n + rest; components are columns."""
    scale: int
    dim: int
    n: int
    centre: np.ndarray  # integers next to the mean
    rest: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def count(self) -> int:
        return self.components.shape[1]

    @property
    def live(self) -> np.ndarray:
        """Components that have variance."""
        return self.values > self.trace * self.dim * np.finfo(np.float64).eps

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of integer vectors; those without variance are nan."""
        shift = np.array([float(Fraction(r, self.n)) for r in self.rest])
        root = np.sqrt(np.where(self.live, self.values, np.nan))
        return ((x - self.centre).astype(np.float64) - shift) @ self.components / root

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)^2, exactly."""
        z, rest = x - self.centre, np.array(self.rest, object)
        most = self.n * int(np.abs(z).max(initial=0)) + max(abs(r) for r in self.rest)
        if most * most * self.dim <= LARGEST:
            y = self.n * z - rest.astype(np.int64)
            return (y * y).sum(1).tolist()
        y = self.n * z.astype(object) - rest
        return [d if d <= LARGEST else None for d in (y * y).sum(1).tolist()]


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS,
        scale: int = SCALE) -> tuple[Whitening | None, DataFrame]:
    """The whitening of the vectors of ``df`` (None without any), and the fit list (x)."""
    vectors = materialize(distinct_vectors(df, vec_col, scale), "vectors")
    dims = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if dims is None:
        return None, vectors.select("x")
    dim, n = dims
    vectors = vectors.where(F.col("dim") == dim).select("x")
    total = {r.i: int(r.v) for r in arrow_map(vectors, lambda it: _sums(it, dim), "i int, v decimal(38,0)")
             .groupBy("i").agg(F.sum("v").alias("v")).collect()}
    centre = np.array([round(Fraction(total[i], n)) for i in range(dim)], np.int64)
    rest = tuple(total[i] - n * int(centre[i]) for i in range(dim))
    product = arrow_map(vectors, lambda it: _products(it, dim, centre), "i int, j int, v decimal(38,0)").groupBy(
        "i", "j").agg(F.sum("v").alias("v")).collect()
    cov = np.zeros((dim, dim), np.longdouble)
    for r in product:
        exact = Fraction(n * int(r.v) - rest[r.i] * rest[r.j], n * n)
        high = float(exact)
        cov[r.i, r.j] = cov[r.j, r.i] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    values, x = eigen(cov)
    keep = min(components, dim)
    x = x[:, :keep].astype(np.float64)
    x = x * np.where(x[np.abs(x).argmax(0), np.arange(keep)] < 0, -1.0, 1.0)
    return Whitening(scale, dim, n, centre, rest, x, values[:keep].astype(np.float64), float(np.trace(cov))), vectors


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest entry, in size, of the covariance of the whitened fit list less the identity."""
    at = np.flatnonzero(model.live).tolist()
    if not at:
        return None
    names = [f"w{k}" for k in at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = model.project(_matrix(b.column(0), model.dim))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in at], names)

    whitened = arrow_map(vectors, run, ", ".join(f"{c} double" for c in names))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    got = whitened.agg(*(F.covar_pop(a, b).alias(f"{a}_{b}") for a, b in pairs)).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(got, pairs))


def transform(df: DataFrame, model: Whitening, keep: tuple[str, ...] = ("vec_id",), vec_col: str = "embedding") -> DataFrame:
    """``keep`` columns, component, deviation and whitened: a row for each sound row and component."""
    source = df.select(*(F.col(c) for c in keep), F.col(vec_col).alias("_v"))
    k, names = model.count, list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, lengths, x = integers(b.column("_v"), model.scale)
            fits = lengths == model.dim
            x = x[np.repeat(fits, lengths)].reshape(-1, model.dim)
            at = pa.array(np.repeat(rows[fits], k))
            cols = {c: b.column(c).take(at) for c in names}
            w = model.project(x).ravel()
            yield out_batch(
                pa.schema([*((c, v.type) for c, v in cols.items()), ("component", pa.int32()), ("deviation", pa.int64()),
                           ("whitened", pa.float64())]), **cols, component=np.tile(np.arange(1, k + 1), len(x)),
                deviation=[d for d in model.deviations(x) for _ in range(k)], whitened=pa.array(w, mask=np.isnan(w)))

    return arrow_map(source, run, out_schema(source, keep, "component int, deviation long, whitened double"))


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "embeddings")
    model, vectors = fit(df)
    if model is None:
        return spark.createDataFrame([], out_schema(df, ["vec_id"], RESULT))
    error = identity_error(vectors, model)
    shares = [float(v) / model.trace if live else 0.0 if model.trace else None
              for v, live in zip(model.values, model.live)]
    explained = F.element_at(F.array(*(F.lit(s).cast("double") for s in shares)), F.col("component"))
    return transform(df, model).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))
