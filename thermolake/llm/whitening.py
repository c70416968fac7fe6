"""Whitening of embeddings: exact distributed covariance, and eigenvectors refined from float32.

Vectors are put on a grid (x = floor(256 c)), so that every sum over them is a sum of integers: sums, the
covariance and each row's deviation are exact, whatever the order of tasks. float32 gives a first set of
eigenvectors; steps that are matrix products in extended precision (Ogita and Aishima) double their digits each
time. Eigenvalues that lie too close for such a step form a cluster, whose few columns are turned by an
eigenproblem of their own.

Only sums of the matrix's size leave the tasks: the square of the vectors' length, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake.llm import textkit
from thermolake.session import Scratch

GRID = 256.0
#: Floats hold integers up to 2^53: limbs of so many bits, and products of so many rows, are summed without rounding.
LIMB_BITS, LIMB_ROWS = 20, 4096
#: Entries beyond this have no place on the grid as a long.
MOST_ENTRY = float(1 << 55)
_WORD = 1 << 64


@dataclass
class Whitening:
    """n vectors of the fit list and their exact sums; eigenvalues, falling, and unit eigenvectors (columns) of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def scaled(self, k: int) -> np.ndarray:
        """The first k components over the roots of their eigenvalues; nan where an eigenvalue is nothing but rounding."""
        e = self.values[:k]
        some = e > 16 * len(self.sums) * np.finfo(float).eps * max(self.values.max(initial=0.0), 0.0)
        return self.vectors[:, :k] / np.sqrt(np.where(some, e, np.nan))


def on_grid(vector: Column) -> Column:
    """floor(256 c) of each entry c as longs; null where the vector is null or holds what is null, not finite, or beyond a long."""
    fine = F.forall(vector, lambda c: F.coalesce((F.abs(c.cast("double")) < MOST_ENTRY) & ~F.isnan(c), F.lit(False)))
    return F.when(fine, F.transform(vector, lambda c: F.floor(c.cast("double") * GRID)))


def matrix_of(column: pa.Array, size: int) -> np.ndarray:
    """Lists of longs as rows of `size` entries; what a shorter one lacks is 0."""
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (lengths == size).all():
        return flat.reshape(len(column), size)
    out = np.zeros((len(column), size), np.int64)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y of integers as Python integers: by limbs in floats, each product of which is exact, or as they are where they are huge."""
    size = y.shape[1]
    if not len(y):
        return np.zeros((size, size), object)
    bits = max(int(y.max()), -int(y.min())).bit_length()
    if bits > 3 * LIMB_BITS:
        return y.astype(object).T @ y.astype(object)
    limbs, rest = [], y
    while len(limbs) * LIMB_BITS < max(bits, 1):
        low = rest & ((1 << LIMB_BITS) - 1) if bits > LIMB_BITS else rest
        limbs.append(low.astype(np.float64))
        rest = rest >> LIMB_BITS if bits > LIMB_BITS else rest
    if bits > LIMB_BITS:
        limbs.append(rest.astype(np.float64))
    out = np.zeros((size, size), object)
    for at in range(0, len(y), LIMB_ROWS):
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                part = a[at : at + LIMB_ROWS].T @ b[at : at + LIMB_ROWS]
                out += part.astype(np.int64).astype(object) * (1 << (LIMB_BITS * (i + j)))
    return out


def _sums(size: int, center: list[int] | None):
    """Rows (i, j, high, low) of a task's sums, high * 2^64 + low: of the entries (i = -1), or of the products of what is left without the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 if center is None else size, size), object)
        for batch in batches:
            x = matrix_of(batch.column(0), size)
            if center is not None:
                wide = int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, center)) < 1 << 62
                total += exact_products(x - np.array(center, np.int64)) if wide else (x.astype(object) - np.array(center, object)).T @ (x.astype(object) - np.array(center, object))
            elif np.abs(x.astype(float)).sum(axis=0).max(initial=0) < float(1 << 62):
                total[0] += x.sum(axis=0).astype(object)
            else:
                total[0] += x.astype(object).sum(axis=0)
        at = [(-1, j) for j in range(size)] if center is None else [(i, j) for i in range(size) for j in range(i, size)]
        values = [int(total[max(i, 0), j]) for i, j in at]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()), pa.array([v // _WORD for v in values], kind), pa.array([v % _WORD for v in values], kind)],
            names=["i", "j", "high", "low"],
        )

    return run


def _gathered(fit: DataFrame, size: int, center: list[int] | None) -> dict[tuple[int, int], int]:
    parts = fit.mapInArrow(_sums(size, center), "i int, j int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # size^2 / 2 rows at most
    return {(r.i, r.j): int(r.high) * _WORD + int(r.low) for r in rows}


def _wide(value: Fraction) -> np.longdouble:
    first = float(value)
    return np.longdouble(first) + np.longdouble(float(value - Fraction(first)))


def fit_whitening(fit: DataFrame, size: int) -> Whitening:
    """From a table of distinct vectors x (array<long>) of at most `size` entries."""
    first = _gathered(fit, size, None)
    n, sums = fit.count(), [first.get((-1, j), 0) for j in range(size)]
    center = [round(Fraction(s, n)) for s in sums]
    products = _gathered(fit, size, center)
    left = [Fraction(s, n) - c for s, c in zip(sums, center, strict=True)]
    v = np.zeros((size, size), np.longdouble)
    for (i, j), total in products.items():
        v[i, j] = v[j, i] = _wide(Fraction(total, n) - left[i] * left[j])
    values, vectors = refined_eigen(v)
    return Whitening(n, sums, values.astype(float), vectors.astype(float), float(np.trace(v)))


# -- eigenvectors ------------------------------------------------------------------------------------------
def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of eigenvalues that neighbours no further than the gap apart chain together."""
    order = np.argsort(values)
    return np.split(order, np.flatnonzero(np.diff(values[order]) > gap) + 1)


def refined_eigen(v: np.ndarray, most: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of extended precision, to double precision.

    Each step measures how far X is from orthogonal (R) and how far X'VX is from diagonal (S), and corrects X by
    a product. A pair of values closer than what R and S leave open cannot be told apart by that: columns of such
    a cluster are made orthogonal only, and then turned by the eigenvectors of their own small matrix, taken
    around its mean and scaled up to its own size, where float32 sees the gaps that it could not see before.
    """
    size, scale = len(v), np.abs(v).max(initial=0)
    if not size or scale == 0:
        return np.zeros(size), np.eye(size)
    a = v / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eps, one = np.finfo(np.longdouble).eps, np.eye(size, dtype=np.longdouble)
    for _ in range(most):
        r, s = one - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else rounding, divided by a small gap, would spoil orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        # rows of a symmetric matrix bound its norm
        open_ = 2 * (np.abs(s - np.diag(values)).sum(axis=1).max() + np.abs(a).sum(axis=1).max() * np.abs(r).sum(axis=1).max())
        if np.abs(r).max() <= 8 * size * eps and np.abs(off).max() <= 8 * size * eps:
            break
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > open_
        x = x + x @ np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        for own in clusters(values, float(open_)):
            if len(own) > 1:
                c = x[:, own]
                mean = values[own].mean()
                small = c.T @ (a @ c) - mean * (c.T @ c)
                if np.abs(small - np.diag(np.diag(small))).max() > size * eps:
                    turn = np.linalg.eigh((small / np.abs(small).max()).astype(np.float32))[1].astype(np.longdouble)
                    for _ in range(3):  # orthogonal in extended precision too, as the columns are that it turns
                        turn = turn @ (3 * np.eye(len(own), dtype=np.longdouble) - turn.T @ turn) / 2
                    x[:, own] = c @ turn
    order = np.argsort(-values, kind="stable")
    x = x / np.sqrt((x * x).sum(axis=0))
    return values[order] * scale, x[:, order]


# -- whitened rows -----------------------------------------------------------------------------------------
def _project(model: Whitening, k: int, deviation: bool):
    size = len(model.sums)
    mean, turn = np.array([float(Fraction(s, model.n)) for s in model.sums]), model.scaled(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column(batch.num_columns - 1), size)
            w = (x - mean) @ turn
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * turn.shape[1]), pa.array(w.reshape(-1), from_pandas=True))
            out = [*batch.columns[:-1], lists]
            if deviation:
                far = np.abs(x.astype(float) * model.n - np.array(model.sums, float)).max(initial=0)
                kind = np.int64 if (far + 1) ** 2 * max(size, 1) < 2.0**62 and np.abs(x.astype(float)).max(initial=0) * model.n < 2.0**62 and max(map(abs, model.sums), default=0) < 1 << 62 else object
                z = x.astype(kind) * model.n - np.array(model.sums, kind)
                totals = [int(t) for t in (z * z).sum(axis=1)]
                out.append(pa.array([t if t < 1 << 63 else None for t in totals], pa.int64()))
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names[:-1], "w", "deviation"][: len(out)])

    return run


def whiten(vectors: DataFrame, model: Whitening, keep: list[str], k: int = 4, deviation: bool = True) -> DataFrame:
    """The columns `keep`, w (whitened values of the first k components) and deviation of a table with a column x of longs."""
    rows = vectors.select(*keep, "x")
    fields = [*(rows.schema[c] for c in keep), T.StructField("w", T.ArrayType(T.DoubleType())), *([T.StructField("deviation", T.LongType())] if deviation else [])]
    return rows.mapInArrow(_project(model, k, deviation), T.StructType(fields))


def whitened_components(vectors: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every row and each of the first k components.

    Rows whose vector is null, or holds an entry that is null, not finite or beyond +-2^55, are left out. The fit
    list has each distinct vector once, so copies do not weigh. Vectors of unequal length are taken as having
    zeros at their end; if all are empty, or no row is left, there is no row. Fewer than k components are given
    where vectors are shorter. A component whose eigenvalue is nothing but rounding (all vectors equal, or fewer
    than components) has a null whitened value and no say in identity_error; where no component has one, that is
    null, as is explained where all vectors are equal. A deviation beyond a long is null. Rows with a null or
    repeated id each give their rows; other columns are not read, so that they may have any name.
    """
    scratch = Scratch(vectors.sparkSession, "whiten")
    x = vectors.select(F.col(id_col).cast("long").alias("vec_id"), on_grid(F.col(vector_col)).alias("x")).where("x is not null")
    fit = scratch.table(x.select("x").distinct(), "fit")
    least, size = (v or 0 for v in fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first())
    if not size:
        scratch.keep()
        return vectors.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if least < size:  # vectors that only differ in zeros at their end are one
        filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("x")))
        fit = scratch.table(fit.select(filled.alias("x")).distinct(), "filled")
    model = fit_whitening(fit, size)
    some = min(k, size)
    # the covariance of what whitening gives, by Spark's own centred sums
    each = whiten(fit, model, [], some, deviation=False)
    pairs = [(i, j) for i in range(some) for j in range(i, some)]
    errors = [F.abs(F.covar_pop(F.col("w")[i], F.col("w")[j]) - float(i == j)) for i, j in pairs]
    found = each.agg(*[e.alias(f"e{i}") for i, e in enumerate(errors)]).first()
    error = max((e for e in found if e is not None and not np.isnan(e)), default=None)
    explained = [float(e) / model.trace if model.trace > 0 else None for e in model.values[:some]]
    scratch.keep()
    rows = whiten(x, model, ["vec_id"], some).select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    share = F.element_at(F.array(*[F.lit(e).cast("double") for e in explained]), F.col("at") + 1)
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
