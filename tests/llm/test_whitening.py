"""Whitening against plain linear algebra and exact fractions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermolake.llm import whitening as W


@pytest.mark.parametrize("values", [[3, 2, 1], [5, 5, 5, 1], [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5 + 1e-13, 0.1], [1e3, 1, 1e-6, 0, 0], [*np.linspace(1, 2, 40), 1.5 + 1e-8, 1.5 + 2e-8, 1.5]])
def test_refinement_tells_clustered_values_apart(values):
    d, size = np.array(values, float), len(values)
    q = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (3 * np.eye(size) - q.T @ q) / 2
    v = (q * d) @ q.T
    e, x = W.refined_eigen((v + v.T) / 2)
    assert np.abs(e - np.sort(d)[::-1]).max() <= 1e-15 * max(d)
    assert np.abs(x.T @ x - np.eye(size)).max() < 1e-16
    assert np.abs(v @ x - x * e).max() < 1e-16 * max(d)


@pytest.mark.parametrize("bits", [3, 19, 20, 21, 40, 41, 60, 61, 62])
def test_products_are_exact(bits):
    rows = [[random.randint(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(50)]
    got = W.exact_products(np.array(rows, np.int64))
    assert [[int(v) for v in r] for r in got] == [[sum(r[i] * r[j] for r in rows) for j in range(3)] for i in range(3)]


def plain(rows, k=4):
    """{(id, component): (deviation, |whitened|, explained)} of (id, vector)."""
    fine = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max((len(x) for _, x in fine), default=0)
    fine = [(i, x + [0] * (size - len(x))) for i, x in fine]
    fit = sorted({tuple(x) for _, x in fine})
    n, out = len(fit), {}
    if size:
        s = [sum(c) for c in zip(*fit, strict=True)]
        v = np.atleast_2d(np.cov(np.array(fit, float).T, bias=True))
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        for i, x in fine:
            w = (np.array(x) - np.array(fit).mean(axis=0)) @ u
            for c in range(min(k, size)):
                some = e[c] > 1e-9
                out[i, c + 1] = (sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)), abs(w[c]) / math.sqrt(e[c]) if some else None, e[c] / e.sum() if e.sum() > 1e-9 else None)
    return n, out


def check(found, rows):
    n, want = plain(rows)
    got = {(r.vec_id, r.component): r for r in found}
    assert set(got) == set(want) and len(found) == len(want)
    for key, (deviation, whitened, explained) in want.items():
        r = got[key]
        assert r.n == n and r.deviation == deviation
        assert (r.whitened is None) == (whitened is None) and (whitened is None or abs(abs(r.whitened) - whitened) < 1e-9)
        assert explained is None or abs(r.explained - explained) < 1e-9
        assert r.identity_error is None or r.identity_error < 1e-6
    return got


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.select("*", *[F.lit("?").alias(c) for c in ("x", "w", "n", "at", "component", "deviation")]).repartition(3)


def test_rows_against_plain_algebra(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 7)) * [3, 2.5, 2, 1.5, 1, 0.5, 0.1]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(100 + i, rows[0][1]) for i in range(80)]  # copies, more than half of all rows
    rows += [(200, None), (201, [None] + rows[0][1][1:]), (202, [float("nan")] + rows[0][1][1:]), (203, [float("inf")] + rows[0][1][1:]), (204, []), (205, [1.5, -2.0]), (206, [-0.0] * 7)]
    check(W.whitened_components(frame(spark, rows)).collect(), rows)


def test_null_and_repeated_ids_give_rows(spark):
    rows = [(None, [1.0, 2.0]), (None, [3.0, 1.0]), (4, [3.0, 1.0]), (4, [3.0, 1.0]), (5, [0.0, 7.0])]
    found = W.whitened_components(frame(spark, rows)).collect()
    assert len(found) == 10 and sum(r.vec_id is None for r in found) == 4


def test_equal_vectors_empty_ones_and_no_rows(spark):
    same = check(W.whitened_components(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect(), [(i, [1.0, 2.0]) for i in range(5)])
    assert all(r.whitened is None and r.explained is None and r.deviation == 0 for r in same.values())
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    assert sum(r.whitened is None for r in check(W.whitened_components(frame(spark, line)).collect(), line).values()) == 10
    for rows in ([], [(1, None)], [(1, []), (2, [])]):
        out = W.whitened_components(frame(spark, rows))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries(spark):
    """A deviation beyond a long is null; an entry that has no place on the grid leaves its row out."""
    rows = [(1, [3e10, 1.0]), (2, [-2e9, 2.0]), (3, [5.0, 2.0]), (4, [1e30, 0.0])]
    found = {(r.vec_id, r.component): r for r in W.whitened_components(frame(spark, rows)).collect()}
    assert set(found) == {(i, c) for i in (1, 2, 3) for c in (1, 2)} and all(r.deviation is None for r in found.values())
    assert all(abs(found[i, 1].whitened) > 0.1 for i in (1, 2, 3)) and found[1, 1].identity_error < 1e-4


def test_op12_over_the_smallest_table(spark, sf):
    found = W.op12_whitening(spark, sf).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(found, rows)
