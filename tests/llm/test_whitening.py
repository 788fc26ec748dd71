import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.whitening import Centre, solve_upper, whiten


def brute(vectors, k=4):
    """Centred covariance and eigh over the distinct vectors, deviations in Python integers."""
    x = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    a = np.array([[float(v[j]) - s[j] / n for j in range(d)] for v in fit])
    e, w = np.linalg.eigh(a.T @ a / n)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    dev = [sum((n * v[j] - s[j]) ** 2 for j in range(d)) for v in x]
    y = (np.array(x, float) - np.array(s) / n) @ w / np.sqrt(e)
    return n, dev, y, e / np.trace(a.T @ a / n), w


def check(out, vectors, ids, k=4):
    n, dev, y, explained, _ = brute(vectors, k)
    got = {(r.vec_id, r.component): r for r in out}
    assert len(got) == len(out) == len(vectors) * k
    for c in range(k):
        mine = np.array([got[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ y[:, c])
        assert np.abs(mine - sign * y[:, c]).max() < 1e-8 * max(1, np.abs(y[:, c]).max())
    for i, v in zip(ids, dev):
        r = got[i, 1]
        assert (r.n, r.deviation) == (n, v) and r.identity_error < 1e-9
    assert [got[ids[0], c + 1].explained for c in range(k)] == pytest.approx(list(explained), rel=1e-9)


def test_table_equals_eigenvectors(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = t.collect()
    out = whiten(t.withColumn("x", F.lit("clash")).withColumn("key", F.lit("clash")).repartition(3)).collect()
    check(out, [r.embedding for r in rows], [r.vec_id for r in rows])


def test_nulls_copies_lengths_and_constant_dimensions(spark):
    rng = random.Random(3)
    good = [[rng.gauss(0, 1) * 10 ** (i % 3) for i in range(6)] + [2.5] for _ in range(40)]
    good += [good[0]] * 30  # copies count once in the fit list
    bad = [None, [], [1.0] * 3, [float("nan")] + [1.0] * 6, [float("-inf")] + [1.0] * 6, [None] + [1.0] * 6]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(good + bad)], "vec_id long, embedding array<double>")
    good32 = [[float(c) for c in v] for v in good]
    out = whiten(df).collect()
    x = {tuple(math.floor(256 * c) for c in v) for v in good32}
    assert {r.vec_id for r in out} == set(range(len(good))) and {r.n for r in out} == {len(x)} == {40}
    assert {r.component for r in out} == {1, 2, 3, 4} and max(r.identity_error for r in out) < 1e-9
    again = whiten(df.unionByName(df)).collect()
    assert len(again) == 2 * len(out)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten_gives_no_rows(spark, rows):
    assert whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_dependent_and_badly_scaled_dimensions(spark):
    """Rank 3 in 6 dimensions, one of them 10^6 times the others, far from the origin."""
    rng = random.Random(9)
    rows = []
    for i in range(200):
        a, b, c = rng.randrange(-500, 500), rng.randrange(-500, 500), rng.randrange(-9, 9)
        rows.append((i, [float(v) + 2.0**40 for v in (a * 10**6, b, c, a * 10**6, b + c, b)]))
    out = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    # two of the three directions are 10^-12 of the first in variance, and still found
    assert sorted({r.component for r in out}) in ([1, 2], [1, 2, 3]) and max(r.identity_error for r in out) < 1e-4
    first = {r.vec_id: r.whitened for r in out if r.component == 1}
    a = np.array([r[1][0] - 2.0**40 for r in rows])
    want = (a - a.mean()) / a.std()
    got = np.array([first[i] for i in range(200)])
    assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6


def test_parts():
    rng = np.random.default_rng(1)
    r = np.triu(rng.normal(size=(5, 5))) + 5 * np.eye(5)
    a = rng.normal(size=(7, 5))
    assert np.allclose(solve_upper(a, r) @ r, a)
    big = Centre(3, [10**15, -7])
    x = np.array([[10**15, 2], [3, 3], [2**62, 0], [1_012_500_000, 0]], np.int64)
    want = [sum((3 * v - s) ** 2 for v, s in zip(row, big.sums)) for row in x.tolist()]
    assert big.deviations(x) == [v if v < 2**63 else None for v in want]
    assert np.allclose(Centre(4, [2**60 * 4 + 2]).rows(np.array([[2**60 + 1]])), [[0.5]])
