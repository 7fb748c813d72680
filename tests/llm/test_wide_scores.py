"""Bit-sliced search over components of any 64-bit size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.llm import bitslice


def searched(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in bitslice.top_k(df, F.col("vec_id") % 5 == 0, k).collect()}


def brute(rows, k=5):
    q = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    want = {}
    for i in q:
        if i % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q[i], v)), j) for j, v in q.items() if j != i)
            want |= {(i, rank): (j, -score) for rank, (score, j) in enumerate(scores[:k], 1)}
    return want


def test_components_above_two_to_the_twenty(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 4)) * 10.0 ** rng.integers(0, 8, (60, 4))
    x[:, 3] = 0
    x[0], x[1], x[2], x[3] = [1, 0, 0, 0], [1e13, 0, 1, 0], [5e12, 0, 1, 0], [-1e15, 0, 0, 0]
    for i in range(5, 60, 5):
        x[i, 0] = rng.integers(-3, 4) / 64
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    for block in (bitslice.BLOCK, 16):
        monkeypatch.setattr(bitslice, "BLOCK", block)
        assert searched(spark, rows) == brute(rows)


def test_sums_above_64_bits_are_exact_or_raise(spark, monkeypatch):
    # the products with ids 1 and 3 lie far below the 64-bit integers and are not among the highest
    rows = [(0, [1e17, 1.0]), (1, [-1.0, 2.0]), (2, [0.0, 2.0]), (3, [-1e17, 0.0]), (4, [0.0, 1.0])]
    assert searched(spark, rows, 2) == brute(rows, 2)
    monkeypatch.setattr(bitslice, "BLOCK", 1)
    assert searched(spark, rows, 2) == brute(rows, 2)
    with pytest.raises(Exception, match="beyond 64 bits"):
        searched(spark, rows, 4)
    with pytest.raises(Exception, match="beyond 64 bits"):
        searched(spark, [(0, [1e17]), (1, [1e17])], 1)
    with pytest.raises(Exception, match="beyond 64 bits"):
        searched(spark, [(0, [1.0]), (1, [1e18])], 1)


def test_slices_of_the_whole_range():
    x = np.array([[-(1 << 63), 5], [(1 << 63) - 1, 5], [0, 5]])
    low, slices = bitslice.slices_of(x)
    for q in ([3, 0], [-(1 << 63), 1], [(1 << 62) + 1, -2]):
        constant, scores = bitslice.score_slices(np.array(q), low, slices, 1)
        got = [constant + sum(int(s[0] >> np.uint64(i) & np.uint64(1)) << w for w, s in enumerate(scores)) for i in range(3)]
        assert got == [q[0] * int(a) + q[1] * int(b) for a, b in x]
