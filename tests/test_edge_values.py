"""Values that are easily got wrong: NULL keys, NULL scores, large and negative numbers."""

import pytest
from pyspark.sql import functions as F

from tableloom.functions import scalars, text
from tableloom.functions.draws import draw, draw_unit
from tableloom.operators import bayes, evolve, keyed
from tableloom.operators.sampling import split_exact
from tableloom.operators.series import moving_value
from tableloom.operators.tensor import _unflat
from tableloom.plans.scratch import scratch_path
from tableloom.streaming import packets


def test_floor_division(spark):
    pairs = [(9007199254740993, 1), (7, -2), (-7, 2), (-7, -2), (7, 2), (-8, 2), (8, -2), (0, -3), (-(2**62), 3), (None, 2)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [r[0] for r in df.select(scalars.floor_divide(F.col("a"), F.col("b"))).collect()]
    assert got == [None if a is None else a // b for a, b in pairs]
    q, r = scalars.divmod_columns(F.col("a"), -2)
    assert [tuple(x) for x in df.where("a is not null").select(q, r).collect()] == [divmod(a, -2) for a, _ in pairs if a is not None]


def test_unflat_beyond_doubles(spark):
    shape = (3, 2**30 + 1, 2**25 + 3)
    at = (2, 2**30 - 5, 2**25 + 1)
    flat = (at[0] * shape[1] + at[1]) * shape[2] + at[2]
    df = spark.createDataFrame([(flat,)], "f bigint")
    assert tuple(df.select(*_unflat(F.col("f"), shape)).first()) == at


def test_last_number_is_large(spark):
    df = spark.createDataFrame([("a 4294967296 b",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(text.last_number(F.col("t"))).collect()] == [4294967296, None, None]


def test_moving_value_over_null_key(spark):
    df = spark.createDataFrame([(None, 1, 10.0), (None, 2, 0.0), ("a", 1, 4.0), ("a", 2, 8.0)], "k string, o int, v double")
    got = {(r.k, r.o): r.moving for r in moving_value(df, ["k"], ["o"], "v", 0.5).collect()}
    assert got == {(None, 1): 10.0, (None, 2): 5.0, ("a", 1): 4.0, ("a", 2): 6.0}


def test_null_never_wins(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0), ("b", 3, None)], "k string, i int, v double")
    assert {r.k: (r.i, r.v) for r in keyed.best_by_key(df, "k", "v", "i").collect()} == {"a": (2, 5.0), "b": (3, None)}
    people = spark.createDataFrame([(1, 1, [0], None), (1, 2, [1], 0.5)], "deme int, ind_id int, genes array<int>, fitness double")
    assert evolve.best(people).first().ind_id == 2
    scores = spark.createDataFrame([(1, 0, None), (1, 1, -3.0)], "doc_id int, label int, score double")
    assert bayes.best_class(scores).first().predicted == 1


def test_cogroup_null_key(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, w int")
    got = {r.k: (r.left_items, r.right_items) for r in keyed.cogroup(a, b, "k", "v", "w").collect()}
    assert got == {None: ([1], [3]), "x": ([2], None), "y": (None, [4])}


def test_pipe_refuses_line_ends(spark):
    with pytest.raises(Exception, match="line end"):
        keyed.pipe_lines(spark.createDataFrame([("a\nb",)], "t string"), F.col("t"), "cat").collect()
    assert [r[0] for r in keyed.pipe_lines(spark.createDataFrame([("a b",)], "t string"), F.col("t"), "cat").collect()] == ["a b"]


def test_draws_are_wide(spark):
    rows = spark.range(2000).select(draw(1, F.col("id")).alias("d"), draw_unit(1, F.col("id")).alias("u")).collect()
    assert max(r.d for r in rows) > 2**59 and all(0 <= r.d < 2**60 and 0 <= r.u < 1 for r in rows)
    assert abs(sum(r.u for r in rows) / 2000 - 0.5) < 0.03


def test_exact_split_takes_the_smallest_draws(spark):
    df = spark.range(500)
    marked = split_exact(df, "id", 0.37, seed=5).collect()
    order = {r.id: r.d for r in df.select("id", draw(5, "split", F.col("id")).alias("d")).collect()}
    taken = sorted(r.id for r in marked if r.is_train)
    assert taken == sorted(sorted(order, key=lambda i: (order[i], i))[:185])


def test_stream_counts_every_file(spark):
    inbox, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    spark.range(400).select(F.col("id"), (F.col("id") % 3).cast("string").alias("kind")).repartition(12).write.parquet(inbox)
    arriving = packets.packet_stream(spark, inbox, "id bigint, kind string", files_per_trigger=1)
    last = packets.count_until_done(packets.running_frequency(arriving, F.col("kind")), scratch_path(spark, "ck"), out)
    assert sum(r.cnt for r in spark.read.parquet(last).collect()) == 400


def test_tucker_with_wide_ranks(spark, monkeypatch):
    import numpy as np

    from tableloom.operators import tensor as tn

    rng = np.random.default_rng(2)
    x = rng.normal(size=(7, 6, 3))
    cells = spark.createDataFrame([(*map(int, at), float(v)) for at, v in np.ndenumerate(x)], "i0 bigint, i1 bigint, i2 bigint, value double")
    # the last mode has 3 rows, and 42 rank combinations of the others
    monkeypatch.setattr(tn, "SOLVE_LIMIT", 20)
    monkeypatch.setattr(tn, "WIDE", 10)
    found = tn.tucker(tn.Tensor(cells, x.shape), x.shape, sweeps=2)
    again = {(r.i0, r.i1, r.i2): r.value for r in tn.tucker_to_tensor(found.core, found.factors, x.shape).cells.collect()}
    assert all(abs(again[at] - v) < 1e-8 for at, v in np.ndenumerate(x))
