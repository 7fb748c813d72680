"""Worked examples of the keyed operators."""

import random

import pytest
from pyspark.sql import functions as F

from tableloom.operators import keyed, series


def pairs(spark, rows, schema="k string, v bigint"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def animals(spark):
    return pairs(spark, [("panda", 0), ("pink", 3), ("pirate", 3), ("panda", 1), ("pink", 4)])


def test_sum_and_count_by_key(animals):
    acc = keyed.combine_by_key(
        animals, "k", "v", lambda v: (v, 1), lambda a, v: (a[0] + v, a[1] + 1), lambda a, b: (a[0] + b[0], a[1] + b[1]), 2
    )
    got = {r["k"]: tuple(r["acc"]) for r in acc.collect()}
    assert got == {"panda": (1, 2), "pink": (7, 2), "pirate": (3, 1)}
    means = {r["k"]: r["v"] for r in keyed.reduce_by_key(animals, "k", "v", F.avg).collect()}
    assert means == {"panda": 0.5, "pink": 3.5, "pirate": 3.0}


def test_combine_by_key_flushes_and_merges(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(5)
    acc = keyed.combine_by_key(
        df, "k", "v", lambda v: (v,), lambda a, v: (a[0] + v,), lambda a, b: (a[0] + b[0],), 1, flush=2
    )
    assert {r["k"]: r["acc"][0] for r in acc.collect()} == {k: sum(range(k, 1000, 7)) for k in range(7)}


def test_reduce_fold_aggregate(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "v")
    assert keyed.reduce_by_key(df.withColumn("k", F.lit(1)), "k", "v").first()["v"] == 55
    assert keyed.fold(df.where("v > 100"), "v", 0).first()["v"] == 0
    row = spark.range(1, 5).agg(F.sum("id"), F.count("id"), F.avg("id")).first()
    assert tuple(row) == (10, 4, 2.5)


def test_joins(spark):
    a = pairs(spark, [("foo", 1), ("kaka", 2), ("baz", 3), ("bar", 8)], "k string, a bigint")
    b = pairs(spark, [("foo", 4), ("bar", 5), ("bar", 6), ("Colin", 7)], "k string, b bigint")
    rows = lambda df: {(r["k"], r["a"], r["b"]) for r in df.collect()}
    both = {("foo", 1, 4), ("bar", 8, 5), ("bar", 8, 6)}
    assert rows(keyed.inner(a, b, ["k"])) == both
    assert rows(keyed.left_outer(a, b, ["k"])) == both | {("kaka", 2, None), ("baz", 3, None)}
    assert rows(keyed.right_outer(a, b, ["k"])) == both | {("Colin", None, 7)}
    assert keyed.right_outer(a, b, ["k"]).columns == ["k", "a", "b"]


def test_group_values_keeps_everything_in_bounded_lists(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"), F.col("id").alias("v"))
    lists = keyed.group_values(df, "k", "v", chunk=50).collect()
    assert max(len(r["items"]) for r in lists) == 50
    for key in ("hot", "cold"):
        whole = [v for r in sorted((r for r in lists if r["k"] == key), key=lambda r: r["chunk"]) for v in r["items"]]
        assert whole == [i for i in range(500) if (i % 3 > 0) == (key == "hot")]


def test_cogroup(spark):
    a = pairs(spark, [("x", 1), ("x", 2), ("y", 3)], "k string, a bigint")
    b = pairs(spark, [("x", 9), ("z", 8)], "k string, b bigint")
    got = {r["k"]: (r["left_items"], r["right_items"]) for r in keyed.cogroup(a, b, "k", "a", "b").collect()}
    assert got == {"x": ([1, 2], [9]), "y": ([3], None), "z": (None, [8])}


def test_product_needs_a_bounded_side(spark):
    a, b = spark.range(3), spark.range(2).withColumnRenamed("id", "b")
    assert keyed.product_with_bounded(a, b).count() == 6
    with pytest.raises(ValueError):
        keyed.product_with_bounded(a, b, max_rows=1)


def test_as_map_last_value_wins(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5)], "k string, at bigint, v bigint")
    assert keyed.as_map(df, "k", "v", ["at"]) == {"a": 20, "b": 5}
    with pytest.raises(ValueError):
        keyed.as_map(df, "k", "v", ["at"], max_keys=1)


def test_sets(spark):
    a = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 7, 7)], "v bigint")
    b = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 5, 6)], "v bigint")
    values = lambda df: sorted(r["v"] for r in df.collect())
    assert values(keyed.union_all(a, b)) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 6, 7, 7]
    assert values(keyed.intersection(a, b)) == [1, 2, 3, 4]
    assert values(keyed.minus_all(a, b)) == [7, 7]
    assert values(keyed.symmetric_difference(a, b)) == [5, 6, 7]
    assert tuple(keyed.set_relations(b.where("v < 3"), b).first()) == (True, False, False)
    assert tuple(keyed.set_relations(b, b).first()) == (True, True, True)
    with pytest.raises(TypeError):
        keyed.union_all(a, a.select(F.col("v").cast("int")))


def test_sets_treat_null_as_a_value(spark):
    a = spark.createDataFrame([(1,), (None,)], "v bigint")
    b = spark.createDataFrame([(None,), (2,)], "v bigint")
    assert [r["v"] for r in keyed.minus_all(a, b).collect()] == [1]
    assert {r["v"] for r in keyed.symmetric_difference(a, b).collect()} == {1, 2}


def test_runs_are_not_global_groups(spark):
    names = ["Alan", "Adam", "Wes", "Will", "Albert", "Steven"]
    df = spark.createDataFrame([(0, i, n[0]) for i, n in enumerate(names)], "g int, i bigint, letter string")
    runs = keyed.consecutive_runs(df, ["g"], ["i"], "letter").orderBy("run_no").collect()
    assert [(r["letter"], r["n"]) for r in runs] == [("A", 2), ("W", 2), ("A", 1), ("S", 1)]


def test_seen_before(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 6, 1, 5, 1, 6, 3, 5])], "i bigint, v bigint")
    flags = keyed.seen_before(df, ["v"], ["i"]).orderBy("i").collect()
    assert [r["seen"] for r in flags] == [False, False, False, True, True, True, False, True]


def test_insertion_points_are_right_biased(spark):
    points = spark.createDataFrame([(0, 0.5), (1, 2.0), (2, 2.5), (3, 9.0)], "id bigint, x double")
    values = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,)], "v double")
    got = keyed.insertion_points(points, "x", values, "v").orderBy("id").collect()
    assert [r["position"] for r in got] == [0, 3, 3, 4]


def test_zip_stops_at_the_shorter(spark):
    a = spark.createDataFrame([("foo",), ("bar",), ("baz",)], "a string")
    b = spark.createDataFrame([(1,), (2,)], "b bigint")
    got = keyed.zip_rows(a, ["a"], b, ["b"]).orderBy("pos").collect()
    assert [(r["a"], r["b"]) for r in got] == [("bar", 1), ("baz", 2)]


def test_pipe_and_packed(spark):
    df = spark.createDataFrame([("ab",), ("cd",)], "w string")
    assert sorted(r["line"] for r in keyed.pipe_lines(df, F.col("w"), "tr a-z A-Z").collect()) == ["AB", "CD"]
    packed = keyed.packed(spark.range(5), ["id"], "id", 2).orderBy("chunk").collect()
    assert [r["items"] for r in packed] == [[0, 1], [2, 3], [4]]


def test_observed_counts_on_the_way(spark):
    lines = spark.createDataFrame([("",), ("a",), ("",)], "line string")
    assert keyed.observed(lines, blank=F.count(F.when(F.col("line") == "", 1)), n=F.count("*")) == {"blank": 2, "n": 3}


def test_combined_keys_of_any_kind(spark):
    nan = float("nan")
    total = lambda df, **k: {
        str(r["k"]): tuple(r["acc"]) for r in keyed.combine_by_key(
            df, "k", "v", lambda v: (v, 1), lambda a, v: (a[0] + v, a[1] + 1), lambda a, b: (a[0] + b[0], a[1] + b[1]), 2, **k
        ).collect()
    }
    rows = [(k, float(i)) for i in range(60) for k in ("a", None, "", "b")]
    texts = spark.createDataFrame(rows, "k string, v double").repartition(5)
    assert total(texts) == total(texts, flush=1) == {k: (1770.0, 60.0) for k in ("a", "None", "", "b")}
    floats = spark.createDataFrame([(k, 1.0) for k in (nan, nan, 0.0, None, 2.5)], "k double, v double").repartition(3)
    assert total(floats) == {"nan": (2.0, 2.0), "0.0": (1.0, 1.0), "None": (1.0, 1.0), "2.5": (1.0, 1.0)}
    pairs = spark.createDataFrame([((1, "x"), 1.0), ((1, "x"), 2.0), ((2, None), 4.0)], "k struct<a:bigint,b:string>, v double").repartition(3)
    assert sorted(total(pairs).values()) == [(3.0, 2.0), (4.0, 1.0)]
    assert total(texts.where("false")) == {}


def test_sort_into_partitions(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("id"), F.lit(1).alias("sort_key")).repartition(3)
    key = F.col("id").cast("string")
    laid = keyed.sort_by_key(df, key, 6)
    assert laid.columns == df.columns and laid.rdd.getNumPartitions() == 6
    assert keyed.layout_of(laid, key).first().asDict() == {"partitions": 6, "inside": True, "across": True, "n": 500}
    mixed = keyed.layout_of(laid, F.col("id")).first()
    assert not mixed["inside"] and keyed.layout_of(df.where("false"), key).first()["partitions"] == 0


def test_prefix_of_maps(spark, monkeypatch):
    monkeypatch.setattr(series, "GROUP", 5)
    rng = random.Random(3)
    maps = [(i, rng.choice([0.0, 0.5, 0.9]), rng.random()) for i in range(33)]
    value, want = 0.0, {}
    for at, a, b in maps:
        want[at], value = value, a * value + b
    got = {r.at: r.v for r in series.entering(spark.createDataFrame(maps, "at int, a double, b double")).collect()}
    assert got == pytest.approx(want)


def test_smoothing_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_BITS", 2)
    monkeypatch.setattr(series, "GROUP", 4)
    rng = random.Random(4)
    rows = [(k, i, rng.random()) for k, n in (("a", 70), (None, 9), ("c", 1), ("d", 25)) for i in range(n)]
    got = series.moving_value(spark.createDataFrame(rows, "k string, i int, x double").repartition(3), ["k"], ["i"], "x", 0.3)
    want, held = {}, {}
    for k, i, x in rows:
        held[k] = x if i == 0 else 0.7 * held[k] + 0.3 * x
        want[(k, i)] = held[k]
    assert {(r.k, r.i): r.moving for r in got.collect()} == pytest.approx(want)
