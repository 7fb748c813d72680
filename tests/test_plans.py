"""Ordered rows and skewed joins against pandas, with a key that holds half of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tableloom.operators import series
from tableloom.plans import scratch
from tableloom.plans.ordered import OrderedRows
from tableloom.plans.placement import partition_count, well_spread
from tableloom.plans.skew import grid_join, heavy_hitters, join_small, outer_join, skew_join


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 600
    key = np.where(rng.random(n) < 0.5, "hot", np.array([f"k{i}" for i in rng.integers(0, 40, n)]))
    frame = pd.DataFrame({"id": rng.permutation(n), "key": key, "x": rng.integers(-50, 50, n)})
    frame["maybe"] = np.where(rng.random(n) < 0.2, frame["x"].astype(float), np.nan)
    return frame


def table(spark, rows):
    df = spark.createDataFrame(rows[["id", "key", "x"]])
    extra = [(int(i), None if np.isnan(m) else int(m)) for i, m in zip(rows["id"], rows["maybe"])]
    return df.join(spark.createDataFrame(extra, "id bigint, maybe bigint"), "id")


def test_ordered_rows_match_pandas(spark, rows, partitions):
    df = table(spark, rows)
    want = rows.sort_values(["key", "id"]).reset_index(drop=True)
    by = want.groupby("key")
    want["rn"] = by.cumcount() + 1
    want["before"] = by["x"].shift()
    want["after"] = by["x"].shift(-1)
    want["total"] = by["x"].cumsum()
    want["held"] = by["maybe"].ffill()
    ordered = OrderedRows(df, ["key"], ["id"])
    assert ordered.total == len(rows)

    def column(frame, name):
        return frame.select("id", name).toPandas().set_index("id")[name].reindex(want["id"]).to_numpy(dtype=float)

    for frame, name, source in (
        (ordered.numbered("rn"), "rn", "rn"),
        (ordered.with_previous(before="x"), "before", "before"),
        (ordered.with_next(after="x"), "after", "after"),
        (ordered.running_sum("x", "total"), "total", "total"),
        (ordered.filled("maybe", "held"), "held", "held"),
    ):
        np.testing.assert_array_equal(column(frame, name), want[source].to_numpy(dtype=float), err_msg=name)


def test_global_order_without_keys(spark, rows, partitions):
    got = OrderedRows(table(spark, rows), (), [F.desc("x"), "id"]).numbered("rn").toPandas().set_index("id")["rn"]
    want = rows.sort_values(["x", "id"], ascending=[False, True]).reset_index(drop=True)
    assert [got[i] for i in want["id"]] == list(range(1, len(rows) + 1))


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id bigint, key string")
    got = {r["id"]: r["rn"] for r in OrderedRows(df, ["key"], ["id"]).numbered().collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_moving_value_crosses_blocks(spark, rows, partitions, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_BITS", 4)
    df = table(spark, rows).withColumn("v", F.col("x").cast("double"))
    got = series.moving_value(df, ["key"], ["id"], "v", 0.1).toPandas().set_index("id")["moving"]
    for _, group in rows.sort_values("id").groupby("key"):
        m = None
        for i, x in zip(group["id"], group["x"]):
            m = float(x) if m is None else 0.9 * m + 0.1 * x
            assert got[i] == pytest.approx(m, abs=1e-9)


@pytest.fixture(scope="module")
def sides(spark):
    left = [("hot", i) for i in range(60)] + [("both", i) for i in range(30)] + [(f"l{i}", i) for i in range(30)] + [(None, 1)]
    right = [("warm", i) for i in range(40)] + [("both", i) for i in range(20)] + [("hot", 1), ("l3", 5), (None, 2)]
    return (
        left, right, spark.createDataFrame(left, "k string, a bigint"), spark.createDataFrame(right, "k string, b bigint"),
    )


def expected(left, right, how):
    out = [(k, a, b) for k, a in left for j, b in right if k is not None and k == j]
    if how in ("left", "full"):
        out += [(k, a, None) for k, a in left if k is None or k not in {j for j, _ in right}]
    if how in ("right", "full"):
        out += [(k, None, b) for k, b in right if k is None or k not in {j for j, _ in left}]
    return sorted(out, key=repr)


def got_rows(df):
    return sorted(((r["k"], r["a"], r["b"]) for r in df.select("k", "a", "b").collect()), key=repr)


def test_skewed_joins(sides):
    left, right, a, b = sides
    names = {r["h"]: r["k"] for r in a.select("k", F.xxhash64("k").alias("h")).collect()}
    hot, total = heavy_hitters(a, F.xxhash64("k"), 0.2)
    assert {names[h]: n for h, n in hot.items()} == {"hot": 60, "both": 30} and total == len(left)
    for how in ("inner", "left"):
        assert got_rows(skew_join(a, b, ["k"], how, share=0.1, salts=4)) == expected(left, right, how)
    assert got_rows(grid_join(a, b, ["k"], share=0.1, salts=3)) == expected(left, right, "inner")
    for how in ("left", "right", "full"):
        assert got_rows(outer_join(a, b, ["k"], how)) == expected(left, right, how)
    kept = skew_join(a, b, ["k"], "left_semi", share=0.1, salts=4).collect()
    gone = skew_join(a, b, ["k"], "left_anti", share=0.1, salts=4).collect()
    assert len(kept) == 91 and len(kept) + len(gone) == len(left)


def test_salts_follow_the_rows(sides):
    left, right, a, b = sides
    assert got_rows(grid_join(a, b, ["k"], share=0.05)) == expected(left, right, "inner")
    assert got_rows(skew_join(a, b, ["k"], "left", share=0.05)) == expected(left, right, "left")
    # keys of different types hash alike
    number = F.when(F.col("k") == "hot", 1).when(F.col("k") == "both", 2).when(F.col("k") == "warm", 3)
    c, d = a.withColumn("k", number.cast("int")), b.withColumn("k", number.cast("bigint"))
    want = sorted(((1 if k == "hot" else 2, x, y) for k, x, y in expected(left, right, "inner") if k in ("hot", "both")), key=repr)
    assert got_rows(grid_join(c, d, ["k"], share=0.05)) == want == got_rows(grid_join(d.withColumnRenamed("b", "a"), c.withColumnRenamed("a", "b"), ["k"], share=0.05).select("k", F.col("b").alias("a"), F.col("a").alias("b")))


def test_sides_are_read_twice_at_most(spark, tmp_path):
    path = str(tmp_path / "side")
    spark.range(1000).selectExpr("id % 7 AS k", "id AS a", "repeat('x', 20) AS wide").write.parquet(path)
    side = spark.read.parquet(path)
    joined = grid_join(side, side.select("k", F.col("a").alias("b")), ["k"], share=0.05)
    assert plan_of(joined.select("k", "a", "b")).count("FileScan") <= 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_bound(spark):
    left, right = spark.range(100), spark.range(50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(join_small(left, right, ["id"], max_rows=50))
        assert "BroadcastHashJoin" not in plan_of(join_small(left, right, ["id"], max_rows=49))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_well_spread_leaves_large_scans_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert partition_count(well_spread(spark.range(10).coalesce(1))) == cores
    wide = spark.range(0, 1000, 1, 5 * cores)
    assert partition_count(well_spread(wide, per_core=100)) == 5 * cores


def test_a_hot_key_is_spread_over_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("key"))
        rows = OrderedRows(df, ["key"], ["id"]).rows
        sizes = [r["count"] for r in rows.where("key = 'hot'").groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) >= 3 and max(sizes) < 10_000


def test_temporary_tables_go_and_kept_ones_stay(spark):
    with scratch.temporary(spark) as kept:
        gone, stays = scratch.materialize(spark.range(3)), scratch.materialize(spark.range(4))
        kept.append(stays)
    assert stays.count() == 4
    with pytest.raises(Exception):
        spark.read.parquet(gone._scratch).count()
    scratch.discard(stays)
    scratch.discard(spark.range(1))  # not ours: nothing happens
    with pytest.raises(Exception):
        spark.read.parquet(stays._scratch).count()


def test_scratch_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    stored = scratch.materialize(spark.range(5))
    assert stored.count() == 5
    files = stored.inputFiles()
    assert files and all(scratch.scratch_root(spark) in f for f in files)
    if named:
        assert scratch.scratch_root(spark) == named.rstrip("/")


def test_scratch_refuses_a_local_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session())
