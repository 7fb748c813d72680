"""What grows with the tables: work spread over the cores, memory of a task, bytes moved."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tableloom.operators import bayes as nb
from tableloom.plans.placement import by_key, stored_bytes
from tableloom.plans.scratch import materialize
from tableloom.plans.skew import weighted_join
from tableloom.registry import QUERIES, load_all

load_all()


def test_array_creation_is_spread_and_right(spark, tmp_path):
    parts = [(i, n) for i, n in enumerate([1, 2, 7, 50, 0, -1, -2, None])]
    spark.createDataFrame(parts, "p_partkey bigint, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    df = QUERIES["f23_array_creation"](spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism  # one file, one split
    got = {r.p_partkey: r for r in df.collect()}
    show = lambda xs: ",".join(map(str, xs))
    for key, n in parts[:4]:
        r = got[key]
        assert r.diagonal == show(i * (n + 1) for i in range(n))
        assert (r.zeros, r.ones, r.counted) == (show([0] * n), show([1] * n), show(range(n)))
        assert r.trace == n and r.cast_up == show(float(i) for i in range(n))
    assert [got[k].diagonal for k in (4, 5, 6, 7)] == ["", "0", "0", None]


def test_count_and_distance_spreads_genes_and_broadcasts_none(spark, tmp_path, capsys):
    rows = [(k, k % 3) for k in range(40)] + [(7, 1), (None, 2), (8, None)]
    spark.createDataFrame(rows, "c_custkey bigint, c_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    from tableloom.operators import evolve as ev

    ids = spark.read.parquet(f"{tmp_path}/customer.parquet").selectExpr("c_nationkey AS deme", "c_custkey AS ind_id")
    assert ev.random_population(ids, 24, 64).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    df = QUERIES["e5_count_and_distance"](spark, str(tmp_path))
    df.explain()
    assert "Broadcast" not in capsys.readouterr().out
    got = df.collect()
    # a repeated individual meets each of its copies, one without a full key none
    assert len(got) == 40 - 1 + 4 and all(-24 * 255 <= r.closeness <= 0 <= r.ones <= 24 for r in got)


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_counts_of_a_document_move_only_its_text(spark, tmp_path, capsys):
    rows = [(i % 5 if i % 7 else None, f"w{i % 4} a-b  w{i}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = nb.token_counts(docs)
    assert _plan(counts, capsys).count("Exchange") == 1
    want = {}
    for doc, text in rows:
        for pos, token in enumerate(re.sub(r"([-])", r" \1 ", text).split(" ")):
            n, first = want.get((doc, token), (0, pos))
            want[doc, token] = (n + 1, min(first, pos))
    got = {(r.doc_id, r.token): (r.cnt, r["first"]) for r in counts.collect()}
    assert got == want and counts.count() == len(want)


def test_partitions_by_key_follow_the_bytes_read(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "md5(CAST(id AS string)) AS text").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    size = stored_bytes(df)
    assert by_key(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert by_key(df, "id", per_task=size // 20).rdd.getNumPartitions() in (20, 21)
    # a join does not multiply the size, and a table of unknown size is dealt as Spark deals it
    assert stored_bytes(df.join(df.select("id"), "id")) == 2 * size
    assert stored_bytes(spark.createDataFrame([(1,)], "id int").rdd.toDF()) in (None, stored_bytes(spark.createDataFrame([(1,)], "id int")))


@pytest.mark.parametrize("most", [0, 3, 20, 10_000])
def test_weighted_join_gives_the_rows_of_a_join(spark, most, capsys):
    left = spark.createDataFrame([(f"t{i % (i // 9 + 1)}" if i % 11 else None, i) for i in range(200)], "token string, n int")
    sizes = left.groupBy("token").count().where("token IS NOT NULL AND token <> 't5'")
    right = sizes.selectExpr("token", "CAST(substr(token, 2) AS int) AS idx", "count AS w").unionByName(
        spark.createDataFrame([("absent", 99, 0), (None, 98, 1)], "token string, idx int, w bigint")
    )
    got = weighted_join(left, right, "token", "w", max_rows=most)
    assert got.columns == ["token", "n", "idx"]
    assert sorted(got.collect()) == sorted(left.join(right.drop("w"), "token").collect())


def test_vectors_move_no_pair_of_a_frequent_word(spark, tmp_path, capsys):
    docs = spark.createDataFrame([(i, f"the of w{i}") for i in range(20)], "doc_id bigint, text string")
    counts = materialize(nb.token_counts(docs))
    vectors = nb.count_vectors(counts, nb.vocabulary(counts))
    plan = _plan(vectors, capsys)
    assert "SortMergeJoin" not in plan and "hashpartitioning(token" not in plan
    assert vectors.count() == 60


def test_holdout_counts_where_the_texts_lie(spark, tmp_path, capsys):
    spark.createDataFrame([(i, "a b") for i in range(20)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    marked = spark.createDataFrame([(i, i % 2, i % 3 > 0) for i in range(20)], "doc_id bigint, label int, is_train boolean")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with texts too large to broadcast
    try:
        plan = _plan(nb.token_counts(nb.labelled_texts(docs, marked), placed=True), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 2 and not re.search(r"hashpartitioning\([^)]*token", plan)
    assert nb.holdout_text(docs, marked).count() == sum(i % 3 == 0 for i in range(20))
