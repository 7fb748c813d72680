"""The pipeline's rows against its four stages written plainly in Python."""

import plain
from pyspark.sql import functions as F

import corpus_pipeline


def test_pipeline_against_plain_stages(spark, tmp_path):
    rows = plain.corpus()
    plain.write(tmp_path, rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    sizes = [len(rows)]
    for (name, stage), step in zip(corpus_pipeline.STAGES, (plain.accepted, plain.one_of_each, plain.without_repeats)):
        before, rows = rows, step(rows)
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        want = sorted((i, str(t), given[i].lang, given[i].source, len(t or "")) for i, t, _ in rows)
        assert sorted((r.doc_id, str(r.text), r.lang, r.source, r.n_chars) for r in docs.collect()) == want, name
        assert rows != before, f"{name} has nothing to do"
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    plain.check_packed(corpus_pipeline.run(spark, str(tmp_path)).collect(), rows)


def test_pipeline_on_odd_tables(spark, tmp_path):
    rows = plain.corpus()
    plain.write(tmp_path, rows)
    whole = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("key", F.lit(1)).withColumn("own_key", F.col("doc_id"))
    odd = whole.unionByName(whole.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    for given, empty in ((whole.where("false"), True), (odd, False)):
        docs = spark.createDataFrame(given.collect(), given.schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
            assert docs.columns == given.columns and docs.isEmpty() == empty, name
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert pieces.isEmpty() == empty
        assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
