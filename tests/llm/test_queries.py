"""The registered queries of the operators against their SQL, and the pipeline against single steps."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

duckdb = pytest.importorskip("duckdb")
import check

import __spark_entry__ as contract
import corpus_pipeline
from tableloom.llm.queries import ORACLES, QUERIES

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in check.TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TINY}/{table}.parquet'")
    df = QUERIES[name](spark, TINY)
    got = check.table_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(ORACLES[name])
    assert got == check.table_of([d[0] for d in cursor.description], cursor.fetchall())


def test_all_are_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, TINY).collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= n
        n = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, TINY)
    whole = corpus_pipeline.run(spark, TINY)
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(pieces) == key(whole) and {r.doc_id for r in docs.collect()} == {r.doc_id for r in whole.collect()}
