"""Page extraction, sources, sinks and the catalog on small files."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from tableloom.functions import text as tx
from tableloom.operators import bayes as nb
from tableloom.operators import logs, sampling, web
from tableloom.sources import catalog, readers, writers

PAGE = """<html><!-- <img src="no.png"> --><script>var a='<img src="no.png">';</script>
<div class="rg_meta other">{"ou":"http://x/a.png","ity":"png"}<div class="inner">deep</div></div>
<img class=z src='one.jpg'/> <IMG alt="src=no" SRC="two&amp;.jpg"><img alt="none">
<a href="/p/1">x</a><a data-href="/no" href="/p/2">y</a><a href=/q/3>z</a></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, "http://h/x", PAGE), (2, "http://h/y", "<p>nothing"), (3, "http://h/z", None)],
                                 "page_id bigint, url string, html string")


def test_attributes(pages):
    images = web.links(pages, "img", "src").orderBy("pos").collect()
    assert [(r["page_id"], r["href"]) for r in images] == [(1, "one.jpg"), (1, "two&.jpg")]
    anchors = web.links(pages, pattern="^/p/").orderBy("pos").collect()
    assert [(r["pos"], r["href"]) for r in anchors] == [(0, "/p/1"), (1, "/p/2")]
    assert [r["href"] for r in web.links(pages).orderBy("pos").collect()] == ["/p/1", "/p/2", "/q/3"]


def test_blocks_and_metadata(pages):
    texts = pages.select("page_id", web.block_texts(F.col("html"), "div", "rg_meta").alias("t")).orderBy("page_id").collect()
    assert texts[0]["t"] == ['{"ou":"http://x/a.png","ity":"png"}deep'] and texts[1]["t"] == [] and texts[2]["t"] == []
    inner = pages.where("page_id = 1").select(web.block_texts(F.col("html"), "div", "inner").alias("t")).first()["t"]
    assert inner == ["deep"]
    one = pages.limit(1).select(
        web.metadata(F.array(F.lit('{"ou":"u","ity":""}')), "ou", "ity").alias("m"),
        web.nested_item(F.lit('[["a"],["b","<p>c</p>"]]'), 1, 1).alias("n"),
        web.album_title(F.lit("red/blue (1/23)")).alias("title"),
        web.picture_name(F.lit("http://a/b/c.jpg")).alias("good"), web.picture_name(F.lit("http://a/b/c")).alias("bad"),
        web.numbered_pages(F.lit("http://a"), F.lit(2)).alias("urls"),
        web.filled("http://s?q={q}&n={n}", q=web.query_words(F.lit("  red  car ")), n=F.lit(3)).alias("url"),
    ).first()
    assert tuple(one["m"][0]) == ("u", "") and one["n"] == "<p>c</p>" and one["title"] == "red blue[23]"
    assert (one["good"], one["bad"]) == ("c.jpg", "error.jpg")
    assert one["urls"] == ["http://a/1.html", "http://a/2.html"] and one["url"] == "http://s?q=red+car&n=3"


def test_unique_urls_and_manifest(spark):
    found = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "a"), (2, 1, "c")], "page_id bigint, pos bigint, href string")
    got = web.unique_numbered(found, "href", ["page_id", "pos"]).orderBy("number").collect()
    assert [(r["href"], r["number"]) for r in got] == [("a", 1), ("b", 2), ("c", 3)]
    files = web.file_manifest(found, "href", ["page_id", "pos"], F.lit("jpg")).orderBy("file_name").collect()
    assert [r["file_name"] for r in files] == ["a_1.jpg", "a_2.jpg", "b_1.jpg", "c_1.jpg"]
    left = web.not_yet_stored(found, spark.createDataFrame([("a",)], "href string"), "href")
    assert {r["href"] for r in left.collect()} == {"b", "c"}


def test_packets(spark):
    rows = [(1, ("a.org",), None), (2, (" ",), ("ua",)), (3, None, ("ua",)), (4, ("a.org",), ("x",))]
    packets = spark.createDataFrame(
        rows, "pkt_id bigint, dns struct<qry_name:string>, http struct<user_agent:string>"
    )
    names = {r["name"]: r["cnt"] for r in logs.name_frequency(packets, F.col("dns.qry_name")).collect()}
    assert names == {"a.org": 2}
    agents = logs.by_frequency(logs.name_frequency(packets, F.col("http.user_agent"))).orderBy("place").collect()
    assert [(r["name"], r["cnt"]) for r in agents] == [("x", 1), ("ua", 2)]
    assert tuple(logs.layer_counts(packets, dns=F.col("dns"), http=F.col("http")).first()) == (3, 3)
    assert logs.first_match(packets, F.col("http.user_agent") == "ua", "pkt_id").first()["pkt_id"] == 2


def test_bursts_overlap_and_end_with_the_table(spark):
    df = spark.range(50).withColumnRenamed("id", "pkt")
    rows = sampling.bursts(df, ["pkt"], 10, 5, 64).collect()
    starts = {r["run_start"] for r in rows}
    assert 0 in starts and len(starts) > 3
    assert sorted((r["run_start"], r["pos"]) for r in rows) == sorted(
        (s, p) for s in starts for p in range(s, min(s + 10, 50))
    )
    assert all(r["pkt"] == r["pos"] for r in rows)


def folder():
    return tempfile.mkdtemp(prefix="run-")


def write(name, content):
    path = f"{folder()}/{name}"
    with open(path, "w", encoding="utf8", newline="") as out:
        out.write(content)
    return path


def test_labelled_text(spark):
    path = write("mail.tsv", 'ham\tsay "hi" &lt;now&gt;, ok\nspam\twin, "cash')
    rows = readers.labelled_text(spark, path).collect()
    assert [tuple(r) for r in rows] == [("ham", 'say "hi" &lt;now&gt;, ok'), ("spam", 'win, "cash')]


def test_mail_log(spark):
    path = write("net.csv", "ham,1.2.3.4,h@a.org,<i@b.net>\nspam,9.9.9.9,k@c.com,odd\n")
    rows = readers.mail_log(spark, path)
    got = rows.select(tx.network_tokens(F.col("ip"), F.col("address"), F.col("message_id")).alias("t")).collect()
    assert got[1]["t"] == ["9", "9", "9", "9", "c", "com", "o", "d", "d"]
    assert [r["c"] for r in rows.select(nb.encode_label(F.col("label")).alias("c")).collect()] == [0, 1]


def test_numeric_and_flower_rows(spark):
    numbers = readers.numeric_rows(spark, write("n.csv", "1,2.5\n3,4\n"), ["a", "b"]).collect()
    assert [tuple(r) for r in numbers] == [(1.0, 2.5), (3.0, 4.0)]
    flowers = readers.flower_rows(spark, write("f.csv", "5.1,Setosa\n6.0,Virginica\n7,Other\n"), ["a"]).collect()
    assert [tuple(r) for r in flowers] == [(5.1, 0), (6.0, 2), (7.0, None)]


def test_csv_keeps_newlines_quotes_and_spaces(spark):
    df = spark.createDataFrame([(1, 'a "b"\nc, d '), (2, " x\\y")], "id bigint, t string")
    path = f"{folder()}/out"
    writers.csv_rows(df, path)
    back = readers.csv_rows(spark, path, "id bigint, t string", newlines=True, header=True)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_json_and_text_sinks(spark):
    df = spark.createDataFrame([(1, "x"), (2, ""), (3, None)], "id bigint, name string")
    path = f"{folder()}/out"
    writers.json_lines(df, path, required="name")
    assert [tuple(r) for r in readers.json_lines(spark, path, "id bigint, name string").collect()] == [(1, "x")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.json_lines(df, path)


def test_whole_files_and_min_partitions(spark):
    path = write("a.txt", "one\ntwo\n")
    files = readers.whole_files(spark, path).collect()
    assert files[0]["content"] == "one\ntwo\n" and files[0]["file"].endswith("a.txt")
    assert readers.text_lines(spark, path, min_partitions=3).rdd.getNumPartitions() >= 3


def test_predictions_and_metrics(spark):
    found = spark.createDataFrame([(30, 1), (10, 0), (20, 5)], "doc_id bigint, predicted int")
    path = f"{folder()}/out"
    writers.write_predictions(found, "doc_id", path)
    rows = readers.csv_rows(spark, path, "row_no int, label string").orderBy("row_no").collect()
    assert [tuple(r) for r in rows] == [(1, "ham"), (2, "spam"), (3, "spam")]
    log = f"{folder()}/metrics"
    for run, generation, best in (("a", 0, 0.5), ("a", 1, 0.6), ("a", 1, 0.7), ("b", 1, 0.8)):
        writers.append_metrics(spark.createDataFrame([(best,)], "best double"), log, run, generation)
    # generation 1 of run a was written again
    assert {(r.run, r.generation, r.best) for r in writers.read_metrics(spark, log).collect()} == {("a", 0, 0.5), ("a", 1, 0.7), ("b", 1, 0.8)}


def test_outside_stores_describe_themselves(spark):
    options = readers.jdbc_options("jdbc:x://h/db", "t", "id", 0, 100, 8, user="u")
    assert options == {
        "url": "jdbc:x://h/db", "dbtable": "t", "user": "u", "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "100", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x://h/db", "t", "id")
    with pytest.raises(ValueError):
        readers.connector_table(spark, "cassandra", table="t")


def test_catalog(spark):
    name = f"loom_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, location=folder())
    try:
        catalog.create_table(spark, f"{name}.people", [
            catalog.column("id", "bigint", required=True), catalog.column("name", "string", default="'it''s'", comment="it's a name"),
        ], comment="people")
        spark.sql(f"INSERT INTO {name}.people (id) VALUES (1)")
        assert catalog.rows_of(spark, f"SELECT id, name FROM {name}.people WHERE id = :one", one=1) == [(1, "it's")]
        rows = spark.createDataFrame([(2, "x"), (None, "y")], "id bigint, name string")
        with pytest.raises(Exception, match="id must not be NULL"):
            catalog.insert_rows(rows, f"{name}.people", required=["id"])
        catalog.insert_rows(rows.where("id = 2"), f"{name}.people", required=["id"])
        assert spark.table(f"{name}.people").count() == 2
        assert dict((f.name, f.metadata.get("comment")) for f in spark.table(f"{name}.people").schema)["name"] == "it's a name"
    finally:
        catalog.drop_database(spark, name, cascade=True)
    assert not spark.catalog.databaseExists(name)
