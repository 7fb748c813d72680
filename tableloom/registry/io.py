"""Sources, sinks, catalog and placement.  Formats are checked by writing a table out and reading it back."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tableloom.functions.scalars import FLOWER_CLASSES
from tableloom.plans import placement
from tableloom.plans.scratch import materialize, scratch_path
from tableloom.plans.skew import row_count_up_to
from tableloom.registry import query
from tableloom.sources import catalog, readers, writers
from tableloom.streaming import packets

PART_LINES = "SELECT p_partkey || ' ' || p_name AS value FROM part"


def part_lines(t):
    return t.part.select(F.concat_ws(" ", "p_partkey", "p_name").alias("value"))


def written(t, name, write, *args, **kwargs):
    path = scratch_path(t.spark, name)
    write(*args, path, **kwargs)
    return path


@query("s1_text_scan", PART_LINES)
def s1(t):
    return readers.text_lines(t.spark, written(t, "text", writers.text_lines, part_lines(t), "value"))


@query("s2_whole_files", """
SELECT count(*) AS n, CAST(sum(length(p_partkey || ' ' || p_name) + 1) AS BIGINT) AS n_chars FROM part""")
def s2(t):
    path = written(t, "text", writers.text_lines, part_lines(t), "value")
    files = readers.whole_files(t.spark, path).where(F.col("file").contains("part-"))
    lines = F.size(F.split("content", "\n", -1)) - 1
    return files.agg(F.sum(lines.cast("bigint")).alias("n"), F.sum(F.length("content").cast("bigint")).alias("n_chars"))


@query("s3_folder_scan", PART_LINES)
def s3(t):
    path = written(t, "text", writers.text_lines, part_lines(t).repartition(4), "value")
    return readers.text_lines(t.spark, path, min_partitions=6)


@query("s3_minimum_partitions", "SELECT count(*) AS n, 4::BIGINT AS files, true AS enough, true AS read_in_place FROM part")
def s3_minimum(t):
    """Lines of a folder of four files in at least eleven splits, cut where they are read."""
    path = written(t, "text", writers.text_lines, part_lines(t).repartition(4), "value")
    lines = readers.text_lines(t.spark, path, min_partitions=11)
    files = readers.whole_files(t.spark, path).where(F.col("file").contains("part-")).select(F.count("*").alias("files"))
    in_place = "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
    counted = readers.file_splits(lines)
    return counted.select("n", files.scalar().alias("files"), (F.col("splits") >= 11).alias("enough"), F.lit(in_place).alias("read_in_place"))


@query("s4_text_sink_refuses_existing", "SELECT count(*) AS n, true AS refused FROM part")
def s4(t):
    path = written(t, "text", writers.text_lines, part_lines(t), "value")
    try:
        writers.text_lines(part_lines(t), "value", path)
        refused = False
    except Exception as error:
        refused = "PATH_ALREADY_EXISTS" in str(error)
    return readers.text_lines(t.spark, path).agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


@query("s5_json_lines", "SELECT event_id, user_id, value, event_type FROM events")
def s5(t):
    path = written(t, "json", writers.json_lines, t.events.select("event_id", "user_id", "value", "event_type"))
    return readers.json_lines(t.spark, path, "event_id bigint, user_id bigint, value double, event_type string")


@query("s5_json_column", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def s5_column(t):
    return readers.parsed_json(t.events.select("event_id", "props"), "props", "k bigint")


@query("s6_json_filter_sink", "SELECT event_id, event_type AS kind FROM events WHERE event_type <> 'view'")
def s6(t):
    rows = t.events.select("event_id", F.when(F.col("event_type") != "view", F.col("event_type")).otherwise("").alias("kind"))
    path = written(t, "json", writers.json_lines, rows, required="kind")
    return readers.json_lines(t.spark, path, "event_id bigint, kind string")


@query("s7_csv_named_fields", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s7(t):
    path = written(t, "csv", writers.csv_rows, t.customer.select("c_custkey", "c_name", "c_acctbal"), header=False)
    return readers.csv_rows(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query("s8_csv_with_newlines", "SELECT conv_id, turn, length(text) AS n, md5(text) AS digest FROM conversations")
def s8(t):
    path = written(t, "csv", writers.csv_rows, t.conversations.select("conv_id", "turn", "text"), header=False)
    rows = readers.csv_rows(t.spark, path, "conv_id bigint, turn bigint, text string", newlines=True)
    return rows.select("conv_id", "turn", F.length("text").cast("bigint").alias("n"), F.md5("text").alias("digest"))


@query("s9_csv_sink", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def s9(t):
    path = written(t, "csv", writers.csv_rows, t.supplier.select("s_suppkey", "s_name", "s_acctbal"))
    return readers.csv_rows(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double", header=True)


@query("s10_prediction_sink", """
SELECT row_number() OVER (ORDER BY doc_id) AS row_no, CASE WHEN toxic = 0 THEN 'ham' ELSE 'spam' END AS label FROM labels""")
def s10(t):
    path = written(t, "csv", lambda df, p: writers.write_predictions(df, "doc_id", p, "toxic"), t.labels)
    return readers.csv_rows(t.spark, path, "row_no bigint, label string")


@query("s11_labelled_text", "SELECT CASE WHEN quality = 1 THEN 'ham' ELSE 'spam' END AS label, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM labels JOIN documents USING (doc_id)")
def s11(t):
    rows = t.labels.join(t.documents, "doc_id").select(
        F.when(F.col("quality") == 1, "ham").otherwise("spam").alias("label"), F.translate("text", "\n\r", "  ").alias("text")
    )
    return readers.labelled_text(t.spark, written(t, "tsv", writers.tab_rows, rows))


@query("s12_mail_log", """
SELECT 'ham' AS label, page_id || '.1.2.3' AS ip, 'u@' || split_part(url, '/', 3) AS address, '<m@' || split_part(url, '/', 3) || '>' AS message_id FROM pages""")
def s12(t):
    host = F.split_part("url", F.lit("/"), F.lit(3))
    rows = t.pages.select(
        F.lit("ham").alias("label"), F.concat(F.col("page_id").cast("string"), F.lit(".1.2.3")).alias("ip"),
        F.concat(F.lit("u@"), host).alias("address"), F.concat(F.lit("<m@"), host, F.lit(">")).alias("message_id"),
    )
    return readers.mail_log(t.spark, written(t, "csv", writers.csv_rows, rows, header=False))


@query("s14_class_name_csv", """
SELECT l_quantity, l_tax, CAST(strpos('ANR', l_returnflag) - 1 AS INTEGER) AS label FROM lineitem""")
def s14_csv(t):
    """Numbers with a class name last, written as CSV and scanned with the names' codes."""
    names = F.create_map(*[F.lit(x) for pair in zip("ANR", FLOWER_CLASSES) for x in pair])
    rows = t.lineitem.select("l_quantity", "l_tax", names[F.col("l_returnflag")].alias("species"))
    path = written(t, "csv", writers.csv_rows, rows, header=False)
    return readers.flower_rows(t.spark, path, ("l_quantity", "l_tax"))


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("s13_numeric_csv", f"SELECT {', '.join(NUMERIC)} FROM lineitem")
def s13(t):
    path = written(t, "csv", writers.csv_rows, t.lineitem.select(*NUMERIC), header=False)
    return readers.numeric_rows(t.spark, path, NUMERIC)


@query("s15_sequence_file", "SELECT p_partkey, p_name FROM part")
def s15(t):
    path = written(t, "seq", writers.sequence_file, t.part.select("p_partkey", "p_name"))
    return readers.sequence_file(t.spark, path, "p_partkey bigint, p_name string")


@query("s16_object_file", "SELECT p_partkey, p_name, p_retailprice FROM part")
def s16(t):
    path = written(t, "obj", writers.object_file, t.part.select("p_partkey", "p_name", "p_retailprice"))
    return readers.object_file(t.spark, path, "p_partkey bigint, p_name string, p_retailprice double")


@query("s17_hadoop_formats", "SELECT c_name, c_mktsegment FROM customer")
def s17(t):
    lib, text = "org.apache.hadoop.mapreduce.lib", "org.apache.hadoop.io.Text"
    path = written(
        t, "hadoop", lambda df, p: writers.hadoop_file(df, p, f"{lib}.output.SequenceFileOutputFormat", text, text),
        t.customer.select("c_name", "c_mktsegment"),
    )
    return readers.hadoop_file(
        t.spark, path, f"{lib}.input.SequenceFileInputFormat", text, text, "c_name string, c_mktsegment string"
    )


@query("s18_compressed_text", PART_LINES)
def s18(t):
    return readers.text_lines(t.spark, written(t, "gz", writers.text_lines, part_lines(t), "value", compression="gzip"))


@query("s21_saved_table", "SELECT n_nationkey, n_name FROM nation")
def s21(t):
    name, home = f"loom_{uuid.uuid4().hex}", scratch_path(t.spark, "db")
    t.nation.select("n_nationkey", "n_name").write.option("path", home).saveAsTable(name)
    try:
        return t.spark.read.schema(t.spark.table(name).schema).parquet(home)
    finally:
        t.spark.sql(f"DROP TABLE {name}")  # the files stay


@query("s24_in_memory_rows", "SELECT r_regionkey, r_name FROM region")
def s24(t):
    if row_count_up_to(t.region, 1000) > 1000:
        raise ValueError("too many rows for a list on the driver")
    rows = [(r["r_regionkey"], r["r_name"]) for r in t.region.collect()]
    return readers.from_rows(t.spark, rows, "r_regionkey int, r_name string", slices=2)


@query("s25_missing_from_range", """
SELECT k AS custkey FROM (SELECT unnest(range((SELECT max(c_custkey) + 1 FROM customer))) AS k)
WHERE k NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def s25(t):
    top = t.customer.agg(F.max("c_custkey")).first()[0]
    pending = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("custkey")).distinct()
    return t.spark.range(top + 1).select(F.col("id").alias("custkey")).join(pending, "custkey", "left_anti")


# ---- streaming form of the per-packet callback -----------------------------


@query("l1_streaming_frequency", "SELECT event_type AS name, count(*) AS cnt FROM events GROUP BY 1")
def l1_streaming(t):
    """The event file arrives as a folder of packet files and is counted as a stream."""
    inbox, out = scratch_path(t.spark, "inbox"), scratch_path(t.spark, "out")
    t.events.select("event_id", "event_type").repartition(4).write.parquet(inbox)
    arriving = packets.packet_stream(t.spark, inbox, "event_id bigint, event_type string", files_per_trigger=2)
    counted = packets.running_frequency(arriving, F.col("event_type"))
    last = packets.count_until_done(counted, scratch_path(t.spark, "checkpoint"), out)
    return t.spark.read.schema("name string, cnt bigint").parquet(last)


# ---- catalog ---------------------------------------------------------------


def fresh_database(t):
    name = f"loom_{uuid.uuid4().hex}"
    catalog.create_database(t.spark, name, location=scratch_path(t.spark, "db"))
    return name


@query("q1_sql_string", """
SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 1000 GROUP BY n_name""")
def q1(t):
    t.customer.createOrReplaceTempView("loom_customer")
    t.nation.createOrReplaceTempView("loom_nation")
    return catalog.run_sql(
        t.spark,
        "SELECT n_name, count(*) AS n FROM loom_customer JOIN loom_nation ON c_nationkey = n_nationkey "
        "WHERE c_acctbal > :floor GROUP BY n_name", floor=1000,
    )


def loaded_table(t, name):
    catalog.create_table(
        t.spark, f"{name}.customers",
        [
            catalog.column("id", "bigint", required=True, comment="row number"),
            catalog.column("name", "string", default="''", comment="the customer's name"),
            catalog.column("balance", "double"),
        ],
        comment="customers by number",
    )
    rows = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    catalog.insert_rows(rows, f"{name}.customers", required=["id"])


@query("q2_list_databases", "SELECT true AS listed, count(*) AS n FROM customer")
def q2(t):
    name = fresh_database(t)
    loaded_table(t, name)
    found = catalog.list_databases(t.spark).where(F.col("namespace") == name).count() == 1
    n = catalog.run_sql(t.spark, f"SELECT count(*) AS n FROM {name}.customers").first()["n"]
    catalog.drop_database(t.spark, name, cascade=True)
    return t.spark.createDataFrame([(found, n)], "listed boolean, n bigint")


@query("q3_use_database", "SELECT count(*) AS n, max(c_custkey) AS last FROM customer")
def q3(t):
    name, before = fresh_database(t), t.spark.catalog.currentDatabase()
    loaded_table(t, name)
    try:
        catalog.use_database(t.spark, name)
        row = catalog.rows_of(t.spark, "SELECT count(*) AS n, max(id) AS last FROM customers")[0]
    finally:
        catalog.use_database(t.spark, before)
        catalog.drop_database(t.spark, name, cascade=True)
    return t.spark.createDataFrame([row], "n bigint, last bigint")


@query("q4_create_database", "SELECT true AS again_refused, true AS if_missing_accepted, count(*) AS n FROM customer")
def q4(t):
    name = fresh_database(t)
    loaded_table(t, name)
    try:
        catalog.create_database(t.spark, name)
        refused = False
    except Exception as error:
        refused = "SCHEMA_ALREADY_EXISTS" in str(error)
    catalog.create_database(t.spark, name, if_missing=True)
    n = catalog.rows_of(t.spark, f"SELECT count(*) FROM {name}.customers")[0][0]
    catalog.drop_database(t.spark, name, cascade=True)
    return t.spark.createDataFrame([(refused, True, n)], "again_refused boolean, if_missing_accepted boolean, n bigint")


@query("q5_describe_database", "SELECT true AS described, count(*) AS n FROM customer")
def q5(t):
    name = fresh_database(t)
    loaded_table(t, name)
    facts = {r["info_name"]: r["info_value"] for r in catalog.describe_database(t.spark, name).collect()}
    n = catalog.rows_of(t.spark, f"SELECT count(*) FROM {name}.customers")[0][0]
    catalog.drop_database(t.spark, name, cascade=True)
    return t.spark.createDataFrame([(name in facts.values(), n)], "described boolean, n bigint")


@query("q6_drop_database", "SELECT true AS full_refused, true AS gone, count(*) AS n FROM customer")
def q6(t):
    name = fresh_database(t)
    loaded_table(t, name)
    n = catalog.rows_of(t.spark, f"SELECT count(*) FROM {name}.customers")[0][0]
    try:
        catalog.drop_database(t.spark, name)
        refused = False
    except Exception:
        refused = True
    catalog.drop_database(t.spark, name, cascade=True)
    catalog.drop_database(t.spark, name, if_exists=True)
    gone = not t.spark.catalog.databaseExists(name)
    return t.spark.createDataFrame([(refused, gone, n)], "full_refused boolean, gone boolean, n bigint")


@query("q7_create_table", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def q7(t):
    name = fresh_database(t)
    loaded_table(t, name)
    out = scratch_path(t.spark, "copy")
    t.spark.table(f"{name}.customers").write.parquet(out)
    catalog.drop_database(t.spark, name, cascade=True)
    return t.spark.read.schema("id bigint, name string, balance double").parquet(out)


@query("q8_run_once", "SELECT max(o_totalprice) AS top, count(*) AS n FROM orders")
def q8(t):
    t.orders.createOrReplaceTempView("loom_orders")
    return catalog.run_sql(t.spark, "SELECT max(o_totalprice) AS top, count(*) AS n FROM loom_orders")


# ---- placement -------------------------------------------------------------


@query("x1_repartition", "SELECT o_custkey, count(*) AS n, 1::BIGINT AS n_partitions FROM orders GROUP BY 1")
def x1(t):
    placed = placement.spread(t.orders.select("o_custkey"), 6, "o_custkey").withColumn("p", F.spark_partition_id())
    parts = placed.groupBy("o_custkey", "p").agg(F.count("*").alias("n"))
    return parts.groupBy("o_custkey").agg(F.sum("n").alias("n"), F.count("*").alias("n_partitions"))


@query("x2_coalesce", "SELECT count(*) AS n, true AS fewer FROM orders")
def x2(t):
    few = placement.gather(placement.spread(t.orders.select("o_orderkey"), 6), 2)
    return few.agg(F.count("*").alias("n"), F.lit(placement.partition_count(few) <= 2).alias("fewer"))


@query("x3_partition_count", "SELECT 5::BIGINT AS planned, count(*) AS n FROM orders")
def x3(t):
    placed = placement.spread(t.orders.select("o_orderkey"), 5)
    return placed.agg(F.lit(placement.partition_count(placed)).cast("bigint").alias("planned"), F.count("*").alias("n"))


@query("x4_partition_by_host", """
SELECT split_part(url, '/', 3) AS host, count(*) AS n, 1::BIGINT AS n_partitions FROM pages GROUP BY 1""")
def x4(t):
    placed = placement.by_host(t.pages.select("url"), "url").select(
        F.parse_url("url", F.lit("HOST")).alias("host"), F.spark_partition_id().alias("p")
    )
    parts = placed.groupBy("host", "p").agg(F.count("*").alias("n"))
    return parts.groupBy("host").agg(F.sum("n").alias("n"), F.count("*").alias("n_partitions"))


@query("x5_persist", "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def x5(t):
    held = placement.kept(t.events.select("event_type", "value"), StorageLevel.MEMORY_AND_DISK)
    try:
        counts = held.groupBy("event_type").agg(F.count("*").alias("n"))
        means = held.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"))
        # both aggregates run while the table is held
        return materialize(counts.join(means, "event_type"))
    finally:
        held.unpersist()


@query("x6_lineage", "SELECT count(*) AS n, true AS pushed, true AS pruned FROM lineitem WHERE l_quantity > 45")
def x6(t):
    few = t.lineitem.where("l_quantity > 45").select("l_orderkey")
    plan = placement.lineage(few)
    pushed = "GreaterThan(l_quantity,45.0)" in plan
    pruned = "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    return few.agg(F.count("*").alias("n"), F.lit(pushed).alias("pushed"), F.lit(pruned).alias("pruned"))


@query("x7_settings", "SELECT count(*) AS n, true AS effective FROM orders")
def x7(t):
    key = "spark.sql.files.maxPartitionBytes"
    before = t.spark.conf.get(key)
    t.spark.conf.set(key, "64k")
    effective = t.spark.conf.get(key) == "64k"
    t.spark.conf.set(key, before)
    return t.orders.agg(F.count("*").alias("n"), F.lit(effective).alias("effective"))


@query("x8_parallelism", "SELECT user_id, round(sum(value), 2) AS total FROM events GROUP BY 1")
def x8(t):
    out = scratch_path(t.spark, "wide")
    with placement.parallelism(t.spark, 10):
        t.events.groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("total")).write.parquet(out)
    return t.spark.read.schema("user_id bigint, total double").parquet(out)
