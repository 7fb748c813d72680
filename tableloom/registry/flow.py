"""Keyed data flow: projections, joins, aggregates, windows, sorting and sets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tableloom.functions import text as tx
from tableloom.functions.draws import draw_below, draw_unit
from tableloom.operators import bayes as nb
from tableloom.operators import keyed, series
from tableloom.plans.ordered import OrderedRows, numbered
from tableloom.plans.scratch import materialize
from tableloom.plans.skew import join_small
from tableloom.registry import query, sql_draw, sql_unit
from tableloom.registry.bayes import TOKENS

# ---- projections, filters, maps --------------------------------------------


@query("p1_map", "SELECT l_orderkey, l_linenumber, l_quantity * l_quantity AS squared FROM lineitem")
def p1(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_quantity")).alias("squared")
    )


@query("p2_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def p2(t):
    return t.lineitem.where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_quantity")


@query("p3_substring_filter", "SELECT event_id, event_type FROM events WHERE contains(event_type, 'err')")
def p3(t):
    return t.events.where(F.col("event_type").contains("err")).select("event_id", "event_type")


@query("p4_flat_map", "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents")
def p4(t):
    return keyed.flat_map(t.documents, F.split("text", " "), "word").select("doc_id", "word")


@query("p5_map_to_array", """
SELECT conv_id, turn, len(string_split(text, ' ')) AS n, md5(array_to_string(string_split(text, ' '), '|')) AS digest
FROM conversations""")
def p5(t):
    words = F.split("text", " ")
    return t.conversations.select(
        "conv_id", "turn", F.size(words).cast("bigint").alias("n"), F.md5(F.array_join(words, "|")).alias("digest")
    )


@query("p6_key_by", "SELECT string_split(text, ' ')[1] AS key, conv_id, turn FROM conversations")
def p6(t):
    return keyed.key_by(t.conversations, F.split("text", " ")[0]).select("key", "conv_id", "turn")


@query("p7_keys", "SELECT user_id AS key FROM events")
def p7_keys(t):
    return t.events.select(F.col("user_id").alias("key"))


@query("p7_values", "SELECT value FROM events")
def p7_values(t):
    return t.events.select("value")


@query("p8_map_values", "SELECT user_id, value * 2 + 1 AS value FROM events")
def p8(t):
    return keyed.map_values(t.events.select("user_id", "value"), "value", lambda v: v * 2 + 1)


@query("p9_flat_map_values", "SELECT conv_id, turn, unnest(string_split(text, '. ')) AS sentence FROM conversations")
def p9(t):
    pairs = keyed.flat_map(t.conversations, F.split("text", "[.] ", -1), "sentence")
    return pairs.select("conv_id", "turn", "sentence")


@query("p10_value_length_filter", "SELECT conv_id, turn, text FROM conversations WHERE length(text) < 200")
def p10(t):
    return t.conversations.where(F.length("text") < 200).select("conv_id", "turn", "text")


@query("p11_layer_present", """
SELECT event_id, event_type FROM events WHERE event_type IS NOT NULL AND event_type <> ' ' AND props IS NOT NULL""")
def p11(t):
    present = F.col("event_type").isNotNull() & (F.col("event_type") != " ") & F.col("props").isNotNull()
    return t.events.where(present).select("event_id", "event_type")


@query("p12_map_partitions", "SELECT event_id, value * 3 - 1 AS scaled FROM events")
def p12(t):
    def scale(batches):
        factor, shift = 3, 1  # set up once per partition
        for batch in batches:
            yield pd.DataFrame({"event_id": batch["event_id"], "scaled": batch["value"] * factor - shift})

    return keyed.map_partitions(t.events.select("event_id", "value"), scale, "event_id bigint, scaled double")


@query("p13_foreach_partition", "SELECT count(*) AS n_rows FROM events")
def p13(t):
    rows = t.spark.sparkContext.accumulator(0)
    t.events.select("event_id").foreachPartition(lambda part: rows.add(sum(1 for _ in part)))
    return t.spark.createDataFrame([(rows.value,)], "n_rows bigint")


@query("p14_foreach", "SELECT count(*) FILTER (WHERE value > 100) AS n_large FROM events")
def p14(t):
    large = t.spark.sparkContext.accumulator(0)
    t.events.select("value").foreach(lambda row: large.add(1 if row["value"] > 100 else 0))
    return t.spark.createDataFrame([(large.value,)], "n_large bigint")


@query("p15_pipe", "SELECT upper(p_partkey || ' ' || p_name) AS line FROM part")
def p15(t):
    return keyed.pipe_lines(t.part, F.concat_ws(" ", "p_partkey", "p_name"), "tr a-z A-Z")


@query("p16_glom", """
SELECT chunk, count(*) AS n, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS keys
FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 30 AS chunk FROM orders) GROUP BY chunk""")
def p16(t):
    lists = keyed.packed(t.orders.select("o_orderkey"), ["o_orderkey"], "o_orderkey", 30)
    return lists.select(
        "chunk", F.size("items").cast("bigint").alias("n"), F.array_join(F.col("items").cast("array<string>"), ",").alias("keys")
    )


@query("p17_take", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25")
def p17(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(25)


@query("p18_comprehension", """
SELECT p_partkey, array_to_string([upper(w) for w in string_split(p_name, ' ') if length(w) > 4], ',') AS words FROM part""")
def p18(t):
    kept = F.filter(F.split("p_name", " "), lambda w: F.length(w) > 4)
    return t.part.select("p_partkey", F.array_join(F.transform(kept, F.upper), ",").alias("words"))


@query("p19_nested_flatten", """
SELECT conv_id, turn, len(w) AS n, md5(array_to_string(w, '|')) AS digest FROM (
  SELECT conv_id, turn, flatten([string_split(line, ' ') for line in string_split(text, chr(10))]) AS w FROM conversations)""")
def p19(t):
    lines = F.transform(F.split("text", "\n", -1), lambda line: F.split(line, " ", -1))
    flat = t.conversations.select("conv_id", "turn", F.flatten(lines).alias("w"))
    return flat.select(
        "conv_id", "turn", F.size("w").cast("bigint").alias("n"), F.md5(F.array_join("w", "|")).alias("digest")
    )


@query("p20_cleaning_chain", """
SELECT p_partkey, array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(p_name || ' of ' || lower(p_type), ' ')], ' ')
       AS cleaned FROM part""")
def p20(t):
    messy = F.concat(F.lit("  "), F.col("p_name"), F.lit("! of# "), F.col("p_type"), F.lit("?? "))
    return t.part.select("p_partkey", tx.clean(messy, tx.CLEANING).alias("cleaned"))


@query("p21_collect_as_map", """
SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def p21(t):
    return keyed.last_by_key(t.events, "user_id", "value", ["event_id"])


# ---- joins and lookups -----------------------------------------------------

@query("j1_inner_join", """
SELECT o_orderkey, o_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def j1(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return keyed.inner(orders, customers, ["o_custkey"])


@query("j2_left_outer_join", """
SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def j2(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return keyed.left_outer(t.customer.select("c_custkey", "c_name"), orders, ["c_custkey"])


@query("j3_right_outer_join", """
SELECT o_orderkey, c_custkey, c_name FROM orders RIGHT JOIN customer ON o_custkey = c_custkey""")
def j3(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return keyed.right_outer(orders, t.customer.select("c_custkey", "c_name"), ["c_custkey"]).select(
        "o_orderkey", "c_custkey", "c_name"
    )


def chunk_sql(table: str, key: str, value: str, size: int) -> str:
    return f"""
(SELECT {key} AS key, (rn - 1) // {size} AS chunk, string_agg({value}, ',' ORDER BY {value}) AS items
 FROM (SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY {value}) AS rn FROM {table}) GROUP BY 1, 2)"""


def listed(name):
    return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)


@query("j4_cogroup", f"""
SELECT coalesce(a.key, b.key) AS key, coalesce(a.chunk, b.chunk) AS chunk, a.items AS left_items, b.items AS right_items
FROM {chunk_sql('customer', 'c_nationkey', 'c_custkey', 16)} a
FULL JOIN {chunk_sql('supplier', 's_nationkey', 's_suppkey', 16)} b ON a.key = b.key AND a.chunk = b.chunk""")
def j4(t):
    both = keyed.cogroup(
        t.customer.select(F.col("c_nationkey").alias("key"), "c_custkey"),
        t.supplier.select(F.col("s_nationkey").alias("key"), "s_suppkey"),
        "key", "c_custkey", "s_suppkey", chunk=16,
    )
    return both.select("key", "chunk", listed("left_items"), listed("right_items"))


@query("j5_product_with_bounded_side", "SELECT s_suppkey, r_name FROM supplier CROSS JOIN region")
def j5(t):
    return keyed.product_with_bounded(t.supplier.select("s_suppkey"), t.region.select("r_name"))


@query("j6_lookup", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 42")
def j6(t):
    return keyed.lookup(t.orders, "o_custkey", 42).select("o_orderkey", "o_totalprice")


@query("j7_broadcast_lookup", """
SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name""")
def j7(t):
    named = join_small(
        t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_acctbal"), t.nation, ["n_nationkey"]
    )
    return named.groupBy("n_name").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query("j8_vocabulary_lookup", f"""
WITH words AS (SELECT item_id, generate_subscripts(tk, 1) AS pos, unnest(tk) AS token
               FROM (SELECT item_id, {TOKENS} AS tk FROM benchmark)),
vocab AS (SELECT token, row_number() OVER (ORDER BY f) - 1 AS idx
          FROM (SELECT token, min(item_id * 1000000 + pos) AS f FROM words GROUP BY token)),
tok AS (SELECT doc_id, unnest({TOKENS}) AS token FROM documents)
SELECT doc_id, idx, count(*) AS cnt FROM tok JOIN vocab USING (token) GROUP BY 1, 2""")
def j8(t):
    vocab = nb.vocabulary(nb.token_counts(t.benchmark), "item_id")
    counts = nb.token_counts(t.documents.select("doc_id", "text"))
    return nb.count_vectors(counts, vocab).drop("first")


@query("j9_inverse_mapping", """
SELECT conv_id, turn, word, max(pos) AS pos FROM (
  SELECT conv_id, turn, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word
  FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)) GROUP BY 1, 2, 3""")
def j9(t):
    placed = t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    return placed.groupBy("conv_id", "turn", "word").agg(F.max(F.col("pos").cast("bigint")).alias("pos"))


@query("j10_zip_rows", """
SELECT a.pos, c_custkey, s_suppkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS pos FROM customer) a
JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS pos FROM supplier) b ON a.pos = b.pos""")
def j10(t):
    zipped = keyed.zip_rows(
        t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"],
        t.supplier.select("s_suppkey", "s_acctbal"), ["s_acctbal", "s_suppkey"],
    )
    return zipped.select("pos", "c_custkey", "s_suppkey")


@query("j10_zip_arrays", """
SELECT p_partkey, array_to_string([n[i] || ':' || m[i] for i in range(1, least(len(n), len(m)) + 1)], ',') AS zipped
FROM (SELECT p_partkey, string_split(p_name, ' ') AS n, string_split(p_type || ' ' || p_brand || ' ' || p_size, ' ') AS m FROM part)""")
def j10_arrays(t):
    a, b = F.split("p_name", " "), F.split(F.concat_ws(" ", "p_type", "p_brand", "p_size"), " ")
    short = F.least(F.size(a), F.size(b))
    pairs = F.zip_with(F.slice(a, F.lit(1), short), F.slice(b, F.lit(1), short), lambda x, y: F.concat(x, F.lit(":"), y))
    return t.part.select("p_partkey", F.array_join(pairs, ",").alias("zipped"))


@query("j11_unzip", """
SELECT p_partkey, array_to_string([n[i] for i in range(1, len(n) + 1)], ',') AS firsts,
       array_to_string([upper(n[i]) for i in range(1, len(n) + 1)], ',') AS seconds
FROM (SELECT p_partkey, string_split(p_name, ' ') AS n FROM part)""")
def j11(t):
    words = F.split("p_name", " ")
    pairs = F.zip_with(words, F.transform(words, F.upper), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return t.part.select("p_partkey", pairs.alias("z")).select(
        "p_partkey",
        F.array_join(F.transform("z", lambda p: p["a"]), ",").alias("firsts"),
        F.array_join(F.transform("z", lambda p: p["b"]), ",").alias("seconds"),
    )


@query("j12_adjacent_pairs", """
SELECT * FROM (SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next_key,
       lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next_price FROM orders)
WHERE next_key IS NOT NULL""")
def j12(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    pairs = keyed.adjacent_pairs(
        orders, ["o_custkey"], ["o_orderkey"], next_key="o_orderkey", next_price="o_totalprice"
    )
    return pairs.drop("o_totalprice")


@query("j13_disjoint_pairs", """
SELECT o_custkey, (rn - 1) // 2 AS pair_id, max(CASE WHEN rn % 2 = 1 THEN o_orderkey END) AS first,
       max(CASE WHEN rn % 2 = 0 THEN o_orderkey END) AS second
FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
GROUP BY 1, 2""")
def j13(t):
    return keyed.disjoint_pairs(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], "o_orderkey")


# ---- aggregates ------------------------------------------------------------


@query("a1_count", "SELECT count(*) AS n FROM lineitem")
def a1(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("a2_count_by_value", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def a2(t):
    return keyed.count_by_value(t.events, "event_type")


@query("a3_reduce", "SELECT sum(l_quantity) AS total FROM lineitem")
def a3(t):
    return t.lineitem.agg(F.sum("l_quantity").alias("total"))


@query("a4_fold", """
SELECT greatest(max(l_quantity), 0.0) AS l_quantity FROM lineitem""")
def a4(t):
    return keyed.fold(t.lineitem, "l_quantity", 0.0, F.max)


@query("a5_aggregate", "SELECT sum(l_quantity) AS total, count(*) AS n, sum(l_quantity) / count(*) AS mean FROM lineitem")
def a5(t):
    return t.lineitem.agg(
        F.sum("l_quantity").alias("total"), F.count("*").alias("n"),
        (F.sum("l_quantity") / F.count("*")).alias("mean"),
    )


@query("a6_reduce_by_key", "SELECT user_id, round(sum(value), 2) AS value FROM events GROUP BY user_id")
def a6(t):
    return keyed.reduce_by_key(t.events, "user_id", "value", lambda v: F.round(F.sum(v), 2))


@query("a7_fold_by_key", """
SELECT user_id, coalesce(round(sum(CASE WHEN event_type = 'error' THEN value END), 2), 0.0) AS value
FROM events GROUP BY user_id""")
def a7(t):
    errors = t.events.select("user_id", F.when(F.col("event_type") == "error", F.col("value")).alias("value"))
    return keyed.fold_by_key(errors, "user_id", "value", 0.0, lambda v: F.round(F.sum(v), 2))


@query("a8_combine_by_key", """
SELECT event_type, round(sum(value), 2) AS total, count(*) AS n FROM events GROUP BY event_type""")
def a8(t):
    return t.events.groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total"), F.count("value").alias("n"))


@query("a9_average_by_key", "SELECT user_id, round(avg(value), 6) AS mean FROM events GROUP BY user_id")
def a9(t):
    return t.events.groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("mean"))


@query("a10_word_count", """
SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def a10(t):
    return keyed.word_count(t.documents, "text")


@query("a11_group_values", f"""
SELECT key AS user_id, chunk, items FROM {chunk_sql('events', 'user_id', 'event_id', 64)}""")
def a11(t):
    return keyed.group_values(t.events, "user_id", "event_id").select("user_id", "chunk", listed("items"))


@query("a12_words_by_letter", f"""
SELECT key AS letter, chunk, items FROM
{chunk_sql("(SELECT DISTINCT substr(w, 1, 1) AS letter, w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE w <> '')", 'letter', 'w', 64)}""")
def a12(t):
    found = t.benchmark.select(F.explode(F.split("text", " ")).alias("w")).where("w <> ''").distinct()
    lettered = found.select(F.substring("w", 1, 1).alias("letter"), "w")
    return keyed.group_values(lettered, "letter", "w").select("letter", "chunk", listed("items"))


@query("a13_stats", """
SELECT count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, sum(l_quantity) AS sum, max(l_quantity) AS max,
       min(l_quantity) AS min, round(var_pop(l_quantity), 6) AS variance, round(var_samp(l_quantity), 6) AS sample_variance,
       round(stddev_pop(l_quantity), 6) AS stdev, round(stddev_samp(l_quantity), 6) AS sample_stdev FROM lineitem""")
def a13(t):
    row = keyed.stats(t.lineitem, "l_quantity")
    smooth = {"mean", "variance", "sample_variance", "stdev", "sample_stdev"}
    return row.select(*[F.round(c, 6).alias(c) if c in smooth else F.col(c) for c in row.columns])


@query("a14_accumulator", """
SELECT CAST(sum(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) = ''))) AS BIGINT) AS blank_lines,
       count(*) AS docs FROM documents""")
def a14(t):
    blank = F.size(F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) == ""))
    seen = keyed.observed(
        t.documents.select("text"), blank_lines=F.sum(blank.cast("bigint")), docs=F.count("*")
    )
    return t.spark.createDataFrame([(seen["blank_lines"], seen["docs"])], "blank_lines bigint, docs bigint")


@query("a15_custom_accumulator", """
SELECT event_type, max(value) AS high, min(value) AS low, max(event_id) AS last FROM events GROUP BY event_type""")
def a15(t):
    acc = keyed.combine_by_key(
        t.events.select("event_type", F.struct("value", "event_id").alias("v")),
        "event_type", "v",
        lambda v: (v["value"], v["value"], v["event_id"]),
        lambda a, v: (max(a[0], v["value"]), min(a[1], v["value"]), max(a[2], v["event_id"])),
        lambda a, b: (max(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2])),
        width=3,
    )
    return acc.select(
        "event_type", F.col("acc")[0].alias("high"), F.col("acc")[1].alias("low"),
        F.col("acc")[2].cast("bigint").alias("last"),
    )


@query("a16_frequency_table", """
SELECT props, count(*) AS cnt FROM events WHERE props IS NOT NULL AND props <> ' ' GROUP BY props""")
def a16(t):
    return keyed.count_by_value(t.events.where("props is not null and props <> ' '"), "props")


UX, UY = sql_unit(sql_draw(64, "'x'", "event_id")), sql_unit(sql_draw(64, "'y'", "event_id"))


@query("a17_monte_carlo_ratio", f"""
SELECT 4.0 * CAST(count(*) FILTER (WHERE x * x + y * y < 1) AS DOUBLE) / count(*) AS pi FROM
(SELECT {UX} AS x, {UY} AS y FROM events)""")
def a17(t):
    points = t.events.select(
        draw_unit(64, "x", F.col("event_id")).alias("x"), draw_unit(64, "y", F.col("event_id")).alias("y")
    )
    inside = F.count(F.when(F.col("x") * F.col("x") + F.col("y") * F.col("y") < 1, 1))
    return points.agg((F.lit(4.0) * inside.cast("double") / F.count("*")).alias("pi"))


@query("a18_rate_check", f"""
SELECT count(*) FILTER (WHERE {sql_draw(64, "'rate'", 'event_id')} % 100 = 0) AS hits, count(*) AS n FROM events""")
def a18(t):
    hit = draw_below(100, 64, "rate", F.col("event_id")) == 0
    return t.events.agg(F.count(F.when(hit, 1)).alias("hits"), F.count("*").alias("n"))


# ---- ordered computations --------------------------------------------------


@query("w1_row_number", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS overall,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS per_customer FROM orders""")
def w1(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    overall = numbered(orders, (), ["o_orderdate", "o_orderkey"], "overall")
    both = numbered(overall, ["o_custkey"], ["o_orderdate", "o_orderkey"], "per_customer")
    return both.select("o_orderkey", "overall", "per_customer")


@query("w2_seen_before", """
SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1 AS seen FROM events""")
def w2(t):
    events = t.events.select("event_id", "user_id", "event_type")
    return keyed.seen_before(events, ["user_id", "event_type"], ["event_id"]).select("event_id", "seen")


@query("w3_consecutive_runs", """
WITH c AS (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) IS DISTINCT FROM event_type
           THEN 1 ELSE 0 END AS changed FROM events),
r AS (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY event_id) AS run_no FROM c)
SELECT user_id, CAST(run_no AS BIGINT) AS run_no, any_value(event_type) AS event_type, count(*) AS n FROM r GROUP BY 1, 2""")
def w3(t):
    events = t.events.select("user_id", "event_id", "event_type")
    return keyed.consecutive_runs(events, ["user_id"], ["event_id"], "event_type")


@query("w4_every_kth", """
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS p FROM orders)
WHERE p >= 1 AND (p - 1) % 2 = 0""")
def w4(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return keyed.every_kth(orders, ["o_totalprice", "o_orderkey"], 2, start=1).select("o_orderkey")


@query("w5_running_sum", """
SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS BIGINT) AS cents
FROM orders""")
def w5(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("c"))
    return OrderedRows(orders, ["o_orderstatus"], ["o_orderkey"]).running_sum("c", "cents").select("o_orderkey", "cents")


@query("w6_moving_value", """
WITH RECURSIVE e AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events),
m AS (SELECT event_type, rn, event_id, value AS moving FROM e WHERE rn = 1
      UNION ALL SELECT e.event_type, e.rn, e.event_id, 0.99 * m.moving + 0.01 * e.value FROM m JOIN e
      ON e.event_type = m.event_type AND e.rn = m.rn + 1)
SELECT event_id, round(moving, 6) AS moving FROM m""")
def w6(t):
    smoothed = series.moving_value(
        t.events.select("event_type", "event_id", "value"), ["event_type"], ["event_id"], "value", 0.01
    )
    return smoothed.select("event_id", F.round("moving", 6).alias("moving"))


@query("w7_rank_in_group", """
SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer""")
def w7(t):
    customers = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    ranked = numbered(customers, ["c_mktsegment"], [F.desc("c_acctbal"), "c_custkey"], "place")
    return ranked.select("c_custkey", "place")


# ---- order -----------------------------------------------------------------


@query("k1_sort_descending", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""")
def k1(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return numbered(orders, (), [F.desc("o_totalprice"), "o_orderkey"], "place").orderBy("place")


@query("k2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def k2(t):
    return keyed.top_k(t.orders.select("o_orderkey", "o_totalprice"), F.col("o_totalprice"), "o_orderkey", 50)


@query("k3_bottom_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def k3(t):
    return keyed.bottom_k(t.orders.select("o_orderkey", "o_totalprice"), F.col("o_totalprice"), "o_orderkey", 50)


@query("k4_sort_by_text_key", """
SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS place FROM orders""")
def k4(t):
    return numbered(t.orders.select("o_orderkey"), (), [F.col("o_orderkey").cast("string")], "place")


@query("k4_sort_into_partitions", """
SELECT 7::INTEGER AS partitions, true AS inside, true AS across, count(*) AS n FROM orders""")
def k4_partitions(t):
    """Orders by their number as text, in exactly seven sorted ranges."""
    key = F.col("o_orderkey").cast("string")
    return keyed.layout_of(keyed.sort_by_key(t.orders.select("o_orderkey", "o_totalprice"), key, 7), key)


@query("k5_frequency_order", """
SELECT props, cnt, row_number() OVER (ORDER BY cnt, props) AS place FROM
(SELECT props, count(*) AS cnt FROM events GROUP BY props)""")
def k5(t):
    return numbered(keyed.count_by_value(t.events, "props"), (), ["cnt", "props"], "place")


@query("k6_sort_by_length", """
SELECT p_partkey, row_number() OVER (ORDER BY length(p_name), p_partkey) AS place FROM part""")
def k6(t):
    parts = t.part.select("p_partkey", "p_name")
    return numbered(parts, (), [F.length("p_name"), "p_partkey"], "place").select("p_partkey", "place")


@query("k7_sorted_distinct", """
SELECT p_name, row_number() OVER (ORDER BY p_name) AS place FROM (SELECT DISTINCT p_name FROM part)""")
def k7(t):
    return numbered(t.part.select("p_name").distinct(), (), ["p_name"], "place")


@query("k8_reverse", """
SELECT vec_id, embedding[64] AS first, embedding[1] AS last,
       row_number() OVER (ORDER BY vec_id DESC) AS place FROM embeddings""")
def k8(t):
    turned = t.embeddings.select("vec_id", F.reverse("embedding").alias("e"))
    placed = numbered(turned, (), [F.desc("vec_id")], "place")
    return placed.select("vec_id", F.col("e")[0].alias("first"), F.element_at("e", -1).alias("last"), "place")


@query("k9_best_by_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def k9(t):
    return keyed.best_by_key(
        t.orders.select("o_custkey", "o_totalprice", "o_orderkey"), "o_custkey", "o_totalprice", "o_orderkey"
    )


@query("k10_insertion_points", """
SELECT o_orderkey, (SELECT count(*) FROM part WHERE p_retailprice * 300 <= o_totalprice) AS position FROM orders""")
def k10(t):
    return keyed.insertion_points(
        t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice",
        t.part.select((F.col("p_retailprice") * 300).alias("v")), "v",
    ).select("o_orderkey", "position")


# ---- sets ------------------------------------------------------------------


def status(t, code):
    return t.orders.where(F.col("o_orderstatus") == code).select("o_custkey")


@query("u1_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def u1(t):
    return t.events.select("user_id", "event_type").distinct()


@query("u2_union_all", "SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def u2(t):
    return keyed.union_all(
        t.customer.select(F.col("c_nationkey").alias("nationkey")), t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    )


@query("u3_intersection", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def u3(t):
    return keyed.intersection(status(t, "F"), status(t, "P"))


@query("u4_subtract", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def u4(t):
    return keyed.minus_all(status(t, "F"), status(t, "P"))


@query("u5_symmetric_difference", """
(SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def u5(t):
    return keyed.symmetric_difference(status(t, "F"), status(t, "P"))


@query("u5_array_algebra", """
SELECT p_partkey, array_to_string(list_sort(list_distinct(a || b)), ',') AS either,
       array_to_string(list_sort(list_distinct(list_filter(a, lambda x: list_contains(b, x)))), ',') AS common,
       array_to_string(list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x)))), ',') AS only_first
FROM (SELECT p_partkey, string_split(p_name, '') AS a, string_split(lower(p_type), '') AS b FROM part)""")
def u5_arrays(t):
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    a, b = chars(F.col("p_name")), chars(F.lower("p_type"))
    show = lambda arr: F.array_join(F.array_sort(arr), ",")
    return t.part.select(
        "p_partkey", show(F.array_union(a, b)).alias("either"), show(F.array_intersect(a, b)).alias("common"),
        show(F.array_except(a, b)).alias("only_first"),
    )


@query("u6_set_relations", """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey AS k FROM customer),
x AS (SELECT count(*) AS n FROM a WHERE k NOT IN (SELECT k FROM b)), y AS (SELECT count(*) AS n FROM b WHERE k NOT IN (SELECT k FROM a))
SELECT x.n = 0 AS is_subset, y.n = 0 AS is_superset, x.n = 0 AND y.n = 0 AS is_equal FROM x, y""")
def u6(t):
    return keyed.set_relations(
        t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))
    )


@query("u7_equal_types", """
SELECT CAST(c_nationkey AS BIGINT) AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier""")
def u7(t):
    left, right = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_suppkey").alias("k"))
    try:
        return keyed.union_all(left, right)  # int and bigint: refused
    except TypeError:
        return keyed.union_all(left.select(F.col("k").cast("bigint")), right)


# ---- user functions over aggregates and generators -------------------------


@query("d2_three_function_aggregate", """
SELECT user_id, round(sum(value), 4) AS total, count(*) AS n FROM events GROUP BY user_id""")
def d2(t):
    acc = keyed.combine_by_key(
        t.events, "user_id", "value",
        lambda v: (v, 1), lambda a, v: (a[0] + v, a[1] + 1), lambda a, b: (a[0] + b[0], a[1] + b[1]), width=2,
    )
    return acc.select(
        "user_id", F.round(F.col("acc")[0], 4).alias("total"), F.col("acc")[1].cast("bigint").alias("n")
    )


@query("d3_one_to_many", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def d3(t):
    return keyed.flat_map(t.part, F.split("p_name", " "), "word").select("p_partkey", "word")
