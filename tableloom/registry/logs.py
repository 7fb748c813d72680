"""Log frequencies, and sampling from repeatable draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions.draws import draw, draw_below
from tableloom.operators import logs, sampling
from tableloom.plans.ordered import numbered
from tableloom.registry import query, sql_draw


def key_of(props="props"):
    return F.get_json_object(props, "$.k")


@query("l1_name_frequency", """
SELECT event_type AS name, count(*) AS cnt FROM events WHERE event_type IS NOT NULL AND event_type <> ' ' GROUP BY 1""")
def l1(t):
    return logs.name_frequency(t.events, F.col("event_type"))


@query("l2_agent_frequency", """
SELECT json_extract_string(props, '$.k') AS name, count(*) AS cnt FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1""")
def l2(t):
    return logs.name_frequency(t.events, key_of())


@query("l3_frequency_order", """
SELECT name, cnt, row_number() OVER (ORDER BY cnt, name) AS place FROM
(SELECT json_extract_string(props, '$.k') AS name, count(*) AS cnt FROM events GROUP BY 1)""")
def l3(t):
    return logs.by_frequency(logs.name_frequency(t.events, key_of()))


@query("l3_distinct_names", "SELECT DISTINCT json_extract_string(props, '$.k') AS name FROM events")
def l3_names(t):
    return t.events.where(logs.present(key_of())).select(key_of().alias("name")).distinct()


@query("l4_layer_counts", """
SELECT count(*) FILTER (WHERE event_type = 'error') AS error, count(*) FILTER (WHERE event_type = 'click') AS click,
       count(json_extract_string(props, '$.k')) AS keyed, count(json_extract_string(props, '$.z')) AS absent FROM events""")
def l4(t):
    kind = F.col("event_type")
    return logs.layer_counts(
        t.events, error=F.when(kind == "error", 1), click=F.when(kind == "click", 1), keyed=key_of(),
        absent=F.get_json_object("props", "$.z"),
    )


@query("l5_first_match", """
SELECT event_id, user_id FROM events WHERE event_type = 'error' AND json_extract_string(props, '$.k') = '7' ORDER BY ts, event_id LIMIT 1""")
def l5(t):
    found = logs.first_match(t.events, (F.col("event_type") == "error") & (key_of() == "7"), "ts", "event_id")
    return found.select("event_id", "user_id")


@query("s27_filtered_scan", """
SELECT event_id, event_type FROM events WHERE props IS NOT NULL AND event_type = 'purchase'""")
def s27(t):
    return t.events.where("props is not null and event_type = 'purchase'").select("event_id", "event_type")


# ---- sampling --------------------------------------------------------------

SPLIT = sql_draw(64, "'split'", "doc_id")


@query("r1_exact_split", f"""
SELECT doc_id, row_number() OVER (ORDER BY {SPLIT}, doc_id) <= floor(count(*) OVER () * 0.67) AS is_train FROM labels""")
def r1(t):
    return sampling.split_exact(t.labels.select("doc_id"), "doc_id", 0.67, 64)


@query("r1_split_by_class", f"""
SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {SPLIT}, doc_id)
       <= floor(count(*) OVER (PARTITION BY quality) * 0.67) AS is_train FROM labels""")
def r1_by_class(t):
    return sampling.split_exact_by(t.labels.select("doc_id", "quality"), "doc_id", "quality", 0.67, 64)


@query("r2_bernoulli", f"""
SELECT event_id, value FROM events WHERE {sql_draw(64, "'bernoulli'", 'event_id')} % 100 = 0""")
def r2(t):
    return sampling.bernoulli(t.events.select("event_id", "value"), "event_id", 100, 64)


@query("r3_bursts", f"""
WITH e AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events),
s AS (SELECT pos AS run_start FROM e WHERE pos = 0 OR {sql_draw(64, "'burst'", 'pos')} % 10000 = 0)
SELECT event_id, pos, run_start FROM s JOIN e ON pos BETWEEN run_start AND run_start + 99""")
def r3(t):
    return sampling.bursts(t.events.select("event_id"), ["event_id"], 100, 10_000, 64)


@query("r4_uniform_pick", f"""
WITH e AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
z AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
d AS (SELECT e.o_custkey, rn AS slot, {sql_draw(64, "'pick'", 'e.o_custkey', 'rn')} % n + 1 AS rn FROM e JOIN z USING (o_custkey))
SELECT d.o_custkey, d.slot, e.o_orderkey FROM d JOIN e ON d.o_custkey = e.o_custkey AND d.rn = e.rn""")
def r4(t):
    orders = t.orders.select("o_custkey", "o_orderkey")
    rows = numbered(orders, ["o_custkey"], ["o_orderkey"])
    sizes = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    slots = rows.select("o_custkey", F.col("rn").alias("slot"))
    return sampling.pick_uniform(rows, slots, sizes, "o_custkey", 64).select("o_custkey", "slot", "o_orderkey")


@query("r5_shuffle", f"""
SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY {sql_draw(64, "'shuffle'", 'c_custkey')}, c_custkey) AS rn
FROM customer""")
def r5(t):
    order = sampling.shuffled(t.customer.select("c_custkey", "c_nationkey"), "c_custkey", 64, ["c_nationkey"])
    return order.select("c_custkey", "rn")


@query("r6_seeded_draws", f"""
SELECT c_custkey, {sql_draw(64, "'bit'", 'c_custkey')} % 2 AS bit, {sql_draw(64, "'code'", 'c_custkey')} % 255 + 1 AS code,
       {sql_draw(64, "'raw'", 'c_custkey')} AS raw FROM customer""")
def r6(t):
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", draw_below(2, 64, "bit", k).alias("bit"), (draw_below(255, 64, "code", k) + 1).alias("code"),
        draw(64, "raw", k).alias("raw"),
    )
