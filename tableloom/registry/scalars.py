"""Scalar functions: text, dates, numbers, arrays, maps, JSON, casts, hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions import scalars as sc
from tableloom.functions import text as tx
from tableloom.operators import bayes as nb
from tableloom.plans.placement import well_spread
from tableloom.plans.skew import join_small
from tableloom.registry import query
from tableloom.registry.bayes import ISOLATE, sql_text


def digest_of(t, column):
    return t.documents.select(
        "doc_id", column(F.col("text")).alias("x")
    ).select("doc_id", F.length("x").cast("bigint").alias("n"), F.md5("x").alias("digest"))


def digest_sql(expression: str) -> str:
    return f"SELECT doc_id, length(x) AS n, md5(x) AS digest FROM (SELECT doc_id, {expression} AS x FROM documents)"


@query("f1_isolate_symbols", digest_sql(ISOLATE))
def f1(t):
    return digest_of(t, tx.isolate_symbols)


@query("f2_blank_symbols", digest_sql(f"translate(text, {sql_text(tx.SYMBOLS)}, '{' ' * len(tx.SYMBOLS)}')"))
def f2(t):
    return digest_of(t, tx.blank_symbols)


@query("f3_delete_symbols", digest_sql(f"translate(text, {sql_text(tx.PUNCTUATION + 'ß«')}, '')"))
def f3(t):
    return digest_of(t, lambda c: tx.delete_symbols(c, "ß«"))


@query("f4_strip_and_title", """
SELECT p_partkey, array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(p_name, ' ')], ' ') AS name FROM part""")
def f4(t):
    padded = F.concat(F.lit(" "), F.upper("p_name"), F.lit("!#? "))
    return t.part.select("p_partkey", tx.title_case(tx.delete_marks(tx.strip(padded))).alias("name"))


@query("f5_split_keeps_empty", """
SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = '')) AS n_empty
FROM (SELECT doc_id, string_split(replace(text, '.', '  '), ' ') AS w FROM documents)""")
def f5(t):
    w = tx.words(F.replace("text", F.lit("."), F.lit("  ")))
    return t.documents.select("doc_id", w.alias("w")).select(
        "doc_id", F.size("w").cast("bigint").alias("n"),
        F.size(F.filter("w", lambda x: x == "")).cast("bigint").alias("n_empty"),
    )


@query("f6_split_on_separators", """
SELECT page_id, split_part(url, '/', 3) AS host, array_to_string(string_split(split_part(url, '/', 3), '.'), '|') AS labels,
       len(string_split(url, '/')) AS n_parts FROM pages""")
def f6(t):
    host = F.split_part("url", F.lit("/"), F.lit(3))
    return t.pages.select(
        "page_id", host.alias("host"), F.array_join(F.split(host, "[.]"), "|").alias("labels"),
        F.size(F.split("url", "/")).cast("bigint").alias("n_parts"),
    )


@query("f7_upper", "SELECT p_partkey, upper(p_name) AS name FROM part")
def f7(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("name"))


@query("f8_count_character", """
SELECT p_partkey, p_name, length(p_name) - length(replace(p_name, 'e', '')) AS n FROM part
WHERE length(p_name) - length(replace(p_name, 'e', '')) >= 2""")
def f8(t):
    n = tx.count_char(F.col("p_name"), "e")
    return t.part.where(n >= 2).select("p_partkey", "p_name", n.cast("bigint").alias("n"))


@query("f9_code_points", """
SELECT p_partkey, array_to_string([ascii(c) for c in string_split(p_name, '')], ',') AS codes, p_name AS back FROM part""")
def f9(t):
    codes = tx.to_codes(F.col("p_name"))
    return t.part.select(
        "p_partkey", F.array_join(codes.cast("array<string>"), ",").alias("codes"), tx.from_codes(codes).alias("back")
    )


@query("f10_formatting", """
SELECT c_custkey, c_name || '/' || c_mktsegment || '/' || c_nationkey AS path, printf('%d-%s', c_custkey, c_name) AS label
FROM customer""")
def f10(t):
    return t.customer.select(
        "c_custkey", F.concat_ws("/", "c_name", "c_mktsegment", "c_nationkey").alias("path"),
        F.format_string("%d-%s", "c_custkey", "c_name").alias("label"),
    )


@query("f11_last_number", """
SELECT page_id, CAST(list_extract(regexp_extract_all(url, '[0-9]+'), -1) AS BIGINT) AS num FROM pages""")
def f11(t):
    return t.pages.select("page_id", tx.last_number(F.col("url")).alias("num"))


@query("f12_last_segment", """
SELECT page_id, list_extract(string_split(url, '/'), -1) AS segment, list_extract(string_split(url, '.'), -1) AS extension FROM pages""")
def f12(t):
    return t.pages.select(
        "page_id", F.substring_index("url", "/", -1).alias("segment"),
        F.substring_index("url", ".", -1).alias("extension"),
    )


@query("f13_dates", """
SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS built,
       strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders""")
def f13(t):
    d = F.col("o_orderdate")
    built = F.make_timestamp_ntz(F.year(d), F.month(d), F.day(d), F.hour(d), F.minute(d), F.second(d).cast("decimal(16,6)"))
    return t.orders.select(
        "o_orderkey", F.day(d).alias("day"), F.date_format(built, "yyyy-MM-dd HH:mm:ss").alias("built"),
        F.date_format(F.to_date(built), "yyyy-MM-dd").alias("date"),
    )


@query("f14_math", """
SELECT l_orderkey, l_linenumber, abs(l_discount - 0.05) AS distance, pow(l_quantity, 2) AS squared,
       round(sqrt(l_extendedprice), 6) AS root, round(exp(l_tax), 9) AS grown, round(l_quantity / 7, 3) AS share,
       CAST(trunc(l_extendedprice) AS BIGINT) AS whole FROM lineitem""")
def f14(t):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.abs(F.col("l_discount") - 0.05).alias("distance"), F.pow(q, F.lit(2)).alias("squared"),
        F.round(F.sqrt(p), 6).alias("root"), F.round(F.exp("l_tax"), 9).alias("grown"), F.round(q / 7, 3).alias("share"),
        p.cast("bigint").alias("whole"),
    )


@query("f15_floor_division", """
SELECT event_id, CAST(floor(cents / 7.0) AS BIGINT) AS quotient, CAST(floor(-cents / 7.0) AS BIGINT) AS negative,
       cents % 7 AS remainder, printf('%02d:%02d:%02d', cents // 3600, (cents // 60) % 60, cents % 60) AS clock
FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events)""")
def f15(t):
    cents = F.round(F.col("value") * 100).cast("bigint")
    return t.events.select("event_id", cents.alias("c")).select(
        "event_id", sc.floor_divide(F.col("c"), 7).alias("quotient"), sc.floor_divide(-F.col("c"), 7).alias("negative"),
        F.pmod("c", F.lit(7)).alias("remainder"), sc.clock(F.col("c")).alias("clock"),
    )


@query("f16_density", """
WITH m AS (SELECT l_returnflag, avg(l_quantity) AS mean, stddev_samp(l_quantity) AS sd FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(CASE WHEN mean = 0 OR sd = 0 THEN 1.0 ELSE
       exp(-pow(l_quantity - mean, 2) / (2 * sd * sd)) / (sqrt(2 * pi()) * sd) END, 9) AS density
FROM lineitem JOIN m USING (l_returnflag)""")
def f16(t):
    moments = t.lineitem.groupBy("l_returnflag").agg(
        F.avg("l_quantity").alias("mean"), F.stddev_samp("l_quantity").alias("sd")
    )
    density = nb.guarded_density(F.col("l_quantity"), F.col("mean"), F.col("sd"))
    return join_small(t.lineitem, moments, ["l_returnflag"]).select(
        "l_orderkey", "l_linenumber", F.round(density, 9).alias("density")
    )


@query("f17_rescale_to_bytes", """
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
e AS (SELECT min(v) AS lo, max(v) AS hi FROM x)
SELECT vec_id, pos, CAST(trunc((v - lo) / (hi - lo) * 255) AS INTEGER) AS byte FROM x, e""")
def f17(t):
    cells = t.embeddings.select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "v"))
    return sc.to_bytes(cells, "v", "byte").select("vec_id", F.col("pos").cast("bigint").alias("pos"), "byte")


@query("f18_index_and_slice", """
SELECT vec_id, embedding[1] AS first, embedding[-1] AS last, list_sum([CAST(x AS DOUBLE) for x in embedding[3:6]]) AS part,
       CAST(len(embedding[1:64:4]) AS BIGINT) AS n_stepped, embedding[1:64:4][2] AS second_step FROM embeddings""")
def f18(t):
    e = F.col("embedding")
    stepped = sc.every(e, 4)
    return t.embeddings.select(
        "vec_id", F.element_at(e, 1).alias("first"), F.element_at(e, -1).alias("last"),
        sc.array_sum(F.slice(e, 3, 4).cast("array<double>")).alias("part"),
        F.size(stepped).cast("bigint").alias("n_stepped"), stepped[1].alias("second_step"),
    )


NAME = "string_split(p_name, ' ')"


@query("f19_concat_and_repeat", f"""
SELECT p_partkey, array_to_string({NAME} || [p_type, p_brand], ',') AS joined,
       array_to_string({NAME} || {NAME} || {NAME}, ',') AS tripled FROM part""")
def f19(t):
    w = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", F.array_join(F.concat(w, F.array("p_type", "p_brand")), ",").alias("joined"),
        F.array_join(sc.repeated(w, 3), ",").alias("tripled"),
    )


@query("f20_array_edits", """
SELECT p_partkey, array_to_string(w || ['end'], ',') AS appended, array_to_string([w[1], 'mid'] || w[2:], ',') AS inserted,
       array_to_string(w[2:], ',') AS popped, array_to_string(w || w[2:], ',') AS removed,
       array_to_string(['a', 'b', 'c'] || w[2:], ',') AS replaced
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""")
def f20(t):
    w = F.col("w")
    show = lambda a: F.array_join(a, ",")
    return t.part.select("p_partkey", F.split("p_name", " ").alias("w")).select(
        "p_partkey",
        show(F.array_append(w, F.lit("end"))).alias("appended"),
        show(F.array_insert(w, 2, F.lit("mid"))).alias("inserted"),
        show(sc.pop_at(w, 0)).alias("popped"),
        # the first word occurs twice when the halves differ; only one goes
        show(F.concat(w, sc.remove_first(w, w[0]))).alias("removed"),
        show(sc.replace_slice(w, 0, 1, F.array(F.lit("a"), F.lit("b"), F.lit("c")))).alias("replaced"),
    )


@query("f21_membership", f"""
SELECT p_partkey, list_contains({NAME}, 'red') AS has_red,
       len(list_filter(string_split(p_name, ''), lambda c: c = 'e')) AS n_e FROM part""")
def f21(t):
    return t.part.select(
        "p_partkey", F.array_contains(F.split("p_name", " "), "red").alias("has_red"),
        sc.count_of(F.split("p_name", ""), "e").cast("bigint").alias("n_e"),
    )


@query("f22_array_sum_and_mean", """
SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 9) AS total, round(list_avg(CAST(embedding AS DOUBLE[])), 9) AS mean
FROM embeddings""")
def f22(t):
    e = F.col("embedding").cast("array<double>")
    return t.embeddings.select(
        "vec_id", F.round(sc.array_sum(e), 9).alias("total"), F.round(sc.array_mean(e), 9).alias("mean")
    )


@query("f23_array_creation", """
SELECT p_partkey, array_to_string([0 for i in range(p_size)], ',') AS zeros, array_to_string([1 for i in range(p_size)], ',') AS ones,
       array_to_string(range(p_size), ',') AS counted, CAST(p_size AS BIGINT) AS trace,
       array_to_string([i * (p_size + 1) for i in range(p_size)], ',') AS diagonal,
       array_to_string([CAST(i AS DOUBLE) for i in range(p_size)], ',') AS cast_up FROM part""")
def f23(t):
    n = F.col("p_size").cast("bigint")
    count = F.sequence(F.lit(0).cast("bigint"), n - 1)
    show = lambda a: F.array_join(a.cast("array<string>"), ",")
    table = F.transform(count, lambda i: F.sequence(i * n, i * n + n - 1))  # n by n cells, row by row
    below_one = F.filter(F.array(F.lit(0).cast("bigint")), lambda x: n < x)  # sizes without such a table
    diagonal = F.when(n > 0, F.transform(table, lambda row, i: F.get(row, i))).when(n <= 0, below_one)
    trace = F.aggregate(sc.identity_cells(n), F.lit(0.0), lambda a, c: a + c["value"])
    return well_spread(t.part.select("p_partkey", "p_size")).select(
        "p_partkey", show(F.array_repeat(F.lit(0), F.col("p_size"))).alias("zeros"),
        show(F.array_repeat(F.lit(1), F.col("p_size"))).alias("ones"), show(count).alias("counted"),
        trace.cast("bigint").alias("trace"), show(diagonal).alias("diagonal"),
        show(count.cast("array<double>")).alias("cast_up"),
    )


@query("f24_map_build_and_read", """
SELECT p_partkey, p_brand AS brand, CAST(NULL AS VARCHAR) AS missing, true AS has_type, 'brand,name,type' AS keys,
       p_brand || ',' || p_name || ',' || p_type AS vals FROM part""")
def f24(t):
    m = F.map_from_arrays(
        F.array(F.lit("brand"), F.lit("name"), F.lit("type")), F.array("p_brand", "p_name", "p_type")
    )
    return t.part.select("p_partkey", m.alias("m")).select(
        "p_partkey", F.element_at("m", F.lit("brand")).alias("brand"), F.element_at("m", F.lit("size")).alias("missing"),
        F.map_contains_key("m", "type").alias("has_type"), F.array_join(F.map_keys("m"), ",").alias("keys"),
        F.array_join(F.map_values("m"), ",").alias("vals"),
    )


@query("f25_map_merge", """
SELECT p_partkey, 'brand=' || p_type || ',name=' || p_name || ',size=' || p_size AS entries FROM part""")
def f25(t):
    left = F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand")
    right = F.create_map(F.lit("brand"), F.col("p_type"), F.lit("size"), F.col("p_size").cast("string"))
    entries = F.array_sort(
        F.transform(F.map_entries(sc.merged(left, right)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    )
    return t.part.select("p_partkey", F.array_join(entries, ",").alias("entries"))


@query("f26_map_delete", "SELECT p_partkey, 'name' AS keys, p_name AS vals FROM part")
def f26(t):
    m = F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand")
    left = sc.without_key(m, "brand")
    return t.part.select(
        "p_partkey", F.array_join(F.map_keys(left), ",").alias("keys"), F.array_join(F.map_values(left), ",").alias("vals")
    )


@query("f27_map_default", """
SELECT event_id, CASE event_type WHEN 'error' THEN 3 WHEN 'click' THEN 1 ELSE 0 END AS weight FROM events""")
def f27(t):
    weights = F.create_map(F.lit("error"), F.lit(3), F.lit("click"), F.lit(1))
    return t.events.select("event_id", sc.get_or(weights, F.col("event_type"), 0).alias("weight"))


@query("f28_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, '{"k":' || json_extract(props, '$.k') || '}' AS compact FROM events""")
def f28(t):
    parsed = F.from_json("props", "k int")
    return t.events.select(
        "event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("compact")
    )


@query("f29_conditional", """
SELECT event_id, CASE WHEN value >= 100 THEN 'large' ELSE 'small' END AS size FROM events""")
def f29(t):
    return t.events.select("event_id", F.when(F.col("value") >= 100, "large").otherwise("small").alias("size"))


@query("f30_cast_or_keep", """
SELECT page_id, CASE WHEN TRY_CAST(seg AS DOUBLE) IS NULL THEN seg ELSE CAST(CAST(seg AS DOUBLE) AS VARCHAR) END AS kept,
       TRY_CAST(seg AS DOUBLE) AS num
FROM (SELECT page_id, unnest([split_part(split_part(url, '/', 5), '?', 1), split_part(url, '/', 4)]) AS seg FROM pages)""")
def f30(t):
    parts = F.array(
        F.split_part(F.split_part("url", F.lit("/"), F.lit(5)), F.lit("?"), F.lit(1)),
        F.split_part("url", F.lit("/"), F.lit(4)),
    )
    return t.pages.select("page_id", F.explode(parts).alias("seg")).select(
        "page_id", sc.to_float_or_keep(F.col("seg")).alias("kept"), F.col("seg").try_cast("double").alias("num")
    )


@query("f31_stable_hash", """
SELECT split_part(url, '/', 3) AS host, count(*) AS n, count(DISTINCT url) AS n_hashes, 1::BIGINT AS n_buckets FROM pages GROUP BY 1""")
def f31(t):
    """Equal values hash alike: one bucket per host, one hash per address."""
    host = F.parse_url("url", F.lit("HOST"))
    hashed = t.pages.select(
        host.alias("host"), F.xxhash64("url").alias("h"), F.pmod(F.xxhash64(host), F.lit(20)).alias("bucket")
    )
    per_hash = hashed.groupBy("host", "h").agg(F.count("*").alias("n"), F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    spread = F.max("hi") - F.min("lo") + 1
    return per_hash.groupBy("host").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_hashes"), spread.alias("n_buckets")
    )


@query("f32_type_names", """
SELECT DISTINCT lower(typeof(event_id)) AS id_type, lower(typeof(value)) AS value_type,
       typeof(props) = 'VARCHAR' AS props_is_text FROM events""")
def f32(t):
    return t.events.select(
        F.typeof("event_id").alias("id_type"), F.typeof("value").alias("value_type"),
        sc.is_type(F.col("props"), "string").alias("props_is_text"),
    ).distinct()


@query("s14_class_name_codes", """
SELECT l_returnflag AS name, CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS code,
       count(*) AS n FROM lineitem GROUP BY 1""")
def s14(t):
    code = sc.encode_names(F.col("l_returnflag"), ("A", "N", "R"))
    return t.lineitem.select(F.col("l_returnflag").alias("name"), code.alias("code")).groupBy("name", "code").agg(
        F.count("*").alias("n")
    )
