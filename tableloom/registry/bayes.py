"""Text and numeric naive Bayes over documents, labels, lineitem and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions import text as tx
from tableloom.operators import bayes as nb
from tableloom.operators.sampling import split_exact
from tableloom.plans.scratch import materialize
from tableloom.registry import query, sql_draw

SEED = 64
RATIO = 0.67


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ISOLATE = f"regexp_replace(text, {sql_text('(' + tx.symbol_class(tx.SYMBOLS) + ')')}, ' \\1 ', 'g')"
TOKENS = f"string_split({ISOLATE}, ' ')"

CORPUS = f"""
corpus AS (SELECT doc_id, generate_subscripts(tk, 1) - 1 AS pos, unnest(tk) AS token
           FROM (SELECT doc_id, {TOKENS} AS tk FROM documents)),
vocab AS (SELECT token, cnt, row_number() OVER (ORDER BY d, p) - 1 AS idx
          FROM (SELECT token, count(*) AS cnt, min(doc_id) AS d, arg_min(pos, doc_id * 1000000 + pos) AS p
                FROM corpus GROUP BY token))
"""

SPLIT = f"""
numbered AS (SELECT doc_id, quality AS label,
                    row_number() OVER (ORDER BY {sql_draw(SEED, "'split'", 'doc_id')}, doc_id) AS rn,
                    count(*) OVER () AS n FROM labels),
marked AS (SELECT doc_id, label, rn <= floor(n * {RATIO}) AS is_train FROM numbered),
known AS (SELECT m.* FROM marked m JOIN documents d USING (doc_id)),
tok AS (SELECT d.doc_id, m.label, m.is_train, unnest({TOKENS.replace('text', 'd.text')}) AS token
        FROM documents d JOIN marked m USING (doc_id)),
allcnt AS (SELECT doc_id, label, is_train, token, count(*) AS cnt FROM tok GROUP BY ALL),
"""

LOG0 = "(CASE WHEN mean <> 0 AND sd <> 0 THEN -0.5 * (mean / sd) * (mean / sd) - ln(sd) - 0.9189385332046727 ELSE 0 END)"
LOGX = (
    "(CASE WHEN mean <> 0 AND sd <> 0 THEN -0.5 * ((cnt - mean) / sd) * ((cnt - mean) / sd) - ln(sd)"
    " - 0.9189385332046727 ELSE 0 END)"
)


def model_sql(ddof: int) -> str:
    """CTEs from ``cnt`` (counts in use) to ``predicted``."""
    variance = f"CAST(n * s2 - s1 * s1 AS DOUBLE) / nullif(CAST(n * (n - {ddof}) AS DOUBLE), 0)"
    return f"""
sizes AS (SELECT label, count(*) AS n FROM known WHERE is_train GROUP BY label),
model AS (SELECT label, token, CAST(s1 AS DOUBLE) / n AS mean, sqrt({variance}) AS sd
          FROM (SELECT label, token, sum(cnt) AS s1, sum(cnt * cnt) AS s2 FROM cnt WHERE is_train
                GROUP BY label, token) JOIN sizes USING (label)),
base AS (SELECT label, sum({LOG0}) AS base FROM model GROUP BY label),
delta AS (SELECT c.doc_id, m.label, sum({LOGX} - {LOG0}) AS delta
          FROM cnt c JOIN model m USING (token) WHERE NOT c.is_train GROUP BY 1, 2),
scores AS (SELECT k.doc_id, b.label, b.base + coalesce(x.delta, 0) AS score
           FROM known k CROSS JOIN base b LEFT JOIN delta x ON x.doc_id = k.doc_id AND x.label = b.label
           WHERE NOT k.is_train),
predicted AS (SELECT doc_id, label AS predicted FROM
              (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r FROM scores)
              WHERE r = 1),
result AS (SELECT k.doc_id, k.label, p.predicted FROM known k JOIN predicted p USING (doc_id))
"""


SPARSE = "WITH " + SPLIT + "cnt AS (SELECT * FROM allcnt)," + model_sql(0)
DENSE = (
    "WITH " + SPLIT
    + f"""firstword AS (SELECT {TOKENS}[1] AS w FROM documents JOIN marked USING (doc_id) ORDER BY doc_id LIMIT 1),
cnt AS (SELECT * FROM allcnt WHERE token <> (SELECT w FROM firstword)),"""
    + model_sql(1)
)


def marked(t):
    return split_exact(t.labels.select("doc_id", F.col("quality").alias("label")), "doc_id", RATIO, SEED)


def train_counts(t):
    labelled = nb.labelled_texts(t.documents, marked(t))
    return materialize(nb.token_counts(labelled, placed=True)), labelled.select("doc_id", "label", "is_train")


def class_sizes(known):
    return known.where("is_train").groupBy("label").agg(F.count("*").alias("n"))


@query("b1_tokens", f"""
SELECT doc_id, len(tk) AS n_tokens, len(list_filter(tk, lambda x: x = '')) AS n_empty,
       md5(array_to_string(tk, '|')) AS digest
FROM (SELECT doc_id, {TOKENS} AS tk FROM documents)""")
def b1(t):
    tk = F.col("tk")
    return t.documents.select("doc_id", tx.tokens(F.col("text")).alias("tk")).select(
        "doc_id",
        F.size(tk).cast("bigint").alias("n_tokens"),
        F.size(F.filter(tk, lambda x: x == "")).cast("bigint").alias("n_empty"),
        F.md5(F.array_join(tk, "|")).alias("digest"),
    )


@query("b2_token_counts", f"""
SELECT token, count(*) AS cnt FROM (SELECT unnest({TOKENS}) AS token FROM documents) GROUP BY token""")
def b2(t):
    words = nb.token_rows(t.documents.select("text"))
    return words.groupBy("token").agg(F.count("*").alias("cnt"))


@query("b3_vocabulary_index", f"WITH {CORPUS} SELECT token, cnt, idx FROM vocab")
def b3(t):
    return nb.vocabulary(nb.token_counts(t.documents.select("doc_id", "text")))


@query("b4_dense_vectors", f"""
WITH {CORPUS}, v AS (SELECT doc_id, idx, count(*) AS cnt FROM corpus JOIN vocab USING (token)
                     WHERE idx > 0 GROUP BY ALL)
SELECT doc_id, count(*) AS n_cells, CAST(sum(cnt) AS BIGINT) AS total,
       CAST(sum(cnt * (idx % 1009)) AS BIGINT) AS checksum FROM v GROUP BY doc_id""")
def b4(t):
    counts = materialize(nb.token_counts(t.documents.select("doc_id", "text")))
    vectors = nb.count_vectors(counts, nb.vocabulary(counts), dense=True)
    return vectors.groupBy("doc_id").agg(
        F.count("*").alias("n_cells"),
        F.sum("cnt").alias("total"),
        F.sum(F.col("cnt") * (F.col("idx") % 1009)).alias("checksum"),
    )


@query("b5_sparse_vectors", f"""
WITH {CORPUS} SELECT doc_id, idx, count(*) AS cnt FROM corpus JOIN vocab USING (token) GROUP BY ALL""")
def b5(t):
    counts = materialize(nb.token_counts(t.documents.select("doc_id", "text")))
    return nb.count_vectors(counts, nb.vocabulary(counts)).drop("first")


NAMED = "CASE WHEN quality = 1 THEN 'ham' WHEN toxic = 1 THEN 'toxic' ELSE 'spam' END"


@query("b6_label_encoding", f"""
SELECT doc_id, name, CAST(CASE WHEN name = 'ham' THEN 0 ELSE 1 END AS INTEGER) AS code
FROM (SELECT doc_id, {NAMED} AS name FROM labels)""")
def b6(t):
    named = t.labels.select("doc_id", F.expr(NAMED).alias("name"))
    return named.withColumn("code", nb.encode_label(F.col("name")))


@query("b7_network_tokens", """
SELECT page_id, len(tk) AS n_tokens, array_to_string(tk, ' ') AS line FROM (
  SELECT page_id, list_concat(list_concat(string_split(replace(seg, '-', '.'), '.'), string_split(host, '.')),
         CASE WHEN page_id % 3 <> 0 THEN string_split(host, '.') ELSE string_split(host, '') END) AS tk
  FROM (SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS seg FROM pages))""")
def b7(t):
    host = F.split_part("url", F.lit("/"), F.lit(3))
    fields = t.pages.select(
        "page_id",
        F.replace(F.split_part("url", F.lit("/"), F.lit(4)), F.lit("-"), F.lit(".")).alias("ip"),
        F.concat(F.lit("u@"), host).alias("address"),
        F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("<m@"), host, F.lit(">")))
        .otherwise(host).alias("message_id"),
    )
    tk = tx.network_tokens(F.col("ip"), F.col("address"), F.col("message_id"))
    return fields.select(
        "page_id", F.size(tk).cast("bigint").alias("n_tokens"), F.array_join(tk, " ").alias("line")
    )


@query("b8_rows_by_class", """
SELECT label, count(*) AS n, count(d.doc_id) AS n_docs, CAST(sum(length(d.text)) AS BIGINT) AS n_chars
FROM (SELECT doc_id, quality AS label FROM labels) LEFT JOIN documents d USING (doc_id) GROUP BY label""")
def b8(t):
    rows = t.labels.select("doc_id", F.col("quality").alias("label")).join(
        t.documents.select("doc_id", "text", F.lit(1).alias("here")), "doc_id", "left"
    )
    return rows.groupBy("label").agg(
        F.count("*").alias("n"),
        F.count("here").alias("n_docs"),
        F.sum(F.length("text").cast("bigint")).alias("n_chars"),
    )


LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def line_rows(t):
    return t.lineitem.select(
        F.col("l_returnflag").alias("label"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_id"),
        F.array(*LINE_FEATURES).alias("features"),
    )


@query("b9_numeric_summaries", """
SELECT l_returnflag AS label, CAST(feature AS INTEGER) AS feature, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS sd
FROM (SELECT l_returnflag, unnest([0, 1, 2, 3]) AS feature,
             unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS x FROM lineitem) GROUP BY 1, 2""")
def b9(t):
    return nb.train_numeric(line_rows(t)).select(
        "label", "feature", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd")
    )


@query("b9_embedding_summaries", """
SELECT label, CAST(feature AS INTEGER) AS feature, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS sd
FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS feature,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY 1, 2""")
def b9_embeddings(t):
    rows = t.embeddings.select("label", F.col("embedding").cast("array<double>").alias("features"))
    return nb.train_numeric(rows).select(
        "label", "feature", F.round("mean", 9).alias("mean"), F.round("sd", 9).alias("sd")
    )


@query("b10_sparse_summaries", SPARSE + """
SELECT label, token, round(mean, 9) AS mean, round(sd, 9) AS sd FROM model""")
def b10(t):
    counts, known = train_counts(t)
    model = nb.train_text(counts.where("is_train"), class_sizes(known))
    return model.select("label", "token", F.round("mean", 9).alias("mean"), F.round("sd", 9).alias("sd"))


@query("b11_class_scores", SPARSE + "SELECT doc_id, label, round(score, 3) AS score FROM scores")
def b11(t):
    counts, known = train_counts(t)
    fitted = nb.TextBayes().fit(counts.where("is_train"), class_sizes(known))
    scores = fitted.scores(counts.where("not is_train"), known.where("not is_train"))
    return scores.select("doc_id", "label", F.round("score", 3).alias("score"))


@query("b12_best_class", SPARSE + "SELECT doc_id, predicted FROM predicted")
def b12(t):
    counts, known = train_counts(t)
    fitted = nb.TextBayes().fit(counts.where("is_train"), class_sizes(known))
    return fitted.predict(counts.where("not is_train"), known.where("not is_train"))


@query("b13_batch_predictions", SPARSE + "SELECT doc_id, label, predicted FROM result")
def b13(t):
    return nb.holdout_text(t.documents, marked(t))


ACCURACY = "round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END) * 100, 9) AS accuracy"


@query("b14_accuracy", SPARSE + f"SELECT {ACCURACY} FROM result")
def b14(t):
    return nb.accuracy(nb.holdout_text(t.documents, marked(t))).select(
        F.round("accuracy", 9).alias("accuracy")
    )


@query("b15_flipped_predictions", SPARSE + """
SELECT doc_id, CASE WHEN predicted = 0 THEN 1 ELSE 0 END AS flipped FROM result""")
def b15(t):
    flipped = F.when(F.col("predicted") == 0, 1).otherwise(0)
    return nb.holdout_text(t.documents, marked(t)).select("doc_id", flipped.alias("flipped"))


@query("b16_sparse_text_holdout", SPARSE + """
SELECT label, predicted, count(*) AS n FROM result GROUP BY 1, 2""")
def b16_sparse(t):
    return nb.confusion(nb.holdout_text(t.documents, marked(t)))


@query("b16_dense_text_holdout", DENSE + """
SELECT label, predicted, count(*) AS n FROM result GROUP BY 1, 2""")
def b16_dense(t):
    return nb.confusion(nb.holdout_text(t.documents, marked(t), dense=True))


@query("b16_refit_and_score", f"""
WITH marked AS (SELECT d.doc_id, l.quality AS label, l.quality IS NOT NULL AS is_train
                FROM documents d LEFT JOIN labels l USING (doc_id)),
known AS (SELECT * FROM marked),
tok AS (SELECT d.doc_id, m.label, m.is_train, unnest({TOKENS.replace('text', 'd.text')}) AS token
        FROM documents d JOIN marked m USING (doc_id)),
cnt AS (SELECT doc_id, label, is_train, token, count(*) AS cnt FROM tok GROUP BY ALL),""" + model_sql(0) + """
SELECT row_number() OVER (ORDER BY doc_id) AS row_no,
       CASE WHEN predicted = 0 THEN 'ham' ELSE 'spam' END AS label FROM predicted""")
def b16_refit(t):
    """Train on every labelled document, score the unlabelled ones, number the output."""
    from tableloom.sources.writers import numbered_predictions

    everything = t.documents.select("doc_id").join(
        t.labels.select("doc_id", F.col("quality").alias("label")), "doc_id", "left"
    ).withColumn("is_train", F.col("label").isNotNull())
    return numbered_predictions(nb.holdout_text(t.documents, everything), "doc_id")


NETWORK = f"""
fields AS (SELECT page_id AS doc_id, CASE WHEN split_part(url, '/', 4) = 'en' THEN 0 ELSE 1 END AS label,
           list_concat(string_split(replace(split_part(url, '/', 5), '?', '.'), '.'), list_concat(string_split(split_part(url, '/', 3), '.'),
                       string_split(split_part(url, '/', 3), '.'))) AS tk FROM pages),
known AS (SELECT doc_id, label, row_number() OVER (ORDER BY {sql_draw(SEED, "'split'", 'doc_id')}, doc_id)
          <= floor(count(*) OVER () * {RATIO}) AS is_train FROM fields),
tok AS (SELECT doc_id, k.label, is_train, unnest(tk) AS token FROM fields JOIN known k USING (doc_id)),
"""


def network_rows(t):
    host = F.split_part("url", F.lit("/"), F.lit(3))
    ip = F.replace(F.split_part("url", F.lit("/"), F.lit(5)), F.lit("?"), F.lit("."))
    return t.pages.select(
        F.col("page_id").alias("doc_id"),
        F.when(F.split_part("url", F.lit("/"), F.lit(4)) == "en", 0).otherwise(1).alias("label"),
        tx.network_tokens(ip, F.concat(F.lit("u@"), host), F.concat(F.lit("<m@"), host, F.lit(">"))).alias("text"),
    )


def network_holdout(t, dense):
    rows = network_rows(t)
    split = split_exact(rows.select("doc_id", "label"), "doc_id", RATIO, SEED)
    return nb.confusion(nb.holdout_text(rows.select("doc_id", "text"), split, dense=dense))


@query("b17_sparse_network_holdout", "WITH " + NETWORK + """
cnt AS (SELECT doc_id, label, is_train, token, count(*) AS cnt FROM tok GROUP BY ALL),""" + model_sql(0) + """
SELECT label, predicted, count(*) AS n FROM result GROUP BY 1, 2""")
def b17_sparse(t):
    return network_holdout(t, False)


@query("b17_dense_network_holdout", "WITH " + NETWORK + """
firstword AS (SELECT tk[1] AS w FROM fields ORDER BY doc_id LIMIT 1),
cnt AS (SELECT doc_id, label, is_train, token, count(*) AS cnt FROM tok WHERE token <> (SELECT w FROM firstword) GROUP BY ALL),""" + model_sql(1) + """
SELECT label, predicted, count(*) AS n FROM result GROUP BY 1, 2""")
def b17_dense(t):
    return network_holdout(t, True)


def logpdf_sql(x: str) -> str:
    return f"CASE WHEN sd <> 0 THEN -0.5 * (({x} - mean) / sd) * (({x} - mean) / sd) - ln(sd) - 0.9189385332046727 ELSE 0 END"


def numeric_sql(rows: str) -> str:
    return f"""
WITH src AS ({rows}),
numbered AS (SELECT *, row_number() OVER (ORDER BY {sql_draw(SEED, "'split'", 'row_id')}, row_id) AS rn,
             count(*) OVER () AS n FROM src),
marked AS (SELECT row_id, label, features, rn <= floor(n * {RATIO}) AS is_train FROM numbered),
long AS (SELECT row_id, label, is_train, generate_subscripts(features, 1) - 1 AS feature, unnest(features) AS x FROM marked),
model AS (SELECT label, feature, avg(x) AS mean, stddev_samp(x) AS sd FROM long WHERE is_train GROUP BY 1, 2),
scores AS (SELECT l.row_id, l.label, m.label AS cls, sum({logpdf_sql('x')}) AS score
           FROM long l JOIN model m USING (feature) WHERE NOT l.is_train GROUP BY 1, 2, 3),
result AS (SELECT row_id, label, cls AS predicted FROM
           (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, cls) AS r FROM scores) WHERE r = 1)
"""


EMBEDDED = "SELECT vec_id AS row_id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings"
LINES = """SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_id, l_returnflag AS label,
       [l_quantity, l_extendedprice, l_discount, l_tax] AS features FROM lineitem"""


def embedded(t):
    return t.embeddings.select(
        F.col("vec_id").alias("row_id"), "label", F.col("embedding").cast("array<double>").alias("features")
    )


@query("b18_numeric_holdout_embeddings", numeric_sql(EMBEDDED) + "SELECT row_id, label, predicted FROM result")
def b18_embeddings(t):
    done = nb.holdout_numeric(split_exact(embedded(t), "row_id", RATIO, SEED))
    return done.select("row_id", "label", "predicted")


@query("b18_numeric_holdout_lineitem", numeric_sql(LINES) + """
SELECT label, predicted, count(*) AS n FROM result GROUP BY 1, 2""")
def b18_lines(t):
    return nb.confusion(nb.holdout_numeric(split_exact(line_rows(t), "row_id", RATIO, SEED)))


@query("b18_numeric_accuracy", numeric_sql(EMBEDDED) + f"SELECT {ACCURACY} FROM result")
def b18_accuracy(t):
    done = nb.holdout_numeric(split_exact(embedded(t), "row_id", RATIO, SEED))
    return nb.accuracy(done).select(F.round("accuracy", 9).alias("accuracy"))


@query("b19_class_report", SPARSE + """
SELECT s.label, s.n AS n_rows, m.n_features FROM sizes s
JOIN (SELECT label, count(*) AS n_features FROM model GROUP BY label) m USING (label)""")
def b19(t):
    counts, known = train_counts(t)
    return nb.class_report(counts.where("is_train"), class_sizes(known))


@query("d7_fit_predict", SPARSE + """
SELECT predicted, count(*) AS n FROM result GROUP BY 1""")
def d7(t):
    counts, known = train_counts(t)
    fitted = nb.TextBayes().fit(counts.where("is_train"), class_sizes(known))
    found = fitted.predict(counts.where("not is_train"), known.where("not is_train"))
    return found.groupBy("predicted").agg(F.count("*").alias("n"))
