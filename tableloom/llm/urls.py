"""URL verdicts from host rules and a logistic regression on hashed character n-grams.

All in DataFrame functions.  Rules are looked up by the host and its parent domains, so the
work per URL follows the host's labels and not the number of rules.  The classifier is
trained on a small labelled table, which is bounded (``MAX_LABELLED``): its n-grams are
hashed to buckets, and full-batch gradient descent runs as one fold over arrays that hold
the examples of each bucket and the buckets of each example.  Scoring needs one weight per
bucket, a row of bounded size that the plan takes as a scalar.

Defined results: a null URL, or one without ``://``, has an empty host and path, which no
rule fits and the classifier judges like any other; repeated rows are judged row by row;
without labelled rows, or with one class only, the verdict is that of the intercept: allow
unless all labelled URLs are blocked; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 2048
SIZES = (3, 4, 5)
ROUNDS = 60
RATE = 4.0
DECAY = 0.002
MAX_LABELLED = 1000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null; ``rules`` holds (host + path, verdict)."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        name, _, rest = rule.partition("/")
        by_host.setdefault(name, []).append(("/" + rest, rule, verdict))
    pairs = []
    for name, own in by_host.items():
        entries = [F.struct(F.lit(p).alias("path"), F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for p, r, v in own]
        pairs += [F.lit(name), F.array(*entries)]
    table = F.create_map(*pairs)
    labels = F.split(host, "\\.")
    # the host and its parent domains
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    found = F.flatten(F.filter(F.transform(parents, lambda d: F.try_element_at(table, d)), lambda r: r.isNotNull()))
    fits = F.filter(found, lambda r: F.startswith(path, r["path"]))
    longest = F.reduce(
        F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))),
        F.lit(None).cast("struct<n: int, rule: string, verdict: string>"),
        lambda best, r: F.when(best.isNull() | (r["n"] > best["n"]), r).otherwise(best),
    )
    return longest


def _grams(mark: str, framed: Column, n: int) -> Column:
    starts = F.when(F.length(framed) >= n, F.sequence(F.lit(1), F.length(framed) - (n - 1)))
    starts = F.coalesce(starts, F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(framed, i, F.lit(n))))


def buckets(host: Column, path: Column, count: int = BUCKETS) -> Column:
    """Sorted distinct buckets of the n-grams of host and path, each marked by which of the two it is from."""
    framed = {mark: F.concat(F.lit("^"), text, F.lit("$")) for mark, text in (("h", host), ("p", path))}
    grams = F.flatten(F.array(*[_grams(mark, text, n) for mark, text in framed.items() for n in SIZES]))
    hashed = F.transform(grams, lambda g: (F.crc32(F.encode(g, "UTF-8")) % count).cast("int"))
    return F.array_sort(F.array_distinct(hashed))


def weights(labelled: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row ``w``: the weights of the buckets in order, the intercept last, fitted to (url, blocked).

    The first ``MAX_LABELLED`` URLs in order are used; a table of labels is meant to be small.
    """
    host, path = split_url(F.col("url"))
    rows = labelled.where("blocked is not null").groupBy("url").agg(F.max(F.col("blocked").cast("int")).alias("y"))
    rows = rows.orderBy("url").limit(MAX_LABELLED).select(F.col("y").cast("double").alias("y"), buckets(host, path).alias("b"))
    # equal weight for both classes, and one unit length per example
    rows = rows.withColumn("s", 1 / F.sqrt(F.size("b").cast("double") + 1))
    one = rows.agg(F.array_sort(F.collect_list(F.struct("b", "y", "s"))).alias("x"))
    # the examples of each bucket, and of the intercept as one bucket more
    listed = one.select(F.posexplode("x").alias("i", "e"))
    listed = listed.select("i", F.explode(F.array_append("e.b", F.lit(BUCKETS))).alias("j"))
    every = listed.sparkSession.range(BUCKETS + 1).select(F.col("id").cast("int").alias("j"))
    held = every.join(listed, "j", "left").groupBy("j").agg(F.array_sort(F.collect_list("i")).alias("i"))
    held = held.agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "i"))), lambda r: r["i"]).alias("held"))
    ready = one.withColumn("held", held.scalar())
    n = F.greatest(F.size("x"), F.lit(1)).cast("double")

    def margins(w: Column) -> Column:
        return F.transform(
            "x", lambda e: e["s"] * F.reduce(e["b"], F.element_at(w, BUCKETS + 1), lambda a, j: a + F.element_at(w, j + 1))
        )

    def errors(w: Column) -> Column:
        return F.zip_with(margins(w), F.col("x"), lambda m, e: e["s"] * (e["y"] - 1 / (1 + F.exp(-m))))

    start = F.struct(
        F.array_repeat(F.lit(0.0), BUCKETS + 1).alias("w"), F.array().cast("array<double>").alias("e")
    )

    def half(state: Column, i: Column) -> Column:
        moved = F.transform(
            F.arrays_zip(state["w"].alias("w"), F.col("held").alias("h")),
            lambda z: z["w"] * (1 - DECAY)
            + RATE / n * F.reduce(z["h"], F.lit(0.0), lambda a, k: a + F.element_at(state["e"], k + 1)),
        )
        # even steps find the examples' errors, odd ones move the weights by them
        return F.when(i % 2 == 0, F.struct(state["w"].alias("w"), errors(state["w"]).alias("e"))).otherwise(
            F.struct(moved.alias("w"), state["e"].alias("e"))
        )

    fitted = F.reduce(F.sequence(F.lit(0), F.lit(2 * rounds - 1)), start, half, lambda state: state["w"])
    return ready.select(fitted.alias("w"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame) -> DataFrame:
    """``pages`` with host, path, rule and verdict of their ``url``."""
    host, path = split_url(F.col("url").cast("string"))
    split = pages.withColumns({"host": host, "path": path})
    best = matching_rule(F.col("host"), F.col("path"), rules)
    split = split.withColumn("_weights", weights(labelled).scalar())
    w = F.col("_weights")
    own = buckets(F.col("host"), F.col("path"))
    # the sign of the margin is that of the sum
    total = F.reduce(own, F.element_at(w, BUCKETS + 1), lambda a, j: a + F.element_at(w, j + 1))
    learned = F.when(total > 0, "block").otherwise("allow")
    judged = split.withColumn("_best", best)
    return judged.withColumns(
        {"rule": F.col("_best.rule"), "verdict": F.coalesce(F.col("_best.verdict"), learned)}
    ).drop("_best", "_weights")
