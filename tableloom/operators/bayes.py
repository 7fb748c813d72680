"""Gaussian naive Bayes without class priors, on token counts or on numbers.

Token counts stay in the long form ``(doc, token, cnt)``.  A class model holds
mean and standard deviation for the tokens seen in the class; the zeros of
absent tokens enter through the class sizes.  A document's log score is the
score of an empty document plus a correction for each token it has, so the work
grows with the tokens present and not with the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions import text as tx
from tableloom.plans.ordered import OrderedRows
from tableloom.plans.placement import by_key, well_spread
from tableloom.plans.scratch import materialize
from tableloom.plans.skew import join_small, weighted_join

HALF_LOG_2PI = 0.9189385332046727


# ---- tokens and vocabulary -------------------------------------------------


def _token_array(docs: DataFrame, text: str) -> Column:
    """A column of token arrays as it is, a text column split into tokens."""
    ready = dict(docs.dtypes)[text].startswith("array")
    return F.col(text) if ready else tx.tokens(F.col(text))


def token_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per token: the columns of ``docs`` without the text, ``pos``, ``token``."""
    return _split(well_spread(docs), text)


def _split(docs: DataFrame, text: str) -> DataFrame:
    keep = [c for c in docs.columns if c != text]
    return docs.select(*keep, F.posexplode(_token_array(docs, text)).alias("pos", "token"))


def token_counts(docs: DataFrame, text: str = "text", placed: bool = False) -> DataFrame:
    """``(other columns of docs, token, cnt, first)``.

    ``text`` is a text column, or a column of token arrays; ``first`` is the
    position of the token's first occurrence in its document.  Texts move once, to
    the others of their document, and are counted there; ``placed`` says that they
    lie so already.
    """
    keep = [c for c in docs.columns if c != text]
    return _split(docs if placed else by_key(docs, *keep), text).groupBy(*keep, "token").agg(
        F.count("*").alias("cnt"), F.min("pos").alias("first")
    )


def vocabulary(counts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(token, cnt, idx)``; ``idx`` counts from 0 in order of first occurrence.

    ``counts`` holds ``(id_col, token, cnt, first)`` with an integer id.  Document
    and position are packed into one number, which keeps the aggregation hashed.
    """
    place = F.col(id_col).cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("first").cast("decimal(10,0)")
    seen = counts.groupBy("token").agg(F.sum("cnt").alias("cnt"), F.min(place).alias("_place"))
    return OrderedRows(seen, (), ["_place"]).rows.select("token", "cnt", F.col("_g").alias("idx"))


def count_vectors(counts: DataFrame, vocab: DataFrame, dense: bool = False) -> DataFrame:
    """Replace ``token`` by ``idx``; words outside the vocabulary are dropped.

    The dense form never counts index 0, the sparse form does.
    """
    words = vocab.select("token", "idx", F.col("cnt").alias("_weight"))
    vectors = weighted_join(counts, words, "token", "_weight").drop("token")
    return vectors.where("idx > 0") if dense else vectors


def dense_arrays(vectors: DataFrame, size: int, doc: str = "doc_id", cell_limit: int = 100_000) -> DataFrame:
    """Materialise ``(doc, vector array<bigint>)`` for a small vocabulary."""
    if size > cell_limit:
        raise ValueError("use the long form for a vocabulary of this size")
    entries = vectors.groupBy(doc).agg(
        F.map_from_entries(F.collect_list(F.struct("idx", "cnt"))).alias("_m")
    )
    cells = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.lit(size - 1).cast("bigint")),
        lambda i: F.coalesce(F.element_at("_m", i), F.lit(0).cast("bigint")),
    )
    return entries.select(doc, cells.alias("vector"))


def encode_label(label: Column) -> Column:
    """``ham`` is 0, anything else 1."""
    return F.when(label == "ham", F.lit(0)).otherwise(F.lit(1))


def decode_label(code: Column) -> Column:
    """0 is ``ham``, anything else ``spam``."""
    return F.when(code == 0, F.lit("ham")).otherwise(F.lit("spam"))


# ---- text model ------------------------------------------------------------


def train_text(counts: DataFrame, sizes: DataFrame, ddof: int = 0, feature: str = "token") -> DataFrame:
    """``(label, feature, mean, sd)`` from ``(label, feature, cnt)`` rows.

    ``sizes`` holds ``(label, n)``, the documents per class.  ``ddof`` 0 is the
    sparse variant, 1 the dense one; with one document the latter has no sd.
    The moments are sums of integers, so they are exact.
    """
    sums = counts.groupBy("label", feature).agg(
        F.sum("cnt").alias("s1"), F.sum(F.col("cnt") * F.col("cnt")).alias("s2")
    )
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    variance = F.try_divide((n * s2 - s1 * s1).cast("double"), (n * (n - ddof)).cast("double"))
    return join_small(sums, sizes, ["label"]).select(
        "label", feature, (s1 / n).alias("mean"), F.sqrt(variance).alias("sd")
    )


def density(x: Column, mean: Column, sd: Column) -> Column:
    """Normal density at ``x``."""
    return F.exp(-((x - mean) * (x - mean)) / (2 * sd * sd)) / (F.lit(2.5066282746310002) * sd)


def guarded_density(x: Column, mean: Column, sd: Column) -> Column:
    """Normal density, 1 when mean or sd is zero or unknown."""
    usable = (mean != 0) & (sd != 0)
    return F.when(usable, density(x, mean, sd)).otherwise(F.lit(1.0))


def log_density(x: Column, mean: Column, sd: Column, guard_mean: bool = True) -> Column:
    """Log of the normal density, 0 when the guarded values are zero or unknown."""
    usable = (sd != 0) & (mean != 0) if guard_mean else sd != 0
    z = (x - mean) / sd
    return F.when(usable, -0.5 * z * z - F.log(sd) - F.lit(HALF_LOG_2PI)).otherwise(F.lit(0.0))


def empty_scores(model: DataFrame, priors: DataFrame | None = None) -> DataFrame:
    """``(label, base)``: the log score of a document without any known token."""
    base = model.groupBy("label").agg(
        F.sum(log_density(F.lit(0.0), F.col("mean"), F.col("sd"))).alias("base")
    )
    if priors is None:
        return base
    return base.join(priors, "label").select("label", (F.col("base") + F.col("log_prior")).alias("base"))


def class_scores(
    counts: DataFrame, docs: DataFrame, model: DataFrame, doc: str = "doc_id", priors: DataFrame | None = None
) -> DataFrame:
    """``(doc, label, score)`` for every document and class.

    ``counts`` holds ``(doc, token, cnt)``, ``docs`` the ids to score.
    """
    mean, sd = F.col("mean"), F.col("sd")
    # one row per token and class on the right, as above
    terms = counts.select(doc, "token", "cnt").join(model, "token").select(
        doc,
        "label",
        (log_density(F.col("cnt"), mean, sd) - log_density(F.lit(0.0), mean, sd)).alias("part"),
    )
    # one entry per class, carried to the rows as a constant
    bases = empty_scores(model, priors).agg(F.collect_list(F.struct("label", "base")).alias("b"))
    starts = docs.select(doc, F.explode(bases.scalar()).alias("b")).select(
        doc, F.col("b.label").alias("label"), F.col("b.base").alias("part")
    )
    return starts.unionByName(terms).groupBy(doc, "label").agg(F.sum("part").alias("score"))


def best_class(scores: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``(doc, predicted)``: the class of the largest score, the smallest label on ties."""
    best = scores.groupBy(doc).agg(
        F.min(F.struct(F.col("score").isNull().alias("n"), (-F.col("score")).alias("s"), F.col("label").alias("l"))).alias("_b")
    )
    return best.select(doc, F.col("_b.l").alias("predicted"))


def accuracy(rows: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """One row: ``accuracy`` in percent."""
    hit = F.when(F.col(label) == F.col(predicted), 1.0).otherwise(0.0)
    return rows.agg((F.avg(hit) * 100).alias("accuracy"))


def confusion(rows: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    return rows.groupBy(label, predicted).agg(F.count("*").alias("n"))


def class_report(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(label, n_rows, n_features)`` of ``(label, token, ...)`` rows.

    Two aggregations instead of a distinct count per class, which would gather
    a class in one task.
    """
    features = (
        counts.groupBy("label", "token").agg(F.count("*").alias("_c"))
        .groupBy("label").agg(F.count("*").alias("n_features"))
    )
    return sizes.withColumnRenamed("n", "n_rows").join(features, "label", "left")


class TextBayes:
    """``fit`` gives a model, ``predict`` a table; both modes of the classifier."""

    def __init__(self, dense: bool = False, use_prior: bool = False):
        self.dense = dense
        self.use_prior = use_prior
        self.model: DataFrame | None = None
        self.priors: DataFrame | None = None

    def fit(self, counts: DataFrame, sizes: DataFrame) -> TextBayes:
        """``counts``: ``(doc_id, label, token, cnt)``; ``sizes``: ``(label, n)``."""
        self.model = materialize(train_text(counts, sizes, ddof=1 if self.dense else 0))
        if self.use_prior:
            total = sizes.agg(F.sum("n").alias("t"))
            self.priors = sizes.select("label", F.log(F.col("n") / total.scalar()).alias("log_prior"))
        return self

    def scores(self, counts: DataFrame, docs: DataFrame, doc: str = "doc_id") -> DataFrame:
        return class_scores(counts, docs, self.model, doc, self.priors)

    def predict(self, counts: DataFrame, docs: DataFrame, doc: str = "doc_id") -> DataFrame:
        return best_class(self.scores(counts, docs, doc), doc)


def labelled_texts(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``(doc_id, text, label, is_train)``, the rows of a document together."""
    return by_key(docs.select("doc_id", "text"), "doc_id").join(marked, "doc_id")


def first_word(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row ``token``: the first token of the document with the smallest id, index 0 of the vocabulary."""
    return docs.orderBy("doc_id").limit(1).select(_token_array(docs, text)[0].alias("token"))


def holdout_text(docs: DataFrame, marked: DataFrame, dense: bool = False, use_prior: bool = False) -> DataFrame:
    """Train on the marked rows, predict the others.

    ``docs``: ``(doc_id, text)``, or token arrays as ``text``;
    ``marked``: ``(doc_id, label, is_train)``.
    Gives ``(doc_id, label, predicted)`` of the rows that are not marked.  The
    texts are split into tokens once.
    """
    labelled = labelled_texts(docs, marked)
    counts = materialize(token_counts(labelled, placed=True))
    known = docs.select("doc_id").join(marked, "doc_id")
    if dense:
        # the dense form never counts the word of index 0
        counts = counts.where(F.col("token") != first_word(labelled).scalar())
    sizes = known.where("is_train").groupBy("label").agg(F.count("*").alias("n"))
    fitted = TextBayes(dense, use_prior).fit(counts.where("is_train"), sizes)
    rest = known.where("not is_train").select("doc_id", "label")
    return rest.join(fitted.predict(counts.where("not is_train"), rest), "doc_id")


# ---- numeric model ---------------------------------------------------------


def train_numeric(rows: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """``(label, feature, mean, sd)`` of an array column, sample standard deviation."""
    return (
        rows.select(F.col(label).alias("label"), F.posexplode(features).alias("feature", "x"))
        .groupBy("label", "feature")
        .agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"))
    )


def predict_numeric(
    rows: DataFrame, model: DataFrame, features: str = "features", guard_mean: bool = False
) -> DataFrame:
    """Add ``predicted``; scoring stays inside the row, without a shuffle.

    The model has one entry per class and feature and reaches the rows as a
    constant.  The first class in label order wins ties.
    """
    per_class = model.groupBy("label").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("feature", "mean", "sd"))),
            lambda m: F.struct(m["mean"].alias("mean"), m["sd"].alias("sd")),
        ).alias("terms")
    )
    models = per_class.agg(F.array_sort(F.collect_list(F.struct("label", "terms"))).alias("m"))

    def score(terms: Column) -> Column:
        parts = F.zip_with(
            F.col(features), terms, lambda x, t: log_density(x, t["mean"], t["sd"], guard_mean)
        )
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)

    ranked = F.transform(
        F.col("_models"),
        lambda m, i: F.struct(score(m["terms"]).alias("s"), (-i).alias("i"), m["label"].alias("l")),
    )
    scored = rows.withColumn("_models", models.scalar())
    return scored.withColumn("predicted", F.array_max(ranked)["l"]).drop("_models")


def holdout_numeric(
    marked: DataFrame, label: str = "label", features: str = "features", guard_mean: bool = False
) -> DataFrame:
    """Train on rows with ``is_train``, add ``predicted`` to the others."""
    model = materialize(train_numeric(marked.where("is_train"), label, features))
    return predict_numeric(marked.where("not is_train"), model, features, guard_mean)
