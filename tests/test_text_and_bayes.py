"""Text functions, vectors and naive Bayes against plain Python."""

import math
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tableloom.functions import scalars as sc
from tableloom.functions import text as tx
from tableloom.operators import bayes as nb


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


def test_symbols(spark):
    assert len(tx.SYMBOLS) == 30 and len(set(tx.SYMBOLS)) == 30
    assert tx.PUNCTUATION == string.punctuation
    text = "win £100! (now)\\`it's"
    spaced = "".join(f" {c} " if c in tx.SYMBOLS else c for c in text)
    assert one(spark, text, tx.isolate_symbols) == spaced
    assert one(spark, text, tx.tokens) == spaced.split(" ")
    assert one(spark, text, tx.blank_symbols) == "".join(" " if c in tx.SYMBOLS else c for c in text)
    assert one(spark, text, lambda c: tx.delete_symbols(c, "£")) == "win 100 nowits"


def test_cleaning(spark):
    states = [" Alabama ", "Georgia!", "georgia", "FlOrIda", "south carolina##", "West virginia?"]
    got = [one(spark, s, lambda c: tx.clean(c, tx.CLEANING)) for s in states]
    assert got == ["Alabama", "Georgia", "Georgia", "Florida", "South Carolina", "West Virginia"]


def test_codes_and_numbers(spark):
    assert one(spark, "Az", tx.to_codes) == [65, 122]
    assert one(spark, [-5, 66, 300], tx.from_codes, "array<int>") == "\x01B\xff"
    assert one(spark, "a (12/34) b", tx.last_number) == 34
    assert one(spark, "none", tx.last_number) is None
    assert one(spark, -7, lambda c: sc.floor_divide(c, 2), "bigint") == -4
    assert one(spark, 3725, sc.clock, "bigint") == "01:02:05"
    assert one(spark, "1.5x", sc.to_float_or_keep) == "1.5x"
    assert one(spark, "7", sc.to_float_or_keep) == "7.0"


def test_array_and_map_edits(spark):
    a = [1, 2, 3, 2, 5]
    assert one(spark, a, lambda c: sc.pop_at(c, 1), "array<int>") == [1, 3, 2, 5]
    assert one(spark, a, lambda c: sc.remove_first(c, 2), "array<int>") == [1, 3, 2, 5]
    assert one(spark, a, lambda c: sc.remove_first(c, 9), "array<int>") == a
    for start, stop in ((1, 3), (0, 0), (4, 9), (7, 9)):
        want = list(a)
        want[start:stop] = [8, 8]
        assert one(spark, a, lambda c: sc.replace_slice(c, start, stop, F.array(F.lit(8), F.lit(8))), "array<int>") == want
    assert one(spark, a, lambda c: sc.every(c, 2, 1, 5), "array<int>") == a[1:5:2]
    m = {"a": 1, "b": 2}
    right = F.create_map(F.lit("b"), F.lit(9), F.lit("c"), F.lit(3))
    assert one(spark, m, lambda c: sc.merged(c, right), "map<string,int>") == {"a": 1, "b": 9, "c": 3}
    assert one(spark, m, lambda c: sc.without_key(c, "a"), "map<string,int>") == {"b": 2}
    assert one(spark, m, lambda c: sc.get_or(c, F.lit("z"), 0), "map<string,int>") == 0


def test_network_tokens(spark):
    rows = [("1.2.3.4", "h@mail.org", "<x@a.b.net>"), ("9.8.7.6", "h@one.two.com", "bad id")]
    df = spark.createDataFrame(rows, "ip string, address string, message_id string")
    got = [r["t"] for r in df.select(tx.network_tokens(F.col("ip"), F.col("address"), F.col("message_id")).alias("t")).collect()]
    assert got[0] == ["1", "2", "3", "4", "mail", "org", "a", "b", "net"]
    assert got[1] == ["9", "8", "7", "6", "one", "two", "com", *"bad id"]


MAIL = [
    (0, "ham", "see you at home  tonight"), (1, "spam", "win cash now! win now"), (2, "ham", "home now, see mum"),
    (3, "spam", "cash prize: call now"), (4, "ham", "call mum tonight"), (5, "ham", "see the prize at home"),
]
ASKED = [(10, "win a prize now"), (11, "mum at home"), (12, "unknown words"), (13, "")]


def split_tokens(text):
    return "".join(f" {c} " if c in tx.SYMBOLS else c for c in text).split(" ")


def brute_force(dense):
    vocab = list(dict.fromkeys(w for _, _, text in MAIL for w in split_tokens(text)))

    def vector(text):
        counts = defaultdict(int)
        for w in split_tokens(text):
            if w in vocab and not (dense and vocab.index(w) == 0):
                counts[vocab.index(w)] += 1
        return counts

    by_class = defaultdict(list)
    for _, label, text in MAIL:
        by_class[0 if label == "ham" else 1].append(vector(text))
    scores = {}
    for doc, text in ASKED:
        x = vector(text)
        for label, rows in by_class.items():
            seen = range(len(vocab)) if dense else {i for r in rows for i in r}
            total = 0.0
            for i in seen:
                values = [r.get(i, 0) for r in rows]
                mean = sum(values) / len(rows)
                sd = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(rows) - (1 if dense else 0)))
                if mean and sd:
                    total += math.log(math.exp(-((x.get(i, 0) - mean) ** 2) / (2 * sd * sd)) / (math.sqrt(2 * math.pi) * sd))
            scores[doc, label] = total
    return vocab, scores


@pytest.mark.parametrize("dense", [False, True])
def test_text_model_equals_the_direct_product(spark, dense):
    vocab, want = brute_force(dense)
    docs = spark.createDataFrame(MAIL, "doc_id bigint, name string, text string").select(
        "doc_id", nb.encode_label(F.col("name")).alias("label"), "text"
    )
    counts = nb.token_counts(docs)
    found = nb.vocabulary(counts).orderBy("idx").collect()
    assert [r["token"] for r in found] == vocab
    asked = spark.createDataFrame(ASKED, "doc_id bigint, text string")
    asked_counts = nb.token_counts(asked)
    if dense:
        word = nb.first_word(docs).scalar()
        counts, asked_counts = counts.where(F.col("token") != word), asked_counts.where(F.col("token") != word)
    sizes = docs.groupBy("label").agg(F.count("*").alias("n"))
    model = nb.TextBayes(dense).fit(counts, sizes)
    got = {(r["doc_id"], r["label"]): r["score"] for r in model.scores(asked_counts, asked).collect()}
    assert got.keys() == want.keys()
    for key, score in want.items():
        assert got[key] == pytest.approx(score, rel=1e-9, abs=1e-9)
    best = {r["doc_id"]: r["predicted"] for r in model.predict(asked_counts, asked).collect()}
    assert best == {d: max((0, 1), key=lambda c: (want[d, c], -c)) for d, _ in ASKED}


def test_single_document_class_has_no_dense_deviation(spark):
    counts = spark.createDataFrame([(0, "a", 3)], "label int, token string, cnt bigint")
    sizes = spark.createDataFrame([(0, 1)], "label int, n bigint")
    assert nb.train_text(counts, sizes, ddof=1).first()["sd"] is None
    assert nb.empty_scores(nb.train_text(counts, sizes, ddof=1)).first()["base"] == 0.0


def test_vectors(spark):
    docs = spark.createDataFrame([(0, "a b a"), (1, "b c")], "doc_id bigint, text string")
    counts = nb.token_counts(docs)
    vocab = nb.vocabulary(counts)
    sparse = {(r["doc_id"], r["idx"]): r["cnt"] for r in nb.count_vectors(counts, vocab).collect()}
    assert sparse == {(0, 0): 2, (0, 1): 1, (1, 1): 1, (1, 2): 1}
    dense = nb.dense_arrays(nb.count_vectors(counts, vocab, dense=True), 3).orderBy("doc_id").collect()
    assert [r["vector"] for r in dense] == [[0, 1, 0], [0, 1, 1]]


def test_numeric_model(spark):
    rows = [(i, i % 2, [float(i % 2) * 5 + i * 0.01, 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, label int, features array<double>").withColumn("is_train", F.col("id") < 30)
    done = nb.holdout_numeric(df)
    assert nb.accuracy(done).first()["accuracy"] == 100.0
    assert {(r["label"], r["predicted"]): r["n"] for r in nb.confusion(done).collect()} == {(0, 0): 5, (1, 1): 5}


def test_priors_are_optional(spark):
    counts = spark.createDataFrame([(0, "a", 1), (1, "b", 1)], "label int, token string, cnt bigint")
    sizes = spark.createDataFrame([(0, 3), (1, 1)], "label int, n bigint")
    asked = spark.createDataFrame([(7,)], "doc_id bigint")
    none = spark.createDataFrame([], "doc_id bigint, token string, cnt bigint")
    plain = nb.TextBayes().fit(counts, sizes).scores(none, asked).collect()
    weighed = nb.TextBayes(use_prior=True).fit(counts, sizes).scores(none, asked).collect()
    shift = {r["label"]: r["score"] for r in weighed}
    for r in plain:
        assert shift[r["label"]] - r["score"] == pytest.approx(math.log(0.75 if r["label"] == 0 else 0.25))
