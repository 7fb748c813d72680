"""Every operator against a brute-force version on small tables with odd rows."""

import collections
import hashlib
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from tableloom.llm import bitslice, bpe, chat, hilbert, packing, partenum, quality, suffixes, urls
from tableloom.llm.queries import ALLOWED_URLS, BLOCKED_URLS, URL_RULES

DOCS = "doc_id long, text string, lang string, `key` string, row int, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "k", 1, len(t or "")) for i, t in rows], DOCS).repartition(3)


def sample_texts(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 5)))
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            words = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randrange(0, 4)):
                words.insert(rng.randrange(len(words) + 1), word())
        else:
            words = [word() for _ in range(rng.randrange(0, 90))]
        rows.append((i, " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "One"), (905, "a b c d"), (None, rows[3][1]), (None, None)]
    rows += [rows[5], rows[5], (906, rows[7][1].upper()), (907, "x " * 3000)]
    return rows


# --- URL filter

def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)), path


def rule_of(host, path):
    fits = []
    for rule, verdict in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def grams(host, path):
    out = set()
    for mark, text in (("h", host), ("p", path)):
        framed = f"^{text}$"
        for n in urls.SIZES:
            out |= {zlib.crc32((mark + framed[i : i + n]).encode()) % urls.BUCKETS for i in range(len(framed) - n + 1)}
    return sorted(out)


def trained(labelled):
    rows = sorted(dict(labelled).items())
    held = [grams(*split(u)) for u, _ in rows]
    w = np.zeros(urls.BUCKETS + 1)
    for _ in range(urls.ROUNDS):
        moved = w * (1 - urls.DECAY)
        for b, (_, y) in zip(held, rows):
            s = 1 / np.sqrt(len(b) + 1)
            error = s * (y - 1 / (1 + np.exp(-s * (w[-1] + w[b].sum()))))
            moved[[*b, -1]] += urls.RATE / len(rows) * error
        w = moved
    return w


def test_url_filter(spark):
    labelled = [(u, 1) for u in BLOCKED_URLS] + [(u, 0) for u in ALLOWED_URLS]
    given = [
        None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "https://net/", "https://net", "http://xnet/de/",
        "http://www.example.com/de/1", "http://example.com/DE/", "https://b.org/fr/", "https://b.org/fr", "x://y://z.net/a",
        "https://casino-win.example.org/en/1", "https://www.casino-win.example.com/play", "https://blog.tionble.example.org/en/3",
        "https://example.net/en/../de", "http://a.b.example.net:80/q", "http://casino.example.com/" + "a" * 5000, "a\nb://c.net/\n?",
    ] * 2
    pages = spark.createDataFrame([(i, u, "x", "clash") for i, u in enumerate(given)], "page_id long, url string, html string, host string")
    table = spark.createDataFrame(labelled, "url string, blocked int")
    got = {r.page_id: r for r in urls.judge(pages, URL_RULES, table).collect()}
    w = trained(labelled)
    assert len(got) == len(given)
    for i, u in enumerate(given):
        host, path = split(u)
        rule, verdict = rule_of(host, path)
        if verdict is None:
            verdict = "block" if w[-1] + w[grams(host, path)].sum() > 0 else "allow"
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert {got[13].verdict, got[14].verdict} == {"block"} and got[15].verdict == "allow"
    assert urls.judge(pages.limit(0), URL_RULES, table).count() == 0
    assert {r.verdict for r in urls.judge(pages.limit(2), URL_RULES, table.limit(0)).collect()} == {"allow"}


# --- searches

def vectors(spark, n=150, side=6):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(n, side)), 1)
    x[20:60] = x[3]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * side), (903, [float("inf")] * side), (None, [1.0] * side)]
    rows += [(905, []), (906, [0.0] * side), (907, [2.5]), rows[8], rows[8]]
    return rows, spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n int, key int").repartition(3)


def padded(rows, side=6):
    keep = {i: v for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    return {i: np.pad(np.array(v, dtype=float), (0, side - len(v))) for i, v in keep.items()}


def test_bit_sliced_search(spark):
    rows, df = vectors(spark)
    q = {i: np.floor(64 * v).astype(int) for i, v in padded(rows).items()}
    got = collections.defaultdict(list)
    for r in bitslice.top_k(df, bitslice.F.col("vec_id") % 5 == 0, 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in q if i % 5 == 0}
    for i, found in got.items():
        want = sorted(((j, int(q[i] @ v)) for j, v in q.items() if j != i), key=lambda x: (-x[1], x[0]))[:20]
        assert found == want
    assert bitslice.top_k(df.limit(0), bitslice.F.col("vec_id") % 5 == 0, 20).count() == 0


def test_bit_slices_add_up():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-200, 200, (130, 5)), rng.integers(-90, 90, 5)
    low, slices = bitslice.slices_of(x)
    constant, scores = bitslice.score_slices(q, low, slices, 3)
    bits = [np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(int) << w for w, s in enumerate(scores)]
    assert (constant + sum(bits) == x @ q).all()


def test_hilbert_curve_steps_to_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    order = np.argsort(hilbert.hilbert_keys(cells, 3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_hilbert_neighbours(spark):
    rows, df = vectors(spark)
    x = {i: v for i, v in padded(rows).items() if v.any()}
    is_query = hilbert.F.col("vec_id") % 5 == 0
    # windows over all rows give the exact answer
    got = collections.defaultdict(list)
    for r in hilbert.nearest(df, is_query, 10, curves=2, share=2.0, votes=1).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in x if i % 5 == 0}
    for i, found in got.items():
        want = sorted(((j, float(np.sqrt(((x[i] - v) ** 2).sum()))) for j, v in x.items() if j != i), key=lambda p: (p[1], p[0]))[:10]
        assert [j for j, _ in found] == [j for j, _ in want] and np.allclose([d for _, d in found], [d for _, d in want])
    assert hilbert.nearest(df.limit(0), is_query, 10).count() == 0


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_hilbert_recall(spark, monkeypatch, tmp_path, scale):
    table = spark.read.parquet(f"/root/testdata/sf{scale}/embeddings.parquet")
    data = table.toPandas()
    x, ids = np.stack(data.embedding).astype(float), data.vec_id.to_numpy()
    is_query = hilbert.F.col("vec_id") % 100 == 0
    got = hilbert.nearest(table, is_query, 10).toPandas().groupby("query_id").vec_id.agg(set)
    hits = []
    for i in np.flatnonzero(ids % 100 == 0):
        far = ((x - x[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        hits.append(len(set(ids[np.argsort(far)[:10]]) & got[ids[i]]) / 10)
    assert np.mean(hits) >= 0.92
    # a row is compared with a query once, and not all rows are
    rows = hilbert.ranked(hilbert.valid_vectors(table), 64, hilbert.CURVES).toPandas()
    ranks = np.stack(rows.ranks)
    reach = int(np.ceil(hilbert.SHARE * len(ids) / 2))
    compared = [hilbert.candidates(ranks, own, reach, hilbert.VOTES, 10).sum() for own in ranks[rows.vec_id % 100 == 0]]
    assert np.mean(compared) < 0.75 * len(ids)


def test_hilbert_blocks_far_away_are_not_met(spark, monkeypatch):
    # clusters: few blocks can be reached, and the answer stays exact inside a cluster
    monkeypatch.setattr(hilbert, "BLOCK", 50)
    monkeypatch.setattr(hilbert, "CHUNK", 1)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(20, 8)) * 50
    x = np.repeat(centre, 50, axis=0) + rng.normal(size=(1000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    met = []
    whole = hilbert.materialize
    monkeypatch.setattr(hilbert, "materialize", lambda d: met.append(d.count()) or whole(d) if d.columns == ["block", "chunk"] else whole(d))
    got = collections.defaultdict(list)
    for r in hilbert.nearest(df, hilbert.F.col("vec_id") % 25 == 0, 5, share=0.03).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    hits = [len(set(got[i]) & set(np.argsort(((x - x[i]) ** 2).sum(axis=1))[1:6].tolist())) / 5 for i in range(0, 1000, 25)]
    assert np.mean(hits) > 0.9 and met[0] < 0.5 * 20 * 40, (np.mean(hits), met)


# --- quality

def test_quality_on_held_out_rows(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    stats = quality.statistics_table(docs).cache()
    scored = quality.score_table(stats, quality.fit(stats, labels)).toPandas().merge(labels.toPandas(), on="doc_id")
    stats.unpersist()
    tested = scored[scored.held_out]
    assert ((tested.score >= 0) & (tested.score <= 1)).all() and len(tested) > 100
    assert (tested.predicted == tested.quality).mean() > 0.97
    assert (tested[tested.quality == 1].predicted == 1).mean() > 0.99
    assert [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id] == scored.held_out.tolist()


def test_quality_odd_rows(spark):
    docs = documents(spark, sample_texts())
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    stats = quality.statistics_table(docs)
    scored = quality.score_table(stats, quality.fit(stats, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    assert not any(r.held_out for r in scored if r.doc_id is None)
    none = quality.fit(stats, labels.limit(0))
    assert {r.score for r in quality.score_table(stats, none).collect()} == {0.5}
    assert quality.score_table(quality.statistics_table(docs.limit(0)), none).count() == 0
    assert quality.accepted(docs, none).count() == docs.count() and quality.accepted(docs, none).columns == docs.columns


def test_pooling_is_monotone():
    knots, values = quality.pooled(np.arange(6.0), np.array([1, 0, 2, 1, 5, 4.0]), np.full(6, 5.0))
    assert (np.diff(knots) > 0).all() and (np.diff(values) >= 0).all()


# --- near duplicates

def shingles(text):
    low = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def linked(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, partitions, seed):
    rows = sample_texts(seed)
    sets, roots = linked(rows)
    ids = collections.defaultdict(list)
    for (i, _), r in zip(rows, roots):
        ids[r].append(i)
    want = sorted(
        ((i, len(s), min((x for x in ids[r] if x is not None), default=None)) for (i, _), s, r in zip(rows, sets, roots)), key=str
    )
    docs = documents(spark, rows)
    got = sorted(map(tuple, partenum.near_duplicates(docs).collect()), key=str)
    assert got == want
    left = partenum.one_of_each(docs).collect()
    assert len(left) == len(set(roots)) and set(left[0].asDict()) == set(docs.columns)
    assert partenum.near_duplicates(docs.limit(0)).count() == 0


def test_signatures_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    for n in (5, 20, 40, 90, 300, 1500):
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop = rng.integers(0, len(x) // 9 + 1)
            add = rng.integers(0, max(1, len(x) // 9 - drop + 1))
            y = np.unique(np.concatenate([x[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
            common = len(np.intersect1d(x, y))
            if 100 * common < 80 * (len(x) + len(y) - common):
                continue
            sig, index, node = partenum.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
            by = [collections.defaultdict(set), collections.defaultdict(set)]
            need = [{}, {}]
            for s, k in zip(sig.tolist(), index):
                by[node[k, 0]][node[k, 1]].add(s)
            for which, band, least in node:
                need[which][band] = least
            assert any(len(by[0][b] & by[1][b]) >= max(1, need[0].get(b, 0), need[1].get(b, 0)) for b in set(by[0]) & set(by[1]))


@pytest.mark.parametrize("bounds", [{}, {"BLOCK_SETS": 7, "HOT": 5, "FLUSH": 500, "PAIRS": 16}, {"BLOCK_BYTES": 3000, "HOT": 40}])
def test_groups_larger_than_the_blocks(spark, monkeypatch, bounds):
    rng = random.Random(8)
    # one passage in all documents, so that every set is in large groups; few of them link
    passage = " ".join(f"p{k}" for k in range(30))
    rows = []
    for i in range(120):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 2, 6, 30])))
        rows.append((i, passage + " " + own))
    rows += [(200 + i, rows[i][1] + " end") for i in range(0, 120, 7)]
    for name, value in bounds.items():
        monkeypatch.setattr(partenum, name, value)
    sets, roots = linked(rows)
    best = {}
    for (i, _), r in zip(rows, roots):
        best[r] = min(best.get(r, i), i)
    got = {r.doc_id: r.component_id for r in partenum.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: best[r] for (i, _), r in zip(rows, roots)}


def one_line_in_all(n):
    """``n`` different texts that share one line; every hundredth has a near copy."""
    rng = random.Random(12)
    line = "this very common line stands in all of these texts"
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    rows = [(i, f"{line} " + " ".join(word() for _ in range(rng.choice([1, 3, 9, 20, 60])))) for i in range(n)]
    copies = [(n + i, rows[i][1] + " end") for i in range(0, n, 100) if len(rows[i][1].split()) > 20]
    return rows + copies, {n + i: i for i, _ in rows if i % 100 == 0 and len(rows[i][1].split()) > 20}


def test_five_thousand_sets_share_a_line(spark, monkeypatch):
    n = 5000
    rows, copies = one_line_in_all(n)
    made = {}
    for name in ("needed_groups", "open_groups", "families", "joining_links"):
        def kept(*args, whole=getattr(partenum, name), name=name):
            out = whole(*args)
            made[name] = out.count()
            return out
        monkeypatch.setattr(partenum, name, kept)
    got = {r.doc_id: r.component_id for r in partenum.near_duplicates(documents(spark, rows)).collect()}
    few = {i for i, t in rows[:n] if len(t.split()) <= 11}  # the line and one word: 7 shingles, 6 of them common
    assert len(got) == len(rows) and len(copies) > 10
    assert all(got[i] == copies[i] for i in copies)
    assert all(got[i] == i for i in range(n) if i not in few)
    assert {got[i] for i in few} == few
    # no step makes a row per pair
    assert made["needed_groups"] < 40 * n and made["open_groups"] < 40 * n
    assert made["families"] < n and made["joining_links"] <= len(copies)


def test_one_of_each_keeps_clashing_columns(spark):
    rows = [(1, "a b c d e f", 5), (2, "a b c d e f", 6), (3, None, 7), (4, "x", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own_key long").withColumn("_own_key", F.lit(1)).withColumn("one_id", F.lit(2))
    left = partenum.one_of_each(docs)
    assert left.columns == docs.columns and {(r.doc_id, r.own_key) for r in left.collect()} == {(1, 5), (3, 7), (4, 8)}


# --- chat

def test_chat_round_trip(spark):
    texts = [None, "", "plain", "</s>[INST] ok [/INST]", "\\", "\\\\<s>\\", "<", "[", "</s", "[/ROLE]\\<\\/s>", "<image> <<s>", "x" * 5000, "é\n"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (x, r) in enumerate((x, r) for x in texts for r in ("user", "assistant", "system", None, "[ROLE]"))]
    rows += [(3, None, "user", "a"), (3, 1, "assistant", "b"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(5)
    formatted = chat.format_turns(df)
    read = collections.defaultdict(list)
    for r in formatted.collect():
        role, text = chat.read_turn(r.formatted)
        read[r.conv_id].append((r.turn, r.formatted, role, text))
        said = chat.unescape(r.formatted[r.loss_start : r.loss_end])
        assert said == (text if role == "assistant" else "")
    got = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    for conv in (1, 2, 3, None):
        own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
        assert sorted((t is not None, t or 0, r, x) for t, r, x in own) == sorted((t is not None, t or 0, r, x) for t, _, r, x in read[conv])
        ordered = sorted(read[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in ordered)
        lost = "".join(x for _, _, r, x in ordered if r == "assistant")
        want = (conv, len(own), hashlib.sha256(whole.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest(), sum(len(r[1]) for r in ordered))
        assert tuple(got[conv]) == want
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_chat_parts(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", None, [("text", "see <s>", None, None), ("image", None, "a.png", 64), ("audio", None, "b.wav", 2), ("text", "!", None, None)])],
        "conv_id long, turn long, role string, text string, parts array<struct<type: string, text: string, ref: string, units: long>>",
    )
    row = chat.format_turns(df).first()
    assert row.formatted == "<s>[ROLE]user[/ROLE][INST] see <\\s><image><audio>! [/INST]</s>"
    assert [(a.kind, a.reference, a.tokens, row.formatted[a.at :][:7]) for a in row.attachments] == [
        ("image", "a.png", 64, "<image>"), ("audio", "b.wav", 50, "<audio>")
    ]
    assert row.expanded_tokens == 114 and chat.read_turn(row.formatted) == ("user", "see <s>!")


# --- tokens

ODD = [
    "a<|endoftext|> b <|startoftext|>x", "  x \n\n y ", "日本 ١٢ 　x\x85y\x1cz\x1f  ", "ǅ ʰ Ⅷ ² ½ é ΑΣ Σ İstanbul", "don't I'LL we've 'S",
    "a" * 3000, "the" * 500, "🙂🙂🙂 ❤️❤️", "123 4.5 !!! <|x|> <", "", None, "\u180e\u200bq w e", "x\x00y", "internationalwomensday aaabbb",
]


def test_word_bpe(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (0, texts[0])])
    got = {r.doc_id: r for r in bpe.encode(docs, path).collect()}
    for i, t in enumerate(texts):
        ids = whole.encode(t or "", add_special_tokens=False).ids
        want = (len(ids), " ".join(map(str, ids)), whole.decode(ids, skip_special_tokens=False))
        assert (got[i].n_tokens, got[i].ids, got[i].decoded) == want, t
    assert None in got and bpe.encode(docs.limit(0), path).count() == 0


def test_pairs_decide_whole_words():
    own, rng = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json")), random.Random(2)
    words = list({"".join(rng.choice("aeinrsth") for _ in range(rng.randrange(1, 14))) for _ in range(3000)})
    assert own.encode_words(words) == {w: own.exact(w) for w in words}
    long = "".join(rng.choice("aeinrsth") for _ in range(200))
    assert own.merged([*long]) == bpe.WordBpe.merged(own, [*long])


# --- repeated bytes

def cut(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = collections.Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, data):
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for x in range(len(b)) if gone[x] and not (x and gone[x - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("alphabet", ["ab", "abcdé\n "])
def test_repeated_bytes(spark, partitions, alphabet):
    rng = random.Random(len(alphabet))
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    base = [text(70) for _ in range(5)]
    rows = []
    for i in range(50):
        parts = [rng.choice(base)[rng.randrange(20) : rng.randrange(20, 70)] if rng.random() < 0.6 else text(rng.randrange(30)) for _ in range(rng.randrange(6))]
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * 90), (103, rows[5][1]), (None, rows[7][1]), rows[9], (104, text(4000))]
    docs = documents(spark, rows)
    assert sorted(map(tuple, suffixes.remove_repeats(docs, 20).collect()), key=str) == sorted(cut(rows, 20), key=str)
    left = suffixes.without_repeats(docs, 20)
    assert left.columns == docs.columns and left.count() == len(rows)
    assert suffixes.remove_repeats(docs.limit(0), 20).count() == 0


def test_multikey_order():
    rng = np.random.default_rng(2)
    words = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(4)]
    assert (multi := suffixes.multikey_order(words)) is not None
    columns = np.stack([w[multi] for w in words], axis=1).tolist()
    assert columns == sorted(columns)


# --- packing

def best_fit(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(capacity - n)
    return len(left)


def test_packing(spark, partitions):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate(ODD)] + sample_texts(3)
    rows = [(i, t and t[:700]) for i, t in rows]
    pieces = packing.pack(documents(spark, rows), path, capacity=64).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        start, stop, piece = 0, len(ids) % 64 or 64, 0
        while start < len(ids):
            want[(i, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes()))] += 1
            start, stop, piece = stop, stop + 64, piece + 1
    assert collections.Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    held = collections.defaultdict(list)
    for p in pieces:
        held[p.sequence_id].append((p.offset, p.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(held) == best_fit([p.length for p in pieces], 64)
    assert packing.pack(documents(spark, rows).limit(0), path).count() == 0


def test_tightest_capacity():
    tree, rng, left = packing.CapacityTree(100), random.Random(1), collections.Counter()
    for _ in range(500):
        c = rng.randrange(101)
        n = rng.choice([1, 2, -left[c]])
        left[c] += n
        tree.add(c, n)
        least = rng.randrange(101)
        assert tree.tightest(least) == min((k for k, v in left.items() if v and k >= least), default=None)
