"""Pieces, alignment and hard negatives against the library and brute force, with their odd cases."""

import collections
import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import sentencepiece
from array import array
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tableloom.llm import align, negatives, pieces
from tableloom.llm.queries import QUERIES

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
TINY = "/root/testdata/sf0.001"

# blanks in every place, marks, characters without a piece, strings of special tokens, long runs
ODD = [
    None, "", " ", "  ", "a b", "  a", "a  ", " a ", "\n", "\t\n x", "▁", "a▁b", "<s>", "</s> <unk>", "<0x0A>", "<|endoftext|> x", "\x00", "é",
    "é", "​", "�", "🙂🙂 a", "漢字かな交じり", "x" * 3000, " " * 700, "ab" * 400 + " " + "é😀\n" * 300, "The  quick\n\nbrown  fox",
]


def texts_of(n, seed):
    rng = random.Random(seed)
    alphabet = "  aabcdeéß漢😀\n.,<>0x'sT"
    out = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]
    out += [out[4]] * 5 + [None, ""] + [" ".join(rng.choice(["the", "of", "nation", "ation"]) for _ in range(20_000))]
    rng.shuffle(out)
    return out


def docs_of(spark, texts):
    # columns that clash with names used inside
    rows = [(i if i else None, t, "x", 7, b"k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, n_a int, text_key binary").repartition(3)


def test_agenda_against_library(spark):
    texts = texts_of(400, 3)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode(docs_of(spark, texts), PIECES).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id or 0] or "", add_bos=True, add_eos=True)
        assert (r.n_tokens, bytes(r.ids), r.decoded) == (len(ids), array("I", ids).tobytes(), library.decode(ids))


def test_long_units_merge_alike():
    v = pieces.PieceVocabulary(PIECES)
    rng = random.Random(1)
    units = ["".join(rng.choice("abcdeEé.\n") for _ in range(rng.randrange(1, 200))) for _ in range(300)] + [" " * 9, "   a"]
    symbols, owner = v.symbols([" " + u for u in units])
    beside, of = v.merge_units(symbols.copy(), owner)
    for i in range(len(units)):
        assert v.merge_long(symbols[owner == i].tolist()) == beside[of == i].tolist()


def test_decode_any_ids():
    v, rng = pieces.PieceVocabulary(PIECES), random.Random(5)
    choice = [0, 1, 2, 259, 28705, *range(3, 259, 9), *range(300, 32000, 997)]
    many = [[rng.choice(choice) for _ in range(rng.randrange(9))] for _ in range(800)]
    for ids, text in zip(many, v.decode([array("I", ids).tobytes() for ids in many])):
        assert text == v.library.decode(ids)
    assert v.decode([array("I", [3 + b for b in "é".encode()]).tobytes(), array("I", [3 + 0xC3, 264]).tobytes()]) == ["é", "� a"]


def test_remembered_units_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 2000)
    v = pieces.PieceVocabulary(PIECES)
    for i in range(40):
        texts = [f"word{i * 50 + k}" for k in range(50)]
        ids = v.encode(texts)
        assert v.differs(texts, ids, v.decode(ids)) is None
        assert len(v.units) <= 60


def test_a_difference_is_an_error(spark, monkeypatch):
    v = pieces.PieceVocabulary(PIECES)
    ids = v.encode(["a b", "c d"])
    assert v.differs(["a b", "c e"], ids, v.decode(ids)) == 1
    assert v.differs(["a b", "c d"], ids, ["a b", "c  d"]) == 1


def test_op11_as_registered(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    got = QUERIES["op11_sentencepiece_encoding"](spark, TINY).collect()
    assert {r.doc_id for r in got} == set(text) and len(got) == len(text)
    for r in got:
        ids = library.encode(text[r.doc_id], add_bos=True, add_eos=True)
        want = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *want)


def byte_tokens():
    with open(BYTES, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stand = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {i: bytes(stand[c] for c in t) for t, i in vocab.items() if t != "<|endoftext|>"}


def aligned_plainly(rows):
    """{row: the columns of op12} written token by token."""
    whole, library, of_a = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES), byte_tokens()
    whole.encode_special_tokens = True

    def of_b(i):
        return bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()

    held, count = {}, collections.Counter()
    for key, text in rows:
        a, b = whole.encode(" " + (text or ""), add_special_tokens=False).ids, library.encode(text or "")
        spelt = [b"".join(map(of_a.get, a)), b"".join(map(of_b, b))]
        if not text or spelt != [b" " + text.encode()] * 2:
            held[key] = (0, 0, [], [])
            continue
        ends = [set(np.cumsum([len(f(i)) for i in ids]).tolist()) for f, ids in ((of_a.get, a), (of_b, b))]
        groups, i, j, at_a, at_b = [], 0, 0, 0, 0
        for cut in sorted(ends[0] & ends[1]):
            left, right = [], []
            while at_a < cut:
                left.append(a[i])
                at_a += len(of_a[a[i]])
                i += 1
            while at_b < cut:
                right.append(b[j])
                at_b += len(of_b(b[j]))
                j += 1
            groups.append((left, right))
        links = [(x, y) for left, right in groups for x in left for y in right]
        count.update(set(links))
        held[key] = (len(a), len(b), groups, links)
    most = collections.Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = {}
    for key, (n_a, n_b, groups, links) in held.items():
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(count[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(said.encode()).hexdigest() if groups else ""
        out[key] = (n_a, n_b, len(groups), len(links), best, sum(count[p] for p in links), digest)
    return out


ALIGNMENT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("bounds", [{}, {"PART": 300, "LINKS": 5, "TEXTS": 7, "ENTRIES": 200, "TOGETHER": 2}])
def test_alignment_against_brute_force(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(align, name, value)
    texts = texts_of(150, 8)
    want = aligned_plainly(enumerate(texts))
    got = align.alignment(docs_of(spark, texts), BYTES, PIECES).collect()
    assert len(got) == len(texts)
    assert {r.doc_id or 0: tuple(r[c] for c in ALIGNMENT) for r in got} == want
    assert any(w[4] < w[3] for w in want.values()) and any(w == (0, 0, 0, 0, 0, 0, "") for w in want.values())


def test_op12_as_registered(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    rows += [(10**6 + i, t) for i, t in enumerate([rows[0][1]] * 30 + ODD)]
    pq.write_table(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}), f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_tokenizer_alignment"](spark, str(tmp_path)).collect()
    assert {r.doc_id: tuple(r[c] for c in ALIGNMENT) for r in got} == aligned_plainly(rows) and len(got) == len(rows)


def test_no_rows(spark):
    docs = docs_of(spark, ["a"]).where("false")
    assert pieces.encode(docs, PIECES).collect() == []
    assert align.alignment(docs, BYTES, PIECES).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(vectors, F.col("label"), F.lit(True), 5, 5).collect() == []


def mined_plainly(rows, anchors, n_positives, n_negatives):
    """rows: {id: (label, integer components)}."""
    out = set()
    for a in anchors:
        if a not in rows:
            continue
        label, q = rows[a]
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, same == label) for i, (same, v) in rows.items() if i != a)
        for s, p, _ in [r for r in scored if r[2]][:n_positives]:
            fits = [(n, t) for t, n, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s]
            out |= {(a, p, rank + 1, n, -s, -t) for rank, (n, t) in enumerate(fits[:n_negatives])}
    return out


NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("block, run, scale", [(64, 4, 256), (1 << 13, 32, 256), (50, 2, 1 << 26)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, block, run, scale):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "CHUNK", 9)
    monkeypatch.setattr(negatives, "RUN", run)
    rng = np.random.default_rng(4)
    side, n = 6, 300
    x = np.round(rng.normal(0, 0.4, (n, side)) + rng.integers(0, 2, (n, 1)), 1)
    x[20:60] = x[20]  # ties, and an anchor among them
    x[70] = 0
    # a few clear directions, so that lists stop early
    x[100:120] = 0
    x[100:120, 0] = np.arange(20) + 3
    labels = rng.integers(0, 3, n)
    rows = {int(i): (int(y), [int(np.floor(scale * v)) for v in r]) for i, y, r in zip(range(n), labels, x)}
    data = [(i, int(y), [float(v) for v in r], "q", 1) for i, y, r in zip(range(n), labels, x)]
    data += [
        (1000, None, [1.0] * side, "q", 1), (1100, 1, None, "q", 1), (1200, 1, [1.0, None], "q", 1), (1300, 1, [float("nan")] * side, "q", 1),
        (1400, 1, [float("inf")] + [0.0] * 5, "q", 1), (None, 1, [1.0] * side, "q", 1),
        # an id given again: the smallest vector counts
        (5, 0, [100.0] * side, "q", 1),
    ]
    vectors = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>, score string, rank int").repartition(5)
    got = negatives.hard_negatives(vectors, F.col("label"), F.col("vec_id") % 10 == 0, 4, 3, scale=scale).collect()
    want = mined_plainly(rows, range(0, n, 10), 4, 3)
    assert {tuple(r[c] for c in NEGATIVES) for r in got} == want and len(got) == len(want) > 100


def test_threshold_reads_less_than_the_block():
    n = 4000
    q = np.zeros((n, 2), dtype=np.int64)
    q[:, 0], q[:, 1] = np.arange(n), 1
    reads = []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            out = super().__getitem__(at)
            reads.append(np.size(out))
            return out

    order = np.ascontiguousarray(np.argsort(q, axis=0, kind="stable").T).view(Counting)
    lists = negatives.SortedLists(np.arange(n), np.zeros(n), q, order)
    best = lists.search(np.array([1, 0]), np.ones(n, dtype=bool), [(None, None), (None, 3990)], 5)
    assert best[0] == [(3999 - i, 3999 - i) for i in range(5)] and best[1] == [(3990 - i, 3990 - i) for i in range(5)]
    assert sum(reads) < 100


def test_sums_of_any_width_are_exact():
    rng = np.random.default_rng(2)
    for wide in (1 << 8, 1 << 28, 1 << 55):
        q = rng.integers(-wide, wide, (90, 3))
        lists = negatives.SortedLists(np.arange(90), np.zeros(90), q, np.argsort(q, axis=0, kind="stable").T)
        anchor = q[7]
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(anchor, r)), i) for i, r in enumerate(q))
        middle = -scored[30][0]
        got = lists.search(anchor, np.ones(90, dtype=bool), [(None, None), (None, middle)], 4)
        assert got == [[(i, -s) for s, i in scored[:4]], [(i, -s) for s, i in scored[30:34]]]


def test_scores_beyond_64_bits_are_an_error(spark):
    vectors = spark.createDataFrame([(0, 1, [2.0**55]), (1, 1, [2.0**54])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        negatives.hard_negatives(vectors, F.col("label"), F.lit(True), 5, 5).collect()
