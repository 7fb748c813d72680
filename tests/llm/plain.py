"""The stages of the pipeline written plainly, and a small corpus with planted copies, passages and junk."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
from tokenizers import Tokenizer

from tableloom.llm import quality

LENGTH, CAPACITY = 200, 1024
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:?", "'\"-()", "!#$%&*+/<=>@[\\]^_`{|}~"]


def corpus(seed=5):
    """(doc_id, text, label or None)."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstuvé") for _ in range(rng.randrange(2, 9))) for _ in range(1500)]

    def prose(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return " ".join(w.capitalize() + "," if rng.random() < 0.1 else w for w in words) + rng.choice([".", "\n", " END"])

    rows = [(i, prose(rng.randrange(40, 250)), 1) for i in range(60)]
    passage, border = prose(60).encode()[:260].decode(errors="ignore"), "q" + "".join(rng.choice("rstuv wxyz") for _ in range(198)) + "q"
    short = "k" + "".join(rng.choice("lmn opq") for _ in range(197)) + "k"
    assert (len(border), len(short)) == (200, 199)
    rows += [(100 + i, f"{prose(40)} {i}{part}{i} {prose(40)}", 1) for i, part in enumerate([passage] * 3 + [border] * 2 + [short] * 2)]
    # é and è share their first byte, which goes with the passage before them
    mid = "".join(rng.choice("abc def") for _ in range(220))
    rows += [(110, f"{prose(50)} 1{mid}é one {prose(50)}", 1), (111, f"{prose(50)} 2{mid}è two {prose(50)}", 1)]
    rows += [(203, rows[3][1], None), (210, rows[4][1], 1), (211, rows[4][1], None)]
    for i in (7, 8, 9, 10):
        words = rows[i][1].split(" ")
        words[len(words) // 2] = "changed"
        rows.append((220 + i, " ".join(words), None))
    rows += [(240, prose(2500), 1), (241, prose(1100), None), (242, prose(700), 1)]
    mark = lambda: rng.choice("#$%@!*") * rng.randrange(2, 6) + str(rng.randrange(10**6)) + rng.choice(["BUY", "WIN", ""])
    rows += [(300 + i, " ".join(rng.choice(["##", "AA", ""]) + mark() for _ in range(rng.randrange(5, 60))) + rng.choice(["##", "ZZ"]), 0) for i in range(40)]
    rows += [(340 + i, "##" + " ".join(mark() for _ in range(30)) + "##", None) for i in range(8)]
    rows += [(400, None, None), (401, "", None), (402, " \n\t", None), (403, "Short one.", None)]
    rng.shuffle(rows)
    return rows


def write(directory, rows):
    texts = [t for _, t, _ in rows]
    pq.write_table(pa.table({
        "doc_id": pa.array([i for i, _, _ in rows], pa.int64()), "text": pa.array(texts, pa.string()),
        "lang": ["en"] * len(rows), "source": [f"s{i % 3}" for i, _, _ in rows],
        "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
    }), f"{directory}/documents.parquet", row_group_size=40)
    known = [(i, y) for i, _, y in rows if y is not None]
    pq.write_table(pa.table({
        "doc_id": pa.array([i for i, _ in known], pa.int64()), "quality": pa.array([y for _, y in known], pa.int32()),
        "toxic": pa.array([0] * len(known), pa.int32()),
    }), f"{directory}/labels.parquet")


def words_of(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def statistics(text):
    data, words = (text or "").encode(), words_of(text)
    if not data:
        return [0.0] * quality.STATISTICS
    kind = [8 if b >= 128 else next((k for k, c in enumerate(CLASSES) if chr(b) in c), 9) for b in data]
    share, n = collections.Counter(kind), max(len(words), 1)
    out = [math.sqrt(share[k] / len(data)) for k in range(10)]
    out += [math.log1p(len(words)), len(data) / n]
    out += [sum(words[k] == words[k - d] for k in range(d, len(words))) / n for d in (1, 2)]
    out.append(math.log(len(set(words))) / math.log(n + 1) if words else 0.0)
    out.append(math.sqrt(sum(a == b == 1 for a, b in zip(kind, kind[1:])) / len(data)))
    out.append(math.sqrt(sum(kind[k] == 7 and data[k] == data[k - 1] for k in range(1, len(data))) / len(data)))
    return out + [math.log1p(share[4] / n * 100)]


def scores(rows):
    """{doc_id: (held_out, score)} by a fit on the labels that are not held out."""
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows}
    x = {i: np.array(statistics(t), dtype="<f4").astype(float) for i, t, _ in rows}
    known = [(i, y) for i, _, y in rows if y is not None and fold[i] != 0]
    chosen, y = np.array([x[i] for i, _ in known]), np.array([y for _, y in known], dtype=float)
    mean, scale = chosen.mean(axis=0), chosen.std(axis=0)
    scale[scale <= 1e-6] = 1
    draw = np.random.default_rng(quality.SEED)
    w = draw.normal(0, 1 / quality.WIDTH, (len(mean), quality.FEATURES))
    b = draw.uniform(0, 2 * np.pi, quality.FEATURES)
    z = lambda v: np.append(math.sqrt(2 / quality.FEATURES) * np.cos(np.clip((v - mean) / scale, -8, 8) @ w + b), 1)
    ridge = np.diag([quality.RIDGE] * quality.FEATURES + [1e-6])

    def weights(left):
        a = np.array([z(x[i]) for i, _ in known if left != fold[i]])
        return np.linalg.solve(a.T @ a + ridge, a.T @ np.array([float(v) for i, v in known if left != fold[i]]))

    by_fold = {f: weights(f) for f in set(fold[i] for i, _ in known)}
    cells = collections.defaultdict(list)
    for i, v in known:
        cells[min(max(round(float(z(x[i]) @ by_fold[fold[i]]) * 1000), -1000), 2000)].append(v)
    # isotonic means: the largest mean over starts of the smallest mean over ends
    at = sorted(cells)
    mean_of = lambda a, b: sum(sum(cells[c]) for c in at[a:b]) / sum(len(cells[c]) for c in at[a:b])
    fitted = [max(min(mean_of(a, b) for b in range(k + 1, len(at) + 1)) for a in range(k + 1)) for k in range(len(at))]
    blocks = collections.defaultdict(list)
    for c, value in zip(at, fitted):
        blocks[round(value, 12)] += [c / 1000] * len(cells[c])
    whole = weights(None)
    values = sorted(blocks)
    return {i: (fold[i] == 0, float(np.interp(z(x[i]) @ whole, [np.mean(blocks[v]) for v in values], values))) for i, _, _ in rows}


def accepted(rows):
    kept = scores(rows)
    assert all(abs(s - 0.3) > 1e-6 for _, s in kept.values())
    return [r for r in rows if kept[r[0]][1] >= 0.3]


def one_of_each(rows):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t, _ in rows if (w := words_of(t))}
    least = {i: i for i in sets}
    changed = True
    links = [(i, j) for i, x in sets.items() for j, y in sets.items() if i < j and 100 * len(x & y) >= 80 * len(x | y)]
    while changed:
        changed = False
        for i, j in links:
            if least[i] != least[j]:
                least[i] = least[j] = min(least[i], least[j])
                changed = True
    return [r for r in rows if least.get(r[0], r[0]) == r[0]]


def cut(rows, length=LENGTH):
    """(doc_id, kept bytes, marks of the bytes that go) of every row."""
    data = [(t or "").encode() for _, t, _ in rows]
    count = collections.Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for (i, _, _), b in zip(rows, data):
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        out.append((i, bytes(x for x, g in zip(b, gone) if not g), gone))
    return out


def without_repeats(rows, length=LENGTH):
    kept = {i: (left, gone) for i, left, gone in cut(rows, length)}
    return [(i, kept[i][0].decode(errors="ignore") if any(kept[i][1]) else t, y) for i, t, y in rows]


def removed(rows, length=LENGTH):
    """The rows of op8: (doc_id, bytes, bytes removed, spans, sha256 of what is kept)."""
    spans = lambda gone: sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
    return [(i, len(gone), sum(gone), spans(gone), hashlib.sha256(left).hexdigest()) for i, left, gone in cut(rows, length)]


def check_packed(pieces, rows, capacity=CAPACITY):
    """Whether rows of the packing are the pieces of all texts, laid end to end by best fit decreasing."""
    whole, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), collections.Counter()
    for i, t, _ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        start, stop, piece = 0, len(ids) % capacity or capacity, 0
        while start < len(ids):
            want[(i, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes()))] += 1
            start, stop, piece = stop, stop + capacity, piece + 1
    assert collections.Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    held = collections.defaultdict(list)
    for p in pieces:
        held[p.sequence_id].append((p.offset, p.length))
    for places in held.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    left = []
    for n in sorted((n for places in held.values() for _, n in places), reverse=True):
        fits = [(r, k) for k, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(capacity - n)
    assert len(held) == len(left)
