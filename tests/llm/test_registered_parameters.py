"""op3, op8, op9 and op10 as registered, with their own parameters, against brute force."""

import collections

import numpy as np
import plain
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tableloom.llm import hilbert, quality
from tableloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    directory, rows = tmp_path_factory.mktemp("corpus"), plain.corpus(9)
    plain.write(directory, rows)
    return str(directory), rows


def test_op3(spark, corpus):
    directory, rows = corpus
    want = plain.scores(rows)
    got = QUERIES["op3_quality_classifier"](spark, directory).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got} == set(want)
    assert {r.doc_id: r.held_out for r in got} == {i: held for i, (held, _) in want.items()}
    assert max(abs(r.score - want[r.doc_id][1]) for r in got) < 1e-6
    assert all(r.predicted == (r.score >= 0.3) for r in got) and {r.predicted for r in got} == {0, 1}


def test_statistics_of_a_text_alone():
    texts = [b"ends IN CAPITALS", b"CAPITALS first ##", b"## marks", b"", b"#", b"A", b"B"]
    offsets = np.cumsum([0, *map(len, texts)])
    got = quality.statistics(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert np.allclose(got, [plain.statistics(t.decode()) for t in texts])


def test_op8(spark, corpus):
    directory, rows = corpus
    got = sorted(map(tuple, QUERIES["op8_suffix_array_dedup"](spark, directory).collect()))
    want = sorted(plain.removed(rows))
    assert got == want and any(r[2] == 200 for r in want) and any(not r[2] for r in want)


def test_op10(spark, corpus):
    directory, rows = corpus
    pieces = QUERIES["op10_best_fit_packing"](spark, directory).collect()
    plain.check_packed(pieces, rows)
    assert max(p.length for p in pieces) == 1024 and max(p.piece for p in pieces) > 2


def test_op9(spark, tmp_path):
    rng = np.random.default_rng(6)
    n, side = 2000, 24
    x = rng.normal(size=(n, side)).astype("f4").astype(float)
    x[50:90] = x[50]  # ties
    ids = rng.permutation(3 * n)[:n]
    ids[:20] = np.arange(20) * 100
    ids[20:] = [i + 1 if i % 100 == 0 else i for i in ids[20:]]
    ids, first = np.unique(ids, return_index=True)
    x, n = x[first], len(ids)
    table = {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(x.astype("f4").tolist(), pa.list_(pa.float32()))}
    pq.write_table(pa.table(table), f"{tmp_path}/embeddings.parquet", row_group_size=300)
    mean = x.mean(axis=0)
    spread = float(np.sqrt(np.mean((x - mean) ** 2)))
    reach = max(10, int(np.ceil(hilbert.SHARE * n / 2)))
    place = np.empty((hilbert.CURVES, n), dtype=int)
    for curve in range(hilbert.CURVES):
        place[curve, np.lexsort((ids, hilbert.curve_key(x, curve, mean, spread)))] = np.arange(n)
    near = {}
    for k in np.flatnonzero(ids % 100 == 0).tolist():
        apart = np.abs(place - place[:, [k]])
        held = ((apart <= reach).sum(axis=0) >= hilbert.VOTES) | (apart[0] <= 10)
        near[k] = set(np.flatnonzero(held).tolist()) - {k}
    got = collections.defaultdict(list)
    for r in QUERIES["op9_hilbert_neighbours"](spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert len(got) == len(near) >= 20 and n > hilbert.BLOCK and n <= hilbert.SAMPLE
    for k, others in near.items():
        rated = sorted((float(np.sqrt(((x[k] - x[j]) ** 2).sum())), int(ids[j])) for j in others)[:10]
        assert [(rank, i) for rank, i, _ in got[ids[k]]] == [(rank, i) for rank, (_, i) in enumerate(rated, 1)]
        assert np.allclose([d for _, _, d in got[ids[k]]], [d for d, _ in rated])
