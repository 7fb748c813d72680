"""Quality scores: ridge regression on random Fourier features, calibrated to probabilities.

A text becomes a vector of statistics over all of it.  Random cosine features of the
standardised vector approximate a Gaussian kernel; tasks sum their share of the normal
equations, whose side is the number of features, and the driver solves them.  Labelled rows
are dealt into folds by the crc32 of their id, the sums are kept per fold, and every row is
scored for calibration by the equations of the other folds.  Isotonic regression over a
fixed grid of scores then gives a probability.  All labelled rows count; nothing is sampled.

Defined results: a null text is empty and is scored by its statistics, which are zero; a null
``doc_id`` is scored, not held out and never labelled; equal rows get equal scores; labels
other than 0 and 1 are ignored, and of several labels of one id the smallest counts.  Without
labels every score is 0.5, with one class it is that class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import utf8_blocks
from tableloom.llm.partenum import word_hashes
from tableloom.plans.scratch import discard, materialize

FOLDS = 5
HELD_OUT = 0
FEATURES = 128
WIDTH = 3.0
RIDGE = 1.0
GRID = 1000
THRESHOLD = 0.3
SEED = 20240611

# byte classes: lower case, upper case, digits, blanks, line ends, stops, quotes and dashes, other marks, non-ASCII, control
_CLASSES = 10
_CLASS = np.full(256, 9, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
_CLASS[[ord(c) for c in ".,;:?"]] = 5
_CLASS[[ord(c) for c in "'\"-()"]] = 6
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 7
_CLASS[128:] = 8
STATISTICS = _CLASSES + 8


def statistics(block: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics per text: shares of byte classes, words, their repetition, lines, length."""
    n_docs = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n_docs) * _CLASSES, size)
    shares = np.bincount(doc + _CLASS[block], minlength=n_docs * _CLASSES).reshape(n_docs, _CLASSES)
    words, first = word_hashes(block, offsets)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n_docs), n_words)
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    pair = np.zeros(len(words), dtype=bool)
    pair[2:] = (words[2:] == words[:-2]) & (owner[2:] == owner[:-2])
    distinct = np.zeros(n_docs)
    for d in np.flatnonzero(n_words > 0):
        own = np.sort(words[first[d] : first[d + 1]])
        distinct[d] = 1 + (own[1:] != own[:-1]).sum()
    bytes_ = np.maximum(size, 1)
    count = np.maximum(n_words, 1)
    upper_pairs = np.zeros(len(block), dtype=bool)
    upper_pairs[1:] = (_CLASS[block[1:]] == 1) & (_CLASS[block[:-1]] == 1)
    marks = np.zeros(len(block), dtype=bool)
    marks[1:] = (_CLASS[block[1:]] == 7) & (block[1:] == block[:-1])
    # a text's first byte has none before it
    starts = offsets[:-1][size > 0]
    upper_pairs[starts] = marks[starts] = False
    of = doc // _CLASSES
    out = np.zeros((n_docs, STATISTICS))
    out[:, :_CLASSES] = np.sqrt(shares / bytes_[:, None])
    out[:, _CLASSES] = np.log1p(n_words)
    out[:, _CLASSES + 1] = size / count
    out[:, _CLASSES + 2] = np.bincount(owner[again], minlength=n_docs) / count
    out[:, _CLASSES + 3] = np.bincount(owner[pair], minlength=n_docs) / count
    # distinct words against what a text of this length usually has
    out[:, _CLASSES + 4] = np.where(n_words > 0, np.log(np.maximum(distinct, 1)) / np.log(count + 1), 0)
    out[:, _CLASSES + 5] = np.sqrt(np.bincount(of[upper_pairs], minlength=n_docs) / bytes_)
    out[:, _CLASSES + 6] = np.sqrt(np.bincount(of[marks], minlength=n_docs) / bytes_)
    out[:, _CLASSES + 7] = np.log1p(shares[:, 4] / count * 100)
    out[size == 0] = 0
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = features(stats, self.mean, self.scale) @ self.weights
        return np.interp(raw, self.knots, self.values)


def features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Cosines of random projections, a constant last."""
    draw = np.random.default_rng(SEED)
    w = draw.normal(0, 1 / WIDTH, (STATISTICS, FEATURES))
    b = draw.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / scale, -8, 8)
    z = np.sqrt(2 / FEATURES) * np.cos(x @ w + b)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


STORED = "doc_id long, stats binary"


def statistics_table(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) for every row; the statistics are packed doubles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, block, offsets in utf8_blocks(batch.column(1)):
                packed = [x.tobytes() for x in statistics(block, offsets).astype("<f4")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(packed, pa.binary())], ["doc_id", "stats"]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, STORED)


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, STATISTICS).astype(np.float64)


def pooled(scores: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of ones / n over ascending scores by pooling adjacent violators: (knots, values)."""
    blocks: list[list[float]] = []
    for s, k, m in zip(scores, ones, n):
        blocks.append([s * m, k, m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    knots = np.array([b[0] / b[2] for b in blocks])
    return knots, np.array([b[1] / b[2] for b in blocks])


def constant(value: float) -> Model:
    zero = np.zeros(STATISTICS)
    return Model(zero, zero + 1, np.zeros(FEATURES + 1), np.zeros(1), np.array([value]))


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of ``stats`` (doc_id, stats) that ``labels`` (doc_id, quality) marks and no test holds out."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("y"))
    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS).cast("int")
    rows = materialize(stats.join(known, "doc_id").select("stats", "y", fold.alias("fold")))
    moments = rows.groupBy("y").agg(F.count("*").alias("n")).collect()
    if len(moments) < 2:
        discard(rows)
        return constant(0.5 if not moments else float(moments[0].y))
    mean, scale = _moments(rows)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = FEATURES + 1
        sums = np.zeros((FOLDS, side, side + 1))
        for batch in batches:
            z = features(_unpacked(batch.column(0)), mean, scale)
            y = batch.column(1).to_numpy().astype(np.float64)
            folds = batch.column(2).to_numpy()
            both = np.concatenate([z, y[:, None]], axis=1)
            for f in np.unique(folds):
                at = folds == f
                sums[f] += z[at].T @ both[at]
        live = [(f, i) for f in range(FOLDS) if sums[f].any() for i in range(side)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f for f, _ in live], pa.int32()), pa.array([i for _, i in live], pa.int32()),
                pa.array([sums[f, i] for f, i in live], pa.list_(pa.float64())),
            ],
            ["fold", "i", "v"],
        )

    # one row per fold and feature, summed over the tasks
    parts = rows.mapInArrow(equations, "fold int, i int, v array<double>").groupBy("fold", "i")
    parts = parts.agg(F.array(*[F.sum(F.col("v")[j]) for j in range(FEATURES + 2)]).alias("v")).collect()
    sums = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
    for r in parts:
        sums[r.fold, r.i] = r.v
    ridge = RIDGE * np.eye(FEATURES + 1)
    ridge[-1, -1] = 1e-6

    def solved(total: np.ndarray) -> np.ndarray:
        return np.linalg.solve(total[:, :-1] + ridge, total[:, -1])

    whole = sums.sum(axis=0)
    by_fold = np.stack([solved(whole - sums[f]) for f in range(FOLDS)])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = features(_unpacked(batch.column(0)), mean, scale)
            raw = (z * by_fold[batch.column(2).to_numpy()]).sum(axis=1)
            cell = np.clip(np.round(raw * GRID), -GRID, 2 * GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(1)], ["cell", "y"])

    # a row per cell of the grid at most
    cells = rows.mapInArrow(scored, "cell int, y int").groupBy("cell")
    cells = cells.agg(F.sum("y").alias("k"), F.count("*").alias("n")).orderBy("cell").collect()
    discard(rows)
    knots, values = pooled(
        np.array([c.cell / GRID for c in cells]), np.array([float(c.k) for c in cells]), np.array([float(c.n) for c in cells])
    )
    return Model(mean, scale, solved(whole), knots, values)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, STATISTICS))
        for batch in batches:
            x = _unpacked(batch.column(0))
            total += np.stack([np.full(STATISTICS, len(x)), x.sum(axis=0), (x * x).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.arange(STATISTICS), *total)], ["i", "n", "a", "b"])

    out = rows.mapInArrow(sums, "i long, n double, a double, b double").groupBy("i")
    out = out.agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).orderBy("i").collect()
    n, a, b = (np.array([r[k] for r in out]) for k in ("n", "a", "b"))
    mean = a / n
    deviation = np.sqrt(np.maximum(b / n - mean * mean, 0))
    return mean, np.where(deviation > 1e-6, deviation, 1.0)


def score_table(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``stats``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(_unpacked(batch.column(1))))], ["doc_id", "score"]
            )

    scored = stats.mapInArrow(rows, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the model does not reject."""
    at = docs.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [np.zeros(0, dtype=bool)]
            for _, _, block, offsets in utf8_blocks(batch.column(at)):
                # the table's statistics are single precision
                stats = statistics(block, offsets).astype("<f4").astype(np.float64)
                keep.append(model.score(stats) >= THRESHOLD)
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(rows, docs.schema)
