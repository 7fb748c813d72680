"""Hard negatives of anchors by the threshold algorithm over sorted lists per dimension.

Components become integers.  Rows are dealt into blocks of bounded size; a block keeps, for
every dimension, its rows in the order of that component.  For an anchor each list is read
from the end that its component's sign asks for, all lists to the same depth; a row met for
the first time is scored at once from its own components (random access), in integers.  No
row that is still unseen can score more than the sum of the anchor's components times the
values the lists have reached: the threshold.  A search over windows of scores ends for a
window when its k-th score in the block is known and the threshold is strictly below it, or
when the threshold is below the window's lower end; rows that tie with the threshold are still
read.  Lists are read in runs that double, and once they have met half the rows that count they
are read to their ends at once, so a block costs about one pass over its rows however flat the scores are.

An anchor's positives are its best rows of the same label; each opens a window of scores for
rows of other labels.  Both searches are searches over windows, the first with one that is
open on both sides.  A block returns at most k rows per window, so nothing larger than that
leaves a task, and no group is larger than a block and a chunk of anchors.

Defined results: rows whose label, vector, id or any component is null, or a component is not
finite, take no part; of several rows with one id the smallest vector, then label, counts;
shorter vectors count as padded with zeros; equal scores come by the smaller id; positives with
equal scores get the same negatives; an anchor without positives, and a positive without rows in
its window, have no rows; components or scores beyond 64 bits raise an error; other columns are
ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.bitslice import BEYOND, LEAST, usable
from tableloom.plans.scratch import materialize

SCALE = 256
# rows of a block, anchors of a chunk, and the rows that each list gives first
BLOCK = 1 << 13
CHUNK = 1 << 12
RUN = 32


def labelled(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, q): floor(scale * x) per component of the usable rows, one row per id."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    fits = lambda x: (x * scale >= float(LEAST)) & (x * scale < float(BEYOND))
    beyond = F.raise_error(F.lit("a quantised component is beyond 64 bits"))
    q = F.transform("v", lambda x: F.when(fits(x), F.floor(x * scale)).otherwise(beyond))
    best = rows.select("vec_id", "label", q.alias("q")).groupBy("vec_id").agg(F.min(F.struct("q", "label")).alias("r"))
    return best.select("vec_id", "r.label", "r.q")


def _matrix(column: pa.ChunkedArray, side: int) -> np.ndarray:
    out = np.zeros((len(column), side), dtype=np.int64)
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return out


class SortedLists:
    """The rows of a block, by ascending id, and for each dimension their order by component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, order: np.ndarray):
        self.ids, self.labels, self.q, self.order = ids, labels, q, order
        self.width = max((abs(int(x)) for x in (q.min(), q.max())), default=0) if q.size else 0
        self.values: dict[type, np.ndarray] = {}

    def _type(self, anchor: np.ndarray):
        # sums stay exact in doubles up to 2^53, in 64-bit integers up to 2^63, beyond that in Python's
        most = sum(abs(int(a)) for a in anchor) * self.width
        return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[list[tuple[int, int]]]:
        """For each window (lowest, highest score) the (position, score) of its k best allowed rows.

        Higher scores come first, equal ones by position; ``None`` leaves an end open.
        """
        dims, kind, n = np.flatnonzero(anchor), self._type(anchor), len(self.ids)
        if kind not in self.values:
            self.values[kind] = self.q.astype(kind)
        values, a = self.values[kind], anchor.astype(kind)
        # a positive component reads its list from the largest value down, a negative one from the smallest up
        up, down = dims[anchor[dims] < 0], dims[anchor[dims] > 0]
        unseen, wanted = allowed.copy(), int(allowed.sum())
        at, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=kind)
        open_windows = set(range(len(windows)))
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        depth = 0
        while True:
            until = min(n, max(RUN, 2 * depth))
            if not len(dims) or 2 * len(at) >= wanted:
                until = n
            if until == n:
                met = np.flatnonzero(unseen)
            else:
                reached = np.zeros(n, dtype=bool)
                reached[self.order[down, n - until : n - depth].ravel()] = True
                reached[self.order[up, depth:until].ravel()] = True
                met = np.flatnonzero(reached & unseen)
            unseen[met] = False
            at = np.concatenate([at, met])
            # random access; most of the rows are scored together
            scores = np.concatenate([scores, values[met] @ a if 4 * len(met) < n else (values @ a)[met]])
            depth, threshold = until, None
            if depth < n and unseen.any():
                last = sum(int(a[d]) * int(self.q[self.order[d, n - depth], d]) for d in down.tolist())
                threshold = last + sum(int(a[d]) * int(self.q[self.order[d, depth - 1], d]) for d in up.tolist())
            for w in sorted(open_windows):
                low, high = windows[w]
                inside = np.ones(len(at), dtype=bool)
                if low is not None:
                    inside &= (scores >= low).astype(bool)
                if high is not None:
                    inside &= (scores <= high).astype(bool)
                found = np.flatnonzero(inside)
                if len(found) > k:
                    # all that reach the k-th score, ties included, then by score and position
                    kth = np.partition(scores[found], len(found) - k)[len(found) - k] if kind is not object else sorted(scores[found])[-k]
                    found = found[scores[found] >= kth]
                best[w] = [(p, -s) for s, p in sorted((-int(scores[i]), int(at[i])) for i in found)[:k]]
                full = len(best[w]) == k and threshold is not None and threshold < best[w][-1][1]
                below = threshold is not None and low is not None and threshold < low
                if threshold is None or full or below:
                    open_windows.discard(w)
            if not open_windows:
                return best


def _index(rows: DataFrame, side: int, blocks: int) -> DataFrame:
    """A row per block: ids, labels, components and sorted lists, packed."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        q = _matrix(table.column("q"), side)
        order = np.argsort(q, axis=0, kind="stable").T
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int32()), "ids": [table.column("vec_id").to_numpy().astype("<i8").tobytes()],
            "labels": [table.column("label").to_numpy().astype("<i8").tobytes()], "q": [q.astype("<i8").tobytes()],
            "lists": [np.ascontiguousarray(order).astype("<i4").tobytes()],
        })

    place = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    return rows.groupBy(place.alias("block")).applyInArrow(build, "block int, ids binary, labels binary, q binary, lists binary")


FOUND = "anchor_id long, lowest long, highest long, vec_id long, score long"


def _searched(index: DataFrame, asked: DataFrame, side: int, blocks: int, chunks: int, k: int, same: bool) -> DataFrame:
    """The k best rows of each block in each window of ``asked`` (anchor_id, label, q, lowest, highest)."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            row = left.to_pylist()[0]
            ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
            lists = SortedLists(
                ids, labels, np.frombuffer(row["q"], "<i8").reshape(-1, side), np.frombuffer(row["lists"], "<i4").reshape(side, -1)
            )
            of_label = {int(v): labels == v for v in np.unique(labels)}
            right = right.sort_by("anchor_id")
            anchors, own, q = right.column("anchor_id").to_pylist(), right.column("label").to_pylist(), _matrix(right.column("q"), side)
            low, high = right.column("lowest").to_pylist(), right.column("highest").to_pylist()
            first = 0
            while first < len(anchors):
                end = first
                while end < len(anchors) and anchors[end] == anchors[first]:
                    end += 1
                alike = of_label.get(own[first], np.zeros(len(ids), dtype=bool))
                allowed = alike.copy() if same else ~alike
                place = int(np.searchsorted(ids, anchors[first]))
                if place < len(ids) and ids[place] == anchors[first]:
                    allowed[place] = False
                windows = list(zip(low[first:end], high[first:end]))
                for (a, b), rows in zip(windows, lists.search(q[first], allowed, windows, k)):
                    out += [(anchors[first], a, b, int(ids[p]), s) for p, s in rows]
                first = end
        if any(not LEAST <= r[4] < BEYOND for r in out):
            raise OverflowError("a score is beyond 64 bits")
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.table({c.split()[0]: pa.array(v, pa.int64()) for c, v in zip(FOUND.split(", "), cols)})

    chunk = F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(chunks)).cast("int")
    blocks_each = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = asked.withColumn("chunk", chunk).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return blocks_each.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(search, FOUND)


def hard_negatives(
    vectors: DataFrame, label: Column, is_anchor: Column, positives: int, negatives: int, margin: int = 80, scale: int = SCALE
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor and each of its ``positives`` best rows of the same label, the ``negatives`` best
    rows of other labels with margin * positive_score <= 100 * negative_score <= 100 * positive_score.
    """
    rows = materialize(labelled(vectors, label, scale))
    n, side = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    side = max(side or 0, 1)
    anchors = rows.where(is_anchor).withColumnRenamed("vec_id", "anchor_id")
    # groups of bounded size: a block of rows and a chunk of anchors
    blocks, chunks = max(1, ceil(n / BLOCK)), max(1, ceil(anchors.count() / CHUNK))
    index = materialize(_index(rows, side, blocks))
    nothing = F.lit(None).cast("long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    alike = _searched(
        index, anchors.withColumn("lowest", nothing).withColumn("highest", nothing), side, blocks, chunks, positives, True
    )
    alike = materialize(alike.withColumn("at", F.row_number().over(best)).where(F.col("at") <= positives))
    # 64-bit products by a hundred may overflow: whole numbers of 38 digits hold them
    score = F.col("score").cast("decimal(20,0)")
    lowest = F.ceil(score * margin / 100).cast("long")
    wanted = alike.select("anchor_id", lowest.alias("lowest"), F.col("score").alias("highest")).where("lowest <= highest").distinct()
    other = _searched(index, wanted.join(anchors, "anchor_id"), side, blocks, chunks, negatives, False)
    within = Window.partitionBy("anchor_id", "highest").orderBy(F.desc("score"), "vec_id")
    other = other.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= negatives)
    other = other.select("anchor_id", "rank", F.col("highest").alias("positive_score"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    alike = alike.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return alike.join(other, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
