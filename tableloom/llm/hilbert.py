"""Approximate nearest neighbours over shifted Hilbert curves.

Vectors are projected on ``AXES`` random orthogonal directions per curve, shifted at random
and ordered along the curve through the projected cells.  Spark range-partitions and sorts
every curve's keys; counts per task turn them into ranks, and a row's ranks on all curves join
its vector once.  A query's window on a curve holds the rows whose rank is near its own: half
of ``SHARE`` of all rows to either side.  The windows of all curves are merged: rows in at
least ``VOTES`` of them, and those within k ranks on the first curve, are compared on the
original vectors, each once.

Rows lie in blocks of ``BLOCK`` along the first curve, queries in chunks of ``CHUNK``.  Both know
the least and greatest rank they hold on every curve, and a block meets a chunk, as a group of
its own, only if enough windows can reach it.  Nothing that counts is passed over by that.

The window is a share of the rows, so recall does not fall as the table grows.  ``SHARE`` is
set for vectors without any structure, for which all methods have to look at much of the
table; for vectors that lie in clusters a far smaller share does, and few blocks are met.

Defined results: vectors that are null, empty, zero, or hold a null or a non-finite component,
and rows with a null id take no part; of several rows with one id the smallest vector counts;
shorter vectors count as padded with zeros; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.bitslice import usable
from tableloom.llm.common import partitions
from tableloom.plans.scratch import discard, materialize, temporary

CURVES = 32
AXES = 3
BITS = 12
SHARE = 0.1
# windows that must hold a row
VOTES = 3
BLOCK = 1024
CHUNK = 1024
# rows that centre and scale the projections; they decide balance only
SAMPLE = 2048
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (rows) with ``bits`` bits per axis.

    The transpose form: undo the excess rotations axis by axis from the top bit down, Gray
    decode, then interleave the axes' bits.  At most 63 bits in all.
    """
    x = [cells[:, i].astype(np.uint64).copy() for i in range(cells.shape[1])]
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = np.uint64(1 << b)
        p = q - one
        for i in range(n):
            flip = (x[i] & q) > 0
            t = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = x[i] ^ t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = np.uint64(1 << b)
        t = np.where((x[n - 1] & q) > 0, t ^ (q - one), t)
    key = np.zeros_like(x[0])
    for i in range(n):
        x[i] ^= t
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key


def curve_key(x: np.ndarray, curve: int, mean: np.ndarray, spread: float) -> np.ndarray:
    draw = np.random.default_rng([SEED, curve])
    axes = min(AXES, x.shape[1])
    directions = np.linalg.qr(draw.normal(size=(x.shape[1], axes)))[0]
    shift = draw.uniform(-0.12, 0.12, axes)
    unit = (x - mean) @ directions / (8 * spread) + 0.5 + shift
    cells = (np.clip(unit, 0, 1 - 1e-9) * (1 << BITS)).astype(np.int64)
    return hilbert_keys(cells, BITS).astype(np.int64)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors that are not zero, one row per id."""
    doubles = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    doubles = doubles.where(F.col("vec_id").isNotNull() & usable(F.col("v")) & F.exists("v", lambda x: x != 0))
    return doubles.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(lists: list, side: int) -> np.ndarray:
    out = np.zeros((len(lists), side))
    for i, row in enumerate(lists):
        out[i, : len(row)] = row
    return out


LAID = "curve int, vec_id long, task int, place long"


def laid_out(rows: DataFrame, side: int, curves: int) -> DataFrame:
    """Every id once per curve, sorted along it; ``place`` counts a task's rows of a curve."""
    drawn = rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("v").collect()
    sample = _matrix([r.v for r in drawn], side)
    mean = sample.mean(axis=0)
    # the root mean square along a direction
    spread = float(np.sqrt(np.mean((sample - mean) ** 2))) or 1.0

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                x = _matrix(part.column(1).to_pylist(), side)
                for curve in range(curves):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), curve, np.int32)), pa.array(curve_key(x, curve, mean, spread)), part.column(0)],
                        ["curve", "key", "vec_id"],
                    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), np.zeros(curves, dtype=np.int64)
        for batch in batches:
            curve = batch.column(0).to_numpy()
            place = np.empty(len(curve), dtype=np.int64)
            for c in np.unique(curve):
                at = np.flatnonzero(curve == c)
                place[at] = before[c] + np.arange(len(at))
                before[c] += len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.full(len(curve), task, np.int32)), pa.array(place)],
                ["curve", "vec_id", "task", "place"],
            )

    out = rows.select("vec_id", "v").mapInArrow(keyed, "curve int, key long, vec_id long")
    out = out.repartitionByRange(partitions(rows.sparkSession), "curve", "key", "vec_id")
    return out.sortWithinPartitions("curve", "key", "vec_id").mapInArrow(placed, LAID)


def ranked(rows: DataFrame, side: int, curves: int) -> DataFrame:
    """(vec_id, v, ranks): every row with its rank on each curve."""
    laid = materialize(laid_out(rows, side, curves))
    # a row per task and curve
    sizes = laid.groupBy("curve", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("curve").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(sizes.select("curve", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    at = laid.join(starts, ["curve", "task"]).select("vec_id", F.struct("curve", (F.col("start") + F.col("place")).alias("at")).alias("r"))
    ranks = at.groupBy("vec_id").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["at"]).alias("ranks"))
    out = materialize(rows.join(ranks, "vec_id"))
    discard(laid)
    return out


PACKED = "ids binary, vectors binary, ranks binary, low array<bigint>, high array<bigint>"


def _packed(rows: DataFrame, group: Column, name: str, side: int) -> DataFrame:
    """A row per group: its rows, by id, and the least and greatest rank on every curve."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ranks = np.array(table.column("ranks").to_pylist(), dtype="<i8")
        return pa.table({
            name: pa.array([key[0].as_py()], pa.int32()), "ids": [table.column("vec_id").to_numpy().astype("<i8").tobytes()],
            "vectors": [_matrix(table.column("v").to_pylist(), side).astype("<f8").tobytes()], "ranks": [ranks.tobytes()],
            "low": pa.array([ranks.min(axis=0).tolist()], pa.list_(pa.int64())), "high": pa.array([ranks.max(axis=0).tolist()], pa.list_(pa.int64())),
        })

    return rows.groupBy(group.cast("int").alias(name)).applyInArrow(pack, f"{name} int, {PACKED}")


def _reached(reach: int) -> Column:
    """On how many curves a window of ``reach`` ranks around a chunk's rows touches a block's."""
    touches = F.zip_with(
        F.arrays_zip("low", "high"), F.arrays_zip("q_low", "q_high"),
        lambda b, q: (b["low"] <= q["q_high"] + reach) & (b["high"] >= q["q_low"] - reach),
    )
    return F.size(F.filter(touches, lambda t: t))


def candidates(ranks: np.ndarray, own: np.ndarray, reach: int, votes: int, k: int) -> np.ndarray:
    """Which rows a query of ranks ``own`` is compared with."""
    apart = np.abs(ranks - own)
    return ((apart <= reach).sum(axis=1) >= votes) | (apart[:, 0] <= k)


def nearest(
    vectors: DataFrame, is_query: Column, k: int, curves: int = CURVES, share: float = SHARE, votes: int = VOTES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, by Euclidean distance."""
    spark = vectors.sparkSession
    with temporary(spark) as left_over:
        rows = materialize(valid_vectors(vectors))
        n, side = rows.agg(F.count("*"), F.max(F.size("v"))).first()
        asked = rows.where(is_query).count()
        if not n or not asked:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        left_over.append(materialize(_found(ranked(rows, side, curves), is_query, k, n, asked, side, share, min(votes, curves))))
    return left_over[0]


def _found(rows: DataFrame, is_query: Column, k: int, n: int, asked: int, side: int, share: float, votes: int) -> DataFrame:
    reach = max(k, ceil(share * n / 2))
    chunks = max(1, ceil(asked / CHUNK))
    blocks = materialize(_packed(rows, F.floor(F.col("ranks")[0] / BLOCK), "block", side))
    queries = materialize(_packed(rows.where(is_query), F.floor(F.col("ranks")[0] * chunks / n), "chunk", side))
    boxes = blocks.select("block", "low", "high").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asking = queries.select("chunk", F.col("low").alias("q_low"), F.col("high").alias("q_high"))
    beside = (F.col("low")[0] <= F.col("q_high")[0] + k) & (F.col("high")[0] >= F.col("q_low")[0] - k)
    pairs = materialize(boxes.join(asking, "chunk").where((_reached(reach) >= votes) | beside).select("block", "chunk"))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            block, chunk = left.to_pylist()[0], right.to_pylist()[0]
            ids, x, ranks = (np.frombuffer(block[c], t) for c, t in (("ids", "<i8"), ("vectors", "<f8"), ("ranks", "<i8")))
            x, ranks = x.reshape(len(ids), -1), ranks.reshape(len(ids), -1)
            asked_ids = np.frombuffer(chunk["ids"], "<i8")
            own_x = np.frombuffer(chunk["vectors"], "<f8").reshape(len(asked_ids), -1)
            own_ranks = np.frombuffer(chunk["ranks"], "<i8").reshape(len(asked_ids), -1)
            for query, vector, own in zip(asked_ids.tolist(), own_x, own_ranks):
                near = np.flatnonzero(candidates(ranks, own, reach, votes, k) & (ids != query))
                far = np.sqrt(((x[near] - vector) ** 2).sum(axis=1))
                if len(near) > k:
                    # everything up to the k-th distance, so that ties stay
                    close = far <= np.partition(far, k - 1)[k - 1]
                    near, far = near[close], far[close]
                order = np.lexsort((ids[near], far))[:k]
                out += zip([query] * len(order), ids[near[order]].tolist(), far[order].tolist())
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.table({
            "query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())
        })

    meeting = blocks.select("block", "ids", "vectors", "ranks").join(pairs, "block")
    asking = queries.select("chunk", "ids", "vectors", "ranks").join(pairs, "chunk")
    # both sides come from one table; new names for one of them keep them apart
    asking = asking.select(*[F.col(c).alias(f"q_{c}") for c in asking.columns]).toDF(*asking.columns)
    found = meeting.groupBy("block", "chunk").cogroup(asking.groupBy("block", "chunk")).applyInArrow(
        best, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")
