"""Exact top-k inner products of quantised vectors from a bit-sliced index.

Components become integers.  A block of rows is stored as bitmaps: one slice per dimension
and bit, after the dimension's least value is taken off.  A query's score is a sum of slices
at the bit positions of its own components (complements for negative ones), added for all
rows of a block at once by full adders on the bitmaps.  The rows with the highest scores are
then read from the most significant slice downward; at the boundary the rows with equal
scores are known exactly and the smallest ids among them are taken.

Blocks hold a bounded number of rows and chunks a bounded number of queries, and every chunk
meets every block as one task-sized group, so no group grows with the input.

Defined results: vectors that are null, or hold a null or a non-finite component, and rows
with a null id take no part; of several rows with one id the smallest vector counts; shorter
vectors count as padded with zeros.  Blocks hold as many slices as their components need, and
sums grow past 64 bits where they have to; a component or one of the k highest scores that is no
64-bit integer raises an error.
"""

from __future__ import annotations

from collections import defaultdict
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.plans.scratch import materialize

SCALE = 64
BLOCK = 1 << 15
CHUNK = 256
LEAST, BEYOND = -(1 << 63), 1 << 63


def usable(vector: Column) -> Column:
    """Whether a vector of doubles is there with finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): floor(scale * x) per component, one row per id."""
    doubles = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    doubles = doubles.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    fits = lambda x: (x * scale >= float(LEAST)) & (x * scale < float(BEYOND))
    beyond = F.raise_error(F.lit("a quantised component is beyond 64 bits"))
    q = F.transform("v", lambda x: F.when(fits(x), F.floor(x * scale)).otherwise(beyond))
    return doubles.select("vec_id", q.alias("q")).groupBy("vec_id").agg(F.min("q").alias("q"))


def _matrix(column: pa.ChunkedArray, side: int) -> np.ndarray:
    out = np.zeros((len(column), side), dtype=np.int64)
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return out


def slices_of(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Least value per dimension, and per dimension its bitmaps (bits, words) from the lowest bit up."""
    low = x.min(axis=0)
    up = (x.astype(np.uint64) - low.astype(np.uint64)).T  # unsigned, the difference may take 64 bits
    pad = -len(x) % 64
    out = []
    for values in up:
        bits = int(values.max()).bit_length()
        planes = (values[None, :] >> np.arange(bits, dtype=np.uint64)[:, None]) & np.uint64(1)
        planes = np.pad(planes.astype(np.uint8), ((0, 0), (0, pad)))
        out.append(np.packbits(planes, axis=1, bitorder="little").view("<u8"))
    return low, out


def score_slices(q: np.ndarray, low: np.ndarray, slices: list[np.ndarray], words: int) -> tuple[int, list[np.ndarray]]:
    """The query's scores of all rows of a block as a constant plus bitmaps from the lowest bit up."""
    constant = 0
    weights: defaultdict[int, list[np.ndarray]] = defaultdict(list)
    for d in np.flatnonzero(q):
        a, planes = abs(int(q[d])), slices[d]
        if q[d] > 0:
            constant += a * int(low[d])
        else:
            planes = ~planes
            constant -= a * ((1 << len(planes)) - 1 + int(low[d]))
        j = 0
        while a >> j:
            if a >> j & 1:
                for b, plane in enumerate(planes):
                    weights[j + b].append(plane)
            j += 1
    out, w = [], 0
    while w <= max(weights, default=-1):
        level = weights[w]
        while len(level) > 2:
            # full adder: three bitmaps of a weight become one, and one of the next weight
            a, b, c = level.pop(), level.pop(), level.pop()
            half = a ^ b
            level.append(half ^ c)
            weights[w + 1].append((a & b) | (half & c))
        if len(level) == 2:
            a, b = level
            weights[w + 1].append(a & b)
            level[:] = [a ^ b]
        out.append(level[0] if level else np.zeros(words, dtype="<u8"))
        w += 1
    while out and not out[-1].any():
        out.pop()
    return constant, out


def top_rows(scores: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores among the allowed rows, ties to the lowest position."""
    tied, sure, need = allowed.copy(), np.zeros_like(allowed), k
    for plane in reversed(scores):
        ones = tied & plane
        n = int(np.bitwise_count(ones).sum())
        if n > need:
            tied = ones
        else:
            sure |= ones
            need -= n
            tied &= ~plane
            if not need:
                break
    chosen = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    if need:
        chosen = np.concatenate([chosen, np.flatnonzero(np.unpackbits(tied.view(np.uint8), bitorder="little"))[:need]])
    return chosen


def totals(constant: int, scores: list[np.ndarray], at: np.ndarray) -> list[int | None]:
    """Scores at these positions; one below the 64-bit integers is None, one above raises."""
    wide = len(scores) > 61 or abs(constant) >> 61
    total = np.full(len(at), constant, dtype=object if wide else np.int64)
    for w, plane in enumerate(scores):
        bit = (plane[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
        total += bit.astype(np.int64).astype(total.dtype) << w
    out = total.tolist()
    if wide and max(out, default=0) >= BEYOND:
        raise OverflowError("a score is beyond 64 bits")
    return [x if x >= LEAST else None for x in out]


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with all other rows."""
    rows = materialize(quantised(vectors, scale))
    n, side = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    side = max(side or 0, 1)
    wanted = rows.where(is_query)
    blocks, chunks = max(1, ceil(n / BLOCK)), max(1, ceil(wanted.count() / CHUNK))

    def index(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        low, slices = slices_of(_matrix(table.column("q"), side))
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int32()), "ids": [table.column("vec_id").to_numpy().astype("<i8").tobytes()],
            "low": [low.astype("<i8").tobytes()], "bits": [bytes(len(s) for s in slices)],
            "slices": [b"".join(s.tobytes() for s in slices)],
        })

    def gathered(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table({
            "chunk": pa.array([key[0].as_py()], pa.int32()), "query_ids": [table.column("vec_id").to_numpy().astype("<i8").tobytes()],
            "q": [_matrix(table.column("q"), side).astype("<i8").tobytes()],
        })

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int | None]] = []
        if left.num_rows and right.num_rows:
            row = left.to_pylist()[0]
            ids, low = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["low"], "<i8")
            words = -(-len(ids) // 64)
            flat = np.frombuffer(row["slices"], "<u8").reshape(-1, words)
            ends = np.cumsum(list(row["bits"]))
            slices = [flat[e - b : e] for e, b in zip(ends, row["bits"])]
            everyone = np.packbits(np.pad(np.ones(len(ids), np.uint8), (0, -len(ids) % 64)), bitorder="little").view("<u8")
            row = right.to_pylist()[0]
            for query, q in zip(np.frombuffer(row["query_ids"], "<i8"), np.frombuffer(row["q"], "<i8").reshape(-1, side)):
                constant, scores = score_slices(q, low, slices, words)
                allowed = everyone
                own = np.searchsorted(ids, query)
                if own < len(ids) and ids[own] == query:
                    allowed = everyone.copy()
                    allowed[own // 64] &= ~np.uint64(1 << (int(own) % 64))
                at = top_rows(scores, allowed, k)
                found += zip([int(query)] * len(at), ids[at].tolist(), totals(constant, scores, at))
        cols = list(zip(*found)) if found else [[], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), cols)})

    place = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    built = rows.groupBy(place.alias("block")).applyInArrow(index, "block int, ids binary, low binary, bits binary, slices binary")
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).cast("int")
    asked = wanted.groupBy(part.alias("chunk")).applyInArrow(gathered, "chunk int, query_ids binary, q binary")
    built = built.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = built.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(
        searched, "query_id long, vec_id long, score long"
    )
    # a null score lies below all others: an error only if it is among the highest of all blocks
    order = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    score = F.coalesce("score", F.raise_error(F.lit("a score is beyond 64 bits")))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
