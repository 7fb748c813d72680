"""Helpers that several operators share: UTF-8 blocks of Arrow batches, substring
fingerprints, packed entries for a shuffle, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.plans.scratch import discard, materialize

U = np.uint64
MASK = (1 << 64) - 1

# odd base of the polynomial fingerprints, and its inverse modulo 2^64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that close inputs give unrelated outputs."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & MASK], dtype=U))[0])


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 .. base^(n-1) and the same of the inverse, grown when asked for more."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", INVERSE)):
            out = np.empty(size, dtype=U)
            out[0] = 1
            out[1:] = U(base)
            np.multiply.accumulate(out, out=out)
            _powers[name] = out
    return _powers["up"][:n], _powers["down"][:n]


def byte_values(lower: bool = False) -> np.ndarray:
    """A random-looking 64-bit value per byte; ``lower`` gives A-Z the values of a-z."""
    table = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
    if lower:
        table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    return table


def prefix_sums(block: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Running sums of byte value times base power; ``fingerprint`` reads substrings from them."""
    up, _ = powers(len(block))
    out = np.empty(len(block) + 1, dtype=U)
    out[0] = 0
    np.cumsum(table[block] * up, out=out[1:])
    return out


def fingerprint(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the substrings [start, end), equal for equal bytes anywhere."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0xA0761D6478BD642F))


def utf8_blocks(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows with at most ``limit`` bytes (a longer text alone).

    Gives (first row, end row, bytes, offsets); offsets start at 0.  A null counts as empty.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, whole[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


# bytes of rows that Spark hands to Python at a time
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hold Arrow batches of the jobs inside to ``BATCH_BYTES``: texts are long, and both sides buffer whole batches."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until the table has no column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, byte plane by byte plane: sorted values compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    n = len(data) // width
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, n).T
    return out.view("<u8").reshape(-1)


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(U, copy=False).view(np.int64)


def unsigned(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, dtype=np.int64).view(U)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for nodes on an edge.

    Alternating large and small stars.  Minima are aggregated before the shuffle and joined
    back, so a node with very many neighbours is split like any skewed join key.
    """
    spark = edges.sparkSession
    current = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")  # repeats go with those of the result
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        following = materialize(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        discard(current)
        current = following
        # done when all nodes point at roots, each at one: no node has two arrows, or one and is pointed at
        ends = current.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            current.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if not ends.agg(F.max(F.expr("out > 1 OR out = 1 AND into = 1"))).first()[0]:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
