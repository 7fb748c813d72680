"""Samples and splits from repeatable draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.draws import BITS, draw, draw_below
from tableloom.plans.ordered import OrderedRows
from tableloom.plans.skew import join_small


def shuffled(df: DataFrame, id_col: str, seed: int, keys: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Number the rows of every key in a random order."""
    ordered = OrderedRows(
        df.withColumn("_draw", draw(seed, "shuffle", F.col(id_col))), keys, ["_draw", id_col]
    )
    return ordered.numbered(name).drop("_draw")


def split_exact(df: DataFrame, id_col: str, ratio: float, seed: int, name: str = "is_train") -> DataFrame:
    """Mark exactly ``int(n * ratio)`` random rows: those with the smallest draws.

    The last marked draw is found by counting draws by their first 16 and then
    their next 16 bits, two aggregations of at most 65,536 rows each; the few
    rows that agree in both are sorted.  The mark itself is a comparison inside
    the row, so the table is neither sorted nor moved.
    """
    drawn = draw(seed, "split", F.col(id_col))
    wanted = None
    top = F.shiftright(drawn, BITS - 32)
    low_bits, chosen = 16, F.lit(True)
    at = 0
    for level, bucket in enumerate((F.shiftright(top, low_bits), top % (1 << low_bits))):
        sizes = df.where(chosen).groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()
        if wanted is None:
            wanted = int(sum(r["n"] for r in sizes) * ratio)
            if wanted == 0:
                return df.withColumn(name, F.lit(False))
        for row in sorted(sizes, key=lambda r: r["b"]):
            if wanted <= row["n"]:
                at = (at << low_bits) + row["b"]
                break
            wanted -= row["n"]
        chosen = (F.shiftright(top, low_bits) == at) if level == 0 else (top == at)
    # what agrees in 32 bits is a handful of rows; the id decides among equal draws
    few = df.where(chosen).select(drawn.alias("d"), F.col(id_col).alias("i")).orderBy("d", "i").limit(wanted)
    last = few.agg(F.max(F.struct("d", "i")).alias("m")).first().m
    marked = (drawn < last.d) | ((drawn == last.d) & (F.col(id_col) <= F.lit(last.i)))
    return df.withColumn(name, marked)


def split_exact_by(
    df: DataFrame, id_col: str, by: str, ratio: float, seed: int, name: str = "is_train"
) -> DataFrame:
    """Mark ``int(n * ratio)`` random rows of every value of ``by``."""
    ranked = OrderedRows(
        df.withColumn("_draw", draw(seed, "split", F.col(id_col))), [by], ["_draw", id_col]
    ).numbered("_rn")
    sizes = df.groupBy(by).agg(F.count("*").alias("_n"))
    return (
        join_small(ranked, sizes, [by])
        .withColumn(name, F.col("_rn") <= F.floor(F.col("_n") * F.lit(ratio)))
        .drop("_rn", "_n", "_draw")
    )


def bernoulli(df: DataFrame, id_col: str, one_in: int, seed: int) -> DataFrame:
    """Keep every row with chance ``1 / one_in``."""
    return df.where(draw_below(one_in, seed, "bernoulli", F.col(id_col)) == 0)


def bursts(
    df: DataFrame, order: Sequence[Column | str], length: int, one_in: int, seed: int
) -> DataFrame:
    """Runs of ``length`` consecutive rows.

    One run starts at the first row; every position starts a further run with
    chance ``1 / one_in``.  Overlapping runs repeat their rows and runs end with
    the table.  Adds ``run_start`` and ``pos`` (both from 0).
    """
    ordered = OrderedRows(df, (), order)
    rows = ordered.rows.select(*ordered.columns, F.col("_g").alias("pos"))
    starts = rows.select(F.col("pos").alias("run_start")).where(
        (F.col("run_start") == 0)
        | (draw_below(one_in, seed, "burst", F.col("run_start")) == 0)
    )
    wanted = starts.withColumn(
        "pos", F.explode(F.sequence(F.col("run_start"), F.col("run_start") + F.lit(length - 1)))
    )
    return join_small(rows, wanted, ["pos"])


def pick_uniform(rows: DataFrame, slots: DataFrame, sizes: DataFrame, key: str, seed: int) -> DataFrame:
    """For every slot a uniformly drawn row of its key, with replacement.

    ``rows`` holds ``key, rn`` (1-based), ``slots`` holds ``key, slot`` and
    ``sizes`` holds ``key, n``.
    """
    drawn = join_small(slots, sizes, [key]).withColumn(
        "rn", draw_below(F.col("n"), seed, "pick", F.col(key), F.col("slot")) + 1
    )
    return drawn.drop("n").join(rows, [key, "rn"])
