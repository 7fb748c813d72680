"""Smoothing of ordered values."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.plans.ordered import OrderedRows
from tableloom.plans.scratch import materialize

# Rows of one block: neighbours share all but the low bits of their position.
BLOCK_BITS = 20


def moving_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, weight: float, name: str = "moving"
) -> DataFrame:
    """``m = (1 - weight) * m + weight * x`` along the order, starting at the first value.

    Blocks of neighbouring rows are smoothed on their own.  A key that continues
    from the block before gets the missing start value as a correction that
    fades with its position, so the result is exact and no key sits in one task.
    What a block does to the value that enters it is a map v -> a v + b (a is 0
    where another key begins), so the values that enter all blocks are a prefix
    composition of such maps, found in Spark in two levels (``entering``).
    """
    keys = list(keys)
    ordered = OrderedRows(df, keys, order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def smooth(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_mid", kind="stable")
        if keys:
            above = block[keys].shift()
            # two NULL keys are the same key
            differs = block[keys].ne(above) & ~(block[keys].isna() & above.isna())
            differs.iloc[0] = True
            piece = differs.any(axis=1).cumsum()
        else:
            piece = pd.Series(1, index=block.index)
        by = block.groupby(piece, sort=False)[value]
        return block.assign(
            _local=by.transform(lambda s: s.ewm(alpha=weight, adjust=False).mean()),
            _at=by.cumcount() + 1, _first=by.transform("first"), _piece=piece.astype("int64"),
        )

    laid = ordered.rows.select(*ordered.columns, "_mid", F.shiftright("_mid", BLOCK_BITS).alias("_block"))
    local = materialize(laid.groupBy("_block").applyInPandas(
        smooth, f"{fields}, _mid bigint, _block bigint, _local double, _at bigint, _first double, _piece bigint"
    ))
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    ends = local.groupBy("_block").agg(
        F.min_by(key, "_mid").alias("first_key"), F.max_by(key, "_mid").alias("last_key"),
        F.max_by(F.struct("_local", "_at", "_first", "_piece"), "_mid").alias("last"),
    )
    keep = 1.0 - weight
    # one row per block of up to a million rows
    before = Window.orderBy("_block")
    linked = ends.withColumn("goes_on", F.lag("last_key").over(before).eqNullSafe(F.col("first_key")))
    linked = linked.withColumn("at", F.row_number().over(before) - 1)
    through = F.when(F.col("goes_on") & (F.col("last._piece") == 1), F.pow(F.lit(keep), F.col("last._at"))).otherwise(F.lit(0.0))
    maps = materialize(linked.select(
        "_block", "at", "goes_on", through.alias("a"), (F.col("last._local") - through * F.col("last._first")).alias("b")
    ))
    # stored, so Spark broadcasts it while it is small
    carry = materialize(entering(maps).where("goes_on").select("_block", F.lit(1).cast("bigint").alias("_piece"), F.col("v").alias("_start")))
    joined = local.join(carry, ["_block", "_piece"], "left")
    correction = F.coalesce(
        F.pow(F.lit(keep), F.col("_at")) * (F.col("_start") - F.col("_first")), F.lit(0.0)
    )
    return joined.select(*ordered.columns, (F.col("_local") + correction).alias(name))


# maps that a group composes
GROUP = 1024


def entering(maps: DataFrame) -> DataFrame:
    """``maps`` (at, a, b, ...) with ``v``: what enters each when maps are applied from 0 in the order of ``at``.

    Groups of ``GROUP`` maps are composed side by side; one row per group then gives what enters the
    groups, and each group goes through its maps from there.
    """
    rows = maps.withColumn("_group", F.floor(F.col("at") / GROUP))
    one = F.struct("at", "a", "b")
    lists = rows.groupBy("_group").agg(F.sort_array(F.collect_list(one)).alias("maps"))
    whole = F.aggregate(
        "maps", F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")),
        lambda s, m: F.struct((m["a"] * s["a"]).alias("a"), (m["a"] * s["b"] + m["b"]).alias("b")),
    )
    summed = lists.select("_group", whole.alias("w")).select(F.col("_group").alias("at"), "w.a", "w.b")
    groups = _walked(summed.agg(F.sort_array(F.collect_list(one)).alias("maps")).withColumn("v", F.lit(0.0)))
    groups = groups.select(F.col("at").alias("_group"), "v")
    inside = _walked(lists.join(groups, "_group")).select("at", "v")
    return maps.join(inside, "at")


def _walked(lists: DataFrame) -> DataFrame:
    """(at, v) of every map in ``maps``: the value that enters it when ``v`` enters the first."""
    empty = F.array().cast("array<struct<at:bigint,v:double>>")
    steps = F.aggregate(
        "maps", F.struct(F.col("v").alias("v"), empty.alias("out")),
        lambda s, m: F.struct(
            (m["a"] * s["v"] + m["b"]).alias("v"),
            F.concat(s["out"], F.array(F.struct(m["at"].cast("bigint").alias("at"), s["v"].alias("v")))).alias("out"),
        ),
        lambda s: s["out"],
    )
    return lists.select(F.explode(steps).alias("s")).select("s.*")
