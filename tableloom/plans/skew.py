"""Joins for skewed keys and for sides of checked size."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.plans.ordered import unused

SMALL_ROWS = 200_000


def row_count_up_to(df: DataFrame, bound: int) -> int:
    """The row count, or ``bound + 1`` when there are more; reads no further."""
    return df.limit(bound + 1).count()


def join_small(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", max_rows: int = SMALL_ROWS
) -> DataFrame:
    """Broadcast ``right`` when it has at most ``max_rows`` rows, else join by shuffle.

    Meant for a ``right`` with one row per key; the adaptive skew join then
    splits hot keys of ``left`` by itself.
    """
    if row_count_up_to(right, max_rows) <= max_rows:
        return left.join(F.broadcast(right), list(on), how)
    return left.join(right, list(on), how)


# most groups that a hot key is spread over
MOST_SALTS = 1024


def weighted_join(left: DataFrame, right: DataFrame, on: str, weight: str, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Inner join with a table of one row per key; ``weight``, left out of the result, says how often ``left`` has the key.

    The most frequent keys, at most ``max_rows`` of them, meet the rows of ``left`` by broadcast, where these
    lie; only the rows of rarer keys are moved.  ``left`` is read twice unless all keys are among the most frequent.
    """
    step = F.coalesce(F.floor(F.log2(F.col(weight))), F.lit(0).cast("bigint"))
    sizes = {r["s"]: r["n"] for r in right.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()}
    least, rows = None, 0
    for s in sorted(sizes, reverse=True):
        if rows + sizes[s] > max_rows:
            break
        least, rows = s, rows + sizes[s]
    if least is None:
        return left.join(right.drop(weight), on)
    hot = F.broadcast(right.where(step >= least).drop(weight))
    if least == min(sizes):
        return left.join(hot, on)
    rest = left.join(F.broadcast(right.where(step >= least).select(on)), on, "left_anti")
    return left.join(hot, on).unionByName(rest.join(right.where(step < least).drop(weight), on))


def _common_hash(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    """A hash of the key that is the same on both sides: values of different types are cast as a union would."""
    types = left.select(*on).union(right.select(*on)).schema
    return F.xxhash64(*[F.col(c).cast(types[c].dataType) for c in on])


def heavy_hitters(df: DataFrame, key: Column, share: float) -> tuple[dict[int, int], int]:
    """The values of ``key``, a hash, with about ``share`` of the rows or more and their counts, and all rows.

    One pass over the columns of the key fills a frequent-items sketch per partition; merged, it has at most
    ``1 / share`` such keys.  The counts are estimates, which the joins below use for balance only.
    """
    k = max(1, ceil(1 / share))
    found = df.select(key.alias("h")).agg(
        F.expr(f"approx_top_k(h, {min(k, 10_000)}, {min(8 * k, 100_000)})").alias("top"), F.count("*").alias("n")
    ).first()
    return {r["item"]: r["count"] for r in found["top"] or () if r["count"] >= share * found["n"]}, found["n"]


def _salts(df: DataFrame, hot: dict[int, int], total: int, salts: int | None) -> dict[int, int]:
    """Into how many groups the rows of each hot key go: as many as tasks of average size they would fill."""
    if salts is not None:
        return dict.fromkeys(hot, salts)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return {h: min(MOST_SALTS, max(2, ceil(n * tasks / total))) for h, n in hot.items()}


def _groups(key: Column, salts: dict[int, int]) -> Column:
    """The number of groups of a row's key, 1 unless it is hot; the few hot ones are constants of the plan."""
    if not salts:
        return F.lit(1).cast("bigint")
    known = F.create_map(*[F.lit(x).cast("bigint") for pair in salts.items() for x in pair])
    return F.when(key.isin(list(salts)), F.element_at(known, key)).otherwise(F.lit(1).cast("bigint"))


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", share: float = 0.01, salts: int | None = None
) -> DataFrame:
    """Equi-join in which hot keys of ``left`` are spread over several groups.

    Rows of a hot key get a salt from the hash of the whole row, the matching
    rows of ``right`` are repeated once per salt, all others keep salt 0.  Every
    left row still meets every match exactly once, so inner, left, semi and anti
    joins are exact, whichever keys the sketch names.  Only the few hot rows of
    ``right`` are repeated.  ``left`` is read twice, its keys alone the first time.

    Where ``right`` has one row per key a plain join does: Spark broadcasts a small
    side, and its adaptive join splits hot keys of the other.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("skew_join spreads the left side; use inner, left, left_semi or left_anti")
    on = list(on)
    key = _common_hash(left, right, on)
    hot, total = heavy_hitters(left, key, share)
    if not hot:
        return left.join(right, on, how)
    (salt,) = unused(left.join(right.drop(*on).limit(0)), "salt")
    groups = _groups(key, _salts(left, hot, total, salts))
    salted_left = left.withColumn(salt, F.pmod(F.xxhash64(*left.columns), groups))
    salted_right = right.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("bigint"), groups - 1)))
    return salted_left.join(salted_right, on + [salt], how).drop(salt)


def grid_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], share: float = 0.01, salts: int | None = None
) -> DataFrame:
    """Inner equi-join that spreads keys hot on either side, or on both.

    A hot key becomes a grid of groups: left rows choose a line and are repeated
    along it when the key is hot on the right, right rows the other way round.
    Every pair of matching rows meets in exactly one cell.  Each side is read
    twice, its keys alone the first time; without hot keys it is a plain join.
    """
    on = list(on)
    key = _common_hash(left, right, on)
    hot_left, hot_right = (_salts(df, *heavy_hitters(df, key, share), salts) for df in (left, right))
    if not hot_left and not hot_right:
        return left.join(right, on)
    line, column = unused(left.join(right.drop(*on).limit(0)), "line", "column")

    def place(df: DataFrame, own: dict[int, int], other: dict[int, int], own_salt: str, other_salt: str) -> DataFrame:
        chosen = F.pmod(F.xxhash64(*df.columns), _groups(key, own))
        along = F.explode(F.sequence(F.lit(0).cast("bigint"), _groups(key, other) - 1)) if other else F.lit(0).cast("bigint")
        return df.withColumn(own_salt, chosen).withColumn(other_salt, along)

    placed_left = place(left, hot_left, hot_right, line, column)
    placed_right = place(right, hot_right, hot_left, column, line)
    return placed_left.join(placed_right, on + [line, column]).drop(line, column)


def outer_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Left, right or full equi-join for keys that may be hot on either side.

    Matching pairs come from :func:`grid_join`; rows without a partner are found
    against the distinct keys of the other side.
    """
    if how not in ("left", "right", "full"):
        raise ValueError(how)
    on = list(on)
    result = grid_join(left, right, on)
    if how in ("left", "full"):
        alone = left.join(right.select(*on).distinct(), on, "left_anti")
        result = result.unionByName(alone, allowMissingColumns=True)
    if how in ("right", "full"):
        alone = right.join(left.select(*on).distinct(), on, "left_anti")
        result = result.unionByName(alone, allowMissingColumns=True)
    return result
