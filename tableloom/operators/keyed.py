"""Keyed data flow: maps, joins, aggregates, sets, sorting and grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tableloom.plans.ordered import OrderedRows, unused
from tableloom.plans.skew import grid_join, outer_join, row_count_up_to

CHUNK = 64


# ---- projections -----------------------------------------------------------


def key_by(df: DataFrame, key: Column) -> DataFrame:
    return df.withColumn("key", key)


def map_values(df: DataFrame, value: str, fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumn(value, fn(F.col(value)))


def flat_map(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per element of an array expression."""
    return df.withColumn(name, F.explode(items))


def map_partitions(
    df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """``fn`` sees the batches of one partition, so it can set up once."""
    return df.mapInPandas(fn, schema)


def pipe_lines(df: DataFrame, line: Column, command: str, name: str = "line") -> DataFrame:
    """Send one text line per row through an external program, one output line each.

    A value with a line end in it would become two lines and is an error.
    """
    whole = F.when(line.rlike(r"[\r\n]"), F.raise_error(F.lit("a value holds a line end"))).otherwise(line)
    lines = df.select(whole.alias("_l")).rdd.map(lambda row: row["_l"])
    return df.sparkSession.createDataFrame(
        lines.pipe(command, checkCode=True).map(lambda out: (out,)), f"{name} string"
    )


def packed(df: DataFrame, order: Sequence[Column | str], value: str, size: int) -> DataFrame:
    """Consecutive rows as lists of ``size`` values: ``(chunk, items)``."""
    rows = OrderedRows(df, (), order).rows
    return (
        rows.groupBy(F.floor(F.col("_g") / size).alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("_g", F.col(value).alias("v")))).alias("_i"))
        .select("chunk", F.transform("_i", lambda i: i["v"]).alias("items"))
    )


# ---- joins -----------------------------------------------------------------


def inner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return grid_join(left, right, on)


def left_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return outer_join(left, right, on, "left")


def right_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Columns of ``left`` still come first."""
    return outer_join(left, right, on, "right")


def group_values(df: DataFrame, key: str, value: str, chunk: int = CHUNK, id_col: str | None = None) -> DataFrame:
    """All values of a key, sorted, as lists of at most ``chunk``: ``(key, chunk, items)``.

    A list without a bound would put a hot key into one task; here every value
    is kept and a hot key simply has many rows.  Give ``id_col`` when values
    repeat often within a key, so that equal values can be spread too.
    """
    extra = [id_col] if id_col else []
    ranked = OrderedRows(df.select(key, value, *extra), [key], [value, *extra]).numbered("_rn")
    return (
        ranked.groupBy(key, F.floor((F.col("_rn") - 1) / chunk).alias("chunk"))
        .agg(F.array_sort(F.collect_list(value)).alias("items"))
    )


def cogroup(
    left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, chunk: int = CHUNK
) -> DataFrame:
    """Both value lists per key, in chunks: ``(key, chunk, left_items, right_items)``."""
    a = group_values(left, key, left_value, chunk).withColumnRenamed("items", "left_items")
    b = group_values(right, key, right_value, chunk).withColumnRenamed("items", "right_items")
    # a NULL key meets a NULL key
    same = F.col("_a.k").eqNullSafe(F.col("_b.k")) & (F.col("_a.chunk") == F.col("_b.chunk"))
    a = a.withColumnRenamed(key, "k").alias("_a")
    b = b.withColumnRenamed(key, "k").alias("_b")
    return a.join(b, same, "full").select(
        F.coalesce("_a.k", "_b.k").alias(key), F.coalesce("_a.chunk", "_b.chunk").alias("chunk"), "left_items", "right_items"
    )


def product_with_bounded(left: DataFrame, right: DataFrame, max_rows: int = 1000) -> DataFrame:
    """Every row of ``left`` with every row of a ``right`` of checked size.

    The right rows travel as one constant list.  Products of two tables without
    a bound are refused.
    """
    if row_count_up_to(right, max_rows) > max_rows:
        raise ValueError(f"the right side has more than {max_rows} rows")
    items = right.agg(F.collect_list(F.struct(*right.columns)).alias("i"))
    return left.withColumn("_r", F.explode(items.scalar())).select(*left.columns, "_r.*")


def lookup(df: DataFrame, key: str, wanted) -> DataFrame:
    return df.where(F.col(key) == F.lit(wanted))


def last_by_key(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """``(key, value)``: the value of the last row of every key."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def as_map(df: DataFrame, key: str, value: str, order: Sequence[str], max_keys: int = 100_000) -> dict:
    """A dict on the driver, for a checked number of keys; the last value wins."""
    last = last_by_key(df, key, value, order)
    rows = last.limit(max_keys + 1).collect()
    if len(rows) > max_keys:
        raise ValueError(f"more than {max_keys} keys; keep the table instead")
    return {row[key]: row[value] for row in rows}


def zip_rows(
    left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]
) -> DataFrame:
    """Pair rows by position; the shorter table decides."""
    a = OrderedRows(left, (), left_order).numbered("pos")
    b = OrderedRows(right, (), right_order).numbered("pos")
    return a.join(b, "pos")


def adjacent_pairs(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], **following: str) -> DataFrame:
    """Every row with its successor in the key (``new_name=column``); the last row is dropped."""
    marked = df.withColumn("_one", F.lit(1))
    pairs = OrderedRows(marked, keys, order).with_next(_next="_one", **following)
    return pairs.where(F.col("_next").isNotNull()).drop("_one", "_next", "_mid", "_part", "_g")


def disjoint_pairs(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str
) -> DataFrame:
    """Rows 2k and 2k+1 of a key side by side: ``(keys, pair_id, first, second)``."""
    ranked = OrderedRows(df.select(*keys, *[c for c in df.columns if c not in keys]), keys, order).numbered("_rn")
    even = (F.col("_rn") % 2) == 1
    return ranked.groupBy(*keys, F.floor((F.col("_rn") - 1) / 2).alias("pair_id")).agg(
        F.max(F.when(even, F.col(value))).alias("first"),
        F.max(F.when(~even, F.col(value))).alias("second"),
    )


# ---- aggregates ------------------------------------------------------------


def count_by_value(df: DataFrame, value: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias(name))


def reduce_by_key(df: DataFrame, key: str, value: str, how: Callable[[Column], Column] = F.sum) -> DataFrame:
    return df.groupBy(key).agg(how(F.col(value)).alias(value))


def fold(df: DataFrame, value: str, zero, how: Callable[[Column], Column] = F.sum) -> DataFrame:
    return df.agg(F.coalesce(how(F.col(value)), F.lit(zero)).alias(value))


def fold_by_key(df: DataFrame, key: str, value: str, zero, how: Callable[[Column], Column] = F.sum) -> DataFrame:
    return df.groupBy(key).agg(F.coalesce(how(F.col(value)), F.lit(zero)).alias(value))


def combine_by_key(
    df: DataFrame,
    key: str,
    value: str,
    create: Callable[[float], tuple],
    merge_value: Callable[[tuple, float], tuple],
    merge: Callable[[tuple, tuple], tuple],
    width: int,
    flush: int = 100_000,
) -> DataFrame:
    """Three-function aggregation for what built-in aggregates cannot say.

    An accumulator is a tuple of ``width`` numbers.  Every partition combines its own rows
    first, so a key reaches the merging task as at most a few accumulators per partition.
    These are sorted by key and merged as they stream by: one Python call per partition, and
    one accumulator held at a time.  Gives ``(key, acc array<double>)``.
    """
    key_type = dict(df.dtypes)[key]
    schema = f"key {key_type}, acc array<double>"
    arrow = to_arrow_schema(df.select(F.col(key).alias("key"), F.array(F.lit(0.0)).alias("acc")).schema)

    def emit(keys: list, accs: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, arrow.field("key").type), pa.array([[float(x) for x in a[:width]] for a in accs], arrow.field("acc").type)], schema=arrow
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accs: dict = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k = hashable(k)
                accs[k] = merge_value(accs[k], v) if k in accs else create(v)
            if len(accs) > flush:
                yield emit([plain(k) for k in accs], list(accs.values()))
                accs = {}
        if accs:
            yield emit([plain(k) for k in accs], list(accs.values()))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            keys, accs = [], []
            for k, acc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                acc = tuple(acc)
                if total is not None and hashable(k) == held:
                    total = merge(total, acc)
                    continue
                if total is not None:
                    keys.append(plain(held))
                    accs.append(total)
                held, total = hashable(k), acc
            if keys:
                yield emit(keys, accs)
        if total is not None:
            yield emit([plain(held)], [total])

    pairs = df.select(F.col(key).alias("key"), F.col(value).alias("value"))
    combined = pairs.mapInArrow(partial, schema).repartition("key").sortWithinPartitions("key").mapInArrow(merged, schema)
    return combined.withColumnRenamed("key", key)


_NAN = "not a number"


def hashable(key):
    """A key that equals itself: NaN, lists and structs of a row as plain values."""
    if isinstance(key, float) and key != key:
        return (_NAN,)
    if isinstance(key, list):
        return ("list", *map(hashable, key))
    if isinstance(key, dict):
        return ("struct", *((n, hashable(v)) for n, v in key.items()))
    return key


def plain(key):
    """The key that :func:`hashable` was given."""
    if not isinstance(key, tuple):
        return key
    if key[0] == _NAN:
        return float("nan")
    if key[0] == "list":
        return [plain(k) for k in key[1:]]
    return {n: plain(v) for n, v in key[1:]}


def sort_by_key(df: DataFrame, key: Column, partitions: int) -> DataFrame:
    """``df`` laid out in exactly ``partitions`` partitions by ranges of a derived key, sorted inside each.

    The borders come from a sample of the key, so partitions are about equally large; rows of equal
    keys lie together, and a partition may be empty when there are fewer keys than partitions.
    """
    (name,) = unused(df, "sort_key")
    keyed = df.withColumn(name, key)
    return keyed.repartitionByRange(partitions, name).sortWithinPartitions(name).drop(name)


def layout_of(df: DataFrame, key: Column) -> DataFrame:
    """One row: ``partitions`` with rows, and whether keys ascend ``inside`` each and ``across`` all of them.

    ``df`` is read once, in its own layout.
    """
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, sorted_, n = None, None, True, 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            if not keys:
                continue
            first = keys[0] if n == 0 else first
            whole = keys if n == 0 else [last, *keys]
            sorted_ = sorted_ and all(a <= b for a, b in zip(whole, whole[1:]))
            last, n = keys[-1], n + len(keys)
        if n:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "first": first, "last": last, "inside": sorted_, "n": n}], schema)

    kind = df.select(key.alias("k")).schema["k"].dataType
    types = f"part int, first {kind.simpleString()}, last {kind.simpleString()}, inside boolean, n bigint"
    schema = to_arrow_schema(StructType.fromDDL(types))
    parts = df.select(key.alias("k")).mapInArrow(seen, types)
    # one row per partition
    before = F.lag("last").over(Window.orderBy("part"))
    follows = F.coalesce(before <= F.col("first"), F.lit(True))
    return parts.select("*", follows.alias("follows")).agg(
        F.count("*").cast("int").alias("partitions"), F.min("inside").alias("inside"), F.min("follows").alias("across"), F.sum("n").alias("n")
    )


def word_count(df: DataFrame, text: str) -> DataFrame:
    return count_by_value(df.select(F.explode(F.split(text, " ")).alias("word")), "word")


def stats(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, sum, extremes, variances and deviations in one pass."""
    return df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.sum(value).alias("sum"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.var_pop(value).alias("variance"),
        F.var_samp(value).alias("sample_variance"),
        F.stddev_pop(value).alias("stdev"),
        F.stddev_samp(value).alias("sample_stdev"),
    )


def observed(df: DataFrame, **counters: Column) -> dict:
    """Run ``df`` once and return aggregates seen on the way."""
    seen = Observation()
    watched = df.observe(seen, *[c.alias(n) for n, c in counters.items()])
    watched.write.format("noop").mode("overwrite").save()
    return seen.get


# ---- sets ------------------------------------------------------------------


def same_schema(left: DataFrame, right: DataFrame) -> None:
    if left.dtypes != right.dtypes:
        raise TypeError(f"set operations need equal columns: {left.dtypes} and {right.dtypes}")


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    same_schema(left, right)
    return left.unionByName(right)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct common rows; both sides are reduced before they meet."""
    same_schema(left, right)
    return left.distinct().intersect(right.distinct())


def minus_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that do not occur in ``right``; repeated rows stay repeated."""
    same_schema(left, right)
    a, b = left.alias("a"), right.distinct().alias("b")
    same = reduce(
        lambda x, y: x & y,
        [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in left.columns],
    )
    return a.join(b, same, "left_anti")


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that occur on exactly one side."""
    same_schema(left, right)
    tagged = left.withColumn("_s", F.lit(1)).unionByName(right.withColumn("_s", F.lit(2)))
    sides = tagged.groupBy(*left.columns).agg(F.bit_or("_s").alias("_s"))
    return sides.where("_s < 3").drop("_s")


def set_relations(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``is_subset``, ``is_superset``, ``is_equal`` of the distinct rows."""
    same_schema(left, right)
    tagged = left.withColumn("_s", F.lit(1)).unionByName(right.withColumn("_s", F.lit(2)))
    sides = tagged.groupBy(*left.columns).agg(F.bit_or("_s").alias("_s"))
    only_left = F.coalesce(F.sum(F.when(F.col("_s") == 1, 1)), F.lit(0))
    only_right = F.coalesce(F.sum(F.when(F.col("_s") == 2, 1)), F.lit(0))
    return sides.agg(
        (only_left == 0).alias("is_subset"),
        (only_right == 0).alias("is_superset"),
        ((only_left == 0) & (only_right == 0)).alias("is_equal"),
    )


# ---- order -----------------------------------------------------------------


def top_k(df: DataFrame, by: Column, id_col: str, k: int) -> DataFrame:
    return df.orderBy(by.desc(), id_col).limit(k)


def bottom_k(df: DataFrame, by: Column, id_col: str, k: int) -> DataFrame:
    return df.orderBy(by.asc(), id_col).limit(k)


def best_by_key(df: DataFrame, key: str, by: str, id_col: str) -> DataFrame:
    """The row of largest ``by`` per key, smallest id on ties; an aggregate, not a window."""
    rest = [c for c in df.columns if c not in (key, by, id_col)]
    # a NULL is worse than every value
    best = df.groupBy(key).agg(
        F.min(F.struct(F.col(by).isNull().alias("_n"), (-F.col(by)).alias("_b"), F.col(id_col).alias("_i"), *[F.col(c) for c in rest])).alias("_m")
    )
    return best.select(
        key, F.col("_m._i").alias(id_col), (-F.col("_m._b")).alias(by), *[F.col("_m")[c].alias(c) for c in rest]
    )


def every_kth(df: DataFrame, order: Sequence[Column | str], step: int, start: int = 0) -> DataFrame:
    """Rows at positions start, start + step, ..."""
    ranked = OrderedRows(df, (), order).numbered("_rn")
    at = F.col("_rn") - 1 - F.lit(start)
    return ranked.where((at >= 0) & (at % step == 0)).drop("_rn")


def seen_before(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "seen") -> DataFrame:
    """Flag rows whose key occurred in an earlier row."""
    return OrderedRows(df, keys, order).numbered("_rn").withColumn(name, F.col("_rn") > 1).drop("_rn")


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key, by aggregation."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_f"))
    return first.select(*keys, "_f.*")


def consecutive_runs(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str) -> DataFrame:
    """Runs of equal neighbouring values: ``(keys, run_no, value, n)``, runs counted from 1."""
    ordered = OrderedRows(df.withColumn("_one", F.lit(1)), keys, order)
    rows = ordered.with_previous(_prev=value, _had="_one")
    starts = F.when(F.col("_had").isNull() | ~F.col("_prev").eqNullSafe(F.col(value)), 1).otherwise(0)
    runs = ordered.running_sum(starts, "run_no", rows)
    return runs.groupBy(*keys, "run_no").agg(
        F.first(value).alias(value), F.count("*").alias("n")
    )


def insertion_points(points: DataFrame, point: str, sorted_values: DataFrame, value: str) -> DataFrame:
    """Add ``position``: how many of the sorted values are ``<= point``.

    Both tables are laid out together, so neither has to fit anywhere.
    """
    asked = points.select(
        F.col(point).alias("_v"),
        F.lit(0).cast("bigint").alias("_n"),
        F.xxhash64(*points.columns).alias("_tie"),
        F.struct(*points.columns).alias("_row"),
    )
    # one row per distinct value, so a frequent value is a single row
    tagged = sorted_values.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n")).select(
        "_v", "_n", F.lit(0).cast("bigint").alias("_tie"),
        F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"),
    )
    # at equal values the counted row comes first
    ordered = OrderedRows(asked.unionByName(tagged), (), ["_v", F.col("_n").desc(), "_tie"])
    counted = ordered.running_sum("_n", "position")
    return counted.where("_n = 0").select("_row.*", "position")
