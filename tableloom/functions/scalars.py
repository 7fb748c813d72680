"""Column functions over numbers, dates, arrays, maps and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ---- numbers and dates -----------------------------------------------------


def floor_divide(a: Column, b: Column | int) -> Column:
    """Integer division that rounds down for negative numbers too, in whole numbers throughout."""
    a, b = a.cast("bigint"), (b if isinstance(b, Column) else F.lit(b)).cast("bigint")
    quotient = F.call_function("div", a, b)
    return F.when((a % b != 0) & ((a < 0) != (b < 0)), quotient - 1).otherwise(quotient)


def divmod_columns(a: Column, b: int) -> tuple[Column, Column]:
    """Quotient rounded down, and the remainder with the divisor's sign."""
    quotient = floor_divide(a, b)
    return quotient, a - quotient * F.lit(b)


def clock(seconds: Column) -> Column:
    """Seconds as ``hh:mm:ss``."""
    minutes, s = divmod_columns(seconds, 60)
    h, m = divmod_columns(minutes, 60)
    return F.format_string("%02d:%02d:%02d", h, m, s)


def to_bytes(df: DataFrame, value: str, name: str) -> DataFrame:
    """Rescale to 0..255 over the whole table; the extremes are one row, read as constants."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    return df.withColumn(name, ((F.col(value) - low) / (high - low) * F.lit(255)).cast("int"))


def to_float_or_keep(text: Column) -> Column:
    """Numbers in their float spelling, anything else unchanged."""
    return F.coalesce(text.try_cast("double").cast("string"), text)


def is_type(value: Column, name: str) -> Column:
    return F.typeof(value) == name


# ---- arrays ----------------------------------------------------------------


def pop_at(arr: Column, index: int) -> Column:
    """The array without the element at ``index``."""
    return F.filter(arr, lambda x, i: i != index)


def remove_first(arr: Column, value) -> Column:
    """The array without the first element equal to ``value``."""
    at = F.array_position(arr, value).cast("int") - 1
    return F.when(at < 0, arr).otherwise(F.filter(arr, lambda x, i: i != at))


def replace_slice(arr: Column, start: int, stop: int, new: Column) -> Column:
    """``arr[start:stop] = new``."""
    size = F.size(arr)
    tail_from = F.least(F.lit(stop), size)
    return F.concat(
        F.slice(arr, F.lit(1), F.least(F.lit(start), size)), new,
        F.slice(arr, tail_from + 1, F.greatest(size - tail_from, F.lit(0))),
    )


def every(arr: Column, step: int, start: int = 0, stop: int | None = None) -> Column:
    """``arr[start:stop:step]``."""
    def keep(_, i):
        wanted = (i >= start) & ((i - start) % step == 0)
        return wanted if stop is None else wanted & (i < stop)
    return F.filter(arr, keep)


def repeated(arr: Column, times: int) -> Column:
    return F.flatten(F.array_repeat(arr, times))


def count_of(arr: Column, value) -> Column:
    return F.size(F.filter(arr, lambda x: x == value))


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def array_mean(arr: Column) -> Column:
    return F.try_divide(array_sum(arr), F.size(arr).cast("double"))


def identity_cells(n: Column) -> Column:
    """Non-zero cells of the n by n identity as ``array<struct<i, j, value>>``."""
    return F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - 1),
        lambda i: F.struct(i.alias("i"), i.alias("j"), F.lit(1.0).alias("value")),
    )


# ---- maps ------------------------------------------------------------------


def merged(left: Column, right: Column) -> Column:
    """Both maps; the value of ``right`` wins."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def without_key(m: Column, key) -> Column:
    return F.map_filter(m, lambda k, _: k != key)


def get_or(m: Column, key: Column, default) -> Column:
    return F.coalesce(F.element_at(m, key), F.lit(default))


# ---- encodings -------------------------------------------------------------


def encode_names(value: Column, names: Sequence[str]) -> Column:
    """Position of a class name in ``names``, NULL when absent."""
    table = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    return F.element_at(table, value)


# Class names of the flower table in code order.
FLOWER_CLASSES = ("Setosa", "Versicolor", "Virginica")
