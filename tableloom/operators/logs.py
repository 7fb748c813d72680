"""Frequencies and samples over packet or event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.plans.ordered import numbered


def present(field: Column) -> Column:
    """The layer is there and its name is not blank."""
    return field.isNotNull() & (field != " ")


def name_frequency(packets: DataFrame, field: Column, name: str = "name") -> DataFrame:
    """``(name, cnt)`` over the packets that carry the field."""
    return packets.where(present(field)).groupBy(field.alias(name)).agg(F.count("*").alias("cnt"))


def by_frequency(frequencies: DataFrame, name: str = "name") -> DataFrame:
    """Add ``place``: 1 for the rarest name, ties by name."""
    return numbered(frequencies, (), ["cnt", name], "place")


def layer_counts(packets: DataFrame, **layers: Column) -> DataFrame:
    """One row: for every layer how many packets have it, in one pass."""
    return packets.agg(*[F.count(F.when(c.isNotNull(), 1)).alias(n) for n, c in layers.items()])


def first_match(packets: DataFrame, condition: Column, *order: str) -> DataFrame:
    """The earliest matching packet; every partition keeps one candidate."""
    return packets.where(condition).orderBy(*order).limit(1)
