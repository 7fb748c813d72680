"""Where rows live: partitions, storage levels, lineage and settings."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame, n: int, *columns) -> DataFrame:
    """Move every row into one of ``n`` partitions, by columns or evenly."""
    return df.repartition(n, *columns)


def gather(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions, without moving rows between machines."""
    return df.coalesce(n)


def well_spread(df: DataFrame, per_core: int = 32 << 20) -> DataFrame:
    """Spread a small scan over the cores before heavy work on each row.

    Decided by the size the optimizer knows, without running anything; a large
    input has many splits of its own and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * per_core else df


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables that ``df`` is made of, as the optimizer knows them; None when it does not."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < 1 << 60 else None


def by_key(df: DataFrame, *columns: str, per_task: int = 4 << 20) -> DataFrame:
    """Rows of a key together, a partition for every ``per_task`` bytes of the tables read.

    An aggregation on these and further columns then stays inside the partitions: no row of it is moved,
    and the memory of a task does not grow with the input.  Decided without running anything.
    """
    size = stored_bytes(df)
    if size is None:
        return df.repartition(*columns)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // per_task)), *columns)


def partition_count(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def by_host(df: DataFrame, url: str, n: int = 20) -> DataFrame:
    """Pages of a host together."""
    return df.repartition(n, F.parse_url(url, F.lit("HOST")))


def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    return df.persist(level)


def lineage(df: DataFrame) -> str:
    """The plan of a table as text."""
    return df._jdf.queryExecution().toString()


@contextmanager
def parallelism(spark: SparkSession, n: int):
    """Run the enclosed actions with ``n`` shuffle partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        yield spark
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
