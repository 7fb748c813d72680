"""Cut lineage by writing a table to the shared scratch folder.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a
local master may fall back to a folder of its own; on a cluster a missing
setting is an error, because a machine-local folder is lost with its executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tableloom-")
    return _local_root


# paths written inside the innermost ``temporary`` block
_open: list[list[str]] = []


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    One pass over the input, column pruning and pushdown on the way back, and
    exact file sizes, so that Spark's own size check decides about broadcasts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    if _open:
        _open[-1].append(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch = path
    return stored


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame | None) -> None:
    """Delete the files of a result of :func:`materialize`; anything else is left alone."""
    path = getattr(df, "_scratch", None)
    if path is not None:
        _delete(df.sparkSession, path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete what is written inside the block, except tables put into the list it gives."""
    kept: list[DataFrame] = []
    _open.append([])
    try:
        yield kept
    finally:
        spared = {getattr(df, "_scratch", None) for df in kept}
        paths = _open.pop()
        for path in paths:
            if path not in spared:
                _delete(spark, path)
        if _open:
            _open[-1].extend(p for p in paths if p in spared)


def release(spark: SparkSession) -> None:
    """Delete every table this application wrote with :func:`materialize`."""
    _delete(spark, f"{scratch_root(spark)}/tableloom-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder, removed by :func:`release`."""
    return f"{scratch_root(spark)}/tableloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
