"""Session construction and access to the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package.  Anything the cluster has
# already set in its defaults or on submit wins, see ``build_session``.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed joins even when an aggregate on the same key follows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tableloom", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or get) a session.

    Precedence is the usual one: arguments here, then what was submitted, then
    the recommended values above.  Keyword names use ``__`` for dots.
    """
    from pyspark import SparkConf

    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


class Tables:
    """Attribute access to the parquet tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}.parquet"
