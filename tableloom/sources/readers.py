"""Sources.  Paths may use any scheme the cluster has a file system for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.scalars import FLOWER_CLASSES, encode_names


def text_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """``value``: one row per line of a file or of all files of a folder.

    With ``min_partitions`` files are cut into at least that many splits where they are read, by
    their bytes; nothing is shuffled.
    """
    if min_partitions is None:
        return spark.read.text(path)
    jvm = spark.sparkContext._jvm
    lines = spark.sparkContext._jsc.sc().textFile(path, min_partitions)
    return DataFrame(spark._jsparkSession.createDataset(lines, jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)


def file_splits(lines: DataFrame) -> DataFrame:
    """One row: ``splits`` of a scan and the rows in them."""
    parts = lines.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    return parts.agg(F.count("*").alias("splits"), F.sum("n").alias("n"))


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, content)``: one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("content")
    )


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One object per line; without a schema the whole input is read to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def parsed_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """The fields of a JSON text column as columns."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.from_json(column, schema).alias("_j")).select(*kept, "_j.*")


def truthy(column: str) -> Column:
    """Present and not empty."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def csv_rows(spark: SparkSession, path: str, schema: str, newlines: bool = False, header: bool = False) -> DataFrame:
    """Comma-separated rows with the given names; ``newlines`` allows them inside quotes."""
    return spark.read.csv(path, schema=schema, multiLine=newlines, header=header, escape='"')


def labelled_text(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``(label, text)``, quotes left alone."""
    return spark.read.csv(path, sep="\t", schema="label string, text string", quote="")


def mail_log(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated ``(label, ip, address, message_id)``."""
    return spark.read.csv(path, schema="label string, ip string, address string, message_id string", quote="")


def numeric_rows(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Comma-separated numbers, every column a double."""
    return spark.read.csv(path, schema=", ".join(f"{c} double" for c in columns))


def flower_rows(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Comma-separated numbers with a class name last; adds its code as ``label``."""
    rows = spark.read.csv(path, schema=", ".join(f"{c} double" for c in columns) + ", species string")
    return rows.select(*columns, encode_names(F.col("species"), FLOWER_CLASSES).alias("label"))


def sequence_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Key and value pairs of a SequenceFile."""
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), schema)


def object_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Serialised records; parquet is the better choice for tables."""
    return spark.createDataFrame(spark.sparkContext.pickleFile(path), schema)


def hadoop_file(spark: SparkSession, path: str, input_format: str, key_class: str, value_class: str, schema: str) -> DataFrame:
    """Records of any Hadoop input format."""
    pairs = spark.sparkContext.newAPIHadoopFile(path, input_format, key_class, value_class)
    return spark.createDataFrame(pairs, schema)


def protobuf_column(column: str, message: str, descriptor: str) -> Column:
    """A protocol-buffer column as a struct; needs the spark-protobuf package on the class path."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return from_protobuf(column, message, descFilePath=descriptor)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, slices: int | None = None) -> DataFrame:
    """A table of in-memory rows, over ``slices`` partitions."""
    df = spark.createDataFrame(list(rows), schema)
    return df if slices is None else df.repartition(slices)


def jdbc_options(
    url: str, table: str, column: str | None = None, lower=None, upper=None, partitions: int | None = None,
    **properties: str,
) -> dict[str, str]:
    """Options of a database read; with bounds it is read in parallel ranges of ``column``."""
    options = {"url": url, "dbtable": table, **properties}
    if column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return options


def database_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


# Data source names and location options of the vendors' connectors.
CONNECTORS = {
    "cassandra": ("org.apache.spark.sql.cassandra", ("keyspace", "table")),
    "hbase": ("org.apache.hadoop.hbase.spark", ("hbase.table", "hbase.columns.mapping")),
    "elasticsearch": ("org.elasticsearch.spark.sql", ("es.resource",)),
}


def connector_table(spark: SparkSession, store: str, **options: str) -> DataFrame:
    """A table of an outside store; its connector has to be on the class path."""
    source, needed = CONNECTORS[store]
    missing = [n for n in needed if n not in options]
    if missing:
        raise ValueError(f"{store} needs {missing}")
    return spark.read.format(source).options(**options).load()
