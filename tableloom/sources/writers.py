"""Sinks.  Every one writes a folder of part files from the tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.operators.bayes import decode_label
from tableloom.plans.ordered import OrderedRows
from tableloom.sources.readers import truthy


def text_lines(df: DataFrame, column: str, path: str, compression: str = "none") -> None:
    """One line per row; an existing path is an error."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("errorifexists").option(
        "compression", compression
    ).text(path)


def json_lines(df: DataFrame, path: str, required: str | None = None) -> None:
    """One object per line; ``required`` keeps rows in which that field is not empty."""
    kept = df if required is None else df.where(truthy(required))
    kept.write.mode("errorifexists").json(path)


def csv_rows(df: DataFrame, path: str, header: bool = True) -> None:
    """Comma-separated rows; texts keep their spaces, quotes are doubled."""
    df.write.mode("errorifexists").csv(
        path, header=header, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def tab_rows(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").csv(
        path, sep="\t", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def sequence_file(df: DataFrame, path: str) -> None:
    """The first two columns as keys and values."""
    df.rdd.map(lambda row: (row[0], row[1])).saveAsSequenceFile(path)


def object_file(df: DataFrame, path: str) -> None:
    df.rdd.map(tuple).saveAsPickleFile(path)


def hadoop_file(df: DataFrame, path: str, output_format: str, key_class: str, value_class: str) -> None:
    """The first two columns through any Hadoop output format."""
    df.rdd.map(lambda row: (row[0], row[1])).saveAsNewAPIHadoopFile(path, output_format, key_class, value_class)


def numbered_predictions(predictions: DataFrame, id_col: str, predicted: str = "predicted") -> DataFrame:
    """``(row_no, label)``: rows numbered from 1 in id order, 0 as ham, the rest as spam."""
    numbered = OrderedRows(predictions.select(id_col, predicted), (), [id_col]).numbered("row_no")
    return numbered.select("row_no", decode_label(F.col(predicted)).alias("label"))


def write_predictions(predictions: DataFrame, id_col: str, path: str, predicted: str = "predicted") -> None:
    csv_rows(numbered_predictions(predictions, id_col, predicted), path, header=False)


def append_metrics(metrics: DataFrame, path: str, run: str, generation: int) -> None:
    """Add the rows of one generation of one run to a log.

    The rows lie in a folder of their own, so the append is one commit, and a generation that is
    written again replaces its rows instead of adding to them.
    """
    metrics.write.mode("overwrite").parquet(f"{path}/run={run}/generation={int(generation)}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a log, with ``run`` and ``generation``."""
    return spark.read.parquet(path)
