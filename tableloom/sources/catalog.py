"""SQL strings, databases and tables of the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_sql(spark: SparkSession, statement: str, **args) -> DataFrame:
    """Run one statement; values go in as named parameters, never into the text."""
    return spark.sql(statement, args=args or None)


def rows_of(spark: SparkSession, statement: str, limit: int = 10_000, **args) -> list[tuple]:
    """All rows on the driver, for results of a checked size."""
    rows = run_sql(spark, statement, **args).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; keep the DataFrame instead")
    return [tuple(r) for r in rows]


def _name(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {_name(name)}")


def create_database(spark: SparkSession, name: str, if_missing: bool = False, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if if_missing else ''}{_name(name)}{where}")


def describe_database(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE DATABASE EXTENDED {_name(name)}")


def drop_database(spark: SparkSession, name: str, if_exists: bool = False, cascade: bool = False) -> None:
    spark.sql(f"DROP DATABASE {'IF EXISTS ' if if_exists else ''}{_name(name)}{' CASCADE' if cascade else ''}")


def column(name: str, kind: str, required: bool = False, default: str | None = None, comment: str | None = None) -> str:
    """One column definition; ``default`` is a SQL literal."""
    parts = [_name(name), kind]
    if required:
        parts.append("NOT NULL")
    if default is not None:
        parts.append(f"DEFAULT {default}")
    if comment is not None:
        parts.append(f"COMMENT {_text(comment)}")
    return " ".join(parts)


def insert_rows(df: DataFrame, table: str, required: Sequence[str] = ()) -> None:
    """Append by position.  File tables do not check NOT NULL, so ``required`` columns are checked here."""
    checked = [
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} must not be NULL"))).otherwise(F.col(c)).alias(c)
        if c in required else F.col(c)
        for c in df.columns
    ]
    df.select(*checked).write.insertInto(table)


def create_table(spark: SparkSession, name: str, columns: Sequence[str], comment: str | None = None) -> None:
    """A parquet table.  Spark has no automatic keys; number the rows when they are written."""
    about = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE {_name(name)} ({', '.join(columns)}) USING parquet{about}")
