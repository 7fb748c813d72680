"""Per-packet counting over files as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.operators.logs import present


def packet_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """Packets of parquet files in a folder, also of those added later."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def running_frequency(packets: DataFrame, field: Column, name: str = "name") -> DataFrame:
    """``(name, cnt)`` kept up to date; the state has one row per name."""
    return packets.where(present(field)).groupBy(field.alias(name)).agg(F.count("*").alias("cnt"))


def count_until_done(frequencies: DataFrame, checkpoint: str, out: str) -> str:
    """Count everything that is there, however long it takes, and name the folder of the last state.

    Every state is written whole below ``out`` under its batch; one that a
    restart has written already is written over.
    """
    written: list[str] = []

    def store(batch: DataFrame, number: int) -> None:
        path = f"{out}/batch={number}"
        batch.write.mode("overwrite").parquet(path)
        written.append(path)

    running = (
        frequencies.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(store).start()
    )
    # an error of the stream is raised here
    running.awaitTermination()
    if not written:
        raise ValueError("no packets arrived")
    return written[-1]
