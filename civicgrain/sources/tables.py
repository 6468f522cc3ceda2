"""Reading the named tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, spread over the cores where they come in far fewer pieces than there are cores.

    Work on texts is bound by the processor; one small file in one row group would be one
    task. A corpus of many pieces is read as it is, without a shuffle.
    """
    frame, cores = table(spark, folder, "documents"), spark.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() * 2 <= cores else frame
