"""Incremental intake: new documents of a growing folder, each address once, stored batch by batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from civicgrain.operators.tables import insert_absent


def new_documents(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A stream of the documents of a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def store(stream: DataFrame, table: str, checkpoint: str):
    """Append the addresses the table lacks, all that is there, then stop. Re-running adds nothing.

    Addresses are compared with the table itself and not within a watermark: a document
    fetched very late, or at an unknown time, would be dropped by one.
    """

    def batch(rows: DataFrame, _: int) -> None:
        try:
            old = rows.sparkSession.read.parquet(table)
        except AnalysisException:  # no table yet
            old = rows.limit(0)
        insert_absent(old, rows, ["source_url"], rows["doc_id"]).write.mode("append").parquet(table)

    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start()
