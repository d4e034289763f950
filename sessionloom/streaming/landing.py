"""Pages that land in a folder, parsed as a stream and appended once to a table.

An extension of the batch loaders: new files are read as they come, URLs seen within the watermark are dropped
in the state, and every batch is inserted only where the table does not hold the URL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionloom.functions.codes import record_key
from sessionloom.sinks.tables import insert_if_absent

PAGES = "url string, html string, fetched_at timestamp"


def landed_pages(spark: SparkSession, path: str, delay: str = "1 day", schema: str = PAGES) -> DataFrame:
    """Landed Parquet files of pages, each URL once within ``delay``."""
    pages = spark.readStream.schema(schema).parquet(path).withWatermark("fetched_at", delay)
    return pages.withColumn("_id", record_key(F.col("url"))).dropDuplicatesWithinWatermark(["_id"])


def append_new(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Everything that has landed, inserted where absent; then the query ends."""

    def batch(df: DataFrame, _: int) -> None:
        insert_if_absent(df.drop("_id"), table)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
