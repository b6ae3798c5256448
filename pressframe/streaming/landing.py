"""The same operators over a landing folder that keeps filling up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pressframe.plans.discovery import discover_links

PAGE_SCHEMA = "page_id long, url string, html string"


def watch_pages(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    return (spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder))


def stream_links(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Discover links in every micro-batch.

    All operators work page by page, so no state is carried.  Each batch owns one folder and
    overwrites it, hence a batch that is tried again after a failure leaves no double rows.
    """
    def batch(frame: DataFrame, batch_id: int) -> None:
        discover_links(frame).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
