"""Landed pages and seeds, session settings, and tables written between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTINGS = {
    # Whole pages travel in each Arrow row, so batches are kept small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # Data hashed by page_id also serves joins on (page_id, more columns) without a new exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Plain JVM case mapping: the same result for these rules, without loading ICU in every executor.
    "spark.sql.icu.caseMappings.enabled": "false",
    # HotSpot never compiles methods above this size; let Spark split such plans instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    # Nodes of pages are a hundredth of their size in a file, so file sizes say nothing about what the driver would have to hold:
    # a side of a join is sent to all tasks when its rows have been measured, never before.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Joins in both branches of a union may come to different numbers of partitions while they run.
    "spark.sql.unionOutputPartitioning": "false",
    # Sizes in a shuffle say as little, so a task reads little of it, and the number of tasks goes up with the rows.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # The same for reading: a task takes two files of a stage table, and those end after so many rows (see write_stage).
    "spark.sql.files.maxPartitionBytes": "8MB",
    # Rows in the order of their groups are aggregated as they come, one group at a time, without a table of groups.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}

# Rows of a file of a stage table, and bytes of a part of a file that is read by itself.
STAGE_FILE_ROWS, STAGE_BLOCK_BYTES = 200_000, 8 << 20
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def read_pages(spark: SparkSession, path: str, spread: int | None = None) -> DataFrame:
    """``pages(page_id, url, html)`` from parquet.

    Splits follow ``spark.sql.files.maxPartitionBytes``.  Reading HTML is CPU work, so a table of few
    splits may ask to be dealt out to ``spread`` tasks first.
    """
    pages = spark.read.parquet(path)
    return pages if spread is None else pages.repartition(spread, "page_id")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """``seeds(site_id, base_url)``: one listing page per company."""
    return spark.read.parquet(path).select("site_id", "base_url")


def seed_pages(seeds: DataFrame, pages: DataFrame) -> DataFrame:
    """Listing pages of the seeds; seeds without a landed page stay, with null ``page_id``.

    Matches are an inner join, whose skewed keys (one listing landed many times) can be split on
    either side; the unmatched seeds are added by an anti-join on distinct URLs.
    """
    matched = pages.join(seeds, seeds.base_url == pages.url).drop("url")
    landed = pages.select(F.col("url").alias("base_url")).distinct()
    return matched.unionByName(seeds.join(landed, "base_url", "left_anti"), allowMissingColumns=True)


def work_folder(spark: SparkSession) -> str:
    """Folder for tables between stages: the shared checkpoint folder of the cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors can reach")
    return f"{folder.rstrip('/')}/pressframe-{spark.sparkContext.applicationId}"


def remove_stages(spark: SparkSession) -> None:
    """Delete all stage tables of this application; frames that read them are of no use afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_stage(frame: DataFrame, name: str, apart: str | None = None) -> DataFrame:
    """Write a frame once as parquet and read it back.

    Several branches can then share the work, each scans only its columns, tag filters reach
    the scan, and a lost executor costs a re-read instead of a new parse.  Files end after a number of rows, so the tasks that
    read a table go up with its rows and each holds as much, however few tasks wrote it.  Rows that differ in ``apart``, a column of few
    values, go to files of their own, so who asks for one kind does not read the other.  ``remove_stages`` clears
    them when their results have been used.
    """
    spark = frame.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = frame.write.option("maxRecordsPerFile", STAGE_FILE_ROWS).option("parquet.block.size", STAGE_BLOCK_BYTES)
    if apart is None:
        writer.parquet(path)
    else:
        # A task keeps a file open for each of up to so many values, instead of sorting its rows by them.
        before = spark.conf.get(_OPEN_FILES)
        spark.conf.set(_OPEN_FILES, "4")
        try:
            writer.partitionBy(apart).parquet(path)
        finally:
            spark.conf.set(_OPEN_FILES, before)
    return spark.read.schema(frame.schema).parquet(path)


def write_dom_table(nodes: DataFrame, table: str, buckets: int) -> DataFrame:
    """Keep ``dom_nodes`` as a table bucketed and sorted by page: one exchange at write time,
    none in the windows, aggregates and joins by ``page_id`` that read it later."""
    (nodes.repartition(buckets, "page_id").write.bucketBy(buckets, "page_id").sortBy("page_id", "pos")
     .mode("overwrite").saveAsTable(table))
    return nodes.sparkSession.table(table)


def page_errors(nodes: DataFrame, pages: DataFrame, stage: str = "dom") -> DataFrame:
    """Pages that could not be read, as data."""
    bad = nodes.where("kind = 'R'").select("page_id", F.lit(stage).alias("stage"), F.col("text").alias("error"))
    return bad.join(pages.select("page_id", "url"), "page_id", "left").select("page_id", "url", "stage", "error")
