"""Tables between steps, in the folder all executors share, and small column helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session on one machine may leave it unset; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="llm-stages-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Texts are long, so few of them travel in one Arrow batch: what a task holds beside the heap, in the JVM and in Python, follows from it.
BATCH_ROWS = 2000
#: A batch ends with the row that reaches so many bytes, whatever its rows hold beside the text.
BATCH_BYTES = 1 << 20


def _size(setting: str) -> int:
    """Bytes, or a number, as Spark's settings write it: ``2000``, ``64m``, ``67108864b``."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def small_batches(spark: SparkSession) -> None:
    """Lets the session send at most ``BATCH_ROWS`` rows and some ``BATCH_BYTES`` a batch to Python; smaller settings stay."""
    for setting, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        setting = f"spark.sql.execution.arrow.{setting}"
        if not 0 < _size(spark.conf.get(setting)) <= most:
            spark.conf.set(setting, str(most))


class Stages:
    """Parquet tables of one operator run, each in a new folder of the shared one.

    A stage is written once and read back, so a lost executor costs a read and not a
    recomputation, and the plan behind it is cut.  ``drop`` removes stages that no
    returned frame reads any more.
    """

    def __init__(self, spark: SparkSession, operator: str):
        small_batches(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{operator}-{uuid.uuid4().hex}"

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_bytes(column: str = "text") -> Column:
    """A whole text as UTF-8 bytes; null reads as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def crc_rest(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def row_keys() -> list[Column]:
    """``did`` and ``th``: never-null id and text hash; rows with equal keys are the same document twice.

    Ids are whole numbers; others end the query with CAST_INVALID_INPUT.
    """
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), F.xxhash64("text").alias("th")]


def without(docs: DataFrame, dropped: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose key is not in ``dropped(did, th)``; of rows with a key in ``once`` one stays.

    Which one follows from the rows, so reruns agree.  Only rows that a fixed-size filter cannot rule out are exchanged, the others go
    straight through.
    """
    from .filters import bit_filter, passing_rows

    keys = ["did", "th"]
    some = dropped.select(*keys) if once is None else dropped.select(*keys).union(once.select(*keys))
    wanted = bit_filter(some.select(F.xxhash64(*keys).alias("key")), "key")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *row_keys())
    marked = passing_rows(keyed.withColumn("key", F.xxhash64(*keys)), "key", wanted)
    near = marked.where("maybe").join(dropped.select(*keys).distinct(), keys, "left_anti")
    if once is not None:
        near = near.groupBy(*keys).agg(F.min_by("row", F.to_json("row")).alias("row"))
    return marked.where("not maybe").select("row.*").union(near.select("row.*"))
