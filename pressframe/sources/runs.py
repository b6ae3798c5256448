"""Tables written run by run, of which readers see committed runs only.

``<path>/data/run=<name>/`` holds the rows of a run and ``<path>/_runs/<name>.json`` says that they are complete.  The second is written
last and by one rename, so a run that fails half-way is not there, may be repeated, and then replaces its own files alone.
"""

from __future__ import annotations

import json
import re

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _mark(path: str, run: str) -> str:
    if not _NAME.fullmatch(run):
        raise ValueError(f"a run's name has letters, digits, dots, dashes and underscores only, not {run!r}")
    return f"{path}/_runs/{run}.json"


def committed_runs(spark: SparkSession, path: str) -> dict[str, StructType]:
    """Names of the committed runs, in order, with the schema each was written in."""
    where, fs = _place(spark, f"{path}/_runs")
    if not fs.exists(where):
        return {}
    names = sorted(s.getPath().getName() for s in fs.listStatus(where))
    found = {}
    for name in (n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith((".", "_"))):
        text = spark.read.text(_mark(path, name), wholetext=True).first().value
        found[name] = StructType.fromJson(json.loads(text))
    return found


def is_committed(spark: SparkSession, path: str, run: str) -> bool:
    where, fs = _place(spark, _mark(path, run))
    return fs.exists(where)


def write_run(frame: DataFrame, path: str, run: str, partition_by: tuple[str, ...] = (), commit: bool = True) -> None:
    """Write one run's rows and then commit it.  A run of that name is taken back first, its files are replaced, others stay."""
    spark = frame.sparkSession
    mark, fs = _place(spark, _mark(path, run))
    fs.delete(mark, False)
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/data/run={run}")
    if commit:
        commit_run(spark, path, run, frame.schema)


def commit_run(spark: SparkSession, path: str, run: str, schema: StructType) -> None:
    mark, fs = _place(spark, _mark(path, run))
    draft, _ = _place(spark, f"{path}/_runs/_{run}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(schema.json(), "utf-8"))
    out.close()
    fs.delete(mark, False)
    if not fs.rename(draft, mark):
        raise OSError(f"could not commit run {run} of {path}")


def read_runs(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Rows of all committed runs with their ``run``.  ``schema`` is for a table that has none yet; runs are read by the names of their columns."""
    runs = committed_runs(spark, path)
    if runs:
        schema = list(runs.values())[-1]
    elif schema is None:
        raise FileNotFoundError(f"no committed run in {path}")
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    schema = StructType([f for f in schema if f.name != "run"]).add("run", StringType())
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*[f"{path}/data/run={r}" for r in runs])
