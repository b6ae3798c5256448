"""Training-data pipeline over ``documents``: stages of the llm operators, each written and read again.

Every stage takes ``(spark, docs, sf_dir)``.  All but the last return the columns of ``docs``; extra columns, whatever
their names, go along.  Nulls, empty texts, repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressframe.llm.chosen_path import near_duplicates
from pressframe.llm.common import Stages, read_table, without
from pressframe.llm.decontaminate import contamination
from pressframe.llm.mixing import mix_sources
from pressframe.llm.quality import keep_good
from pressframe.llm.secrets import scan_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the pairwise ranking rejects (score under 0.3)."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id; repeated rows become one."""
    found = near_duplicates(docs)
    repeated = found.groupBy("did", "th").count().where("count > 1")
    return without(docs, found.where("not is_first"), once=repeated)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words at least one in twenty lies in a benchmark window."""
    return without(docs, contamination(docs, read_table(spark, sf_dir, "benchmark")).where("contaminated"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by their kind in brackets and counts ``n_chars`` of changed texts anew."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    scanned = scan_secrets(rows, keep=("row",), redact=True)
    changed = F.col("redacted_text").isNotNull()
    new = {"text": F.col("redacted_text"), "n_chars": F.char_length("redacted_text")}
    return scanned.select(*[F.when(changed, new[f.name].cast(f.dataType)).otherwise(F.col("row")[f.name]).alias(f.name)
                            if f.name in new else F.col("row")[f.name].alias(f.name) for f in docs.schema])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: one row for each document taken, with the number of its copies and the words they give."""
    return mix_sources(docs).where("copies > 0")


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix),
]

#: Learned scores and set similarity joins are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages, docs, before = Stages(spark, "pipeline"), read_table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        docs = stages.write(stage(spark, docs, sf_dir), f"stage-{number}")
        if before:
            stages.drop(before)
        before = f"stage-{number}"
    return docs
