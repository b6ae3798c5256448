"""One query for each operator, over whole tables, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .bit_counts import similar_fingerprints
from .chosen_path import near_duplicates
from .common import crc_rest, read_table
from .decontaminate import contamination
from .filter_audit import audit_filters
from .host_reputation import judge_urls, path_of
from .language import identify_languages
from .merkle import compare_edited
from .mixing import mix_sources
from .quality import score_quality
from .ranked_search import search
from .repeats import remove_repeats
from .secrets import scan_secrets
from .sql import HOST_RULES, OP1_SQL, OP3_SQL, OP12_SQL, OP13_SQL
from .token_lengths import token_lengths


def op1_prefix_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = crc_rest(F.col("doc_id"), 5)
    scored = score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), learn=rest != 0)
    score = F.col("quality_score")
    return scored.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), score.alias("score"),
                         (score >= 0.3).cast("int").alias("predicted"))


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, bad``: pages whose path ends in the number of a labelled document, bad if that is of low quality or toxic."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})[^/]*/?$", 1)
    pages = read_table(spark, sf_dir, "pages").select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    bad = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(bad)
    return pages.join(labels, "doc_id").select("url", "bad")


def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(read_table(spark, sf_dir, "pages"), labelled_urls(spark, sf_dir), HOST_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "class_id")


def op5_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare_edited(read_table(spark, sf_dir, "documents"))
    return compared.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
                           "edited_fingerprint", "near_edited", "near_next")


def op6_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


#: The kinds of the base scan; the operator adds others.
BASE = ("assign", "access", "hex")


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, spans = scan_secrets(read_table(spark, sf_dir, "documents")), F.col("secret_spans")
    count = [F.size(F.filter(spans, _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *count, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def op9_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths(read_table(spark, sf_dir, "documents"))


def op10_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = crc_rest(F.col("doc_id"), 4)
    found = identify_languages(read_table(spark, sf_dir, "documents"), learn=rest != 2)
    return found.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"), _span_text().alias("spans"))


def _span_text() -> Column:
    text = F.transform("lang_spans", lambda s: F.concat_ws(":", s["lang"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def op11_bit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_fingerprints(read_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_prefix_containment": op1_prefix_containment,
    "op2_pairwise_quality": op2_pairwise_quality,
    "op3_host_reputation": op3_host_reputation,
    "op4_chosen_path": op4_chosen_path,
    "op5_merkle_fingerprint": op5_merkle_fingerprint,
    "op6_previous_factors": op6_previous_factors,
    "op7_entropy_mixing": op7_entropy_mixing,
    "op8_secret_scan": op8_secret_scan,
    "op9_token_lengths": op9_token_lengths,
    "op10_language_spans": op10_language_spans,
    "op11_bit_counts": op11_bit_counts,
    "op12_ranked_search": op12_ranked_search,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES = {
    "op1_prefix_containment": OP1_SQL,
    "op3_host_reputation": OP3_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
