"""Token counts through an exact histogram of encoded lengths.

Documents are encoded once and summed by length, and that histogram is written; sums over longer lengths then answer, for
every context limit, how many documents and tokens fit, are cut or lost.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .common import Stages

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A public byte-level BPE vocabulary; only the path is used, nothing is copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how that vocabulary cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CHUNK = 1024


def encoder(path: str = VOCABULARY, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``n_tokens, docs`` over all rows of ``docs(text)``; null and empty texts have length 0, bytes that are not UTF-8 count as U+FFFD.

    A task sums its own documents first, so at most one short row for each length leaves it.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sums = encoder(path, pattern).encode_ordinary, {}
        for batch in batches:
            for text in batch.column(0):
                n = len(encode(text.as_py() or ""))
                sums[n] = sums.get(n, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["n_tokens", "docs"])

    return docs.select(F.make_valid_utf8("text")).mapInArrow(count, "n_tokens long, docs long").groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """What every context limit that is some document's length means for the corpus.

    ``n_tokens, docs, tokens, docs_up_to, tokens_up_to, docs_from, tokens_from`` (sums over shorter and longer
    lengths, this one included) and ``tokens_truncated`` (all documents cut to ``n_tokens``).  Sums run inside chunks of
    lengths and then over chunks, so no task holds all lengths.
    """
    rows = histogram.select("n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("tokens"),
                            F.floor(F.col("n_tokens") / _CHUNK).alias("chunk"))
    chunks = rows.groupBy("chunk").agg(F.sum("docs").alias("chunk_docs"), F.sum("tokens").alias("chunk_tokens"))
    later = Window.orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    chunks = chunks.select("chunk", *[F.coalesce(F.sum(f"chunk_{k}").over(later), F.lit(0)).alias(f"{k}_after") for k in ("docs", "tokens")],
                           *[F.sum(f"chunk_{k}").over(every).alias(f"all_{k}") for k in ("docs", "tokens")])
    inside = Window.partitionBy("chunk").orderBy(F.col("n_tokens").desc())
    summed = rows.join(chunks, "chunk").select(
        "n_tokens", "docs", "tokens", "all_docs", "all_tokens",
        (F.sum("docs").over(inside) + F.col("docs_after")).alias("docs_from"),
        (F.sum("tokens").over(inside) + F.col("tokens_after")).alias("tokens_from"))
    return summed.select(
        "n_tokens", "docs", "tokens", (F.col("all_docs") - F.col("docs_from") + F.col("docs")).alias("docs_up_to"),
        (F.col("all_tokens") - F.col("tokens_from") + F.col("tokens")).alias("tokens_up_to"), "docs_from", "tokens_from",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("tokens_truncated"))


def truncated_totals(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``limit, docs_cut, tokens_kept`` for any limits, from :func:`limit_table`."""
    cells = [F.struct(F.lit(int(x)).alias("limit"),
                      F.coalesce(F.sum(F.when(F.col("n_tokens") > x, F.col("docs"))), F.lit(0)).alias("docs_cut"),
                      F.coalesce(F.sum(F.least("n_tokens", F.lit(int(x))) * F.col("docs")), F.lit(0)).alias("tokens_kept")) for x in limits]
    return table.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, n_tokens``: the smallest length that at least that share of the documents does not exceed."""
    up_to = F.col("docs_up_to") / (F.col("docs_up_to") + F.col("docs_from") - F.col("docs"))
    cells = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(up_to >= s, F.col("n_tokens"))).alias("n_tokens")) for s in shares]
    return table.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def token_lengths(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """:func:`limit_table` of the whole texts of ``docs``; an empty table gives no rows, repeated rows count each."""
    return limit_table(Stages(docs.sparkSession, "token-lengths").write(length_histogram(docs, path, pattern), "histogram"))
