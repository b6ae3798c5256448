"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows of words, windows into shingles of a few words.  A window is contained
in a document only if its rarest shingle is, so that one (the prefix that full containment
needs) is joined; then length and position bounds and the exact words decide.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .bytewords import Words, letters_and_digits, signed, slices
from .common import Stages, row_keys, text_bytes
from .filters import bit_filter, passes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, SHINGLE = 13, 3


def _slice_words(low: bytes, words: Words, first: int, end: int) -> bytes:
    return b" ".join(low[words.start[i]:words.end[i]] for i in range(first, end))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, words``: each run of ``size`` words of an item, or all words of a shorter one."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, owners, texts = batch.column(0), [], []
            for row, _, data, offsets in slices(batch.column(1)):
                w = Words(data, offsets, letters_and_digits(), hashed=False)
                low, ends = w.low.tobytes(), np.cumsum(w.counts)
                for d, n in enumerate(w.counts):
                    for i in range(int(ends[d] - n), int(ends[d]) - min(size, int(n)) + 1 if n else 0):
                        owners.append(row + d)
                        texts.append(_slice_words(low, w, i, i + min(size, int(n))))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(owners, pa.int64())), pa.array(texts, pa.binary())], names=["item_id", "words"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", text_bytes()).mapInArrow(stage, f"item_id {kind}, words binary")


def _shingles_of(words: Words, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for q in sizes:
        at, h = words.shingles(q)
        yield q, at, h


def window_shingles(windows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``wid, words, n, q, h, pos``: the shingles of each window, of ``size`` words or of all if there are fewer."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in slices(batch.column(1)):
                w = Words(data, offsets, letters_and_digits())
                ends = np.cumsum(w.counts)
                for q, at, h in _shingles_of(w, list(range(1, size + 1))):
                    fits = (w.counts[w.doc[at]] == q) | (q == size)
                    at, h = at[fits], h[fits]
                    doc = w.doc[at]
                    picked = pa.array(row + doc)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(w.counts[doc].astype(np.int32)),
                         pa.array(np.full(len(at), q, np.int32)), pa.array(signed(h)), pa.array((at - (ends - w.counts)[doc]).astype(np.int32))],
                        names=["wid", "words", "n", "q", "h", "pos"])

    return windows.select("wid", "words").mapInArrow(stage, "wid binary, words binary, n int, q int, h long, pos int")


def shingle_counts(docs: DataFrame, wanted: np.ndarray, sizes: list[int]) -> DataFrame:
    """``h, df``: how often shingles that pass the filter occur in all documents, summed in the tasks first."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                w = Words(data, offsets, letters_and_digits())
                found = [h[passes(wanted, h)] for _, _, h in _shingles_of(w, sizes)]
                h, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, int))
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return docs.select(text_bytes()).mapInArrow(stage, "h long, n long").groupBy("h").agg(F.sum("n").alias("df"))


def probe(docs: DataFrame, wanted: np.ndarray, sizes: list[int], size: int) -> DataFrame:
    """``did, th, doc_id, n_words, near``: for each document the places of shingles that pass the filter, with the words around."""
    place = pa.struct([("h", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("around", pa.binary())])

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, near = [], []
            for _, _, data, offsets in slices(batch.column(3)):
                w = Words(data, offsets, letters_and_digits())
                low, ends = w.low.tobytes(), np.cumsum(w.counts)
                rows: list[list] = [[] for _ in range(w.n_docs)]
                for q, at, h in _shingles_of(w, sizes):
                    for i in np.flatnonzero(passes(wanted, h)):
                        a, d = int(at[i]), int(w.doc[at[i]])
                        begin, end = int(ends[d] - w.counts[d]), int(ends[d])
                        lo = max(begin, a - size + q)
                        rows[d].append({"h": int(signed(h[i:i + 1])[0]), "at": a - begin, "first": lo - begin,
                                        "around": _slice_words(low, w, lo, min(end, a + size))})
                counts.extend(w.counts.tolist())
                near.extend(rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(near, pa.list_(place))],
                                             names=["did", "th", "doc_id", "n_words", "near"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*row_keys(), "doc_id", text_bytes().alias("__bytes")).mapInArrow(
        stage, f"did long, th long, doc_id {kind}, n_words long, near array<struct<h:long,at:int,first:int,around:binary>>")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``did, th, doc_id, n_words, n_hit, n_items, items, contaminated`` for every row of ``docs(doc_id, text)``.

    ``items(item_id, text)``.  ``items`` is the sorted array of item ids (as strings) with a window in the document;
    a document is contaminated when at least one word in twenty lies in an occurrence of a window.
    Defined cases: null and empty texts have no words and no hits; an item without words has no windows; repeated
    documents get equal rows; repeated item ids count once; an item without id marks words but is not listed; empty tables give no rows, or no hits;
    other columns are not read.
    """
    stages = Stages(docs.sparkSession, "decontaminate")
    of_items = stages.write(item_windows(items, size).withColumn("wid", F.unhex(F.sha2("words", 256))), "windows")
    shingles = stages.write(window_shingles(of_items.select("wid", "words").distinct(), shingle), "shingles")
    sizes = sorted(r[0] for r in shingles.select("q").distinct().collect())
    counts = shingle_counts(docs, bit_filter(shingles, "h"), sizes)
    # Rarest first; a window with a shingle that no document has is dropped by the count of its shingles.
    ranked = shingles.join(counts, "h").groupBy("wid", "words", "n").agg(
        F.count_distinct("pos").alias("present"), F.max("q").alias("q"), F.min(F.struct("df", "h", "pos")).alias("rarest"))
    prefix = stages.write(ranked.where(F.col("present") == F.col("n") - F.col("q") + 1)
                          .select("wid", F.col("words").cast("string").alias("words"), "n", "rarest.h", "rarest.pos"), "prefix")
    probed = stages.write(probe(docs, bit_filter(prefix, "h"), sizes, size), "probed")
    stages.drop("shingles")
    near = probed.select("did", "th", "n_words", F.explode("near").alias("at")).select("did", "th", "n_words", "at.*")
    start = F.col("at") - F.col("pos")
    words = F.slice(F.split(F.col("around").cast("string"), " "), start - F.col("first") + 1, F.col("n"))
    hits = stages.write(near.join(prefix, "h").where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
                        .where(F.array_join(words, " ") == F.col("words"))
                        .select("did", "th", "wid", start.alias("start"), (start + F.col("n")).alias("end")).distinct(), "hits")
    stages.drop("prefix")
    keys = ["did", "th"]
    before = F.max("end").over(Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    covered = (hits.select(*keys, "start", "end").distinct().withColumn("before", F.coalesce(before, F.lit(0)))
               .groupBy(*keys).agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "before"), F.lit(0))).alias("n_hit")))
    listed = (hits.select(*keys, "wid").distinct().join(of_items.select("wid", "item_id").distinct(), "wid").where("item_id is not null")
              .select(*keys, F.col("item_id").cast("string").alias("item")).distinct()
              .groupBy(*keys).agg(F.array_sort(F.collect_list("item")).alias("items")))
    found = covered.join(listed, keys, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (probed.select(*keys, "doc_id", "n_words").join(found, keys, "left")
            .select(*keys, "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")))
