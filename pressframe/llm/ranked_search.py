"""Ranked lexical search of many items over all documents by dense blocked multiplication.

Documents are read once for a block of items and keep only what the block's vocabulary has of them.  Then tiles of documents
times vocabulary, which hold weight times impact, are multiplied by tiles of vocabulary times items.  All entries are whole
numbers in float64, and the sum of a tile stays below 2**53, so that every product is exact in whatever order BLAS adds;
tiles are added up as 64-bit integers.  A task keeps the best documents of each item and never parts
equal scores but by ``doc_id``.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from .bytewords import Words, letters_and_digits, signed, slices
from .common import Stages, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
TILE_DOCS = TILE_TERMS = 1024
#: Items are taken in blocks of about so many bytes, an item counting some more than its text.
BLOCK_BYTES, ITEM_BYTES = 1 << 20, 256
#: Scale of term weights, parts of the impact formula, and the bound that every impact stays below.
SCALE, UNIT, SATURATION, LENGTH_SHARE, IMPACT_BOUND = 1000, 10**9, 12, 25, 10**6
#: Whole numbers below this one are exact in float64.
EXACT = 1 << 53
_SALTS = 32


def _term_counts(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None):
    """Row, term and count of the distinct terms of each text of a slice, and how many terms each text has in all.

    Terms are numbers in the sorted ``vocabulary`` of hashes, others being left out, or without one the hashes themselves.
    """
    words = Words(data, offsets, letters_and_digits())
    doc, term = words.doc, words.hash
    if vocabulary is not None:
        at = np.searchsorted(vocabulary, term)
        at[at == len(vocabulary)] = 0
        known = np.flatnonzero(vocabulary[at] == term) if len(vocabulary) else np.zeros(0, np.int64)
        doc, term = doc[known], at[known].astype(np.uint64)
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return doc[first], term[first], np.diff(np.append(first, len(doc))), words.counts


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, th, term, q``: how often each item has each term (a 64-bit hash); ``th`` tells items of one id apart."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in slices(batch.column(2)):
                doc, term, n, _ = _term_counts(data, offsets, None)
                of = [batch.column(i).take(pa.array(row + doc)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*of, pa.array(signed(term)), pa.array(n)], names=["item_id", "th", "term", "q"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "th", text_bytes()).mapInArrow(stage, f"item_id {kind}, th long, term long, q long")


class ItemBlock:
    """Items of one block: their keys, vocabulary, and counts as (term, item, q) in order of terms.  It is a few times the block's bytes."""

    def __init__(self, rows: pa.Table):
        keys = rows.group_by(["item_id", "th"]).aggregate([]).sort_by([("item_id", "ascending"), ("th", "ascending")])
        self.ids = keys.column("item_id").combine_chunks()
        number = {key: i for i, key in enumerate(zip(self.ids.to_pylist(), keys.column("th").to_pylist()))}
        item = np.array([number[key] for key in zip(rows.column("item_id").to_pylist(), rows.column("th").to_pylist())], np.int64)
        self.vocabulary, term = np.unique(rows.column("term").to_numpy().view(np.uint64), return_inverse=True)
        order = np.argsort(term, kind="stable")
        self.term, self.item, self.q = term[order], item[order], rows.column("q").to_numpy()[order]


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[ItemBlock]:
    """The items in blocks of about ``block_bytes``; the driver holds the terms of one block at a time."""
    known = items.where("text is not null").select("item_id", "text").distinct().withColumn("th", F.xxhash64("text"))
    size = known.agg(F.sum(F.octet_length("text") + ITEM_BYTES)).first()[0] or 0
    blocks = -(-size // block_bytes)
    for block in range(blocks):
        rows = item_terms(known.where(F.pmod(F.xxhash64("item_id", "th"), F.lit(blocks)) == block)).toArrow()
        if rows.num_rows:
            yield ItemBlock(rows)


def document_vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id, n_terms, terms, counts`` of every document with a term: numbers in the vocabulary, and their counts, packed as int32 and int64."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1)):
                doc, term, n, counts = _term_counts(data, offsets, vocabulary)
                cut = np.searchsorted(doc, np.arange(end - row + 1))
                terms, times = term.astype("<i4").tobytes(), n.astype("<i8").tobytes()
                has = np.flatnonzero(counts)
                packed = [pa.array([part[cut[d] * w:cut[d + 1] * w] for d in has], pa.binary()) for part, w in ((terms, 4), (times, 8))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + has)), pa.array(counts[has]), *packed],
                                                 names=["doc_id", "n_terms", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes()).mapInArrow(stage, "doc_id long, n_terms long, terms binary, counts binary")


def corpus_counts(vectors: DataFrame, n_vocabulary: int) -> tuple[np.ndarray, int, int]:
    """Documents that hold each term of the vocabulary, all documents with a term, and their terms.

    A task sums its own documents, so at most one short row for each term leaves it.
    """
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_vocabulary + 2, np.int64)
        for batch in batches:
            sums[:-2] += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4"), minlength=n_vocabulary)
            sums[-2:] += batch.num_rows, batch.column(0).to_numpy().sum()
        has = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(sums[has])], names=["term", "n"])

    rows = vectors.select("n_terms", "terms").mapInArrow(stage, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(n_vocabulary + 2, np.int64)
    sums[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return sums[:-2], int(sums[-2]), int(sums[-1])


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(SCALE * math.log((2.0 * n_docs + 2) / (2.0 * n + 1))) for n in df.tolist()], np.int64)


def digit_base(top_weight: int, tile_terms: int = TILE_TERMS) -> int:
    """Base in which an item's counts are written, so that a tile's sum of digits times weights times impacts is exact."""
    base = (EXACT - 1) // (tile_terms * max(top_weight, 1) * IMPACT_BOUND) + 1
    if base < 2:
        raise ValueError(f"tiles of {tile_terms} terms are too large for exact sums")
    return base


class _Multiplier:
    """Scores of document tiles for all items of a block."""

    def __init__(self, block: ItemBlock, weights: np.ndarray, n_docs: int, n_terms: int, tile_terms: int):
        self.weights, self.n_docs, self.n_terms, self.n_items = weights, n_docs, n_terms, len(block.ids)
        # Terms that many documents have come first: tiles of rare ones then shrink to few columns and rows.
        by_weight = np.argsort(weights, kind="stable")
        self.place = np.empty(len(weights), np.int64)
        self.place[by_weight] = np.arange(len(weights))
        order = np.argsort(self.place[block.term], kind="stable")
        self.term, self.item, q = self.place[block.term][order], block.item[order], block.q[order]
        self.base, self.digits = digit_base(int(weights.max(initial=0)), tile_terms), []
        while q.any():
            self.digits.append((q % self.base).astype(float))
            q = q // self.base
        self.tile_terms = tile_terms

    def scores(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Documents by items, from the length of each document and its (document, term, count) entries."""
        out = np.zeros((len(n), self.n_items), np.int64)
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * self.n_docs) // self.n_terms
        value = (self.weights[term] * ((UNIT * tf) // (SCALE * tf + SATURATION * m[doc]))).astype(float)
        term = self.place[term]
        order = np.argsort(term, kind="stable")
        doc, term, value = doc[order], term[order], value[order]
        for low in range(0, len(self.weights), self.tile_terms):
            a, b = np.searchsorted(term, (low, low + self.tile_terms))
            if a == b:
                continue
            columns, column = np.unique(term[a:b], return_inverse=True)
            rows, row = np.unique(doc[a:b], return_inverse=True)
            impacts = np.zeros((len(rows), len(columns)))
            impacts[row, column] = value[a:b]
            c, d = np.searchsorted(self.term, (low, low + self.tile_terms))
            at = np.searchsorted(columns, self.term[c:d])
            at[at == len(columns)] = 0
            used = np.flatnonzero(columns[at] == self.term[c:d])
            for power, digits in enumerate(self.digits):
                wanted = np.zeros((len(columns), self.n_items))
                wanted[at[used], self.item[c:d][used]] = digits[c:d][used]
                if wanted.any():
                    out[rows] += (impacts @ wanted).astype(np.int64) * self.base**power
        return out


class _Best:
    """The ``top`` highest scores above zero of each item so far; equal scores by ``doc_id``, nulls last."""

    def __init__(self, n_items: int, top: int):
        self.top, self.least, self.held = top, np.ones(n_items, np.int64), [np.zeros(0, np.int64)] * 4

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item, none, score, doc = (np.concatenate(x) for x in zip(self.held, (item, no_id[row], scores[row, item], ids[row])))
        order = np.lexsort((doc, none, -score, item))
        item, none, score, doc = item[order], none[order], score[order], doc[order]
        first = np.searchsorted(item, item, "left")
        rank = np.arange(len(item)) - first
        last = rank == self.top - 1
        self.least[item[last]] = score[last]
        self.held = [x[rank < self.top] for x in (item, none, score, doc)]


def best_documents(vectors: DataFrame, block: ItemBlock, weights: np.ndarray, n_docs: int, n_terms: int, kind: str, top: int = TOP,
                   tile_docs: int = TILE_DOCS, tile_terms: int = TILE_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of a block's items: the best of each task, then of each salt, then of all."""
    schema = StructType.fromDDL(f"item_id {kind}, item int, doc_id long, score long")

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multiplier, best = _Multiplier(block, weights, n_docs, n_terms, tile_terms), _Best(len(block.ids), top)
        for batch in batches:
            for at in range(0, batch.num_rows, tile_docs):
                tile = batch.slice(at, tile_docs)
                terms = tile.column(2).to_pylist()
                doc = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
                term = np.frombuffer(b"".join(terms), "<i4").astype(np.int64)
                tf = np.frombuffer(b"".join(tile.column(3).to_pylist()), "<i8")
                ids = tile.column(0)
                scores = multiplier.scores(tile.column(1).to_numpy(), doc, term, tf)
                best.add(scores, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        item, none, score, doc = best.held
        yield pa.RecordBatch.from_arrays(
            [block.ids.take(pa.array(item)), pa.array(item.astype(np.int32)), pa.array(doc, pa.int64(), mask=none.astype(bool)), pa.array(score)],
            names=["item_id", "item", "doc_id", "score"])

    found = vectors.select("doc_id", "n_terms", "terms", "counts").mapInArrow(stage, schema)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", salt).orderBy(*order))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return found.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, tile_docs: int = TILE_DOCS,
           tile_terms: int = TILE_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents above zero for each of ``items(item_id, text)``.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; weights come from counts over all ``docs(doc_id, text)``.
    Every document with a term is scored for every item; equal scores rank by ascending ``doc_id``.
    Defined cases: a null, empty or wordless item gives no rows, nor does one no document shares a term with; items with equal id and text
    are one, with equal id and other texts each has its own ranks; a document without terms counts nowhere; repeated rows are
    documents of their own and may both be ranked; documents without id rank last among equal scores; texts are read whole, bytes that are not UTF-8 as
    parts of words; empty tables give no rows; other columns are not read.  ``doc_id`` has to be a whole number.
    Terms are compared by 64-bit hashes.
    """
    stages, kind = Stages(docs.sparkSession, "ranked-search"), items.schema["item_id"].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for number, block in enumerate(item_blocks(items, block_bytes)):
        vectors = stages.write(document_vectors(docs, block.vocabulary), f"vectors-{number}")
        df, n_docs, n_terms = corpus_counts(vectors, len(block.vocabulary))
        if n_docs:
            weights = term_weights(df, n_docs)
            ranked = best_documents(vectors, block, weights, n_docs, n_terms, kind, top, tile_docs, tile_terms)
            found = found.union(stages.write(ranked, f"ranked-{number}"))
        stages.drop(f"vectors-{number}")
    return found
