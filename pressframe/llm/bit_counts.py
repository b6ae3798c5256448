"""SimHash near-duplicates by a segment-popcount embedding.

Each distinct fingerprint is one point: the numbers of set bits in its segments.  The Manhattan distance of two points is
at most the number of differing bits, so whatever links lies that near in the embedding.  Of a distance of three, one half of the
segments holds one at most: each half is a grid of unit cells, and a point meets those of its own cell and of the
cells at distance one.  Two such cells differ in the parity of their sums, so only odd points go to the cells around.  What meets
is held against the whole embedding and then against the fingerprints themselves.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .bytewords import SLICE_BYTES, Words, mix, not_space, signed, slices
from .chosen_path import _by_meeting, components
from .common import Stages, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS, DIFFERING, SHINGLE, SEED = 64, 3, 3, 42
#: Bits of a segment.  Narrow ones keep apart more: a half grid of 16 segments has about 22 bits of entropy.
SEGMENT = 2
#: Cells with more points are refined before anything is compared.
CROWDED = 1024
_HASHED_AT_ONCE = 1 << 17
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _joined(data: np.ndarray, words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a slice with one blank after each, and where they start and end there."""
    size = words.end - words.start
    start = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(int(start[-1]), 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[start[1:] - 1] = False
    marks = np.zeros(len(data) + 1, np.int8)
    marks[words.start] += 1
    marks[words.end] -= 1
    out[inside] = data[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
    return out.tobytes(), start[:-1], start[1:] - 1


def _votes(text: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many of the strings' hashes have each bit, the highest first."""
    from xxhash import xxh64_digest

    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(start), _HASHED_AT_ONCE):
        cut = slice(at, at + _HASHED_AT_ONCE)
        hashes = b"".join([xxh64_digest(text[a:b], SEED) for a, b in zip(start[cut].tolist(), end[cut].tolist())])
        votes += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return votes


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, q: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text of a slice; 0 without words."""
    words = Words(data, offsets, not_space(), hashed=False)
    text, start, end = _joined(words.low, words)
    out, first = np.zeros(words.n_docs, np.uint64), 0
    for row, n in enumerate(words.counts.tolist()):
        if n:
            run = min(q, n)
            votes = _votes(text, start[first:first + n - run + 1], end[first + run - 1:first + n])
            out[row] = np.packbits(2 * votes > n - run + 1).view(">u8")[0]
            first += n
    return out


def fingerprinted(docs: DataFrame, q: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` for every row of ``docs(doc_id, text)``; ``fp`` holds the 64 bits as a signed number."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1), SLICE_BYTES):
                found = fingerprints_of(data, offsets, q)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(signed(found))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes()).mapInArrow(stage, f"doc_id {kind}, fp long")


def segment_counts(fp: np.ndarray, width: int = SEGMENT) -> np.ndarray:
    """The embedding: set bits of each segment of ``width`` bits, points by segments."""
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8)).reshape(len(fp), BITS // width, width)
    return bits.sum(2, dtype=np.uint8)


def stacked(fp: np.ndarray, width: int = SEGMENT) -> np.ndarray:
    """The embedding in one number: the set bits of each segment moved to its low end.

    The Manhattan distance of two points is the number of bits in which these differ.
    """
    low = np.arange(width, dtype=np.uint8)[::-1] < segment_counts(fp, width)[:, :, None]
    return np.packbits(low.reshape(len(fp), BITS), axis=1).view(">u8")[:, 0].astype(np.uint64)


def _cells(counts: np.ndarray, grid: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Point and cell for each cell of one grid that a point goes to: its own, and those at distance one if its sum is odd."""
    n, dims = counts.shape
    # A cell's key is a sum over its coordinates, so a step along one of them is one addition.
    step = mix(np.arange(1, dims + 1, dtype=np.uint64) * _GOLDEN)
    own = (counts * step).sum(1, dtype=np.uint64) + mix(np.array([grid], np.uint64))
    points, cells = [np.arange(n)], [own]
    odd = np.flatnonzero(counts.sum(1) % 2)
    for k in range(dims):
        for up, allowed in ((True, counts[odd, k] < width), (False, counts[odd, k] > 0)):
            to = odd[allowed]
            points.append(to)
            cells.append(own[to] + step[k] if up else own[to] - step[k])
    return np.concatenate(points), mix(np.concatenate(cells))


def grid_cells(points: DataFrame, width: int = SEGMENT) -> DataFrame:
    """``cell, free, fp``: the cells of both half grids that each fingerprint of ``points(fp)`` goes to.

    ``free`` has the bits that the cell has not been refined by, here all.
    """
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            counts = segment_counts(fp, width)
            half = counts.shape[1] // 2
            for grid, part in enumerate((counts[:, :half], counts[:, half:]), 1):
                at, cells = _cells(part, grid, width)
                yield pa.RecordBatch.from_arrays([pa.array(signed(cells)), pa.array(np.full(len(at), -1)), pa.array(signed(fp[at]))],
                                                 names=["cell", "free", "fp"])

    return points.select("fp").mapInArrow(stage, "cell long, free long, fp long")


def _quarters(free: int) -> list[int]:
    """The set bits of a mask dealt to one mask more than there may be differing bits."""
    places = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << i for i in places[k::DIFFERING + 1]) for k in range(DIFFERING + 1)]


def refined(crowded: DataFrame) -> DataFrame:
    """``cell, free, fp`` of crowded cells, once more for each quarter of their free bits.

    Of four quarters that differ in three bits at most, one is equal; so the points of a cell that are equal in a quarter meet, and no
    link is lost.  Each time a quarter less is free, and few free bits leave few fingerprints: cells end up small.
    """
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, free, fp = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            for mask in np.unique(free):
                rows = np.flatnonzero(free == mask)
                for quarter in _quarters(int(mask)):
                    bits = np.uint64(quarter)
                    key = mix(cell[rows] + mix((fp[rows] & bits) + mix(np.full(len(rows), bits))))
                    left = np.full(len(rows), mask & ~bits)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(x)) for x in (key, left, fp[rows])], names=["cell", "free", "fp"])

    return crowded.select("cell", "free", "fp").mapInArrow(stage, "cell long, free long, fp long")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each of ``n`` rows reaches over the links of rows ``a`` and ``b``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        if (low == root[a]).all() and (low == root[b]).all():
            return root
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]


def _linked_rows(cell: np.ndarray, fp: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the rows they are joined to, for rows in order of cells: pairs of one cell, by the bound and then exactly."""
    point, one, two = stacked(fp, width), [], []
    first, apart = np.arange(len(cell)), 0
    while len(first):
        apart += 1
        first = first[first + apart < len(cell)]
        first = first[cell[first] == cell[first + apart]]
        near = first[np.bitwise_count(point[first] ^ point[first + apart]) <= DIFFERING]
        near = near[np.bitwise_count(fp[near] ^ fp[near + apart]) <= DIFFERING]
        one.append(near)
        two.append(near + apart)
    root = _roots(len(cell), np.concatenate(one), np.concatenate(two)) if one else np.arange(0)
    joined = np.flatnonzero(root != np.arange(len(root)))
    return root[joined], joined


def cell_links(rows: DataFrame, width: int = SEGMENT) -> DataFrame:
    """``a, b``: as many links as join what is linked within each cell of ``rows(cell, fp)``, not all pairs."""
    def judge(table: pa.Table) -> pa.RecordBatch:
        cell, fp = (table.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(signed(fp[at])) for at in _linked_rows(cell, fp, width)], names=["a", "b"])

    placed = rows.select("cell", "fp").repartition("cell").sortWithinPartitions("cell", "fp")
    return placed.mapInArrow(_by_meeting(judge), "a long, b long")


def fingerprint_links(points: DataFrame, stages: Stages, width: int = SEGMENT, crowded: int = CROWDED) -> DataFrame:
    """``a, b``: links that join all fingerprints of ``points(fp)`` that differ in three bits at most, over others or directly."""
    found, cells, level = None, stages.write(grid_cells(points, width), "cells-0"), 0
    while True:
        full = stages.write(cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("cell"), f"full-{level}")
        few = stages.write(cell_links(cells.join(full, "cell", "left_anti"), width).distinct(), f"links-{level}")
        found = few if found is None else found.union(few)
        if not full.limit(1).count():
            stages.drop(f"cells-{level}", f"full-{level}")
            return found
        level += 1
        finer = stages.write(refined(cells.join(full, "cell", "left_semi")), f"cells-{level}")
        stages.drop(f"cells-{level - 1}", f"full-{level - 1}")
        cells = finer


def similar_fingerprints(docs: DataFrame, width: int = SEGMENT, crowded: int = CROWDED) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Words are runs without white space, A-Z lower-cased; a text's shingles of three words, repeats included, vote with the bits of
    their XXH64.  Documents whose fingerprints differ in at most three bits are linked; ``component_id`` is the
    smallest ``doc_id`` reachable.
    Defined cases: null, empty and blank texts have the fingerprint zero and are linked like others, fewer than three words are one
    shingle; texts of any length count whole; repeated rows give a row each; rows without id can be linked
    but give no component id of their own (null if nobody else does); bytes that are not UTF-8 are hashed as they are; empty
    tables give no rows; other columns are not read.
    """
    if BITS // 2 % width or crowded < 1 << DIFFERING + 1:
        raise ValueError("segments divide half of the bits, and a crowded cell has 16 points or more")
    stages = Stages(docs.sparkSession, "bit-counts")
    prints = stages.write(fingerprinted(docs), "prints")
    points = stages.write(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    links = fingerprint_links(points, stages, width, crowded)
    joined = stages.write(components(links, stages, "joined"), "components")
    own = points.join(joined, points["fp"] == joined["cid"], "left").select("fp", "least", F.coalesce("comp", "fp").alias("comp"))
    smallest = own.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_point = stages.write(own.join(smallest, "comp").select("fp", "component_id"), "result")
    stages.drop("points", "components")
    text = F.lower(F.lpad(F.hex("fp"), BITS // 4, "0"))
    return prints.join(of_point, "fp").select("doc_id", text.alias("fingerprint"), "component_id")
