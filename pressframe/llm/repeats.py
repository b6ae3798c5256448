"""Removal of repeated byte strings by longest-previous-factor arrays.

Every string of ``size`` bytes holds a sampled anchor: its smallest gram by hash, the leftmost of equals.  Equal
strings have equal anchors at the same place, so segments around anchors that occur more than once hold all
repeats.  The segments of an anchor meet in one task, lined up at the anchor, and are put in suffix order
byte column by byte column.  Where the common prefix stays long enough, a smaller position before or after in
suffix order is an earlier match; bytes it covers go, and the first copy stays.
An anchor with very many occurrences is instead split by its strings' hashes, whose smallest position is an aggregate.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .bytewords import _BASE, _BYTES, _INVERSE, _powers, mix, running, signed, slices
from .common import Stages, row_keys, text_bytes
from .filters import bit_filter, passes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, GRAM = 100, 32
#: Segments of one anchor that a task lines up at once, some 100 MB; anchors with more take the other way.
GROUP = 200_000
_PART = 1 << 24  # a longer text is sampled in parts that overlap by a string less one byte
_BATCH_ROWS = 5_000


def anchors(data: np.ndarray, offsets: np.ndarray, size: int = SIZE, gram: int = GRAM):
    """Text, anchor position, first and last start of its strings (positions in the text) and gram hash."""
    found = []
    lengths = np.diff(offsets)
    if len(data) <= _PART:
        found.append(_anchors(data, offsets, size, gram, 0))
    else:
        for row in np.flatnonzero(lengths >= size):
            text = data[offsets[row]:offsets[row + 1]]
            for start in range(0, len(text) - size + 1, _PART - size + 1):
                part = text[start:start + _PART]
                found.append((np.full(len(x[1]), row), *x[1:]) if (x := _anchors(part, np.array([0, len(part)]), size, gram, start)) else x)
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]


def _anchors(data, offsets, size, gram, shift):
    n, width = len(data), size - gram + 1
    m = n - gram + 1
    starts = np.concatenate([np.arange(a, b - size + 1) for a, b in zip(offsets[:-1], offsets[1:]) if b - a >= size] or [np.zeros(0, np.int64)])
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = running(data)
    h = mix((sums[gram:] - sums[:-gram]) * _powers(_INVERSE, m))
    low = np.uint64((1 << 25) - 1)
    key = (h & ~low) | np.arange(m, dtype=np.uint64)
    # Smallest key of each run of `width` grams: minima from both ends of blocks of that width.
    blocks = -(-m // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = key
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[starts], ahead[starts + width - 1]) & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first, last, at = starts[new], starts[np.append(new[1:], len(starts)) - 1], at[new]
    row = np.searchsorted(offsets, first, "right") - 1
    base = offsets[row] - shift
    return row, at - base, first - base, last - base, h[at]


def anchor_rows(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """``did, th, h, at, before, after``: anchors with how far their first and last string starts lie before them."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in slices(batch.column(2)):
                of, at, first, last, h = anchors(data, offsets, size, gram)
                picked = pa.array(row + of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(signed(h)), pa.array(at.astype(np.int32)),
                     pa.array((at - first).astype(np.int16)), pa.array((at - last).astype(np.int16))], names=["did", "th", "h", "at", "before", "after"])

    return docs.select(*row_keys(), text_bytes().alias("__bytes")).mapInArrow(stage, "did long, th long, h long, at int, before short, after short")


def repeated_anchors(found: DataFrame) -> DataFrame:
    """``did, th, seen``: of each document the anchors that occur more than once, with their number of occurrences."""
    counted = found.withColumn("n", F.count("*").over(Window.partitionBy("h"))).where("n > 1")
    return counted.groupBy("did", "th").agg(F.collect_set(F.struct("h", "at", "before", "after", "n")).alias("seen"))


def passing(docs: DataFrame, wanted: np.ndarray, *more: str) -> DataFrame:
    """``did, th, bytes`` and ``more`` columns of documents that pass the filter on ``xxhash64(did, th)``."""
    names = ["did", "th", "bytes", *more]

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(passes(wanted, batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[1:]], names=names)

    keyed = docs.select(*row_keys(), "text", *more).select(F.xxhash64("did", "th").alias("key"), "did", "th", text_bytes().alias("bytes"), *more)
    return keyed.mapInArrow(stage, ", ".join(f"`{c}` {t}" for c, t in keyed.dtypes[1:]))


def cut_segments(texts: DataFrame, size: int) -> DataFrame:
    """``h, did, th, start, before, n, segment`` for each entry of ``seen``: the bytes its strings cover."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.column(3)
            entries, cuts = seen.values, seen.offsets.to_numpy()
            h, at, before, after, n = (entries.field(i).to_numpy() for i in range(5))
            start, stop = at - before, at - after + size
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py()
                a, b = cuts[row], cuts[row + 1]
                picked = pa.array(np.full(b - a, row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[a:b]), batch.column(0).take(picked), batch.column(1).take(picked), pa.array(start[a:b].astype(np.int32)), pa.array(before[a:b].astype(np.int16)),
                     pa.array(n[a:b]), pa.array([text[i:j] for i, j in zip(start[a:b], stop[a:b])], pa.binary())],
                    names=["h", "did", "th", "start", "before", "n", "segment"])

    return texts.select("did", "th", "bytes", "seen").mapInArrow(
        _rows_together(stage), "h long, did long, th long, start int, before short, n long, segment binary")


def _rows_together(stage):
    """Join the small batches a stage yields into some of a few thousand rows."""
    def joined(batches):
        held, rows = [], 0
        for batch in stage(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= 8192:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def earlier_matches(group: np.ndarray, before: np.ndarray, lengths: np.ndarray, flat: np.ndarray, size: int, gram: int) -> np.ndarray:
    """Which strings of some segments start earlier too: a row for each segment, a column for each place before the anchor.

    Rows come in order of group and position; ``flat`` holds the segments' bytes one after another.
    """
    rows, lead = len(group), size - gram
    width = lead + size
    columns = np.zeros((width, rows), np.uint8)
    shift = lead - before.astype(np.int64)
    ends = np.cumsum(lengths)
    for a in range(0, rows, 8192):
        b = min(a + 8192, rows)
        table, first = np.zeros((b - a) * width, np.uint8), ends[a] - lengths[a]
        place = np.arange(ends[b - 1] - first) + np.repeat(np.arange(b - a) * width + shift[a:b] - (ends[a:b] - lengths[a:b] - first), lengths[a:b])
        table[place] = flat[first:ends[b - 1]]
        columns[:, a:b] = table.reshape(b - a, width).T
    order = np.arange(rows)
    groups = (group % 65536).astype(np.uint16)
    out = np.zeros((rows, lead + 1), bool)
    # Polynomial hash of the `size` bytes from column c on, carried from column to column.
    base, ahead, leaves = np.uint64(_BASE), np.zeros(rows, np.uint64), np.uint64(pow(_BASE, size, 1 << 64))
    for c in range(width - 1, -1, -1):
        ahead = ahead * base + _BYTES[columns[c]]
        if c + size < width:
            ahead -= leaves * _BYTES[columns[c + size]]
        order = order[np.argsort(columns[c][order], kind="stable")]  # suffixes from column c, by bytes
        if c > lead:
            continue
        suffix = order[np.argsort(groups[order], kind="stable")]
        valid = (shift <= c) & (c + size <= shift + lengths)
        prefix = mix(ahead) ^ valid
        now, same = prefix[suffix], groups[suffix]
        # Neighbours with a common prefix of `size` bytes form one run of the suffix order.
        run = np.cumsum(np.concatenate([[0], (now[1:] != now[:-1]) | (same[1:] != same[:-1])]))
        down, up = suffix - run * rows, suffix + (run - run[-1]) * rows
        previous_smaller = np.minimum.accumulate(down) < down
        next_smaller = np.minimum.accumulate(up[::-1])[::-1] < up
        out[suffix, c] = previous_smaller | next_smaller
        out[:, c] &= valid
    return out


def _spans(found: np.ndarray, first: np.ndarray, size: int):
    """Row, begin and end of the bytes covered by runs of neighbouring strings."""
    edge = np.zeros((len(found), found.shape[1] + 2), np.int8)
    edge[:, 1:-1] = found
    step = np.diff(edge, axis=1)
    row, begin = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    return row, first[row] + begin, first[row] + end - 1 + size


def repeats_in_groups(segments: DataFrame, size: int, gram: int) -> DataFrame:
    """``did, th, begin, end``: covered bytes, from segments grouped by anchor and sorted by position."""
    names = ["did", "th", "begin", "end"]

    def judge(table: pa.Table) -> pa.RecordBatch:
        h, did, th, start, before = (table.column(i).to_numpy() for i in range(5))
        new = np.ones(len(h), bool)  # the same place twice is one segment
        new[1:] = (h[1:] != h[:-1]) | (did[1:] != did[:-1]) | (th[1:] != th[:-1]) | (start[1:] != start[:-1])
        if not new.all():
            table = table.filter(pa.array(new))
            h, did, th, start, before = (table.column(i).to_numpy() for i in range(5))
        bytes_of = table.column(6).combine_chunks()
        parts = list(slices(bytes_of, 1 << 40))
        flat, offsets = (parts[0][2], parts[0][3]) if parts else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        found = earlier_matches(group, before, np.diff(offsets), flat, size, gram)
        row, begin, end = _spans(found, start + before.astype(np.int64) - (size - gram), size)
        return pa.RecordBatch.from_arrays([pa.array(did[row]), pa.array(th[row]), pa.array(begin), pa.array(end)], names=names)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < _BATCH_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column(0).to_numpy()
            cut = int(np.searchsorted(h, h[-1], "left"))  # the last group may go on
            if cut:
                yield judge(table.slice(0, cut))
            rest = table.slice(cut).to_batches()
            held, rows = rest, table.num_rows - cut if cut else 0
        if held:
            yield judge(pa.Table.from_batches(held).combine_chunks())

    placed = segments.repartition("h").sortWithinPartitions("h", "did", "th", "start")
    return placed.mapInArrow(stage, "did long, th long, begin long, `end` long")


def repeats_by_hash(segments: DataFrame, size: int, stages: Stages) -> DataFrame:
    """The same for anchors with very many segments: the smallest position of each string is an aggregate."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(6)):
                sums = running(data)
                starts = np.concatenate([np.arange(a, b - size + 1) for a, b in zip(offsets[:-1], offsets[1:])] or [np.zeros(0, np.int64)])
                of = np.searchsorted(offsets, starts, "right") - 1
                one = mix((sums[starts + size] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts])
                half = size // 2
                two = mix((sums[starts + half] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts])
                picked = pa.array(row + of)
                begin = batch.column(3).to_numpy()[row + of] + (starts - offsets[of])
                yield pa.RecordBatch.from_arrays([pa.array(signed(one)), pa.array(signed(two)), batch.column(1).take(picked), batch.column(2).take(picked),
                                                  pa.array(begin)], names=["one", "two", "did", "th", "begin"])

    every = stages.write(segments.mapInArrow(strings, "one long, two long, did long, th long, begin long"), "strings")
    first = every.groupBy("one", "two").agg(F.min(F.struct("did", "th", "begin")).alias("first"))
    later = every.join(first, ["one", "two"]).where(F.struct("did", "th", "begin") > F.col("first"))
    return later.select("did", "th", "begin", (F.col("begin") + size).alias("end"))


def remove_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_text`` for every row of ``docs(doc_id, text)``.

    A byte goes when a string of ``size`` bytes over it also starts earlier, in a document with a smaller id or
    before in its own; strings are judged on the input.  ``spans`` are the removed runs of bytes, end exclusive;
    ``kept_text`` the remaining bytes.
    Defined cases: null and empty texts have no bytes; texts shorter than ``size`` stay whole; null ids come first; documents with
    equal ids come in order of their text hash, and rows repeated in full are one document with equal results; texts of
    any length are read whole; an empty table gives no rows; other columns are not read.
    """
    stages = Stages(docs.sparkSession, "repeats")
    keys = ["did", "th"]
    seen = stages.write(repeated_anchors(anchor_rows(docs, size, gram)), "seen")
    key = F.xxhash64(*keys).alias("key")
    texts = passing(docs, bit_filter(seen.select(key), "key"))

    def segments(of: DataFrame, anchors_of) -> DataFrame:
        some = seen.withColumn("seen", F.filter("seen", anchors_of)).where("size(seen) > 0")
        return cut_segments(of.join(some, keys), size)

    found = repeats_in_groups(segments(texts, lambda s: s["n"] <= group), size, gram)
    many = seen.where(F.exists("seen", lambda s: s["n"] > group))
    if many.limit(1).count():
        few = passing(docs, bit_filter(many.select(key), "key"))
        found = found.union(repeats_by_hash(segments(few, lambda s: s["n"] > group), size, stages))
    spans = stages.write(found.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("found")), "spans")
    stages.drop("seen", "strings")
    wanted = bit_filter(spans.select(key), "key")
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(ids, texts, found) -> Iterator[pa.RecordBatch]:
        """Result rows in batches of about a megabyte of text."""
        rows, first, held = [], 0, 0
        for row in range(len(texts)):
            text, merged = texts[row].as_py(), []
            for s in (found[row].as_py() or ()) if found is not None else ():
                if merged and s["begin"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                else:
                    merged.append(dict(s))
            bounds = [0, *(x for s in merged for x in (s["begin"], s["end"])), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2])) if merged else text
            rows.append((len(text), sum(s["end"] - s["begin"] for s in merged), merged, kept))
            held += len(text)
            if held >= 1 << 20 or row + 1 == len(texts):
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(rows)), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), span, pa.binary())))],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept_text"])
                rows, first, held = [], row + 1, 0

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = pa.array(~passes(wanted, batch.column(1).to_numpy().view(np.uint64)))
            yield from cut(batch.column(0).filter(clean), batch.column(2).filter(clean), None)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from cut(*batch.columns)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<begin:long,`end`:long>>, kept_text binary"
    keyed = docs.select(*row_keys(), "doc_id", "text").select("doc_id", key, text_bytes().alias("bytes"))
    # Texts that cannot have spans are not exchanged.
    rest = passing(docs, wanted, "doc_id").join(spans, keys, "left").select("doc_id", "bytes", "found")
    return rest.mapInArrow(touched, schema).union(keyed.mapInArrow(untouched, schema))
