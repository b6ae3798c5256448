"""Merkle fingerprints of texts.

A text is cut by its content alone: runs of a few words are leaves, lines are paragraphs, runs of
paragraphs are sections.  A parent's digest is the hash of its children's, so equal roots mean equal
texts, and two trees are compared from the top down where digests differ.  The fingerprint is the
root and the short leaf digests in their sections and paragraphs:
``root.leaf leaf/leaf|leaf`` with four characters for each leaf, ``/`` between paragraphs and ``|`` between sections.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .bytewords import Words, _powers, mix, not_space, span_hashes
from .common import text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A leaf ends after a word whose hash has these bits 0 (one in four), a section after such a paragraph.
LEAF_MASK, SECTION_MASK = 3, 3
_SECOND = np.random.default_rng(77).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE2 = 2862933555777941757
_INVERSE2 = pow(_BASE2, -1, 1 << 64)
_GROUP_BYTES = 1 << 20


def _leaves(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, 128-bit digest (two columns) of the leaves of some texts; leaves cover every byte."""
    words = Words(data, offsets, not_space(), lower=False)
    newline = np.flatnonzero(data == 10) + 1
    cut = words.end[(words.hash & np.uint64(LEAF_MASK)) == 0]
    ends = np.unique(np.concatenate([cut, newline, offsets[1:]]))
    ends = ends[ends > 0]
    starts = np.concatenate([[0], ends[:-1]])
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_SECOND[data] * _powers(_BASE2, len(data)), dtype=np.uint64, out=sums[1:])
    second = mix((sums[ends] - sums[starts]) * _powers(_INVERSE2, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, span_hashes(data, starts, ends), second


def _digest(parts: list[bytes]) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def fingerprints(texts: list[bytes]) -> list[str]:
    out = []
    for first in _groups(texts):
        group = texts[first]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in group])]).astype(np.int64)
        data = np.frombuffer(b"".join(group), np.uint8)
        starts, ends, one, two = _leaves(data, offsets)
        raw = np.column_stack([one, two]).astype("<u8").tobytes()
        codes = base64.urlsafe_b64encode(np.ascontiguousarray(one.view(np.uint8).reshape(-1, 8)[:, :3]).tobytes()).decode()
        of_text = np.searchsorted(starts, offsets)
        closes = data[ends - 1] == 10 if len(ends) else np.zeros(0, bool)
        for i in range(len(group)):
            a, b = int(of_text[i]), int(of_text[i + 1])
            sections, names, paragraph, start = [], [], [], a
            texts_of_section: list[str] = []
            for stop in [*(np.flatnonzero(closes[a:b]) + a + 1).tolist(), b]:
                if stop == start:
                    continue
                digest = _digest([raw[16 * start:16 * stop]])
                paragraph.append(digest)
                texts_of_section.append(codes[4 * start:4 * stop])
                start = stop
                if digest[0] & SECTION_MASK == 0:
                    sections.append(_digest(paragraph))
                    names.append("/".join(texts_of_section))
                    paragraph, texts_of_section = [], []
            if paragraph:
                sections.append(_digest(paragraph))
                names.append("/".join(texts_of_section))
            out.append(f"{_digest(sections).hex()}.{'|'.join(names)}")
    return out


def _groups(texts: list[bytes]) -> Iterator[slice]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _GROUP_BYTES:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def _tree(fingerprint: str) -> tuple[str, list[list[list[str]]]]:
    root, _, body = fingerprint.partition(".")
    return root, [[[p[i:i + 4] for i in range(0, len(p), 4)] for p in s.split("/")] for s in body.split("|")] if body else []


def leaf_codes(fingerprint: str) -> np.ndarray:
    body = fingerprint.partition(".")[2].replace("/", "").replace("|", "")
    return np.sort(np.frombuffer(body.encode(), "<u4"))


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays with repeats."""
    both = np.concatenate([a, b])
    values, at = np.unique(both, return_inverse=True)
    return int(np.minimum(np.bincount(at[:len(a)], minlength=len(values)), np.bincount(at[len(a):], minlength=len(values))).sum())


def likeness(one: str, two: str, codes: tuple[np.ndarray, np.ndarray] | None = None) -> float:
    """1.0 for equal roots; else twice the common leaves over all leaves (repeats count)."""
    if one.partition(".")[0] == two.partition(".")[0]:
        return 1.0
    a, b = codes or (leaf_codes(one), leaf_codes(two))
    return 2.0 * _shared(a, b) / (len(a) + len(b)) if len(a) and len(b) else 0.0


def edits(one: str, two: str) -> list[tuple[int, int]]:
    """(section, paragraph) numbers of the first text whose branch has no equal in the second."""
    (root_one, tree_one), (root_two, tree_two) = _tree(one), _tree(two)
    if root_one == root_two:
        return []
    sections = Counter("/".join(map("".join, s)) for s in tree_two)
    paragraphs = Counter("".join(p) for s in tree_two for p in s)
    return [(i, j) for i, s in enumerate(tree_one) if not sections["/".join(map("".join, s))]
            for j, p in enumerate(s) if not paragraphs["".join(p)]]


def fingerprint_documents(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fingerprint`` of each whole text; null reads as empty, repeated rows get equal values."""
    chosen = docs.select(*keep, text_bytes().alias("__bytes"))
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], names=[*keep, "fingerprint"])

    return chosen.mapInArrow(stage, f"{fields}, fingerprint string")


def in_id_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """``part, guest, doc_id, bytes``: documents in ``ranges`` parts by id, highest part for the highest ids; sorted by id
    downwards in each part, followed by a guest row, the document that comes next after the part.

    After the last document of all comes the first.  Null ids come after all others, equal ids in order of their
    bytes.  Only the ids' quantiles and each part's first id reach the driver: numbers bounded by ``ranges``.
    """
    spark = docs.sparkSession
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 20 * ranges).alias("q")).first().q or []
    bounds = np.unique(np.array([x for x in found if x is not None], np.int64)) if shares else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def part_of(ids):
        values = ids.fillna(0).astype("int64").to_numpy()
        return ids.mask(ids.isna(), other=-1).where(ids.isna(), np.searchsorted(bounds, values, "right")).astype("int32")

    part = F.coalesce(part_of(F.col("doc_id").cast("long")), F.lit(0))
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(part + 1)
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("bytes")).withColumn("part", part)
    tops = sorted(placed.groupBy("part").agg(F.max("doc_id")).collect())
    if not tops:
        return placed.select("part", F.lit(0).alias("guest"), "doc_id", "bytes")
    # The first document of a part is the guest of the next higher part, and of the lowest if it is the first of all.
    host = {tops[i][0]: tops[(i + 1) % len(tops)][0] for i in range(len(tops))}
    top = F.create_map(*[F.lit(x) for p, t in tops for x in (p, t)])
    to = F.create_map(*[F.lit(x) for p, t in host.items() for x in (p, t)])
    first = F.col("doc_id").eqNullSafe(top[F.col("part")])
    rows = placed.withColumn("seat", F.explode(F.when(first, F.array(
        F.struct(F.col("part").alias("part"), F.lit(0).alias("guest")), F.struct(to[F.col("part")].alias("part"), F.lit(1).alias("guest")))).otherwise(
        F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))))))
    rows = rows.select("seat.part", "seat.guest", "doc_id", "bytes")
    return (rows.repartitionById(ranges + 1, F.col("part"))
            .sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "bytes"))


def compare_edited(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, which ends in the beginning of the next document.

    The edited text has its last third of code points (rounded down) replaced by as many (or all) from the start of the next
    document by descending id.  Columns ``doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next``.  Whole texts are exchanged once, by id range.
    Defined cases: null texts are empty; two empty texts are alike (1.0), an empty and another are not (0.0); a
    single document is its own next; rows with equal or null ids follow :func:`in_id_ranges`; an
    empty table gives no rows; other columns are not read.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ("doc_id long, n_chars long, edited_text binary, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def build(rows):
        """Rows of one part in order, the last one only as a successor."""
        texts = [r[3] for r in rows]
        points = [t.decode("utf-8", "replace") for t in texts]
        edited = []
        for one, following in zip(points, points[1:]):
            n = len(one) // 3
            edited.append((one[:len(one) - n] + following[:n]).encode())
        marks = fingerprints(texts)
        edited_marks = fingerprints(edited)
        codes, edited_codes = [leaf_codes(m) for m in marks], [leaf_codes(m) for m in edited_marks]
        own = range(len(rows) - 1)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in own], pa.int64()), pa.array([len(points[i]) for i in own], pa.int64()), pa.array(edited, pa.binary()),
            pa.array(marks[:-1], pa.string()), pa.array(edited_marks, pa.string()),
            pa.array([likeness(marks[i], edited_marks[i], (codes[i], edited_codes[i])) for i in own], pa.float64()),
            pa.array([likeness(marks[i], marks[i + 1], (codes[i], codes[i + 1])) for i in own], pa.float64())],
            names=["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, done = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                row = (*row[:3], row[3].as_py())
                if row[0] == done:  # further guests of a finished part
                    continue
                held.append(row)
                size += len(row[3])
                if row[1]:  # the guest ends its part
                    yield build(held)
                    held, size, done = [], 0, row[0]
                elif size >= 4 * _GROUP_BYTES and len(held) > 1:
                    yield build(held)
                    held, size = [row], len(row[3])

    return in_id_ranges(docs, ranges).mapInArrow(stage, schema)
