"""Quality scores by Bradley-Terry pairwise ranking.

Documents are described by shares and lengths of their whole text.  Pairs of a preferred and a
rejected labelled document give the logistic loss of ``w . (x_preferred - x_rejected)``; its
minimum makes ``w . x`` a score, and a quantile of the labelled scores the threshold.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .bytewords import Words, not_space, slices
from .common import Stages, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = (
    "log_words", "log_bytes", "word_length", "word_length_spread", "upper", "digits", "symbols", "loud", "non_ascii",
    "repeated_next", "distinct_words", "top_word", "symbol_ends", "log_line_length", "repeated_lines", "repeated_runs",
    "wordless", "stops", "long_words", "upper_words",
)
THRESHOLD = 0.3


def _classes() -> dict[str, np.ndarray]:
    table = {name: np.zeros(256, bool) for name in ("upper", "lower", "digit", "symbol", "loud", "high", "stop")}
    table["upper"][65:91] = table["lower"][97:123] = table["digit"][48:58] = table["high"][128:] = True
    table["symbol"][[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]"]] = True
    table["loud"][[ord("!"), ord("?")]] = True
    table["stop"][[ord(c) for c in ".!?"]] = True
    return table


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and count of the most frequent one, for each document."""
    if not len(doc):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])]))
    sizes, top = np.diff(np.append(new, len(d))), np.zeros(n)
    np.maximum.at(top, d[new], sizes)
    return np.bincount(d[new], minlength=n).astype(float), top


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text of a slice; a text without words gives zeros."""
    n, table = len(offsets) - 1, _classes()
    w = Words(data, offsets, not_space(), lower=False)
    size = np.diff(offsets).astype(float)
    words = w.counts.astype(float)

    def per(value, total):
        return np.divide(value, total, out=np.zeros(n), where=total > 0)

    def count(mask):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    def by_word(value):
        return np.bincount(w.doc, weights=value, minlength=n)

    length = (w.end - w.start).astype(float)
    mean = per(by_word(length), words)
    spread = np.sqrt(np.maximum(per(by_word(length ** 2), words) - mean ** 2, 0))
    upper, lower = table["upper"][data], table["lower"][data]
    letters = count(upper) + count(lower)
    distinct, top = _distinct(w.doc, w.hash, n)
    same = np.zeros(len(w.doc))
    if len(same) > 1:
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    at, runs = w.shingles(5)
    n_runs = np.bincount(w.doc[at], minlength=n).astype(float)
    distinct_runs, _ = _distinct(w.doc[at], runs, n)
    newline = np.ones(256, bool)
    newline[10] = False
    lines = Words(data, offsets, newline, lower=False)
    n_lines = lines.counts.astype(float)
    distinct_lines, _ = _distinct(lines.doc, lines.hash, n)
    last = w.end - 1
    word_sums = {k: np.concatenate([[0], np.cumsum(m)]) for k, m in
                 (("letter", upper | lower | table["high"][data]), ("upper", upper), ("lower", lower))}
    inside = {k: s[w.end] - s[w.start] for k, s in word_sums.items()}
    rows = np.column_stack([
        np.log1p(words), np.log1p(size), mean, spread, per(count(upper), letters), per(count(table["digit"][data]), size),
        per(count(table["symbol"][data]), size), per(count(table["loud"][data]), size), per(count(table["high"][data]), size),
        per(by_word(same), words), per(distinct, words), per(top, words), per(by_word(table["symbol"][data[last]]), words),
        np.log1p(per(size, n_lines)), 1 - per(distinct_lines, n_lines), 1 - per(distinct_runs, n_runs),
        per(by_word(inside["letter"] == 0), words), per(by_word(table["stop"][data[last]]), words), per(by_word(length > 20), words),
        per(by_word((inside["upper"] > 1) & (inside["lower"] == 0)), words)])
    rows[:, 14] *= n_lines > 0
    rows[:, 15] *= n_runs > 0
    rows[words == 0] = 0
    return rows.astype(np.float32)


def with_features(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``features``, from one pass over the whole texts."""
    chosen = docs.select(*keep, text_bytes().alias("__bytes"))
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [text_features(d, o) for _, _, d, o in slices(batch.column(batch.num_columns - 1))]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0, np.float32)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            rows = pa.ListArray.from_arrays(ends, pa.array(flat, pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], rows], names=[*keep, "features"])

    return chosen.mapInArrow(stage, f"{fields}, features array<float>")


def pair_up(preferred: np.ndarray, rejected: np.ndarray, rounds: int, seed: int = 11) -> np.ndarray:
    """Differences of preferred and rejected rows.  Every document takes part, ``rounds`` times or more; partners come from fixed permutations."""
    if not len(preferred) or not len(rejected):
        return np.zeros((0, len(FEATURES)))
    rng, longest = np.random.default_rng(seed), max(len(preferred), len(rejected))
    sides = [np.concatenate([np.resize(rng.permutation(len(x)), longest) for _ in range(rounds)]) for x in (preferred, rejected)]
    found = preferred[sides[0]]
    found -= rejected[sides[1]]
    return found


def pair_rows(known: DataFrame, counts: dict[int, int], spread: np.ndarray, slice_docs: int, pairs: int) -> DataFrame:
    """``x``: feature differences, in units of ``spread``, of pairs in which every row of ``known(doc_id, features, good)`` takes part.

    Documents are dealt by a hash of the id over slices of about ``slice_docs`` of the more frequent class.  Those of the other class form as many
    groups of that size, or fewer, which slices take in turn; so what a task holds has a fixed bound.
    """
    most = int(counts[1] >= counts[0])
    slices_, groups = -(-counts[most] // slice_docs), -(-counts[1 - most] // slice_docs)
    rounds = max(1, -(-pairs // counts[most]))
    dealt = [F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(n)) for n in (slices_, groups)]
    of = F.when(F.col("good") == bool(most), F.array(dealt[0])).otherwise(F.sequence(dealt[1], F.lit(slices_ - 1).cast("long"), F.lit(groups).cast("long")))

    def pair(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        x = table.column("features").combine_chunks().flatten().to_numpy().astype(float).reshape(-1, len(FEATURES)) / spread
        good = table.column("good").to_numpy()
        found = pair_up(x[good], x[~good], rounds, 11 + table.column("slice")[0].as_py())
        ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
        return pa.table({"x": pa.ListArray.from_arrays(ends, pa.array(found.ravel()))})

    return known.select("doc_id", "features", "good", F.explode(of).alias("slice")).groupBy("slice").applyInArrow(pair, "x array<double>")


def fit_pairs(pairs: DataFrame, ridge: float = 1e-3) -> np.ndarray:
    """Weights with the least mean logistic loss on the differences ``x``, by Newton's method: a pass over the pairs for each step, of which
    only sums reach the driver."""
    n = len(FEATURES)
    w = np.zeros(n)
    for _ in range(50):
        def sums(batches: Iterator[pa.RecordBatch], w=w) -> Iterator[pa.RecordBatch]:
            total = np.zeros(n + n * n + 1)
            for batch in batches:
                x = batch.column(0).flatten().to_numpy().reshape(-1, n)
                p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
                total += np.concatenate([x.T @ (p - 1), ((x * (p * (1 - p))[:, None]).T @ x).ravel(), [len(x)]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

        total = np.array([r.value for r in pairs.mapInArrow(sums, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()])
        slope = total[:n] / total[-1] + ridge * w
        curve = total[n:-1].reshape(n, n) / total[-1] + ridge * np.eye(n)
        move = np.linalg.solve(curve, slope)
        w = w - move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return w


def middle_after(rows: DataFrame, place: int, bins: int = 1024) -> float:
    """The middle between the ``place``-th smallest ``raw``, counted from 1, and the one after it, exactly.

    Each pass counts the values of the stretch that holds the place in ``bins`` parts and goes on with one of them.
    """
    low, high = rows.agg(F.min("raw"), F.max("raw")).first()
    before = 0
    while low < high:
        part = F.least(F.floor((F.col("raw") - low) / (high - low) * bins), F.lit(bins - 1))
        found = (rows.where(F.col("raw").between(low, high)).groupBy(part.alias("part"))
                 .agg(F.count("*").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("part").collect())
        for r in found:
            if before + r.n >= place:
                low, high = r.low, r.high
                break
            before += r.n
    up_to, after = rows.agg(F.count_if(F.col("raw") <= low), F.min(F.when(F.col("raw") > low, F.col("raw")))).first()
    return low if up_to > place or after is None else (low + after) / 2


def fit_quality(rows: DataFrame, labels: DataFrame, stages: Stages, learn: Column | None = None,
                slice_docs: int = 10_000, pairs: int = 60_000) -> Column:
    """Score of a ``features`` column, learned from ``rows(doc_id, features)`` and ``labels(doc_id, quality)``.

    ``learn`` is a condition on ``doc_id`` that labelled rows must meet.  All labelled documents take part in the pairs (see
    :func:`pair_rows`; some ``pairs`` in all, or one for each document of the more frequent class) and in the threshold.  It is the quantile
    of their scores at the share of rejected labels, mapped to 0.3.  With labels of one class, or none, every score is 0.5.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(learn) if learn is not None else known
    known = rows.dropDuplicates(["doc_id"]).select("doc_id", "features").join(known, "doc_id")
    known = stages.write(known.select("doc_id", "features", (F.col("quality") > 0).alias("good")), "labelled")
    counts = {0: 0, 1: 0} | {int(r[0]): r[1] for r in known.groupBy("good").count().collect()}
    if not counts[0] or not counts[1]:
        stages.drop("labelled")
        return F.lit(0.5)
    each = [F.col("features")[i].cast("double") for i in range(len(FEATURES))]
    spread = np.maximum(np.array(known.agg(*[F.stddev_pop(c) for c in each]).first(), float), 1e-6)
    a = fit_pairs(stages.write(pair_rows(known, counts, spread, slice_docs, pairs), "pairs")) / spread
    raw = F.lit(0.0)
    for c, slope in zip(each, a):
        raw = raw + c * float(slope)
    threshold = middle_after(stages.write(known.select(raw.alias("raw")), "raw"), counts[0])
    stages.drop("labelled", "pairs", "raw")
    return 1 / (1 + F.exp(-(raw - threshold + float(np.log(THRESHOLD / (1 - THRESHOLD))))))


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, slice_docs: int = 10_000, pairs: int = 60_000) -> DataFrame:
    """``doc_id`` and ``quality_score`` (0 to 1) of every row of ``docs(doc_id, text)``; good from 0.3 on.

    See :func:`fit_quality` for the learning.  Defined cases: null and empty texts have features of zero and get a score like
    any other; repeated rows get equal scores; labels with nulls do not count and contradicting ones count as rejected; an
    empty table gives no rows; other columns are not read.
    """
    stages = Stages(docs.sparkSession, "quality")
    rows = stages.write(with_features(docs, "doc_id"), "features")
    return rows.select("doc_id", fit_quality(rows, labels, stages, learn, slice_docs, pairs).alias("quality_score"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold; texts are read twice and never exchanged."""
    stages = Stages(docs.sparkSession, "quality")
    rows = stages.write(with_features(docs, "doc_id"), "features")
    score = fit_quality(rows, labels, stages)
    stages.drop("features")
    scored = with_features(docs.select(F.struct(*docs.columns).alias("row"), "text"), "row")
    return scored.where(score >= threshold).select("row.*")
