"""Language of spans: script ranges, scores of words, Viterbi with a switching penalty.

A word is a run of letters.  Its score in a language is the sum of the log shares of its
character trigrams there, counted over all learning documents.  Languages that hardly use a word's
script are not candidates.  The best path pays a penalty at each change of language.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 15
SLICE_CHARS = 1 << 20
#: First code points of script ranges; a letter belongs to the last range that starts at or below it.
SCRIPT_STARTS = {
    0x0: "latin", 0x370: "greek", 0x400: "cyrillic", 0x530: "armenian", 0x590: "hebrew", 0x600: "arabic", 0x900: "indic",
    0xE00: "thai", 0xE80: "lao", 0x1000: "burmese", 0x10A0: "georgian", 0x1100: "hangul", 0x1200: "ethiopic", 0x1780: "khmer",
    0x1E00: "latin", 0x1F00: "greek", 0x2C00: "other", 0x3040: "kana", 0x3100: "other", 0x3400: "han", 0xA000: "other",
    0xAC00: "hangul", 0xD7B0: "other", 0xF900: "han", 0xFB00: "latin", 0xFB1D: "hebrew", 0xFB50: "arabic", 0xFF21: "latin",
    0xFF66: "kana", 0x10000: "other", 0x20000: "han",
}
SCRIPTS = tuple(dict.fromkeys(SCRIPT_STARTS.values()))
#: A language is a candidate for a script that has at least this share of its words.
CANDIDATE_SHARE = 0.01
PENALTY = 20.0
_EXCLUDED = 60.0


_TABLES: list[np.ndarray] = []


def _letters() -> list[np.ndarray]:
    """Lower-case code point of every letter, 0 for anything else; script of every code point."""
    if _TABLES:
        return _TABLES
    lower = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            lower[c] = ord(low) if len(low) == 1 else c
    starts = np.array(list(SCRIPT_STARTS))
    of_range = np.array([SCRIPTS.index(s) for s in SCRIPT_STARTS.values()], np.uint8)
    _TABLES.extend([lower, of_range[np.searchsorted(starts, np.arange(0x110000), "right") - 1]])
    return _TABLES


class LetterWords:
    """Words of some texts: code points ``start``/``end`` within the text, ``doc``, ``script``, trigram ``buckets`` by letter."""

    def __init__(self, texts: list[str]):
        lower, scripts = _letters()
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        low = lower[points]
        before, after = np.zeros_like(low), np.zeros_like(low)
        before[1:], after[:-1] = low[:-1], low[1:]
        at = np.flatnonzero(low)
        gram = low[at].astype(np.uint64) + before[at].astype(np.uint64) * np.uint64(0x9E3779B1) + after[at].astype(np.uint64) * np.uint64(0x85EBCA77C2B2AE63)
        gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.buckets = (gram >> np.uint64(49)).astype(np.int64)
        begins = before[at] == 0
        self.first = np.flatnonzero(begins)  # of each word's letters
        self.letters = np.diff(np.append(self.first, len(at)))
        start = at[begins]
        self.doc = np.searchsorted(first, start, "right") - 1
        self.start = start - first[self.doc]
        self.end = self.start + self.letters
        self.script = scripts[points[start]]
        self.n_docs = len(texts)


def _text_groups(texts: list[str | None]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(text or "")
        if size >= SLICE_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


class LanguageModel:
    """Log shares of trigram buckets (languages by buckets) and the scripts each language uses."""

    @classmethod
    def of_parts(cls, parts: tuple) -> LanguageModel:
        """The model again from its ``parts``, which are plain arrays that a worker can read without this package."""
        model = cls.__new__(cls)
        model.languages, model.table, model.ruled_out = parts
        return model

    @property
    def parts(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        return self.languages, self.table, self.ruled_out

    def __init__(self, languages: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        total = grams.sum(1, keepdims=True)
        self.table = np.log((grams + 0.5) / (total + 0.5 * BUCKETS)).T.astype(np.float32).copy()
        used = scripts >= CANDIDATE_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
        used[:, ~used.any(0)] = True  # nobody's script: no language is ruled out
        self.ruled_out = np.where(used, 0.0, _EXCLUDED).T.copy()

    def word_scores(self, words: LetterWords) -> np.ndarray:
        scores = np.add.reduceat(self.table[words.buckets], words.first, axis=0).astype(float)
        return scores - self.ruled_out[words.script]


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi path of one text (words by languages); ties keep the language, then the first."""
    n, k = scores.shape
    back, value = np.empty((n, k), np.int32), scores[0].tolist()
    stay = np.arange(k, dtype=np.int32)
    for i, row in enumerate(scores[1:].tolist(), 1):
        top = max(value)
        best = value.index(top)
        change = top - penalty
        back[i] = stay
        for j in range(k):
            if value[j] < change:
                back[i, j] = best
                value[j] = change + row[j]
            else:
                value[j] += row[j]
    path = np.empty(n, np.int64)
    path[-1] = value.index(max(value))
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def label_words(scores: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Language of every word and total score of every text in each language.

    A text keeps one language when no stretch of words gains half the penalty by another: ``k`` stretches of
    others cost at least ``k - 1`` changes, and a single one beside the best language one.  Only other texts need the full search.
    """
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    row = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    part = np.add.reduceat(scores, first, axis=0)
    totals = np.zeros((n_docs, scores.shape[1]))
    totals[doc[first]] = part
    best = part.argmax(1)
    path = best[row]
    gain = scores - np.take_along_axis(scores, path[:, None], 1)
    sums = np.cumsum(gain, axis=0)
    sums -= (sums[first] - gain[first])[row]
    apart = row[:, None] * 1e9  # starts the running minimum anew in each text
    rise = sums - apart - np.minimum.accumulate(sums - gain - apart, axis=0)
    for d in np.flatnonzero(np.maximum.reduceat(rise.max(1), first) >= penalty / 2):
        stop = first[d + 1] if d + 1 < len(first) else len(doc)
        path[first[d]:stop] = best_path(scores[first[d]:stop], penalty)
    return path, totals


def fit_languages(docs: DataFrame) -> LanguageModel:
    """Model from all rows of ``docs(text, lang)`` with neither null.

    Each task sums its own counts, at most ``BUCKETS`` and the scripts for each language, before the shuffle; what reaches
    the driver is bounded by languages times ``BUCKETS``.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts, at = batch.column(1).to_pylist(), batch.column(0).to_pylist(), 0
            for group in _text_groups(texts):
                words = LetterWords(group)
                names, of_doc = np.unique(langs[at:at + len(group)], return_inverse=True)
                at += len(group)
                for i, name in enumerate(names):
                    have = sums.setdefault(str(name), np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                    chosen = of_doc[words.doc] == i
                    have[:BUCKETS] += np.bincount(words.buckets[np.repeat(chosen, words.letters)], minlength=BUCKETS)
                    have[BUCKETS:] += np.bincount(words.script[chosen], minlength=len(SCRIPTS))
        for name, have in sums.items():
            used = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(have[used])],
                                             names=["lang", "bucket", "n"])

    rows = (docs.where("text is not null and lang is not null").select(F.make_valid_utf8("text"), F.make_valid_utf8("lang"))
            .mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    if languages:
        at = {name: i for i, name in enumerate(languages)}
        counts[[at[x] for x in rows.column("lang").to_pylist()], rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return LanguageModel(languages, counts[:, :BUCKETS], counts[:, BUCKETS:])


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",), penalty: float = PENALTY) -> DataFrame:
    """The ``keep`` columns, ``lang_pred``, ``lang_score`` and ``lang_spans`` of every row of ``docs``.

    Spans are code points, end exclusive, from the first word of a language to its last before a change.  The
    text's language is the one with most letters (ties: first by name); its score is its share of the letters times
    its posterior among the languages over the whole text.
    Defined cases: a null text, one without letters, or a model without languages gives ``und``, score 0 and no spans;
    texts of any length are read whole; bytes that are not UTF-8 count as U+FFFD, which is no letter; repeated rows are judged row by row;
    other columns are not read.
    """
    added = "lang_pred string, lang_score double, lang_spans array<struct<lang:string,start:int,`end`:int>>"
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL(added)])
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    shared = docs.sparkSession.sparkContext.broadcast(model.parts)  # size: languages times BUCKETS

    def judged(texts: list[str], found: LanguageModel):
        names = found.languages
        out = [("und", 0.0, []) for _ in texts]
        words = LetterWords(texts)
        if not names or not len(words.doc):
            return out
        scores = found.word_scores(words)
        path, totals = label_words(scores, words.doc, len(texts), penalty)
        letters = np.bincount(words.doc * len(names) + path, weights=words.letters, minlength=len(texts) * len(names)).reshape(len(texts), -1)
        top = letters.argmax(1)
        new = np.flatnonzero(np.concatenate([[True], (words.doc[1:] != words.doc[:-1]) | (path[1:] != path[:-1])]))
        last = np.append(new[1:], len(path)) - 1
        spans: dict[int, list] = {}
        for s, e in zip(new, last):
            spans.setdefault(int(words.doc[s]), []).append(
                {"lang": names[path[s]], "start": int(words.start[s]), "end": int(words.end[e])})
        for d, found_spans in spans.items():
            of_all = totals[d] - totals[d].max()
            posterior = math.exp(of_all[top[d]]) / float(np.exp(of_all).sum())
            out[d] = (names[top[d]], float(letters[d, top[d]] / letters[d].sum() * posterior), found_spans)
        return out

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = LanguageModel.of_parts(shared.value)
        for batch in batches:
            rows = [r for group in _text_groups(batch.column(batch.num_columns - 1).to_pylist()) for r in judged(group, found)]
            columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[f.name for f in schema])

    return docs.select(*keep, F.make_valid_utf8("text").alias("__text")).mapInArrow(stage, schema)


def identify_languages(docs: DataFrame, learn: Column | None = None, keep: tuple[str, ...] = ("doc_id",), penalty: float = PENALTY) -> DataFrame:
    """:func:`identify` by a model from the rows of ``docs`` that meet ``learn`` and have a ``lang``."""
    return identify(docs, fit_languages(docs.where(learn) if learn is not None else docs), keep, penalty)
