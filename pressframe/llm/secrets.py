"""Secret scan: keyword prefilter, anchored patterns at the hits, checksums.

One Aho-Corasick pass over each text finds keywords; a pattern is only tried where one of its
keywords starts.  Runs of hex digits have no keyword and come from run lengths.  Formats that carry
their own proof (GitHub and npm tokens a CRC-32, JSON web tokens a decodable header, private
keys a decodable body) are reported only when it holds.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import sys
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .bytewords import Words, slices
from .common import small_batches, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPANS = "array<struct<kind:string,start:int,`end`:int>>"
#: Kinds in reporting order.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_token(match: re.Match) -> bool:
    """The last six of the 36 characters are the CRC-32 of the others in base 62."""
    body, check = match[1][:-6], match[1][-6:]
    number, digits = zlib.crc32(body), bytearray()
    for _ in range(6):
        number, digit = divmod(number, 62)
        digits.append(BASE62[digit])
    return bytes(reversed(digits)) == check


def _decoded(part: bytes, url: bool = False) -> bytes | None:
    try:
        return base64.b64decode(part + b"=" * (-len(part) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _web_token(match: re.Match) -> bool:
    try:
        return "alg" in json.loads(_decoded(match[1], url=True) or b"")
    except (ValueError, TypeError, RecursionError):  # no JSON, no object, or nested deeper than anybody writes
        return False


def _private_key(match: re.Match) -> bool:
    return bool(_decoded(re.sub(rb"\s", b"", match[2])))


#: kind -> keywords, pattern anchored at a keyword, test of a match.
DETECTORS = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"),
               rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8),
    "access": (("akia",), rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", _crc_token),
    "npm": (("npm_",), rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", _crc_token),
    "jwt": (("eyj",), rb"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", _web_token),
    "pem": (("-----begin ",), rb"-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----", _private_key),
}
#: What a pattern reads first, from any keyword in it to its end: if pattern or proof fails at one keyword, the others of that run are passed over.
RUNS = {"jwt": rb"[A-Za-z0-9_-]+"}
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _Scanner:
    def __init__(self, kinds: Sequence[str]):
        import ahocorasick

        self.trie, self.hex = ahocorasick.Automaton(), "hex" in kinds
        self.patterns = {k: (re.compile(DETECTORS[k][1]), DETECTORS[k][2]) for k in kinds if k in DETECTORS}
        self.runs = {k: re.compile(RUNS[k]) for k in kinds if k in RUNS}
        for kind in self.patterns:
            for word in DETECTORS[kind][0]:
                self.trie.add_word(word, (kind, len(word)))
        if len(self.trie):
            self.trie.make_automaton()
        self.digits = np.zeros(256, bool)
        self.digits[48:58] = self.digits[97:103] = True

    def keyword_spans(self, text: bytes) -> list[tuple[str, int, int]]:
        """Byte spans of the keyword kinds, leftmost and non-overlapping within each kind."""
        spans, over = [], dict.fromkeys(self.patterns, 0)
        if not len(self.trie):
            return spans
        hits = sorted((end - n + 1, kind) for end, (kind, n) in self.trie.iter(text.translate(_LOWER).decode("latin-1")))
        for start, kind in hits:
            if start < over[kind]:
                continue
            pattern, holds = self.patterns[kind]
            match = pattern.match(text, start)
            proved = match is not None and holds(match)
            if proved:
                spans.append((kind, start, match.end()))
            if kind in self.runs and not proved:
                over[kind] = self.runs[kind].match(text, start).end()
            elif match:
                over[kind] = match.end()
        return spans

    def scan(self, column) -> Iterator[tuple[bytes, list[tuple[str, int, int]]]]:
        """Each text with its spans in code points, by start and then kind."""
        for first, end, data, offsets in slices(column):
            runs: dict[int, list[tuple[str, int, int]]] = {}
            if self.hex:
                found = Words(data, offsets, self.digits, lower=False, hashed=False)
                for i in np.flatnonzero(found.end - found.start >= 32):
                    at = offsets[found.doc[i]]
                    runs.setdefault(int(found.doc[i]), []).append(("hex", int(found.start[i] - at), int(found.end[i] - at)))
            whole = data.tobytes()
            for row in range(end - first):
                text = whole[offsets[row]:offsets[row + 1]]
                spans = self.keyword_spans(text) + runs.get(row, [])
                if spans and not text.isascii():
                    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                    spans = [(k, int(points[s]), int(points[e])) for k, s, e in spans]
                yield text, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _redacted(text: bytes, spans: list[tuple[str, int, int]]) -> str:
    text, out, at = text.decode("utf-8", "replace"), [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, keep: Sequence[str] = ("doc_id",), kinds: Sequence[str] = KINDS, redact: bool = False) -> DataFrame:
    """The columns in ``keep`` and ``secret_spans``, one row for each row of ``docs``.

    Spans are code points of ``text``, end exclusive, in order of start and then kind.  With ``redact``
    also ``redacted_text``: every span (overlapping ones as one) replaced by the name of its first kind in brackets;
    null where no span was found, so clean texts are not copied.
    Defined cases: a null or empty text has no spans; any length is scanned whole; repeated rows
    are scanned row by row; an empty table gives no rows; other columns are not read.  Bytes that are not UTF-8 belong to no secret
    and come back as U+FFFD where a text is redacted; the time of a text grows with its length, whatever it repeats.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(*[F.col(c) for c in keep], text_bytes().alias("__bytes"))
    added = f"secret_spans {SPANS}" + ", redacted_text string" * redact
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL(added)])
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(kinds)
        for batch in batches:
            spans, texts = [], []
            for text, found in scanner.scan(batch.column(batch.num_columns - 1)):
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                if redact:
                    texts.append(_redacted(text, found) if found else None)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(spans, kind_type)]
            if redact:
                columns.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return chosen.mapInArrow(stage, schema)
