"""Secret scans.

An Aho-Corasick automaton over lower-cased bytes finds the keywords in one pass; a regular
expression is tried only where a keyword stands, anchored there, and token formats that
embed a checksum are validated by computing it. Lower-case hex keys have no keyword; their
maximal runs are found by a vectorised run-length pass over the bytes.

Kinds, in the order used for ties: ``assign``, ``access``, ``hex`` (base rules), then
``github`` and ``npm`` (36 base-62 characters of which the last six are the CRC32 of the
first thirty), ``jwt`` (three base64url parts whose first decodes to a JSON object with
``alg``) and ``pem`` (a private-key block from its BEGIN line to the END line, or the BEGIN line alone).

Cases: null text is scanned as empty; empty texts have no spans; texts are scanned whole,
whatever their length; repeated rows are scanned row by row; an empty table gives an empty
table; input columns named like an output column are replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import extended, slices, starts_code_point, texts_of

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_GITHUB = re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])")
_NPM = re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])")
_JWT = re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_PART = re.compile(rb"[A-Za-z0-9_-]*")
_PEM = re.compile(rb"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
_PEM_END = re.compile(rb"-----END ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt", "-----begin ": "pem",
}
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_automaton = None


def _scanner() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        _automaton = ahocorasick.Automaton()
        for word, kind in _KEYWORDS.items():
            _automaton.add_word(word, (len(word), kind))
        _automaton.make_automaton()
    return _automaton


def checksum_ok(body: bytes) -> bool:
    """Last six base-62 characters equal the CRC32 of the thirty before them."""
    crc, digits = binascii.crc32(body[:30]), bytearray()
    for _ in range(6):
        crc, d = divmod(crc, 62)
        digits.append(_BASE62[d])
    return bytes(reversed(digits)) == body[30:]


def _jwt_ok(head: bytes) -> bool:
    try:
        header = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(header, dict) and "alg" in header


def _try(kind: str, raw: bytes, at: int, ends: dict[bytes, list[int]]) -> tuple[int, bool]:
    """(where the next match of ``kind`` may start, whether the match anchored at ``at`` counts). Every byte is
    read a bounded number of times: where no match starts, what the expression has read is not read again."""
    if kind == "assign":
        m = _ASSIGN.match(raw, at)
        return (m.end(), len(m[2]) >= 6) if m else (at + 1, False)
    if kind == "access":
        m = _ACCESS.match(raw, at)
        return (m.end(), m.end() - at >= 20) if m else (at + 1, False)
    if kind == "jwt":
        m = _JWT.match(raw, at)
        # no token starts later in the same run of characters either: the run is followed by the same bytes
        return (m.end(), _jwt_ok(m[1])) if m else (_PART.match(raw, at).end(), False)
    if kind == "pem":
        m = _PEM.match(raw, at)
        if not m:
            return at + 1, False
        if None not in ends:
            ends[None] = []
            for e in _PEM_END.finditer(raw):
                ends.setdefault(e[1], []).append(e.start())
        own = ends.get(m[1], [])
        k = bisect_left(own, m.end())
        return (own[k] + len(m[1]) + 14 if k < len(own) else m.end()), True
    m = (_GITHUB if kind == "github" else _NPM).match(raw, at)
    return (m.end(), checksum_ok(m[1])) if m else (at + 1, False)


def hex_runs(raw: bytes, least: int = 24) -> list[tuple[int, int]]:
    """Maximal runs of lower-case hex digits of at least ``least`` bytes."""
    if len(raw) < least:
        return []
    inside = _HEX[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    long = (edges[1::2] - edges[::2]) >= least
    return list(zip(edges[::2][long].tolist(), edges[1::2][long].tolist()))


def byte_spans(raw: bytes) -> list[tuple[int, str, int]]:
    """(start, kind, end) in bytes, every kind leftmost and non-overlapping in itself."""
    found: list[tuple[int, str, int]] = []
    free = dict.fromkeys(KINDS, 0)
    ends: dict = {}
    # no keyword of a kind lies inside another of that kind, so hits come by start within each kind
    for last, (size, kind) in _scanner().iter(raw.lower().decode("latin-1")):
        at = last - size + 1
        if at < free[kind]:
            continue
        free[kind], counts = _try(kind, raw, at, ends)
        if counts:
            found.append((at, kind, free[kind]))
    found.extend((a, "hex", b) for a, b in hex_runs(raw))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind as listed in KINDS."""
    raw = text.encode("utf-8")
    found = byte_spans(raw)
    if not found or text.isascii():
        return [(k, a, b) for a, k, b in found]
    points = np.concatenate([[0], np.cumsum(starts_code_point(np.frombuffer(raw, np.uint8)))])
    return [(k, int(points[a]), int(points[b])) for a, k, b in found]


SPANS = T.StructField("secret_spans", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType())])))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans`` (array of kind, start, end; code points, end exclusive,
    ordered by start then kind). No shuffle; one pass over whole texts."""
    base, schema = extended(docs, [SPANS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for batch in slices(whole, text_col):
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scan_text(t)]
                         for t in texts_of(batch, text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)],
                                                 [*batch.schema.names, "secret_spans"])

    return base.mapInArrow(run, schema)


def digest(spans) -> F.Column:
    """'kind:start:end' of an array of spans, comma-joined in its order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mask`` (overlapping spans merged into one);
    clean texts stay as they are, null stays null."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                at = batch.schema.get_field_index(text_col)
                out = [None if t is None else redact_text(t, mask) for t in batch.column(at).to_pylist()]
                yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(run, schema)


def redact_text(text: str, mask: str) -> str:
    merged: list[list[int]] = []
    for _, a, b in scan_text(text):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, at = [], 0
    for a, b in merged:
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]]) if merged else text
