"""Language identification of mixed-language text.

Training counts hashed letter trigrams, whole words and scripts per language over all
labelled documents, in Spark. Scoring gives every word (a run of letters) a log-likelihood per
language; the word's script narrows the candidates to languages that use it; Viterbi over the
words, with a penalty for switching, labels spans. A document's language is the one that
labels most of its letters, and the score is that share, weighed by how clearly the words
chose it.

The model has ``FEATURES`` rows and one column per language, whatever the corpus size.

Cases: null text and text without letters give ``und``, score 0 and no spans; a word whose script no
learned language uses is open to all of them; texts are read whole; ties go to the language
that sorts first; repeated rows are scored row by row; without any labelled document everything
is ``und``; an empty table gives an empty table; input columns named like an output column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import SLICE_BYTES, extended, slices, texts_of

BUCKETS = 1 << 16
#: First code point of each script range; fixed values of the Unicode block layout.
SCRIPT_STARTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Hiragana"), (0x30A0, "Katakana"), (0x3100, "Other"), (0x3130, "Hangul"),
    (0x3190, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"),
    (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF21, "Latin"), (0xFF66, "Katakana"),
    (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"), (0x30000, "Han"), (0x40000, "Other"),
]
SCRIPTS = sorted({s for _, s in SCRIPT_STARTS})
#: Trigrams, then whole words, then scripts.
FEATURES = 2 * BUCKETS + len(SCRIPTS)
#: A language is a candidate for a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01

_tables = None


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is letter, lower case, script) of every code point; built once per worker."""
    global _tables
    if _tables is None:
        chars = [chr(c) for c in range(0x110000)]
        letter = np.fromiter((c.isalpha() for c in chars), bool, len(chars))
        low = np.arange(len(chars), dtype=np.uint32)
        for c in np.flatnonzero(letter):
            s = chars[c].lower()
            if len(s) == 1:
                low[c] = ord(s)
        starts = np.array([a for a, _ in SCRIPT_STARTS])
        names = np.array([SCRIPTS.index(s) for _, s in SCRIPT_STARTS], np.uint8)
        _tables = letter, low, names[np.searchsorted(starts, np.arange(len(chars)), side="right") - 1]
    return _tables


@dataclass
class Words:
    """The words of a run of documents: spans in the joined code points, and their features."""
    offs: np.ndarray       # code points before each document
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    trigrams: np.ndarray   # bucket of each letter's trigram, word after word
    heads: np.ndarray      # where each word's trigrams begin
    whole: np.ndarray      # bucket of the word
    script: np.ndarray     # script of its first letter


def words_of(texts: list[str]) -> Words:
    letter, low, scripts = tables()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offs = np.concatenate([[0], np.cumsum(lengths)])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    inside = letter[points]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(points))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sizes = ends - starts
    heads = np.cumsum(sizes) - sizes
    chars = low[points[inside]].astype(np.uint64)
    before, after = np.zeros_like(chars), np.zeros_like(chars)
    before[1:], after[:-1] = chars[:-1], chars[1:]
    before[heads], after[heads + sizes - 1] = 1, 1
    h = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (chars * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (after * np.uint64(0x165667B19E3779F9))
    h *= np.uint64(0xD6E8FEB86659FD93)
    tri = (h >> np.uint64(48)).astype(np.int32)
    whole = np.add.reduceat(h, heads) if len(heads) else np.zeros(0, np.uint64)
    whole = ((whole * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int32)
    return Words(offs, starts, ends, np.searchsorted(offs, starts, side="right") - 1, tri, heads, whole, scripts[points[starts]])


# ------------------------------------------------------------------ training

@dataclass
class Model:
    langs: list[str]
    table: np.ndarray      # FEATURES - scripts rows of log-probabilities, one column per language
    allowed: np.ndarray    # script x language

    def scores(self, w: Words) -> np.ndarray:
        """Log-likelihood of every word per language; languages that do not use its script are out."""
        if not len(w.starts):
            return np.zeros((0, len(self.langs)), np.float32)
        s = np.add.reduceat(self.table[w.trigrams], w.heads, axis=0) + self.table[BUCKETS + w.whole]
        return np.where(self.allowed[w.script], s, np.float32(-1e6))


def count_features(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, feature, n) over all documents with a label: counts per task, then a sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def give() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                                 ["lang", "feature", "n"])
            held.clear()

        for whole in batches:
            for batch in slices(whole, text_col):
                w = words_of(texts_of(batch, text_col).to_pylist())
                names = batch.column(batch.schema.get_field_index(lang_col)).to_pylist()
                sizes = w.ends - w.starts
                own = np.repeat(w.doc, sizes)
                for lang in dict.fromkeys(names):
                    mine = np.array([x == lang for x in names])
                    if lang not in held and len(held) >= 64:
                        yield from give()
                    n = held.setdefault(lang, np.zeros(FEATURES, np.int64))
                    n[:BUCKETS] += np.bincount(w.trigrams[mine[own]], minlength=BUCKETS)
                    n[BUCKETS:2 * BUCKETS] += np.bincount(w.whole[mine[w.doc]], minlength=BUCKETS)
                    n[2 * BUCKETS:] += np.bincount(w.script[mine[w.doc]], weights=sizes[mine[w.doc]],
                                                   minlength=len(SCRIPTS)).astype(np.int64)
        yield from give()

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(f"`{lang_col}`"), F.col(f"`{text_col}`"))
    return (rows.mapInArrow(run, "lang string, feature int, n long")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.1) -> Model:
    """Model of the labelled ``docs``. The driver gets FEATURES counts a language at most."""
    counts = count_features(docs, text_col, lang_col).toPandas()
    langs = sorted(counts["lang"].unique())
    n = np.zeros((FEATURES, len(langs)))
    n[counts["feature"].to_numpy(), counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)] = counts["n"]
    parts = [np.log((x + smoothing) / (x.sum(0) + smoothing * BUCKETS)) for x in (n[:BUCKETS], n[BUCKETS:2 * BUCKETS])]
    scripts = n[2 * BUCKETS:]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(0))
    allowed[~allowed.any(1)] = True
    return Model(list(langs), np.concatenate(parts).astype(np.float32), allowed)


# ------------------------------------------------------------------ labelling

def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word. Row ``first[d] + t`` of ``scores`` is word ``t`` of document d;
    all documents advance together, a step per word position, longest first."""
    label = np.zeros(len(scores), np.int16)
    order = np.argsort(-count, kind="stable")
    order = order[count[order] > 0]
    if not len(order):
        return label
    first, count = first[order], count[order]
    alive = np.searchsorted(-count, -np.arange(1, count[0] + 1), side="right")  # documents with word t
    came = np.zeros(scores.shape, np.int16)
    stay = np.arange(scores.shape[1], dtype=np.int16)
    best = scores[first].astype(np.float64)
    for t in range(1, int(count[0])):
        m = alive[t]
        v = best[:m]
        top = v.argmax(1)
        jump = v[np.arange(m), top][:, None] - penalty
        moved = jump > v
        at = first[:m] + t
        came[at] = np.where(moved, top[:, None].astype(np.int16), stay)
        best[:m] = np.where(moved, jump, v) + scores[at]
    now = best.argmax(1).astype(np.int16)
    label[first + count - 1] = now
    for t in range(int(count[0]) - 1, 0, -1):
        m = alive[t]
        at = first[:m] + t
        now[:m] = came[at, now[:m]]
        label[at - 1] = now[:m]
    return label


def label_texts(texts: list[str], model: Model, penalty: float) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """(language, score, spans) of every text."""
    w = words_of(texts)
    scores = model.scores(w)
    count = np.bincount(w.doc, minlength=len(texts))
    first = np.cumsum(count) - count
    label = viterbi(scores, first, count, penalty)
    sizes = w.ends - w.starts
    langs = len(model.langs)
    letters = np.bincount(w.doc * langs + label, weights=sizes, minlength=len(texts) * langs).reshape(-1, langs)
    pick = letters.argmax(1)
    # how clearly: mean advantage per word of the picked language over the best other one
    if len(scores) and langs > 1:
        mine = scores[np.arange(len(scores)), pick[w.doc]]
        others = scores.copy()
        others[np.arange(len(scores)), pick[w.doc]] = -np.inf
        gap = np.bincount(w.doc, weights=np.clip(mine - others.max(1), -20, 20), minlength=len(texts))
        clear = 1 / (1 + np.exp(-np.clip(gap, -50, 50)))
    else:
        clear = np.ones(len(texts))
    total = letters.sum(1)
    score = letters.max(1) / np.maximum(total, 1) * clear
    # spans: runs of words of one document with one label
    new = np.ones(len(label), bool)
    new[1:] = (w.doc[1:] != w.doc[:-1]) | (label[1:] != label[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(label)) - 1 if len(heads) else heads
    spans: list[list] = [[] for _ in texts]
    for d, k, a, b in zip(w.doc[heads].tolist(), label[heads].tolist(), (w.starts[heads] - w.offs[w.doc[heads]]).tolist(),
                          (w.ends[tails] - w.offs[w.doc[heads]]).tolist()):
        spans[d].append((model.langs[k], a, b))
    return [(model.langs[p], float(s), x) if n else ("und", 0.0, [])
            for p, s, n, x in zip(pick.tolist(), score.tolist(), total.tolist(), spans)]


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("lang_spans", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()),
                                                                T.StructField("start", T.LongType()),
                                                                T.StructField("end", T.LongType())])))]


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = 12.0) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``lang_spans`` (code points, end exclusive)."""
    base, schema = extended(docs, FIELDS)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x languages, bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        m = shared.value
        for whole in batches:
            # neighbours in length share the steps of a run
            texts = texts_of(whole, text_col)
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)) if len(texts) else []
            sorted_batch = whole.take(pa.array(np.argsort(sizes, kind="stable"))) if len(texts) else whole
            for batch in slices(sorted_batch, text_col, 2 * SLICE_BYTES):
                own = texts_of(batch, text_col).to_pylist()
                got = label_texts(own, m, penalty) if m.langs else [("und", 0.0, [])] * len(own)
                spans = [[{"lang": x, "start": a, "end": b} for x, a, b in g[2]] for g in got]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                     pa.array(spans, kind)], [*batch.schema.names, *[f.name for f in FIELDS]])

    return base.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, mod 4, is 2: such rows are never learned from. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
