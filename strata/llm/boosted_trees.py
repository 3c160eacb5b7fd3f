"""Histogram gradient-boosted trees over document statistics.

``document_features`` computes a fixed vector of statistics of every whole text in one
vectorised pass. ``fit`` grows complete binary trees of fixed depth on quantile-binned features
with logistic loss; the result is flattened into arrays (feature, threshold, leaf value per
node), and ``predict`` walks all rows down all trees level by level in numpy.

The trees are fitted on a bounded sample of the labelled rows (``MAX_ROWS``, the smallest by a
hash of the id), a few megabytes of numbers; scoring covers every row.

Cases: null and empty texts have all-zero features and get a score like any other; labels that
are null or name no document are not learned from; repeated labels of a document count as
often as they stand; with labels of one class only (or none) every score is that class's share
(0.5 without labels); ties in the sample order are broken by the features; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (NOT_WS, extended, mix64, per_document, slices, span_hashes, starts_code_point, texts_of, utf8,
                               word_spans)
from strata.llm.quality_rules import counts_of

#: Labelled rows that the trees are fitted on at most.
MAX_ROWS = 20_000
FEATURES = ("log_words", "log_chars", "word_length", "word_length_spread", "symbols", "upper", "marks", "digits", "punctuation",
            "non_ascii", "spaces", "dup_lines", "repeats", "distinct_words", "words_per_line", "short_words", "long_words",
            "ends_with_mark", "bars", "max_word")


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_DIGIT, _PUNCT, _BAR = _table(b"0123456789"), _table(b".,;:'\"()-"), _table(b"|")


def features_of(texts: pa.Array) -> np.ndarray:
    """(documents, FEATURES) float32."""
    n = len(texts)
    data, offs = utf8(texts)
    c = counts_of(texts)
    starts, ends, doc = word_spans(data, offs)
    point = np.concatenate([[0], np.cumsum(starts_code_point(data))])
    sizes = (point[ends] - point[starts]).astype(np.float64)
    words = np.maximum(c["n_words"], 1).astype(np.float64)
    chars = np.maximum(c["word_chars"], 1).astype(np.float64)
    lines = np.maximum(c["n_lines"], 1).astype(np.float64)
    total = np.maximum(per_document(starts_code_point(data), offs), 1).astype(np.float64)

    def by_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=n)

    def share(table: np.ndarray) -> np.ndarray:
        return per_document(table[data], offs) / chars

    mean = by_doc(sizes) / words
    spread = np.sqrt(np.maximum(0, by_doc(sizes * sizes) / words - mean * mean))
    keys = np.unique(mix64(span_hashes(data, starts, ends) ^ (doc.astype(np.uint64) << np.uint64(40))) if len(doc) else np.zeros(0, np.uint64),
                     return_index=True)[1]
    distinct = np.bincount(doc[keys], minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, sizes)
    # words that end with a sentence mark
    marks = by_doc(_PUNCT[data[ends - 1]].astype(float)) if len(ends) else np.zeros(n)
    out = np.stack([
        np.log1p(c["n_words"]), np.log1p(per_document(starts_code_point(data), offs)), mean, spread,
        c["n_symbols"] / chars, c["n_upper"] / chars, c["n_marks"] / words, share(_DIGIT), share(_PUNCT),
        per_document(starts_code_point(data) & (data >= 0x80), offs) / chars, per_document(~NOT_WS[data], offs) / total,
        c["n_dup_lines"] / lines, c["n_repeat_words"] / words, distinct / words, c["n_words"] / lines,
        by_doc(sizes <= 2) / words, by_doc(sizes >= 13) / words, marks / words, share(_BAR), np.log1p(longest)], 1)
    return out.astype(np.float32)


FIELD = T.StructField("doc_features", T.ArrayType(T.FloatType()))


def document_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``doc_features``: FEATURES as floats. One pass, no shuffle."""
    base, schema = extended(docs, [FIELD])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                x = features_of(texts_of(batch, text_col))
                rows = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, rows], [*batch.schema.names, FIELD.name])

    return base.mapInArrow(run, schema)


# ------------------------------------------------------------------ trees

@dataclass
class Trees:
    """Complete trees of one depth: node k of a tree has children 2k+1 and 2k+2."""
    base: float
    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; larger values go right
    leaf: np.ndarray       # trees x leaves

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of ``x``."""
        raw = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1] if len(self.feature) else 0
        depth = (inner + 1).bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            raw += leaf[node - inner]
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for labels 0/1 by second-order logistic loss on binned features."""
    inner = 2 ** depth - 1
    none = Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    none.base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return none
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    raw = np.full(len(y), none.base)
    out = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            split = np.full(width, -1)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                at = (node - first) * (len(c) + 1) + binned[:, f]
                gl = np.bincount(at, weights=g, minlength=width * (len(c) + 1)).reshape(width, -1).cumsum(1)
                hl = np.bincount(at, weights=h, minlength=width * (len(c) + 1)).reshape(width, -1).cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gl, hl = gl[:, :-1], hl[:, :-1]
                gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
                gain[(hl < least) | (ht - hl < least)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best + 1e-9
                best[better] = gain[np.arange(width), k][better]
                feature[first:first + width][better] = f
                threshold[first:first + width][better] = c[k[better]]
                split[better] = k[better]
            mine = node - first
            goes = (split[mine] >= 0) & (binned[np.arange(len(y)), feature[node]] > split[mine])
            node = 2 * node + 1 + goes
        at = node - inner
        value = -rate * np.bincount(at, weights=g, minlength=inner + 1) / (np.bincount(at, weights=h, minlength=inner + 1) + ridge)
        raw += value[at]
        for kept, new in zip(out, (feature, threshold, value)):
            kept.append(new)
    return Trees(none.base, *map(np.stack, out))


# ------------------------------------------------------------------ training and scoring

def train(featured: DataFrame, labels: DataFrame, id_col: str, label_col: str, max_rows: int = MAX_ROWS, **options) -> Trees:
    """Trees from the rows of ``featured`` (id, doc_features) that ``labels`` (id, label) marks.
    The ``max_rows`` rows with the smallest hash of the id come to the driver."""
    y = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y"))
    sample = (featured.select(F.col(id_col).alias("id"), "doc_features").join(y, F.col("id") == F.col("k"))
              .orderBy(F.xxhash64("id"), "id", "y", "doc_features").limit(max_rows).select("doc_features", "y").toArrow())
    if not sample.num_rows:
        return fit(np.zeros((0, len(FEATURES)), np.float32), np.zeros(0), **options)
    x = sample["doc_features"].combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    return fit(x, sample["y"].to_numpy().astype(float), **options)


def score(featured: DataFrame, trees: Trees, out: str = "score") -> DataFrame:
    """``featured`` with ``out``: the probability of label 1 (0 to 1)."""
    base, schema = extended(featured, [T.StructField(out, T.DoubleType())])
    shared = featured.sparkSession.sparkContext.broadcast(trees)  # rounds x nodes, fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.schema.get_field_index(FIELD.name)).flatten().to_numpy(zero_copy_only=False)
            got = shared.value.predict(x.reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*batch.schema.names, out])

    return base.mapInArrow(run, schema)
