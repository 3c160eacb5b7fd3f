"""Quality rules with adaptive thresholds from mergeable quantile sketches.

``measure`` counts text statistics in one vectorised pass. ``judge`` builds, per language and
source, a quantile sketch of every ratio: counts over logarithmic buckets, which merge by
addition, so partial sketches combine in any order to the same result. Quartiles are read from the
sketch of the group, of its language and of everything and blended by their documents (a sketch
of n documents has the weight n / (n + prior) against the wider ones), so no group's verdicts
jump at some size. Junk lies above the bulk of a ratio, so the scale is read below the median: the fence is
``q50 + reach * max(q50 - q25, least spread)``, and for word length the mirrored lower one is read above it. Fences
replace fixed cutoffs and are joined back and filter; the least spread only stands in for a scale of 0 (a ratio
that is 0 in half the documents) and keeps every fence below the base rule.

Cases: null and empty texts have zero counts and fail the base rule (fewer than 20 words);
null languages and sources are groups of their own; repeated rows count as often as they
stand; whole texts are measured whatever their length; an empty table gives an empty table;
input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (extended, mix64, per_document, slices, span_hashes, starts_code_point, texts_of, utf8,
                               window_hashes, word_spans)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_stutters")
WINDOW = 8
#: ratio -> (numerator, denominator, what is added to the denominator so that one case in a short text
#: weighs little, least spread of the fence, two-sided)
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 0, 0.005, False),
    "dup_lines": ("n_dup_lines", "n_lines", 4, 0.05, False),
    "repeats": ("n_repeat_words", "n_words", 0, 0.049, False),
    "stutters": ("n_stutters", "n_words", 4, 0.02, False),
    "upper": ("n_upper", "word_chars", 0, 0.01, False),
    "marks": ("n_marks", "n_words", 0, 0.02, False),
    "word_length": ("word_chars", "n_words", 0, 0.35, True),
}
#: Spreads that a fence lies above the median, and the documents at which a group's own sketch has half the weight.
REACH, PRIOR = 6.0, 200
#: Relative width of a sketch bucket, and the ratio below which all values share bucket 0.
GAMMA, TINY = 1.02, 1e-4

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def counts_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of COUNTS for every text."""
    data, offs = utf8(texts)
    n = len(texts)
    starts, ends, doc = word_spans(data, offs)
    n_words = np.bincount(doc, minlength=n)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    in_word = np.cumsum(inside[:-1]).astype(bool)
    # lines: pieces between newlines inside one text
    line_starts, line_ends, line_doc = _lines(data, offs)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    a, z, d = line_starts[worded], line_ends[worded], line_doc[worded]
    keys = mix64(span_hashes(data, a, z) + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    words = span_hashes(data, starts, ends)
    return {
        "n_words": n_words,
        "word_chars": per_document(in_word & starts_code_point(data), offs),
        "n_symbols": per_document(_SYMBOL[data], offs),
        "n_dup_lines": np.bincount(d[again], minlength=n),
        "n_repeat_words": _repeat_words(words, doc, n),
        "n_lines": np.bincount(d, minlength=n),
        "n_upper": per_document(_UPPER[data], offs),
        "n_marks": per_document(_MARK[data], offs),
        "n_stutters": np.bincount(doc[1:][(words[1:] == words[:-1]) & (doc[1:] == doc[:-1])], minlength=n),
    }


def _lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the non-empty pieces between newlines."""
    newline = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offs[:-1], newline + 1]))
    starts = starts[starts < len(data)]
    doc = np.searchsorted(offs, starts, side="right") - 1
    ends = np.minimum(np.append(newline, len(data))[np.searchsorted(newline, starts)], offs[doc + 1])
    full = ends > starts
    return starts[full], ends[full], doc[full]


def _repeat_words(words: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Words that lie in a window of WINDOW words found twice or more in their text."""
    if len(words) < WINDOW:
        return np.zeros(n, np.int64)
    hashes = window_hashes(words, WINDOW)
    whole = doc[:len(hashes)] == doc[WINDOW - 1:]
    at = np.flatnonzero(whole)
    keys = mix64(hashes[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    return np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of COUNTS (longs). One pass, no shuffle."""
    base, schema = extended(docs, [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                got = counts_of(texts_of(batch, text_col))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(got[c].astype(np.int64)) for c in COUNTS]],
                    [*batch.schema.names, *COUNTS])

    return base.mapInArrow(run, schema)


def base_failed(of: str = "") -> Column:
    """The base rule; ``of`` names the frame of the counts (``alias.``)."""
    n_words = F.col(f"{of}n_words")
    return (n_words < 20) | (100 * F.col(f"{of}n_repeat_words") > 30 * n_words)


def ratio(name: str, of: str = "") -> Column:
    top, bottom, more, _, _ = RATIOS[name]
    return F.coalesce(F.try_divide(F.col(of + top).cast("double"), (F.col(of + bottom) + more).cast("double")), F.lit(0.0))


def sketch(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, ratio, bucket, n): the quantile sketches; map-side sums come first, so a
    hot source adds at most one row per bucket and task."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), ratio(r).alias("v")) for r in RATIOS]))
    bucket = F.when(F.col("e.v") < TINY, 0).otherwise(
        F.ceil(F.log(F.col("e.v") / TINY) / F.log(F.lit(GAMMA))).cast("int"))
    return (measured.where(~base_failed())
            .select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"), each.alias("e"))
            .groupBy("lang", "source", F.col("e.ratio").alias("ratio"), bucket.alias("bucket"))
            .agg(F.count("*").alias("n")))


def fences(sketches: DataFrame, reach: float = REACH, prior: float = PRIOR) -> DataFrame:
    """(lang, source, ratio, lo, hi): fences of every group, from quartiles blended over its own sketch, the merged
    one of its language and that of all."""
    levels = (sketches.withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
              .groupBy("level",
                       F.when(F.col("level") < 2, F.col("lang")).alias("lang"),
                       F.when(F.col("level") < 1, F.col("source")).alias("source"), "ratio", "bucket")
              .agg(F.sum("n").alias("n")))
    group = Window.partitionBy("level", "lang", "source", "ratio")
    run = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(F.lit(TINY) * F.pow(F.lit(GAMMA), F.col("bucket") - 0.5))
    seen = (levels.withColumn("upto", F.sum("n").over(run)).withColumn("total", F.sum("n").over(group))
            .withColumn("value", value))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("value")))

    names = ("q25", "q50", "q75")
    read = (seen.groupBy("level", "lang", "source", "ratio")
            .agg(F.max("total").alias("docs"), quantile(0.25).alias("q25"), quantile(0.5).alias("q50"), quantile(0.75).alias("q75")))
    out = sketches.select("lang", "source", "ratio").distinct()
    for level, keys in enumerate((["ratio", "lang", "source"], ["ratio", "lang"], ["ratio"])):
        own = read.where(F.col("level") == level).select(*[F.col(k).alias(f"{k}{level}") for k in keys],
                                                         F.struct("docs", *names).alias(f"f{level}"))
        same = F.lit(True)
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"{k}{level}"))
        out = out.join(own, same, "left")

    def blended(name: str) -> Column:
        value = F.col(f"f2.{name}")
        for level in (1, 0):
            docs = F.col(f"f{level}.docs")
            weight = docs / (docs + F.lit(float(prior)))
            value = weight * F.col(f"f{level}.{name}") + (1 - weight) * value
        return value.alias(name)

    spread = F.create_map(*[x for r, (_, _, _, s, _) in RATIOS.items() for x in (F.lit(r), F.lit(s))])[F.col("ratio")]
    two_sided = F.col("ratio").isin([r for r, x in RATIOS.items() if x[4]])
    q = out.select("lang", "source", "ratio", *[blended(n) for n in names])
    hi = F.col("q50") + F.lit(reach) * F.greatest(F.col("q50") - F.col("q25"), spread)
    lo = F.when(two_sided, F.col("q50") - F.lit(reach) * F.greatest(F.col("q75") - F.col("q50"), spread))
    return q.select("lang", "source", "ratio", lo.alias("lo"), hi.alias("hi"))


def judge(measured: DataFrame, reach: float = REACH, prior: float = PRIOR, lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``. Read twice (sketch, verdict): hand in a
    written table. The fences are one row per language and source; the plan joins them by
    broadcast when their measured size allows, else by a shuffle that splits hot groups."""
    from strata.llm.common import without, written

    base = without(measured, ["base_failed", "kept"])
    table = written(fences(written(sketch(base, lang_col, source_col), "quality-sketch"), reach, prior), "quality-fences")
    wide = (table.groupBy("lang", "source")
            .agg(F.struct(*[F.max(F.when(F.col("ratio") == r, F.struct("lo", "hi"))).alias(r) for r in RATIOS]).alias("fence"))
            .alias("__wide"))
    rows = base.alias("__rows")
    joined = rows.join(wide, F.col(f"__rows.`{lang_col}`").eqNullSafe(F.col("__wide.lang"))
                       & F.col(f"__rows.`{source_col}`").eqNullSafe(F.col("__wide.source")), "left")
    inside = F.lit(True)
    for r in RATIOS:
        lo, hi = F.col(f"__wide.fence.{r}.lo"), F.col(f"__wide.fence.{r}.hi")
        value = ratio(r, "__rows.")
        inside &= F.coalesce(value <= hi, F.lit(True)) & F.coalesce(value >= lo, F.lit(True))
    failed = base_failed("__rows.")
    return joined.select(*[F.col(f"__rows.`{c}`") for c in base.columns], failed.alias("base_failed"), (~failed & inside).alias("kept"))
