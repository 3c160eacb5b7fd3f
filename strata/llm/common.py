"""Shared pieces of the training-data operators: scratch tables, column handling and
vectorised (numpy over UTF-8 buffers) text primitives used inside Arrow tasks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import strata
from strata.session import scratch_path

WS = b" \t\n\x0b\x0c\r"
#: Text bytes that one numpy pass works on at most (a longer text makes a slice of its own).
SLICE_BYTES = 1 << 20


#: Rows of an Arrow batch of documents: Spark's 10,000 are tens of megabytes of text in every task, twice.
BATCH_ROWS = "2000"


def ship(spark: SparkSession) -> None:
    """Make this library importable in the Python workers, once per application, by adding its
    sources to those that Spark hands to every executor. (A cluster that has it installed, or a
    job submitted with it, reads the same code.) Arrow batches are made smaller unless the session says otherwise."""
    sc = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    if getattr(sc, "_strata_shipped", False):
        return
    root = Path(strata.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="strata-"), "strata_sources.zip")  # the driver serves it from there
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"strata/{f.relative_to(root).as_posix()}")
    sc.addPyFile(str(path))
    sc._strata_shipped = True


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` under the cluster's shared checkpoint folder and read it back: cuts
    lineage, so a lost executor costs no recomputation of what stands before it."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame) -> DataFrame:
    """``df`` under attributes of its own, so that it can meet a frame made from the same table."""
    return df.select(*[F.col(f"`{c}`").alias(c) for c in df.columns])


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the input columns that an operator's own output columns replace."""
    lowered = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lowered])


def extended(df: DataFrame, fields: list[T.StructField]) -> tuple[DataFrame, T.StructType]:
    """``df`` without clashing columns, and its schema with ``fields`` appended."""
    base = without(df, [f.name for f in fields])
    return base, T.StructType([*base.schema.fields, *fields])


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column with nulls as empty strings."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.string()).fill_null("")


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, offsets starting at 0."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offs = np.frombuffer(off, np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``most`` text bytes (one row at least), so
    that numpy temporaries stay bounded whatever the batch size."""
    if not batch.num_rows:
        return
    _, offs = utf8(texts_of(batch, column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


# ---------------------------------------------------------------- numpy text primitives

_U = np.uint64
NOT_WS = np.ones(256, bool)
NOT_WS[list(WS)] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, elementwise."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_VALUE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
#: The same with A-Z read as a-z.
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]
_RADIX = _U(0x9FB21C651E98DF25)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """64-bit hash of every byte span (non-empty, disjoint, ascending)."""
    if not len(starts):
        return np.zeros(0, _U)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
    longest = int(lengths.max())
    power = np.multiply.accumulate(np.full(longest, _RADIX, _U))
    part = value[data[within + np.repeat(starts, lengths)]] * power[within]
    return mix64(np.add.reduceat(part, heads) + lengths.astype(_U))


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document index) of the maximal runs ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = NOT_WS[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def per_document(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of true bytes per document."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def starts_code_point(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of every run of ``width`` values (len - width + 1 of them)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    return mix64(reduce(lambda acc, k: acc * _U(0x9E3779B97F4A7C15) + mix64(hashes[k:k + n] + _U(k)),
                        range(width), np.zeros(n, _U)))


def white(data: np.ndarray) -> np.ndarray:
    """Bytes of white space, control characters and Unicode's wider spaces."""
    out = (data <= 0x20) | (data == 0x7F)
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    if len(lead):
        b0 = data[lead]
        b1 = data[np.minimum(lead + 1, len(data) - 1)]
        b2 = data[np.minimum(lead + 2, len(data) - 1)]
        two = lead[(b0 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))]
        three = lead[((b0 == 0xE1) & (b1 == 0x9A) & (b2 == 0x80)) | ((b0 == 0xE3) & (b1 == 0x80) & (b2 == 0x80))
                     | ((b0 == 0xE2) & (b1 == 0x81) & (b2 == 0x9F))
                     | ((b0 == 0xE2) & (b1 == 0x80) & ((b2 <= 0x8A) | (b2 == 0xA8) | (b2 == 0xA9) | (b2 == 0xAF)))]
        out[two] = out[two + 1] = True
        out[three] = out[three + 1] = out[three + 2] = True
    return out


def unit_cuts(data: np.ndarray, offs: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Where a byte-level BPE must cut the documents ``offs``, ascending, without 0: before a single space between
    other characters, around such a newline, and between an ASCII letter or digit and a byte of ``mark``."""
    blank = white(data)
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        lone = np.zeros(n, bool)
        lone[1:-1] = blank[1:-1] & ~blank[:-2] & ~blank[2:]
        cut[:-1] |= lone & (data == 0x20)
        newline = np.flatnonzero(lone & (data == 0x0A))
        cut[newline] = True
        cut[newline + 1] = True
        plain = np.zeros(256, bool)
        plain[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
        cut[1:-1] |= plain[data[:-1]] & mark[data[1:]]
    cut[0] = cut[n] = False
    cut[offs[1:-1]] = True
    return np.flatnonzero(cut)


def ascending(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (``np.unique`` without counts hashes, which is slower on integers)."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def expand_runs(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + many[i] - 1, one run behind the other."""
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


def md5_int(column, digits: int, start: int = 1):
    """Native: ``digits`` hex digits (at most 15) of an md5 hex string, as a long."""
    return F.conv(F.substring(column, start, digits), 16, 10).cast("long")


#: SQL regex of a word; RE2 (DuckDB) and Java read it alike.
WORD_RE = r"[^\x20\x09-\x0D]+"


def n_words(text) -> F.Column:
    """Native word count; null text has no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")
