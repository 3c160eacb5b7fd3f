"""Substring dedup on prefix-partitioned suffix trees.

A *window* is a run of ``words`` consecutive words of one document; a word goes when some window
that covers it stands earlier too (smaller id, or same id and earlier start).

Suffixes are taken at *anchors*: of the prefixes of ``PREFIX`` words inside a window, the one with
the least hash. Equal windows have their anchor at the same place, so windows are compared only
among suffixes that begin with the same prefix, and about one word in seven begins a suffix.

1. Documents are gathered into blocks (``BLOCK_BYTES``); a block names each of its prefixes once,
   with its count. Prefixes that stand once in all blocks begin no repeat and go no further.
2. Variable-length prefixes split the suffixes into groups of a bounded size: a prefix with at most
   ``group_limit`` suffixes is a group as it stands; a more frequent one is lengthened to the whole
   window, each window being a group of its own.
3. A task sorts the suffixes of its groups with their common lengths: a tree whose internal nodes are
   the runs of suffixes that agree in so many words. Where a node's depth and the words that
   agree before the anchor make a whole window, its leaves are copies: the earliest stays, the others
   are marked. A lengthened group has one node, its earliest leaf is found by two rounds of minima
   (per part of the blocks, then over these), so a window that stands in every block bounds no task.
4. Marks go back to their blocks, which drop the covered words.

Equal texts: only rows of the smallest id take part; the others lose every word, if they have a window.

Cases: null and empty texts have no words and stay as they are (kept text ''); texts of any length are read
whole; rows with one id are one document as far as "earlier" goes: at equal starts neither is earlier, so
repeated rows give equal results; a null id counts as larger than every other; ids are integers. An empty
table gives an empty table; other columns of the input are not read, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import mix64, slices, span_hashes, texts_of, utf8, window_hashes, word_spans, written

#: Words of a suffix's shortest prefix.
PREFIX = 5
#: Text bytes of a block (a longer text makes a block of its own).
BLOCK_BYTES = 4 << 20
#: Suffixes that a group of one shortest prefix holds at most.
GROUP_LIMIT = 50_000
#: Text bytes of suffixes whose trees a task builds at once (whole groups).
TREE_BYTES = 6 << 20
#: Words hashed in one numpy pass.
_HASH_WORDS = 1 << 17
#: Parts of the blocks for the first round of minima.
_PARTS = 64

_U = np.uint64
_LAST_ID = np.iinfo(np.int64).max
_OTHER = _U(0xD6E8FEB86659FD93)

_BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("body", T.BinaryType()),
    T.StructField("prefix", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("ord", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("digest", T.BinaryType())])
_SUFFIXES = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("prefix", T.LongType()), T.StructField("rest", T.LongType()),
    T.StructField("ord", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("before", T.IntegerType()), T.StructField("words", T.BinaryType()),
    T.StructField("ords", T.ArrayType(T.IntegerType())), T.StructField("starts", T.ArrayType(T.IntegerType()))])
_MARKS = T.StructType([T.StructField("block", T.LongType()), T.StructField("ords", T.ArrayType(T.IntegerType())),
                       T.StructField("starts", T.ArrayType(T.IntegerType()))])
#: ``start`` of the mark that takes a whole document.
_WHOLE = -1


# ---------------------------------------------------------------- words, anchors, blocks

def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    parts = [span_hashes(data, starts[k:k + _HASH_WORDS], ends[k:k + _HASH_WORDS])
             for k in range(0, len(starts), _HASH_WORDS)]
    return np.concatenate(parts) if parts else np.zeros(0, _U)


class Anchors:
    """The words of some texts, and their anchors: ``at`` (word number), ``prefix`` (its hash) and the
    starts ``first``..``last`` of the windows that an anchor serves."""

    def __init__(self, texts: pa.Array, words: int):
        self.data, offs = utf8(texts)
        self.starts, self.ends, self.doc = word_spans(self.data, offs)
        self.first_word = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.n_words = np.diff(self.first_word)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.words, size = words, min(PREFIX, words)
        n = len(self.hashes) - words + 1
        e = np.zeros(0, np.int64)
        self.at = self.first = self.last = e
        self.prefix = np.zeros(0, _U)
        if n <= 0:
            return
        begins = np.flatnonzero(self.doc[:n] == self.doc[words - 1:])
        if not len(begins):
            return
        grams = window_hashes(self.hashes, size)
        choice = np.lib.stride_tricks.sliding_window_view(grams, words - size + 1)
        at = np.concatenate([choice[k:k + _HASH_WORDS].argmin(1) for k in range(0, n, _HASH_WORDS)]) + np.arange(n)
        at = at[begins]
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.at, self.first = at[edge], begins[edge]
        self.last = begins[np.concatenate([edge[1:], [len(begins)]]) - 1]
        self.prefix = grams[self.at]


def _ids(batch: pa.Table | pa.RecordBatch, name: str = "id") -> np.ndarray:
    ids = batch.column(name)
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return ids.cast(pa.int64()).fill_null(_LAST_ID).to_numpy(zero_copy_only=False)


def _body(ids: pa.Array, texts: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([ids, texts], ["id", "text"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(body: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(pa.BufferReader(body))))


def _rows(schema: T.StructType, n: int, /, **columns) -> pa.RecordBatch:
    """``n`` rows with the named columns, the others null."""
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.BinaryType: pa.binary(), T.ArrayType: pa.list_(pa.int32())}
    arrays = [columns.get(f.name) if f.name in columns else pa.nulls(n, kinds[type(f.dataType)]) for f in schema]
    return pa.RecordBatch.from_arrays(
        [a.cast(kinds[type(f.dataType)]) if isinstance(a, pa.Array) else pa.array(a, kinds[type(f.dataType)])
         for a, f in zip(arrays, schema)], [f.name for f in schema])


def _gather(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Rows regrouped into batches of about BLOCK_BYTES of text."""
    held, size = [], 0
    for whole in batches:
        for part in slices(whole, text_col, BLOCK_BYTES):
            own = len(utf8(texts_of(part, text_col))[0])
            if held and size + own > BLOCK_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(words: int):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(_gather(batches, "text")):
            texts = texts_of(batch, "text")
            found = Anchors(texts, words)
            yield _rows(_BLOCKS, 1, block=[base + k], body=[_body(batch.column(0), texts)])
            prefixes, counts = np.unique(found.prefix, return_counts=True)
            for j in range(0, len(prefixes), _HASH_WORDS):
                part = prefixes[j:j + _HASH_WORDS].view(np.int64)
                yield _rows(_BLOCKS, len(part), block=np.full(len(part), base + k), prefix=part,
                            n=counts[j:j + _HASH_WORDS])
            able = np.flatnonzero(found.n_words >= words)
            if len(able):
                raw, offs = memoryview(utf8(texts)[0]), utf8(texts)[1]
                yield _rows(_BLOCKS, len(able), block=np.full(len(able), base + k), ord=able, id=_ids(batch)[able],
                            digest=[hashlib.md5(raw[offs[i]:offs[i + 1]]).digest() for i in able])

    return run


# ---------------------------------------------------------------- suffixes

def _marks(block: np.ndarray, ords: np.ndarray, starts: np.ndarray, schema: T.StructType) -> pa.RecordBatch | None:
    """One row a block with the documents and starts of its marked windows."""
    if not len(block):
        return None
    order = np.lexsort((starts, ords, block))
    block, ords, starts = block[order], ords[order], starts[order]
    edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    offs = pa.array(np.concatenate([edge, [len(block)]]), pa.int32())
    return _rows(schema, len(edge), block=block[edge],
                 ords=pa.ListArray.from_arrays(offs, pa.array(ords, pa.int32())),
                 starts=pa.ListArray.from_arrays(offs, pa.array(starts, pa.int32())))


def _earliest(keys: list[np.ndarray], ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, later): rows sorted by ``keys``, id and start, and whether a row (in that order) stands
    later than the earliest one of its keys."""
    order = np.lexsort((starts, ids, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    ids, starts = ids[order], starts[order]
    return order, (ids > ids[head]) | ((ids == ids[head]) & (starts > starts[head]))


def _suffixes(words: int):
    """Of one block: the suffixes that begin with a prefix which stands elsewhere too."""

    def run(key, bodies: pa.Table, flags: pa.Table) -> pa.Table:
        block = key[0].as_py()
        out = [_rows(_SUFFIXES, 0)]
        if bodies.num_rows and flags.num_rows:
            batch = _unpack(bodies.column("body")[0].as_py())
            found, ids = Anchors(batch.column(1), words), _ids(batch)
            flags = flags.combine_chunks()
            whole = flags.column("ord").drop_null().to_numpy()
            gone = np.zeros(batch.num_rows, bool)
            gone[whole] = True
            named = flags.filter(flags.column("prefix").is_valid())
            prefixes = named.column("prefix").to_numpy().view(_U)
            rank = np.argsort(prefixes)
            prefixes, hot = prefixes[rank], np.asarray(named.column("hot").to_numpy())[rank]
            here = np.zeros(len(found.at), bool)
            if len(prefixes):
                place = np.minimum(np.searchsorted(prefixes, found.prefix), len(prefixes) - 1)
                here = (prefixes[place] == found.prefix) & ~gone[found.doc[found.at]]
            kept = np.flatnonzero(here)
            is_hot = hot[place[kept]].astype(bool) if len(kept) else np.zeros(0, bool)
            out += [_marks(np.full(len(whole), block), whole, np.full(len(whole), _WHOLE), _SUFFIXES)]
            cold = kept[~is_hot]
            raw, doc = found.data.tobytes(), found.doc
            if len(cold):
                first, last, at = found.first[cold], found.last[cold], found.at[cold]
                cuts = zip(found.starts[first].tolist(), found.ends[last + words - 1].tolist())
                out.append(_rows(_SUFFIXES, len(cold), block=np.full(len(cold), block), prefix=found.prefix[cold].view(np.int64),
                                 ord=doc[at], id=ids[doc[at]], start=first - found.first_word[doc[at]], before=at - first,
                                 words=[raw[a:b] for a, b in cuts]))
            warm = kept[is_hot]
            if len(warm):
                many = found.last[warm] - found.first[warm] + 1
                begin = np.repeat(found.first[warm] - np.cumsum(many) + many, many) + np.arange(many.sum())
                one = window_hashes(found.hashes, words)[begin]
                two = window_hashes(mix64(found.hashes + _OTHER), words)[begin]
                own, start = doc[begin], begin - found.first_word[doc[begin]]
                order, later = _earliest([one, two], ids[own], start)
                lost = order[later]
                out.append(_marks(np.full(len(lost), block), own[lost], start[lost], _SUFFIXES))
                stay = order[~later]
                out.append(_rows(_SUFFIXES, len(stay), block=np.full(len(stay), block), prefix=one[stay].view(np.int64),
                                 rest=two[stay].view(np.int64), ord=own[stay], id=ids[own[stay]], start=start[stay]))
        return pa.Table.from_batches([b for b in out if b is not None])

    return run


# ---------------------------------------------------------------- trees

def tree_marks(batch: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, ord, start) of the windows that stand earlier too, of whole groups of suffixes.

    The suffixes are sorted word by word; ``common`` is the number of words that a suffix shares with
    its predecessor. Suffixes between two places where ``common`` is below ``d`` are the leaves of one
    node of depth ``d`` or more. A window that begins ``o`` words before its anchor needs a node of depth
    ``words - o`` whose leaves also agree in the ``o`` words before."""
    size = min(PREFIX, words)
    texts = batch.column("words").combine_chunks()
    data, offs = utf8(texts.cast(pa.binary()))
    starts, ends, own = word_spans(data, offs)
    hashes = word_hashes(data, starts, ends)
    head = np.searchsorted(own, np.arange(batch.num_rows + 1))
    before = batch.column("before").to_numpy().astype(np.int64)
    anchor = head[:-1] + before
    after = head[1:] - anchor
    column = np.arange(words)
    reach = np.minimum(anchor[:, None] + column, len(hashes) - 1)
    path = np.where(column < after[:, None], hashes[reach], _U(0))
    prefix = batch.column("prefix").to_numpy()
    order = np.lexsort((*(path[:, j] for j in range(words - 1, size - 1, -1)), prefix))
    path, prefix = path[order], prefix[order]
    same = path[1:] == path[:-1]
    common = np.where(same.all(1), words, same.argmin(1))
    common[prefix[1:] != prefix[:-1]] = 0
    ids, blocks, ords = _ids(batch)[order], batch.column("block").to_numpy()[order], batch.column("ord").to_numpy()[order]
    first, before, anchor = batch.column("start").to_numpy()[order], before[order], anchor[order]
    windows = (head[1:] - head[:-1])[order] - words + 1
    found = []
    left = np.zeros(len(order), _U)
    for o in range(words - size + 1):
        if o:
            left = mix64(left * _U(0x9E3779B97F4A7C15) + hashes[np.maximum(anchor - o, 0)])
        node = np.cumsum(np.concatenate([[0], common < words - o]))
        leaf = np.flatnonzero((o <= before) & (before - o < windows))
        if len(leaf) < 2:
            continue
        begin = first[leaf] + before[leaf] - o
        rank, later = _earliest([node[leaf], left[leaf]], ids[leaf], begin)
        lost = rank[later]
        found.append((blocks[leaf[lost]], ords[leaf[lost]], begin[lost]))
    if not found:
        e = np.zeros(0, np.int64)
        return e, e, e
    return tuple(np.concatenate(x) for x in zip(*found))


def _trees(words: int):
    """Over suffixes sorted by prefix: whole groups are gathered to about TREE_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def build(parts):
            made = _marks(*tree_marks(pa.Table.from_batches(parts).combine_chunks(), words), _MARKS)
            return [made] if made is not None else []

        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                part = batch.slice(at, 10_000)
                if held and size > TREE_BYTES:
                    prefix = part.column("prefix").to_numpy()
                    open_key = held[-1].column("prefix")[-1].as_py()
                    goes = int(np.argmax(prefix != open_key)) if (prefix != open_key).any() else -1
                    if goes >= 0:
                        yield from build([*held, part.slice(0, goes)])
                        held, size, part = [], 0, part.slice(goes)
                held.append(part)
                size += part.column("words").nbytes
        if held:
            yield from build(held)

    return run


# ---------------------------------------------------------------- kept text

def _spans(removed: np.ndarray, first_word: np.ndarray) -> pa.Array:
    """Per document the runs of removed words as structs (start, end)."""
    edge = np.zeros(len(removed) + 1, bool)
    edge[first_word] = True
    wide = np.concatenate([[False], removed, [False]])
    begins = np.flatnonzero(wide[1:-1] & (~wide[:-2] | edge[:-1]))
    ends = np.flatnonzero(wide[1:-1] & (~wide[2:] | edge[1:])) + 1
    doc = np.searchsorted(first_word, begins, side="right") - 1
    base = first_word[doc]
    offs = np.searchsorted(begins, first_word)
    rows = pa.StructArray.from_arrays([pa.array(begins - base, pa.int64()), pa.array(ends - base, pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), rows)


def _kept(words: int, id_col: str):
    def run(key, bodies: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        for body in bodies.column("body").to_pylist():
            batch = _unpack(body)
            data, offs = utf8(batch.column(1))
            starts, ends, doc = word_spans(data, offs)
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            change = np.zeros(len(starts) + 1, np.int64)
            if marks.num_rows:
                ords = pa.chunked_array(marks.column("ords")).combine_chunks().flatten().to_numpy()
                begin = pa.chunked_array(marks.column("starts")).combine_chunks().flatten().to_numpy()
                whole = ords[begin == _WHOLE]
                np.add.at(change, first[whole], 1)
                np.add.at(change, first[whole + 1], -1)
                ords, begin = ords[begin != _WHOLE], begin[begin != _WHOLE]
                np.add.at(change, first[ords] + begin, 1)
                np.add.at(change, first[ords] + begin + words, -1)
            removed = np.cumsum(change)[:-1] > 0
            stay = ~removed
            lengths = (ends - starts)[stay]
            per_doc = np.concatenate([[0], np.cumsum(stay)])[first]
            close = np.cumsum(lengths + 1)
            text = np.full(int(close[-1]) if len(close) else 0, 0x20, np.uint8)
            inside = np.ones(len(text), bool)
            inside[close - 1] = False
            level = np.zeros(len(data) + 1, np.int8)
            level[starts[stay]] += 1
            level[ends[stay]] -= 1
            text[inside] = data[np.cumsum(level[:-1], dtype=np.int8).astype(bool)]
            close = np.concatenate([[0], close])[per_doc]
            raw = text.tobytes()
            kept = [raw[a:b - 1] if b > a else b"" for a, b in zip(close[:-1].tolist(), close[1:].tolist())]
            n = np.diff(first)
            out.append(pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(n - np.diff(per_doc), pa.int64()), _spans(removed, first),
                 pa.array(kept, pa.binary()).cast(pa.string())], [id_col, "n_words", "n_removed", "removed", "kept_text"]))
        return pa.Table.from_batches(out)

    return run


# ---------------------------------------------------------------- the operator

def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 20,
                   group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Per row (id, n_words, n_removed, removed, kept_text): ``removed`` holds the runs (start, end) of words
    covered by a window that stands earlier too, ``kept_text`` the other words joined by one space."""
    if words < 1:
        raise ValueError("a window has one word at least")
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    if not isinstance(id_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise ValueError(f"{id_col}: ids are integers")
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    blocks = written(named.mapInArrow(_blocks(words), _BLOCKS), "repeats-blocks")
    bodies = blocks.where("body IS NOT NULL").select("block", "body")

    same = Window.partitionBy("prefix")
    shared = (blocks.where("prefix IS NOT NULL").select("block", "prefix", "n")
              .withColumn("all", F.sum("n").over(same)).where("all > 1")
              .select("block", "prefix", (F.col("all") > group_limit).alias("hot"), F.lit(None).cast("int").alias("ord")))
    texts = blocks.where("digest IS NOT NULL").select("block", "ord", "id", "digest", (F.col("block") % _PARTS).alias("part"))
    copies = (_later(texts, ["digest"], ["id"])
              .select("block", F.lit(None).cast("long").alias("prefix"), F.lit(False).alias("hot"), "ord"))
    flags = shared.unionByName(copies)

    found = written(bodies.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(_suffixes(words), _SUFFIXES),
                    "repeats-suffixes")
    cold = found.where("words IS NOT NULL").select("block", "prefix", "ord", "id", "start", "before", "words")
    by_tree = cold.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_trees(words), _MARKS)
    windows = found.where("rest IS NOT NULL").select("block", "prefix", "rest", "ord", "id", "start",
                                                     (F.col("block") % _PARTS).alias("part"))
    by_window = (_later(windows, ["prefix", "rest"], ["id", "start"])
                 .select("block", F.array("ord").alias("ords"), F.array("start").alias("starts")))
    early = found.where("ords IS NOT NULL").select("block", "ords", "starts")
    marks = early.unionByName(by_tree).unionByName(by_window)

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("removed", span),
                           T.StructField("kept_text", T.StringType())])
    return bodies.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(_kept(words, id_col), schema)


def _later(rows: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """Rows that stand later than the earliest (by ``place``) of their ``keys``, in two rounds: first
    among the rows of one part, then among the parts' earliest ones."""
    at = F.struct(*place)
    one = rows.withColumn("__least", F.min(at).over(Window.partitionBy(*keys, "part")))
    firsts = one.where(at == F.col("__least"))
    two = firsts.withColumn("__least", F.min(at).over(Window.partitionBy(*keys)))
    return one.where(at > F.col("__least")).unionByName(two.where(at > F.col("__least"))).drop("__least")
