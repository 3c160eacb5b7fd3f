"""Cross-tokenizer alignment by inverted pair bitmaps.

Every text is read by two tokenizers, A (byte-level BPE) over a space and the text, B (pieces with byte
fallback, which adds that space itself) over the text. Both cut the same bytes: an A token and a B
token are *linked* where their byte ranges overlap, and the offsets where both end cut the tokens into
groups. How often a pair of ids is linked in the whole corpus scores each link.

1. Texts are cut into units at places where both tokenizers must cut: before a single space, around a
   single newline, and between a letter or digit and a mark that no piece of B joins to one. A unit is
   encoded once and remembered (two generations of ``CACHE_UNITS``); the unit's links are gathered
   for every place it stands.
2. Documents are numbered inside blocks. A block holds, per id pair, bitmaps over its documents: plane ``j``
   has the documents whose number of links of the pair has bit ``j`` set. A bitmap is kept as sorted
   16-bit numbers or as bits, whichever is shorter; those of a block's slices are OR-merged.
3. The planes' popcounts, weighted by 2^j, add up to a pair's links, the popcount of their union to its
   documents (blocks share no document). The highest link count of each B id is marked.
4. Each posting takes its pair's score back to its block, where the planes hand it to the documents.

Cases: null and empty texts, and texts whose joined token bytes differ from space + text (B reads U+2581
as a space), have no tokens: zeros and ''. Texts of any length are read whole; special-token strings are
plain text; repeated rows are counted each; ids of any type are carried along, null too. An empty
table gives an empty table. Other columns are not read, so their names clash with nothing.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import apart, ascending, expand_runs, slices, texts_of, unit_cuts, utf8, written

#: Text bytes and documents of a block (a longer text makes a block of its own).
BLOCK_BYTES, BLOCK_DOCS = 16 << 20, 1 << 16
#: Units that a worker remembers.
CACHE_UNITS = 400_000
#: Marks that may end a word; those that a piece of B joins to a letter or digit are not used as cuts.
_MARKS = b".,;:!?*$%&#\")|"
_SHIFT = 16
_HEAD = struct.Struct("<BI")


# ---------------------------------------------------------------- two tokenizers over units

class Units(dict):
    """Unit -> (ids of A, ids of B, groups), ids as little-endian 32-bit bytes, groups as text; None where the joined
    bytes of a tokenizer differ from the unit."""

    def __init__(self, a_ranks: str, b_model: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        with open(a_ranks, "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self._a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                    special_tokens={}).encode_ordinary
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for x, y in ranks.items():
            self.a_bytes[y] = x
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        whole = [p for i, p in enumerate(pieces) if not self._b.is_byte(i) and not self._b.is_control(i)]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in whole):
            raise ValueError("tokenizer B has pieces across spaces or newlines")
        joined = {y for p in whole for x, y in zip(p, p[1:]) if x.isascii() and x.isalnum()}
        self.mark = np.zeros(256, bool)
        self.mark[[m for m in _MARKS if chr(m) not in joined]] = True
        self._older: dict = {}

    def look_up(self, units: list[bytes]) -> list:
        """The entries of ``units``; missing ones are encoded together."""
        found = [self.get(u, 0) for u in units]
        missing = [k for k, x in enumerate(found) if x == 0]
        fresh = []
        for k in missing:
            old = self._older.get(units[k], 0)
            if old == 0:
                fresh.append(k)
            else:
                found[k] = old
        if fresh:
            for k, entry in zip(fresh, self._encode([units[k] for k in fresh])):
                found[k] = entry
        if len(self) + len(missing) > CACHE_UNITS // 2:
            self._older = dict(self)
            self.clear()
        for k in missing:
            if len(units[k]) <= 64:
                self[units[k]] = found[k]
        return found

    def _encode(self, units: list[bytes]) -> list:
        """A newline is a piece of its own (behind the space that B adds), so it serves to encode what no
        space precedes."""
        texts = [u.decode() for u in units]
        spaced = [t[0] == " " for t in texts]
        b_ids = self._b.encode([t[1:] if s else "\n" + t for t, s in zip(texts, spaced)], num_threads=1)
        out = []
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        for unit, text, s, b in zip(units, texts, spaced, b_ids):
            a = self._a(text)
            b = b if s else b[2:]
            parts_a, parts_b = [a_bytes[i] for i in a], [b_bytes[i] for i in b]
            if b"".join(parts_a) != unit or b"".join(parts_b) != unit:
                out.append(None)
                continue
            groups, at_a, at_b, i, j, i0, j0 = [], 0, 0, 0, 0, 0, 0
            while i < len(a):
                at_a += len(parts_a[i])
                i += 1
                while j < len(b) and at_b < at_a:
                    at_b += len(parts_b[j])
                    j += 1
                if at_a == at_b:
                    groups.append(f"{','.join(map(str, a[i0:i]))}|{','.join(map(str, b[j0:j]))}")
                    i0, j0 = i, j
            out.append((np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes(), ";".join(groups)))
        return out


_units: dict = {}


def units_of(a_ranks: str, b_model: str) -> Units:
    if (a_ranks, b_model) not in _units:
        _units[a_ranks, b_model] = Units(a_ranks, b_model)
    return _units[a_ranks, b_model]


# ---------------------------------------------------------------- blocks

class Block:
    """Documents of one block and their links, slice by slice."""

    def __init__(self):
        self.docs = self.bytes = 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, base: int, code: np.ndarray, doc: np.ndarray, times: np.ndarray) -> None:
        self.keys.append(code.astype(np.int64) << _SHIFT | (doc + base))
        self.times.append(times)

    def planes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(pair code, documents, links, planes) of every pair."""
        if not any(map(len, self.keys)):
            e = np.zeros(0, np.int64)
            return e, e, e, []
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        code, doc = keys >> _SHIFT, (keys & 0xFFFF).astype("<u2")
        edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        pairs, n = code[edge], len(edge)
        docs = np.diff(np.append(edge, len(code)))
        links = np.add.reduceat(times, edge)
        out: list[list[bytes]] = [[] for _ in range(n)]
        pair = np.repeat(np.arange(n), docs)
        empty = _HEAD.pack(0, 0)
        for j in range(int(times.max()).bit_length()):
            own = (times >> j & 1).astype(bool)
            here, raw = pair[own], doc[own].tobytes()
            if not len(here):
                continue
            first = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
            for p, a, b in zip(here[first].tolist(), first.tolist(), np.append(first[1:], len(here)).tolist()):
                if 16 * (b - a) > self.docs:
                    bits = np.zeros(self.docs, bool)
                    bits[np.frombuffer(raw, "<u2", b - a, 2 * a)] = True
                    body = _HEAD.pack(1, (self.docs + 7) // 8) + np.packbits(bits).tobytes()
                else:
                    body = _HEAD.pack(0, 2 * (b - a)) + raw[2 * a:2 * b]
                out[p] += [empty] * (j - len(out[p])) + [body]
        return pairs, docs, links, [b"".join(parts) for parts in out]


def documents_of(planes: bytes) -> Iterator[tuple[int, bytes | np.ndarray]]:
    """(plane number, document numbers as raw 16-bit bytes or array) of one pair's planes."""
    at = j = 0
    while at < len(planes):
        kind, size = _HEAD.unpack_from(planes, at)
        at += _HEAD.size
        body = planes[at:at + size]
        yield j, (np.flatnonzero(np.unpackbits(np.frombuffer(body, np.uint8))).astype("<u2").tobytes() if kind else body)
        at += size
        j += 1


def _csr(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) // 4 for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), "<i4").astype(np.int64), lengths


class Reader:
    """Counts, groups and links of the documents of a slice."""

    def __init__(self, a_ranks: str, b_model: str):
        self.units = units_of(a_ranks, b_model)

    def read(self, texts: pa.Array):
        """(n_a, n_b, n_groups, n_links, groups or None, link codes, their documents, their multiplicities)."""
        n = len(texts)
        filled = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        spaced = pc.if_else(pa.array(filled), pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar("")), texts)
        data, offs = utf8(spaced)
        zero = np.zeros(n, np.int64)
        if not len(data):
            e = np.zeros(0, np.int64)
            return zero, zero, zero, zero, [None] * n, e, e, e
        inner = unit_cuts(data, offs, self.units.mark)
        cuts = np.concatenate([[0], inner[(inner > 0) & (inner < len(data))], [len(data)]]).astype(np.int32)
        buffer = pa.py_buffer(np.ascontiguousarray(data))
        named = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), buffer]).dictionary_encode()
        unit = named.indices.to_numpy().astype(np.int64)
        doc = np.searchsorted(offs, cuts[:-1], side="right") - 1
        entries = self.units.look_up(named.dictionary.to_pylist())
        fits = np.array([x is not None for x in entries])
        good = filled & (np.bincount(doc, ~fits[unit], n) == 0)
        entries = [x or (b"", b"", "") for x in entries]
        a_ids, n_a = _csr([x[0] for x in entries])
        b_ids, n_b = _csr([x[1] for x in entries])
        a_end, b_end = np.cumsum(self.units.a_length[a_ids]), np.cumsum(self.units.b_length[b_ids])
        ends = ascending(np.concatenate([a_end, b_end]))
        both = b_end[np.minimum(np.searchsorted(b_end, a_end), len(b_end) - 1)] == a_end if len(b_end) else np.zeros(0, bool)
        code = a_ids[np.searchsorted(a_end, ends)] << 15 | b_ids[np.searchsorted(b_end, ends)]
        unit_end = np.concatenate([[0], a_end])[np.cumsum(n_a)]
        n_links = np.diff(np.searchsorted(ends, unit_end, side="right"), prepend=0)
        n_groups = np.diff(np.concatenate([[0], np.cumsum(both)])[np.cumsum(n_a)], prepend=0)

        def per_doc(values):
            return np.where(good, np.bincount(doc, values[unit], n).astype(np.int64), 0)

        sizes = np.bincount(doc, minlength=n)
        groups = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                          pa.array([x[2] for x in entries], pa.string()).take(pa.array(unit)))
        groups = pc.if_else(pa.array(good), pc.binary_join(groups, ";"), None).to_pylist()
        stays = good[doc]
        where, times = np.unique(doc[stays] * len(entries) + unit[stays], return_counts=True)
        own, at = where // len(entries), where % len(entries)
        many = n_links[at]
        link = code[expand_runs((np.cumsum(n_links) - n_links)[at], many)]
        key, back = np.unique(link << 32 | np.repeat(own, many), return_inverse=True)
        total = np.bincount(back, np.repeat(times, many), len(key)).astype(np.int64)
        return (per_doc(n_a), per_doc(n_b), per_doc(n_groups), per_doc(n_links), groups,
                key >> 32, key & 0xFFFFFFFF, total)


def _read_documents(a_ranks: str, b_model: str, schema: T.StructType, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, number = Reader(a_ranks, b_model), TaskContext.get().partitionId() << 32
        kinds = None
        block = Block()

        def rows(n: int, /, **columns):
            return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds],
                                              [k for k, _ in kinds])

        def postings():
            pairs, docs, links, planes = block.planes()
            for at in range(0, len(pairs), 20_000):
                part = slice(at, at + 20_000)
                own = pairs[part]
                yield rows(len(own), block=np.full(len(own), number), a=own >> 15, b=own & 0x7FFF, docs=docs[part],
                           links=links[part], planes=planes[part])

        for whole in batches:
            if kinds is None:
                types = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BinaryType: pa.binary()}
                kinds = [("id", whole.schema.field("id").type), *[(f.name, types[type(f.dataType)]) for f in schema.fields[1:]]]
            for part in slices(whole, "text"):
                texts = texts_of(part, "text")
                size = len(utf8(texts)[0])
                at = 0
                while at < part.num_rows:  # never more documents than a block numbers
                    if block.docs and (block.bytes + size > BLOCK_BYTES or block.docs >= BLOCK_DOCS):
                        yield from postings()
                        block, number = Block(), number + 1
                    here = part.slice(at, BLOCK_DOCS - block.docs)
                    own = texts.slice(at, len(here))
                    n_a, n_b, n_groups, n_links, groups, code, doc, times = reader.read(own)
                    block.add(block.docs, code, doc, times)
                    named = [("" if g is None else hashlib.sha256(g.encode()).hexdigest()) if digest else g or "" for g in groups]
                    yield rows(len(here), id=here.column("id"), block=np.full(len(here), number),
                               ord=block.docs + np.arange(len(here)), n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links,
                               groups=named)
                    block.docs += len(here)
                    block.bytes += size
                    at += len(here)
        if block.docs:
            yield from postings()

    return run


def _return_scores(names: list[str]):
    """Of one block: every document's sums over the planes of the block's postings."""

    def run(docs: pa.Table, postings: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        n = docs.num_rows
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        bodies, sizes, weight, tops = [], [], [], []
        for planes, count, top in zip(*(postings.column(c).to_pylist() for c in ("planes", "count", "best"))):
            for j, raw in documents_of(planes):
                bodies.append(raw)
                sizes.append(len(raw) // 2)
                weight.append(count << j)
                tops.append(top << j)
        if bodies:
            at = np.frombuffer(b"".join(bodies), "<u2")
            np.add.at(total, at, np.repeat(np.array(weight, np.int64), sizes))
            np.add.at(best, at, np.repeat(np.array(tops, np.int64), sizes))
        place = docs.column("ord").to_numpy()
        out = docs.drop_columns(["block", "ord"]).append_column("n_best", pa.array(best[place]))
        return out.append_column("count_sum", pa.array(total[place])).select(names)

    return run


# ---------------------------------------------------------------- the operator

def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_ranks: str | None = None,
          b_model: str | None = None, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). documents: id, n_a, n_b, n_groups, n_links, n_best (links whose pair has its B id's highest
    count), count_sum (counts of all links), groups (``a,a|b;a|b,b``, or its SHA-256 if ``digest``). pairs: a, b,
    links, docs, best (0 or 1)."""
    import public_tokenizers
    a_ranks = a_ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    b_model = b_model or public_tokenizers.path("piece_bpe_32k.model")
    long, i32 = T.LongType(), T.IntegerType()
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), *[T.StructField(c, t) for c, t in (
        ("block", long), ("ord", i32), ("n_a", long), ("n_b", long), ("n_groups", long), ("n_links", long),
        ("groups", T.StringType()), ("a", i32), ("b", i32), ("docs", long), ("links", long), ("planes", T.BinaryType()))]])
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    read = written(named.mapInArrow(_read_documents(a_ranks, b_model, schema, digest), schema), "alignment")
    postings = read.where("planes IS NOT NULL").select("block", "a", "b", "docs", "links", "planes")
    pairs = postings.groupBy("a", "b").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    highest = F.max("links").over(Window.partitionBy("b"))
    pairs = written(pairs.withColumn("best", (F.col("links") == highest).cast("long")), "alignment-pairs")

    scored = postings.join(pairs.select("a", "b", F.col("links").alias("count"), "best"), ["a", "b"])
    texts = read.where("planes IS NULL").select("id", "block", "ord", "n_a", "n_b", "n_groups", "n_links", "groups")
    out = T.StructType([*[texts.schema[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links")], T.StructField("n_best", long),
                        T.StructField("count_sum", long), texts.schema["groups"]])
    found = (texts.groupBy("block").cogroup(apart(scored.select("block", "planes", "count", "best")).groupBy("block"))
             .applyInArrow(_return_scores(out.names), out))
    return found.withColumnRenamed("id", id_col), pairs
