"""Vector bin packing of examples into training sequences.

Every example asks for tokens, one segment and loss-bearing tokens at once. A task streams
its share of the examples through a bounded pool and fills one sequence after another: the
next piece is the one whose demand has the largest dot product with what the sequence has
left (demands weighted by the pool's mean demand), among those that fit all three limits; when
none fits and enough room is left, the best one is cut. Nothing is shuffled: tasks pack
independently, and each leaves at most one sequence part-filled.

Token ids are those of the public 50k byte-level BPE as its ``tokenizers`` file gives them, special-token
strings included; they are computed through its rank file. A slice of texts is cut where the BPE must
cut (before single spaces, around single newlines, between words and marks, around special tokens), each distinct unit is
looked up or encoded once, and the ids of the texts are gathered.

Cases: a null or empty text is one end token; texts of any length are cut into as many
pieces as needed; repeated rows are packed as often as they stand; a null id is carried
along; an empty table gives an empty table; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import ascending, expand_runs, slices, texts_of, unit_cuts, utf8

END_ID = 1
#: Units whose ids a worker remembers.
CACHE_UNITS = 500_000
#: Text bytes whose units are looked up together.
SLICE_BYTES = 4 << 20
#: Pieces waiting in a task.
POOL = 1024
#: A piece is cut to fill a sequence only if so many tokens are left in it.
LEAST_CUT = 16
#: Limits of the packing query and stage beside the tokens: pieces and loss-bearing ids of a sequence of 2,048; the first
#: line of a text is its prompt.
PACKING_LIMITS = {"segments": 64, "loss": 2016, "prompt_line": True}

_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?*$%&#\")|")] = True


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_specials() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts. Two generations of CACHE_UNITS / 2 units are remembered: frequent ones survive when
    the older generation is forgotten."""

    def __init__(self, ranks_path: str, specials_path: str):
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(specials_path, "rb") as f:
            added = json.load(f)["added_tokens"]
        self._encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        self._specials = {t["content"].encode(): int(t["id"]) for t in added}
        self._special = re.compile(b"|".join(map(re.escape, sorted(self._specials, key=len, reverse=True))) or b"(?!)")
        self._cache: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def _ids(self, units: list[bytes]) -> list[bytes]:
        out, fresh, cache, older = [], {}, self._cache, self._older
        for unit in units:
            ids = cache.get(unit)
            if ids is None:
                ids = older.get(unit)
                if ids is None:
                    special = self._specials.get(unit)
                    ids = array("I", self._encode(unit.decode()) if special is None else [special]).tobytes()
                if len(unit) <= 64:
                    fresh[unit] = ids
            out.append(ids)
        if len(cache) + len(fresh) > CACHE_UNITS // 2:
            self._older, self._cache = cache, fresh
        else:
            cache.update(fresh)
        return out

    def _around_specials(self, data: np.ndarray, offs: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """``cuts`` with the special tokens as units of their own."""
        raw, at, spans = data.tobytes(), 0, []
        while m := self._special.search(raw, at):
            inside = int(np.searchsorted(offs, m.start(), side="right")) == int(np.searchsorted(offs, m.end() - 1, side="right"))
            if inside:
                spans.append((m.start(), m.end()))
            at = m.end() if inside else m.start() + 1
        if not spans:
            return cuts
        starts, ends = map(np.array, zip(*spans))
        k = np.searchsorted(starts, cuts, side="right") - 1
        within = (k >= 0) & (cuts < ends[np.maximum(k, 0)])
        return ascending(np.concatenate([cuts[~within], starts, ends]))

    def encode_batch(self, texts: pa.Array, end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, prompt): the ids of all texts, the id END_ID behind each if ``end``; where a text's ids begin (and
        the end of all); how many of them come before its second line, 0 if it has but one."""
        n = len(texts)
        data, offs = utf8(texts)
        if len(data):
            inner = self._around_specials(data, offs, unit_cuts(data, offs, _MARK))
            cuts = np.concatenate([[0], inner[(inner > 0) & (inner < len(data))], [len(data)]]).astype(np.int32)
        else:
            ids = np.full(n if end else 0, END_ID, "<u4")
            return ids, np.arange(n + 1) if end else np.zeros(n + 1, np.int64), np.zeros(n, np.int64)
        named = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
        named = named.dictionary_encode()
        unit = named.indices.to_numpy().astype(np.int64)
        known = self._ids(named.dictionary.to_pylist())
        many = np.array([len(x) // 4 for x in known], np.int64)
        flat = np.frombuffer(b"".join(known), "<u4")
        ids = flat[expand_runs((np.cumsum(many) - many)[unit], many[unit])]
        upto = np.concatenate([[0], np.cumsum(many[unit])])
        begin = np.searchsorted(cuts[:-1], offs)
        first = upto[begin]
        line = np.flatnonzero(data == 10)
        at = np.append(line, len(data))[np.searchsorted(line, offs[:-1])]
        second = upto[np.searchsorted(cuts[:-1], at, side="right")]
        prompt = np.where(at < offs[1:], second - first[:-1], 0)
        if end:
            own = np.repeat(np.arange(n), np.diff(first))
            out = np.full(len(ids) + n, END_ID, "<u4")
            out[np.arange(len(ids)) + own] = ids
            ids, first = out, first + np.arange(n + 1)
        return ids, first, prompt


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(ranks_path: str, specials_path: str) -> Encoder:
    if (ranks_path, specials_path) not in _encoders:
        _encoders[ranks_path, specials_path] = Encoder(ranks_path, specials_path)
    return _encoders[ranks_path, specials_path]


class Packer:
    """Streams pieces in, gives placed pieces out; memory is bounded by POOL pieces.

    A piece is [example, start, ids (bytes), loss]: ``loss`` counts its trailing loss-bearing ids."""

    def __init__(self, tokens: int, segments: int, loss: int):
        if min(tokens, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.room = np.array([tokens, segments, loss], np.int64)
        self.demand = np.zeros((POOL, 3))
        self.items: list = [None] * POOL
        self.free = list(range(POOL - 1, -1, -1))
        self.sequence = 0

    def add(self, example, ids: bytes, loss: int) -> Iterator[tuple]:
        """Cut an example into pieces that fit an empty sequence; fill sequences as the pool fills."""
        n, at = len(ids) // 4, 0
        while at < n:
            size = self._largest(n - at, loss, self.room)
            bears = max(0, size - (n - at - loss))
            if not self.free:
                yield from self.fill()
            self._put([example, at, ids[4 * at:4 * (at + size)], bears])
            loss -= bears
            at += size

    @staticmethod
    def _largest(n: int, loss: int, room: np.ndarray) -> int:
        """Most leading ids of a piece of ``n`` (the last ``loss`` of them bearing loss) that fit."""
        size = min(n, int(room[0]))
        return min(size, n - loss + int(room[2]))

    def _put(self, item: list) -> None:
        k = self.free.pop()
        self.items[k] = item
        self.demand[k] = (len(item[2]) // 4, 1, item[3])

    def _take(self, k: int) -> list:
        item, self.items[k] = self.items[k], None
        self.demand[k] = 0
        self.free.append(k)
        return item

    def fill(self) -> Iterator[tuple]:
        """One sequence: (sequence, offset, segment, example, start, ids, loss) of its pieces."""
        left, offset, segment = self.room.astype(float), 0, 0
        full = np.maximum(self.room, 1).astype(float)
        mean = self.demand.sum(0) / (full * max(1, POOL - len(self.free)))
        weight = mean / full / full
        live = self.demand[:, 1] > 0
        while live.any() and left[0] > 0 and left[1] > 0:
            fits = live & (self.demand <= left).all(1)
            if fits.any():
                score = np.where(fits, self.demand @ (weight * left), -1.0)
                k = int(score.argmax())
                item = self._take(k)
            else:
                k = int(np.where(live, self.demand @ (weight * left), -1.0).argmax())
                n, loss = len(self.items[k][2]) // 4, self.items[k][3]
                size = self._largest(n, loss, left.astype(np.int64))
                if size < LEAST_CUT:
                    break
                example, start, ids, _ = self._take(k)
                head = max(0, size - (n - loss))
                item = [example, start, ids[:4 * size], head]
                self._put([example, start + size, ids[4 * size:], loss - head])
                k = -1
            if k >= 0:
                live[k] = False
            else:
                live = self.demand[:, 1] > 0
            n = len(item[2]) // 4
            yield (self.sequence, offset, segment, *item)
            left -= (n, 1, item[3])
            offset += n
            segment += 1
        self.sequence += 1

    def drain(self) -> Iterator[tuple]:
        while len(self.free) < POOL:
            yield from self.fill()


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
                   tokens: int = 2048, segments: int = 1024, loss: int | None = None, prompt_line: bool = False,
                   with_ids: bool = False, ranks_path: str | None = None, specials_path: str | None = None) -> DataFrame:
    """Pieces (id, start, length, loss_tokens, ids_crc32, doc_tokens, sequence_id, segment, offset
    [, ids]) of all examples. An example is its prompt's ids (no loss), its text's ids and the end
    id; a sequence holds at most ``tokens`` ids, ``segments`` pieces and ``loss`` loss-bearing ids. With ``prompt_line``
    the first line of a text of several lines is a prompt too (up to the unit that holds the newline)."""
    ranks, specials = ranks_path or default_vocabulary(), specials_path or default_specials()
    most_loss = tokens if loss is None else loss
    names = [id_col, text_col, *([prompt_col] if prompt_col else [])]
    base = docs.select(*[F.col(f"`{c}`") for c in names])
    long, i32 = T.LongType(), T.ArrayType(T.IntegerType())
    plain = [("start", long), ("length", long), ("loss_tokens", long), ("ids_crc32", long), ("doc_tokens", long),
             ("sequence_id", long), ("segment", long), ("offset", long)]
    schema = T.StructType([base.schema[id_col], *[T.StructField(n, t) for n, t in plain],
                           *([T.StructField("ids", i32)] if with_ids else [])])

    def emit(placed: list[tuple], first: int, kind: pa.DataType) -> pa.RecordBatch:
        seq, off, seg, example, start, ids, bears = zip(*placed)
        arrays = [pa.array([e[0] for e in example], kind), pa.array(start, pa.int64()),
                  pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(bears, pa.int64()),
                  pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([e[1] for e in example], pa.int64()),
                  pa.array([first + s for s in seq], pa.int64()), pa.array(seg, pa.int64()), pa.array(off, pa.int64())]
        if with_ids:
            arrays.append(pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, [f.name for f in schema.fields])

    def examples(batch: pa.RecordBatch) -> Iterator[tuple]:
        """(key, ids, how many of them, from the end, bear loss) of every row."""
        encode = encoder(ranks, specials).encode_batch
        keys = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
        ids, first, prompt = encode(texts_of(batch, text_col))
        raw, first = memoryview(ids.tobytes()), first.tolist()
        silent = prompt.tolist() if prompt_line else [0] * len(keys)
        if prompt_col:
            asked, ask, _ = encode(texts_of(batch, prompt_col), end=False)
            before, ask = memoryview(asked.tobytes()), ask.tolist()
        for i, key in enumerate(keys):
            own = bytes(raw[4 * first[i]:4 * first[i + 1]])
            bears = len(own) // 4 - silent[i]
            yield key, bytes(before[4 * ask[i]:4 * ask[i + 1]]) + own if prompt_col else own, bears

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(tokens, segments, most_loss)
        first = TaskContext.get().partitionId() << 36
        done: list[tuple] = []
        kind = None
        for whole in batches:
            kind = whole.schema.field(id_col).type
            for batch in slices(whole, text_col, SLICE_BYTES):
                for key, ids, bears in examples(batch):
                    done.extend(packer.add((key, len(ids) // 4), ids, bears))
                if done:
                    yield emit(done, first, kind)
                    done = []
        done.extend(packer.drain())
        if done:
            yield emit(done, first, kind)

    return base.mapInArrow(run, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The columns that name, check and place a piece."""
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                         "segment", "loss_tokens")
