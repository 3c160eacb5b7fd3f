"""Document fingerprints by invertible Bloom lookup sketches.

A text is cut into paragraph pieces (at newlines and sentence ends, and where a piece is long, at places that its
own bytes name, so that a line without marks or a script without spaces gives many pieces too); each distinct piece is a
64-bit digest, put into one cell of each of three sub-tables. A cell holds a count and the xor
of its digests and of their check hashes. Subtracting the sketches of two versions leaves only
what differs; peeling cells that hold a single digest recovers it. If peeling gets stuck, the
two are sketched anew at twice the size, until it succeeds.

The sketches of a run of documents are built, subtracted and peeled together in numpy.

Cases: null and empty texts have no pieces and one common fingerprint; two texts without pieces
have likeness 1; repeated pieces of a text count once; texts of any length are read whole; an
empty table gives an empty table; other columns of the input are not read. Ids are integers. In ``versions``: null ids stand after all others, rows equal in
id are ordered by length and hash of the text (after which they are interchangeable), and a
single row is its own successor.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SLICE_BYTES, mix64, span_hashes, starts_code_point, utf8

#: Cells of a stored fingerprint; a multiple of the three sub-tables.
CELLS = 24
HASHES = 3
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Text bytes per range partition of ``versions``.
RANGE_BYTES = 16 << 20

#: Pieces of more bytes are cut again, at one of so many words and one of so many other characters.
LONG, WORD_CUT, ANY_CUT = 200, 8, 64
_END = np.zeros(256, bool)
_END[list(b".!?")] = True


def pieces_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(digest, document) of the distinct paragraph pieces, ordered by document and digest."""
    data, offs = utf8(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    cut = data == 10
    cut[1:] |= (data[1:] == 32) & _END[data[:-1]]
    starts = np.unique(np.concatenate([offs[:-1], np.flatnonzero(cut) + 1]))
    starts = starts[starts < len(data)]
    doc = np.searchsorted(offs, starts, side="right") - 1
    at = np.flatnonzero(cut)
    ends = np.minimum(np.append(at, len(data))[np.searchsorted(at, starts)], offs[doc + 1])
    full = ends > starts
    starts, ends, doc = _cut_long(data, starts[full], ends[full], doc[full])
    keys = span_hashes(data, starts, ends)
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return keys[new], doc[new]


def _cut_long(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray):
    """Pieces of more than LONG bytes cut where the hash of the eight bytes before a character says so: what stands
    elsewhere in the piece does not move the cuts."""
    long = ends - starts > LONG
    if not long.any():
        return starts, ends, doc
    level = np.zeros(len(data) + 1, np.int8)
    level[starts[long]] += 1
    level[ends[long]] -= 1
    at = np.flatnonzero(np.cumsum(level[:-1], dtype=np.int8).astype(bool) & starts_code_point(data))
    begin = starts[np.searchsorted(starts, at, side="right") - 1]
    at = at[at - begin >= 8]
    before = np.zeros(len(at), np.uint64)
    for k in range(1, 9):
        before = (before << np.uint64(8)) | data[at - k].astype(np.uint64)
    h = mix64(before)
    word = data[at - 1] == 32
    cut = at[np.where(word, h % np.uint64(WORD_CUT) == 0, h % np.uint64(ANY_CUT) == 0)]
    again = np.unique(np.concatenate([starts, cut]))
    own = np.searchsorted(starts, again, side="right") - 1
    last = np.append(again[1:], 0)
    last = np.where(np.append(own[1:] == own[:-1], False), last, ends[own])
    return again, last, doc[own]


def check_hash(keys: np.ndarray) -> np.ndarray:
    return mix64(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)


def cells_of(keys: np.ndarray, table: np.ndarray, first: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """(HASHES, keys): the cells of each key in its table, which starts at ``first`` and has
    ``cells`` cells in equal sub-tables."""
    sub = (cells[table] // HASHES).astype(np.uint64)
    return np.stack([first[table] + k * sub.astype(np.int64) + (mix64(keys + _SEEDS[k]) % sub).astype(np.int64)
                     for k in range(HASHES)])


class Sketches:
    """One sketch per table, of ``cells[t]`` cells each."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.first = np.cumsum(cells) - cells
        n = int(cells.sum())
        self.count, self.keys, self.checks = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)

    def add(self, keys: np.ndarray, table: np.ndarray, sign: np.ndarray | int) -> None:
        """Add (sign 1) or subtract (-1) digests; subtracting sketches is adding with -1."""
        checks = check_hash(keys)
        for at in cells_of(keys, table, self.first, self.cells):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, checks)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digest, table, sign) of all that can be recovered, and which tables came out empty."""
        owner = np.repeat(np.arange(len(self.cells)), self.cells)
        got: list[tuple] = []
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[check_hash(self.keys[at]) == self.checks[at]]
            if not len(at):
                break
            keys, table, sign = self.keys[at], owner[at], self.count[at]
            order = np.lexsort((keys, table))
            new = np.ones(len(order), bool)
            new[1:] = (keys[order][1:] != keys[order][:-1]) | (table[order][1:] != table[order][:-1])
            pick = order[new]
            keys, table, sign = keys[pick], table[pick], sign[pick]
            got.append((keys, table, sign))
            self.add(keys, table, -sign)
        dirty = (self.count != 0) | (self.keys != 0)
        clean = np.bincount(owner[dirty], minlength=len(self.cells)) == 0
        parts = [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, t) for t in (np.uint64, np.int64, np.int64)]
        return (*parts, clean)


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], pairs: int,
                cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digest, pair, sign) of what differs between side ``a`` (+1) and side ``b`` (-1) of every
    pair; each side is (digests, pair index). Pairs whose sketch does not peel are sketched
    again at twice the cells until all do."""
    out: list[tuple] = []
    todo, size = np.arange(pairs), cells
    while len(todo):
        place = np.full(pairs, -1)
        place[todo] = np.arange(len(todo))
        s = Sketches(np.full(len(todo), size))
        for (keys, pair), sign in ((a, 1), (b, -1)):
            mine = place[pair] >= 0
            s.add(keys[mine], place[pair[mine]], sign)
        keys, table, sign, clean = s.peel()
        good = clean[table]
        out.append((keys[good], todo[table[good]], sign[good]))
        todo, size = todo[~clean], 2 * size
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], pairs: int) -> np.ndarray:
    """Jaccard likeness of the piece sets of every pair, from sizes and the recovered difference."""
    differ = np.bincount(differences(a, b, pairs)[1], minlength=pairs)
    total = np.bincount(a[1], minlength=pairs) + np.bincount(b[1], minlength=pairs)
    return np.where(total > 0, (total - differ) / np.maximum(total + differ, 1), 1.0)


def fingerprints(pieces: tuple[np.ndarray, np.ndarray], texts: int, cells: int = CELLS) -> list[str]:
    """The stored form: pieces, cells, then count (2 bytes), digest xor (8), check xor (4) per cell."""
    s = Sketches(np.full(texts, cells))
    s.add(*pieces, 1)
    sizes = np.bincount(pieces[1], minlength=texts)
    raw = np.zeros(texts * cells, [("n", "<u2"), ("k", "<u8"), ("c", "<u4")])
    raw["n"], raw["k"], raw["c"] = s.count & 0xFFFF, s.keys, s.checks
    step = raw.itemsize * cells
    packed = raw.tobytes()
    return [f"{n}:{cells}:" + base64.b64encode(packed[i * step:(i + 1) * step]).decode()
            for i, n in enumerate(sizes.tolist())]


def fingerprint(texts: list[str], cells: int = CELLS) -> list[str]:
    array = pa.array(texts, pa.string())
    return fingerprints(pieces_of(array), len(texts), cells)


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many code points of the start of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


# ------------------------------------------------------------------ documents and their successors

def in_ranges(docs: DataFrame, id_col: str, text_col: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(range, ahead, id, text): the documents in descending order of id, cut into ranges of about
    ``range_bytes``, one to a partition and sorted there and followed by the first document of the next
    range (``ahead`` = 1; after the last range: of the first). One shuffle of the texts; only the
    range bounds, which are ids, come to the driver."""
    key, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(key.alias("id"), text.alias("text"))
    size, least, most = rows.agg(F.sum(F.octet_length("text")), F.min("id"), F.max("id")).first()
    ranges = max(1, -(-(size or 0) // range_bytes))
    bounds = [least, most]
    if most is not None and ranges > 1:
        at = [k / ranges for k in range(1, ranges)]
        bounds += rows.agg(F.percentile_approx("id", at, 100 * ranges)).first()[0]
    firsts = np.array(sorted({b for b in bounds[1:] if b is not None}), np.int64)  # largest id of every range

    @F.arrow_udf("struct<range: int, head: boolean>")
    def place(ids: pa.Array) -> pa.Array:
        # ranges count from the largest id down; null ids close the last range
        known, values = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        if not len(firsts):
            at, head = np.zeros(len(ids), np.int32), np.ones(len(ids), bool)
        else:
            up = np.searchsorted(firsts, values)
            at = np.where(known, len(firsts) - 1 - up, len(firsts) - 1).astype(np.int32)
            head = known & (firsts[np.minimum(up, len(firsts) - 1)] == values)
        return pa.StructArray.from_arrays([pa.array(at), pa.array(head)], ["range", "head"])

    placed = (rows.withColumn("p", place("id"))
              .select(F.col("p.range").alias("range"), F.lit(0).alias("ahead"), "id", "text", F.col("p.head").alias("head")))
    n = max(1, len(firsts))
    ahead = placed.where("head").select(F.pmod(F.col("range") - 1, F.lit(n)).alias("range"), F.lit(1).alias("ahead"), "id", "text")
    return (placed.drop("head").unionByName(ahead).repartitionById(n, F.col("range"))
            .sortWithinPartitions("range", "ahead", F.col("id").desc_nulls_last(), F.length("text"), F.xxhash64("text")))


OUT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
       "near_next double")


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """Per document: its fingerprint, that of its edited version (last third replaced by the start
    of the next document), and how like it is to that version and to the next document."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def block(rows: list[tuple]) -> pa.RecordBatch:
        """``rows``: (id, text, text of the next)."""
        n = len(rows)
        both = [r[1] for r in rows], [edited(r[1], r[2]) for r in rows], [r[2] for r in rows]
        own, new, following = (pieces_of(pa.array(x, pa.string())) for x in both)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], kind), pa.array([len(x) for x in both[0]], pa.int64()),
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in both[1]]), pa.array(fingerprints(own, n, cells)),
             pa.array(fingerprints(new, n, cells)), pa.array(likeness(own, new, n)), pa.array(likeness(own, following, n))],
            [id_col, *[x.split()[0] for x in OUT.split(", ")]])

    kind = pa.int64() if id_type == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        last = None  # the row before: (range, ahead, id, text)
        for batch in batches:
            for small in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                for now in zip(*[c.to_pylist() for c in small.columns]):
                    if last is not None and last[1] == 0 and last[0] == now[0]:
                        rows.append((last[2], last[3], now[3]))
                        held += len(last[3])
                    last = now
                    if held >= SLICE_BYTES:
                        yield block(rows)
                        rows, held = [], 0
        if rows:
            yield block(rows)

    return in_ranges(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {OUT}")
