"""Phrase collocation mining by direct-address tiling.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at spaces and tabs;
phrases are runs of two to four words inside a piece. All is counted per language (null: ``und``).

1. Documents are gathered into blocks of one language. A block's words are numbered inside it; word counts over
   all blocks leave the words that stand ``least`` times, which are ranked by frequency and sent back, so that a
   block is a sequence of ranks.
2. Pairs of neighbouring ranks fall into tiles. Where both ranks are below ``HEAD``, a tile is a dense square of
   ``SIDE`` x ``SIDE`` cells counted by bincount at the cell's address; all other tiles are kept as sorted (cell,
   count) lists, packed into as many groups as the corpus asks for (``GROUP_WORDS``). Blocks count their own
   tiles, which are added up in rounds whose groups hold about ``CODES`` cells.
3. Pairs that stand ``least`` times are ranked by frequency in their turn and sent back to the blocks that hold
   them. A phrase of three is then a pair of (pair rank, word rank), one of four a pair of two pair ranks, counted
   in tiles as before.
4. Each phrase's cuts meet the counts of their parts; the lowest score counts. Phrases inside a longer one that
   is nearly as frequent go; each language's first ones are ranked.

Frequency ranks follow the count in steps of an eighth of an octave, then a hash: ranks are dealt out in many
parts, no task orders a language. Ranks below 2^31 a language are assumed (words and pairs that stand ``least`` times).

Cases: null and empty texts have no words; texts of any length are read whole; repeated rows are counted each;
ties in the order are broken by count and phrase; a null language is ``und``, together with that label itself. An
empty table gives an empty table. Other columns are not read, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import apart, slices, texts_of, utf8, written
from strata.llm.sharding import number_slots

#: Text bytes gathered before they are parted by language.
BLOCK_BYTES = 8 << 20
#: Ranks of the dense tiles and their side (a power of two).
HEAD, SIDE = 4096, 1024
#: Words of the corpus for each group of sparse tiles.
GROUP_WORDS = 4_000_000
#: Cells that one group of a merging round holds, about.
CODES = 1_000_000
#: Most merged tiles that a later round adds up at once.
FAN_IN = 16
#: Ranks on a side of a sparse tile: its address decides the tile's group.
_SPARSE_BITS = 11
_RANK_BITS = 31
_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_SEPARATORS
_IN_WORD[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_LONG, _INT, _STR, _BIN = T.LongType(), T.IntegerType(), T.StringType(), T.BinaryType()
_ARROW = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BinaryType: pa.binary()}


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(k, t) for k, t in columns.items()])


_BLOCKS = _schema(block=_LONG, lang=_STR, n_words=_LONG, body=_BIN, word=_STR, local=_INT, n=_LONG)
_TILES = _schema(block=_LONG, lang=_STR, body=_BIN, n=_INT, tile=_LONG, cells=_LONG, codes=_BIN, counts=_BIN)
_MERGED = _schema(lang=_STR, n=_INT, tile=_LONG, part=_LONG, cells=_LONG, codes=_BIN, counts=_BIN)
_FOUND = _schema(lang=_STR, n=_INT, tile=_LONG, x=_LONG, y=_LONG, f=_LONG)
_NAMED = _schema(block=_LONG, codes=_BIN, ranks=_BIN)


def _rows(schema: T.StructType, count: int, /, **columns) -> pa.RecordBatch:
    """``count`` rows with the named columns (a scalar is repeated), the others null."""
    arrays = []
    for f in schema:
        kind, given = _ARROW[type(f.dataType)], columns.get(f.name)
        if given is None:
            arrays.append(pa.nulls(count, kind))
        elif isinstance(given, (str, int)):
            arrays.append(pa.repeat(pa.scalar(given, kind), count))
        else:
            arrays.append(given.cast(kind) if isinstance(given, pa.Array) else pa.array(given, kind))
    return pa.RecordBatch.from_arrays(arrays, schema.names)


def pack(values: np.ndarray) -> bytes:
    """Long values as compressed differences."""
    raw = np.diff(values, prepend=0).astype("<i8").tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    return np.cumsum(np.frombuffer(pa.Codec("zstd").decompress(packed[8:], size, asbytes=True), "<i8"))


# ---------------------------------------------------------------- words of blocks

def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(words, whether a word begins a piece, its document) of some texts."""
    data, offs = utf8(texts)
    data = _LOWER[data]
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offs, starts, side="right") - 1
    marks = np.cumsum(_SEPARATORS[data])[starts]
    begins = np.ones(len(starts), bool)
    begins[1:] = (doc[1:] != doc[:-1]) | (marks[1:] != marks[:-1])
    ends = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    return words.dictionary_encode(), begins, doc


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for whole in batches:
        for part in slices(whole, "text", BLOCK_BYTES):
            own = len(utf8(texts_of(part, "text"))[0])
            if held and size + own > BLOCK_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.Table.from_batches(held)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for table in _gather(batches):
        named = table.column("lang").combine_chunks().dictionary_encode()
        own = named.indices.to_numpy()
        for k, lang in enumerate(named.dictionary.to_pylist()):
            texts = table.column("text").take(pa.array(np.flatnonzero(own == k))).combine_chunks().fill_null("")
            words, begins, _ = words_of(texts)
            if not len(words):
                continue
            local = words.indices.to_numpy().astype(np.int64)
            #: a word that begins a piece carries its number negated
            yield _rows(_BLOCKS, 1, block=number, lang=lang, n_words=len(local), body=[pack(np.where(begins, ~local, local))])
            counts = np.bincount(local)
            for at in range(0, len(counts), 50_000):
                part = np.arange(at, min(at + 50_000, len(counts)))
                yield _rows(_BLOCKS, len(part), block=number, lang=lang, word=words.dictionary.slice(at, len(part)),
                            local=part, n=counts[part])
            number += 1


# ---------------------------------------------------------------- tiles

def tiles_of(x: np.ndarray, y: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(tile, codes ascending, counts) of the pairs (x, y): dense tiles first, then the groups of sparse ones."""
    side, across = SIDE.bit_length() - 1, HEAD // SIDE
    head = (x < HEAD) & (y < HEAD)
    dx, dy = x[head], y[head]
    address = ((dx >> side) * across + (dy >> side)) * SIDE * SIDE + ((dx & (SIDE - 1)) << side | (dy & (SIDE - 1)))
    address = address[np.argsort(address >> 2 * side, kind="stable")]
    edge = np.searchsorted(address >> 2 * side, np.arange(across * across + 1))
    for tile in range(across * across):
        own = address[edge[tile]:edge[tile + 1]] & (SIDE * SIDE - 1)
        if len(own):
            dense = np.bincount(own, minlength=SIDE * SIDE)
            cell = np.flatnonzero(dense)
            yield tile, _codes(tile, cell), dense[cell]
    codes, counts = np.unique(x[~head] << _RANK_BITS | y[~head], return_counts=True)
    if len(codes):
        group = group_of(codes, groups)
        order = np.argsort(group, kind="stable")
        group, codes, counts = group[order], codes[order], counts[order]
        cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        for a, b in zip(cut[:-1], cut[1:]):
            yield across * across + int(group[a]), codes[a:b], counts[a:b]


def _codes(tile: int, cell: np.ndarray) -> np.ndarray:
    side, across = SIDE.bit_length() - 1, HEAD // SIDE
    return ((tile // across * SIDE) + (cell >> side)) << _RANK_BITS | ((tile % across * SIDE) + (cell & (SIDE - 1)))


def group_of(codes: np.ndarray, groups: int) -> np.ndarray:
    """Group of a sparse cell: its tile's address, hashed."""
    tile = (codes >> _RANK_BITS >> _SPARSE_BITS) * 0x2545F491 + ((codes & (1 << _RANK_BITS) - 1) >> _SPARSE_BITS) * 0x9E3779B1
    return (tile ^ tile >> 15) % groups


def add_up(tile: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One (codes, counts) of several: dense tiles at their addresses, sparse ones by sorting."""
    if tile < (HEAD // SIDE) ** 2:
        side = SIDE.bit_length() - 1
        dense = np.zeros(SIDE * SIDE, np.int64)
        for codes, counts in parts:
            dense[(codes >> _RANK_BITS & (SIDE - 1)) << side | (codes & (SIDE - 1))] += counts
        cell = np.flatnonzero(dense)
        return _codes(tile, cell), dense[cell]
    codes, counts = (np.concatenate(z) for z in zip(*parts))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    edge = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[edge], np.add.reduceat(counts, edge)


def _merge(key, table):
    """One row of the tiles of one part."""
    lang, n, tile, part = (k.as_py() for k in key)
    codes, counts = add_up(tile, [(unpack(a), unpack(b)) for a, b in zip(table.column("codes").to_pylist(),
                                                                        table.column("counts").to_pylist())])
    return pa.Table.from_batches([_rows(_MERGED, 1, lang=lang, n=n, tile=tile, part=part, cells=len(codes),
                                        codes=[pack(codes)], counts=[pack(counts)])])


def _frequent(least: int):
    def run(key, table):
        lang, n, tile = (k.as_py() for k in key)
        codes, counts = add_up(tile, [(unpack(a), unpack(b)) for a, b in zip(table.column("codes").to_pylist(),
                                                                            table.column("counts").to_pylist())])
        stay = counts >= least
        codes = codes[stay]
        return pa.Table.from_batches([_rows(_FOUND, len(codes), lang=lang, n=n, tile=tile, x=codes >> _RANK_BITS,
                                            y=codes & (1 << _RANK_BITS) - 1, f=counts[stay])])

    return run


def _per_part(tiles: DataFrame) -> int:
    """Rows whose cells make up a group of CODES cells."""
    size = tiles.agg(F.sum("cells").alias("cells"), F.count("*").alias("rows")).first()
    return max(2, CODES * (size["rows"] or 1) // max(1, size["cells"] or 1))


def frequent_pairs(tiles: DataFrame, blocks: int, least: int) -> DataFrame:
    """(lang, n, tile, x, y, f) of the pairs that stand ``least`` times; ``blocks`` bounds the rows a tile has."""
    parts = -(-blocks // _per_part(tiles))
    level = tiles.withColumn("part", F.pmod(F.hash("block"), F.lit(parts)).cast("long"))
    while parts > 1:
        level = level.groupBy("lang", "n", "tile", "part").applyInArrow(_merge, _MERGED)
        parts = -(-parts // FAN_IN)
        level = level.withColumn("part", F.col("part") % parts)
    return level.select("lang", "n", "tile", "codes", "counts").groupBy("lang", "n", "tile").applyInArrow(_frequent(least), _FOUND)


def ranked(counted: DataFrame, names: list[str], out: str) -> DataFrame:
    """``counted`` (lang, names, f) with a gapless rank from 0 in each language, the most frequent first."""
    step = -F.floor(F.log2(F.col("f")) * 8) * 64 + F.pmod(F.hash(*names), F.lit(64))
    return number_slots(counted, "lang", names, step.cast("long")).withColumnRenamed("slot", out)


# ---------------------------------------------------------------- passes over blocks

def _sequences(groups: int):
    """A block's words as ranks (-1: a gap, where phrases end), and the tiles of its pairs."""

    def run(key, bodies: pa.Table, ranks: pa.Table) -> pa.Table:
        block, out = key[0].as_py(), [_rows(_TILES, 0)]
        for lang, body in zip(bodies.column("lang").to_pylist(), bodies.column("body").to_pylist()):
            local = unpack(body)
            begins = local < 0
            local = np.where(begins, ~local, local)
            rank = np.full(int(local.max()) + 1, -1, np.int64)
            rank[ranks.column("local").to_numpy()] = ranks.column("rank").to_numpy()
            seq = np.full(len(local) + int(begins.sum()), -1, np.int64)
            seq[np.arange(len(local)) + np.cumsum(begins)] = rank[local]
            gap = seq < 0
            seq = seq[~(gap & np.concatenate([[True], gap[:-1]]))]
            out.append(_rows(_TILES, 1, block=block, lang=lang, body=[pack(seq)]))
            x, y = seq[:-1], seq[1:]
            both = (x >= 0) & (y >= 0)
            out += _tile_rows(block, lang, 2, x[both], y[both], groups)
        return pa.Table.from_batches(out)

    return run


def _tile_rows(block: int, lang: str, n: int, x: np.ndarray, y: np.ndarray, groups: int) -> list[pa.RecordBatch]:
    made = list(tiles_of(x, y, groups))
    if not made:
        return []
    return [_rows(_TILES, len(made), block=block, lang=lang, n=n, tile=[t for t, _, _ in made], cells=[len(c) for _, c, _ in made],
                  codes=[pack(c) for _, c, _ in made], counts=[pack(k) for _, _, k in made])]


def _name_pairs(key, own: pa.Table, pairs: pa.Table) -> pa.Table:
    """For every block's tile: the ranks of its frequent pairs."""
    out = [_rows(_NAMED, 0)]
    if own.num_rows and pairs.num_rows:
        codes = pairs.column("x").to_numpy() << _RANK_BITS | pairs.column("y").to_numpy()
        order = np.argsort(codes)
        codes, ranks = codes[order], pairs.column("pair").to_numpy()[order]
        for block, packed in zip(own.column("block").to_pylist(), own.column("codes").to_pylist()):
            here = unpack(packed)
            at = np.minimum(np.searchsorted(codes, here), len(codes) - 1)
            stay = codes[at] == here
            if stay.any():
                out.append(_rows(_NAMED, 1, block=block, codes=[pack(here[stay])], ranks=[pack(ranks[at[stay]])]))
    return pa.Table.from_batches(out)


def _longer(groups: int):
    """The tiles of a block's phrases of three (pair, word) and four (pair, pair)."""

    def run(key, bodies: pa.Table, named: pa.Table) -> pa.Table:
        block, out = key[0].as_py(), [_rows(_TILES, 0)]
        if named.num_rows:
            codes = np.concatenate([unpack(c) for c in named.column("codes").to_pylist()])
            ranks = np.concatenate([unpack(c) for c in named.column("ranks").to_pylist()])
            order = np.argsort(codes)
            codes, ranks = codes[order], ranks[order]
            for lang, body in zip(bodies.column("lang").to_pylist(), bodies.column("body").to_pylist()):
                seq = unpack(body)
                here = seq[:-1] << _RANK_BITS | seq[1:]
                at = np.minimum(np.searchsorted(codes, here), len(codes) - 1)
                pair = np.where((codes[at] == here) & (seq[:-1] >= 0) & (seq[1:] >= 0), ranks[at], -1)
                three = (pair[:-1] >= 0) & (pair[1:] >= 0)
                out += _tile_rows(block, lang, 3, pair[:-1][three], seq[2:][three], groups)
                four = three[:-1] & three[1:]
                out += _tile_rows(block, lang, 4, pair[:-2][four], pair[2:][four], groups)
        return pa.Table.from_batches(out)

    return run


# ---------------------------------------------------------------- the operator

def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(phrases, sizes): (lang, phrase, n_words, f) of all phrases of one to four words that stand ``least`` times in a
    language, and (lang, n): its number of words."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    named = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    read = written(named.mapInArrow(_blocks, _BLOCKS), "phrase-blocks")
    bodies = read.where("body IS NOT NULL").select("block", "lang", "n_words", "body")
    sizes = bodies.groupBy("lang").agg(F.sum("n_words").alias("n"))
    total = bodies.agg(F.count("*").alias("blocks"), F.sum("n_words").alias("words")).first()
    blocks, groups = total["blocks"], -(-(total["words"] or 1) // GROUP_WORDS)

    words = (read.where("word IS NOT NULL").select("block", "lang", "word", "local", "n")
             .withColumn("f", F.sum("n").over(Window.partitionBy("lang", "word"))).where(F.col("f") >= least).drop("n"))
    words = written(words, "phrase-words")
    one = written(ranked(words.groupBy("lang", "word").agg(F.first("f").alias("f")), ["word"], "rank"), "phrase-ranks")
    local = words.select("block", "local", "lang", "word").join(one.select("lang", "word", "rank"), ["lang", "word"])
    tiles = written(bodies.groupBy("block").cogroup(apart(local.select("block", "local", "rank")).groupBy("block"))
                    .applyInArrow(_sequences(groups), _TILES), "phrase-pairs")
    pair_tiles = tiles.where("codes IS NOT NULL")
    two = frequent_pairs(pair_tiles, blocks, least)
    two = written(ranked(two.select("lang", "tile", "x", "y", "f"), ["x", "y"], "pair"), "phrase-pair-ranks")

    parts = -(-blocks // _per_part(pair_tiles))
    own = pair_tiles.select("block", "lang", "tile", "codes", F.pmod(F.hash("block"), F.lit(parts)).alias("part"))
    asked = own.select("lang", "tile", "part").distinct()
    sent = two.select("lang", "tile", "x", "y", "pair").join(asked, ["lang", "tile"])
    keys = ["lang", "tile", "part"]
    back = own.groupBy(*keys).cogroup(apart(sent).groupBy(*keys)).applyInArrow(_name_pairs, _NAMED)
    sequences = tiles.where("body IS NOT NULL").select("block", "lang", "body")
    more = written(sequences.groupBy("block").cogroup(apart(back).groupBy("block")).applyInArrow(_longer(groups), _TILES), "phrase-longer")
    longer = written(frequent_pairs(more, blocks, least), "phrase-counts")

    def text_of(df: DataFrame, key: str, table: DataFrame, rank: str, text: str, out: str) -> DataFrame:
        names = table.select(F.col("lang"), F.col(rank).alias(key), F.col(text).alias(out))
        return df.join(names, ["lang", key]).drop(key)

    word = one.select("lang", "rank", "word")
    pair = text_of(text_of(two, "x", word, "rank", "word", "a"), "y", word, "rank", "word", "b")
    pair = written(pair.select("lang", "pair", F.concat_ws(" ", "a", "b").alias("phrase"), "f"), "phrase-pair-texts")
    three = text_of(text_of(longer.where("n = 3"), "x", pair, "pair", "phrase", "a"), "y", word, "rank", "word", "b")
    four = text_of(text_of(longer.where("n = 4"), "x", pair, "pair", "phrase", "a"), "y", pair, "pair", "phrase", "b")
    joined = F.concat_ws(" ", "a", "b").alias("phrase")
    counted = [one.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("n_words"), "f"),
               pair.select("lang", "phrase", F.lit(2).alias("n_words"), "f"),
               three.select("lang", joined, F.lit(3).alias("n_words"), "f"),
               four.select("lang", joined, F.lit(4).alias("n_words"), "f")]
    out = counted[0]
    for df in counted[1:]:
        out = out.unionByName(df)
    return written(out, "phrases"), sizes


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, top: int = 2000,
                 covered: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases. ``a``, ``l``, ``r`` are the counts of the
    phrase and of the parts of its lowest-scoring cut, score is floor(2000000 * a / (l + r)); a phrase inside a
    longer one that has at least ``covered`` percent of its count is left out."""
    grams, sizes = phrases(docs, lang_col, text_col, least)
    candidates = grams.where("n_words > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))

    def part(first, size) -> F.Column:
        return F.array_join(F.slice("w", first, size), " ")

    k = F.col("k")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
            .select("lang", "phrase", "a", "k", part(F.lit(1), k).alias("head"), part(k + 1, F.col("n_words") - k).alias("tail")))
    for name, out in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(grams.select("lang", F.col("phrase").alias(name), F.col("f").alias(out)), ["lang", name])
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div CAST(l + r AS DECIMAL(20,0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "m.score", "m.l", "m.r")

    spans = F.expr("""flatten(transform(sequence(2, n_words - 1), s ->
        transform(sequence(1, n_words - s + 1), at -> array_join(slice(w, at, s), ' '))))""")
    inside = (candidates.where("n_words > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (scored.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                            F.col("score").cast("long").alias("score"))
