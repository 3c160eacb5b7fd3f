"""N-gram Jaccard join on a prefix tree.

A document's set are its distinct word n-grams, hashed to 63 bits and globally ordered (rare
tokens by hash, then frequent ones by rising count). Two sets link when their Jaccard likeness reaches the threshold.

1. One pass reads sets' sizes, digests, min-hashes and compressed texts, and sums up frequent tokens. Equal
   sets are collapsed into classes; the smallest id represents a class. Only representatives go on;
   their texts are bucketed by id, so that later steps join narrow rows to them in place.
2. Sets that share a min-hash are compared with one of their number, which ties most groups of
   near copies together into components.
3. The first branching of the tree is dealt over the cluster: every set is filed under the
   tokens of its prefix (two sets that link share one). Under a token, sets that are alone in
   their component are paired; a set and a larger component are named together once, however many
   members of it stand there. A candidate goes on only if the tokens shared in the prefixes
   plus what remains behind them could reach the required overlap. Tokens of ``CROWD`` documents or
   more are paired by joins, which no task holds; so a token of one component gives nothing.
4. Below, a task holds a prefix tree of about ``TREE_SETS`` sets (partners of a probe, or a part of a
   component) and walks it with each probe: overlaps of shared paths are counted once, and a subtree
   is passed in one step when the overlap so far plus the lengths remaining below cannot reach what is required.
   This is exact; of a component one link is enough.

No pair inside a component is ever written out, and no set is paired with each member of one.
Frequent tokens are named by a mergeable summary of ``SUMMARY`` counters (a bounded broadcast);
any choice of them gives the same links, only at a different cost.

Cases: texts without words (null, empty, white space) have no set and stand alone; fewer than
``n`` words make one n-gram; repeated rows and rows with one id are one document (linked to all
that any of their texts links to, rows of it without words included); rows with a null id take no part and have a null component;
an empty table gives an empty table; texts are read whole; other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (BYTE_VALUE_LOWER, mix64, slices, span_hashes, texts_of, utf8, window_hashes, word_spans, written)
from strata.llm.components import components
from strata.session import scratch_path

#: Counters of a task's summary of frequent tokens, and tokens taken as frequent at most.
SUMMARY, FREQUENT = 1 << 20, 1 << 18
#: Least count (documents) of a frequent token.
FREQUENT_LEAST = 32
#: Count (documents) from which a token's rows are joined instead of held by one task.
CROWD = 4096
#: Min-hashes per set for the first round.
SEEDS = mix64(np.arange(1, 5, dtype=np.uint64))
#: Sets in one prefix tree, probes that walk it in one task, tokens between two bound checks on a path.
TREE_SETS, PROBES, STRIDE = 64, 512, 64
_HEAVY = np.uint64(1 << 63)


# ------------------------------------------------------------------ sets

def shingle_sets(texts: pa.Array, n: int, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, offsets): each text's distinct n-grams in global order: by hash, then those in
    ``frequent`` (tokens, rarest first), which are replaced by their rank behind all hashes."""
    data, offs = utf8(texts)
    starts, ends, doc = word_spans(data, offs)
    words = span_hashes(data, starts, ends, BYTE_VALUE_LOWER)
    count = np.bincount(doc, minlength=len(texts))
    grams = window_hashes(words, n)
    whole = doc[:len(grams)] == doc[n - 1:] if len(grams) else np.zeros(0, bool)
    tokens, owner = [grams[whole]], [doc[:len(grams)][whole]]
    for k in range(1, n):  # texts of k < n words: the whole sequence is one n-gram
        few = np.flatnonzero(count == k)
        if len(few):
            first = np.searchsorted(doc, few)
            rows = np.stack([words[first + i] for i in range(k)], 1).ravel()
            tokens.append(mix64(window_hashes(rows, k)[::k] + np.uint64(k)))
            owner.append(few)
    token, owner = np.concatenate(tokens) >> np.uint64(1), np.concatenate(owner)
    if frequent is not None and len(frequent) and len(token):
        by_hash = np.argsort(frequent)
        at = by_hash[np.minimum(np.searchsorted(frequent, token, sorter=by_hash), len(frequent) - 1)]
        token = np.where(frequent[at] == token, at.astype(np.uint64) | _HEAVY, token)
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[new], owner[new]
    return token, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def required(a, b, percent: int):
    """Least overlap of sets of sizes a and b with ``100 * overlap >= percent * union``."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n, percent: int):
    """Tokens of a set of size n of which one at least is shared by every set it links to."""
    return n - (-(-percent * n // 100)) + 1


class Summary:
    """Counts of a task's tokens: beyond SUMMARY counters those below the cut are dropped and the cut
    subtracted, so summaries stay mergeable by addition."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.room = SUMMARY

    def add(self, token: np.ndarray) -> None:
        self.waiting.append(token)
        self.room -= len(token)
        if self.room <= 0:
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        new, many = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.room = [], SUMMARY
        self.keys, inverse = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        self.counts = np.bincount(inverse, weights=np.concatenate([self.counts, many])).astype(np.int64)
        if len(self.keys) > SUMMARY:
            self.counts = self.counts - np.partition(self.counts, -SUMMARY - 1)[-SUMMARY - 1]
            self.keys, self.counts = self.keys[self.counts > 0], self.counts[self.counts > 0]

    def often(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        return self.keys[self.counts > 1], self.counts[self.counts > 1]


def profiles(docs: DataFrame, n: int) -> DataFrame:
    """All that is read off the texts, in one pass. Rows of documents: (doc_id, n_shingles, s1, s2, mins,
    body), size, 128-bit digest, min-hashes and compressed text of every set. Rows of tokens: (token,
    documents), each task's summary of frequent tokens."""
    names = ["doc_id", "n_shingles", "s1", "s2", "mins", "body", "token", "documents"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64()]

    def rows(**given) -> pa.RecordBatch:
        many = len(next(iter(given.values())))
        return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(many, t)) for c, t in zip(names, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_, summary = zstandard.ZstdCompressor(3).compress, Summary()
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = texts_of(batch, "text")
                token, offs = shingle_sets(texts, n)
                summary.add(token)
                size = np.diff(offs)
                has, first = size > 0, offs[:-1][size > 0]
                s1, s2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
                mins = np.zeros((len(size), len(SEEDS)), np.uint64)
                if len(first):
                    s1[has] = np.add.reduceat(mix64(token), first)
                    s2[has] = np.bitwise_xor.reduceat(mix64(token + SEEDS[0]), first)
                    for k, seed in enumerate(SEEDS):
                        mins[has, k] = np.minimum.reduceat(mix64(token ^ seed), first)
                body = [zip_(t.encode()) if full else None for t, full in zip(texts.to_pylist(), has)]
                yield rows(doc_id=batch.column(0), n_shingles=pa.array(size), s1=pa.array(s1.view(np.int64)),
                           s2=pa.array(s2.view(np.int64)), body=pa.array(body, pa.binary()),
                           mins=pa.ListArray.from_arrays(np.arange(0, mins.size + 1, len(SEEDS), dtype=np.int32),
                                                         pa.array(mins.view(np.int64).ravel())))
        token, count = summary.often()
        for at in range(0, len(token), 100_000):
            yield rows(token=pa.array(token[at:at + 100_000].view(np.int64)), documents=pa.array(count[at:at + 100_000]))

    return docs.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, mins array<long>, body binary, token long, documents long")


def frequent_tokens(summary: DataFrame, least: int) -> np.ndarray:
    """Tokens that stand in at least ``least`` documents by the tasks' summaries (token, documents), rarest first; at
    most FREQUENT tokens come to the driver."""
    top = (summary.groupBy("token").agg(F.sum("documents").alias("n")).where(F.col("n") >= least)
           .orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").toArrow())
    return top["token"].to_numpy().view(np.uint64)[::-1].copy()


# ------------------------------------------------------------------ the prefix tree

class PrefixTree:
    """A compressed trie of ordered token sets, its nodes in preorder. Node k stands for the sets
    ``first`` to ``last`` (in lexicographic order), which share their tokens up to ``end``; ``start`` is
    where its parent ends. It carries the least and the greatest length below it and ``past``, the next
    node that is not below it, so that a pruned subtree is passed in one step."""

    def __init__(self, names: list, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.names, self.sets = [names[i] for i in order], [sets[i] for i in order]
        shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            shared.append(int(differ[0]) if len(differ) else m)
        length = [len(s) for s in self.sets]
        self.nodes: list[list[int]] = []  # level, first, last, start, end, least, most, past
        todo = [(0, 0, len(sets), 0)] if sets else []
        while todo:
            level, first, last, start = todo.pop()
            end = min(shared[first + 1:last], default=length[first])
            self.nodes.append([level, first, last, start, end, min(length[first:last]), max(length[first:last]), 0])
            child = first
            while child < last and length[child] == end:  # sets that end here
                child += 1
            cuts = [j for j in range(child + 1, last) if shared[j] == end]
            below = [(level + 1, a, b, end) for a, b in zip([child, *cuts], [*cuts, last]) if a < b]
            todo.extend(reversed(below))
        for k in reversed(range(len(self.nodes))):
            past = k + 1
            while past < len(self.nodes) and self.nodes[past][0] > self.nodes[k][0]:
                past = self.nodes[past][7]
            self.nodes[k][7] = past

    def linked(self, probe: np.ndarray, percent: int) -> Iterator[tuple]:
        """(name, overlap) of the sets that link to ``probe``."""
        path = [(0, 0)]  # by level: overlap and probe tokens passed above the nodes of that level
        k = 0
        while k < len(self.nodes):
            level, first, last, depth, end, least, most, past = self.nodes[k]
            overlap, passed = path[level]
            while True:
                # of all lengths below, the one that leaves as many tokens as the probe has left comes closest
                best = min(max(depth + len(probe) - passed, least), most)
                if overlap + min(best - depth, len(probe) - passed) < required(len(probe), best, percent):
                    k = past
                    break
                if depth < end:
                    part = self.sets[first][depth:min(depth + STRIDE, end)]
                    at = np.searchsorted(probe[passed:], part) + passed
                    hit = probe[np.minimum(at, len(probe) - 1)] == part
                    overlap, passed, depth = overlap + int(hit.sum()), int(at[-1]) + int(hit[-1]), depth + len(part)
                    continue
                for i in range(first, last):
                    if len(self.sets[i]) > end:
                        break
                    if overlap >= required(len(probe), end, percent):
                        yield self.names[i], overlap
                path[level + 1:] = [(overlap, passed)]
                k += 1
                break


# ------------------------------------------------------------------ candidate pairs

def class_bodies(named: DataFrame, reps: DataFrame, name: str) -> DataFrame:
    """(rep, body): compressed text of every representative, bucketed by id in the table ``name``: joins of
    narrow rows with it on ``rep`` leave it in place. Of rows that share id and set, one stays."""
    spark = named.sparkSession
    packed = named.select(F.col("doc_id").alias("rep"), "s1", "body")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = reps.select(F.col("rep").alias("r"), F.col("s1").alias("r1"))
    # equality as an xor: the join is by ``rep`` alone, and what it deals out is the buckets
    kept = (packed.repartition(buckets, "rep").join(r, F.col("rep") == F.col("r"))
            .where(F.col("s1").bitwiseXOR(F.col("r1")) == 0).groupBy("rep", "s1").agg(F.min("body").alias("body")))
    (kept.select("rep", "body").write.bucketBy(buckets, "rep")
     .option("path", scratch_path(spark, "jaccard-bodies")).saveAsTable(name))
    return spark.table(name)


def hub_pairs(reps: DataFrame) -> DataFrame:
    """(a, b): every set with the smallest id among those that share one of its min-hashes."""
    keys = reps.select(F.col("rep").alias("b"), F.posexplode("mins").alias("k", "m"))
    hubs = keys.groupBy("k", "m").agg(F.min("b").alias("a"), F.max("b").alias("z")).where("a < z").select("k", "m", "a")
    return keys.join(hubs, ["k", "m"]).where("a < b").select("a", "b").distinct()


def crowded_candidates(filed: DataFrame, percent: int) -> DataFrame:
    """What ``filed_candidates`` pairs under one token, for tokens whose rows no task should hold: joins whose
    groups Spark streams and splits. A component is one row under a token before anything meets it, so a
    token under which all sets are of one component gives nothing; sets alone in theirs meet by
    (token, length class), neighbouring classes only."""
    many = (filed.where("members > 1").groupBy(F.col("token").alias("t"), F.col("component").alias("other"))
            .agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("members").alias("m")))
    smaller = (F.col("members") < F.col("m")) | ((F.col("members") == F.col("m")) & (F.col("component") < F.col("other")))
    fits = (100 * F.col("n") >= percent * F.col("lo")) & (100 * F.col("hi") >= percent * F.col("n"))
    against = (filed.join(many, (F.col("token") == F.col("t")) & smaller & fits)
               .select(F.col("rep").alias("z"), "other", F.col("n").alias("nz"), "lo", "hi", F.lit(True).alias("whole")))
    # a little wider than the ratio of linked lengths: no pair is two classes apart by rounding
    step = 1.001 * max(math.log(100 / percent), 0.01)
    one = filed.where("members = 1").select("token", "n", "rep", F.floor(F.log("n") / step).alias("c"))
    small = one.select(F.col("token").alias("t"), F.col("n").alias("n1"), F.col("rep").alias("r1"),
                       F.explode(F.array("c", F.col("c") + 1)).alias("c1"))
    before = (F.col("n1") < F.col("n")) | ((F.col("n1") == F.col("n")) & (F.col("r1") < F.col("rep")))
    first = F.col("r1") < F.col("rep")
    alone = (one.join(small, (F.col("token") == F.col("t")) & (F.col("c") == F.col("c1")) & before
                      & (100 * F.col("n1") >= percent * F.col("n")) & (F.col("r1") != F.col("rep")))
             .select(F.least("r1", "rep").alias("z"), F.greatest("r1", "rep").alias("other"),
                     F.when(first, F.col("n1")).otherwise(F.col("n")).alias("nz"),
                     F.when(first, F.col("n")).otherwise(F.col("n1")).alias("lo")).withColumn("hi", F.col("lo"))
             .withColumn("whole", F.lit(False)))
    return against.unionByName(alone)


def filed_candidates(bodies: DataFrame, member: DataFrame, n: int, percent: int, frequent: np.ndarray,
                     crowded: int) -> DataFrame:
    """(z, other, whole, shared): what could link by the tokens shared in the prefixes. ``other`` is a
    set when it and ``z`` are alone in their components (``whole`` false), else the larger of their
    components (size, then id). ``member`` is (rep, component, members). The last ``crowded`` of the
    ``frequent`` tokens go by joins, all others by task."""
    spark = bodies.sparkSession
    heavy = spark.sparkContext.broadcast(frequent)  # FREQUENT tokens at most

    crowd = _HEAVY | np.uint64(max(0, len(frequent) - crowded))  # ranks rise with the count

    def file(batches: Iterator[pa.RecordBatch], among_crowded: bool) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = pa.array([unzip(b).decode() for b in batch.column(3).to_pylist()], pa.string())
                token, offs = shingle_sets(texts, n, heavy.value)
                size = np.diff(offs)
                take = prefix_length(size, percent) * (size > 0)
                rows = np.repeat(np.arange(len(size)), take)
                within = np.arange(len(rows)) - np.repeat(np.cumsum(take) - take, take)
                prefix = token[offs[rows] + within]
                these = (prefix >= crowd) == among_crowded
                rows, prefix = rows[these], prefix[these]
                of = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix.view(np.int64)), pa.array(size[rows]), batch.column(0).take(of),
                     batch.column(1).take(of), batch.column(2).take(of)], ["token", "n", "rep", "component", "members"])

    def alone(token: np.ndarray, size: np.ndarray, rep: np.ndarray) -> Iterator[tuple]:
        """Pairs of rows of one token whose lengths allow a link; rows come by token and size."""
        at, step = np.arange(len(token)), 1
        while len(at):  # row i against row i + step
            at = at[at + step < len(token)]
            at = at[token[at] == token[at + step]]
            at = at[100 * size[at] >= percent * size[at + step]]  # later partners are larger still
            p, q = at, at + step
            swap = rep[p] > rep[q]
            p, q = np.where(swap, q, p), np.where(swap, p, q)
            yield rep[p], rep[q], size[p], size[q], size[q]
            step += 1

    def against(token: np.ndarray, size: np.ndarray, rep: np.ndarray, comp: np.ndarray, members: np.ndarray) -> Iterator[tuple]:
        """A row and every larger component that stands under its token, once."""
        many = np.flatnonzero(members > 1)
        if not len(many):
            return
        many = many[np.lexsort((size[many], comp[many], token[many]))]
        new = np.concatenate([[True], (token[many][1:] != token[many][:-1]) | (comp[many][1:] != comp[many][:-1])])
        first, last = many[new], many[np.append(np.flatnonzero(new)[1:] - 1, len(many) - 1)]
        begin, end = np.searchsorted(token, token[first]), np.searchsorted(token, token[first], side="right")
        at = 0
        while at < len(first):  # about a million rows at a time
            width = np.cumsum(end[at:] - begin[at:])
            upto = at + max(1, int(np.searchsorted(width, 1 << 20)))
            count = (end - begin)[at:upto]
            c = np.repeat(np.arange(at, upto), count)
            z = np.arange(len(c)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[at:upto], count)
            big, lo, hi = first[c], size[first[c]], size[last[c]]
            fits = (members[z] < members[big]) | ((members[z] == members[big]) & (comp[z] < comp[big]))
            fits &= (100 * size[z] >= percent * lo) & (100 * hi >= percent * size[z])
            yield rep[z[fits]], comp[big[fits]], size[z[fits]], lo[fits], hi[fits]
            at = upto

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["z", "other", "nz", "lo", "hi", "whole"]

        def give(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            token, size, rep, comp, members = cols
            # tokens under which all sets are of one component have nothing to compare
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            mixed = np.maximum.reduceat(comp, first) != np.minimum.reduceat(comp, first)
            keep = np.repeat(mixed, np.diff(np.append(first, len(token))))
            token, size, rep, comp, members = (c[keep] for c in (token, size, rep, comp, members))
            one = members == 1
            for found, whole in ((alone(token[one], size[one], rep[one]), False), (against(token, size, rep, comp, members), True)):
                for got in found:
                    for k in range(0, len(got[0]), 200_000):
                        part = [x[k:k + 200_000] for x in got]
                        yield pa.RecordBatch.from_arrays([*map(pa.array, part), pa.array(np.full(len(part[0]), whole))], names)

        held: list[np.ndarray] = []
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, cols)] if held else cols
            done = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if done:
                yield from give([c[:done] for c in held])
                held = [c[done:] for c in held]
        if held and len(held[0]):
            yield from give(held)

    sets = bodies.join(member, "rep").select("rep", "component", "members", "body")
    schema = "token long, n long, rep long, component long, members long"
    found = (sets.mapInArrow(lambda batches: file(batches, False), schema)
             .repartition("token").sortWithinPartitions("token", "n")
             .mapInArrow(pair, "z long, other long, nz long, lo long, hi long, whole boolean"))
    if crowded:  # few rows: only these are written, all others go straight into the shuffle
        filed = written(sets.mapInArrow(lambda batches: file(batches, True), schema), "jaccard-crowded")
        found = found.unionByName(crowded_candidates(filed, percent))

    def short_of(n_other) -> F.Column:
        """Tokens that the prefixes must share, given what remains behind the longer one."""
        behind = lambda x: F.ceil(F.lit(percent) * x / 100) - 1
        return (F.ceil(F.lit(percent) * (F.col("nz") + n_other) / (100 + percent))
                - F.greatest(behind(F.col("nz")), behind(n_other)))

    # of a component, the sizes that could link at all. Up to nz the bound rises with the size; above it falls,
    # but for the rounding of its two terms, which puts a size below hi at most one under the bound of hi
    lo = F.greatest(F.col("lo"), F.ceil(F.lit(percent) * F.col("nz") / 100))
    hi = F.least(F.col("hi"), F.floor(F.lit(100) * F.col("nz") / percent))
    least = F.least(short_of(lo), short_of(hi) - (lo < hi).cast("long"))
    # texts of several sizes under one id have no common bound: the trees decide
    return (found.groupBy("z", "other", "whole").agg(F.count("*").alias("shared"), F.max("nz").alias("nz"), F.min("nz").alias("least_nz"),
                                                     F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .where((F.col("least_nz") < F.col("nz")) | ((lo <= hi) & (F.col("shared") >= least)))
            .select("z", "other", "whole", "shared"))


def pair_requests(pairs: DataFrame) -> DataFrame:
    """(whole, key, tree, part, role, rep): the sets (role 0) and probes (role 1) of the trees that
    decide the pairs (z, other). The end of a pair with more partners probes."""
    ends = pairs.select(F.col("z").alias("x")).unionByName(pairs.select(F.col("other").alias("x"))).groupBy("x").agg(F.count("*").alias("d"))
    turned = (pairs.select("z", "other").join(ends.select(F.col("x").alias("z"), F.col("d").alias("dz")), "z")
              .join(ends.select(F.col("x").alias("other"), F.col("d").alias("do")), "other")
              .select(F.when(F.col("dz") >= F.col("do"), F.col("z")).otherwise(F.col("other")).alias("key"),
                      F.when(F.col("dz") >= F.col("do"), F.col("other")).otherwise(F.col("z")).alias("rep"),
                      F.greatest("dz", "do").alias("d"))
              .withColumn("tree", F.pmod(F.xxhash64("rep"), F.ceil(F.col("d") / TREE_SETS))))
    probes = turned.select("key", "tree").distinct().withColumn("rep", F.col("key"))
    named = lambda df, role: df.select(F.lit(False).alias("whole"), "key", "tree", F.lit(0).cast("long").alias("part"),
                                       F.lit(role).alias("role"), "rep")
    return named(turned, 0).unionByName(named(probes, 1))


def component_requests(probes: DataFrame, member: DataFrame) -> DataFrame:
    """The same for probes ``z`` of components ``other``: a component is dealt into trees, a component
    with many probes into as many copies of each tree as bound the probes of a task."""
    asked = (probes.groupBy(F.col("other").alias("key")).agg(F.count("*").alias("asked"))
             .join(member.groupBy(F.col("component").alias("key")).agg(F.count("*").alias("sets")), "key")
             .select("key", F.ceil(F.col("sets") / TREE_SETS).alias("trees"), F.ceil(F.col("asked") / PROBES).alias("parts")))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    sets = (member.select(F.col("component").alias("key"), "rep").join(asked, "key")
            .withColumn("tree", F.pmod(F.xxhash64("rep"), F.col("trees"))).withColumn("part", upto("parts")))
    walkers = (probes.select(F.col("other").alias("key"), F.col("z").alias("rep")).join(asked, "key")
               .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))).withColumn("tree", upto("trees")))
    named = lambda df, role: df.select(F.lit(True).alias("whole"), "key", "tree", "part", F.lit(role).alias("role"), "rep")
    return named(sets, 0).unionByName(named(walkers, 1))


def verified(requests: DataFrame, bodies: DataFrame, n: int, percent: int) -> DataFrame:
    """(u, v): the links found by walking the requested trees: all of a probe's partners, and one set of
    a component's tree."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        key, names, sets, tree = None, [], [], None
        for whole in batches:
            found: list[tuple] = []
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                *parts, roles, reps, packed = (c.to_pylist() for c in batch.columns)
                token, offs = shingle_sets(pa.array([unzip(b).decode() for b in packed], pa.string()), n)
                for i, here in enumerate(zip(*parts)):
                    if here != key:
                        key, names, sets, tree = here, [], [], None
                    own = token[offs[i]:offs[i + 1]].copy()
                    if roles[i] == 0:
                        names.append(reps[i])
                        sets.append(own)
                        continue
                    tree = tree or PrefixTree(names, sets)
                    for name, _ in tree.linked(own, percent):
                        found.append((reps[i], name))
                        if key[0]:
                            break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], ["u", "v"])

    dealt = ["whole", "key", "tree", "part"]
    return (bodies.select("rep", "body").join(requests, "rep").select(*dealt, "role", "rep", "body")
            .repartition(*dealt).sortWithinPartitions(*dealt, "role", "rep").mapInArrow(walk, "u long, v long"))


# ------------------------------------------------------------------ the join

def join(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id",
         text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, links).

    ``documents``: (doc_id, n_shingles, class_id, component_id) per row. ``classes``: (class_id,
    n_shingles, copies). ``links``: (u, v) between class representatives, enough to connect every
    component (pairs inside a component are not compared once it is connected)."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    read = written(profiles(docs, n), "jaccard-profiles")
    prof = read.where(F.col("documents").isNull()).select("doc_id", "n_shingles", "s1", "s2", "mins", "body")
    named = prof.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    reps = written(named.groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                                                                F.min("mins").alias("mins")), "jaccard-classes")
    summary = read.where(F.col("documents").isNotNull()).select("token", "documents")
    frequent = frequent_tokens(summary, FREQUENT_LEAST)
    crowded = len(frequent_tokens(summary, max(CROWD, FREQUENT_LEAST)))
    table = f"llm_bodies_{uuid.uuid4().hex}"
    bodies = class_bodies(named, reps, table)

    # rows that share an id are one document: its classes are tied together
    ids = named.select("doc_id", "n_shingles", "s1", "s2").join(reps, ["n_shingles", "s1", "s2"]).select("doc_id", "rep")
    several = ids.groupBy("doc_id").agg(F.min("rep").alias("m"), F.max("rep").alias("z")).where("m < z")
    tied = ids.join(several, "doc_id").select(F.col("rep").alias("u"), F.col("m").alias("v"))
    first = hub_pairs(reps).select(F.col("a").alias("z"), F.col("b").alias("other"))
    links = written(verified(pair_requests(written(first, "jaccard-pairs")), bodies, n, percent).unionByName(tied), "jaccard-links")

    member = written(_member(reps, links), "jaccard-members")
    sizes = member.groupBy("component").agg(F.count("*").alias("members"))
    member = written(member.join(sizes, "component").select("rep", "component", "members"), "jaccard-members")
    candidates = written(filed_candidates(bodies, member, n, percent, frequent, crowded), "jaccard-candidates")
    requests = pair_requests(candidates.where("not whole")).unionByName(component_requests(candidates.where("whole"), member))
    links = links.unionByName(written(verified(requests, bodies, n, percent), "jaccard-links"))
    docs.sparkSession.sql(f"DROP TABLE {table}")  # from the catalog; its files are scratch like the rest
    member = written(_member(reps, links), "jaccard-members")

    classes = reps.select("n_shingles", "s1", "s2", "rep", "copies")
    filled = (named.select("doc_id", "n_shingles", "s1", "s2").join(classes, ["n_shingles", "s1", "s2"]).join(member, "rep")
              .select("doc_id", "n_shingles", F.col("rep").alias("class_id"), "component"))
    # rows without words: the component of their id's other rows, if it has any
    empty = prof.where(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).select("doc_id", "n_shingles")
    of_id = (filled.join(empty.select("doc_id").distinct(), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min("component").alias("component")))
    bare = (empty.join(of_id, "doc_id", "left")
            .select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.coalesce("component", "doc_id").alias("component")))
    documents = filled.unionByName(bare).withColumnRenamed("component", "component_id")
    return documents, classes.select(F.col("rep").alias("class_id"), "n_shingles", "copies"), links


def _member(reps: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, component) of every representative."""
    found = components(links)
    return (reps.select("rep").distinct().join(found, F.col("rep") == F.col("node"), "left")
            .select("rep", F.coalesce("component", "rep").alias("component")))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component of near-duplicates, that of its smallest doc_id; rows without
    an id stay."""
    documents, _, _ = join(docs, n, percent)
    kept = documents.where("doc_id = component_id").select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    one = (docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("r"))
           .select("doc_id", *[F.col(f"r.`{c}`").alias(c) for c in rest]))
    return one.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
