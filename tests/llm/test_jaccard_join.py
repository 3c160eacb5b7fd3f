import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import jaccard_join as jj
from strata.llm.components import components
from strata.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def plain(rows):
    """{id: (size set, component)} by comparing all pairs that share a shingle."""
    by, sizes = defaultdict(set), defaultdict(set)
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for i, s in sets:
        sizes[i].add(len(s))
        for g in s:
            by[g].add((i, s))
    seen = set()
    for own in by.values():
        for a, sa in own:
            for b, sb in own:
                if a < b and (a, b, sa, sb) not in seen:
                    seen.add((a, b, sa, sb))
                    if 100 * len(sa & sb) >= 75 * len(sa | sb):
                        x, y = sorted((find(a), find(b)))
                        parent[y] = x
    return {i: (sizes[i], find(i)) for i in parent}


def check(got, rows):
    want = plain(rows)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
            continue
        size, component = want[r["doc_id"]]
        assert r["n_shingles"] in size and r["component_id"] == component, r


def edited(rng, words, share):
    return [rng.choice(VOCABULARY) if rng.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(400)]


def corpus(seed, n=260):
    """Exact copies, near copies in chains, shared passages, short and odd texts."""
    rng = random.Random(seed)
    passage = [rng.choice(VOCABULARY) for _ in range(30)]
    texts = []
    while len(texts) < n:
        base = [rng.choice(VOCABULARY) for _ in range(rng.choice([2, 4, 5, 6, 9, 30, 80, 200]))]
        if rng.random() < 0.4:
            base = base[:len(base) // 2] + passage + base[len(base) // 2:]
        for _ in range(rng.choice([1, 1, 2, 6, 14])):
            texts.append(" ".join(base))
            base = edited(rng, base, rng.choice([0, 0.004, 0.02, 0.05]))
            if rng.random() < 0.3:
                base = base[rng.randrange(1 + len(base) // 8):]
    texts += ["", " \n", None, "One", "one", "ONE two", "é É", "É é", "a b c d e", "A B C D E f", "x " * 3000, "x " * 2000]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op1_ngram_jaccard_join"](spark, sf).collect(), rows)


@pytest.mark.parametrize("seed,trees", [(1, 64), (2, 2)])
def test_components_equal_brute_force(spark, monkeypatch, seed, trees):
    monkeypatch.setattr(jj, "TREE_SETS", trees)  # small trees and parts: components are dealt over several
    monkeypatch.setattr(jj, "PROBES", trees)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(jj.join(docs)[0].collect(), rows)


def test_without_frequent_tokens_and_first_round(spark, monkeypatch):
    """The filed pairs alone find every link, with any choice of frequent tokens."""
    rows = corpus(5, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jj, "hub_pairs", lambda reps: reps.selectExpr("rep as a", "rep as b").where("false"))
    monkeypatch.setattr(jj, "FREQUENT_LEAST", 2)
    check(jj.join(docs)[0].collect(), rows)
    monkeypatch.setattr(jj, "frequent_tokens", lambda docs, n: np.zeros(0, np.uint64))
    check(jj.join(docs)[0].collect(), rows)


def test_odd_rows(spark):
    t = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, t), (5, t), (9, t + " x"), (9, "something else that is here now"), (2, "something else that is here now"),
            (None, t), (None, None), (7, None), (7, None), (8, ""), (11, "q " * 50000), (12, "q " * 50000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rep long")
    got = jj.join(docs)[0].collect()
    check(got, rows)
    assert {r["component_id"] for r in got if r["doc_id"] in (2, 5, 9)} == {2}
    kept = jj.keep_one(docs).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept) == [(False, 0), (False, 0), (True, 2), (True, 7), (True, 8), (True, 11)]
    assert jj.join(docs.where("false"))[0].count() == 0


def test_tree_walk_equals_intersection():
    rng = random.Random(3)
    texts = [t for _, t in corpus(7, 80) if t]
    token, offs = jj.shingle_sets(pa.array(texts), 5)
    sets = [token[a:b] for a, b in zip(offs, offs[1:]) if b > a]
    tree = jj.PrefixTree(list(range(len(sets))), sets)
    for probe in rng.sample(sets, 40):
        got = dict(tree.linked(probe, 75))
        want = {}
        for i, s in enumerate(sets):
            both = len(np.intersect1d(s, probe))
            if 100 * both >= 75 * (len(s) + len(probe) - both):
                want[i] = both
        assert got == want


def test_partly_tied_components_are_joined_through_their_trees(spark, monkeypatch):
    """The first round ties only some pairs; the rest comes from probes of larger components."""
    rows = corpus(11, 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole = jj.hub_pairs
    monkeypatch.setattr(jj, "hub_pairs", lambda reps: whole(reps).where("b % 3 = 0"))
    check(jj.join(docs)[0].collect(), rows)


def test_sizes(spark):
    texts = ["", None, "a", "A b", "a b c d e", "a b c d e f", "a a a a a a a", "É x"]
    _, offs = jj.shingle_sets(pa.array(["" if t is None else t for t in texts]), 5)
    assert np.diff(offs).tolist() == [len(shingles(t)) for t in texts]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(900), rng.randrange(900)) for _ in range(500)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000)]
    edges += [(2000, 2001 + i) for i in range(200)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_size_between_the_ends_of_a_component_links(spark, monkeypatch):
    """100 tokens against 102, 103 and 104: only the middle one links (87 of 116), and its bound is
    below that of both ends."""
    rare, common = [f"p{i}" for i in range(10)], [f"c{i}" for i in range(77)]
    near = [f"x{i}" for i in range(17)]
    sets = {1: rare + common + near, 2: rare + common[1:] + near[:16], 3: rare + common + near[:16],
            9: rare + common + [f"z{i}" for i in range(13)]}
    both = {i: 100 * len({*s} & {*sets[9]}) / len({*s} | {*sets[9]}) for i, s in sets.items()}
    assert [len(sets[i]) for i in (9, 2, 3, 1)] == [100, 102, 103, 104] and both[3] == 75 and max(both[1], both[2]) < 75
    # the common passage is frequent, so it stands behind the prefixes
    rows = [(i, " ".join(s)) for i, s in sets.items()]
    rows += [(100 + k, " ".join(common + [f"f{k}_{i}" for i in range(100)])) for k in range(jj.FREQUENT_LEAST)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = jj.hub_pairs
    monkeypatch.setattr(jj, "hub_pairs", lambda reps: whole(reps).where("b <> 9"))
    got = {r["doc_id"]: r["component_id"] for r in jj.join(docs, n=1)[0].collect()}
    assert got == {i: 1 if i < 10 else i for i, _ in rows}


def test_two_texts_of_one_id_are_bounded_by_their_own_sizes(spark, monkeypatch):
    rare, common, near = [f"p{i}" for i in range(4)], [f"c{i}" for i in range(82)], [f"x{i}" for i in range(24)]
    rows = [(1, " ".join(rare + common + near)), (2, " ".join(rare + common + near[1:] + ["y"])),
            (9, " ".join(rare + common + [f"z{i}" for i in range(4)])),  # 86 of 114 with document 1
            (9, " ".join(near[:8] + [f"o{i}" for i in range(92)]))]
    rows += [(100 + k, " ".join(common + [f"f{k}_{i}" for i in range(100)])) for k in range(jj.FREQUENT_LEAST)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = jj.hub_pairs
    monkeypatch.setattr(jj, "hub_pairs", lambda reps: whole(reps).where("b <> 9"))
    got = {r["doc_id"]: r["component_id"] for r in jj.join(docs, n=1)[0].collect()}
    assert got == {i: 1 if i < 10 else i for i, _ in rows}


@pytest.mark.parametrize("seed", [3, 8])
def test_crowded_tokens_are_joined(spark, monkeypatch, seed):
    """Tokens of two documents already go by joins, with and without the first round."""
    rows = corpus(seed, 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jj, "CROWD", 2)
    monkeypatch.setattr(jj, "FREQUENT_LEAST", 2)
    check(jj.join(docs)[0].collect(), rows)
    whole = jj.hub_pairs
    monkeypatch.setattr(jj, "hub_pairs", lambda reps: whole(reps).where("b % 3 = 0"))
    check(jj.join(docs)[0].collect(), rows)


def test_crowded_candidates_name_a_component_once(spark):
    rows = [(-5, 100, i, 1, 900) for i in range(900)] + [(-5, 100, 2000 + i, 2000 + i, 1) for i in range(3)]
    rows += [(-4, 100, i, 1, 900) for i in range(900)] + [(-5, 140, 3000, 3000, 1)]
    filed = spark.createDataFrame(rows, "token long, n long, rep long, component long, members long")
    got = sorted(tuple(r) for r in jj.crowded_candidates(filed, 75).collect())
    alone = [(2000, 2001), (2000, 2002), (2001, 2002)]  # 140 is too long for any of them
    assert got == sorted([(z, o, 100, 100, 100, False) for z, o in alone] + [(2000 + i, 1, 100, 100, 100, True) for i in range(3)])


def test_length_classes_lose_no_pair(spark):
    sizes = [*range(1, 60), 75, 100, 300, 400, 3 ** 9, 4 * 3 ** 8]
    filed = spark.createDataFrame([(-1, n, 10 * n, 10 * n, 1) for n in sizes], "token long, n long, rep long, component long, members long")
    got = {(r["z"] // 10, r["other"] // 10) for r in jj.crowded_candidates(filed, 75).collect()}
    assert got == {(a, b) for a in sizes for b in sizes if a < b and 100 * a >= 75 * b}


def test_tree_nodes_and_pruned_subtrees():
    rng = random.Random(4)
    for _ in range(30):
        base = sorted(rng.sample(range(400), 60))
        sets = [np.array(sorted({*base[:rng.randrange(1, 60)], *rng.sample(range(400), rng.randrange(0, 9))}), np.uint64) for _ in range(40)]
        sets += [sets[0], sets[1][:1], np.array(base, np.uint64), np.array(base[:30], np.uint64)]
        tree = jj.PrefixTree(list(range(len(sets))), sets)
        for level, first, last, start, end, least, most, past in tree.nodes:
            below = tree.sets[first:last]
            assert all((s[:end] == below[0][:end]).all() for s in below) and {min(map(len, below)), max(map(len, below))} == {least, most}
            assert past == len(tree.nodes) or tree.nodes[past][1] == last
        for percent in (50, 75, 100):
            for probe in rng.sample(sets, 12):
                both = [len(np.intersect1d(s, probe)) for s in sets]
                want = {i: b for i, b in enumerate(both) if 100 * b >= percent * (len(sets[i]) + len(probe) - b)}
                assert dict(tree.linked(probe, percent)) == want


def test_rows_without_words_follow_their_id_and_no_table_stays(spark):
    t = "one two three four five six seven"
    docs = spark.createDataFrame([(4, t), (2, t), (4, None), (6, ""), (6, None)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jj.join(docs)[0].collect())
    assert got == [(2, 3, 2), (4, 0, 2), (4, 3, 2), (6, 0, 6), (6, 0, 6)]
    assert sorted(r["doc_id"] for r in jj.keep_one(docs).collect()) == [2, 6]
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("llm_bodies_")]
