import re
import string
from collections import defaultdict

import numpy as np
import pytest

from strata.llm.common import ship
from strata.llm.suffix_trees import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, words):
    """{row number: (n_words, removed runs, kept text)} by comparing every window with all earlier ones."""
    texts = [WORD.findall(t or "") for _, t in rows]
    key = [i if i is not None else 2 ** 63 for i, _ in rows]
    places = defaultdict(list)
    for r, w in enumerate(texts):
        for s in range(len(w) - words + 1):
            places[tuple(w[s:s + words])].append((key[r], s))
    out = []
    for r, w in enumerate(texts):
        gone = [False] * len(w)
        for s in range(len(w) - words + 1):
            if min(places[tuple(w[s:s + words])]) < (key[r], s):
                gone[s:s + words] = [True] * words
        runs, at = [], 0
        while at < len(w):
            end = at
            while end < len(w) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                runs.append((at, end))
            at = end
        out.append((rows[r][0], len(w), tuple(runs), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def got(spark, rows, words, parts=4, **more):
    ship(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    found = remove_repeats(docs, words=words, **more).collect()
    for r in found:
        assert r["n_removed"] == sum(e - s for s, e in r["removed"])
    return sorted(((r["doc_id"], r["n_words"], tuple(map(tuple, r["removed"])), r["kept_text"]) for r in found), key=repr)


def corpus(rng, n, vocabulary):
    words = ["".join(rng.choice(list(string.ascii_lowercase + "é世"), 3)) for _ in range(vocabulary)]
    passages = [rng.choice(words, int(rng.integers(5, 60))).tolist() for _ in range(4)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(int(rng.integers(0, 5))):
            if rng.random() < 0.5:
                p = passages[int(rng.integers(4))]
                a = int(rng.integers(0, len(p)))
                text += p[a:] if rng.random() < 0.5 else p[:a]
            else:
                text += rng.choice(words, int(rng.integers(0, 30))).tolist()
        rows.append((int(rng.permutation(n * 3)[0]), rng.choice([" ", "\n", "\t  "]).join(text)))
    return rows + [rows[0], rows[1], (10 ** 6, rows[2][1]), (10 ** 6 + 1, rows[2][1])]


@pytest.mark.parametrize("words,vocabulary,limit", [(20, 200, 50_000), (6, 3, 50_000), (6, 3, 4), (20, 40, 0), (3, 5, 7), (1, 30, 50)])
def test_equals_brute_force(spark, words, vocabulary, limit):
    rows = corpus(np.random.default_rng(words * 7 + limit % 11), 60, vocabulary)
    assert got(spark, rows, words, group_limit=limit) == brute(rows, words)


def test_one_word_text_and_odd_rows(spark):
    line = " ".join(["na"] * 300)
    rows = [(3, line), (1, line), (1, line), (None, line), (7, None), (8, ""), (9, " \n "), (10, "one two"), (None, "a b"),
            (11, " ".join(map(str, range(40)))), (11, " ".join(map(str, range(40)))), (12, " ".join(map(str, range(10, 50)))),
            (13, " ".join("xyz") + " " + " ".join(map(str, range(5, 30))))]
    for limit in (0, 50_000):
        assert got(spark, rows, 20, group_limit=limit) == brute(rows, 20)


def test_copies_of_a_text_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(i, text) for i in range(5, 305)] + [(400, "x " + text), (2, text + " y")]
    assert got(spark, rows, 20, parts=16) == brute(rows, 20)


def test_whole_groups_meet_across_batches(spark, monkeypatch):
    import strata.llm.suffix_trees as st
    monkeypatch.setattr(st, "BLOCK_BYTES", 400)
    rng = np.random.default_rng(3)
    rows = corpus(rng, 80, 12)
    assert got(spark, rows, 8, parts=3) == brute(rows, 8)


def test_trees_of_a_bounded_batch():
    """Groups cut over batches stay whole: the same marks whatever the bytes a task holds."""
    import pyarrow as pa

    import strata.llm.suffix_trees as st
    rng = np.random.default_rng(4)
    n = 3000
    texts = [" ".join(rng.choice(["a", "b"], 24)).encode() for _ in range(n)]
    table = pa.table({"block": np.arange(n) % 7, "prefix": np.sort(rng.integers(0, 40, n)), "ord": pa.array(np.arange(n), pa.int32()),
                      "id": np.arange(n), "start": pa.array(np.zeros(n), pa.int32()), "before": pa.array(np.full(n, 3), pa.int32()),
                      "words": pa.array(texts, pa.binary())})
    # equal prefix hashes stand for equal first words behind the anchor
    key = [hash(tuple(t.split()[3:8])) for t in texts]
    order = np.argsort(key, kind="stable")
    table = table.take(pa.array(order)).set_column(1, "prefix", pa.array(np.array(key)[order]))

    def marks(bytes_at_once):
        st.TREE_BYTES, old = bytes_at_once, st.TREE_BYTES
        try:
            out = list(st._trees(20)(iter(table.to_batches(max_chunksize=100))))
        finally:
            st.TREE_BYTES = old
        return sorted((b, o, s) for x in out for b, os, ss in zip(*(x.column(i).to_pylist() for i in range(3))) for o, s in zip(os, ss))

    first, want = {}, []
    for i, t in enumerate(texts):
        w = t.split()
        for s in range(4):
            seen = first.setdefault((tuple(w[s:s + 20]), 3 - s, tuple(w[3:8])), i)
            if seen < i:
                want.append((i % 7, i, s))
    assert marks(1 << 30) == sorted(want) == marks(1000)


def test_schema_and_parameters(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id int, text string, block string, kept_text int")
    assert remove_repeats(docs).columns == ["doc_id", "n_words", "n_removed", "removed", "kept_text"]
    assert remove_repeats(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(docs, words=0)
    with pytest.raises(ValueError):
        remove_repeats(docs, id_col="block")
