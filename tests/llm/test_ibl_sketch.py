import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from strata.llm.ibl_sketch import Sketches, differences, edited, fingerprint, likeness, pieces_of, versions
from strata.llm.queries import QUERIES


def mix(x):
    m = (1 << 64) - 1
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & m
    return x ^ (x >> 31)


def cut_long(piece):
    raw = piece.encode()
    if len(raw) <= 200:
        return [piece]
    cuts = [0]
    for i in range(8, len(raw)):
        if raw[i] & 0xC0 != 0x80 and mix(int.from_bytes(raw[i - 8:i], "little")) % (8 if raw[i - 1] == 32 else 64) == 0:
            cuts.append(i)
    return [raw[a:b].decode() for a, b in zip(cuts, [*cuts[1:], len(raw)])]


def plain_pieces(text):
    return {x for line in (text or "").split("\n") for p in re.split(r"(?<=[.!?]) ", line) if p for x in cut_long(p)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(rows):
    """The contract over (id, text) rows with distinct ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        e = edited(t, nxt)
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), jaccard(plain_pieces(t), plain_pieces(e)),
                  jaccard(plain_pieces(t), plain_pieces(nxt)))
    return out


def check(got, rows):
    want = plain(rows)
    assert len(got) == len(rows)
    for r in got:
        n, sha, near, near_next = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert r["near_edited"] == pytest.approx(near) and r["near_next"] == pytest.approx(near_next)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op6_document_fingerprints"](spark, sf).collect()
    check(got, rows)
    text = dict(rows)
    for r in got[:40]:
        assert r["fingerprint"] == fingerprint([text[r["doc_id"]]])[0]


def test_difference_is_recovered_exactly():
    rng = np.random.default_rng(8)
    pairs, a, b, want = 300, [], [], []
    for p in range(pairs):
        common = rng.integers(1, 2 ** 63, int(rng.integers(0, 40)))
        left, right = rng.integers(1, 2 ** 63, int(rng.integers(0, 300 if p % 9 == 0 else 6))), rng.integers(1, 2 ** 63, int(rng.integers(0, 5)))
        a += [(k, p) for k in {*common.tolist(), *left.tolist()}]
        b += [(k, p) for k in {*common.tolist(), *right.tolist()}]
        want += [(k, p, 1) for k in left.tolist()] + [(k, p, -1) for k in right.tolist()]
    side = lambda x: (np.array([k for k, _ in x], np.uint64), np.array([p for _, p in x], np.int64))
    got = differences(side(a), side(b), pairs)
    assert sorted(zip(*[x.tolist() for x in got])) == sorted(want)
    assert np.allclose(likeness(side(a), side(a), pairs), 1)


def test_too_small_sketch_fails_to_peel_and_says_so():
    keys = np.arange(1, 400, dtype=np.uint64)
    s = Sketches(np.array([24, 24]))
    s.add(keys, np.zeros(len(keys), np.int64), 1)
    s.add(keys[:3], np.ones(3, np.int64), 1)
    assert s.peel()[3].tolist() == [False, True]


def test_pieces():
    texts = ["", "a. b! c\nc\n\nd", "a. b! c", "é? é", "\n", "x"]
    keys, doc = pieces_of(pa.array(texts))
    assert np.bincount(doc, minlength=6).tolist() == [len(plain_pieces(t)) for t in texts]
    assert len(set(keys[doc == 1]) & set(keys[doc == 2])) == 3


def test_lines_without_marks_and_scripts_without_spaces(spark):
    """Two thirds of a one-line text and of a Chinese one stay: their fingerprints stay alike."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(3000)]
    line = " ".join(words[:2000])
    chinese = "".join("".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 3000, 12)) + "。" for _ in range(300))
    rows = [(4, line), (3, " ".join(words[2000:])), (2, chinese), (1, "另外一个" * 500)]
    got = versions(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(got, rows)
    near = {r["doc_id"]: r["near_edited"] for r in got}
    assert near[4] > 0.4 and near[2] > 0.4
    assert all(r["near_next"] < 0.1 for r in got)


def test_odd_rows(spark):
    rows = [(9, "One. Two. Three."), (7, None), (5, ""), (3, "é\U0001f600" * 40000), (2, "a\nb\nc"), (1, "short"), (None, "last. one.")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, range string")
    check(versions(docs).collect(), rows)
    one = docs.where("doc_id = 2")
    check(versions(one).collect(), [rows[4]])
    assert versions(docs.where("false")).count() == 0
    assert versions(docs.where("doc_id is null")).count() == 1
    twice = versions(docs.unionByName(docs)).collect()
    assert len(twice) == 14
    prints = {}
    for r in twice:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in prints.values()) and prints[7] == prints[5]


def test_many_ranges(spark):
    from strata.llm import ibl_sketch
    rows = [(int(i) * 7 - 300, f"Text {i}. Common line.\n" + "w " * (i % 50)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = ibl_sketch.in_ranges(docs, "doc_id", "text", 1000)
    assert placed.where("ahead = 1").count() == placed.select("range").distinct().count() > 10
    old = ibl_sketch.RANGE_BYTES
    try:
        ibl_sketch.in_ranges.__defaults__ = (1000,)
        check(versions(docs).collect(), rows)
    finally:
        ibl_sketch.in_ranges.__defaults__ = (old,)
