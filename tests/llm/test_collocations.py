import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import collocations as co
from strata.llm.common import ship


def brute(rows, least, top, covered):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cand = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    by = defaultdict(list)
    for (lang, p), a in cand.items():
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        by[lang].append((-score, -a, " ".join(p).encode(), p, left, right))
    inside = {}
    for (lang, p), a in cand.items():
        for s in range(2, len(p)):
            for i in range(len(p) - s + 1):
                key = (lang, p[i:i + s])
                inside[key] = max(inside.get(key, 0), a)
    out = []
    for lang, own in by.items():
        rank = 0
        for score, a, text, p, left, right in sorted(own):
            if 100 * inside.get((lang, p), 0) >= covered * -a and (lang, p) in inside:
                continue
            rank += 1
            if rank <= top:
                out.append((lang, rank, text.decode(), -a, left, right, n[lang], -score))
    return sorted(out), {(lang, " ".join(p)): v for (lang, p), v in f.items() if v >= least}


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "New", "york", "Zürich", "ÀB", "日本", "a-b", "c'd", " x", "𝔘"] + [f"w{i}" for i in range(60)]
    weights = 1 / np.arange(1, len(words) + 1)
    weights /= weights.sum()
    rows = []
    for i in range(n):
        text = []
        for _ in range(int(rng.integers(0, 60))):
            text.append(str(rng.choice(words, p=weights)))
            if rng.random() < 0.1:
                text += ["New", "York", "city", "hall"]
            text.append(str(rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "], p=[.7, .05, .05, .05, .05, .05, .03, .02])))
        rows.append(("".join(text), rng.choice(["en", "de", "und", None], p=[.5, .2, .2, .1])))
    return rows + [(None, "en"), ("", "de"), (" . , ", None), rows[0], rows[0], ("x", "lonely")]


def run(spark, rows, parts=4, **more):
    ship(spark)
    docs = spark.createDataFrame([(t, g, 1, "z") for t, g in rows], "text string, lang string, block int, word string").repartition(parts)
    got = co.collocations(docs, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed,least,top,covered", [(1, 3, 2000, 80), (2, 2, 15, 50), (3, 10, 2000, 100)])
def test_equals_brute_force(spark, seed, least, top, covered):
    rows = corpus(seed)
    assert run(spark, rows, least=least, top=top, covered=covered) == brute(rows, least, top, covered)[0]


def test_small_tiles_blocks_and_rounds(spark, tmp_path):
    """Dense and sparse tiles, many blocks and several merging rounds: the constants travel with the shipped functions only
    by module, so the tile functions are driven here and the Spark plan through its parameters."""
    rng = np.random.default_rng(9)
    x, y = (rng.zipf(1.3, 20000) % 9000).astype(np.int64), (rng.zipf(1.3, 20000) % 9000).astype(np.int64)
    want = Counter(zip(x.tolist(), y.tolist()))
    for groups in (1, 7):
        got, seen = Counter(), defaultdict(list)
        for at in range(0, len(x), 1500):
            for tile, codes, counts in co.tiles_of(x[at:at + 1500], y[at:at + 1500], groups):
                assert (np.diff(codes) > 0).all()
                seen[tile].append((co.unpack(co.pack(codes)), co.unpack(co.pack(counts))))
        for tile, parts in seen.items():
            codes, counts = co.add_up(tile, parts)
            for c, k in zip(codes.tolist(), counts.tolist()):
                got[c >> 31, c & (1 << 31) - 1] += k
        assert got == want
        assert any(t >= 16 for t in seen) and any(t < 16 for t in seen)


def test_many_blocks(spark, monkeypatch):
    rows = corpus(4, 300)
    monkeypatch.setattr(co, "CODES", 50)
    monkeypatch.setattr(co, "FAN_IN", 2)
    assert run(spark, rows, parts=40, least=4, top=500) == brute(rows, 4, 500, 80)[0]


def test_phrases_and_empty(spark):
    ship(spark)
    rows = corpus(5, 60)
    docs = spark.createDataFrame(rows, "text string, lang string")
    grams, sizes = co.phrases(docs, least=3)
    assert {(r["lang"], r["phrase"]): r["f"] for r in grams.collect()} == brute(rows, 3, 9, 80)[1]
    assert co.collocations(docs.where("false")).count() == 0


def test_scores_past_64_bits(spark):
    a, lr = 8 * 10 ** 15, 9 * 10 ** 15
    got = spark.range(1).selectExpr(f"(CAST(2000000 AS DECIMAL(7,0)) * CAST({a}L AS DECIMAL(19,0))) div CAST({lr}L AS DECIMAL(20,0)) AS s")
    assert got.first()["s"] == 2000000 * a // lr
