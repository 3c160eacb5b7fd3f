import itertools
import zlib

import numpy as np

from strata.llm.language_id import label_texts, train, identify, viterbi, words_of
from strata.llm.queries import QUERIES


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(2)
    count = np.array([0, 1, 5, 3, 0, 6, 1])
    first = np.cumsum(count) - count
    scores = rng.normal(0, 3, (count.sum(), 3)).astype(np.float32)
    got = viterbi(scores, first, count, 2.5)
    for a, n in zip(first, count):
        def value(path):
            return sum(float(scores[a + t, k]) for t, k in enumerate(path)) - 2.5 * sum(x != y for x, y in zip(path, path[1:]))
        best = max((value(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
        assert n == 0 or abs(value(got[a:a + n].tolist()) - best) < 1e-4


def test_words_are_runs_of_letters():
    texts = ["", "ab, Cd", "é1ü", "日本 x", "", "z"]
    w = words_of(texts)
    got = [(int(d), "".join(texts)[a:b]) for d, a, b in zip(w.doc, w.starts, w.ends)]
    assert got == [(1, "ab"), (1, "Cd"), (2, "é"), (2, "ü"), (3, "日本"), (3, "x"), (5, "z")]


def model(spark):
    rows = [("the cat and the dog went with them into that house", "en"), ("der hund und die katze gehen nicht in das haus", "de"),
            ("кошка и собака идут домой", "ru")] * 20 + [("ignored", None), (None, "en")]
    return train(spark.createDataFrame(rows, "text string, lang string"))


def test_mixed_text_gives_spans_and_scripts_narrow(spark):
    m = model(spark)
    assert m.langs == ["de", "en", "ru"]
    text = "the dog and the cat went into that house. der hund und die katze gehen nicht in das haus! кошка идут"
    lang, score, spans = label_texts([text], m, 6.0)[0]
    assert [s[0] for s in spans] == ["en", "de", "ru"] and 0 < score < 1
    assert text[spans[1][1]:spans[1][2]].startswith("der hund") and text[spans[2][1]:spans[2][2]] == "кошка идут"
    assert label_texts(["домой"], m, 6.0)[0][0] == "ru"
    assert label_texts(["the"], m, 6.0)[0][0] == "en"
    assert label_texts(["漢字"], m, 6.0)[0][0] in m.langs
    assert label_texts(["", "12 !", "٠"], m, 6.0) == [("und", 0.0, [])] * 3


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "the cat " * 30000, None), (3, "the cat " * 30000, None), (None, "der hund", "y"), (4, "123 ...", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = sorted(((r["doc_id"] or 0), r["lang_pred"], 0 <= r["score"] <= 1) for r in identify(docs, model(spark)).collect())
    assert got == [(0, "de", True), (1, "und", True), (2, "und", True), (3, "en", True), (3, "en", True), (4, "und", True)]
    assert identify(docs.where("false"), model(spark)).count() == 0
    none = train(spark.createDataFrame([("a", None)], "text string, lang string"))
    assert {r["lang_pred"] for r in identify(docs, none).collect()} == {"und"}


def test_query_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_language_id"](spark, sf).collect()
    assert len(rows) == len(docs)
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["held_out"] and any(c.isalpha() for c in docs[r["doc_id"]]["text"]):
            right.append(r["lang_pred"] == docs[r["doc_id"]]["lang"])
    assert len(right) > 100 and np.mean(right) > 0.97, np.mean(right)
