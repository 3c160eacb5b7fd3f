import re
from collections import Counter

import numpy as np

from strata.llm.quality_rules import GAMMA, PRIOR, RATIOS, REACH, TINY, fences, judge, measure, ratio, sketch
from strata.llm.queries import QUERIES
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    hit = set()
    for i, w in enumerate(windows):
        if count[w] >= 2:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_counts(spark, sf):
    odd = [None, "", "\n\n", "a", "a\na\n a\n", "xé\U0001f600   b\x0bc", "a b c d e f g h " * 3, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8",
           "\n".join(["same line here"] * 5), "w " * 30000, "|a|<b> #c", "\r\n\r\nq\r\nq\r\n", "a\n", "\na"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    for r in measure(docs).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == plain(r["text"]), (r["doc_id"], got, plain(r["text"]))


def test_sketch_merges_and_finds_quartiles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(n), int(n * f), ["a", "b", None][i % 3], ["s", None][i % 2])
            for i, (n, f) in enumerate(zip(rng.integers(50, 900, 6000), rng.uniform(3, 9, 6000)))]
    df = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, lang string, source string")
    df = df.select("*", *[F.lit(0).cast("long").alias(c) for c in ("n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_stutters")])
    whole = {tuple(r) for r in sketch(df).collect()}
    parts = sketch(df.where("doc_id % 5 < 2")).unionByName(sketch(df.where("doc_id % 5 >= 2")))
    merged = parts.groupBy("lang", "source", "ratio", "bucket").agg(F.sum("n").alias("n"))
    assert {tuple(r) for r in merged.collect()} == whole
    got = {(r["lang"], r["source"]): (r["lo"], r["hi"]) for r in fences(sketch(df), 2.0, 0).where("ratio = 'word_length'").collect()}
    assert len(got) == 6
    for key, (lo, hi) in got.items():
        v = np.sort([r[2] / r[1] for r in rows if (r[3], r[4]) == key])
        a, m, z = np.quantile(v, [0.25, 0.5, 0.75])
        assert abs(lo - (m - 2 * (z - m))) < 0.5 and abs(hi - (m + 2 * (m - a))) < 0.5


def test_small_groups_lean_on_the_merged_sketch(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi "
    rows = [(i, text + str(i), "en", "big") for i in range(300)] + [(1000, text + "new", "en", "tiny"), (1001, " ".join(w + "***" for w in text.split()), "xx", None)]
    rows += [(1002, None, None, None), (1003, "", "en", "big"), (1004, text, None, "big"), (1004, text, None, "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [(r["doc_id"], r["base_failed"], r["kept"]) for r in judge(measure(docs)).collect()]
    assert len(got) == len(rows)
    by = {d: (f, k) for d, f, k in got}
    assert by[1000] == (False, True) and by[1001] == (False, False) and by[1002] == (True, False) and by[1003] == (True, False)
    assert by[1004] == (False, True) and by[5] == (False, True)
    assert judge(measure(docs.where("false"))).count() == 0


def test_query_keeps_clean_documents(spark, sf):
    """Rows by brute force; clean labelled documents stay, most junk goes."""
    sf = sf.replace("0.001", "0.01")
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op8_quality_rules"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, c, s, d, w = want = plain(docs[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (n < 20 or 100 * w > 30 * n) and not (r["base_failed"] and r["kept"])
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(label[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in label and not r["base_failed"]]
    clean = [k for q, k in judged if q == 1]
    junk = [k for q, k in judged if q == 0]
    assert sum(clean) == len(clean)
    assert sum(junk) / len(junk) < 0.1


def brute_fences(rows, reach=REACH, prior=PRIOR):
    """{(lang, source, ratio): (lo, hi)} of rows of dicts that pass the base rule."""
    values = {}
    for r in rows:
        for name, (top, bottom, more, _, _) in RATIOS.items():
            v = r[top] / (r[bottom] + more) if r[bottom] + more else 0.0
            b = 0 if v < TINY else int(np.ceil(np.log(v / TINY) / np.log(GAMMA)))
            for key in ((r["lang"], r["source"]), (r["lang"],), ()):
                values.setdefault((key, name), []).append(b)
    quartiles = {}
    for key, own in values.items():
        own.sort()
        pick = [own[max(0, int(np.ceil(q * len(own))) - 1)] for q in (0.25, 0.5, 0.75)]
        quartiles[key] = (len(own), [0.0 if b == 0 else TINY * GAMMA ** (b - 0.5) for b in pick])
    out = {}
    for (key, name) in quartiles:
        if len(key) < 2:
            continue
        q = quartiles[(), name][1]
        for wider in (key[:1], key):
            n, own = quartiles[wider, name]
            w = n / (n + prior)
            q = [w * x + (1 - w) * y for x, y in zip(own, q)]
        least, two = RATIOS[name][3:]
        out[(*key, name)] = (q[1] - reach * max(q[2] - q[1], least) if two else None, q[1] + reach * max(q[1] - q[0], least))
    return out


def test_kept_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 17 != 0, F.col("lang"))).select("doc_id", "text", "lang", "source")
    rows = [r.asDict() for r in judge(measure(docs)).collect()]
    passed = [r for r in rows if not r["base_failed"]]
    limit = brute_fences(passed)
    n = 0
    for r in rows:
        if r["base_failed"]:
            assert not r["kept"]
            continue
        inside = True
        for name, (top, bottom, more, _, _) in RATIOS.items():
            v = r[top] / (r[bottom] + more) if r[bottom] + more else 0.0
            lo, hi = limit[r["lang"], r["source"], name]
            inside &= v <= hi + 1e-9 and (lo is None or v >= lo - 1e-9)
        assert inside == r["kept"], r["doc_id"]
        n += not inside
    assert n > 0


def test_every_fence_can_fire_and_none_jumps(spark):
    """Fences lie below what the base rule rejects, and move little from 199 to 201 documents of a group."""
    zero = {c: F.lit(0).cast("long") for c in ("n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_stutters")}

    def limits(n):
        rows = [(i, 100, 500 + (i % 5), "a", "small") for i in range(n)] + [(9000 + i, 100, 300 + (i % 9), "b", "big") for i in range(800)]
        df = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, lang string, source string").withColumns(zero)
        return {(r["source"], r["ratio"]): r["hi"] for r in fences(sketch(df)).collect()}

    a, b, c = limits(199), limits(200), limits(201)
    assert all(abs(a[k] - b[k]) < 0.01 and abs(b[k] - c[k]) < 0.01 for k in a)
    assert all(a[s, "repeats"] < 0.30 for s in ("small", "big")) and all(v < 1 for (s, r), v in a.items() if r != "word_length")


def test_clashing_names(spark):
    """Columns named like the counts, the verdicts or the joined fences are replaced or carried along."""
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi"
    rows = [(i, text, "en", "s", "l", 7, "x", i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tongue string, site string, lang string, n_words int, kept string, `f_lang` int")
    got = judge(measure(docs), lang_col="tongue", source_col="site")
    assert sorted(got.columns) == sorted({*docs.columns, *measure(docs).columns, "base_failed", "kept"})
    assert {(r["n_words"], r["kept"], r["lang"]) for r in got.collect()} == {(21, True, "l")}
    assert sorted(r["f_lang"] for r in got.collect()) == list(range(30))
