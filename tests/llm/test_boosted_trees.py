import zlib

import numpy as np
import pyarrow as pa

from strata.llm.boosted_trees import FEATURES, document_features, features_of, fit, score, train
from strata.llm.queries import QUERIES


def walk(trees, row):
    """One row, node by node."""
    total = trees.base
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        k = 0
        while k < len(feature):
            k = 2 * k + 1 + (row[feature[k]] > threshold[k])
        total += leaf[k - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_fit_learns_and_traversal_equals_walking():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = fit(x[:2000], y[:2000], rounds=40, depth=3)
    p = trees.predict(x)
    assert ((p[2000:] > 0.5) == y[2000:]).mean() > 0.97
    assert np.allclose(p[:50], [walk(trees, r) for r in x[:50]])
    loss = lambda n: -np.mean(np.log(np.where(y[:2000] == 1, q := fit(x[:2000], y[:2000], rounds=n).predict(x[:2000]), 1 - q)))
    assert loss(1) > loss(5) > loss(30)


def test_one_class_or_no_labels():
    x = np.zeros((4, 2), np.float32)
    assert np.allclose(fit(x, np.ones(4)).predict(x), 0.999)
    assert np.allclose(fit(x[:0], np.zeros(0)).predict(x), 0.5)


def test_features_do_not_depend_on_the_slice():
    texts = ["One two. Three!", "", "É à | b", "x" * 5000 + " y", "a\na\nb 12"]
    whole = features_of(pa.array(texts))
    assert whole.shape == (5, len(FEATURES)) and np.isfinite(whole).all() and not whole[1].any()
    for i, t in enumerate(texts):
        assert np.allclose(features_of(pa.array([t]))[0], whole[i])


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "good words here " * 20000, None), (3, "good words here " * 20000, None), (None, "x *** y", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc_features string")
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 1), (9, 0), (None, 1), (2, None)], "doc_id long, quality int")
    featured = document_features(docs)
    got = score(featured, train(featured, labels, "doc_id", "quality")).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert score(document_features(docs.where("false")), fit(np.zeros((0, 2)), np.zeros(0))).count() == 0


def test_query_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op5_quality_classifier"](spark, sf).collect()
    assert {r["doc_id"] for r in rows} == docs and len(rows) == len(docs)
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["held_out"] and r["doc_id"] in label:
            right.append((label[r["doc_id"]], r["predicted"]))
    good = [p for q, p in right if q == 1]
    assert np.mean([q == p for q, p in right]) > 0.93, np.mean([q == p for q, p in right])
    assert np.mean(good) > 0.95
