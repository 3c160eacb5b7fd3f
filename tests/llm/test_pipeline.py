import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm.common import written
from strata.llm.secret_scan import redact_text
from test_jaccard_join import plain as plain_components
from test_mixing import plain_targets
from test_quality_rules import plain as plain_counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """What each stage returned, on the whole small table."""
    out, docs = [], spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), f"t-{name}")
        out.append((name, docs.columns, [r.asDict() for r in docs.collect()]))
    return out


def test_stages_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality_rules", "ngram_jaccard_join", "secret_scans", "mixing", "packing"]
    assert all(c == COLUMNS for _, c, _ in stages[:-1])
    assert "pipeline" in entry.queries()


def test_quality_drops_junk_and_keeps_rows_whole(spark, sf, stages):
    docs = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kept = stages[0][2]
    assert 0 < len(kept) < len(docs) and all(docs[r["doc_id"]] == r for r in kept)
    for r in kept:
        n, _, _, _, w = plain_counts(r["text"])
        assert n >= 20 and 100 * w <= 30 * n


def test_one_of_each_group_stays(stages):
    before, after = stages[0][2], stages[1][2]
    want = plain_components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, c in want.values()})
    by = {r["doc_id"]: r for r in before}
    assert all(by[r["doc_id"]] == r for r in after)


def test_secrets_are_masked_and_nothing_else(stages):
    before = {r["doc_id"]: r for r in stages[1][2]}
    assert len(stages[2][2]) == len(before)
    for r in stages[2][2]:
        assert r["text"] == redact_text(before[r["doc_id"]]["text"], "[SECRET]") and r["n_chars"] == len(r["text"])


def test_mix_repeats_whole_documents_near_the_targets(stages):
    before, after = {r["doc_id"]: r for r in stages[2][2]}, stages[3][2]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, got = defaultdict(int), defaultdict(int)
    longest = defaultdict(int)
    for r in before.values():
        sizes[r["source"]] += words(r["text"])
        longest[r["source"]] = max(longest[r["source"]], words(r["text"]))
    for r in after:
        assert r == before[r["doc_id"]]
        got[r["source"]] += words(r["text"])
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3
    for s, t in plain_targets(sizes).items():
        assert -1 <= got[s] - t <= longest[s]


def test_packing_covers_every_row(stages):
    rows = Counter(r["doc_id"] for r in stages[3][2])
    per, room = Counter(), Counter()
    for p in stages[4][2]:
        per[p["doc_id"]] += p["length"]
        room[p["sequence_id"]] += p["length"]
    tokens = {p["doc_id"]: p["doc_tokens"] for p in stages[4][2]}
    assert per == Counter({d: n * tokens[d] for d, n in rows.items()})
    assert max(room.values()) <= 2048


def test_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        docs = out if "text" in out.columns else docs
        assert out.count() == 0
