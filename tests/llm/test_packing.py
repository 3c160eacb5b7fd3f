import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm.packing import END_ID, PACKING_LIMITS, Encoder, Packer, default_specials, default_vocabulary, pack_documents
from strata.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["", " ", "  ", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "\ta\t", "a b", "a  b", "it's we'll 's", "\x1c \x1d a", "x" * 3000,
       "日本語 テスト 한국어", "\U0001f600 \U0001f600‍", "1 22 333  4444", "a\r\nb c", "\u0085 a", "<|endoftext|> a<|endoftext|>", "é ́", "... !!  ??"]


def test_ids_equal_the_library(spark, sf, library):
    rng = np.random.default_rng(1)
    marks = [*"ab1 ,.;:!?\n\t'\"()&%$#*|_-é²", " ", "  ", "the ", " and", "ing", "日", "\u00a0", "<|endoftext|>", "<|", "|>"]
    texts = ODD + ["".join(rng.choice(marks, int(rng.integers(1, 30)))) for _ in range(3000)]
    texts += [r[0] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    enc = Encoder(default_vocabulary(), default_specials())
    for _ in range(2):  # the second time from the cache
        for at in range(0, len(texts), 50):
            part = texts[at:at + 50]
            ids, first, prompt = enc.encode_batch(pa.array(part), end=False)
            for k, t in enumerate(part):
                assert ids[first[k]:first[k + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, t[:50]
                assert 0 <= prompt[k] <= first[k + 1] - first[k] and (prompt[k] > 0) == ("\n" in t)


def test_prompt_is_the_first_line(library):
    enc = Encoder(default_vocabulary(), default_specials())
    texts = ["one line", "a question, please\nan answer\nof two lines", "", "q\n"]
    assert enc.encode_batch(pa.array(texts))[2].tolist() == [0, len(library.encode("a question, please\n").ids), 0, 2]


def check(rows, texts, library, tokens=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= tokens
    return sequences


def test_query(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op4_pack_documents"](spark, sf).collect()
    sequences = check(rows, texts, library)
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len(sequences)) > 0.97  # one part-filled sequence a task
    # all three limits hold, and each of them stops some sequence
    loss = [sum(r["loss_tokens"] for r in own) for own in sequences.values()]
    assert max(loss) == PACKING_LIMITS["loss"] and max(map(len, sequences.values())) <= PACKING_LIMITS["segments"]
    assert any(sum(r["length"] for r in own) == 2048 for own in sequences.values())


def test_odd_rows(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(100, None, "x"), (101, "a b " * 40000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(3)
    got = pack_documents(docs, with_ids=True).collect()
    check(got, {r[0]: r[1] for r in rows}, library)
    assert all(len(r["ids"]) == r["length"] for r in got)
    assert pack_documents(docs.where("false")).count() == 0
    twice = spark.createDataFrame([(1, "a b c", "y")] * 2 + [(None, "d", "y")], "doc_id long, text string, k string")
    assert sorted((r["doc_id"] or 0, r["length"]) for r in pack_documents(twice).collect()) == [(0, 2), (1, 4), (1, 4)]


def test_three_limits_hold_and_no_id_is_lost():
    rng = np.random.default_rng(5)
    for tokens, segments, loss in ((64, 3, 20), (64, 64, 64), (50, 1, 50), (32, 5, 1)):
        packer, placed, n = Packer(tokens, segments, loss), [], 0
        want = {}
        for e in range(700):
            size = int(rng.integers(1, 150))
            bears = int(rng.integers(0, size + 1))
            want[e] = (np.arange(n, n + size, dtype="<u4"), bears)
            n += size
            placed += packer.add(e, want[e][0].tobytes(), bears)
        placed += packer.drain()
        by, back = defaultdict(list), defaultdict(list)
        for p in placed:
            by[p[0]].append(p)
            back[p[3]].append(p)
        for own in by.values():
            assert sum(len(p[5]) // 4 for p in own) <= tokens
            assert len(own) <= segments and sum(p[6] for p in own) <= loss
            assert [p[2] for p in own] == list(range(len(own)))
        for e, (ids, bears) in want.items():
            own = sorted(back[e], key=lambda p: p[4])
            assert b"".join(p[5] for p in own) == ids.tobytes() and sum(p[6] for p in own) == bears
    with pytest.raises(ValueError):
        Packer(0, 1, 1)


def test_prompts_bear_no_loss(spark):
    rows = [(i, "q " * 30, "answer " * 10) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, prompt string, text string")
    got = pack_documents(docs, prompt_col="prompt", tokens=256, segments=4, loss=40).collect()
    by = defaultdict(lambda: [0, 0, 0])
    for r in got:
        for k, v in enumerate((r["length"], 1, r["loss_tokens"])):
            by[r["sequence_id"]][k] += v
    assert all(a <= 256 and b <= 4 and c <= 40 for a, b, c in by.values())
    total = {(r["doc_id"]): 0 for r in got}
    for r in got:
        total[r["doc_id"]] += r["loss_tokens"]
    assert len(set(total.values())) == 1
