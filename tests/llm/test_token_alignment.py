import hashlib
from collections import Counter

import numpy as np
import pytest

from strata.llm.common import ship
from strata.llm.queries import QUERIES
from strata.llm.token_alignment import Block, align, documents_of


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    vocabulary = {i: t for t, i in a.get_vocab().items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def read(text):
        """(A ids, B ids, A ends, B ends) or None."""
        if not text:
            return None
        ia = a.encode(" " + text, add_special_tokens=False).ids
        ib = b.encode(text)
        ta = [bytes(byte_of[c] for c in vocabulary[i]) for i in ia]
        tb = []
        for i in ib:
            p = b.id_to_piece(i)
            tb.append(bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
        if b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            return None
        return ia, ib, np.cumsum([len(x) for x in ta]), np.cumsum([len(x) for x in tb])

    return read


def brute(rows, read):
    count, found = Counter(), []
    docs = Counter()
    for _, text in rows:
        got = read(text)
        if got is None:
            found.append((0, 0, [], []))
            continue
        ia, ib, ea, eb = got
        links = []
        for i, end in enumerate(ea):
            start = ea[i - 1] if i else 0
            first, last = np.searchsorted(eb, start, side="right"), np.searchsorted(eb, end, side="left")
            links += [(ia[i], ib[j]) for j in range(first, last + 1)]
        both = sorted(set(ea.tolist()) & set(eb.tolist()))
        groups, x, y = [], 0, 0
        for end in both:
            x2, y2 = int(np.searchsorted(ea, end)) + 1, int(np.searchsorted(eb, end)) + 1
            groups.append(f"{','.join(map(str, ia[x:x2]))}|{','.join(map(str, ib[y:y2]))}")
            x, y = x2, y2
        count.update(links)
        docs.update(set(links))
        found.append((len(ia), len(ib), groups, links))
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = [(i, a, b, len(g), len(k), sum(count[x] == top[x[1]] for x in k), sum(count[x] for x in k), ";".join(g))
           for (i, _), (a, b, g, k) in zip(rows, found)]
    return sorted(out, key=repr), {k: (n, docs[k], int(n == top[k[1]])) for k, n in count.items()}


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
ODD = ["", None, " ", "  ", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "\ta\t", "a b c", "it's we'll 's", "\n's x", "\x1c \x1d a", "x" * 3000,
       "日本語 テスト 한국어", "\U0001f600 \U0001f600‍", "1 22 333  4444", "a\r\nb c", "\u0085 a", "<|endoftext|> a<|endoftext|> <s> <0x41>", "é ́",
       "... !!  ??", "a▁b c", "▁", "a ▁b", "word, word. \"word\" (word) word! 3.5 5% $4 a|b x&y #1 *z", "a b 　 c", "a ​ b",
       "naïve café. Ça! été, où", "end.\n\n\nNext  line\n", "\n", "\n\n a", "a\x00b", "﻿a b", "²., ²) _. _) __,"]


def test_equals_the_libraries(spark, libraries):
    ship(spark)
    rng = np.random.default_rng(2)
    marks = list("ab1 ,.;:!?\n\t'\"()&%$#*|_-é²▁") + [" ", "the ", " and", "ing", " ", "日"]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(5, "a  b"), (None, "the end."), (None, "the end.")]
    rows += [(100 + i, "".join(rng.choice(marks, int(rng.integers(1, 40))))) for i in range(400)]
    rows += [(1000, "long text, with words. " * 20000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, n_a int").repartition(3)
    found, pairs = align(docs)
    assert found.columns == ["doc_id", *COLUMNS]
    want, want_pairs = brute(rows, libraries)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert {(r["a"], r["b"]): (r["links"], r["docs"], r["best"]) for r in pairs.collect()} == want_pairs
    assert align(docs.where("false"))[0].count() == 0


def test_query(spark, sf, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in brute(rows, libraries)[0]]
    got = QUERIES["op12_cross_tokenizer_alignment"](spark, sf)
    assert got.columns == ["doc_id", *COLUMNS[:-1], "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_small_blocks_and_caches_give_the_same(spark, libraries):
    """One unit remembered at a time and blocks of three documents, in this process."""
    import pyarrow as pa

    import strata.llm.token_alignment as ta
    texts = [t or "" for t in ODD] * 3
    for units in (0, 10, 400_000):
        ta._units.clear()
        old, ta.CACHE_UNITS = ta.CACHE_UNITS, units
        try:
            import public_tokenizers as P
            reader = ta.Reader(P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model"))
            for at in range(0, len(texts), 7):
                part = texts[at:at + 7]
                n_a, n_b, n_g, n_l, groups, *_ = reader.read(pa.array(part))
                for k, t in enumerate(part):
                    got = libraries(t)
                    assert (n_a[k], n_b[k]) == ((0, 0) if got is None else (len(got[0]), len(got[1])))
                    assert (groups[k] is None) == (got is None)
        finally:
            ta.CACHE_UNITS = old
            ta._units.clear()


def test_planes_round_trip():
    rng = np.random.default_rng(8)
    for docs in (1, 9, 70, 5000):
        block, want = Block(), {}
        for base in range(0, docs, 50):  # slices of 50 documents
            n = min(50, docs - base)
            keys = {(int(rng.integers(0, 6)) * 1000, int(d)) for d in rng.integers(0, n, 200)}
            code, doc = map(np.array, zip(*sorted(keys)))
            times = rng.integers(1, 40, len(code))
            block.add(base, code, doc, times)
            want.update({(int(c), int(d) + base): int(t) for c, d, t in zip(code, doc, times)})
        block.docs = docs
        pairs, n_docs, links, planes = block.planes()
        got = Counter()
        for p, body in zip(pairs.tolist(), planes):
            for j, raw in documents_of(body):
                for d in np.frombuffer(raw, "<u2").tolist():
                    got[p, d] += 1 << j
        assert got == want
        for p, nd, nl in zip(pairs.tolist(), n_docs.tolist(), links.tolist()):
            assert (nd, nl) == (sum(k[0] == p for k in want), sum(v for k, v in want.items() if k[0] == p))
