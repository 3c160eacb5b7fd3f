import base64
import gzip
import hashlib
import os
import random
from urllib.parse import unquote

import pytest

from strata.llm.queries import QUERIES
from strata.llm.warc import (MAGIC, complete, filesystem, member, page_of, plan_records, read_archives, record_urn, records_in,
                             round_trip, write_archives)
from strata.session import scratch_path


def digest(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def plain(pages):
    """(page_id, bytes, digest, type, refers_to) by the rule."""
    best = {}
    for p, _, h in pages:
        best.setdefault(h or "", []).append(p)
    out = []
    for h, ids in best.items():
        ids = sorted(ids, key=lambda x: (x is not None, x or 0), reverse=True)
        raw = h.encode()
        out += [(ids[0], len(raw), digest(raw), "response", None)]
        out += [(i, len(raw), digest(raw), "revisit", ids[0]) for i in ids[1:]]
    return sorted(out, key=str)


def test_query(spark, sf):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op9_warc_round_trip"](spark, sf)
    assert sorted(map(tuple, got.collect()), key=str) == plain(pages)


def test_odd_rows(spark):
    pages = [(1, "http://a/\r\nX: y", "é" * 70000), (2, None, None), (3, "", ""), (4, "u", "é" * 70000), (5, "u", ""), (5, "u", ""),
             (6, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"), (None, "u", "x"), (None, "u", "x"), (7, "v", "x"), (8, "w", "\x1f\x08")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = round_trip(spark, df).collect()
    rows = [(page_of(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], page_of(r["refers_to_id"])) for r in got]
    assert sorted(rows, key=str) == plain(pages)
    assert all(r["digest_ok"] for r in got if r["record_type"] == "response")
    assert round_trip(spark, df.where("false")).count() == 0
    # below a least size nothing is shared
    kept = plan_records(df, least_bytes=3).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in kept} == {"response": 10, "revisit": 1}


def test_any_split_finds_every_record_once(spark):
    rng = random.Random(4)
    pages = [(i, f"http://h/{i}", "".join(chr(rng.randrange(32, 1000)) for _ in range(rng.choice([0, 5, 400, 9000])))) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    manifest = write_archives(plan_records(df), scratch_path(spark, "t"), archive_bytes=60000)
    assert manifest.count() > 2
    want = None
    for split in (1 << 22, 5000, 777, 64):
        got = sorted((page_of(r["record_id"]), bytes(r["payload"] or b"").decode(), r["target_uri"])
                     for r in read_archives(manifest, split_bytes=split).collect())
        want = want or got
        assert got == want
    stored = {i: h for i, h, _ in want}
    assert all(stored[i] in (h, "") for i, _, h in pages)
    path = manifest.first()["path"]
    store, at = filesystem(path)
    whole = gzip.decompress(store.open_input_stream(at, compression=None).read())
    assert whole.count(b"WARC/1.1\r\n") == manifest.first()["records"]


def test_false_magic_is_rejected():
    a = member("response", record_urn(1, 0), "u", digest(b"p"), 1, b"p", None, "d")
    b = member("revisit", record_urn(2, 0), None, digest(b"p"), 1, None, record_urn(1, 0), "d")
    junk = MAGIC + b"\0" * 20 + gzip.compress(b"not a record") + MAGIC
    raw = a + junk + b + b[:-3]  # the last member is cut short
    read = lambda pos, n: raw[pos:pos + n]
    assert [x[0] for x in records_in(read, len(raw), 0, len(raw))] == [0, len(a) + len(junk)]
    for cut in range(0, len(raw), 7):
        parts = [*records_in(read, len(raw), 0, cut), *records_in(read, len(raw), cut, len(raw))]
        assert [x[0] for x in parts] == [0, len(a) + len(junk)]
    assert os.path.isabs(filesystem("file:///tmp/x")[1])


def test_long_urls_are_read_back(spark):
    rng = random.Random(6)
    url = lambda n: "data:," + "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n))
    pages = [(1, url(30000), "a"), (2, url(200000), "a"), (3, url(90000), "b"), (4, "http://h/" + "x" * 3000000, None), (5, "u", "c")]
    got = round_trip(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    rows = [(page_of(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], page_of(r["refers_to_id"])) for r in got]
    assert sorted(rows, key=str) == plain(pages)
    assert {page_of(r["record_id"]): unquote(r["target_uri"]) for r in got} == {p: u for p, u, _ in pages}


def test_a_missing_record_is_an_error(spark):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(9)], "page_id long, url string, html string")
    manifest = write_archives(plan_records(df), scratch_path(spark, "t"))
    records = read_archives(manifest)
    assert complete(records, manifest).count() == 9
    with pytest.raises(ValueError, match="records read of"):
        complete(records.where("offset > 0"), manifest)
    with pytest.raises(ValueError, match="0 records read of"):
        complete(records.where("false"), manifest)
