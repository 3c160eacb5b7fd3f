"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Writing: the largest page id of each payload becomes a ``response`` record, the others
``revisit`` records that name it and carry the payload's digest and length but not its bytes.
Which record is which is settled on narrow rows (digest, length, id); the html is shuffled
once, by page, to the rows that store it. Every record is a gzip member of its own. A task
writes files under attempt-unique names and reports them in a manifest, so that a retried or
lost task leaves at most files that no manifest names.

Reading: archives are cut into byte ranges. A task scans its range for gzip magic, accepts a
candidate only if its member decodes to a WARC head with a type and a length that the member
then honours (its checksum included), and owns the records that start inside the range, however
far they reach past it.

Files are reached through Arrow's file systems by URI (file, hdfs, s3, gs; s3a is read as s3),
from tasks, never through local paths of one machine.

Cases: null html is an empty payload, which counts as any other; a null page id sorts below
all ids; rows equal in id and payload give one response at most; a null url writes no target;
line breaks in urls are escaped; an empty table writes no archive and reads back no rows;
records of any length, their heads too, are read, one at a time; a round trip that reads another
number of records from an archive than were written is an error; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
CRLF = b"\r\n"
#: How much the reader fetches at once.
FETCH = 1 << 18
ARCHIVE_BYTES = 256 << 20


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# ------------------------------------------------------------------ records

def record_urn(page_id, copy: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{copy}>"


def page_of(urn: str | None) -> int | None:
    """Page id of a record's name, or None."""
    part = (urn or "").strip("<>").split(":")
    return int(part[2]) if len(part) == 4 and part[:2] == ["urn", "page"] and part[2] else None


def member(kind: str, urn: str, url: str | None, digest: str, length: int, payload: bytes | None, refers: str | None,
           date: str) -> bytes:
    """One gzip member holding one record. ``payload`` is None for a revisit."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length)
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers is not None:
        head += [f"WARC-Refers-To: {refers}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2) + z.flush()


def headers(raw: bytes, first: bytes) -> dict[str, str] | None:
    """Named fields of a head whose first line starts with ``first``, names in lower case."""
    lines = raw.split(CRLF)
    if not lines[0].startswith(first):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields


def decode(read, at: int, size: int) -> tuple[dict[str, str], bytes, int] | None:
    """(fields, block, end offset) of the record whose member starts at ``at``, else None."""
    z, out, pos, head, need, seen = zlib.decompressobj(31), bytearray(), at, None, -1, 0
    try:
        while not z.eof and pos < size:
            # little until the output starts as a record: most candidates that are none end here
            chunk = read(pos, min(FETCH if len(out) > 5 else 4096, size - pos))
            pos += len(chunk)
            out += z.decompress(chunk)
            if head is None:
                cut = out.find(CRLF * 2, max(0, seen - 3))
                if cut < 0:
                    if not out.startswith(b"WARC/"[:len(out)]):
                        return None
                    seen = len(out)
                    continue
                head = headers(bytes(out[:cut]), b"WARC/1.")
                if head is None or "warc-type" not in head or not head.get("content-length", "").isdigit():
                    return None
                body, need = cut + 4, cut + 4 + int(head["content-length"]) + 4
            if need >= 0 and len(out) > need:
                return None
    except zlib.error:
        return None
    if not z.eof or head is None or len(out) != need or not out.endswith(CRLF * 2):
        return None
    return head, bytes(out[body:-4]), pos - len(z.unused_data)


def records_in(read, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of the records that start in [start, end)."""
    at = start
    while at < end:
        window = read(at, min(FETCH, end - at) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0 or at + hit >= end:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += hit
        got = decode(read, at, size)
        if got is None:
            at += 1
            continue
        yield at, got[0], got[1]
        at = got[2]


# ------------------------------------------------------------------ writing

def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, digest, bytes, copy, kind, refers, html): the records to write; ``html`` is
    null for revisits. ``digest`` is the hex SHA-1 of the UTF-8 payload."""
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                        F.sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    # rows equal in page, url and payload are counted, not kept apart
    named = rows.groupBy("page_id", "url", "digest", "bytes").agg(F.count("*").alias("rows"))
    shared = named.where(F.col("bytes") >= least_bytes)
    best = shared.groupBy("digest", "bytes").agg(F.max(F.struct("page_id", "url")).alias("best"))
    # one pass of narrow rows: how many of them store the payload, and how many revisit it
    marked = (named.join(best, ["digest", "bytes"], "left")
              .withColumn("is_best", F.col("best").isNotNull() & F.col("page_id").eqNullSafe(F.col("best.page_id"))
                          & F.col("url").eqNullSafe(F.col("best.url")))
              .withColumn("stores", F.when(F.col("best").isNull(), F.col("rows")).when(F.col("is_best"), 1).otherwise(0)))
    marked = written(marked, "warc-plan")
    revisits = (marked.where(F.col("rows") > F.col("stores"))
                .select("page_id", "url", "digest", "bytes",
                        F.explode(F.sequence(F.col("stores"), F.col("rows") - 1)).alias("copy"),
                        F.lit("revisit").alias("kind"), F.col("best.page_id").alias("refers"),
                        F.lit(None).cast("string").alias("html")))
    # the html meets the narrow mark of its row in one grouping, which treats nulls as equal: it is shuffled once
    keys = ["page_id", "url", "digest", "bytes"]
    marks = marked.where("stores > 0").select(*keys, F.lit(None).cast("string").alias("html"), F.col("stores").cast("long").alias("n"))
    bodies = (rows.select(*keys, "html", F.lit(None).cast("long").alias("n")).unionByName(marks)
              .groupBy(*keys).agg(F.first("html", ignorenulls=True).alias("html"), F.max("n").alias("n"))
              .where(F.col("n").isNotNull())
              .select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"),
                      F.lit("response").alias("kind"), F.lit(None).cast("long").alias("refers"), "html"))
    return bodies.unionByName(revisits)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the records as ``*.warc.gz`` under ``folder``; the manifest (path, size, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        done, out, size, count, name = [], None, 0, 0, ""
        for batch in batches:
            for r in (row for part in _small(batch) for row in part.to_pylist()):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz"
                    out, size, count = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                payload = None if r["html"] is None else r["html"].encode()
                refers = record_urn(r["refers"], 0) if r["kind"] == "revisit" else None
                raw = member(r["kind"], record_urn(r["page_id"], r["copy"]), r["url"], digest, r["bytes"], payload, refers, date)
                out.write(raw)
                size, count = size + len(raw), count + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["path", "size", "records"])

    return written(records.mapInArrow(run, "path string, size long, records long"), "warc-manifest")


def _small(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


# ------------------------------------------------------------------ reading

#: A range has a task of its own up to so many tasks; beyond, a task reads so many ranges.
RANGE_TASKS, RANGES_A_TASK = 10_000, 16

READ_SCHEMA = ("path string, offset long, record_type string, record_id string, target_uri string, refers_to_id string, "
               "payload_digest string, payload_bytes long, digest_ok boolean, payload binary")


def read_archives(files: DataFrame, split_bytes: int = 4 << 20, with_payload: bool = True) -> DataFrame:
    """Records of the archives listed in ``files`` (path, size), read by byte ranges.

    ``payload_bytes`` and ``payload_digest`` (bare base32) are of the full payload: recomputed for a
    stored one, taken from the heads of a revisit; ``digest_ok`` says whether a stored payload
    has the digest that its head names."""
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)),
                                                              F.lit(split_bytes).cast("long"))).alias("start"))
    # a count of its own: rows as narrow as these would be merged into a few tasks that read everything
    count = files.agg(F.sum(F.ceil(F.greatest(F.col("size"), F.lit(1)) / split_bytes))).first()[0] or 1
    tasks = min(count, max(RANGE_TASKS, count // RANGES_A_TASK))
    ranges = ranges.repartitionByRange(int(tasks), "path", "start")

    def row(path: str, at: int, head: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(CRLF * 2)
        named = head.get("warc-payload-digest", "").partition(":")[2] or None
        if head["warc-type"] == "response":
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            digest, length, ok = own, len(payload), named in (None, own)
        else:
            told = (headers(http, b"HTTP/") or {}).get("content-length", "")
            digest, length, ok, payload = named, int(told) if told.isdigit() else None, None, None
        return (path, at, head["warc-type"], head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-refers-to"),
                digest, length, ok, payload if with_payload else None)

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_(),
             pa.binary()]
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, path = filesystem(r["path"])
                with store.open_input_file(path) as f:
                    rows, held = [], 0
                    for at, head, block in records_in(lambda pos, n: f.read_at(n, pos), r["size"], r["start"],
                                                      min(r["start"] + split_bytes, r["size"])):
                        rows.append(row(r["path"], at, head, block))
                        held += len(block) + sum(map(len, head.values()))
                        if len(rows) >= 2000 or held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    return ranges.mapInArrow(run, READ_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared scratch folder and read their records back, all of them."""
    manifest = write_archives(plan_records(pages, least_bytes), scratch_path(spark, "warc"))
    return complete(written(read_archives(manifest, with_payload=False), "warc-records"), manifest)


def complete(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """``records``, after an error if an archive gave another number of them than ``manifest`` names."""
    got = records.groupBy("path").agg(F.count("*").alias("got"))
    wrong = (manifest.join(got, "path", "full").select("path", F.coalesce("records", F.lit(0)).alias("named"),
                                                       F.coalesce("got", F.lit(0)).alias("got")).where("named <> got"))
    first = wrong.orderBy("path").limit(1).collect()
    if first:
        raise ValueError("{path}: {got} records read of {named} written".format(**first[0].asDict()))
    return records


def page_id_of(urn) -> F.Column:
    """Native ``page_of``: null unless the name holds an id."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+):\d+>$", 1).try_cast("long")
