"""Registered streaming (W1-W9) and source/sink (S1-S13) queries.

Streams read the events table incrementally from its folder (``pathGlobFilter``) and
run to completion with ``availableNow``; the query returns the sink snapshot.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import dq as DQ
from strata.plans import bindings as B
from strata.plans.q_dq import EVQ_CTE
from strata.plans.registry import QUERIES, query
from strata.session import scratch_path
from strata.sources import ingest as I
from strata.sources import sinks as SK
from strata.sources.tables import Tables, scan_stream
from strata.streaming import jobs as W


#: Events of one landed file, about.
FILE_EVENTS = 500_000


def events_stream(spark, d):
    """The events table landed in time order, a quarter of the rows at a time, each as the same number of files and read as one
    micro-batch (in the order they were written, so watermarks drop nothing). A larger table is
    not read in more batches: every batch loads and commits all partitions of the state."""
    events = Tables(spark, d).events
    path = scratch_path(spark, "events-stream")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts, n = events.agg(F.percentile_approx(at, [0.25, 0.5, 0.75]), F.count(at)).first()
    files = -(-n // (4 * FILE_EVENTS))
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = events if lo is None else events.where(at > lo)
        (part if hi is None else part.where(at <= hi)).repartition(files).write.mode("append").parquet(path)
    s = scan_stream(spark, path, events.schema, max_files_per_trigger=files)
    return s.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
                    F.when(F.col("event_id") % 9 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
                     .alias("value"), "props")


@query("s2_scan_stream", f"WITH {B.EVENTS_DQ_CTE} SELECT * FROM events_dq")
def s2_scan_stream(spark, d):
    return spark.read.parquet(W.run_available_now(spark, events_stream(spark, d), "s2"))


@query("w1_stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def w1_stream_dedupe(spark, d):
    s = W.stream_dedupe(events_stream(spark, d).select("user_id", "event_type"), ["user_id", "event_type"])
    return spark.read.parquet(W.run_available_now(spark, s, "w1"))


@query("w2_stream_uniqueness", """
WITH planted AS (SELECT event_id, user_id, ts FROM events
                 UNION ALL SELECT event_id, user_id, ts + INTERVAL 5 SECOND FROM events WHERE event_id % 50 = 0)
SELECT 'ind__event_id' AS check_name, count(*) AS n_keys, sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)::BIGINT AS n_dup, max(n) AS max_dup_count
FROM (SELECT event_id, count(*) AS n FROM planted GROUP BY event_id)
UNION ALL
SELECT 'cmp__user_id_ts', count(*), sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)::BIGINT, max(n)
FROM (SELECT user_id, ts, count(*) AS n FROM planted GROUP BY user_id, ts)""")
def w2_stream_uniqueness(spark, d):
    e = events_stream(spark, d).select("event_id", "user_id", "ts")
    # every 50th event comes again five seconds later
    planted = e.withColumn("ts", F.explode(F.when(F.col("event_id") % 50 == 0, F.array("ts", F.expr("ts + interval 5 seconds")))
                                           .otherwise(F.array("ts"))))
    counts = W.uniqueness_counts(planted, individual=["event_id"], composite=[["user_id", "ts"]])
    sink = W.run_available_now(spark, counts, "w2", mode="update")
    seen = W.latest_state(spark, sink, ["check_name", "key_value"])
    return seen.groupBy("check_name").agg(F.count(F.lit(1)).alias("n_keys"),
                                          F.sum(F.when(F.col("dup_count") > 1, 1).otherwise(0)).alias("n_dup"),
                                          F.max("dup_count").alias("max_dup_count"))


def _stream_quarantine(spark, d):
    flagged = W.flag_stream(events_stream(spark, d), ["value"], {}, {"error_event": "event_type = 'error'"})
    return W.quarantine_stream(flagged)


@query("w4_quarantine_counts", QUERIES["d7_quarantine_summary"].sql)
def w4_quarantine_counts(spark, d):
    q, _ = _stream_quarantine(spark, d)
    counts = W.quarantine_counts(q, "ts", "events")
    sink = W.run_available_now(spark, counts, "w4", mode="update")
    return W.latest_state(spark, sink, ["table_name", "window_start"])


@query("w5_append_flow", "SELECT event_id, user_id, event_type FROM events")
def w5_append_flow(spark, d):
    s = events_stream(spark, d).select("event_id", "user_id", "event_type")
    a = s.where(F.col("event_type").isin("click", "view"))
    b = s.where(~F.col("event_type").isin("click", "view"))
    return spark.read.parquet(W.run_available_now(spark, W.append_flows([a, b]), "w5"))


@query("w6_raw_quarantine_log", QUERIES["d8_quarantine_log"].sql)
def w6_raw_quarantine_log(spark, d):
    q, _ = _stream_quarantine(spark, d)
    return spark.read.parquet(W.run_available_now(spark, DQ.quarantine_log(q, "events", "ts"), "w6"))


@query("w7_flag_stream", f"""
WITH {EVQ_CTE} SELECT * FROM evq""")
def w7_flag_stream(spark, d):
    flagged = W.flag_stream(events_stream(spark, d), ["value"], {}, {"error_event": "event_type = 'error'"})
    return spark.read.parquet(W.run_available_now(spark, flagged, "w7"))


@query("w8_stream_quarantine_split", f"""
WITH {B.EVENTS_DQ_CTE} SELECT * FROM events_dq WHERE value IS NOT NULL""")
def w8_stream_quarantine_split(spark, d):
    _, clean = _stream_quarantine(spark, d)
    return spark.read.parquet(W.run_available_now(spark, clean, "w8"))


# -- sources and sinks -----------------------------------------------------------------
@query("s1_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def s1_scan(spark, d):
    o = Tables(spark, d).orders
    return o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("s3_read_csv_history", """
SELECT CAST(o_orderkey AS VARCHAR) AS Order_Key, strftime(o_orderdate, '%Y-%m-%d') AS Order_Date,
       o_orderstatus AS Status, o_orderpriority AS Priority
FROM orders WHERE o_orderkey % 29 <> 0""")
def s3_read_csv_history(spark, d):
    o = Tables(spark, d).orders
    raw = o.select(F.col("o_orderkey").cast("string").alias("Order Key"),
                   F.date_format("o_orderdate", "M/d/yyyy").alias("Order Date"),
                   F.when(F.col("o_orderkey") % 29 == 0, F.lit(" ")).otherwise(F.col("o_orderstatus")).alias("Status"),
                   F.col("o_orderpriority").alias("Priority"))
    path = scratch_path(spark, "s3-csv")
    raw.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    df = I.read_csv_history(spark, path, required=["Order_Key", "Status"], date_cols=["Order_Date"],
                            keep=["Order_Key", "Order_Date", "Status", "Priority"])
    return df.drop("datalake_ingestion_timestamp")


#: Events of one landed page at most: a user's events are paged by their ids.
PAGE_EVENTS = 100


@query("s4_land_json_pages", "SELECT user_id, event_id // 100 AS page, count(*) AS page_rows FROM events GROUP BY 1, 2")
def s4_land_json_pages(spark, d):
    e = Tables(spark, d).events
    pages = (e.groupBy("user_id", F.expr(f"event_id div {PAGE_EVENTS}").alias("page")).agg(F.to_json(F.struct(
        F.first("user_id").alias("user"), F.first(F.expr(f"event_id div {PAGE_EVENTS}")).alias("page"),
        F.collect_list(F.struct(F.col("event_id").alias("f1"), F.col("event_type").alias("f2"))).alias("result"),
        F.array(F.struct(F.lit("f1").alias("id"), F.lit("Event Id").alias("label")),
                F.struct(F.lit("f2").alias("id"), F.lit("Event Type").alias("label"))).alias("fields"))).alias("value")))
    path = scratch_path(spark, "s4-pages")
    pages.select("value").write.text(path)
    landed = I.land_json_pages(spark, path, "t1", "events_api", whole_files=False)
    return landed.select(F.variant_get("raw_data", "$.user", "bigint").alias("user_id"), F.variant_get("raw_data", "$.page", "bigint").alias("page"), "page_rows")


@query("s5_unpack_variant_records", """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       sha256(concat_ws('||', CAST(event_id AS VARCHAR), json_extract_string(props, '$.k'))) AS row_hash
FROM events""")
def s5_unpack_variant_records(spark, d):
    e = Tables(spark, d).events.select("event_id", F.parse_json("props").alias("v"))
    return I.unpack_variant_records(e, "v", None, {"k": "$.k"}, meta_cols=["event_id"])


@query("s5_unpack_variant_array", """
SELECT event_id, i AS k FROM (SELECT event_id, unnest([CAST(event_id AS VARCHAR), event_type]) AS i FROM events)""")
def s5_unpack_variant_array(spark, d):
    e = Tables(spark, d).events
    item = lambda c: F.struct(c.cast("string").alias("k"))
    doc = F.to_json(F.struct(F.array(item(F.col("event_id")), item(F.col("event_type"))).alias("rows")))
    out = I.unpack_variant_records(e.select("event_id", F.parse_json(doc).alias("v")), "v", "$.rows", {"k": "$.k"}, meta_cols=["event_id"])
    return out.drop("row_hash")


@query("s6_explode_json_array", "SELECT user_id, event_id, value FROM events")
def s6_explode_json_array(spark, d):
    e = Tables(spark, d).events
    docs = (e.groupBy("user_id", F.expr(f"event_id div {PAGE_EVENTS}").alias("page"))
            .agg(F.to_json(F.collect_list(F.struct("event_id", "value"))).alias("doc")))
    rows = I.explode_json_array(docs, "doc", keep=["user_id"])
    return rows.select("user_id", "event_id", F.col("value").cast("double").alias("value"))


@query("s7_infer_variant_schema", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def s7_infer_variant_schema(spark, d):
    e = Tables(spark, d).events.withColumn("v", F.parse_json("props"))
    ddl = I.infer_variant_schema(e, "v")
    return e.select("event_id", F.from_json("props", ddl).alias("r")).select("event_id", "r.*")


@query("s8_rename_from_lookup", """
SELECT sum(CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END) AS AFRICA, sum(CASE WHEN n_regionkey = 1 THEN 1 ELSE 0 END) AS AMERICA,
       sum(CASE WHEN n_regionkey = 2 THEN 1 ELSE 0 END) AS ASIA, sum(CASE WHEN n_regionkey = 3 THEN 1 ELSE 0 END) AS EUROPE,
       sum(CASE WHEN n_regionkey = 4 THEN 1 ELSE 0 END) AS "MIDDLE EAST"
FROM nation""")
def s8_rename_from_lookup(spark, d):
    t = Tables(spark, d)
    ids = ["0", "1", "2", "3", "4"]
    wide = t.nation.select(*[F.sum(F.when(F.col("n_regionkey") == int(i), 1).otherwise(0)).alias(i) for i in ids])
    # the lookup is a dimension of region ids -> labels, collected once (5 rows)
    mapping = {str(r["r_regionkey"]): r["r_name"] for r in t.region.collect()}
    return I.rename_from_lookup(wide, mapping)


@query("s9_sanitise_columns", """
SELECT c_custkey AS Customer_Key, c_acctbal AS Acct_Bal__USD_, c_mktsegment AS MktSegment, c_nationkey AS Share_perc
FROM customer""")
def s9_sanitise_columns(spark, d):
    c = Tables(spark, d).customer
    raw = c.select(F.col("c_custkey").alias("Customer Key"), F.col("c_acctbal").alias("Acct Bal (USD)"),
                   F.col("c_mktsegment").alias("Mkt.Segment"), F.col("c_nationkey").alias("Share %"))
    return I.sanitise_columns(raw).drop("datalake_ingestion_timestamp")


@query("s10_cast_to_schema", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders""")
def s10_cast_to_schema(spark, d):
    o = Tables(spark, d).orders
    raw = o.select(F.col("o_orderkey").cast("string").alias("O_ORDERKEY"), F.col("o_custkey").cast("string"),
                   F.col("o_totalprice").cast("string"),
                   F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit('"'), F.date_format("o_orderdate", "dd-MM-yyyy"),
                                                                  F.lit('"')))
                    .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("o_orderdate"),
                   "o_orderstatus")
    defs = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_totalprice": "DOUBLE", "o_orderdate": "DATE"}
    return I.cast_to_schema(raw, defs, date_formats={"o_orderdate": "dd-MM-yyyy"})


@query("s13_write_append", """
SELECT c_custkey, c_name, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 1""")
def s13_write_append(spark, d):
    c = Tables(spark, d).customer
    path = scratch_path(spark, "s13-append")
    SK.write_overwrite(c.where(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_name"), path)
    SK.write_append(c.where(F.col("c_custkey") % 2 == 1).select("c_custkey", "c_name", "c_mktsegment"), path)
    return SK.read_evolving(spark, path)


@query("s12_write_overwrite", "SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS yr FROM orders")
def s12_write_overwrite(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.date_trunc("year", "o_orderdate").cast("date").alias("yr"))
    path = scratch_path(spark, "s12-snapshot")
    SK.write_overwrite(o, path, partition_by=["yr"])
    SK.write_overwrite(o.where(F.year("yr") == 1999), path, partition_by=["yr"])  # rewrites one partition only
    return spark.read.parquet(path).select("o_orderkey", "yr")
