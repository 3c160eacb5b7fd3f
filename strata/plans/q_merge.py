"""Registered table-mutation queries (S14-S25) over order / customer / event bindings.

The merge inputs are two versions of the orders table: a target snapshot missing
every 10th order, and a batch of the orders from 1999 on, missing every 7th order and
with every 5th order repriced. Both read the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import merge as MG
from strata.operators.prefix import time_bucket
from strata.operators.scd2 import scd2_apply_changes
from strata.plans import bindings as B
from strata.plans.registry import query
from strata.sources.tables import Tables

COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "period"]


def _period():
    return F.date_trunc("year", F.col("o_orderdate")).cast("date").alias("period")


def merge_target(spark, d):
    o = Tables(spark, d).orders
    return o.where(F.col("o_orderkey") % 10 != 0).select("o_orderkey", "o_custkey", "o_orderstatus",
                                                          "o_totalprice", _period())


def merge_batch(spark, d, extra=False):
    o = Tables(spark, d).orders
    price = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + F.lit(1.0)).otherwise(F.col("o_totalprice"))
    b = o.where((F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) & (F.col("o_orderkey") % 7 != 0))
    if extra:
        return b.select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"), _period(), "o_orderpriority")
    return b.select("o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"), _period())


MERGE_CTE = """
tgt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(date_trunc('year', o_orderdate) AS DATE) AS period,
         true AS __t
  FROM orders WHERE o_orderkey % 10 <> 0
),
src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS period, o_orderpriority, true AS __s
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderkey % 7 <> 0
)"""


def _merged_sql(keys: list[str], cols: list[str], pad: dict[str, str] | None = None) -> str:
    pad = pad or {}
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    sel = ", ".join(f"CASE WHEN s.__s THEN {pad.get(c, 's.' + c)} ELSE t.{c} END AS {c}" for c in cols)
    return (f"SELECT {sel}, t.__t IS NOT NULL AS in_t, s.__s IS NOT NULL AS in_s "
            f"FROM tgt t FULL JOIN src s ON {on}")


@query("s14_merge_upsert", f"WITH {MERGE_CTE}, m AS ({_merged_sql(['o_orderkey'], COLS)}) "
                           f"SELECT {', '.join(COLS)} FROM m")
def s14_merge_upsert(spark, d):
    return MG.merge_upsert(merge_target(spark, d), merge_batch(spark, d), ["o_orderkey"])


@query("s15_merge_scoped_delete", f"""
WITH {MERGE_CTE}, m AS ({_merged_sql(['o_orderkey', 'period'], COLS)})
SELECT {', '.join(COLS)} FROM m
WHERE NOT (in_t AND NOT in_s AND period IN (SELECT DISTINCT period FROM src))""")
def s15_merge_scoped_delete(spark, d):
    return MG.merge_upsert(merge_target(spark, d), merge_batch(spark, d), ["o_orderkey"],
                           delete="scoped", period_col="period")


@query("s16_merge_full_delete", f"""
WITH {MERGE_CTE}, m AS ({_merged_sql(['o_orderkey'], COLS)})
SELECT {', '.join(COLS)} FROM m WHERE NOT (in_t AND NOT in_s AND o_orderstatus = 'P')""")
def s16_merge_full_delete(spark, d):
    return MG.merge_upsert(merge_target(spark, d), merge_batch(spark, d), ["o_orderkey"],
                           delete="full", delete_filter="o_orderstatus = 'P'")


S17_COLS = COLS + ["o_orderpriority"]


@query("s17_align_schema", f"""
WITH {MERGE_CTE},
m AS (
  SELECT {", ".join(f"CASE WHEN s.__s THEN {'NULL' if c == 'o_custkey' else 's.' + c} ELSE "
                    f"{'NULL' if c == 'o_orderpriority' else 't.' + c} END AS {c}" for c in S17_COLS)}
  FROM tgt t FULL JOIN src s ON t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey
)
SELECT * FROM m""")
def s17_align_schema(spark, d):
    return MG.merge_upsert(merge_target(spark, d), merge_batch(spark, d, extra=True), ["o_orderkey"])


@query("s18_incremental_insert", """
WITH tgt AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
             WHERE o_orderdate < TIMESTAMP '2000-01-01'),
src AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders),
fresh AS (SELECT DISTINCT * FROM src WHERE o_orderdate > (SELECT max(o_orderdate) FROM tgt)
                                       OR (SELECT max(o_orderdate) FROM tgt) IS NULL)
SELECT * FROM tgt UNION ALL
SELECT * FROM fresh f WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.o_orderkey = f.o_orderkey AND t.o_orderdate = f.o_orderdate)""")
def s18_incremental_insert(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    tgt = o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return MG.incremental_insert(tgt, o, ["o_orderkey"], "o_orderdate")


@query("s19_replace_load", "SELECT DISTINCT * FROM lineitem")
def s19_replace_load(spark, d):
    return MG.replace_load(Tables(spark, d).lineitem)


@query("s20_insert_by_date", """
WITH tgt AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders
             WHERE o_orderdate < TIMESTAMP '2001-03-01' AND o_orderkey % 3 <> 0),
src AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders)
SELECT * FROM tgt UNION ALL
SELECT * FROM src s WHERE s.d >= DATE '2001-02-01' AND NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_orderkey = s.o_orderkey)""")
def s20_insert_by_date(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    tgt = o.where((F.col("d") < F.lit("2001-03-01").cast("date")) & (F.col("o_orderkey") % 3 != 0))
    return MG.insert_by_date(tgt, o, ["o_orderkey"], "d", F.lit("2001-02-01").cast("date"), mode="multi_day")


@query("s20_insert_single_day", """
WITH tgt AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0)
SELECT * FROM tgt UNION ALL
SELECT o_orderkey, CAST(o_orderdate AS DATE), o_totalprice FROM orders s
WHERE CAST(o_orderdate AS DATE) = DATE '1998-08-02' AND NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_orderkey = s.o_orderkey)""")
def s20_insert_single_day(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    return MG.insert_by_date(o.where(F.col("o_orderkey") % 3 != 0), o, ["o_orderkey"], "d", F.lit("1998-08-02").cast("date"))


@query("s21_insert_missing", """
WITH tgt AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0)
SELECT * FROM tgt UNION ALL
SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.c_custkey = c.c_custkey)""")
def s21_insert_missing(spark, d):
    c = Tables(spark, d).customer
    return MG.insert_missing(c.where(F.col("c_custkey") % 10 != 0), c, "c_custkey")


@query("s22_union_sources", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, 'customer' AS src FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier' FROM supplier
UNION ALL SELECT n_nationkey, n_name, NULL, NULL, 'nation' FROM nation""")
def s22_union_sources(spark, d):
    t = Tables(spark, d)
    return MG.union_sources([
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
                          F.lit("customer").alias("src")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("src")),
        t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
                        F.lit("nation").alias("src")),
    ])


def customer_versions(spark, d):
    """Customer rows with every 37th segment NULL (NULLs are skipped by the hash)."""
    c = Tables(spark, d).customer
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.when(F.col("c_custkey") % 37 == 0, F.lit(None).cast("string"))
                     .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


CUST_CTE = """
cust AS (SELECT c_custkey, c_name, c_nationkey,
                CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)"""


@query("s23_row_hash", f"""
WITH {CUST_CTE}
SELECT *, sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment))
          AS row_hash
FROM cust""")
def s23_row_hash(spark, d):
    return MG.row_hash(customer_versions(spark, d))


@query("s23_row_hash_null_token", f"""
WITH {CUST_CTE}
SELECT *, sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), COALESCE(c_mktsegment, '~'))) AS row_hash FROM cust""")
def s23_row_hash_null_token(spark, d):
    return MG.row_hash(customer_versions(spark, d), null_token="~")


NOW = "2024-06-01 00:00:00"


def scd2_target(spark, d):
    cur = MG.row_hash(customer_versions(spark, d)).withColumns({
        "START_AT": F.lit("2024-01-01 00:00:00").cast("timestamp"), "END_AT": F.lit(None).cast("timestamp")})
    old = (customer_versions(spark, d).where(F.col("c_custkey") % 4 == 0).withColumn("c_mktsegment", F.lit("OLD")))
    old = MG.row_hash(old).withColumns({"START_AT": F.lit("2023-01-01 00:00:00").cast("timestamp"),
                                        "END_AT": F.lit("2024-01-01 00:00:00").cast("timestamp")})
    return cur.unionByName(old)


def scd2_source(spark, d):
    c = customer_versions(spark, d).where(F.col("c_custkey") % 13 != 0)
    c = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 == 0, F.lit("CHANGED"))
                     .otherwise(F.col("c_mktsegment")))
    return MG.row_hash(c)


H = "sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment))"


@query("s24_scd2_hash_merge", f"""
WITH {CUST_CTE},
cur AS (SELECT *, {H} AS row_hash, TIMESTAMP '2024-01-01' AS START_AT, CAST(NULL AS TIMESTAMP) AS END_AT FROM cust),
old AS (SELECT * REPLACE ('OLD' AS c_mktsegment) FROM cust WHERE c_custkey % 4 = 0),
hist AS (SELECT *, {H} AS row_hash, TIMESTAMP '2023-01-01' AS START_AT, TIMESTAMP '2024-01-01' AS END_AT FROM old),
src0 AS (SELECT * REPLACE (CASE WHEN c_custkey % 11 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment)
         FROM cust WHERE c_custkey % 13 <> 0),
src AS (SELECT *, {H} AS row_hash FROM src0)
SELECT * FROM hist
UNION ALL
SELECT * REPLACE (CASE WHEN row_hash NOT IN (SELECT row_hash FROM src) THEN TIMESTAMP '{NOW}' ELSE END_AT END AS END_AT)
FROM cur
UNION ALL
SELECT *, TIMESTAMP '{NOW}' AS START_AT, CAST(NULL AS TIMESTAMP) AS END_AT FROM src
WHERE row_hash NOT IN (SELECT row_hash FROM cur)""")
def s24_scd2_hash_merge(spark, d):
    return MG.scd2_hash_merge(scd2_target(spark, d), scd2_source(spark, d), F.lit(NOW).cast("timestamp"))


@query("s25_scd2_apply_changes", f"""
WITH {B.EVENTS_DQ_CTE},
f AS (
  SELECT user_id, ts, event_id,
         last_value(event_type IGNORE NULLS) OVER wc AS event_type,
         last_value(value IGNORE NULLS) OVER wc AS value
  FROM events_dq
  WINDOW wc AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
g AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR event_type IS DISTINCT FROM lag(event_type) OVER w
                 THEN 1 ELSE 0 END AS nw
  FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
h AS (SELECT *, SUM(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver FROM g),
v AS (
  SELECT user_id, ver, MIN(ts) AS __START_AT, arg_max_null(event_type, (ts, event_id)) AS event_type,
         arg_max_null(value, (ts, event_id)) AS value, arg_max_null(event_id, (ts, event_id)) AS event_id
  FROM h GROUP BY user_id, ver
)
SELECT user_id, __START_AT, event_type, value, event_id,
       lead(__START_AT) OVER (PARTITION BY user_id ORDER BY __START_AT, ver) AS __END_AT
FROM v""")
def s25_scd2_apply_changes(spark, d):
    ev = B.events_dq(spark, d)
    return scd2_apply_changes(ev, ["user_id"], "ts", ["event_type"], ["value", "event_id"],
                              tiebreak=["event_id"], bucket=time_bucket("ts", "day"))
