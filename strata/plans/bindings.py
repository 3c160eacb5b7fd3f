"""Bindings: TPC-H-ish test tables -> domain-shaped inputs.

Each binding has a DataFrame builder and the DuckDB CTE computing the same rows, so
oracle SQL can start from the identical input. Planted defects use integer
arithmetic on non-negative keys (``%``), which both engines evaluate identically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import Tables

# ---------------------------------------------------------------------------------
# Fund operations: one transaction per order.
#   fund = customer nation, structure type = region, investor = customer,
#   investor type = market segment, type from priority/status, date = order date.
# Planted: every 50th order is a draft (filtered); every 37th customer has no type
# and invests under a fund's name (feeder-fund inference fires).
# ---------------------------------------------------------------------------------


def fund_operations(spark: SparkSession, root: str) -> DataFrame:
    t = Tables(spark, root)
    o, c, n, r = t.orders, t.customer, t.nation, t.region
    df = (o.join(c, o.o_custkey == c.c_custkey)
           .join(n, c.c_nationkey == n.n_nationkey)
           .join(r, n.n_regionkey == r.r_regionkey))
    feeder = (F.col("c_custkey") % 37) == 0
    return df.select(
        F.col("o_orderkey").alias("Transaction_Id"),
        F.col("n_nationkey").alias("Fund_Id"),
        F.col("n_name").alias("Fund"),
        F.col("r_name").alias("Fund_Structure_Type"),
        F.when(F.col("n_nationkey") % 6 == 5, "Inactive").otherwise("Active").alias("Fund_Status"),
        F.when(feeder, F.concat(F.lit("NATION_"), (F.col("c_custkey") % 25).cast("string")))
         .otherwise(F.col("c_name")).alias("Investor"),
        F.when(feeder, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("Investor_Type"),
        F.when(feeder, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("CTRY_"), (F.col("c_custkey") % 7).cast("string"))).alias("Investor_Country"),
        F.when(F.col("n_nationkey") % 3 == 0, "GBP").when(F.col("n_nationkey") % 3 == 1, "EUR")
         .otherwise("USD").alias("Transaction_Currency"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "MF: Net Asset Value")
         .when(F.col("o_orderstatus") == "F", "MF: Call")
         .when(F.col("o_orderstatus") == "O", "MF: Distribution")
         .otherwise("MF: Commitment").alias("Type"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderdate").cast("date").alias("Effective_Date"),
        F.when(F.col("o_orderkey") % 50 == 0, "True").otherwise("False").alias("Draft"),
    )


FUND_OPS_CTE = """
fund_ops AS (
  SELECT o.o_orderkey AS Transaction_Id, n.n_nationkey AS Fund_Id, n.n_name AS Fund,
         r.r_name AS Fund_Structure_Type,
         CASE WHEN n.n_nationkey % 6 = 5 THEN 'Inactive' ELSE 'Active' END AS Fund_Status,
         CASE WHEN c.c_custkey % 37 = 0 THEN concat('NATION_', CAST(c.c_custkey % 25 AS VARCHAR))
              ELSE c.c_name END AS Investor,
         CASE WHEN c.c_custkey % 37 = 0 THEN NULL ELSE c.c_mktsegment END AS Investor_Type,
         CASE WHEN c.c_custkey % 37 = 0 THEN NULL
              ELSE concat('CTRY_', CAST(c.c_custkey % 7 AS VARCHAR)) END AS Investor_Country,
         CASE WHEN n.n_nationkey % 3 = 0 THEN 'GBP' WHEN n.n_nationkey % 3 = 1 THEN 'EUR'
              ELSE 'USD' END AS Transaction_Currency,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'MF: Net Asset Value'
              WHEN o.o_orderstatus = 'F' THEN 'MF: Call'
              WHEN o.o_orderstatus = 'O' THEN 'MF: Distribution'
              ELSE 'MF: Commitment' END AS Type,
         o.o_totalprice AS Amount,
         CAST(o.o_orderdate AS DATE) AS Effective_Date,
         CASE WHEN o.o_orderkey % 50 = 0 THEN 'True' ELSE 'False' END AS Draft
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


# ---------------------------------------------------------------------------------
# Funds dimension: one row per nation (fund names used by feeder inference).
# ---------------------------------------------------------------------------------


def funds(spark: SparkSession, root: str) -> DataFrame:
    n = Tables(spark, root).nation
    return n.select(F.col("n_nationkey").alias("Fund_Id"), F.col("n_name").alias("Fund"),
                    F.col("n_regionkey").alias("Region_Id"))


FUNDS_CTE = """
funds AS (SELECT n_nationkey AS Fund_Id, n_name AS Fund, n_regionkey AS Region_Id FROM nation)"""


# ---------------------------------------------------------------------------------
# Ownership edges: child = customer, parent = custkey div 3 (every 5th order: div 7,
# a second parent), one percentage event per order, deduplicated to the latest order
# per (child, parent, day); intervals [event_date, next event_date). Customer 0 is its
# own parent (a natural self-parenting row); the tree is ~log3(n) levels deep.
# ---------------------------------------------------------------------------------


def edge_events(spark: SparkSession, root: str) -> DataFrame:
    o = Tables(spark, root).orders
    second = (F.col("o_orderkey") % 5) == 0
    return o.select(
        F.col("o_custkey").alias("child_id"),
        F.when(second, F.expr("o_custkey div 7")).otherwise(F.expr("o_custkey div 3")).alias("parent_id"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.col("o_orderkey").alias("event_id"),
        F.when(second, ((F.col("o_orderkey") % 41) + 10).cast("double") / F.lit(100.0))
         .otherwise(((F.col("o_orderkey") % 51) + 50).cast("double") / F.lit(100.0)).alias("percentage"),
    )


def edges(spark: SparkSession, root: str, orders: str | None = None) -> DataFrame:
    """``orders``: the edges as they stand when only those orders have come."""
    from strata.operators.temporal import intervals_from_events
    from strata.operators.windows import keep_latest
    events = edge_events(spark, root)
    if orders is not None:
        events = events.withColumn("o_orderkey", F.col("event_id")).where(orders).drop("o_orderkey")
    daily = keep_latest(events, ["child_id", "parent_id", "event_date"], ["event_id"])
    return intervals_from_events(daily, ["child_id", "parent_id"], "event_date")


EDGES_CTE = """
edge_events AS (
  SELECT o_custkey AS child_id,
         CASE WHEN o_orderkey % 5 = 0 THEN o_custkey // 7 ELSE o_custkey // 3 END AS parent_id,
         CAST(o_orderdate AS DATE) AS event_date, o_orderkey AS event_id,
         CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 41 + 10 AS DOUBLE) / 100.0
              ELSE CAST(o_orderkey % 51 + 50 AS DOUBLE) / 100.0 END AS percentage
  FROM orders
),
edge_daily AS (
  SELECT * FROM edge_events
  QUALIFY row_number() OVER (PARTITION BY child_id, parent_id, event_date ORDER BY event_id DESC) = 1
),
edges AS (
  SELECT child_id, parent_id, event_date AS active_from, event_id, percentage,
         lead(event_date) OVER (PARTITION BY child_id, parent_id ORDER BY event_date) AS active_to
  FROM edge_daily
)"""


# ---------------------------------------------------------------------------------
# Line items for data-quality checks. Planted: NULL supplier every 97th order, an
# unknown supplier every 89th, an unknown part every 83rd, a lower-cased status code
# every 101st. (l_orderkey, l_linenumber) already has real duplicates.
# ---------------------------------------------------------------------------------


def lineitem_dq(spark: SparkSession, root: str) -> DataFrame:
    li = Tables(spark, root).lineitem
    k = F.col("l_orderkey")
    code = F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus"))
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k % 83 == 0, F.col("l_partkey") + 1000000).otherwise(F.col("l_partkey")).alias("l_partkey"),
        F.when(k % 97 == 0, F.lit(None).cast("bigint"))
         .when(k % 89 == 0, F.col("l_suppkey") + 1000000).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
        "l_quantity", "l_discount", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "l_returnflag", "l_linestatus",
        F.when(k % 101 == 0, F.lower(code)).otherwise(code).alias("status_code"))


LINEITEM_DQ_CTE = """
li_dq AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 83 = 0 THEN l_partkey + 1000000 ELSE l_partkey END AS l_partkey,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN l_suppkey + 1000000
              ELSE l_suppkey END AS l_suppkey,
         l_quantity, l_discount, CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag, l_linestatus,
         CASE WHEN l_orderkey % 101 = 0 THEN lower(concat(l_returnflag, '-', l_linestatus))
              ELSE concat(l_returnflag, '-', l_linestatus) END AS status_code
  FROM lineitem
)"""


# Events as a raw stream landing: ts to a zoned timestamp, value NULL every 9th event.
def events_dq(spark: SparkSession, root: str) -> DataFrame:
    e = Tables(spark, root).events
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
                    F.when(F.col("event_id") % 9 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
                     .alias("value"), "props")


EVENTS_DQ_CTE = """
events_dq AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value, props
  FROM events
)"""


# Edge history as an SCD2-style table with planted defects: end pushed 3 days late
# (overlap) every 17th event, 1 day early (gap) every 19th, before the start every
# 23rd, equal to the start every 29th.
def edges_scd(spark: SparkSession, root: str) -> DataFrame:
    e = edges(spark, root)
    ev, af, at = F.col("event_id"), F.col("active_from"), F.col("active_to")
    return e.select("child_id", "parent_id", "event_id", "percentage", af,
                    F.when(ev % 29 == 0, af).when(ev % 23 == 0, F.date_sub(af, 1))
                     .when(ev % 19 == 0, F.date_sub(at, 1)).when(ev % 17 == 0, F.date_add(at, 3))
                     .otherwise(at).alias("active_to"))


EDGES_SCD_CTE = """
edges_scd AS (
  SELECT child_id, parent_id, event_id, percentage, active_from,
         CASE WHEN event_id % 29 = 0 THEN active_from WHEN event_id % 23 = 0 THEN active_from - 1
              WHEN event_id % 19 = 0 THEN active_to - 1 WHEN event_id % 17 = 0 THEN active_to + 3
              ELSE active_to END AS active_to
  FROM edges
)"""
