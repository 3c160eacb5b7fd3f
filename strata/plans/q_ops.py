"""Registered generic operator queries: windows (N1-N13), aggregations (A1-A15) and
joins (J1-J20) on the base tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import joins as J
from strata.operators import temporal as T
from strata.operators import windows as N
from strata.operators.prefix import time_bucket
from strata.plans import bindings as B
from strata.plans.registry import query
from strata.sources.tables import Tables

LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
           "l_linestatus"]


# -- windows ------------------------------------------------------------------------------
@query("n1_keep_latest", f"""
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, {", ".join(c + " DESC NULLS LAST" for c in LI_REST)}) = 1""")
def n1_keep_latest(spark, d):
    return N.keep_latest(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("n2_rank_rows", """
SELECT o_orderkey, o_custkey, o_totalprice,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ASC) AS rank
FROM orders""")
def n2_rank_rows(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return N.rank_rows(o, ["o_custkey"], {"o_totalprice": "desc", "o_orderkey": "asc"})


@query("n3_running_total", """
SELECT o_orderkey, o_custkey, o_orderdate,
       ROUND(SUM(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total
FROM orders""")
def n3_running_total(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = N.running_total(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"running_total": "o_totalprice"}, bucket=time_bucket("o_orderdate", "year"))
    return r.select("o_orderkey", "o_custkey", "o_orderdate", F.round("running_total", 2).alias("running_total"))


@query("n4_fill_forward", f"""
WITH {B.EVENTS_DQ_CTE}
SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM events_dq""")
def n4_fill_forward(spark, d):
    ev = B.events_dq(spark, d).select("event_id", "user_id", "ts", "value")
    return N.fill_forward(ev, ["user_id"], ["ts", "event_id"], ["value"], bucket=time_bucket("ts", "day"))


@query("n5_fill_forward_many", f"""
WITH {B.EVENTS_DQ_CTE},
x AS (SELECT event_id, user_id, ts, value,
             CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS event_type FROM events_dq),
f AS (
  SELECT *, last_value(value IGNORE NULLS) OVER w AS fv, last_value(NULLIF(event_type, '') IGNORE NULLS) OVER w AS ft
  FROM x WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT event_id, user_id, ts, fv AS value, ft AS event_type,
       COALESCE((value IS NULL AND fv IS NOT NULL) OR ((event_type IS NULL OR event_type = '') AND ft IS NOT NULL),
                false) AS backfilled
FROM f""")
def n5_fill_forward_many(spark, d):
    ev = B.events_dq(spark, d).select(
        "event_id", "user_id", "ts", "value",
        F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.col("event_type")).alias("event_type"))
    return N.fill_forward(ev, ["user_id"], ["ts", "event_id"], ["value", "event_type"], flag="backfilled", bucket=time_bucket("ts", "day"))


@query("n6_period_delta", """
SELECT o_orderkey, o_custkey, o_orderdate,
       ROUND(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 2)
         AS price_delta
FROM orders""")
def n6_period_delta(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = N.period_delta(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"price_delta": "o_totalprice"})
    return r.select("o_orderkey", "o_custkey", "o_orderdate", F.round("price_delta", 2).alias("price_delta"))


NATION_YEAR_SQL = """
ny AS (
  SELECT c.c_nationkey AS nation, CAST(year(o.o_orderdate) AS INTEGER) AS yr, SUM(o.o_totalprice) AS total
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2
)"""


def nation_year(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("yr")).agg(
        F.sum("o_totalprice").alias("total"))


@query("n7_agg_delta", f"""
WITH {NATION_YEAR_SQL}
SELECT nation, yr, ROUND(total, 2) AS total,
       ROUND(total - COALESCE(lag(total) OVER (PARTITION BY nation ORDER BY yr), 0), 2) AS delta
FROM ny""")
def n7_agg_delta(spark, d):
    r = N.period_delta(nation_year(spark, d), ["nation"], ["yr"], {"delta": "total"}, default=0.0)
    return r.select("nation", "yr", F.round("total", 2).alias("total"), F.round("delta", 2).alias("delta"))


@query("n8_close_intervals", """
SELECT o_orderkey, o_custkey, o_orderdate,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_date
FROM orders""")
def n8_close_intervals(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return N.close_intervals(o, ["o_custkey"], "o_orderdate", "next_date", tiebreak=["o_orderkey"])


NATION_MONTH_SQL = """
nm AS (
  SELECT c.c_nationkey AS nation, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
         SUM(o.o_totalprice) AS total_price, CAST(count(*) AS DOUBLE) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2
),
rk AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY month DESC) AS rank FROM nm),
av AS (
  SELECT *, avg(total_price) OVER w AS tpa, avg(n_orders) OVER w AS noa
  FROM rk WINDOW w AS (PARTITION BY nation ORDER BY rank ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)
),
pc AS (
  SELECT *, CASE WHEN tpa = 0 OR tpa IS NULL THEN NULL ELSE (total_price - tpa) / tpa END * 100.0 AS tpp,
            CASE WHEN noa = 0 OR noa IS NULL THEN NULL ELSE (n_orders - noa) / noa END * 100.0 AS nop
  FROM av
)"""


@query("n9_rolling_variance", f"""
WITH {NATION_MONTH_SQL}
SELECT nation, month, ROUND(total_price, 2) AS total_price, n_orders, rank,
       ROUND(tpa, 4) AS total_price_rolling_avg, ROUND(noa, 4) AS n_orders_rolling_avg,
       ROUND(tpp, 4) AS total_price_pct_diff, ROUND(nop, 4) AS n_orders_pct_diff,
       ROUND(greatest(abs(tpp), abs(nop)), 4) AS max_abs_pct_diff,
       CASE WHEN abs(tpp) = greatest(abs(tpp), abs(nop)) THEN 'total_price'
            WHEN abs(nop) = greatest(abs(tpp), abs(nop)) THEN 'n_orders' END AS max_diff_column,
       COALESCE(greatest(abs(tpp), abs(nop)) > 50, false) AS high_variance
FROM pc""")
def n9_rolling_variance(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    nm = j.groupBy(F.col("c_nationkey").alias("nation"),
                   F.date_trunc("month", "o_orderdate").cast("date").alias("month")).agg(
        F.sum("o_totalprice").alias("total_price"), F.count(F.lit(1)).cast("double").alias("n_orders"))
    rk = N.rank_rows(nm, ["nation"], {"month": "desc"})
    rv = N.rolling_variance(rk, ["nation"], "rank", ["total_price", "n_orders"], lookback=3, threshold=50)
    r4 = ["total_price_rolling_avg", "n_orders_rolling_avg", "total_price_pct_diff", "n_orders_pct_diff",
          "max_abs_pct_diff"]
    return rv.withColumns({c: F.round(c, 4) for c in r4}).withColumn("total_price", F.round("total_price", 2))


@query("n10_keep_min_priority", """
WITH x AS (SELECT *, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS prio FROM lineitem)
SELECT * FROM x QUALIFY prio = min(prio) OVER (PARTITION BY l_orderkey)""")
def n10_keep_min_priority(spark, d):
    li = Tables(spark, d).lineitem.withColumn(
        "prio", F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3))
    return N.keep_min_priority(li, ["l_orderkey"], "prio")


@query("n11_islands", """
WITH x AS (
  SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS s,
         lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS e
  FROM orders
),
y AS (SELECT * FROM x WHERE e IS NOT NULL AND e > s),
f AS (SELECT *, CASE WHEN lag(e) OVER w IS NULL OR lag(e) OVER w <> s
                          OR NOT (o_orderstatus IS NOT DISTINCT FROM lag(o_orderstatus) OVER w) THEN 1 ELSE 0 END AS nf
      FROM y WINDOW w AS (PARTITION BY o_custkey ORDER BY s)),
g AS (SELECT *, SUM(nf) OVER (PARTITION BY o_custkey ORDER BY s ROWS UNBOUNDED PRECEDING) AS grp FROM f)
SELECT o_custkey, MIN(s) AS s, MAX(e) AS e, MAX(o_orderstatus) AS o_orderstatus FROM g GROUP BY o_custkey, grp""")
def n11_islands(spark, d):
    o = Tables(spark, d).orders
    x = N.close_intervals(o.select("o_custkey", "o_orderstatus", "o_orderkey", F.col("o_orderdate").cast("date").alias("s")),
                          ["o_custkey"], "s", "e", tiebreak=["o_orderkey"])
    y = x.where(F.col("e").isNotNull() & (F.col("e") > F.col("s"))).drop("o_orderkey")
    return T.coalesce_segments(y, ["o_custkey"], ["o_orderstatus"], "s", "e")


@query("n12_grand_total", """
SELECT n_nationkey, n_name, n_regionkey, SUM(n_nationkey) OVER () AS key_total FROM nation""")
def n12_grand_total(spark, d):
    return N.grand_total(Tables(spark, d).nation, {"key_total": "n_nationkey"})


@query("n13_previous_period", """
WITH d AS (SELECT DISTINCT CAST(last_day(o_orderdate) AS DATE) AS period_end FROM orders)
SELECT period_end, lag(period_end) OVER (ORDER BY period_end) AS prev_date FROM d""")
def n13_previous_period(spark, d):
    o = Tables(spark, d).orders.select(F.last_day("o_orderdate").alias("period_end"))
    return N.previous_period(o, "period_end")


# -- aggregations -------------------------------------------------------------------------
@query("a1_agg_sum", """
SELECT l_returnflag, l_linestatus, ROUND(SUM(l_quantity), 2) AS sum_qty, MAX(l_extendedprice) AS max_price,
       MIN(l_discount) AS min_discount, count(*) AS n_lines, ROUND(AVG(l_tax), 6) AS avg_tax
FROM lineitem GROUP BY 1, 2""")
def a1_agg_sum(spark, d):
    r = A.agg_sum(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus"], {
        "sum_qty": ("sum", "l_quantity"), "max_price": ("max", "l_extendedprice"),
        "min_discount": ("min", "l_discount"), "n_lines": ("count", "l_orderkey"), "avg_tax": ("avg", "l_tax")})
    return r.withColumns({"sum_qty": F.round("sum_qty", 2), "avg_tax": F.round("avg_tax", 6)})


@query("a2_sum_by_type", """
SELECT o_custkey, ROUND(SUM(CASE WHEN o_orderstatus IN ('F') THEN o_totalprice ELSE 0 END), 2) AS finished,
       ROUND(SUM(CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice ELSE 0 END), 2) AS open_or_pending
FROM orders GROUP BY o_custkey""")
def a2_sum_by_type(spark, d):
    o = Tables(spark, d).orders
    r = o.groupBy("o_custkey").agg(*A.sum_by_type(o, "o_orderstatus", {
        "finished": (["F"], "o_totalprice"), "open_or_pending": (["O", "P"], "o_totalprice")}))
    return r.withColumns({"finished": F.round("finished", 2), "open_or_pending": F.round("open_or_pending", 2)})


@query("a3_agg_all", """
SELECT count(l_orderkey) AS n, MIN(l_quantity) AS lo, MAX(l_quantity) AS hi, ROUND(AVG(l_quantity), 6) AS mean, ROUND(SUM(l_extendedprice), 2) AS total
FROM lineitem""")
def a3_agg_all(spark, d):
    a = A.agg_sum(Tables(spark, d).lineitem, [], {"n": ("count", "l_orderkey"), "lo": ("min", "l_quantity"), "hi": ("max", "l_quantity"),
                                                  "mean": ("avg", "l_quantity"), "total": ("sum", "l_extendedprice")})
    return a.withColumns({"mean": F.round("mean", 6), "total": F.round("total", 2)})


@query("a4_distinct_count", """
SELECT c.c_nationkey, count(DISTINCT o.o_custkey) AS n_distinct
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""")
def a4_distinct_count(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return A.distinct_count(j, ["c_nationkey"], "o_custkey")


@query("a5_collect_sorted", """
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
FROM orders GROUP BY o_custkey""")
def a5_collect_sorted(spark, d):
    return A.collect_sorted(Tables(spark, d).orders, ["o_custkey"], "o_orderpriority", "priorities", sep=",")


@query("a6_first_non_null", f"""
WITH {B.EVENTS_DQ_CTE}
SELECT user_id, arg_max(value, ts) FILTER (WHERE value IS NOT NULL) AS value FROM events_dq GROUP BY user_id""")
def a6_first_non_null(spark, d):
    return A.first_non_null(B.events_dq(spark, d), ["user_id"], ["value"], "ts")


@query("a7_any_true", """
SELECT o_custkey, COALESCE(bool_or(o_totalprice > 300000), false) AS big_order,
       COALESCE(bool_or(o_orderstatus = 'P'), false) AS has_pending
FROM orders GROUP BY o_custkey""")
def a7_any_true(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", (F.col("o_totalprice") > 300000).alias("big_order"),
                                       (F.col("o_orderstatus") == "P").alias("has_pending"))
    return A.any_true(o, ["o_custkey"], ["big_order", "has_pending"])


@query("a8_product_of", """
WITH x AS (SELECT l_orderkey, 1.0 - l_discount AS keep FROM lineitem)
SELECT l_orderkey, ROUND(product(keep), 6) AS keep_product FROM x GROUP BY l_orderkey""")
def a8_product_of(spark, d):
    li = Tables(spark, d).lineitem
    g = li.groupBy("l_orderkey").agg(F.collect_list(F.lit(1.0) - F.col("l_discount")).alias("ks"))
    return g.select("l_orderkey", F.round(A.product_of(F.col("ks")), 6).alias("keep_product"))


PIVOT_SQL = """
pv AS (
  SELECT c.c_nationkey AS nation,
         ROUND(SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS F,
         ROUND(SUM(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS O,
         ROUND(SUM(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS P
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1
)"""


def _pivot(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_nationkey", "nation")
    p = A.pivot_metric(j, ["nation"], "o_orderstatus", "o_totalprice", ["F", "O", "P"], agg="sum")
    return p.select("nation", *[F.round(c, 2).alias(c) for c in ("F", "O", "P")])


@query("a9_pivot_metric", f"WITH {PIVOT_SQL} SELECT * FROM pv")
def a9_pivot_metric(spark, d):
    return _pivot(spark, d)


@query("a10_melt", f"""
WITH {PIVOT_SQL}
SELECT nation, metric, value FROM (
  SELECT nation, 'F' AS metric, CAST(F AS DOUBLE) AS value FROM pv UNION ALL
  SELECT nation, 'O', CAST(O AS DOUBLE) FROM pv UNION ALL SELECT nation, 'P', CAST(P AS DOUBLE) FROM pv)""")
def a10_melt(spark, d):
    return A.melt(_pivot(spark, d), ["nation"], ["F", "O", "P"])


@query("a11_summary_string", """
SELECT o_custkey, string_agg(DISTINCT o_orderstatus || '|' || o_orderpriority, ', '
                             ORDER BY o_orderstatus || '|' || o_orderpriority) AS summary
FROM orders GROUP BY o_custkey""")
def a11_summary_string(spark, d):
    return A.summary_string(Tables(spark, d).orders, ["o_custkey"], ["o_orderstatus", "o_orderpriority"])


@query("a12_pct_of_total", """
SELECT o_orderpriority, count(*) AS n, count(*) * 100.0 / SUM(count(*)) OVER () AS pct FROM orders GROUP BY 1""")
def a12_pct_of_total(spark, d):
    return A.pct_of_total(Tables(spark, d).orders, ["o_orderpriority"])


@query("a13_share_of_period", """
WITH s AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS yr, r.r_name AS region, SUM(o.o_totalprice) AS total,
         SUM(CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice ELSE 0 END) AS finished
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2
)
SELECT yr, region, ROUND(total, 2) AS total, ROUND(finished, 2) AS finished,
       ROUND(total / NULLIF(SUM(total) OVER (PARTITION BY yr), 0), 6) AS total_share,
       ROUND(finished / NULLIF(SUM(finished) OVER (PARTITION BY yr), 0), 6) AS finished_share
FROM s""")
def a13_share_of_period(spark, d):
    t = Tables(spark, d)
    j = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
                 .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
                 .select(F.year("o_orderdate").alias("yr"), F.col("r_name").alias("region"),
                         F.col("o_totalprice").alias("total"),
                         F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0).alias("finished")))
    s = A.share_of_period(j, ["yr"], "region", ["total", "finished"])
    return s.select("yr", "region", *[F.round(c, 2).alias(c) for c in ("total", "finished")],
                    *[F.round(f"{c}_share", 6).alias(f"{c}_share") for c in ("total", "finished")])


@query("a14_distinct_key_rows", """
SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
       AS distinct_keys FROM lineitem""")
def a14_distinct_key_rows(spark, d):
    li = Tables(spark, d).lineitem
    return li.agg(F.count(F.lit(1)).alias("total_rows"),
                  A.distinct_key_rows(li, ["l_orderkey", "l_linenumber"]).alias("distinct_keys"))


@query("a15_dup_counts", "SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem GROUP BY 1, 2")
def a15_dup_counts(spark, d):
    return A.dup_counts(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


# -- joins ---------------------------------------------------------------------------------
@query("j1_join_inner", "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
def j1_join_inner(spark, d):
    t = Tables(spark, d)
    return J.join_inner(t.orders, t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("j2_enrich", """
SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def j2_enrich(spark, d):
    t = Tables(spark, d)
    e = J.enrich(t.orders, [(t.customer, F.col("o_custkey") == F.col("c_custkey")),
                            (t.nation, F.col("c_nationkey") == F.col("n_nationkey")),
                            (t.region, F.col("n_regionkey") == F.col("r_regionkey"))])
    return e.select("o_orderkey", "c_name", "n_name", "r_name")


@query("j3_full_merge", """
WITH c AS (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer GROUP BY 1),
     s AS (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1)
SELECT COALESCE(c.nationkey, s.nationkey) AS nationkey, n_customers, n_suppliers
FROM c FULL JOIN s ON c.nationkey = s.nationkey""")
def j3_full_merge(spark, d):
    t = Tables(spark, d)
    c = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return J.full_merge(c, s, ["nationkey"])


@query("j4_keep_in", """
SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def j4_keep_in(spark, d):
    t = Tables(spark, d)
    return J.keep_in(t.orders, t.customer.where(F.col("c_mktsegment") == "BUILDING"), "o_custkey", "c_custkey")


@query("j5_not_in", """
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def j5_not_in(spark, d):
    t = Tables(spark, d)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")  # customers who never ordered urgently
    return J.not_in(t.customer, urgent, {"c_custkey": "o_custkey"})


@query("j6_broadcast_dim", """
SELECT s.s_suppkey, s.s_name, n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def j6_broadcast_dim(spark, d):
    t = Tables(spark, d)
    return J.broadcast_dim(t.supplier, t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_name", "n_name")


@query("j7_null_safe_join", """
WITH cv AS (SELECT c_custkey, CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
     sc AS (SELECT seg, count(*) AS seg_customers FROM cv GROUP BY seg)
SELECT cv.c_custkey, cv.seg, sc.seg_customers FROM cv JOIN sc ON cv.seg IS NOT DISTINCT FROM sc.seg""")
def j7_null_safe_join(spark, d):
    c = Tables(spark, d).customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
        .alias("seg"))
    sc = c.groupBy("seg").agg(F.count(F.lit(1)).alias("seg_customers"))
    return J.null_safe_join(c, sc, ["seg"])


@query("j8_attach_scalar", """
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders))
       AS INTEGER) AS days_before_last FROM orders""")
def j8_attach_scalar(spark, d):
    o = Tables(spark, d).orders
    last = o.agg(F.max("o_orderdate").cast("date").alias("last_date"))
    j = J.attach_scalar(o, last)
    return j.select("o_orderkey", F.datediff("last_date", F.col("o_orderdate").cast("date")).alias("days_before_last"))


REPORT_SQL = """
qe AS (SELECT DISTINCT CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS period_end
       FROM orders),
rp AS (SELECT period_end FROM (SELECT period_end, row_number() OVER (ORDER BY period_end) AS rn FROM qe)
       WHERE rn % 3 <> 0 AND period_end < (SELECT max(period_end) FROM qe)),
rpl AS (SELECT period_end, lag(period_end) OVER (ORDER BY period_end) AS prev FROM rp)"""


def report_periods(spark, d):
    o = Tables(spark, d).orders
    qe = o.select(F.last_day(F.add_months(F.date_trunc("quarter", "o_orderdate"), 2)).alias("period_end")).distinct()
    mx = qe.agg(F.max("period_end").alias("_mx"))
    rn = qe.withColumn("rn", F.row_number().over(Window.orderBy("period_end")))
    return (rn.crossJoin(F.broadcast(mx)).where((F.col("rn") % 3 != 0) & (F.col("period_end") < F.col("_mx")))
              .select("period_end"))


@query("j11_bucket_to_period", f"""
WITH {REPORT_SQL}
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS txn_date, r.period_end,
       CASE WHEN r.period_end IS NULL THEN 'Unbucketed' ELSE 'Bucketed' END AS bucket_status
FROM orders o LEFT JOIN rpl r ON CAST(o.o_orderdate AS DATE) <= r.period_end
  AND (r.prev IS NULL OR CAST(o.o_orderdate AS DATE) > r.prev)""")
def j11_bucket_to_period(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("txn_date"))
    return J.bucket_to_period(o, report_periods(spark, d), "txn_date", "period_end")


@query("j12_overlap_join", f"""
WITH {B.EDGES_CTE}, {B.EDGES_SCD_CTE}
SELECT a.child_id, a.parent_id AS parent_a, a.active_from AS from_a, b.parent_id AS parent_b, b.active_from AS from_b
FROM edges_scd a JOIN edges_scd b ON a.child_id = b.child_id AND a.parent_id < b.parent_id
 AND a.active_from < COALESCE(b.active_to, DATE '9999-12-31') AND b.active_from < COALESCE(a.active_to, DATE '9999-12-31')""")
def j12_overlap_join(spark, d):
    e = B.edges_scd(spark, d).select("child_id", "parent_id", "active_from", "active_to")
    side = lambda x: e.select("child_id", F.col("parent_id").alias(f"parent_{x}"), F.col("active_from").alias(f"from_{x}"),
                              F.col("active_to").alias(f"to_{x}"))
    j = T.overlap_join(side("a"), side("b"), ["child_id"], "from_a", "to_a", "from_b", "to_b")
    return j.where(F.col("parent_a") < F.col("parent_b")).select("child_id", "parent_a", "from_a", "parent_b", "from_b")


@query("j13_pair_periods", f"""
WITH {NATION_YEAR_SQL}
SELECT a.nation, a.yr, ROUND(a.total, 2) AS total, a.yr - 1 AS prev_period, ROUND(b.total, 2) AS prev_total
FROM ny a LEFT JOIN ny b ON a.nation = b.nation AND b.yr = a.yr - 1""")
def j13_pair_periods(spark, d):
    ny = nation_year(spark, d)
    prev = ny.select("yr").distinct().select("yr", (F.col("yr") - 1).alias("prev_period"))
    r = J.pair_periods(ny, ["nation"], "yr", prev, ["total"])
    return r.select("nation", "yr", F.round("total", 2).alias("total"), "prev_period",
                    F.round("prev_total", 2).alias("prev_total"))


@query("j16_join_coalesced", """
WITH c AS (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer GROUP BY 1),
     s AS (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1),
     m AS (SELECT COALESCE(c.nationkey, s.nationkey) AS nk, n_customers, n_suppliers FROM c FULL JOIN s ON c.nationkey = s.nationkey)
SELECT m.nk, m.n_customers, m.n_suppliers, n.n_name FROM m JOIN nation n ON m.nk = n.n_nationkey""")
def j16_join_coalesced(spark, d):
    t = Tables(spark, d)
    c = t.customer.groupBy(F.col("c_nationkey").alias("ck")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("sk")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    m = c.join(s, F.col("ck") == F.col("sk"), "full")
    j = J.join_coalesced(m, t.nation, F.coalesce("ck", "sk"), F.col("n_nationkey"))
    return j.select(F.coalesce("ck", "sk").alias("nk"), "n_customers", "n_suppliers", "n_name")


@query("j17_mapped_join", """
SELECT s.*, n.n_nationkey AS dim_n_nationkey, n.n_name AS dim_n_name, n.n_regionkey AS dim_n_regionkey
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def j17_mapped_join(spark, d):
    t = Tables(spark, d)
    return J.mapped_join(t.supplier, t.nation, {"s_nationkey": "n_nationkey"}, "left", prefix="dim_")


@query("j18_trim_join", """
WITH padded AS (SELECT c_custkey AS k2, CASE WHEN c_custkey % 3 = 0 THEN '  ' || c_name || ' ' ELSE c_name END AS pname
                FROM customer)
SELECT c.c_custkey, p.k2 FROM customer c JOIN padded p ON trim(c.c_name) = trim(p.pname)""")
def j18_trim_join(spark, d):
    c = Tables(spark, d).customer
    p = c.select(F.col("c_custkey").alias("k2"),
                 F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
                  .otherwise(F.col("c_name")).alias("pname"))
    return J.trim_join(c, p, "c_name", "pname").select("c_custkey", "k2")


@query("j20_key_date_grid", """
WITH x AS (SELECT c.c_nationkey AS nation, o.o_custkey AS member, CAST(date_trunc('year', o.o_orderdate) AS DATE) AS yr
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
m AS (SELECT DISTINCT nation, member FROM x), dd AS (SELECT DISTINCT nation, yr FROM x)
SELECT m.nation, m.member, dd.yr FROM m JOIN dd ON m.nation = dd.nation""")
def j20_key_date_grid(spark, d):
    t = Tables(spark, d)
    x = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("nation"), F.col("o_custkey").alias("member"),
        F.date_trunc("year", "o_orderdate").cast("date").alias("yr"))
    return J.key_date_grid(x, "nation", "member", "yr")
