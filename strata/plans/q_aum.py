"""Registered FX, track-record, dictionary, variance and mapped-dimension queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.text import metric_slug
from strata.plans import aum_models as AM
from strata.plans.registry import query
from strata.sources.tables import Tables


@query("m19_track_record", """
WITH e AS (
  SELECT n.n_name AS entity,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Gross IRR' WHEN '2-HIGH' THEN 'Net IRR'
              WHEN '3-MEDIUM' THEN 'TVPI' ELSE 'DPI' END AS datapoint_name,
         o.o_totalprice / 100000.0 AS value, CAST(o.o_orderdate AS DATE) AS reporting_date, o.o_orderkey AS revision
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
y AS (SELECT *, CAST(year(reporting_date) AS INTEGER) AS year FROM e),
l AS (SELECT *, lower(regexp_replace(regexp_replace(datapoint_name, '[\\s()]+', '_', 'g'), '_+$', '')) AS metric FROM y
      QUALIFY row_number() OVER (PARTITION BY entity, datapoint_name, year
                                 ORDER BY reporting_date DESC, revision DESC, value DESC) = 1),
w AS (SELECT entity, year, MAX(CASE WHEN metric = 'gross_irr' THEN value END) AS gross_irr,
             MAX(CASE WHEN metric = 'net_irr' THEN value END) AS net_irr,
             MAX(CASE WHEN metric = 'tvpi' THEN value END) AS tvpi, MAX(CASE WHEN metric = 'dpi' THEN value END) AS dpi
      FROM l GROUP BY 1, 2)
SELECT *, year = max(year) OVER (PARTITION BY entity) AS is_active FROM w""")
def m19_track_record(spark, d):
    eav = AM.track_record_eav(spark, d).withColumn("value", F.col("value"))
    return AM.track_record(eav)


def currency_codes(spark, d):
    n = Tables(spark, d).nation
    return n.where(F.col("n_nationkey") % 8 != 0).select(
        F.concat(F.lit("CUR_"), F.col("n_nationkey").cast("string")).alias("currency"),
        F.concat(F.upper(F.substring("n_name", 1, 3)), F.col("n_nationkey").cast("string")).alias("currency_code"))


@query("m1_fx_to_base", """
WITH months AS (SELECT DISTINCT CAST(last_day(o_orderdate) AS DATE) AS ref_date FROM orders),
fx AS (
  SELECT CASE WHEN month(ref_date) % 2 = 1 THEN 'GBP' ELSE 'CUR_' || n_nationkey END AS source_currency,
         CASE WHEN month(ref_date) % 2 = 1 THEN 'CUR_' || n_nationkey ELSE 'GBP' END AS destination_currency,
         ROUND(1.0 + CAST(n_nationkey AS DOUBLE) / 10.0 + CAST(month(ref_date) AS DOUBLE) / 100.0, 6) AS fx_rate, ref_date
  FROM nation, months
),
codes AS (SELECT 'CUR_' || n_nationkey AS currency, upper(substr(n_name, 1, 3)) || n_nationkey AS currency_code
          FROM nation WHERE n_nationkey % 8 <> 0),
legs AS (
  SELECT source_currency AS currency, ref_date, fx_rate AS rate_to_base, 'direct' AS leg FROM fx
  WHERE destination_currency = 'GBP'
  UNION ALL
  SELECT destination_currency, ref_date, ROUND(1.0 / fx_rate, 8), 'inverse' FROM fx WHERE source_currency = 'GBP'
)
SELECT l.*, c.currency_code FROM legs l JOIN codes c USING (currency)""")
def m1_fx_to_base(spark, d):
    return AM.fx_to_base(AM.fx_rates(spark, d, every=True), currency_codes(spark, d))


# -- M19: snapshot and datapoints side by side, melted, year ends -------------------------------
YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
POINTS = {"1-URGENT": "Total NAV Return", "2-HIGH": "Total NAV Return (Annualised)", "3-MEDIUM": "Annualised Dividend Paid"}
SLUGS = ["total_nav_return", "total_nav_return_annualised", "annualised_dividend_paid", "weighted_average_discount_rate"]


def fund_points(spark, d):
    """Datapoints: an order's total per nation and quarter end, the greatest order key being the last revision; no nation of every seven."""
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).where("c_nationkey % 7 <> 0")
    name = F.lit("Weighted Average Discount Rate")
    for k, v in reversed(list(POINTS.items())):
        name = F.when(F.col("o_orderpriority") == k, F.lit(v)).otherwise(name)
    return j.select(F.col("c_nationkey").cast("bigint").alias("fund_id"), AM.quarter_end(F.col("o_orderdate")).alias("report_date"), name.alias("datapoint_name"),
                    (F.col("o_totalprice") / F.lit(100000.0)).alias("value"), F.col("o_orderkey").alias("revision"))


def fund_snapshot(spark, d):
    """A wide table per supplier nation and quarter end, without every fifth nation; one column has gaps."""
    t = Tables(spark, d)
    j = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).where("s_nationkey % 5 <> 0")
    g = j.groupBy(F.col("s_nationkey").cast("bigint").alias("fund_id"), AM.quarter_end(F.col("l_shipdate")).alias("report_date")).agg(
        (F.sum("l_quantity") / 1000.0).alias("DPI"), (F.count(F.lit(1)) / 10.0).alias("MOIC"))
    return g.withColumn("MOIC", F.when(F.month("report_date") != 3, F.col("MOIC")))


def fund_dims(spark, d):
    k = F.col("n_nationkey")
    return Tables(spark, d).nation.select(
        k.cast("bigint").alias("fund_id"), F.col("n_name").alias("fund"), F.when(k % 2 == 0, "GBP").otherwise("EUR").alias("currency"),
        F.date_add(F.lit("1994-01-01").cast("date"), (k * 30).cast("int")).alias("start_date"),
        F.when(k % 6 == 5, F.lit("1999-01-01").cast("date")).alias("end_date"))


def display_names(spark, d):
    """Display names of the metrics but one, from their slugs."""
    names = fund_points(spark, d).select("datapoint_name").distinct()
    return names.select(metric_slug(F.col("datapoint_name")).alias("metric"), F.col("datapoint_name").alias("display_name")).where("metric <> 'annualised_dividend_paid'")


def definitions(spark, d):
    return display_names(spark, d).select("metric", F.concat(F.lit("Definition of "), "display_name").alias("definition")).where("metric <> 'total_nav_return'")


def dictionary(spark, d):
    return AM.metric_dictionary(fund_points(spark, d), fund_snapshot(spark, d), ["fund_id", "report_date"], display_names(spark, d), definitions(spark, d))


M19_CTE = f"""
pts AS (SELECT CAST(c_nationkey AS BIGINT) AS fund_id, CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS report_date,
               CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in POINTS.items())} ELSE 'Weighted Average Discount Rate' END AS datapoint_name,
               o_totalprice / 100000.0 AS value, o_orderkey AS revision
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 7 <> 0),
slugged AS (SELECT *, lower(regexp_replace(regexp_replace(datapoint_name, '[\\s()]+', '_', 'g'), '_+$', '')) AS slug FROM pts),
snap AS (SELECT CAST(s_nationkey AS BIGINT) AS fund_id, CAST(last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS DATE) AS report_date,
                SUM(l_quantity) / 1000.0 AS DPI, count(*) / 10.0 AS m FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey % 5 <> 0 GROUP BY 1, 2),
disp AS (SELECT DISTINCT slug AS metric, datapoint_name AS display_name FROM slugged WHERE slug <> 'annualised_dividend_paid'),
defs AS (SELECT metric, 'Definition of ' || display_name AS definition FROM disp WHERE metric <> 'total_nav_return'),
dict AS (
  SELECT 'fund' AS domain, 'SRCE_SYST_1001' AS source_system_id, dataset_name, slug AS normalised_metric, display_name AS metric, definition
  FROM (SELECT DISTINCT 'datapointsexport' AS dataset_name, slug FROM slugged UNION ALL VALUES ('track_record_fund', 'dpi'), ('track_record_fund', 'moic')) k
  LEFT JOIN disp ON disp.metric = slug LEFT JOIN defs ON defs.metric = slug)"""


@query("m19_track_record_report", f"""
WITH {M19_CTE},
melted AS (
  SELECT fund_id, report_date, slug AS raw_metric, value FROM slugged QUALIFY row_number() OVER (PARTITION BY fund_id, report_date, datapoint_name ORDER BY revision DESC) = 1
  UNION ALL SELECT fund_id, report_date, 'DPI', DPI FROM snap
  UNION ALL SELECT fund_id, report_date, 'MOIC', CASE WHEN month(report_date) <> 3 THEN m END FROM snap),
g AS (SELECT fund_id, raw_metric, max(report_date) FILTER (WHERE value IS NOT NULL) AS latest_metric_date, arg_max(value, report_date) FILTER (WHERE value IS NOT NULL) AS latest_metric_value,
             {', '.join(f"MAX(CASE WHEN report_date = DATE '{y}-12-31' THEN value END) AS y{y}" for y in YEARS)} FROM melted GROUP BY 1, 2),
lastr AS (SELECT fund_id, max(report_date) AS r FROM melted GROUP BY 1),
fd AS (SELECT CAST(n_nationkey AS BIGINT) AS fund_id, n_name AS fund, CASE WHEN n_nationkey % 2 = 0 THEN 'GBP' ELSE 'EUR' END AS currency,
              DATE '1994-01-01' + CAST(n_nationkey * 30 AS INTEGER) AS s, CASE WHEN n_nationkey % 6 = 5 THEN DATE '1999-01-01' END AS e FROM nation)
SELECT g.fund_id, fund, currency, s AS inception_date, COALESCE(r >= s AND (e IS NULL OR r < e), false) AS fund_is_active, raw_metric, display_name AS metric, definition,
       latest_metric_date, ROUND(latest_metric_value, 7) AS latest_metric_value, {', '.join(f'ROUND(y{y}, 7) AS "{y}"' for y in YEARS)}
FROM g LEFT JOIN fd ON fd.fund_id = g.fund_id LEFT JOIN lastr ON lastr.fund_id = g.fund_id LEFT JOIN disp ON disp.metric = raw_metric LEFT JOIN defs ON defs.metric = raw_metric
WHERE latest_metric_date IS NOT NULL""")
def m19_track_record_report(spark, d):
    r = AM.track_record_report(fund_snapshot(spark, d), fund_points(spark, d), fund_dims(spark, d), SLUGS, YEARS, dictionary(spark, d))
    return r.withColumns({c: F.round(c, 7) for c in ["latest_metric_value", *map(str, YEARS)]})


@query("m20_metric_dictionary", f"WITH {M19_CTE} SELECT * FROM dict")
def m20_metric_dictionary(spark, d):
    return dictionary(spark, d)


# -- M21: three tables of different shape ---------------------------------------------------------
def variance_tables(spark, d):
    t = Tables(spark, d)
    months = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
              .groupBy(F.col("c_nationkey").alias("nation"), F.last_day("o_orderdate").alias("month"))
              .agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).cast("double").alias("orders"), F.max("o_orderkey").alias("loaded")))
    years = (t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("yr"))
             .agg(F.sum("l_quantity").alias("quantity"), F.avg("l_tax").alias("tax"), F.max("l_orderkey").alias("loaded")))
    balance = t.customer.select("c_custkey", "c_mktsegment", F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("loaded"))
    return {"nation_months": (months, {"match_keys": ["nation", "month"], "load_date": "loaded", "partition_by": ["nation"], "order_by": {"month": "desc"}, "window": 3}),
            "flag_years": (years, {"match_keys": ["l_returnflag", "yr"], "load_date": "loaded", "partition_by": ["l_returnflag"], "order_by": {"yr": "desc"}, "window": 2,
                                   "exclude": ["tax"]}),
            "balances": (balance, {"match_keys": ["c_custkey"], "load_date": "loaded", "partition_by": ["c_mktsegment"], "order_by": {"c_custkey": "asc"}, "window": 4})}


def variance_sql(name, src, keys, part, order, window, measures):
    over = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN 1 FOLLOWING AND {window} FOLLOWING)"
    key = " || '|' || ".join(f"'{k}=' || CAST({k} AS VARCHAR)" for k in keys)
    diffs = ", ".join(f"abs(({m} - avg({m}) {over}) / NULLIF(avg({m}) {over}, 0) * 100) AS p_{m}" for m in measures)
    most = f"greatest({', '.join('p_' + m for m in measures)})" if len(measures) > 1 else f"p_{measures[0]}"
    which = " ".join(f"WHEN p_{m} = {most} THEN '{m}'" for m in measures)
    return f"SELECT '{name}' AS table_name, {key} AS keys, ROUND({most}, 4) AS max_pct_diff, CASE {which} END AS max_variance_column FROM (SELECT *, {diffs} FROM {src})"


@query("m21_kpi_variance", f"""
WITH nm AS (SELECT c_nationkey AS nation, CAST(last_day(o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS total, CAST(count(*) AS DOUBLE) AS orders
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
fy AS (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS yr, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2),
bl AS (SELECT c_custkey, c_mktsegment, c_acctbal AS balance FROM customer)
{variance_sql('nation_months', 'nm', ['nation', 'month'], 'nation', 'month DESC', 3, ['total', 'orders'])}
UNION ALL {variance_sql('flag_years', 'fy', ['l_returnflag', 'yr'], 'l_returnflag', 'yr DESC', 2, ['quantity'])}
UNION ALL {variance_sql('balances', 'bl', ['c_custkey'], 'c_mktsegment', 'c_custkey', 4, ['balance'])}""")
def m21_kpi_variance(spark, d):
    return AM.kpi_variance(variance_tables(spark, d)).withColumn("max_pct_diff", F.round("max_pct_diff", 4))


# -- M22 --------------------------------------------------------------------------------------------
@query("m22_mapped_dimension", """
WITH map AS (SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 9 = 0 THEN 'SRCE_SYST_1002' ELSE 'SRCE_SYST_1001' END AS system, s_nationkey AS fund_core_id FROM supplier),
core AS (SELECT n_nationkey, n_name, n_regionkey, n_nationkey % 4 <> 0 AS live FROM nation),
names AS (SELECT r_regionkey, r_name, r_regionkey <> 3 AS live FROM region)
SELECT s.s_suppkey, s.s_name, m.fund_core_id, c.n_name AS fund_name, c.n_regionkey AS region_id, r.r_name AS region_name
FROM supplier s JOIN map m ON m.source_id = s.s_suppkey AND system = 'SRCE_SYST_1001' LEFT JOIN core c ON c.n_nationkey = m.fund_core_id AND c.live
LEFT JOIN names r ON r.r_regionkey = c.n_regionkey AND r.live""")
def m22_mapped_dimension(spark, d):
    """Suppliers under their ids of the common model; closed rows of the dimensions do not count."""
    t = Tables(spark, d)
    closed = lambda c: F.when(c, F.lit("2020-01-01").cast("date")).alias("END_AT")
    mapping = t.supplier.select(F.col("s_suppkey").alias("source_id"), F.when(F.col("s_suppkey") % 9 == 0, "SRCE_SYST_1002").otherwise("SRCE_SYST_1001").alias("source_system_id"),
                                F.col("s_nationkey").alias("fund_core_id"))
    core = t.nation.select("n_nationkey", F.col("n_name").alias("fund_name"), F.col("n_regionkey").alias("region_id"), closed(F.col("n_nationkey") % 4 == 0))
    names = t.region.select("r_regionkey", F.col("r_name").alias("region_name"), closed(F.col("r_regionkey") == 3))
    return AM.mapped_dimension(t.supplier.select("s_suppkey", "s_name"), mapping, "SRCE_SYST_1001", "s_suppkey", "fund_core_id",
                               [(core, "fund_core_id", "n_nationkey"), (names, "region_id", "r_regionkey")])
