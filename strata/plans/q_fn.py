"""One ``fn_<family>`` query per scalar-function family of SURVEY 2.8, plus the
month-end FX conversion (J14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import text as X
from strata.operators.recon import similarity
from strata.plans import aum_models as AM
from strata.plans.registry import query
from strata.sources import ingest as I
from strata.sources.tables import Tables


@query("fn_string", r"""
SELECT c_custkey, upper(c_mktsegment) AS up, length(c_name) AS len, replace(c_name, 'Customer#', 'C') AS short,
       substring(c_name, 10, 9) AS digits, split_part(c_name, '#', 2) AS after_hash,
       regexp_extract(c_name, '([0-9]+)$', 1) AS num, c_name LIKE 'Customer#0000001%' AS like_hit,
       starts_with(c_mktsegment, 'B') AS starts_b, concat_ws('/', c_mktsegment, c_name) AS joined,
       lower(regexp_replace(trim(regexp_replace('  ' || c_mktsegment || ' Limited, Co.  ', '\s+', ' ', 'g')), ',|\.', '', 'g'))
         AS norm_raw
FROM customer""")
def fn_string(spark, d):
    c = Tables(spark, d).customer
    return c.select(
        "c_custkey", F.upper("c_mktsegment").alias("up"), F.length("c_name").alias("len"),
        F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("C")).alias("short"),
        F.substring("c_name", 10, 9).alias("digits"), F.split("c_name", "#").getItem(1).alias("after_hash"),
        F.regexp_extract("c_name", r"([0-9]+)$", 1).alias("num"),
        F.col("c_name").like("Customer#0000001%").alias("like_hit"), F.col("c_mktsegment").startswith("B").alias("starts_b"),
        F.concat_ws("/", "c_mktsegment", "c_name").alias("joined"),
        F.lower(F.regexp_replace(F.trim(F.regexp_replace(F.concat(F.lit("  "), F.col("c_mktsegment"),
                                                                  F.lit(" Limited, Co.  ")), r"\s+", " ")),
                                 r",|\.", "")).alias("norm_raw"))


@query("fn_text_normalisers", r"""
SELECT p_partkey,
  regexp_replace(regexp_replace(lower(trim(regexp_replace(p_name || ' Limited.', '\s+', ' ', 'g'))), '\blimited\b', 'ltd', 'g'),
                 '[,.]', '', 'g') AS norm_name,
  lower(regexp_replace(regexp_replace(p_type || ' (' || p_name || ') ', '[\s()]+', '_', 'g'), '_+$', '')) AS slug
FROM part""")
def fn_text_normalisers(spark, d):
    p = Tables(spark, d).part
    return p.select("p_partkey", X.normalise_name(F.concat("p_name", F.lit(" Limited."))).alias("norm_name"),
                    X.metric_slug(F.concat("p_type", F.lit(" ("), "p_name", F.lit(") "))).alias("slug"))


@query("fn_similarity", """
SELECT s_suppkey, c_custkey,
  ROUND(1.0 - CAST(levenshtein(lower(trim(s_name)), lower(trim(c_name))) AS DOUBLE)
        / greatest(length(trim(s_name)), length(trim(c_name))), 6) AS score
FROM supplier JOIN customer ON s_suppkey = c_custkey""")
def fn_similarity(spark, d):
    t = Tables(spark, d)
    j = t.supplier.join(t.customer, F.col("s_suppkey") == F.col("c_custkey"))
    return j.select("s_suppkey", "c_custkey", F.round(similarity(F.col("s_name"), F.col("c_name")), 6).alias("score"))


@query("fn_date", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start, CAST(last_day(o_orderdate) AS DATE) AS month_end,
       CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(dayofmonth(o_orderdate) AS INTEGER) AS dom, strftime(o_orderdate, '%Y-%m') AS ym,
       concat(CAST(year(o_orderdate) AS VARCHAR), '-Q', CAST(quarter(o_orderdate) AS VARCHAR)) AS yq
FROM orders""")
def fn_date(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", F.date_trunc("month", "o_orderdate").cast("date").alias("month_start"),
                    F.date_trunc("quarter", "o_orderdate").cast("date").alias("quarter_start"),
                    F.last_day("o_orderdate").alias("month_end"), F.quarter("o_orderdate").alias("q"),
                    F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("dom"),
                    F.date_format("o_orderdate", "yyyy-MM").alias("ym"), X.quarter_label(F.col("o_orderdate")).alias("yq"))


@query("fn_math", """
SELECT l_orderkey, l_linenumber, l_partkey, abs(l_quantity - 25) AS dist, greatest(l_discount, l_tax) AS top_rate,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS ratio, -l_extendedprice AS neg_price
FROM lineitem""")
def fn_math(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.abs(F.col("l_quantity") - 25).alias("dist"),
                     F.greatest("l_discount", "l_tax").alias("top_rate"),
                     F.try_divide(F.col("l_discount"), F.nullif(F.col("l_tax"), F.lit(0.0))).alias("ratio"),
                     (-F.col("l_extendedprice")).alias("neg_price"))


@query("fn_array_hof", """
WITH a AS (SELECT o_custkey, list_sort(list_distinct(list(o_orderpriority))) AS pr,
                  list_sort(list(CAST(o_orderkey AS BIGINT))) AS ks FROM orders GROUP BY o_custkey)
SELECT o_custkey, len(pr) AS n_pr, array_to_string(pr, ',') AS pr, ks[1] AS first_key, ks[-1] AS last_key,
       list_contains(pr, '1-URGENT') AS has_urgent,
       array_to_string(list_filter(pr, lambda x: x <> '5-LOW'), ',') AS not_low,
       array_to_string(list_transform(pr, lambda x: substr(x, 1, 1)), '') AS codes,
       list_reduce(list_transform(ks, lambda x: x % 7), lambda acc, x: acc + x) AS mod_sum,
       len(list_filter(ks, lambda x: x % 2 = 0)) > 0 AS any_even,
       len(list_filter(ks, lambda x: x >= 0)) = len(ks) AS all_nonneg,
       array_to_string(ks[1:2], ',') AS first_two
FROM a""")
def fn_array_hof(spark, d):
    o = Tables(spark, d).orders
    a = o.groupBy("o_custkey").agg(F.sort_array(F.collect_set("o_orderpriority")).alias("pr"),
                                   F.sort_array(F.collect_list("o_orderkey")).alias("ks"))
    return a.select("o_custkey", F.size("pr").alias("n_pr"), F.array_join("pr", ",").alias("pr"),
                    F.element_at("ks", 1).alias("first_key"), F.element_at("ks", -1).alias("last_key"),
                    F.array_contains("pr", "1-URGENT").alias("has_urgent"),
                    F.array_join(F.filter("pr", lambda x: x != "5-LOW"), ",").alias("not_low"),
                    F.array_join(F.transform("pr", lambda x: F.substring(x, 1, 1)), "").alias("codes"),
                    F.aggregate(F.transform("ks", lambda x: x % 7), F.lit(0).cast("bigint"),
                                lambda acc, x: acc + x).alias("mod_sum"),
                    F.exists("ks", lambda x: x % 2 == 0).alias("any_even"),
                    F.forall("ks", lambda x: x >= 0).alias("all_nonneg"),
                    F.array_join(F.slice("ks", 1, 2).cast("array<string>"), ",").alias("first_two"))


@query("fn_map_struct", """
SELECT n.n_nationkey, n.n_name, r.r_name AS region_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def fn_map_struct(spark, d):
    t = Tables(spark, d)
    # an id -> struct map per region row, read through the join
    dim = t.region.select("r_regionkey", F.create_map(F.col("r_regionkey"), F.struct(F.col("r_name").alias("name"))).alias("m"))
    j = t.nation.join(dim, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select("n_nationkey", "n_name", F.element_at("m", F.col("n_regionkey"))["name"].alias("region_name"))


@query("fn_json_hash", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       sha256(CAST(event_id AS VARCHAR) || ':' || event_type) AS h
FROM events""")
def fn_json_hash(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                    F.sha2(F.concat(F.col("event_id").cast("string"), F.lit(":"), F.col("event_type")), 256).alias("h"))


@query("fn_array_sets", """
WITH g AS (SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag))) AS f, list_sort(list_distinct(list(l_linestatus))) AS s, list(l_linenumber ORDER BY l_linenumber) AS n,
                  list(l_quantity ORDER BY l_linenumber, l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_sort(list_distinct(list_concat(f, s))), ',') AS both,
       array_to_string(list_transform(range(1, len(n) + 1), lambda i: CAST(n[i] AS VARCHAR) || ':' || CAST(CAST(q[i] AS BIGINT) AS VARCHAR)), ',') AS zipped FROM g""")
def fn_array_sets(spark, d):
    g = Tables(spark, d).lineitem.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("l_returnflag")).alias("f"), F.array_sort(F.collect_set("l_linestatus")).alias("s"),
        F.array_sort(F.collect_list("l_linenumber")).alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))), lambda x: x["l_quantity"]).alias("q"))
    pair = F.transform(F.arrays_zip("n", "q"), lambda x: F.concat(x["n"].cast("string"), F.lit(":"), x["q"].cast("bigint").cast("string")))
    return g.select("l_orderkey", F.array_join(F.array_sort(F.array_union("f", "s")), ",").alias("both"), F.array_join(pair, ",").alias("zipped"))


@query("fn_bounded_ts", """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-05' OR ts > TIMESTAMP '2024-01-25' THEN NULL ELSE ts END AS bounded FROM events""")
def fn_bounded_ts(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", X.bounded_ts(F.col("ts").cast("timestamp"), "2024-01-05", "2024-01-25").alias("bounded"))


@query("fn_try_cast", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(38, 18)) END AS amount,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def fn_try_cast(spark, d):
    """Bad values become NULL: every 7th amount is a word, every 5th date has another format."""
    o = Tables(spark, d).orders
    raw = o.select(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
                   F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("day"))
    return I.cast_to_schema(raw, {"o_orderkey": "BIGINT", "amount": "DECIMAL(38,18)", "day": "DATE"}, date_formats={"day": "dd-MM-yyyy"}, on_error="null")


@query("j14_convert_at_month_end", """
WITH seen AS (SELECT DISTINCT c_nationkey AS n_nationkey, CAST(last_day(o_orderdate) AS DATE) AS ref_date FROM orders JOIN customer ON o_custkey = c_custkey),
fx AS (
  SELECT CASE WHEN month(ref_date) % 2 = 1 THEN 'GBP' ELSE 'CUR_' || n_nationkey END AS source_currency,
         CASE WHEN month(ref_date) % 2 = 1 THEN 'CUR_' || n_nationkey ELSE 'GBP' END AS destination_currency,
         ROUND(1.0 + CAST(n_nationkey AS DOUBLE) / 10.0 + CAST(month(ref_date) AS DOUBLE) / 100.0, 6) AS fx_rate, ref_date
  FROM seen
)
SELECT o.o_orderkey, o.o_totalprice, f.fx_rate, ROUND(o.o_totalprice * f.fx_rate, 4) AS amount_gbp
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN fx f ON f.source_currency = 'CUR_' || c.c_nationkey AND f.destination_currency = 'GBP'
 AND f.ref_date = CAST(last_day(o.o_orderdate) AS DATE)""")
def j14_convert_at_month_end(spark, d):
    t = Tables(spark, d)
    fx = AM.fx_rates(spark, d).where(F.col("destination_currency") == "GBP")
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", F.concat(F.lit("CUR_"), F.col("c_nationkey").cast("string")).alias("ccy"),
        F.last_day("o_orderdate").alias("month_end"))
    j = o.join(fx, (F.col("ccy") == F.col("source_currency")) & (F.col("month_end") == F.col("ref_date")), "left")
    # missing rate -> NULL amount (SQL behaviour of the reference, not the documented 1.0)
    return j.select("o_orderkey", "o_totalprice", "fx_rate",
                    F.round(F.col("o_totalprice") * F.col("fx_rate"), 4).alias("amount_gbp"))
