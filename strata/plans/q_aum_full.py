"""Registered queries of the full AUM models: M2-M7, M17, M18.

Bindings: asset-level measures = line items x part x supplier per quarter end (fund = supplier
nation, portfolio = brand); fund-level measures = orders per customer nation and quarter. Some
derived metrics are reported, some of those off by a planted amount, so that checks fire."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.windows import fill_forward
from strata.plans import aum_core as AC
from strata.plans import aum_models as AM
from strata.plans.registry import query
from strata.sources.tables import Tables

CUTOFF = "1998-01-01"
ASSET_FACTORS = {"ASSET_DEBT": 100.0, "ASSET_DEBT_CMT": 10.0, "ASSET_EQUITY_CMT": 5.0, "EXTERNAL_DEBT_COMMIT": 2.0,
                 "ADJ_UNDRAWNCOMMITMENT": 1.0, "ASSET_LEVEL_CASH": 3.0, "ASSET_LEVEL_CASH_ADJ": -1.0}
FUND_FACTORS = {"FUND_CASH_UP": 0.02, "FUND_CASH_DOWN": 0.01, "FUND_CASH_EXP": -0.05, "FUND_CASH_OTHER": 0.03, "FUND_VALUE_ADJ": -0.01,
                "FUND_REMOVE_DBL": -0.02, "TOTAL_FUND_DEBT": 0.15, "TOTAL_FUND_CAPITAL_HR": 0.3, "UNDRAWN_FUND_DEBT": 0.04,
                "FUND_CAPITAL_DR": 0.01, "FUND_CONDITIONAL_ACQ_EQ": 0.02, "TOTAL_COMMITTED": 0.5, "EXPIRED_COMMITMENT": -0.1, "TOTAL_CALLED": 0.25,
                "RETURN_OF_CALL": -0.05, "TOTAL_RECALLED": 0.02}
BUY = ["EQ - Purchase/Subscription (w/o Commitment)", "EQ - Subscription (Capital Issue following Commitment)",
       "LN - Advance/Purchase (w/o commitment)", "LN - Advance (following Commitment)"]
SELL = ["EQ - Sale/Redemption"]


def levels(spark, d):
    t = Tables(spark, d)
    j = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")))
    px = F.col("l_extendedprice")
    a = j.groupBy(AM.quarter_end(F.col("l_shipdate")).alias("report_date"), F.col("n_name").alias("fund"), F.col("p_brand").alias("portfolio")).agg(
        F.sum(px * (F.lit(1.0) - F.col("l_discount"))).alias("EQ_VALUATION"), F.sum(px * F.col("l_discount")).alias("LN_VALUATION"),
        F.sum(px * F.col("l_tax")).alias("LOAN_BALANCE"), *[(F.sum("l_quantity") * F.lit(f)).alias(m) for m, f in ASSET_FACTORS.items()])
    b = F.substring("portfolio", 7, 3).cast("int")
    nav = F.col("EQ_VALUATION") + F.col("LN_VALUATION") + F.col("LOAN_BALANCE")
    a = a.withColumns({"ASSET_NAV": F.when(b % 7 == 0, F.lit(None)).when(b % 5 == 0, nav + F.lit(10.0)).otherwise(nav),
                       "PORTFOLIO_GAV": F.when(b % 4 == 0, nav + F.col("ASSET_DEBT") - F.lit(1.0)),
                       "AUM": F.when(b % 9 == 0, nav + F.lit(7.0)), "DRY_POWDER": F.when(b % 11 == 0, F.lit(3.0))})
    # brands whose amounts cancel out: the row is suppressed though none of them is 0
    others = [c for c in a.columns if c not in ("report_date", "fund", "portfolio", "ASSET_LEVEL_CASH_ADJ")]
    cancel = -sum((F.coalesce(F.col(c), F.lit(0.0)) for c in others), F.lit(0.0))
    a = a.withColumn("ASSET_LEVEL_CASH_ADJ", F.when(b % 13 == 0, cancel).otherwise(F.col("ASSET_LEVEL_CASH_ADJ")))
    o = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    f = o.groupBy(AM.quarter_end(F.col("o_orderdate")).alias("report_date"), F.col("n_name").alias("fund"), F.col("n_nationkey").alias("k")).agg(
        *[(F.sum("o_totalprice") * F.lit(x)).alias(m) for m, x in FUND_FACTORS.items()])
    k = F.col("k")
    f = f.withColumns({"portfolio": F.lit("Fund Level"), "FUND_NAV": F.when(k % 3 == 0, F.lit(5.0)), "FUM": F.when(k % 4 == 0, F.lit(50.0)),
                       "FUND_GAV": F.when(k % 5 == 0, F.lit(500.0))}).drop("k")
    return a, f


def full_metrics(spark, d):
    ids = Tables(spark, d).nation.select(F.col("n_name").alias("fund"), F.col("n_nationkey").alias("fund_id"))
    # four digits: amounts are exact there, so that no engine meets a tie
    return AC.aum_metrics(levels(spark, d), ids, CUTOFF, check_digits=4)


# The oracle is written out term by term: it knows nothing of the model's own tables of terms.
METRICS_CTE = """
a0 AS (
  SELECT CAST(last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS DATE) AS report_date, n_name AS fund, p_brand AS portfolio,
         CAST(substr(p_brand, 7, 3) AS INTEGER) AS b, SUM(l_extendedprice * (1.0 - l_discount)) AS EQ_VALUATION, SUM(l_extendedprice * l_discount) AS LN_VALUATION,
         SUM(l_extendedprice * l_tax) AS LOAN_BALANCE, SUM(l_quantity) AS q
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3, 4),
a1 AS (
  SELECT *, EQ_VALUATION + LN_VALUATION + LOAN_BALANCE AS nav, q * 100.0 AS ASSET_DEBT, q * 10.0 AS ASSET_DEBT_CMT, q * 5.0 AS ASSET_EQUITY_CMT, q * 2.0 AS EXTERNAL_DEBT_COMMIT,
         q * 1.0 AS ADJ_UNDRAWNCOMMITMENT, q * 3.0 AS ASSET_LEVEL_CASH FROM a0),
a2 AS (
  SELECT *, CASE WHEN b % 7 = 0 THEN NULL WHEN b % 5 = 0 THEN nav + 10.0 ELSE nav END AS ASSET_NAV, CASE WHEN b % 4 = 0 THEN nav + ASSET_DEBT - 1.0 END AS PORTFOLIO_GAV,
         CASE WHEN b % 9 = 0 THEN nav + 7.0 END AS AUM, CASE WHEN b % 11 = 0 THEN 3.0 END AS DRY_POWDER FROM a1),
asset AS (
  SELECT * EXCLUDE (nav, b, q),
         CASE WHEN b % 13 = 0 THEN -(EQ_VALUATION + LN_VALUATION + LOAN_BALANCE + ASSET_DEBT + ASSET_DEBT_CMT + ASSET_EQUITY_CMT + EXTERNAL_DEBT_COMMIT + ADJ_UNDRAWNCOMMITMENT
                                     + ASSET_LEVEL_CASH + COALESCE(ASSET_NAV, 0.0) + COALESCE(PORTFOLIO_GAV, 0.0) + COALESCE(AUM, 0.0) + COALESCE(DRY_POWDER, 0.0))
              ELSE q * -1.0 END AS ASSET_LEVEL_CASH_ADJ FROM a2),
f0 AS (
  SELECT CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS report_date, n_name AS fund, n_nationkey AS k, SUM(o_totalprice) AS p
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3),
fundl AS (
  SELECT report_date, fund, 'Fund Level' AS portfolio, p * 0.02 AS FUND_CASH_UP, p * 0.01 AS FUND_CASH_DOWN, p * -0.05 AS FUND_CASH_EXP, p * 0.03 AS FUND_CASH_OTHER,
         p * -0.01 AS FUND_VALUE_ADJ, p * -0.02 AS FUND_REMOVE_DBL, p * 0.15 AS TOTAL_FUND_DEBT, p * 0.3 AS TOTAL_FUND_CAPITAL_HR, p * 0.04 AS UNDRAWN_FUND_DEBT,
         p * 0.01 AS FUND_CAPITAL_DR, p * 0.02 AS FUND_CONDITIONAL_ACQ_EQ, p * 0.5 AS TOTAL_COMMITTED, p * -0.1 AS EXPIRED_COMMITMENT, p * 0.25 AS TOTAL_CALLED,
         p * -0.05 AS RETURN_OF_CALL, p * 0.02 AS TOTAL_RECALLED, CASE WHEN k % 3 = 0 THEN 5.0 END AS FUND_NAV, CASE WHEN k % 4 = 0 THEN 50.0 END AS FUM,
         CASE WHEN k % 5 = 0 THEN 500.0 END AS FUND_GAV FROM f0),
summed AS (SELECT * FROM asset UNION ALL BY NAME SELECT * FROM fundl),
known AS (
  SELECT *, COALESCE(EQ_VALUATION, 0.0) AS eq, COALESCE(LN_VALUATION, 0.0) AS ln_, COALESCE(LOAN_BALANCE, 0.0) AS lb, COALESCE(ASSET_DEBT, 0.0) AS ad,
         COALESCE(ASSET_DEBT_CMT, 0.0) AS adc, COALESCE(ASSET_EQUITY_CMT, 0.0) AS aec, COALESCE(EXTERNAL_DEBT_COMMIT, 0.0) AS edc, COALESCE(ADJ_UNDRAWNCOMMITMENT, 0.0) AS auc,
         COALESCE(ASSET_LEVEL_CASH, 0.0) AS alc, COALESCE(ASSET_LEVEL_CASH_ADJ, 0.0) AS ala, COALESCE(FUND_CASH_UP, 0.0) AS fcu, COALESCE(FUND_CASH_DOWN, 0.0) AS fcd,
         COALESCE(FUND_CASH_EXP, 0.0) AS fce, COALESCE(FUND_CASH_OTHER, 0.0) AS fco, COALESCE(FUND_VALUE_ADJ, 0.0) AS fva, COALESCE(FUND_REMOVE_DBL, 0.0) AS frd,
         COALESCE(TOTAL_FUND_DEBT, 0.0) AS tfd, COALESCE(TOTAL_FUND_CAPITAL_HR, 0.0) AS tfc, COALESCE(UNDRAWN_FUND_DEBT, 0.0) AS ufd, COALESCE(FUND_CAPITAL_DR, 0.0) AS fcdr,
         COALESCE(FUND_CONDITIONAL_ACQ_EQ, 0.0) AS fca FROM summed),
calc AS (
  SELECT *, COALESCE(ASSET_NAV, eq + ln_ + lb) AS CALC_ASSET_NAV, COALESCE(FUND_NAV, fcu + fcd + fce + fco + fva - tfd + eq + ln_ + lb) AS CALC_FUND_NAV,
         COALESCE(FUM, fcu + fcd + fce + fco + fva - tfd + eq + ln_ + lb + tfc) AS CALC_FUM, COALESCE(PORTFOLIO_GAV, eq + ln_ + lb + ad) AS CALC_PORTFOLIO_GAV,
         COALESCE(FUND_GAV, eq + ln_ + lb + ad + fcu + fcd + fce + fco + fva) AS CALC_FUND_GAV,
         COALESCE(AUM, eq + ln_ + lb + ad + adc + aec + edc + auc + fcu + fcd + fce + fco + fva + frd) AS CALC_AUM,
         COALESCE(DRY_POWDER, tfc + ufd + fco + fcd + fce + fcdr + alc + ala - adc - aec - auc - fca) AS CALC_DRY_POWDER FROM known),
metrics AS (
  SELECT c.*, n_nationkey AS fund_id,
         ROUND(CASE WHEN report_date < DATE '1998-01-01' THEN eq - COALESCE(ASSET_NAV, 0.0) ELSE eq + ln_ + lb - COALESCE(ASSET_NAV, 0.0) END, 4) AS CHECK_ASSET_NAV,
         ROUND(CASE WHEN report_date >= DATE '1998-01-01' THEN fcu + fcd + fce + fco + fva - tfd + eq + ln_ + lb - CALC_FUND_NAV END, 4) AS CHECK_FUND_NAV,
         ROUND(CASE WHEN report_date < DATE '1998-01-01' THEN fco + eq + fcd + fva - tfd - COALESCE(FUM, 0.0) - COALESCE(ASSET_NAV, 0.0)
                    ELSE fcu + fcd + fce + fco + fva - tfd + eq + ln_ + lb + tfc - CALC_FUM END, 4) AS CHECK_FUM,
         ROUND(CASE WHEN report_date >= DATE '1998-01-01' THEN eq + ln_ + lb + ad - COALESCE(PORTFOLIO_GAV, 0.0) END, 4) AS CHECK_PORTFOLIO_GAV,
         ROUND(CASE WHEN report_date >= DATE '1998-01-01' THEN eq + ln_ + lb + ad + fcu + fcd + fce + fco + fva - CALC_FUND_GAV END, 4) AS CHECK_FUND_GAV,
         ROUND(CASE WHEN report_date < DATE '1998-01-01' THEN eq + ad + aec + alc + fco + tfc + fcd - COALESCE(AUM, 0.0)
                    ELSE eq + ln_ + lb + ad + adc + aec + edc + auc + fcu + fcd + fce + fco + fva + frd - CALC_AUM END, 4) AS CHECK_AUM,
         ROUND(CASE WHEN report_date >= DATE '1998-01-01' THEN tfc + ufd + fco + fcd + fce + fcdr + alc + ala - adc - aec - auc - fca - CALC_DRY_POWDER END, 4) AS CHECK_DRY_POWDER
  FROM calc c LEFT JOIN nation ON fund = n_name
  WHERE portfolio = 'Fund Level' OR abs(COALESCE(ASSET_NAV, 0.0) + COALESCE(FUND_NAV, 0.0) + COALESCE(FUM, 0.0) + COALESCE(PORTFOLIO_GAV, 0.0) + COALESCE(FUND_GAV, 0.0)
        + COALESCE(AUM, 0.0) + COALESCE(DRY_POWDER, 0.0) + fcu + fcd + fce + fcdr + fco + fva + frd + fca + tfd + ufd + COALESCE(TOTAL_COMMITTED, 0.0)
        + COALESCE(EXPIRED_COMMITMENT, 0.0) + COALESCE(TOTAL_CALLED, 0.0) + COALESCE(RETURN_OF_CALL, 0.0) + COALESCE(TOTAL_RECALLED, 0.0) + tfc + eq + ln_ + lb + ad + adc + aec
        + edc + auc + alc + ala) >= 0.005)"""

NAMES = ["ASSET_NAV", "FUND_NAV", "FUM", "PORTFOLIO_GAV", "FUND_GAV", "AUM", "DRY_POWDER"]
SHOWN = [f"CALC_{m}" for m in NAMES]
CHECKS = [f"CHECK_{m}" for m in NAMES]


@query("m2_aum_metrics", f"""
WITH {METRICS_CTE}
SELECT report_date, fund, portfolio, fund_id, {', '.join(f'ROUND({c}, 4) + 0.0 AS {c}' for c in SHOWN)}, {', '.join(f'{c} + 0.0 AS {c}' for c in CHECKS)}
FROM metrics""")
def m2_aum_metrics(spark, d):
    m = full_metrics(spark, d)
    return m.select("report_date", "fund", "portfolio", "fund_id", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in SHOWN],
                    *[(F.col(c) + F.lit(0.0)).alias(c) for c in CHECKS])


@query("m2_checks_that_fire", f"""
WITH {METRICS_CTE}
SELECT {', '.join(f"SUM(CASE WHEN abs({c}) >= 0.01 THEN 1 ELSE 0 END)::BIGINT AS {c}" for c in CHECKS)} FROM metrics""")
def m2_checks_that_fire(spark, d):
    return full_metrics(spark, d).agg(*[F.sum(F.when(F.abs(c) >= 0.01, 1).otherwise(0)).alias(c) for c in CHECKS])


# -- M18 ------------------------------------------------------------------------------------
def transactions(spark, d):
    t = Tables(spark, d)
    j = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")))
    kind = (F.when(F.col("l_returnflag") == "R", SELL[0]).when(F.col("l_returnflag") == "A", BUY[0])
            .when(F.col("l_linenumber") % 4 == 0, "Other").when(F.col("l_linenumber") % 4 == 1, BUY[1]).when(F.col("l_linenumber") % 4 == 2, BUY[2])
            .otherwise(BUY[3]))
    sale = F.col("l_returnflag") == "R"
    return j.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"), F.col("n_name").alias("fund"),
                    F.when(F.col("l_orderkey") % 31 == 0, F.lit(" ")).when(F.col("l_orderkey") % 29 == 0, F.lit("Unknown"))
                    .otherwise(F.col("p_brand")).alias("portfolio"), kind.alias("type"),
                    F.when(sale, F.col("l_extendedprice")).otherwise(-F.col("l_extendedprice")).alias("amount"),
                    F.when(F.col("n_nationkey") % 5 == 0, F.lit("gbp ")).otherwise(F.concat(F.lit("CUR_"), F.col("n_nationkey").cast("string"))).alias("currency"),
                    F.col("l_shipdate").cast("date").alias("transaction_date"), F.when(F.col("l_orderkey") % 50 == 0, "True").otherwise("False").alias("draft"))


def rates(spark, d):
    """Month-end rates of the ship dates; every 6th currency has none."""
    t = Tables(spark, d)
    li = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).where("s_nationkey % 6 <> 1")
    pairs = li.select(F.col("s_nationkey").alias("n"), F.last_day(F.col("l_shipdate").cast("date")).alias("ref_date")).distinct()
    return pairs.select(F.concat(F.lit("CUR_"), F.col("n").cast("string")).alias("currency"), "ref_date",
                        (F.lit(1.0) + F.col("n") / F.lit(10.0) + F.month("ref_date") / F.lit(100.0)).alias("rate_to_base"))


def moves(spark, d, metrics):
    return AC.capital_transactions(transactions(spark, d), rates(spark, d), metrics, BUY + SELL)


QUOTED = ", ".join(f"'{x}'" for x in BUY + SELL)
MOVES_CTE = f"""{METRICS_CTE},
tx AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, n_name AS fund,
         CASE WHEN l_orderkey % 31 = 0 THEN ' ' WHEN l_orderkey % 29 = 0 THEN 'Unknown' ELSE p_brand END AS portfolio,
         CASE WHEN l_returnflag = 'R' THEN '{SELL[0]}' WHEN l_returnflag = 'A' THEN '{BUY[0]}' WHEN l_linenumber % 4 = 0 THEN 'Other'
              WHEN l_linenumber % 4 = 1 THEN '{BUY[1]}' WHEN l_linenumber % 4 = 2 THEN '{BUY[2]}' ELSE '{BUY[3]}' END AS type,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE -l_extendedprice END AS amount, n_nationkey AS nk,
         CASE WHEN n_nationkey % 5 = 0 THEN 'gbp ' ELSE 'CUR_' || n_nationkey END AS currency, CAST(l_shipdate AS DATE) AS transaction_date,
         CASE WHEN l_orderkey % 50 = 0 THEN 'True' ELSE 'False' END AS draft
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
paid AS (
  SELECT transaction_id, fund, portfolio, type, amount, currency, transaction_date, draft, last_day(transaction_date) AS month_end,
         CASE WHEN nk % 5 = 0 THEN 1.0 WHEN nk % 6 <> 1 THEN 1.0 + nk / 10.0 + month(transaction_date) / 100.0 END AS used_rate
  FROM tx WHERE draft = 'False' AND trim(portfolio) <> '' AND type IN ({QUOTED})),
dates AS (SELECT DISTINCT fund, portfolio, report_date FROM metrics),
moves AS (
  SELECT p.*, amount * used_rate AS amount_base,
         (SELECT MIN(d.report_date) FROM dates d WHERE d.fund = p.fund AND d.portfolio = p.portfolio AND d.report_date >= p.month_end) AS report_date
  FROM paid p WHERE EXISTS (SELECT 1 FROM dates d WHERE d.fund = p.fund AND d.portfolio = p.portfolio))"""


@query("m18_capital_injections", f"""
WITH {MOVES_CTE}
SELECT transaction_id, fund, portfolio, type, amount, currency, transaction_date, month_end, ROUND(used_rate, 6) AS used_rate,
       ROUND(amount_base, 4) AS amount_base, report_date, CASE WHEN report_date IS NULL THEN 'Unbucketed' ELSE 'Bucketed' END AS bucket_status
FROM moves""")
def m18_capital_injections(spark, d):
    m = moves(spark, d, full_metrics(spark, d))
    return m.select("transaction_id", "fund", "portfolio", "type", "amount", "currency", "transaction_date", "month_end",
                    F.round("used_rate", 6).alias("used_rate"), F.round("amount_base", 4).alias("amount_base"), "report_date", "bucket_status")


# -- M17 ------------------------------------------------------------------------------------
PARTS = ["opening", "capital_injections", "nav_change", "committed_equity", "debt_movements", "disposals", "fund_level_adj", "closing"]


def bridge_sql(keys, first):
    k = "".join(f"{x}, " for x in keys)
    by = f"PARTITION BY {', '.join(keys)} " if keys else ""
    prev = (lambda x: f"lag({x}) OVER w") if first == "null" else (lambda x: f"COALESCE(lag({x}) OVER w, 0.0)")
    buy, sell = (", ".join(f"'{x}'" for x in xs) for xs in (BUY, SELL))
    return f"""
WITH {MOVES_CTE},
s AS (SELECT {k}report_date, SUM(CALC_AUM) AS a, SUM(adc + aec + auc) AS c, SUM(ad) AS dd, SUM(fcu + fcd + fce + fco + fva + frd) AS f
      FROM metrics GROUP BY {k}report_date),
l AS (SELECT {k}report_date, {prev('a')} AS opening, a AS closing, c - {prev('c')} AS committed_equity, dd - {prev('dd')} AS debt_movements,
             f - {prev('f')} AS fund_level_adj FROM s WINDOW w AS ({by}ORDER BY report_date)),
t AS (SELECT {k}report_date, SUM(CASE WHEN type IN ({buy}) THEN -amount_base ELSE 0.0 END) AS inj, SUM(CASE WHEN type IN ({sell}) THEN -amount_base ELSE 0.0 END) AS dis
      FROM moves WHERE report_date IS NOT NULL GROUP BY {k}report_date),
x AS (SELECT l.*, COALESCE(inj, 0.0) AS capital_injections, COALESCE(dis, 0.0) AS disposals FROM l LEFT JOIN t USING ({k}report_date))
SELECT {k}report_date, {', '.join(f'ROUND({p}, 4) + 0.0 AS {p}' for p in PARTS if p != 'nav_change')},
       ROUND(closing - opening - capital_injections - committed_equity - debt_movements - disposals - fund_level_adj, 4) + 0.0 AS nav_change
FROM x"""


def make_bridge(keys, first):
    def fn(spark, d):
        m = full_metrics(spark, d)
        b = AC.bridge(m, moves(spark, d, m), keys, BUY, SELL, first)
        return b.select(*keys, "report_date", *[(F.round(p, 4) + F.lit(0.0)).alias(p) for p in PARTS])
    return fn


for _level, _keys in (("total", []), ("fund", ["fund"]), ("portfolio", ["fund", "portfolio"])):
    for _flavour in ("null", "zero"):
        query(f"m17_bridge_{_level}" + ("" if _flavour == "null" else "_zero"), bridge_sql(_keys, _flavour))(make_bridge(_keys, _flavour))


# -- M3-M6 ----------------------------------------------------------------------------------
PHASE_LIST = [*AC.PHASES, "Exited"]
LANDS = ["England", "Scotland", "UK", "Portugal", "Spain", "Germany"]
TECH_LIST = ["Ground mount solar", "Rooftop solar", "Offshore wind", "Floating wind", "Biomass", "Landfill gas", "Battery storage", "Onshore wind"]
OWNED = ["Owned", "Signed", "Exited"]
SPECIAL = {"Brand#13": (["Portugal", "Spain"], "Spain")}


def pick(items, index):
    return F.element_at(F.array(*[F.lit(x) for x in items]), (index % len(items) + 1).cast("int"))


def holdings(spark, d):
    """Parts of a brand held by a nation's suppliers from their first to 200 days after their last shipment."""
    t = Tables(spark, d)
    j = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")))
    day = F.col("l_shipdate").cast("date")
    k = F.col("p_partkey")
    g = j.groupBy(F.col("n_name").alias("fund"), F.col("p_brand").alias("portfolio"), "p_partkey", "p_size").agg(
        F.min(day).alias("start"), F.date_add(F.max(day), 200).alias("end"))
    return g.select("fund", "portfolio", F.concat(F.lit("A"), k.cast("string")).alias("asset"),
                    F.when(F.col("p_size") % 25 == 0, "Platform").otherwise("Infrastructure").alias("asset_type"),
                    pick(PHASE_LIST, k).alias("lifecycle_phase"), pick(OWNED, k).alias("ownership_phase"), pick(LANDS, k).alias("country"),
                    F.when(k % 9 != 8, pick(TECH_LIST, k % 9)).alias("technology"), "start", "end")


def descriptors(spark, d):
    points = full_metrics(spark, d).select("fund", "portfolio", F.col("report_date").alias("as_of")).distinct()
    return AC.portfolio_descriptors(points, holdings(spark, d), SPECIAL)


def sql_list(items):
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


DESC_CTE = f"""{METRICS_CTE},
hold AS (
  SELECT n_name AS fund, p_brand AS portfolio, 'A' || p_partkey AS asset, CASE WHEN p_size % 25 = 0 THEN 'Platform' ELSE 'Infrastructure' END AS asset_type,
         {sql_list(PHASE_LIST)}[p_partkey % 8 + 1] AS phase, {sql_list(OWNED)}[p_partkey % 3 + 1] AS owned, {sql_list(LANDS)}[p_partkey % 6 + 1] AS country,
         CASE WHEN p_partkey % 9 <> 8 THEN {sql_list(TECH_LIST)}[p_partkey % 9 + 1] END AS tech, MIN(CAST(l_shipdate AS DATE)) AS s, MAX(CAST(l_shipdate AS DATE)) + 200 AS e
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY n_name, p_brand, p_partkey, p_size),
held AS (SELECT m.fund, m.portfolio, m.report_date AS as_of, h.* EXCLUDE (fund, portfolio, s, e) FROM (SELECT DISTINCT fund, portfolio, report_date FROM metrics) m
         JOIN hold h ON m.fund = h.fund AND m.portfolio = h.portfolio AND h.s <= m.report_date AND m.report_date < h.e),
sets AS (SELECT fund, portfolio, as_of, list_sort(list_distinct(list(asset))) AS names, list_sort(list_distinct(list(asset_type))) AS types,
                list_sort(list_distinct(list(phase))) AS phases, list_sort(list_distinct(list(owned))) AS owned, list_sort(list_distinct(list(country))) AS lands,
                list_sort(list_distinct(list(tech))) AS techs,
                list_distinct(list(CASE WHEN country IN ('England', 'Scotland', 'Wales', 'UK', 'United Kingdom') THEN 'UK' ELSE country END)) AS lands2,
                list_distinct(list(CASE WHEN tech IN ('Ground mount solar', 'Rooftop solar', 'Agrivoltaics') THEN 'Solar'
                                        WHEN tech IN ('Offshore wind', 'Floating wind') THEN 'Offshore wind'
                                        WHEN tech IN ('Biomass', 'Landfill gas', 'Energy from waste') THEN 'Biomass' ELSE tech END)) AS techs2
         FROM held GROUP BY 1, 2, 3),
descr AS (
  SELECT fund, portfolio, as_of, array_to_string(names, '; ') AS asset_names, array_to_string(types, '; ') AS asset_types,
         CASE WHEN list_contains(types, 'Platform') THEN 'Platform' ELSE array_to_string(types, ', ') END AS reporting_asset_type,
         array_to_string(phases, '; ') AS asset_lifecycle_phases,
         CASE WHEN list_contains(types, 'Platform') THEN 'Business / Developer'
              ELSE COALESCE(list_filter({sql_list(AC.PHASES)}, lambda x: list_contains(phases, x))[1], phases[1], '') END AS reporting_asset_lifecycle_phase,
         array_to_string(owned, '; ') AS asset_ownership_phases, array_to_string(owned, ', ') AS reporting_asset_ownership_phase,
         array_to_string(lands, '; ') AS asset_countries,
         CASE WHEN portfolio = 'Brand#13' AND list_contains(lands, 'Portugal') AND list_contains(lands, 'Spain') THEN 'Spain'
              WHEN len(lands2) > 1 THEN 'Multi-Country' ELSE array_to_string(lands2, ', ') END AS reporting_asset_country,
         COALESCE(array_to_string(techs, '; '), '') AS asset_technologies,
         CASE WHEN len(techs2) = 2 AND list_contains(techs2, 'Battery storage') THEN list_filter(techs2, lambda x: x <> 'Battery storage')[1] || ' & Battery storage'
              WHEN len(techs2) >= 2 THEN 'Multi-Tech Renewables' ELSE COALESCE(array_to_string(techs2, ', '), '') END AS reporting_asset_technology
  FROM sets)"""


@query("m3_portfolio_descriptors", f"WITH {DESC_CTE} SELECT * FROM descr")
def m3_portfolio_descriptors(spark, d):
    return descriptors(spark, d)


def enriched(spark, d):
    m = full_metrics(spark, d).select("report_date", "fund", "fund_id", "portfolio", "CALC_AUM", "CALC_ASSET_NAV")
    c = descriptors(spark, d)
    return m.join(c, (m["fund"] == c["fund"]) & (m["portfolio"] == c["portfolio"]) & (m["report_date"] == c["as_of"]), "left").select(
        m["report_date"], m["fund"], m["fund_id"], m["portfolio"], F.round("CALC_AUM", 4).alias("aum"), F.round("CALC_ASSET_NAV", 4).alias("asset_nav"),
        *[c[x] for x in AC.DESCRIPTORS])


ENRICHED_CTE = f"""{DESC_CTE},
enr AS (SELECT m.report_date, m.fund, m.fund_id, m.portfolio, ROUND(CALC_AUM, 4) AS aum, ROUND(CALC_ASSET_NAV, 4) AS asset_nav, {', '.join('c.' + x for x in AC.DESCRIPTORS)}
        FROM metrics m LEFT JOIN descr c ON m.fund = c.fund AND m.portfolio = c.portfolio AND m.report_date = c.as_of),
over AS (SELECT report_date, fund, fund_id, portfolio, aum, asset_nav,
                {', '.join(f"CASE WHEN portfolio = 'Brand#2' THEN 'Undeployed' WHEN fund = 'NATION_3' OR portfolio LIKE 'Fund%' THEN 'N/A' ELSE {x} END AS {x}" for x in AC.DESCRIPTORS)} FROM enr)"""


def overridden(spark, d):
    return AC.override_descriptors(enriched(spark, d), F.col("portfolio") == "Brand#2",
                                   (F.col("fund") == "NATION_3") | F.col("portfolio").like("Fund%"))


@query("m4_overrides", f"WITH {ENRICHED_CTE} SELECT * FROM over")
def m4_overrides(spark, d):
    return overridden(spark, d)


RULES = [{"when": "fund_id = 7 AND portfolio LIKE 'Brand#1%'", "ids": {"fund_id": None}}, {"when": "fund_id = 7", "ids": {"fund_id": -1}},
         {"when": "fund_id = 9 AND portfolio = 'Brand#1'"}]


@query("m5_eliminations", f"""
WITH {ENRICHED_CTE},
r AS (SELECT *, CASE WHEN fund_id = 7 AND portfolio LIKE 'Brand#1%' THEN 0 WHEN fund_id = 7 THEN 1 WHEN fund_id = 9 AND portfolio = 'Brand#1' THEN 2 END AS rule FROM over)
SELECT * EXCLUDE (rule), false AS is_elimination FROM r
UNION ALL BY NAME
SELECT report_date, fund || ' [ELIMINATION]' AS fund, CASE rule WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE -fund_id END AS fund_id, portfolio || ' [ELIMINATION]' AS portfolio,
       -aum AS aum, -asset_nav AS asset_nav, {', '.join(AC.DESCRIPTORS)}, true AS is_elimination FROM r WHERE rule IS NOT NULL""")
def m5_eliminations(spark, d):
    return AC.eliminate(overridden(spark, d), RULES)


@query("m6_fill_forward", f"""
WITH {ENRICHED_CTE},
z AS (SELECT * REPLACE ({', '.join(f"CASE WHEN month(report_date) = 6 THEN NULL ELSE NULLIF({x}, '') END AS {x}" for x in AC.DESCRIPTORS)}) FROM over),
f AS (SELECT report_date, fund, portfolio, aum, {', '.join(f"last_value({x} IGNORE NULLS) OVER w AS {x}" for x in AC.DESCRIPTORS)},
             {', '.join(f"{x} IS NULL AND last_value({x} IGNORE NULLS) OVER w IS NOT NULL AS b_{x}" for x in AC.DESCRIPTORS)}
      FROM z WINDOW w AS (PARTITION BY fund, portfolio ORDER BY report_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT report_date, fund, portfolio, aum, {', '.join(AC.DESCRIPTORS)}, {' OR '.join('b_' + x for x in AC.DESCRIPTORS)} AS backfilled FROM f""")
def m6_fill_forward(spark, d):
    gaps = overridden(spark, d).withColumns({x: F.when(F.month("report_date") != 6, F.col(x)) for x in AC.DESCRIPTORS})
    out = fill_forward(gaps, ["fund", "portfolio"], ["report_date"], AC.DESCRIPTORS, flag="backfilled")
    return out.select("report_date", "fund", "portfolio", "aum", *AC.DESCRIPTORS, "backfilled")


@query("m7_technology_tiers", """
SELECT p_partkey AS asset_id,
       CASE WHEN p_partkey % 2 = 0 OR p_partkey % 9 <> 4 THEN p_type END AS technology_type,
       CASE WHEN (p_partkey % 2 = 0 OR p_partkey % 9 <> 4) AND p_type <> 'PROMO' THEN 'Sector ' || (length(p_type) % 3) END AS technology_sector,
       CASE WHEN (p_partkey % 2 = 0 OR p_partkey % 9 <> 4) AND p_type <> 'PROMO' THEN 'Sector ' || (length(p_type) % 2) END AS energy_system_category
FROM part""")
def m7_technology_tiers(spark, d):
    p = Tables(spark, d).part
    names = p.select(F.concat(F.lit("TECH_NAME_"), "p_type").alias("technology_name_id"), F.col("p_type").alias("technology_name")).distinct()
    core = names.select(F.concat(F.lit("TECH_CORE_"), "technology_name").alias("technology_core_id"), "technology_name_id",
                        F.concat(F.lit("G_"), "technology_name").alias("group_id"))
    groups = names.where("technology_name <> 'PROMO'").select(F.concat(F.lit("G_"), "technology_name").alias("group_id"),
                                                             (F.length("technology_name") % 3).alias("tier1"), (F.length("technology_name") % 2).alias("tier2"))
    group_names = p.select((F.col("p_partkey") % 3).cast("int").alias("group_id")).distinct().withColumn("group_name", F.concat(F.lit("Sector "), F.col("group_id").cast("string")))
    odd = F.col("p_partkey") % 2 == 1
    tech = (F.when(odd & (F.col("p_partkey") % 9 == 4), F.lit("TECH_CORE_none")).when(odd, F.concat(F.lit("TECH_CORE_"), "p_type"))
            .otherwise(F.concat(F.lit("TECH_NAME_"), "p_type")))
    return AC.technology_tiers(p.select(F.col("p_partkey").alias("asset_id"), tech.alias("technology_id")), names, core, groups, group_names)


# -- M14-M16 ------------------------------------------------------------------------------------
GOLD_CTE = f"""{ENRICHED_CTE},
gold AS (
  SELECT m.report_date AS Report_Date, 'GBP' AS Currency, COALESCE(NULLIF(trim(m.fund), ''), 'Unknown') AS Fund, COALESCE(NULLIF(trim(m.portfolio), ''), 'Unknown') AS Portfolio,
         COALESCE(NULLIF(trim(c.reporting_asset_country), ''), 'Unknown') AS Reporting_Asset_Country, COALESCE(NULLIF(trim(c.reporting_asset_technology), ''), 'Unknown') AS Reporting_Asset_Technology,
         COALESCE(NULLIF(trim(c.reporting_asset_lifecycle_phase), ''), 'Unknown') AS Reporting_Asset_Lifecycle_Phase,
         CALC_AUM AS AUM, CALC_ASSET_NAV AS Asset_NAV, CALC_DRY_POWDER AS Dry_Powder, CALC_FUM AS FUM, CALC_FUND_GAV AS Fund_GAV, CALC_FUND_NAV AS Fund_NAV, CALC_PORTFOLIO_GAV AS Portfolio_GAV,
         adc + aec + auc AS Asset_Committed_Equity, edc AS Asset_Committed_External_Debt, ad AS Asset_External_Debt, alc AS Asset_Level_Cash, ala AS Asset_Level_Cash_Adj,
         fce + fva + fco AS Fund_HoldCo_Cash_and_Liabilities, fcd AS Fund_Downstream_Cash, fcu AS Fund_Upstream_Cash, fva AS Fund_Level_Other_Adj, frd AS Fund_Remove_Double_Count,
         tfd AS Fund_Debt, ufd AS Fund_Undrawn_Debt, fca AS Fund_Conditional_Acquisition, tfc AS Fund_Undrawn_Subscriptions
  FROM metrics m LEFT JOIN descr c ON m.fund = c.fund AND m.portfolio = c.portfolio AND m.report_date = c.as_of)"""
KPI_NAMES = ["AUM", "Asset_NAV", "Dry_Powder", "FUM", "Fund_GAV", "Fund_NAV", "Portfolio_GAV", "Asset_Committed_Equity", "Asset_Committed_External_Debt", "Asset_External_Debt",
             "Asset_Level_Cash", "Asset_Level_Cash_Adj", "Fund_HoldCo_Cash_and_Liabilities", "Fund_Downstream_Cash", "Fund_Upstream_Cash", "Fund_Level_Other_Adj",
             "Fund_Remove_Double_Count", "Fund_Debt", "Fund_Undrawn_Debt", "Fund_Conditional_Acquisition", "Fund_Undrawn_Subscriptions"]


def gold(spark, d):
    return AC.gold_metrics(full_metrics(spark, d), descriptors(spark, d))


def positive_zero(df, names):
    return df.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in names})


@query("m14_gold_metrics", f"WITH {GOLD_CTE} SELECT * REPLACE ({', '.join(f'ROUND({k}, 4) + 0.0 AS {k}' for k in KPI_NAMES)}) FROM gold")
def m14_gold_metrics(spark, d):
    return positive_zero(gold(spark, d), KPI_NAMES)


@query("m14_aum_kpis", f"WITH {GOLD_CTE} SELECT Report_Date, Fund, {', '.join(f'ROUND(SUM({k}), 4) + 0.0 AS {k}' for k in KPI_NAMES)} FROM gold GROUP BY 1, 2")
def m14_aum_kpis(spark, d):
    return positive_zero(gold(spark, d).groupBy("Report_Date", "Fund").agg(*[F.sum(k).alias(k) for k in KPI_NAMES]), KPI_NAMES)


SLICE_SQL = " UNION ALL ".join(
    f"SELECT Report_Date, '{s}' AS slice, {s} AS value, {', '.join(f'SUM({k}) AS {k}' for k in KPI_NAMES)} FROM gold GROUP BY 1, 3"
    for s in ("Reporting_Asset_Country", "Reporting_Asset_Technology", "Reporting_Asset_Lifecycle_Phase"))


@query("m15_kpi_share_by_slice", f"""
WITH {GOLD_CTE}, sl AS ({SLICE_SQL}),
tot AS (SELECT Report_Date, {', '.join(f'SUM({k}) AS t_{k}' for k in KPI_NAMES)} FROM gold GROUP BY 1)
SELECT sl.Report_Date, slice, value, {', '.join(f'ROUND({k}, 4) + 0.0 AS {k}' for k in KPI_NAMES)},
       {', '.join(f'ROUND(COALESCE(CASE WHEN t_{k} <> 0 THEN {k} / t_{k} * 100 END, 0.0), 4) + 0.0 AS {k}_Pct' for k in KPI_NAMES)}
FROM sl JOIN tot ON sl.Report_Date = tot.Report_Date""")
def m15_kpi_share_by_slice(spark, d):
    return positive_zero(AC.kpi_slices(gold(spark, d), digits=4), [*KPI_NAMES, *[f"{k}_Pct" for k in KPI_NAMES]])


def previous_sql(keys):
    k = "".join(f"{x}, " for x in keys)
    on = "".join(f" AND p.{x} = t.{x}" for x in keys)
    shown = "".join(f"COALESCE(t.{x}, p.{x}) AS {x}, " for x in keys)
    names = ("AUM", "Dry_Powder", "FUM", "Fund_GAV", "Fund_NAV", "Portfolio_GAV")
    return f"""
WITH {GOLD_CTE},
agg AS (SELECT {k}Report_Date, {', '.join(f'SUM({m}) AS {m}' for m in names)} FROM gold GROUP BY ALL),
long AS ({' UNION ALL '.join(f"SELECT {k}Report_Date, '{m}' AS Metric, {m} AS value FROM agg" for m in names)}),
pair AS (SELECT * FROM (SELECT Report_Date AS t, lag(Report_Date) OVER (ORDER BY Report_Date) AS p FROM (SELECT DISTINCT Report_Date FROM gold)) WHERE p IS NOT NULL),
cur AS (SELECT pair.p, pair.t, long.* FROM pair JOIN long ON long.Report_Date = pair.t),
old AS (SELECT pair.p, pair.t, long.* FROM pair JOIN long ON long.Report_Date = pair.p)
SELECT {shown}COALESCE(t.Metric, p.Metric) AS Metric, COALESCE(t.p, p.p) AS Prev_Report_Date, COALESCE(t.t, p.t) AS This_Report_Date, ROUND(p.value, 4) AS KPI_Prev_Report_Date,
       ROUND(t.value, 4) AS KPI_This_Report_Date, ROUND(t.value - p.value, 4) + 0.0 AS Delta,
       COALESCE(ROUND(CASE WHEN p.value IS NULL OR p.value = 0 THEN NULL ELSE (t.value - p.value) / p.value * 100 END, 6), 0.0) + 0.0 AS Percentage_Delta
FROM cur t FULL JOIN old p ON p.p = t.p AND p.t = t.t AND p.Metric = t.Metric{on}"""


for _name, _keys in (("m16_kpis_vs_prev", []), ("m16_kpis_by_fund_vs_prev", ["Fund"])):
    def _make(keys=_keys):
        def fn(spark, d):
            r = AC.kpis_vs_previous(gold(spark, d), keys, digits=4)
            return r.withColumns({c: F.col(c) + F.lit(0.0) for c in ("Delta", "Percentage_Delta")})
        return fn
    query(_name, previous_sql(_keys))(_make())
