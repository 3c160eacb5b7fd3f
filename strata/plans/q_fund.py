"""Registered fund-operations queries (M8-M13) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.prefix import time_bucket
from strata.plans import bindings as B
from strata.plans import fund_models as FM
from strata.plans.registry import query
from strata.sources.tables import Tables

GRAIN = ", ".join(FM.DAILY_GRAIN)


def _daily(spark, d):
    return FM.fundoperations_daily(B.fund_operations(spark, d), B.funds(spark, d))


# -- DuckDB twin of fundoperations_daily, as CTEs ending in ``daily_out`` ----------
DAILY_CTES = f"""{B.FUND_OPS_CTE}, {B.FUNDS_CTE},
latest AS (
  SELECT * FROM fund_ops
  QUALIFY row_number() OVER (PARTITION BY Transaction_Id ORDER BY Effective_Date DESC) = 1
),
base AS (
  SELECT l.* REPLACE (
    CASE WHEN (l.Investor_Type IS NULL OR trim(l.Investor_Type) = '')
              AND l.Investor IN (SELECT Fund FROM funds) THEN 'Feeder Fund'
         ELSE l.Investor_Type END AS Investor_Type,
    CASE WHEN (l.Investor_Country IS NULL OR trim(l.Investor_Country) = '')
              AND l.Investor IN (SELECT Fund FROM funds) THEN 'N/A'
         ELSE l.Investor_Country END AS Investor_Country)
  FROM latest l WHERE l.Draft <> 'True'
),
daily AS (
  SELECT {GRAIN}, Effective_Date,
    SUM(CASE WHEN Type = 'MF: Commitment' THEN Amount ELSE 0 END) AS Commitments,
    SUM(CASE WHEN Type IN ('MF: Call', 'MF: Return Of Call (Negative Call)') THEN Amount ELSE 0 END) AS Called,
    SUM(CASE WHEN Type = 'MF: Distribution' THEN Amount ELSE 0 END) AS Distribution,
    SUM(CASE WHEN Type = 'MF: Net Asset Value' THEN Amount ELSE 0 END) AS NAV
  FROM base GROUP BY {GRAIN}, Effective_Date
),
daily_cum AS (
  SELECT *,
    SUM(Commitments) OVER w AS cc, SUM(Called) OVER w AS ca, SUM(Distribution) OVER w AS cd
  FROM daily
  WINDOW w AS (PARTITION BY {GRAIN} ORDER BY Effective_Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
daily_out AS (
  SELECT {GRAIN}, Effective_Date,
    ROUND(Commitments, 2) AS Commitments, ROUND(Called, 2) AS Called,
    ROUND(Distribution, 2) AS Distribution, ROUND(NAV, 2) AS NAV,
    ROUND(cc, 2) AS Cumulative_Commitments, ROUND(ca, 2) AS Cumulative_Called,
    ROUND(cd, 2) AS Cumulative_Distribution, ROUND(cc - ca, 2) AS Remaining_Commitments
  FROM daily_cum
)"""


def _label_sql(unit: str, col: str = "Period") -> str:
    if unit == "month":
        return f"strftime({col}, '%Y-%m')"
    return f"concat(CAST(year({col}) AS VARCHAR), '-Q', CAST(quarter({col}) AS VARCHAR))"


def cal_ctes(src: str, grain: list[str], unit: str, nav: bool, slice_col: str | None = None,
             p: str = "") -> str:
    """DuckDB calendarisation over CTE ``src`` ending in CTE ``{p}cal_out``."""
    g = ", ".join(grain)
    step = "INTERVAL 1 MONTH" if unit == "month" else "INTERVAL 3 MONTH"
    label = FM.period_label_name(unit)
    src_expr = "*" if not slice_col else f"* REPLACE (COALESCE({slice_col}, 'Unknown') AS {slice_col})"
    nav_m = ", MAX(NAV) AS NAV" if nav else ""
    nav_j = ", m.NAV" if nav else ""
    nav_w = ", last_value(NAV IGNORE NULLS) OVER w AS NAV_ff" if nav else ""
    nav_o = ", ROUND(NAV_ff, 2) AS NAV" if nav else ""
    on = " AND ".join(f"s.{c} IS NOT DISTINCT FROM m.{c}" for c in grain)
    return f"""
{p}cal_src AS (SELECT {src_expr} FROM {src}),
{p}m AS (
  SELECT {g}, CAST(date_trunc('{unit}', Effective_Date) AS DATE) AS Period,
    SUM(Commitments) AS Commitments, SUM(Called) AS Called, SUM(Distribution) AS Distribution{nav_m}
  FROM {p}cal_src GROUP BY ALL
),
{p}bounds AS (SELECT {g}, MIN(Period) AS first_p FROM {p}m GROUP BY ALL),
{p}last_p AS (SELECT MAX(Period) AS last_p FROM {p}m),
{p}spine AS (
  SELECT {g}, CAST(p AS DATE) AS Period FROM (
    SELECT b.*, unnest(generate_series(b.first_p, l.last_p, {step})) AS p FROM {p}bounds b, {p}last_p l)
),
{p}joined AS (
  SELECT {", ".join("s." + c for c in grain)}, s.Period,
    COALESCE(m.Commitments, 0) AS Commitments, COALESCE(m.Called, 0) AS Called,
    COALESCE(m.Distribution, 0) AS Distribution{nav_j}
  FROM {p}spine s LEFT JOIN {p}m m ON {on} AND s.Period = m.Period
),
{p}calc AS (
  SELECT *, SUM(Commitments) OVER w AS cc, SUM(Called) OVER w AS ca, SUM(Distribution) OVER w AS cd{nav_w}
  FROM {p}joined
  WINDOW w AS (PARTITION BY {g} ORDER BY Period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
{p}cal_out AS (
  SELECT {g}, {_label_sql(unit)} AS {label},
    ROUND(Commitments, 2) AS Commitments, ROUND(Called, 2) AS Called,
    ROUND(Distribution, 2) AS Distribution{nav_o},
    ROUND(cc, 2) AS Cumulative_Commitments, ROUND(ca, 2) AS Cumulative_Called,
    ROUND(cd, 2) AS Cumulative_Distribution, ROUND(cc - ca, 2) AS Remaining_Commitments
  FROM {p}calc
)"""


@query("m8_fundoperations_daily", f"WITH {DAILY_CTES} SELECT * FROM daily_out")
def m8_fundoperations_daily(spark, d):
    return _daily(spark, d)


@query("m9_calendarise_monthly",
       f"WITH {DAILY_CTES}, {cal_ctes('daily_out', FM.DAILY_GRAIN, 'month', True)} SELECT * FROM cal_out")
def m9_calendarise_monthly(spark, d):
    return FM.fundoperations_calendarised(_daily(spark, d), "month")


@query("m9_calendarise_quarterly",
       f"WITH {DAILY_CTES}, {cal_ctes('daily_out', FM.DAILY_GRAIN, 'quarter', True)} SELECT * FROM cal_out")
def m9_calendarise_quarterly(spark, d):
    return FM.fundoperations_calendarised(_daily(spark, d), "quarter")


SLICE_GRAIN = ["Fund", "Fund_Structure_Type", "Fund_Status", "Transaction_Currency"]

for _unit in ("month", "quarter"):
    for _slice, _tag in (("Investor_Country", "country"), ("Investor_Type", "type")):
        def _mk(unit=_unit, sl=_slice):
            def fn(spark, d):
                return FM.fundoperations_by_slice(_daily(spark, d), sl, unit)
            return fn

        _sql = (f"WITH {DAILY_CTES}, {cal_ctes('daily_out', SLICE_GRAIN + [_slice], _unit, False, _slice)} "
                f"SELECT * FROM cal_out")
        query(f"m10_by_investor_{_tag}_{_unit}ly", _sql)(_mk())


# -- M11: by-investor cumulatives across funds (tie-break by fund id) --------------
@query("m11_by_investor_cumulative", f"""
WITH {DAILY_CTES}
SELECT Investor, Fund_Id, Transaction_Currency, Effective_Date, Commitments, Called, Distribution,
  ROUND(SUM(Commitments) OVER w, 2) AS Investor_Cumulative_Commitments,
  ROUND(SUM(Called) OVER w, 2) AS Investor_Cumulative_Called, ROUND(SUM(Distribution) OVER w, 2) AS Investor_Cumulative_Distribution
FROM daily_out
WINDOW w AS (PARTITION BY Investor, Transaction_Currency ORDER BY Effective_Date, Fund_Id,
             Fund, Fund_Structure_Type, Fund_Status, Investor_Type NULLS FIRST, Investor_Country NULLS FIRST
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def m11_by_investor_cumulative(spark, d):
    out = FM.investor_cumulatives(_daily(spark, d), time_bucket("Effective_Date", "year"))
    return out.select("Investor", "Fund_Id", "Transaction_Currency", "Effective_Date", "Commitments", "Called", "Distribution",
                      *[f"Investor_Cumulative_{c}" for c in ("Commitments", "Called", "Distribution")])


# -- M8 in full: every table holds rows loaded twice ---------------------------------
def full_inputs(spark, d):
    """Operations = orders (every 8th loaded twice, the first time with another amount), funds and mapped funds = nations (twice), accounts
    = customers per nation (twice); every 37th account has no type and bears a nation's name."""
    t = Tables(spark, d)
    stamp = lambda df: df.withColumn("loaded", F.explode(F.array(F.lit(1), F.lit(2))))
    k, n = F.col("o_orderkey"), F.col("c_nationkey")
    acct = F.when(F.col("c_custkey") % 37 == 0, F.concat(F.lit("NATION_"), (F.col("c_custkey") % 25).cast("string"))).otherwise(F.col("c_name"))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, n == F.col("n_nationkey"))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("MF: Commitment", "MF: Call", "MF: Distribution", "MF: Net Asset Value", "MF: Expired/Released Commitment",
                                                       "MF: Return Of Call (Negative Call)")]), (k % 6 + 1).cast("int"))
    price = F.col("o_totalprice")
    ops = o.select(k.alias("operation_id"), n.alias("fund_id"), F.col("n_name").alias("fund"), F.when(n % 3 == 0, "GBP").otherwise("EUR").alias("currency"),
                   acct.alias("account"), F.col("o_orderdate").cast("date").alias("effective_date"), kind.alias("type"), price.alias("amount"), price.alias("valuation"),
                   price.alias("committed"), F.when(k % 5 == 0, F.lit(100.0)).alias("redrawable"), F.when(k % 4 == 0, F.lit(50.0)).alias("expired"),
                   F.when(k % 40 == 0, "Top 20").otherwise("All").alias("share"), F.when(k % 50 == 0, "True").otherwise("False").alias("draft"), F.lit(2).alias("loaded"))
    early = ops.where("operation_id % 8 = 0").withColumns({"loaded": F.lit(1), "amount": F.lit(1.0), "committed": F.lit(1.0)})
    funds = stamp(t.nation.select(F.col("n_nationkey").alias("fund_id"), F.col("n_name").alias("fund"), F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("short_name")))
    funds = funds.withColumn("short_name", F.when(F.col("loaded") == 1, "old").otherwise(F.col("short_name")))
    c = t.customer
    accounts = stamp(c.select(acct.alias("account"), n.alias("fund_id"), F.when(F.col("c_custkey") % 37 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("investor_type"),
                              F.when(F.col("c_custkey") % 37 != 0, F.concat(F.lit("CTRY_"), (F.col("c_custkey") % 7).cast("string"))).alias("country")))
    accounts = accounts.withColumn("investor_type", F.when(F.col("loaded") == 1, "old").otherwise(F.col("investor_type")))
    mapped = stamp(t.nation.where("n_nationkey % 10 <> 9").select(
        F.col("n_nationkey").alias("source_fund_id"), F.concat(F.lit("Fund "), "n_name").alias("fund_name"), F.col("n_regionkey").cast("string").alias("structure_type"),
        F.when(F.col("n_nationkey") % 6 == 5, F.lit("1999-01-01").cast("date")).alias("end_date"))).withColumnRenamed("loaded", "updated")
    mapped = mapped.withColumn("fund_name", F.when(F.col("updated") == 1, "old").otherwise(F.col("fund_name")))
    return ops.unionByName(early), funds, accounts, mapped


FULL = ", ".join(FM.FULL_GRAIN)


@query("m8_fundoperations_full", f"""
WITH o AS (
  SELECT o_orderkey AS k, c_nationkey AS fid, n_name, CASE WHEN c_custkey % 37 = 0 THEN 'NATION_' || (c_custkey % 25) ELSE c_name END AS account, CAST(o_orderdate AS DATE) AS day,
         ['MF: Commitment', 'MF: Call', 'MF: Distribution', 'MF: Net Asset Value', 'MF: Expired/Released Commitment', 'MF: Return Of Call (Negative Call)'][o_orderkey % 6 + 1] AS type, o_totalprice AS p
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 40 <> 0 AND o_orderkey % 50 <> 0),
acc AS (SELECT DISTINCT CASE WHEN c_custkey % 37 = 0 THEN 'NATION_' || (c_custkey % 25) ELSE c_name END AS account, c_nationkey AS fid,
               CASE WHEN c_custkey % 37 = 0 THEN ' ' ELSE c_mktsegment END AS itype, CASE WHEN c_custkey % 37 <> 0 THEN 'CTRY_' || (c_custkey % 7) END AS country FROM customer),
r AS (
  SELECT o.fid AS Ef_Fund_Id, 'S' || o.fid AS Ef_Fund, n_name AS Ef_Fund_Long, CASE WHEN o.fid % 10 <> 9 THEN 'Fund ' || n_name END AS Fund,
         CASE WHEN o.fid % 10 <> 9 THEN (SELECT CAST(n_regionkey AS VARCHAR) FROM nation n2 WHERE n2.n_nationkey = o.fid) END AS Fund_Structure_Type,
         CASE WHEN o.fid % 10 = 9 THEN NULL WHEN o.fid % 6 = 5 THEN 'Inactive' ELSE 'Active' END AS Fund_Status, CASE WHEN o.fid % 3 = 0 THEN 'GBP' ELSE 'EUR' END AS Transaction_Currency,
         o.account AS Investor, CASE WHEN trim(itype) = '' AND o.account IN (SELECT n_name FROM nation) THEN 'Feeder Fund' ELSE itype END AS Investor_Type,
         CASE WHEN country IS NULL AND o.account IN (SELECT n_name FROM nation) THEN 'N/A' ELSE country END AS Investor_Country, day AS Effective_Date,
         CASE type WHEN 'MF: Commitment' THEN p + CASE WHEN k % 5 = 0 THEN 100.0 ELSE 0.0 END WHEN 'MF: Expired/Released Commitment' THEN CASE WHEN k % 4 = 0 THEN -50.0 ELSE 0.0 END ELSE 0.0 END AS c,
         CASE WHEN type IN ('MF: Call', 'MF: Return Of Call (Negative Call)') THEN p ELSE 0.0 END AS ca, CASE WHEN type = 'MF: Distribution' THEN p ELSE 0.0 END AS di,
         CASE WHEN type = 'MF: Net Asset Value' THEN p ELSE 0.0 END AS nv
  FROM o LEFT JOIN acc ON acc.account = o.account AND acc.fid = o.fid),
dd AS (SELECT {FULL}, Effective_Date, SUM(c) AS c, SUM(ca) AS ca, SUM(di) AS di, SUM(nv) AS nv FROM r GROUP BY ALL),
w AS (SELECT *, SUM(c) OVER x AS cc, SUM(ca) OVER x AS cca, SUM(di) OVER x AS cdi FROM dd WINDOW x AS (PARTITION BY {FULL} ORDER BY Effective_Date ROWS UNBOUNDED PRECEDING))
SELECT {FULL}, Effective_Date, ROUND(c, 2) + 0.0 AS Commitments, ROUND(ca, 2) AS Called, ROUND(di, 2) AS Distribution, ROUND(nv, 2) AS NAV, ROUND(cc, 2) + 0.0 AS Cumulative_Commitments,
       ROUND(cca, 2) AS Cumulative_Called, ROUND(cdi, 2) AS Cumulative_Distribution, ROUND(cc - cca, 2) + 0.0 AS Remaining_Commitments FROM w""")
def m8_fundoperations_full(spark, d):
    out = FM.fundoperations_full(*full_inputs(spark, d), bucket=time_bucket("Effective_Date", "year"))
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("Commitments", "Cumulative_Commitments", "Remaining_Commitments")})


def _totals_sql(unit: str) -> str:
    label = FM.period_label_name(unit)
    k = ", ".join(FM.TOTAL_KEYS)
    return f"""
tot AS (
  SELECT {k}, {label}, SUM(Commitments) AS tc, SUM(Called) AS tca, SUM(Distribution) AS td
  FROM cal_out GROUP BY ALL
),
tot_out AS (
  SELECT {k}, {label}, ROUND(tc, 2) AS Total_Commitments, ROUND(tca, 2) AS Total_Called,
    ROUND(td, 2) AS Total_Distribution,
    ROUND(SUM(tc) OVER w, 2) AS Total_Cumulative_Commitments,
    ROUND(SUM(tca) OVER w, 2) AS Total_Cumulative_Called,
    ROUND(SUM(td) OVER w, 2) AS Total_Cumulative_Distribution
  FROM tot
  WINDOW w AS (PARTITION BY {k} ORDER BY {label} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


for _unit in ("month", "quarter"):
    def _mk_tot(unit=_unit):
        def fn(spark, d):
            return FM.fund_period_totals(FM.fundoperations_calendarised(_daily(spark, d), unit), unit)
        return fn

    query(f"m12_fund_totals_{_unit}ly",
          f"WITH {DAILY_CTES}, {cal_ctes('daily_out', FM.DAILY_GRAIN, _unit, True)}, {_totals_sql(_unit)} "
          f"SELECT * FROM tot_out")(_mk_tot())


def _share_sql(unit: str, slice_col: str) -> str:
    label = FM.period_label_name(unit)
    keys = FM.TOTAL_KEYS + [label]
    # totals come from the investor-grain series; the slice series is a second pass
    inv = cal_ctes("daily_out", FM.DAILY_GRAIN, unit, True)
    sl = cal_ctes("daily_out", SLICE_GRAIN + [slice_col], unit, False, slice_col, p="s_")
    on = " AND ".join(f"s.{c} = t.{c}" for c in keys)
    return f"""{inv}, {_totals_sql(unit)}, {sl}
SELECT {", ".join("s." + c for c in keys)}, s.{slice_col}, s.Commitments, s.Called, s.Distribution,
  ROUND(s.Commitments / NULLIF(t.Total_Commitments, 0), 6) AS Commitments_Share,
  ROUND(s.Called / NULLIF(t.Total_Called, 0), 6) AS Called_Share,
  ROUND(s.Distribution / NULLIF(t.Total_Distribution, 0), 6) AS Distribution_Share
FROM s_cal_out s JOIN tot_out t ON {on}"""


for _unit in ("month", "quarter"):
    for _slice, _tag in (("Investor_Country", "country"), ("Investor_Type", "type")):
        def _mk_share(unit=_unit, sl=_slice):
            def fn(spark, d):
                # slices add up to the fund, so slice and total come from one series
                series = FM.fundoperations_by_slice(_daily(spark, d), sl, unit)
                return FM.investor_share(series, FM.fund_period_totals(series, unit), sl, unit)
            return fn

        query(f"m13_investor_{_tag}_share_{_unit}ly",
              f"WITH {DAILY_CTES}, {_share_sql(_unit, _slice)}")(_mk_share())
