"""Fund-operations models (daily facts, calendarised series, totals, shares)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregates import sum_by_type
from strata.operators.series import calendarise
from strata.operators.windows import keep_latest, running_total

MONEY = 2

DAILY_GRAIN = ["Fund_Id", "Fund", "Fund_Structure_Type", "Fund_Status", "Transaction_Currency",
               "Investor", "Investor_Type", "Investor_Country"]

TYPE_SPEC = {
    "Commitments": (["MF: Commitment"], "Amount"),
    "Called": (["MF: Call", "MF: Return Of Call (Negative Call)"], "Amount"),
    "Distribution": (["MF: Distribution"], "Amount"),
    "NAV": (["MF: Net Asset Value"], "Amount"),
}


def feeder_inference(ops: DataFrame, funds: DataFrame) -> DataFrame:
    """Subquery-in-CASE as a left join to the distinct fund names: an investor with no
    type whose name is a fund is a 'Feeder Fund' (country 'N/A'). The fund-name set is a
    dimension (one row per fund); AQE broadcasts it when its measured size is small."""
    names = funds.select(F.col("Fund").alias("_feeder")).distinct()
    j = ops.join(names, ops["Investor"] == names["_feeder"], "left")
    is_feeder = F.col("_feeder").isNotNull()
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    return j.withColumns({
        "Investor_Type": F.when(blank("Investor_Type") & is_feeder, "Feeder Fund").otherwise(F.col("Investor_Type")),
        "Investor_Country": F.when(blank("Investor_Country") & is_feeder, "N/A").otherwise(F.col("Investor_Country")),
    }).drop("_feeder")


def fundoperations_daily(ops: DataFrame, funds: DataFrame) -> DataFrame:
    """M8: latest row per transaction, drafts dropped, feeder inference, typed sums per
    (grain, day), to-date cumulatives per grain, remaining commitments."""
    latest = keep_latest(ops, ["Transaction_Id"], ["Effective_Date"])
    base = feeder_inference(latest.where(F.col("Draft") != "True"), funds)
    daily = base.groupBy(*DAILY_GRAIN, "Effective_Date").agg(*sum_by_type(base, "Type", TYPE_SPEC))
    cum = running_total(daily, DAILY_GRAIN, ["Effective_Date"], {
        "Cumulative_Commitments": "Commitments", "Cumulative_Called": "Called",
        "Cumulative_Distribution": "Distribution"})
    out = cum.withColumn("Remaining_Commitments", F.col("Cumulative_Commitments") - F.col("Cumulative_Called"))
    money = ["Commitments", "Called", "Distribution", "NAV", "Cumulative_Commitments", "Cumulative_Called",
             "Cumulative_Distribution", "Remaining_Commitments"]
    return out.withColumns({c: F.round(c, MONEY) for c in money})


FULL_GRAIN = ["Ef_Fund_Id", "Ef_Fund", "Ef_Fund_Long", "Fund", "Fund_Structure_Type", "Fund_Status", "Transaction_Currency", "Investor",
              "Investor_Type", "Investor_Country"]


def fundoperations_full(ops: DataFrame, funds: DataFrame, accounts: DataFrame, mapped: DataFrame, bucket=None) -> DataFrame:
    """M8 in full: fund operations per day with the fund's and the investor's attributes.

    Four dedupes keep the last loaded row: operations by id, funds by id, investor accounts by (account, fund), mapped funds by
    source id. Drafts and the 'Top 20' share are left out. Commitments are the committed and redrawable amounts, less those
    expired or released. An account without type or country that is itself a fund is a 'Feeder Fund' / 'N/A'. Running totals
    are kept per fund, currency and investor (``bucket``: see :func:`strata.operators.windows.running_total`).

    ops: operation_id, fund_id, fund, currency, account, effective_date, type, amount, valuation, committed, redrawable, expired,
    share, draft, loaded; funds: fund_id, fund, short_name, loaded; accounts: account, fund_id, investor_type, country, loaded;
    mapped: source_fund_id, fund_name, structure_type, end_date, updated."""
    o = keep_latest(ops, ["operation_id"], ["loaded"]).where("share <> 'Top 20' AND draft <> 'True'")
    f = keep_latest(funds, ["fund_id"], ["loaded"])
    a = keep_latest(accounts, ["account", "fund_id"], ["loaded"]).select("account", "fund_id", "investor_type", "country")
    m = keep_latest(mapped, ["source_fund_id"], ["updated"])
    names = f.select(F.col("fund").alias("__feeder")).distinct()
    j = (o.join(f.select("fund_id", "short_name"), "fund_id", "left").join(a, ["account", "fund_id"], "left")
          .join(m.select(F.col("source_fund_id").alias("fund_id"), "fund_name", "structure_type", "end_date"), "fund_id", "left")
          .join(names, F.col("account") == F.col("__feeder"), "left"))
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    feeder = F.col("__feeder").isNotNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    kind = lambda *types: F.col("type").isin(*types)
    rows = j.select(
        F.col("fund_id").alias("Ef_Fund_Id"), F.col("short_name").alias("Ef_Fund"), F.col("fund").alias("Ef_Fund_Long"), F.col("fund_name").alias("Fund"),
        F.col("structure_type").alias("Fund_Structure_Type"),
        F.when(F.col("fund_name").isNotNull(), F.when(F.col("end_date").isNull(), "Active").otherwise("Inactive")).alias("Fund_Status"),
        F.col("currency").alias("Transaction_Currency"), F.col("account").alias("Investor"),
        F.when(blank("investor_type") & feeder, "Feeder Fund").otherwise(F.col("investor_type")).alias("Investor_Type"),
        F.when(blank("country") & feeder, "N/A").otherwise(F.col("country")).alias("Investor_Country"),
        F.col("effective_date").alias("Effective_Date"),
        F.when(kind("MF: Commitment"), zero("committed") + zero("redrawable")).when(kind("MF: Expired/Released Commitment"), -zero("expired"))
         .otherwise(0.0).alias("Commitments"),
        F.when(kind("MF: Call", "MF: Return Of Call (Negative Call)"), zero("amount")).otherwise(0.0).alias("Called"),
        F.when(kind("MF: Distribution"), zero("amount")).otherwise(0.0).alias("Distribution"),
        F.when(kind("MF: Net Asset Value"), zero("valuation")).otherwise(0.0).alias("NAV"))
    daily = rows.groupBy(*FULL_GRAIN, "Effective_Date").agg(*[F.sum(c).alias(c) for c in ("Commitments", "Called", "Distribution", "NAV")])
    out = running_total(daily, FULL_GRAIN, ["Effective_Date"], {f"Cumulative_{c}": c for c in ("Commitments", "Called", "Distribution")}, bucket)
    out = out.withColumn("Remaining_Commitments", F.col("Cumulative_Commitments") - F.col("Cumulative_Called"))
    money = ["Commitments", "Called", "Distribution", "NAV", "Cumulative_Commitments", "Cumulative_Called", "Cumulative_Distribution", "Remaining_Commitments"]
    return out.withColumns({c: F.round(c, MONEY) for c in money})


def investor_cumulatives(daily: DataFrame, bucket=None) -> DataFrame:
    """An investor's commitments, calls and distributions to date over all funds, per currency; days are
    ordered by date, then fund."""
    order = ["Effective_Date", "Fund_Id", "Fund", "Fund_Structure_Type", "Fund_Status", "Investor_Type", "Investor_Country"]
    sums = ("Commitments", "Called", "Distribution")
    out = running_total(daily, ["Investor", "Transaction_Currency"], order, {f"Investor_Cumulative_{c}": c for c in sums}, bucket)
    return out.withColumns({f"Investor_Cumulative_{c}": F.round(f"Investor_Cumulative_{c}", MONEY) for c in sums})


def fundoperations_calendarised(daily: DataFrame, unit: str = "month") -> DataFrame:
    """M9: dense month/quarter series per full grain: sums (0 on empty periods), NAV
    max then forward-filled, cumulatives and remaining commitments."""
    cal = calendarise(daily, DAILY_GRAIN, "Effective_Date", ["Commitments", "Called", "Distribution"],
                      maxes=["NAV"], unit=unit,
                      cumulative={"Cumulative_Commitments": "Commitments", "Cumulative_Called": "Called",
                                  "Cumulative_Distribution": "Distribution"},
                      ffill=["NAV"])
    return _finish(cal, unit)


def fundoperations_by_slice(daily: DataFrame, slice_col: str, unit: str = "month") -> DataFrame:
    """The same series by one investor attribute (NULL -> 'Unknown') instead of by
    investor; partitions of the running totals equal the grain (fixes the reference's
    narrower partitions)."""
    src = daily.withColumn(slice_col, F.coalesce(F.col(slice_col), F.lit("Unknown")))
    grain = ["Fund", "Fund_Structure_Type", "Fund_Status", "Transaction_Currency", slice_col]
    cal = calendarise(src, grain, "Effective_Date", ["Commitments", "Called", "Distribution"], unit=unit,
                      cumulative={"Cumulative_Commitments": "Commitments", "Cumulative_Called": "Called",
                                  "Cumulative_Distribution": "Distribution"})
    return _finish(cal, unit)


def period_label_name(unit: str) -> str:
    return "Year_Month" if unit == "month" else "Year_Quarter"


def _finish(cal: DataFrame, unit: str) -> DataFrame:
    money = [c for c in ("Commitments", "Called", "Distribution", "NAV", "Cumulative_Commitments",
                         "Cumulative_Called", "Cumulative_Distribution") if c in cal.columns]
    return (cal.withColumn("Remaining_Commitments", F.col("Cumulative_Commitments") - F.col("Cumulative_Called"))
               .withColumnRenamed("Period_Label", period_label_name(unit))
               .withColumns({c: F.round(c, MONEY) for c in money + ["Remaining_Commitments"]})
               .drop("Period"))


TOTAL_KEYS = ["Fund", "Fund_Structure_Type", "Transaction_Currency"]


def fund_period_totals(cal: DataFrame, unit: str) -> DataFrame:
    """Fund totals per period over the calendarised investor series and their
    to-date cumulatives per (fund, structure type, currency)."""
    label = period_label_name(unit)
    tot = cal.groupBy(*TOTAL_KEYS, label).agg(
        F.sum("Commitments").alias("Total_Commitments"), F.sum("Called").alias("Total_Called"),
        F.sum("Distribution").alias("Total_Distribution"))
    cum = running_total(tot, TOTAL_KEYS, [label], {"Total_Cumulative_Commitments": "Total_Commitments",
                                                   "Total_Cumulative_Called": "Total_Called",
                                                   "Total_Cumulative_Distribution": "Total_Distribution"})
    cols = ["Total_Commitments", "Total_Called", "Total_Distribution", "Total_Cumulative_Commitments",
            "Total_Cumulative_Called", "Total_Cumulative_Distribution"]
    return cum.withColumns({c: F.round(c, MONEY) for c in cols})


def investor_share(cal_slice: DataFrame, totals: DataFrame, slice_col: str, unit: str) -> DataFrame:
    """Each slice's share of its fund's period totals (NULL when the total is 0),
    joined on the full totals grain incl. structure type (no fan-out)."""
    keys = TOTAL_KEYS + [period_label_name(unit)]
    t = totals.select(*keys, "Total_Commitments", "Total_Called", "Total_Distribution")
    j = cal_slice.join(t, keys, "inner")
    share = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0.0)), 6)
    return j.select(*keys, slice_col, "Commitments", "Called", "Distribution",
                    share("Commitments", "Total_Commitments").alias("Commitments_Share"),
                    share("Called", "Total_Called").alias("Called_Share"),
                    share("Distribution", "Total_Distribution").alias("Distribution_Share"))
