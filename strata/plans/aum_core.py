"""M2-M7, M17, M18 in full: derived AUM metrics with residual checks, descriptor enrichment,
overrides, elimination rows, technology tiers, capital transactions and the eight-term bridge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.joins import bucket_to_period
from strata.operators.temporal import as_of_join

# Measures of the two reporting levels, and what each derived metric adds up (a
# leading '-' subtracts) when it is not reported.
ASSET_MEASURES = ["EQ_VALUATION", "LN_VALUATION", "LOAN_BALANCE", "ASSET_DEBT", "ASSET_DEBT_CMT", "ASSET_EQUITY_CMT",
                  "EXTERNAL_DEBT_COMMIT", "ADJ_UNDRAWNCOMMITMENT", "ASSET_LEVEL_CASH", "ASSET_LEVEL_CASH_ADJ"]
FUND_MEASURES = ["FUND_CASH_UP", "FUND_CASH_DOWN", "FUND_CASH_EXP", "FUND_CASH_OTHER", "FUND_VALUE_ADJ", "FUND_REMOVE_DBL",
                 "TOTAL_FUND_DEBT", "TOTAL_FUND_CAPITAL_HR", "UNDRAWN_FUND_DEBT", "FUND_CAPITAL_DR", "FUND_CONDITIONAL_ACQ_EQ"]
COMMITMENT_MEASURES = ["TOTAL_COMMITTED", "EXPIRED_COMMITMENT", "TOTAL_CALLED", "RETURN_OF_CALL", "TOTAL_RECALLED"]
DERIVED = {
    "ASSET_NAV": "EQ_VALUATION LN_VALUATION LOAN_BALANCE",
    "FUND_NAV": "FUND_CASH_UP FUND_CASH_DOWN FUND_CASH_EXP FUND_CASH_OTHER FUND_VALUE_ADJ -TOTAL_FUND_DEBT EQ_VALUATION LN_VALUATION "
                "LOAN_BALANCE",
    "FUM": "FUND_CASH_UP FUND_CASH_DOWN FUND_CASH_EXP FUND_CASH_OTHER FUND_VALUE_ADJ -TOTAL_FUND_DEBT EQ_VALUATION LN_VALUATION "
           "LOAN_BALANCE TOTAL_FUND_CAPITAL_HR",
    "PORTFOLIO_GAV": "EQ_VALUATION LN_VALUATION LOAN_BALANCE ASSET_DEBT",
    "FUND_GAV": "EQ_VALUATION LN_VALUATION LOAN_BALANCE ASSET_DEBT FUND_CASH_UP FUND_CASH_DOWN FUND_CASH_EXP FUND_CASH_OTHER "
                "FUND_VALUE_ADJ",
    "AUM": "EQ_VALUATION LN_VALUATION LOAN_BALANCE ASSET_DEBT ASSET_DEBT_CMT ASSET_EQUITY_CMT EXTERNAL_DEBT_COMMIT "
           "ADJ_UNDRAWNCOMMITMENT FUND_CASH_UP FUND_CASH_DOWN FUND_CASH_EXP FUND_CASH_OTHER FUND_VALUE_ADJ FUND_REMOVE_DBL",
    "DRY_POWDER": "TOTAL_FUND_CAPITAL_HR UNDRAWN_FUND_DEBT FUND_CASH_OTHER FUND_CASH_DOWN FUND_CASH_EXP FUND_CAPITAL_DR "
                  "ASSET_LEVEL_CASH ASSET_LEVEL_CASH_ADJ -ASSET_DEBT_CMT -ASSET_EQUITY_CMT -ADJ_UNDRAWNCOMMITMENT "
                  "-FUND_CONDITIONAL_ACQ_EQ",
}
# What a check adds up before the cutoff date (None: no check then), with the reported
# or derived value it is held against; from the cutoff on it is the metric's own sum.
EARLY_CHECKS = {
    "ASSET_NAV": "EQ_VALUATION -ASSET_NAV", "FUND_NAV": None,
    "FUM": "FUND_CASH_OTHER EQ_VALUATION FUND_CASH_DOWN FUND_VALUE_ADJ -TOTAL_FUND_DEBT -FUM -ASSET_NAV",
    "PORTFOLIO_GAV": None, "FUND_GAV": None,
    "AUM": "EQ_VALUATION ASSET_DEBT ASSET_EQUITY_CMT ASSET_LEVEL_CASH FUND_CASH_OTHER TOTAL_FUND_CAPITAL_HR FUND_CASH_DOWN -AUM",
    "DRY_POWDER": None,
}
HELD_AGAINST = {"ASSET_NAV": "ASSET_NAV", "FUND_NAV": "CALC_FUND_NAV", "FUM": "CALC_FUM", "PORTFOLIO_GAV": "PORTFOLIO_GAV",
                "FUND_GAV": "CALC_FUND_GAV", "AUM": "CALC_AUM", "DRY_POWDER": "CALC_DRY_POWDER"}


def added(terms: str) -> Column:
    """Sum of signed columns, missing ones as 0."""
    total = F.lit(0.0)
    for t in terms.split():
        value = F.coalesce(F.col(t.lstrip("-")), F.lit(0.0))
        total = total - value if t[0] == "-" else total + value
    return total


def aum_metrics(levels: Sequence[DataFrame], ids: DataFrame, cutoff: str, always: str = "Fund Level",
                check_digits: int = 2) -> DataFrame:
    """M2: rows of all levels summed per (report_date, fund, portfolio); the seven derived metrics
    (reported value, else their sum), the seven residual checks (rounded to ``check_digits``; another
    formula, or none, before ``cutoff``), fund ids, and rows whose amounts add up to nothing (the signed sum of all 33
    reported columns) dropped, unless the portfolio is ``always``."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)
    keys = ["report_date", "fund", "portfolio"]
    s = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])
    s = s.withColumns({f"CALC_{m}": F.coalesce(F.col(m), added(t)) for m, t in DERIVED.items()})
    early = F.col("report_date") < F.lit(cutoff).cast("date")
    checks = {}
    for m, t in DERIVED.items():
        late = added(f"{t} -{HELD_AGAINST[m]}")
        before = F.lit(None).cast("double") if EARLY_CHECKS[m] is None else added(EARLY_CHECKS[m])
        checks[f"CHECK_{m}"] = F.round(F.when(early, before).otherwise(late), check_digits)
    s = s.withColumns(checks).join(ids, "fund", "left")
    size = F.abs(added(" ".join(m for m in [*DERIVED, *ASSET_MEASURES, *FUND_MEASURES, *COMMITMENT_MEASURES] if m in s.columns)))
    return s.where((size >= 0.005) | (F.col("portfolio") == always))


def capital_transactions(txns: DataFrame, rates: DataFrame, metrics: DataFrame, types: Sequence[str], base: str = "GBP") -> DataFrame:
    """Final transactions of the given types (transaction_id, fund, portfolio, type, amount,
    currency, transaction_date, draft) in ``base`` currency at their month end (no rate: NULL), for
    (fund, portfolio) pairs that the metrics know, each in the reporting period it falls into."""
    t = (txns.where((F.lower("draft") == "false") & (F.trim("portfolio") != "") & F.col("type").isin(*types))
         .withColumn("month_end", F.last_day("transaction_date")))
    r = rates.select(F.col("currency").alias("r_currency"), F.col("ref_date").alias("r_date"), "rate_to_base")
    t = t.join(r, (F.col("currency") == F.col("r_currency")) & (F.col("month_end") == F.col("r_date")), "left")
    rate = F.when(F.upper(F.trim("currency")) == base, F.lit(1.0)).otherwise(F.col("rate_to_base"))
    t = t.withColumn("used_rate", rate).withColumn("amount_base", F.col("amount") * F.col("used_rate")).drop("r_currency", "r_date", "rate_to_base")
    dates = metrics.select("fund", "portfolio", "report_date").distinct()
    known = t.join(dates.select("fund", "portfolio").distinct(), ["fund", "portfolio"], "left_semi")
    return bucket_to_period(known, dates, "month_end", "report_date", keys=["fund", "portfolio"])


# What the bridge counts as committed equity and as fund-level adjustment.
COMMITTED = "ASSET_DEBT_CMT ASSET_EQUITY_CMT ADJ_UNDRAWNCOMMITMENT"
FUND_LEVEL = "FUND_CASH_UP FUND_CASH_DOWN FUND_CASH_EXP FUND_CASH_OTHER FUND_VALUE_ADJ FUND_REMOVE_DBL"


def bridge(metrics: DataFrame, txns: DataFrame, keys: Sequence[str], injections: Sequence[str], disposals: Sequence[str],
           first: str = "null") -> DataFrame:
    """Opening AUM + capital injections + NAV change + committed equity + debt + disposals +
    fund-level adjustments = closing AUM, per ``keys`` and report date. NAV change is what the
    others leave. ``first`` = 'null' leaves the first period's opening and changes NULL (view),
    'zero' counts them from 0 (analyst)."""
    s = metrics.select(*keys, "report_date", F.col("CALC_AUM").alias("a"), added(COMMITTED).alias("c"),
                       F.coalesce("ASSET_DEBT", F.lit(0.0)).alias("d"), added(FUND_LEVEL).alias("f"))
    s = s.groupBy(*keys, "report_date").agg(*[F.sum(x).alias(x) for x in "acdf"])
    w = Window.partitionBy(*keys).orderBy("report_date")

    def before(x: str) -> Column:
        return F.lag(x).over(w) if first == "null" else F.coalesce(F.lag(x).over(w), F.lit(0.0))

    s = s.select(*keys, "report_date", before("a").alias("opening"), F.col("a").alias("closing"),
                 *[(F.col(x) - before(x)).alias(n) for x, n in (("c", "committed_equity"), ("d", "debt_movements"), ("f", "fund_level_adj"))])
    paid = lambda types: F.sum(F.when(F.col("type").isin(*types), -F.col("amount_base")).otherwise(0.0))
    moved = txns.where(F.col("report_date").isNotNull()).groupBy(*keys, "report_date").agg(
        paid(injections).alias("capital_injections"), paid(disposals).alias("disposals"))
    j = s.join(moved, [*keys, "report_date"], "left").fillna(0.0, ["capital_injections", "disposals"])
    parts = ["capital_injections", "committed_equity", "debt_movements", "disposals", "fund_level_adj"]
    return j.withColumn("nav_change", F.col("closing") - F.col("opening") - sum((F.col(p) for p in parts), F.lit(0.0)))


# -- enrichment ---------------------------------------------------------------------------------
# Reporting names of lifecycle phases by priority, countries and technologies.
PHASES = ["In Last Mile Development", "In Development", "In Construction", "In Optimisation", "In Repowering", "Operational",
          "Decommissioning"]
COUNTRIES = {"UK": ["England", "Scotland", "Wales", "UK", "United Kingdom"]}
TECHNOLOGIES = {"Solar": ["Ground mount solar", "Rooftop solar", "Agrivoltaics"], "Offshore wind": ["Offshore wind", "Floating wind"],
                "Biomass": ["Biomass", "Landfill gas", "Energy from waste"]}
DESCRIPTORS = ["asset_names", "asset_types", "reporting_asset_type", "asset_lifecycle_phases", "reporting_asset_lifecycle_phase",
               "asset_ownership_phases", "reporting_asset_ownership_phase", "asset_countries", "reporting_asset_country",
               "asset_technologies", "reporting_asset_technology"]


def merged_names(items: Column, synonyms: dict[str, list[str]]) -> Column:
    """Distinct items after every listed synonym has taken its reporting name."""
    def one(x: Column) -> Column:
        out = x
        for name, listed in synonyms.items():
            out = F.when(x.isin(*listed), F.lit(name)).otherwise(out)
        return out
    return F.array_distinct(F.transform(items, one))


def portfolio_descriptors(points: DataFrame, history: DataFrame, special: dict[str, tuple[list[str], str]] | None = None) -> DataFrame:
    """M3: per (fund, portfolio, as_of) the assets held then (``history``: fund, portfolio, asset,
    asset_type, lifecycle_phase, ownership_phase, country, technology, start, end) as '; ' lists, and
    their reporting group: the phase of highest priority ('Business / Developer' with a platform),
    one country or 'Multi-Country', one technology, 'X & Battery storage' or 'Multi-Tech Renewables',
    'Platform' over other types. ``special``: portfolio -> (countries all present, country shown)."""
    held = as_of_join(points, history, ["fund", "portfolio"], "as_of", "start", "end", how="inner", series=["asset"], listed=True)
    sets = {"asset": "names", "asset_type": "types", "lifecycle_phase": "phases", "ownership_phase": "owned", "country": "countries",
            "technology": "techs"}
    g = held.groupBy("fund", "portfolio", "as_of").agg(*[F.array_sort(F.collect_set(c)).alias(a) for c, a in sets.items()])
    phase = reduce(lambda rest, p: F.when(F.array_contains("phases", p), F.lit(p)).otherwise(rest), reversed(PHASES), F.get("phases", F.lit(0)))
    lands = merged_names(F.col("countries"), COUNTRIES)
    country = F.when(F.size(lands) > 1, F.lit("Multi-Country")).otherwise(F.array_join(lands, ", "))
    for portfolio, (present, shown) in (special or {}).items():
        both = reduce(lambda a, b: a & b, [F.array_contains("countries", c) for c in present])
        country = F.when((F.col("portfolio") == portfolio) & both, F.lit(shown)).otherwise(country)
    techs = merged_names(F.col("techs"), TECHNOLOGIES)
    battery = "Battery storage"
    other = F.element_at(F.array_except(techs, F.array(F.lit(battery))), 1)
    tech = (F.when((F.size(techs) == 2) & F.array_contains(techs, battery), F.concat(other, F.lit(f" & {battery}")))
            .when(F.size(techs) >= 2, F.lit("Multi-Tech Renewables")).otherwise(F.array_join(techs, ", ")))
    platform = F.array_contains("types", "Platform")
    listed = lambda c: F.array_join(c, "; ")
    return g.select("fund", "portfolio", "as_of", listed("names").alias("asset_names"), listed("types").alias("asset_types"),
                    F.when(platform, F.lit("Platform")).otherwise(F.array_join("types", ", ")).alias("reporting_asset_type"),
                    listed("phases").alias("asset_lifecycle_phases"),
                    F.when(platform, F.lit("Business / Developer")).otherwise(F.coalesce(phase, F.lit(""))).alias("reporting_asset_lifecycle_phase"),
                    listed("owned").alias("asset_ownership_phases"), F.array_join("owned", ", ").alias("reporting_asset_ownership_phase"),
                    listed("countries").alias("asset_countries"), country.alias("reporting_asset_country"),
                    listed("techs").alias("asset_technologies"), tech.alias("reporting_asset_technology"))


def override_descriptors(df: DataFrame, undeployed: Column, without_assets: Column, cols: Sequence[str] = DESCRIPTORS,
                         details: str | None = None) -> DataFrame:
    """M4: descriptors read 'Undeployed' or 'N/A' where a rule says so. ``details`` names an
    array of structs that then holds one element: the word in its string fields, NULL in others."""
    word = F.when(undeployed, F.lit("Undeployed")).when(without_assets, F.lit("N/A"))
    out = df.withColumns({c: F.coalesce(word, F.col(c)) for c in cols})
    if details is not None:
        fields = df.schema[details].dataType.elementType.fields
        one = F.struct(*[(word if isinstance(f.dataType, T.StringType) else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        out = out.withColumn(details, F.when(word.isNotNull(), F.array(one)).otherwise(F.col(details)))
    return out


def eliminate(df: DataFrame, rules: Sequence[dict], names: Sequence[str] = ("fund", "portfolio"), suffix: str = " [ELIMINATION]") -> DataFrame:
    """M5: a row that a rule matches comes twice: as it is, and with every number negated, ``suffix``
    behind its names and the rule's id overrides (None: NULL). A rule is {"when": SQL condition,
    "ids": {column: value}}; the first that matches holds. One pass: the copies are exploded inline."""
    rule = reduce(lambda rest, ir: F.when(F.expr(ir[1]["when"]), F.lit(ir[0])).otherwise(rest), reversed(list(enumerate(rules))), F.lit(None).cast("int"))
    twice = df.withColumn("__rule", rule).withColumn("is_elimination", F.explode(
        F.when(F.col("__rule").isNotNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    copy, cols = F.col("is_elimination"), []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.NumericType):
            c = F.when(copy, -c).otherwise(c)
        elif f.name in names:
            c = F.when(copy, F.concat(c, F.lit(suffix))).otherwise(c)
        for i, r in enumerate(rules):
            if f.name in r.get("ids", {}):
                c = F.when(copy & (F.col("__rule") == i), F.lit(r["ids"][f.name]).cast(f.dataType)).otherwise(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return twice.select(*cols, "is_elimination")


def technology_tiers(assets: DataFrame, tech_names: DataFrame, core_to_name: DataFrame, groups: DataFrame, group_names: DataFrame) -> DataFrame:
    """M7: (asset_id, technology_type, technology_sector, energy_system_category). A technology id
    that is no name id ('TECH_NAME_...') is mapped by the core bridge (technology_core_id,
    technology_name_id, group_id); groups (group_id, tier1, tier2) are named twice."""
    mapped = (assets.join(core_to_name.select(F.col("technology_core_id").alias("core"), F.col("technology_name_id").alias("via")).distinct(),
                          F.col("technology_id") == F.col("core"), "left")
              .withColumn("name_id", F.when(F.col("technology_id").rlike("^TECH_NAME_"), F.col("technology_id")).otherwise(F.col("via"))))
    tier = lambda n: group_names.select(F.col("group_id").alias(f"g{n}"), F.col("group_name").alias(f"name{n}"))
    tiers = (tech_names.join(core_to_name.select("technology_name_id", "group_id").distinct(), "technology_name_id", "left")
             .join(groups, "group_id", "left").join(tier(1), F.col("tier1") == F.col("g1"), "left").join(tier(2), F.col("tier2") == F.col("g2"), "left")
             .select("technology_name_id", "technology_name", "name1", "name2"))
    return (mapped.join(tiers, F.col("name_id") == F.col("technology_name_id"), "left")
            .select("asset_id", F.col("technology_name").alias("technology_type"), F.col("name1").alias("technology_sector"),
                    F.col("name2").alias("energy_system_category")))


# -- M14-M16: KPIs ------------------------------------------------------------------------------
# The reported KPIs and what each adds up.
KPIS = {
    "AUM": "CALC_AUM", "Asset_NAV": "CALC_ASSET_NAV", "Dry_Powder": "CALC_DRY_POWDER", "FUM": "CALC_FUM", "Fund_GAV": "CALC_FUND_GAV",
    "Fund_NAV": "CALC_FUND_NAV", "Portfolio_GAV": "CALC_PORTFOLIO_GAV",
    "Asset_Committed_Equity": "ASSET_DEBT_CMT ASSET_EQUITY_CMT ADJ_UNDRAWNCOMMITMENT",
    "Asset_Committed_External_Debt": "EXTERNAL_DEBT_COMMIT", "Asset_External_Debt": "ASSET_DEBT", "Asset_Level_Cash": "ASSET_LEVEL_CASH",
    "Asset_Level_Cash_Adj": "ASSET_LEVEL_CASH_ADJ", "Fund_HoldCo_Cash_and_Liabilities": "FUND_CASH_EXP FUND_VALUE_ADJ FUND_CASH_OTHER",
    "Fund_Downstream_Cash": "FUND_CASH_DOWN", "Fund_Upstream_Cash": "FUND_CASH_UP", "Fund_Level_Other_Adj": "FUND_VALUE_ADJ",
    "Fund_Remove_Double_Count": "FUND_REMOVE_DBL", "Fund_Debt": "TOTAL_FUND_DEBT", "Fund_Undrawn_Debt": "UNDRAWN_FUND_DEBT",
    "Fund_Conditional_Acquisition": "FUND_CONDITIONAL_ACQ_EQ", "Fund_Undrawn_Subscriptions": "TOTAL_FUND_CAPITAL_HR",
}
#: The KPIs that are compared with the previous period.
HEADLINES = ["AUM", "Dry_Powder", "FUM", "Fund_GAV", "Fund_NAV", "Portfolio_GAV"]
SLICES = {"reporting_asset_country": "Reporting_Asset_Country", "reporting_asset_technology": "Reporting_Asset_Technology",
          "reporting_asset_lifecycle_phase": "Reporting_Asset_Lifecycle_Phase"}


def gold_metrics(metrics: DataFrame, descriptors: DataFrame, currency: str = "GBP") -> DataFrame:
    """M14 projection: metrics beside the descriptors of their portfolio at the report date, labels that are NULL or
    blank as 'Unknown', and the 21 KPIs."""
    label = lambda c, out: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Unknown")).alias(out)
    named = descriptors.select(F.col("fund").alias("d_fund"), F.col("portfolio").alias("d_portfolio"), F.col("as_of").alias("d_date"), *SLICES)
    j = metrics.join(named, (F.col("fund") == F.col("d_fund")) & (F.col("portfolio") == F.col("d_portfolio"))
                     & (F.col("report_date") == F.col("d_date")), "left")
    return j.select(F.col("report_date").alias("Report_Date"), F.lit(currency).alias("Currency"), label(F.col("fund"), "Fund"),
                    label(F.col("portfolio"), "Portfolio"), *[label(F.col(c), out) for c, out in SLICES.items()],
                    *[added(terms).alias(k) for k, terms in KPIS.items()])


def kpi_slices(gold: DataFrame, slices: Sequence[str] = tuple(SLICES.values()), measures: Sequence[str] = tuple(KPIS), digits: int = 1) -> DataFrame:
    """Every measure per report date and value of each slice, with its percentage of the date's total (0 where that
    is 0 or missing). One aggregate over grouping sets gives the slices and the totals, and the totals reach their
    date's rows by a window over these few rows. Rows: (Report_Date, slice, value, measures, ``<measure>_Pct``)."""
    sets = [[F.col("Report_Date"), F.col(s)] for s in slices] + [[F.col("Report_Date")]]
    g = gold.groupingSets(sets, "Report_Date", *slices).agg(
        *[F.grouping(s).alias(f"__g_{s}") for s in slices], *[F.sum(m).alias(m) for m in measures])
    which = reduce(lambda rest, s: F.when(F.col(f"__g_{s}") == 0, F.lit(s)).otherwise(rest), slices, F.lit(None).cast("string"))
    value = reduce(lambda rest, s: F.when(F.col(f"__g_{s}") == 0, F.col(s)).otherwise(rest), slices, F.lit(None).cast("string"))
    g = g.withColumn("slice", which).withColumn("value", value)
    day = Window.partitionBy("Report_Date")
    total = {m: F.max(F.when(F.col("slice").isNull(), F.col(m))).over(day) for m in measures}
    g = g.withColumns({f"__t_{m}": c for m, c in total.items()}).where("slice IS NOT NULL")
    return g.select("Report_Date", "slice", "value", *[F.round(m, digits).alias(m) for m in measures],
                    *[F.coalesce(F.try_divide(F.col(m), F.col(f"__t_{m}")) * 100, F.lit(0.0)).alias(f"{m}_Pct") for m in measures])


def kpis_vs_previous(gold: DataFrame, keys: Sequence[str] = (), measures: Sequence[str] = tuple(HEADLINES), digits: int = 0) -> DataFrame:
    """Each KPI per ``keys`` at every report date beside the previous report date: values, delta and percentage
    (0 where the previous value is 0 or missing). A value serves the pair that ends at its date and the pair that
    starts there; both meet in one grouping, so what is missing on one side stays as NULL."""
    from strata.operators.aggregates import melt
    from strata.operators.windows import previous_period
    sums = gold.groupBy("Report_Date", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    long = melt(sums, ["Report_Date", *keys], measures, "Metric", "value")
    dates = previous_period(sums, "Report_Date", "prev")
    following = dates.select(F.col("prev").alias("Report_Date"), F.col("Report_Date").alias("next")).where("Report_Date IS NOT NULL")
    both = long.join(dates, "Report_Date", "left").join(following, "Report_Date", "left")
    role = F.explode(F.array(F.struct(F.col("prev").alias("p"), F.col("Report_Date").alias("t"), F.lit(None).cast("double").alias("old"), F.col("value").alias("new")),
                             F.struct(F.col("Report_Date").alias("p"), F.col("next").alias("t"), F.col("value").alias("old"), F.lit(None).cast("double").alias("new"))))
    g = (both.select(*keys, "Metric", role.alias("r")).where("r.p IS NOT NULL AND r.t IS NOT NULL")
         .groupBy(*keys, "Metric", F.col("r.p").alias("Prev_Report_Date"), F.col("r.t").alias("This_Report_Date"))
         .agg(F.max("r.old").alias("old"), F.max("r.new").alias("new")))
    delta = F.col("new") - F.col("old")
    pct = F.when(F.col("old") != 0, delta / F.col("old") * 100)
    return g.select(*keys, "Metric", "Prev_Report_Date", "This_Report_Date", F.round("old", digits).alias("KPI_Prev_Report_Date"),
                    F.round("new", digits).alias("KPI_This_Report_Date"), F.round(delta, digits).alias("Delta"),
                    F.coalesce(F.round(pct, 2 + digits), F.lit(0.0)).alias("Percentage_Delta"))
