"""Hand fixtures: streams with all flags, the kept SCD2 table, check roles, AUM models, KPIs, track record, variance."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import checks as C
from strata.operators import dq as DQ
from strata.operators.scd2 import scd2_apply_changes
from strata.plans import aum_core as AC
from strata.plans import aum_models as AM
from strata.plans import fund_models as FM
from strata.session import scratch_path
from strata.sources import ingest as I
from strata.sources.tables import scan_stream
from strata.streaming import jobs as W

DAY = dt.date


# ---------------------------------------------------------------- streams
def land(spark, path, batches, schema):
    """One file a batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return scan_stream(spark, path, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)


GATE = {"not_null": ["v"], "rules": {"big": "v > 90"}, "soft_rules": {"odd": "v % 2 = 1"}, "unique": ["id"], "order": ["v"]}


def test_gate_equals_the_batch_operators_and_resumes(spark):
    path, sink, ckpt = (scratch_path(spark, x) for x in ("gate-in", "gate-out", "gate-ckpt"))
    first = [[(1, 2, "a"), (2, 3, "b"), (3, None, "a"), (3, None, "a")], [(1, 2, "a"), (4, 95, "zz"), (None, 4, "a"), (None, 4, "a")]]
    ref = spark.createDataFrame([("a",), ("b",), ("a",)], "code string")
    refs = [(ref, {"c": "code"}, "code_known", True)]
    stream = land(spark, path, first, "id int, v int, c string")
    W.quality_gate(spark, stream, "g", refs=refs, sink=sink, checkpoint=ckpt, **GATE)
    spark.createDataFrame([(4, 8, "a"), (5, 6, "b")], "id int, v int, c string").coalesce(1).write.mode("append").parquet(path)
    stream = scan_stream(spark, path, spark.createDataFrame([], "id int, v int, c string").schema, max_files_per_trigger=1)
    clean, quarantine = W.quality_gate(spark, stream, "g", refs=refs, sink=sink, checkpoint=ckpt, **GATE)
    rows = [*first[0], *first[1], (4, 8, "a"), (5, 6, "b")]
    seen, flagged = set(), []
    for i, v, c in rows:  # arrival order
        again = i is not None and i in seen
        seen.add(i)
        hard = max(v is None, (v or 0) > 90, c not in "ab", again)
        flagged.append((i, v, c, int(hard), int((v or 0) % 2 == 1)))
    got_clean = sorted(map(tuple, spark.read.parquet(clean).select("id", "v", "c").collect()), key=repr)
    got_bad = sorted(map(tuple, spark.read.parquet(quarantine).select("id", "v", "c", "DQ_hard_quarantine", "DQ_soft_quarantine").collect()), key=repr)
    assert got_clean == sorted((x[:3] for x in flagged if not x[3]), key=repr)
    assert got_bad == sorted((x for x in flagged if x[3] or x[4]), key=repr)
    assert {"DQ_hard_null_v", "DQ_hard_big", "DQ_soft_odd", "DQ_hard_code_known", "DQ_hard_duplicate"} <= set(spark.read.parquet(quarantine).columns)


def test_scd2_table_is_kept_per_batch(spark):
    """Late changes re-open history; a batch leaves the editions of other buckets alone."""
    path, sink, ckpt = (scratch_path(spark, x) for x in ("scd-in", "scd-out", "scd-ckpt"))
    t = lambda n: dt.datetime(2024, 1, n)
    schema = "k int, ts timestamp, v string, n int"
    batches = [[(k, t(2), "a", 1) for k in range(20)] + [(1, t(5), "b", 2)], [(1, t(3), "c", 3), (2, t(4), None, 9)], [(3, t(9), "z", 1)]]
    spec = dict(keys=["k"], seq="ts", tracked=["v"], untracked=["n"])
    stream = land(spark, path, batches, schema)
    W.scd2_stream(spark, stream, "s", sink=sink, checkpoint=ckpt, buckets=16, **spec)
    got = W.scd2_versions(spark, sink)
    every = spark.createDataFrame([r for b in batches for r in b], schema)
    want = scd2_apply_changes(every, **spec)
    key = lambda df: sorted(map(tuple, df.select("k", "__START_AT", "v", "n", "__END_AT").collect()), key=repr)
    assert key(got) == key(want) and got.where("k = 1").count() == 3
    editions = {(r["bucket"], r["batch"]) for r in spark.read.parquet(f"{sink}/versions").select("bucket", "batch").distinct().collect()}
    last = {b for b, n in editions if n == 2}
    assert len(last) == 1 and len({b for b, n in editions if n == 1}) <= 2 < len({b for b, n in editions if n == 0})


# ---------------------------------------------------------------- checks by roles
def test_roles_templates_and_overrides(spark):
    df = spark.createDataFrame([(1, "x", DAY(2024, 1, 1), DAY(2024, 1, 1)), (1, None, DAY(2024, 2, 1), None)], "id int, name string, a date, z date")
    defaults = {"roles": {"system_keys": ["id"], "start": "a", "end": "z", "audit": "loaded_by"}, "checks": [
        {"template": "not_null", "name": "audited", "params": {"roles": ["audit"]}, "when_roles_present": ["audit"]},
        {"template": "scd2_zero_length", "name": "zero", "when_roles_present": ["start", "end"]},
        {"template": "not_null", "name": "named", "params": {"columns": ["name"]}}]}
    names = lambda table, **more: [(c.name, c.criticality) for c in C.checks_for(df, table, defaults, **more)]
    assert names({}) == [("zero", "warn"), ("named", "error")]  # no loaded_by column: the audit check is skipped
    assert names({"roles": {"audit": "name"}}) == [("audited", "error"), ("zero", "warn"), ("named", "error")]
    assert names({"checks": [{"template": "not_null", "name": "named", "enabled": False}, {"template": "unique", "params": {"roles": ["system_keys", "start"]}}]}) == [
        ("zero", "warn"), ("id_a_is_unique", "error")]
    two = {"checks": [{"template": "not_null", "name": "keys", "criticality": "warn", "params": {"roles": ["system_keys"], "columns": ["z"]}}]}
    assert names(two)[-2:] == [("keys_0", "warn"), ("keys_1", "warn")]
    own = C.TEMPLATES.extended(not_null=lambda p, r: C.check_pattern(p["columns"][0], "^x"))
    assert "not_null" in C.TEMPLATES and C.checks_for(df, {}, defaults, own)[1].function == "regex_match"
    with pytest.raises(ValueError, match="unknown check template"):
        C.checks_for(df, {"checks": [{"template": "none"}]}, defaults)
    found = C.findings(C.evaluate(df, C.checks_for(df, {}, defaults)), ["id"]).collect()
    assert sorted(r["check_name"] for r in found) == ["named", "zero"]


def test_two_overlap_checks_on_one_table(spark):
    df = spark.createDataFrame([(1, 7, 1, 5), (1, 8, 3, 9), (2, 7, 4, 6)], "a int, b int, s int, e int")
    checks = [C.check_scd2_overlap(["a"], "s", "e"), C.check_scd2_overlap(["b"], "s", "e")]
    checks[1].name = "by_b"
    got = {(r["a"], r["b"], r["check_name"]) for r in C.findings(C.evaluate(df, checks), ["a", "b"]).collect()}
    assert got == {(1, 8, "scd2_no_overlap"), (2, 7, "by_b")}


# ---------------------------------------------------------------- AUM
def metrics(spark, **amounts):
    cols = {"EQ_VALUATION": 100.0, "LN_VALUATION": 20.0, "LOAN_BALANCE": 5.0, "ASSET_DEBT": 10.0} | amounts
    names = [*AC.ASSET_MEASURES, *AC.FUND_MEASURES, *AC.COMMITMENT_MEASURES, *AC.DERIVED]
    schema = "report_date date, fund string, portfolio string, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([(DAY(2024, 3, 31), "F", "P", *[cols.get(n) for n in names])], schema)


def ids(spark):
    return spark.createDataFrame([("F", 1)], "fund string, fund_id int")


def test_derived_metrics_and_checks(spark):
    r = AC.aum_metrics([metrics(spark, FUND_CASH_UP=7.0, TOTAL_FUND_DEBT=2.0, TOTAL_FUND_CAPITAL_HR=50.0, AUM=150.0)], ids(spark), "2020-01-01").first()
    assert (r["CALC_ASSET_NAV"], r["CALC_FUND_NAV"], r["CALC_FUM"], r["CALC_PORTFOLIO_GAV"], r["CALC_FUND_GAV"], r["CALC_AUM"], r["CALC_DRY_POWDER"]) == (
        125.0, 130.0, 180.0, 135.0, 142.0, 150.0, 50.0)
    assert r["CHECK_AUM"] == 142.0 - 150.0 and r["CHECK_ASSET_NAV"] == 125.0 and r["CHECK_FUND_NAV"] == 0.0
    early = AC.aum_metrics([metrics(spark)], ids(spark), "2030-01-01").first()
    assert early["CHECK_ASSET_NAV"] == 100.0 and early["CHECK_FUND_NAV"] is None and early["CHECK_AUM"] == 110.0


def test_suppression_takes_the_signed_sum(spark):
    gone = metrics(spark, EQ_VALUATION=100.0, LN_VALUATION=-100.0, LOAN_BALANCE=0.0, ASSET_DEBT=0.0)
    assert AC.aum_metrics([gone], ids(spark), "2020-01-01").count() == 0
    assert AC.aum_metrics([gone.withColumn("portfolio", F.lit("Fund Level"))], ids(spark), "2020-01-01").count() == 1
    assert AC.aum_metrics([gone.withColumn("TOTAL_CALLED", F.lit(1.0))], ids(spark), "2020-01-01").count() == 1


def test_bridge_closes(spark):
    m = AC.aum_metrics([metrics(spark), metrics(spark, EQ_VALUATION=160.0, ASSET_DEBT=30.0).withColumn("report_date", F.lit(DAY(2024, 6, 30)))], ids(spark), "2020-01-01")
    tx = spark.createDataFrame([("F", "P", "Buy", -25.0, DAY(2024, 6, 30)), ("F", "P", "Sell", 5.0, DAY(2024, 6, 30))],
                               "fund string, portfolio string, type string, amount_base double, report_date date")
    b = AC.bridge(m, tx, ["fund"], ["Buy"], ["Sell"]).orderBy("report_date").collect()
    assert b[0]["opening"] is None and b[0]["nav_change"] is None
    r = b[1]
    assert (r["opening"], r["closing"], r["capital_injections"], r["disposals"], r["debt_movements"]) == (135.0, 215.0, 25.0, -5.0, 20.0)
    assert r["opening"] + sum(r[c] for c in ("capital_injections", "committed_equity", "debt_movements", "disposals", "fund_level_adj", "nav_change")) == r["closing"]


def test_capital_transactions(spark):
    m = spark.createDataFrame([("F", "P", DAY(2024, 3, 31)), ("F", "P", DAY(2024, 6, 30))], "fund string, portfolio string, report_date date")
    tx = spark.createDataFrame([(1, "F", "P", "Buy", 10.0, "EUR", DAY(2024, 2, 3), "False"), (2, "F", "P", "Buy", 10.0, "gbp ", DAY(2024, 5, 3), "False"),
                                (3, "F", "P", "Buy", 10.0, "EUR", DAY(2024, 7, 3), "False"), (4, "F", "P", "Buy", 1.0, "GBP", DAY(2024, 5, 3), "True"),
                                (5, "F", "Q", "Buy", 1.0, "GBP", DAY(2024, 5, 3), "False"), (6, "F", "P", "Fee", 1.0, "GBP", DAY(2024, 5, 3), "False")],
                               "transaction_id int, fund string, portfolio string, type string, amount double, currency string, transaction_date date, draft string")
    rates = spark.createDataFrame([("EUR", DAY(2024, 2, 29), 0.5)], "currency string, ref_date date, rate_to_base double")
    got = {r["transaction_id"]: (r["amount_base"], r["report_date"]) for r in AC.capital_transactions(tx, rates, m, ["Buy"]).collect()}
    assert got == {1: (5.0, DAY(2024, 3, 31)), 2: (10.0, DAY(2024, 6, 30)), 3: (None, None)}


def test_descriptors_overrides_eliminations(spark):
    hist = spark.createDataFrame([("F", "P", a, k, p, "Owned", c, t, DAY(2020, 1, 1), None) for a, k, p, c, t in (
        ("A2", "Infrastructure", "Operational", "England", "Rooftop solar"), ("A1", "Infrastructure", "In Construction", "Scotland", "Battery storage"))],
        "fund string, portfolio string, asset string, asset_type string, lifecycle_phase string, ownership_phase string, country string, technology string, start date, end date")
    points = spark.createDataFrame([("F", "P", DAY(2024, 3, 31)), ("F", "P", DAY(2019, 3, 31))], "fund string, portfolio string, as_of date")
    d = AC.portfolio_descriptors(points, hist).collect()
    assert len(d) == 1 and (d[0]["asset_names"], d[0]["reporting_asset_lifecycle_phase"], d[0]["reporting_asset_country"], d[0]["reporting_asset_technology"]) == (
        "A1; A2", "In Construction", "UK", "Solar & Battery storage")
    named = spark.createDataFrame([("F", "P", 5.0, 7, "x"), ("G", "Q", 1.0, 8, "y")], "fund string, portfolio string, aum double, fund_id int, asset_names string")
    over = AC.override_descriptors(named, F.col("portfolio") == "P", F.col("portfolio") == "Q", ["asset_names"])
    assert {r["asset_names"] for r in over.collect()} == {"Undeployed", "N/A"}
    e = AC.eliminate(named, [{"when": "fund_id = 7", "ids": {"fund_id": None}}]).where("is_elimination").collect()
    assert [tuple(r) for r in e] == [("F [ELIMINATION]", "P [ELIMINATION]", -5.0, None, "x", True)]


def test_technology_tiers(spark):
    mk = spark.createDataFrame
    got = {r["asset_id"]: tuple(r)[1:] for r in AC.technology_tiers(
        mk([(1, "TECH_NAME_s"), (2, "CORE_s"), (3, "CORE_none")], "asset_id int, technology_id string"), mk([("TECH_NAME_s", "Solar")], "technology_name_id string, technology_name string"),
        mk([("CORE_s", "TECH_NAME_s", "g")], "technology_core_id string, technology_name_id string, group_id string"), mk([("g", 1, 2)], "group_id string, tier1 int, tier2 int"),
        mk([(1, "Sun"), (2, "Power")], "group_id int, group_name string")).collect()}
    assert got == {1: ("Solar", "Sun", "Power"), 2: ("Solar", "Sun", "Power"), 3: (None, None, None)}


def gold(spark):
    rows = [(DAY(2024, 3, 31), "F", "UK", "Solar", 10.0), (DAY(2024, 3, 31), "G", "UK", "Wind", 30.0), (DAY(2024, 6, 30), "F", "ES", "Solar", 0.0), (DAY(2024, 9, 30), "F", "UK", "Solar", 5.0)]
    return spark.createDataFrame(rows, "Report_Date date, Fund string, Reporting_Asset_Country string, Reporting_Asset_Technology string, AUM double")


def test_kpi_slices_in_one_aggregate(spark):
    s = AC.kpi_slices(gold(spark), ["Reporting_Asset_Country", "Reporting_Asset_Technology"], ["AUM"])
    got = {(r["Report_Date"].month, r["slice"], r["value"]): (r["AUM"], r["AUM_Pct"]) for r in s.collect()}
    assert got[3, "Reporting_Asset_Country", "UK"] == (40.0, 100.0) and got[3, "Reporting_Asset_Technology", "Wind"] == (30.0, 75.0)
    assert got[6, "Reporting_Asset_Country", "ES"] == (0.0, 0.0) and len(got) == 7
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan


def test_kpis_by_fund_against_the_previous_period(spark):
    got = {(r["Fund"], r["This_Report_Date"].month): (r["KPI_Prev_Report_Date"], r["KPI_This_Report_Date"], r["Delta"], r["Percentage_Delta"])
           for r in AC.kpis_vs_previous(gold(spark), ["Fund"], ["AUM"]).collect()}
    assert got == {("F", 6): (10.0, 0.0, -10.0, -100.0), ("G", 6): (30.0, None, None, 0.0), ("F", 9): (0.0, 5.0, 5.0, 0.0)}


def test_track_record_report(spark):
    mk = spark.createDataFrame
    snap = mk([(1, DAY(2022, 12, 31), 1.5), (1, DAY(2023, 6, 30), None)], "fund_id int, report_date date, dpi double")
    eav = mk([(1, DAY(2022, 12, 31), "Net IRR (Annualised)", 0.1, 1), (1, DAY(2022, 12, 31), "Net IRR (Annualised)", 0.2, 2), (2, DAY(2021, 12, 31), "Net IRR (Annualised)", 0.3, 1)],
             "fund_id int, report_date date, datapoint_name string, value double, revision int")
    funds = mk([(1, "One", "GBP", DAY(2020, 1, 1), None), (2, "Two", "EUR", DAY(2020, 1, 1), DAY(2021, 6, 1))], "fund_id int, fund string, currency string, start_date date, end_date date")
    d = AM.metric_dictionary(eav, snap, ["fund_id", "report_date"], mk([("dpi", "DPI")], "metric string, display_name string"), mk([("dpi", "Paid out")], "metric string, definition string"))
    assert {(r["dataset_name"], r["normalised_metric"], r["metric"], r["definition"]) for r in d.collect()} == {
        ("datapointsexport", "net_irr_annualised", None, None), ("track_record_fund", "dpi", "DPI", "Paid out")}
    got = {(r["fund"], r["raw_metric"]): (r["latest_metric_date"], r["latest_metric_value"], r["2022"], r["fund_is_active"], r["metric"])
           for r in AM.track_record_report(snap, eav, funds, ["net_irr_annualised"], [2021, 2022], d).collect()}
    assert got == {("One", "dpi"): (DAY(2022, 12, 31), 1.5, 1.5, True, "DPI"), ("One", "net_irr_annualised"): (DAY(2022, 12, 31), 0.2, 0.2, True, None),
                   ("Two", "net_irr_annualised"): (DAY(2021, 12, 31), 0.3, None, False, None)}


def test_variance_over_tables_of_different_shape(spark):
    a = spark.createDataFrame([("x", 3, 30.0, 1.0, 1), ("x", 2, 10.0, 1.0, 1), ("x", 1, 10.0, 2.0, 1), ("x", 3, 15.0, 1.0, 0)], "k string, p int, u double, w double, loaded int")
    b = spark.createDataFrame([(1, 4.0, 1)], "id int, only double, loaded int")
    got = {(r["table_name"], r["keys"]): (r["max_pct_diff"], r["max_variance_column"]) for r in AM.kpi_variance({
        "a": (a, {"match_keys": ["k", "p"], "load_date": "loaded", "partition_by": ["k"], "order_by": {"p": "desc"}, "window": 2}),
        "b": (b, {"match_keys": ["id"], "load_date": "loaded", "partition_by": ["id"], "order_by": {"id": "asc"}, "window": 1})}).collect()}
    assert got == {("a", "k=x|p=3"): (200.0, "u"), ("a", "k=x|p=2"): (50.0, "w"), ("a", "k=x|p=1"): (None, None), ("b", "id=1"): (None, None)}
    with pytest.raises(ValueError, match="no numeric column"):
        AM.kpi_variance({"b": (b, {"match_keys": ["id"], "load_date": "loaded", "partition_by": ["id"], "order_by": {"id": "asc"}, "window": 1, "exclude": ["only"]})})


def test_four_dedupes_of_fund_operations(spark):
    mk = spark.createDataFrame
    d = DAY(2024, 1, 1)
    ops = mk([(1, 7, "Big", "GBP", "Acme", d, "MF: Commitment", 0.0, 0.0, 100.0, 5.0, None, "All", "False", 2), (1, 7, "Big", "GBP", "Acme", d, "MF: Commitment", 0.0, 0.0, 1.0, 0.0, None, "All", "False", 1),
              (2, 7, "Big", "GBP", "Acme", d, "MF: Expired/Released Commitment", 0.0, 0.0, 0.0, 0.0, 30.0, "All", "False", 1), (3, 7, "Big", "GBP", "Acme", d, "MF: Call", 9.0, 0.0, 0.0, 0.0, None, "Top 20", "False", 1),
              (4, 7, "Big", "GBP", "Feeder", d, "MF: Call", 9.0, 0.0, 0.0, 0.0, None, "All", "False", 1), (5, 7, "Big", "GBP", "Acme", d, "MF: Call", 9.0, 0.0, 0.0, 0.0, None, "All", "True", 1)],
             "operation_id int, fund_id int, fund string, currency string, account string, effective_date date, type string, amount double, valuation double, committed double, redrawable double, expired double, share string, draft string, loaded int")
    funds = mk([(7, "Big", "new", 2), (7, "Big", "old", 1), (8, "Feeder", "f", 1)], "fund_id int, fund string, short_name string, loaded int")
    accounts = mk([("Acme", 7, "Pension", "UK", 2), ("Acme", 7, "old", "UK", 1), ("Feeder", 7, " ", None, 1)], "account string, fund_id int, investor_type string, country string, loaded int")
    mapped = mk([(7, "Fund Big", "LP", None, 2), (7, "old", "LP", None, 1)], "source_fund_id int, fund_name string, structure_type string, end_date date, updated int")
    got = {r["Investor"]: (r["Ef_Fund"], r["Fund"], r["Investor_Type"], r["Investor_Country"], r["Commitments"], r["Called"]) for r in FM.fundoperations_full(ops, funds, accounts, mapped).collect()}
    assert got == {"Acme": ("new", "Fund Big", "Pension", "UK", 75.0, 0.0), "Feeder": ("new", "Fund Big", "Feeder Fund", "N/A", 0.0, 9.0)}


def test_mapped_dimension_and_json_schema_from_the_data(spark):
    mk = spark.createDataFrame
    got = AM.mapped_dimension(mk([(1, "a"), (2, "b"), (3, "c")], "id int, n string"), mk([(1, "S", 10), (2, "S", 20), (3, "T", 30)], "source_id int, source_system_id string, core int"), "S", "id", "core",
                              [(mk([(10, "Ten", None), (20, "Old", DAY(2020, 1, 1))], "k int, name string, END_AT date"), "core", "k")]).collect()
    assert sorted((r["id"], r["core"], r["name"]) for r in got) == [(1, 10, "Ten"), (2, 20, None)]
    docs = mk([('[{"a": 1, "b": "x"}, {"a": 2}]', 1), ('[{"c": true}]', 2)], "doc string, k int")
    rows = I.explode_json_array(docs, "doc", keep=["k"])
    assert rows.columns == ["k", "a", "b", "c"] and rows.count() == 3
    with pytest.raises(ValueError, match="no arrays of objects"):
        I.explode_json_array(mk([("[1]", 1)], "doc string, k int"), "doc")


def test_flags_of_the_gate_are_the_batch_flags(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "id int, v int")
    assert W.flag_stream(df, ["v"], {"big": "v > 2"}).columns == DQ.flag_rules(DQ.flag_nulls(df, ["v"]), {"big": "v > 2"}).columns
