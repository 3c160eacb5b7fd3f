"""Registered data-quality queries (D1-D27) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import bespoke as BS
from strata.operators import checks as C
from strata.operators import dq as DQ
from strata.operators.graph import path_rel_ids
from strata.plans import bindings as B
from strata.plans.q_temporal import chains_cte
from strata.plans.registry import query
from strata.sources.tables import Tables


def sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


LI = B.LINEITEM_DQ_CTE
RULES = {"bad_discount": "l_discount > 0.09", "late_ship": "l_shipdate > DATE '2001-06-30'"}


def _flagged(spark, d):
    t = Tables(spark, d)
    df = B.lineitem_dq(spark, d)
    df = DQ.flag_nulls(df, ["l_orderkey", "l_suppkey"])
    df = DQ.flag_missing_ref(df, t.supplier, {"l_suppkey": "s_suppkey"}, "supplier_exists", hard=True)
    df = DQ.flag_missing_ref(df, t.part, {"l_partkey": "p_partkey"}, "part_exists", hard=False)
    return DQ.flag_rules(df, RULES)


FLAGGED_CTE = f"""{LI},
flagged AS (
  SELECT li.*,
    CASE WHEN li.l_orderkey IS NULL THEN 1 ELSE 0 END AS DQ_hard_null_l_orderkey,
    CASE WHEN li.l_suppkey IS NULL THEN 1 ELSE 0 END AS DQ_hard_null_l_suppkey,
    CASE WHEN s.s_suppkey IS NULL THEN 1 ELSE 0 END AS DQ_hard_supplier_exists,
    CASE WHEN p.p_partkey IS NULL THEN 1 ELSE 0 END AS DQ_soft_part_exists,
    CASE WHEN li.l_discount > 0.09 THEN 1 ELSE 0 END AS DQ_hard_bad_discount,
    CASE WHEN li.l_shipdate > DATE '2001-06-30' THEN 1 ELSE 0 END AS DQ_hard_late_ship
  FROM li_dq li
  LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON li.l_suppkey = s.s_suppkey
  LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON li.l_partkey = p.p_partkey
),
verdicts AS (
  SELECT *, greatest(DQ_hard_null_l_orderkey, DQ_hard_null_l_suppkey, DQ_hard_supplier_exists,
                     DQ_hard_bad_discount, DQ_hard_late_ship) AS DQ_hard_quarantine,
            DQ_soft_part_exists AS DQ_soft_quarantine
  FROM flagged
)"""


@query("d1_flag_nulls", f"""
WITH {LI}
SELECT *, CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END AS DQ_hard_null_l_orderkey,
          CASE WHEN l_suppkey IS NULL THEN 1 ELSE 0 END AS DQ_hard_null_l_suppkey
FROM li_dq""")
def d1_flag_nulls(spark, d):
    return DQ.flag_nulls(B.lineitem_dq(spark, d), ["l_orderkey", "l_suppkey", "l_orderkey"], exempt=[])


@query("d2_flag_missing_ref", f"""
WITH {LI}
SELECT li.*, CASE WHEN s.s_suppkey IS NULL THEN 1 ELSE 0 END AS DQ_hard_supplier_exists,
       CASE WHEN p.p_partkey IS NULL THEN 1 ELSE 0 END AS DQ_soft_part_exists
FROM li_dq li
LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON li.l_suppkey = s.s_suppkey
LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON li.l_partkey = p.p_partkey""")
def d2_flag_missing_ref(spark, d):
    t = Tables(spark, d)
    df = DQ.flag_missing_ref(B.lineitem_dq(spark, d), t.supplier, {"l_suppkey": "s_suppkey"}, "supplier_exists")
    return DQ.flag_missing_ref(df, t.part, {"l_partkey": "p_partkey"}, "part_exists", hard=False)


@query("d3_flag_rules", f"""
WITH {LI}
SELECT *, CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END AS DQ_hard_bad_discount,
          CASE WHEN l_shipdate > DATE '2001-06-30' THEN 1 ELSE 0 END AS DQ_hard_late_ship
FROM li_dq""")
def d3_flag_rules(spark, d):
    return DQ.flag_rules(B.lineitem_dq(spark, d), RULES)


@query("d4_duplicate_counts", f"""
WITH {LI}
SELECT 'cmp__l_orderkey_l_linenumber' AS check_name,
       concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS key_value,
       count(*) AS dup_count
FROM li_dq GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'ind__status_code', status_code, count(*) FROM li_dq GROUP BY status_code HAVING count(*) > 1""")
def d4_duplicate_counts(spark, d):
    return DQ.duplicate_counts(B.lineitem_dq(spark, d), individual=["status_code"],
                               composite=[["l_orderkey", "l_linenumber"]])


@query("d5_quarantine", f"WITH {FLAGGED_CTE} SELECT * FROM verdicts "
                        f"WHERE DQ_hard_quarantine = 1 OR DQ_soft_quarantine = 1")
def d5_quarantine(spark, d):
    return DQ.quarantine_split(_flagged(spark, d))[0]


@query("d5_clean", f"WITH {FLAGGED_CTE} SELECT * EXCLUDE (DQ_hard_null_l_orderkey, DQ_hard_null_l_suppkey, "
                   f"DQ_hard_supplier_exists, DQ_soft_part_exists, DQ_hard_bad_discount, DQ_hard_late_ship, "
                   f"DQ_hard_quarantine, DQ_soft_quarantine) FROM verdicts WHERE DQ_hard_quarantine = 0")
def d5_clean(spark, d):
    return DQ.quarantine_split(_flagged(spark, d))[1]


def _missing(spark, d):
    """Keys the line items reference that the dimension tables lack (the line items
    are the reference query, the dimension is the data being validated)."""
    t = Tables(spark, d)
    li = B.lineitem_dq(spark, d)
    return (DQ.missing_reference(t.supplier, li, {"s_suppkey": "l_suppkey"}, "supplier_missing")
            .unionByName(DQ.missing_reference(t.part, li, {"p_partkey": "l_partkey"}, "part_missing")))


MISSING_CTE = f"""{LI},
missing AS (
  SELECT 'supplier_missing' AS validation_check_name, 'l_suppkey' AS column_names,
         concat_ws(' | ', CAST(l_suppkey AS VARCHAR)) AS missing_value
  FROM (SELECT DISTINCT l_suppkey FROM li_dq) l
  WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE l.l_suppkey = s.s_suppkey)
  UNION ALL
  SELECT 'part_missing', 'l_partkey', concat_ws(' | ', CAST(l_partkey AS VARCHAR))
  FROM (SELECT DISTINCT l_partkey FROM li_dq) l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE l.l_partkey = p.p_partkey)
)"""


@query("d6_missing_reference", f"WITH {MISSING_CTE} SELECT * FROM missing")
def d6_missing_reference(spark, d):
    return _missing(spark, d)


@query("d6_missing_reference_summary", f"""
WITH {MISSING_CTE}
SELECT validation_check_name, column_names, count(*) AS count FROM missing GROUP BY ALL""")
def d6_missing_reference_summary(spark, d):
    return DQ.missing_reference_summary(_missing(spark, d))


def _events_quarantine(spark, d):
    df = DQ.flag_nulls(B.events_dq(spark, d), ["value"])
    df = DQ.flag_rules(df, {"error_event": "event_type = 'error'"}, hard=False)
    return DQ.quarantine_split(df)[0]


EVQ_CTE = f"""{B.EVENTS_DQ_CTE},
evq AS (
  SELECT *, CASE WHEN value IS NULL THEN 1 ELSE 0 END AS DQ_hard_null_value,
            CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS DQ_soft_error_event
  FROM events_dq
),
evq2 AS (
  SELECT *, DQ_hard_null_value AS DQ_hard_quarantine, DQ_soft_error_event AS DQ_soft_quarantine FROM evq
  WHERE DQ_hard_null_value = 1 OR DQ_soft_error_event = 1
)"""


@query("d7_quarantine_summary", f"""
WITH {EVQ_CTE}
SELECT 'events' AS table_name, to_timestamp(floor(epoch(ts) / 7200) * 7200)::TIMESTAMP AS window_start,
       count(*) AS row_count, CAST(SUM(DQ_hard_quarantine) AS BIGINT) AS hard_count,
       CAST(SUM(DQ_soft_quarantine) AS BIGINT) AS soft_count
FROM evq2 GROUP BY 2""")
def d7_quarantine_summary(spark, d):
    return DQ.quarantine_summary(_events_quarantine(spark, d), "ts", "events")


@query("d8_quarantine_log", f"""
WITH {EVQ_CTE}
SELECT 'events' AS source_table, ts AS ingestion_ts,
       to_json({{'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'value': value,
                'props': props, 'DQ_hard_null_value': DQ_hard_null_value,
                'DQ_soft_error_event': DQ_soft_error_event, 'DQ_hard_quarantine': DQ_hard_quarantine,
                'DQ_soft_quarantine': DQ_soft_quarantine}})::VARCHAR AS raw_data
FROM evq2""")
def d8_quarantine_log(spark, d):
    return DQ.quarantine_log(_events_quarantine(spark, d), "events", "ts")


# -- D9-D20: template checks and the runner --------------------------------------------
NOW = "2001-06-30"
LI_PK = ["l_orderkey", "l_linenumber"]


def li_checks(spark, d):
    t = Tables(spark, d)
    return [
        C.check_not_null("l_suppkey"),
        C.check_unique(["l_orderkey", "l_linenumber"], criticality="warn"),
        C.check_in_range("l_discount", 0.0, 0.09),
        C.check_no_future("l_shipdate", F.lit(NOW).cast("date"), criticality="warn"),
        C.check_pattern("status_code", r"^[ANR]-[OF]$"),
        C.check_fk("l_suppkey", [(t.supplier, "s_suppkey"), (t.customer, "c_custkey")], allow_nulls=True),
    ]


def finding_sql(pk: list[str], name: str, function: str, message: str, cols: str, crit: str,
                src: str, where: str) -> str:
    return (f"SELECT {', '.join(pk)}, {sq(name)} AS check_name, {sq(function)} AS check_function, "
            f"{sq(message)} AS check_message, {sq(cols)} AS check_columns, {sq(crit)} AS criticality "
            f"FROM {src} WHERE {where}")


LI_FIND = {
    "d9_check_not_null": ("l_suppkey_is_not_null", "is_not_null", "Column 'l_suppkey' value is null",
                          "l_suppkey", "ERROR", "li_dq", "l_suppkey IS NULL"),
    "d10_check_unique": ("l_orderkey_l_linenumber_is_unique", "is_unique",
                         "Value of l_orderkey, l_linenumber is not unique", "l_orderkey,l_linenumber", "WARN",
                         "(SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM li_dq)",
                         "n > 1"),
    "d11_check_in_range": ("l_discount_in_range", "is_in_range", "Value of 'l_discount' is outside [0.0, 0.09]",
                           "l_discount", "ERROR", "li_dq", "NOT (l_discount BETWEEN 0.0 AND 0.09)"),
    "d12_check_no_future": ("l_shipdate_not_in_future", "is_not_in_future", "Value of 'l_shipdate' is in the future",
                            "l_shipdate", "WARN", "li_dq", f"l_shipdate > DATE '{NOW}'"),
    "d13_check_pattern": ("status_code_matches_pattern", "regex_match", "Value of 'status_code' does not match pattern",
                          "status_code", "ERROR", "li_dq",
                          "status_code IS NOT NULL AND NOT regexp_matches(status_code, '^[ANR]-[OF]$')"),
    "d14_check_fk": ("l_suppkey_fk_exists", "foreign_key", "Value of 'l_suppkey' has no match in the reference",
                     "l_suppkey", "ERROR", "li_dq",
                     "l_suppkey IS NOT NULL AND l_suppkey NOT IN "
                     "(SELECT s_suppkey FROM supplier UNION SELECT c_custkey FROM customer)"),
}

_LI_ORDER = ["d9_check_not_null", "d10_check_unique", "d11_check_in_range", "d12_check_no_future",
             "d13_check_pattern", "d14_check_fk"]


def _reg_single(qname: str, idx: int):
    spec = LI_FIND[qname]

    def fn(spark, d):
        return C.findings(C.evaluate(B.lineitem_dq(spark, d), [li_checks(spark, d)[idx]]), LI_PK)
    query(qname, f"WITH {LI} " + finding_sql(LI_PK, *spec))(fn)


for _i, _q in enumerate(_LI_ORDER):
    _reg_single(_q, _i)

LI_FINDINGS_SQL = " UNION ALL ".join(finding_sql(LI_PK, *LI_FIND[q]) for q in _LI_ORDER)


@query("d20_run_checks_findings", f"WITH {LI} {LI_FINDINGS_SQL}")
def d20_run_checks_findings(spark, d):
    return C.findings(C.evaluate(B.lineitem_dq(spark, d), li_checks(spark, d)), LI_PK)


@query("d20_run_checks_valid", f"""
WITH {LI}
SELECT * FROM li_dq
WHERE NOT (l_suppkey IS NULL OR NOT (l_discount BETWEEN 0.0 AND 0.09)
           OR (status_code IS NOT NULL AND NOT regexp_matches(status_code, '^[ANR]-[OF]$'))
           OR (l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier UNION SELECT c_custkey FROM customer)))""")
def d20_run_checks_valid(spark, d):
    return C.valid_rows(C.evaluate(B.lineitem_dq(spark, d), li_checks(spark, d)))


EDGE_PK = ["child_id", "parent_id", "active_from"]


def edge_checks():
    k = ["child_id", "parent_id"]
    return [
        C.check_scd2_unique(k, "active_from"),
        C.check_scd2_overlap(k, "active_from", "active_to"),
        C.check_scd2_contiguous(k, "active_from", "active_to"),
        C.check_scd2_chronology("active_from", "active_to"),
        C.check_scd2_zero_length("active_from", "active_to"),
    ]


EDGE_FIND = {
    "d15_check_scd2_unique": ("scd2_pk_unique", "scd2_pk_unique",
                              "Value of child_id, parent_id, active_from is not unique",
                              "child_id,parent_id,active_from", "ERROR",
                              "(SELECT *, count(*) OVER (PARTITION BY child_id, parent_id, active_from) AS n FROM edges_scd)",
                              "n > 1"),
    "d16_check_scd2_overlap": ("scd2_no_overlap", "scd2_no_overlap", "Version overlaps the previous version",
                               "child_id,parent_id,active_from,active_to", "ERROR",
                               "(SELECT *, lag(active_to) OVER (PARTITION BY child_id, parent_id ORDER BY active_from) AS pe FROM edges_scd)",
                               "pe > active_from"),
    "d17_check_scd2_contiguous": ("scd2_contiguous", "scd2_contiguous", "Version is not contiguous with the next version",
                                  "child_id,parent_id,active_from,active_to", "WARN",
                                  "(SELECT *, lead(active_from) OVER (PARTITION BY child_id, parent_id ORDER BY active_from) AS ns FROM edges_scd)",
                                  "active_to <> ns"),
    "d18_check_scd2_chronology": ("scd2_chronology", "scd2_chronology", "Start is after end",
                                  "active_from,active_to", "ERROR", "edges_scd", "active_from > active_to"),
    "d19_check_scd2_zero_length": ("scd2_zero_length", "scd2_zero_length", "Zero-length version",
                                   "active_from,active_to", "WARN", "edges_scd", "active_from = active_to"),
}
_EDGE_ORDER = list(EDGE_FIND)
EDGE_SCD_CTES = f"{B.EDGES_CTE}, {B.EDGES_SCD_CTE}"


def _reg_edge(qname: str, idx: int):
    spec = EDGE_FIND[qname]

    def fn(spark, d):
        return C.findings(C.evaluate(B.edges_scd(spark, d), [edge_checks()[idx]]), EDGE_PK)
    query(qname, f"WITH {EDGE_SCD_CTES} " + finding_sql(EDGE_PK, *spec))(fn)


for _i, _q in enumerate(_EDGE_ORDER):
    _reg_edge(_q, _i)


def _summary_sql(table: str, src: str, findings: str, pk: list[str], n_checks: int) -> str:
    pkc = ", ".join(pk)
    return f"""
SELECT {sq(table)} AS table_name, t.total_rows, e.failed_rows, w.warning_rows,
  CASE WHEN t.total_rows > 0 THEN ROUND((t.total_rows - e.failed_rows) * 100.0 / t.total_rows, 2) ELSE 100.0 END
    AS success_rate,
  CASE WHEN e.failed_rows > 0 THEN 'Issues Found' WHEN w.warning_rows > 0 THEN 'Warning' ELSE 'Success' END AS status,
  CAST({n_checks} AS BIGINT) AS checks_run
FROM (SELECT count(*) AS total_rows FROM {src}) t,
     (SELECT count(*) AS failed_rows FROM (SELECT DISTINCT {pkc} FROM ({findings}) WHERE criticality = 'ERROR')) e,
     (SELECT count(*) AS warning_rows FROM (SELECT DISTINCT {pkc} FROM ({findings}) WHERE criticality = 'WARN')) w"""


EDGE_FINDINGS_SQL = " UNION ALL ".join(finding_sql(EDGE_PK, *EDGE_FIND[q]) for q in _EDGE_ORDER)
SUMMARY_SQL = (f"WITH {LI}, {EDGE_SCD_CTES} "
               + _summary_sql("lineitem", "li_dq", LI_FINDINGS_SQL, LI_PK, 6) + " UNION ALL "
               + _summary_sql("edges", "edges_scd", EDGE_FINDINGS_SQL, EDGE_PK, 5))


def summary_of(df, checks, pk, table):
    return C.summarise(C.evaluate(df, checks), pk, table, len(checks))


def _summaries(spark, d):
    return summary_of(B.lineitem_dq(spark, d), li_checks(spark, d), LI_PK, "lineitem").unionByName(
        summary_of(B.edges_scd(spark, d), edge_checks(), EDGE_PK, "edges"))


@query("d20_run_checks_summary", SUMMARY_SQL)
def d20_run_checks_summary(spark, d):
    return _summaries(spark, d)


@query("d21_dq_report_merge", f"""
WITH {LI}, {EDGE_SCD_CTES}, new AS ({_summary_sql("lineitem", "li_dq", LI_FINDINGS_SQL, LI_PK, 6)}),
old AS (
  SELECT 'orders' AS table_name, count(*) AS total_rows, CAST(0 AS BIGINT) AS failed_rows,
         CAST(0 AS BIGINT) AS warning_rows, 100.0 AS success_rate, 'Success' AS status, CAST(1 AS BIGINT) AS checks_run
  FROM orders
  UNION ALL
  SELECT 'lineitem', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 100.0, 'Success', CAST(1 AS BIGINT) FROM lineitem
)
SELECT * FROM old WHERE table_name NOT IN (SELECT table_name FROM new) UNION ALL SELECT * FROM new""")
def d21_dq_report_merge(spark, d):
    o = Tables(spark, d).orders
    old_orders = summary_of(o, [C.check_not_null("o_orderkey")], ["o_orderkey"], "orders")
    old_li = summary_of(Tables(spark, d).lineitem, [C.check_not_null("l_orderkey")], LI_PK, "lineitem")
    new = summary_of(B.lineitem_dq(spark, d), li_checks(spark, d), LI_PK, "lineitem")
    return C.dq_report_merge(old_orders.unionByName(old_li), new)


# D14's default arm: a NULL key fails
@query("d14_check_fk_nulls_fail", f"WITH {LI} " + finding_sql(
    LI_PK, "l_suppkey_fk_exists", "foreign_key", "Value of 'l_suppkey' has no match in the reference", "l_suppkey", "ERROR", "li_dq",
    "l_suppkey IS NULL OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"))
def d14_check_fk_nulls_fail(spark, d):
    check = C.check_fk("l_suppkey", [(Tables(spark, d).supplier, "s_suppkey")])
    return C.findings(C.evaluate(B.lineitem_dq(spark, d), [check]), LI_PK)


@query("d10_check_unique_nulls_distinct", f"WITH {LI} " + finding_sql(
    LI_PK, "l_suppkey_l_shipdate_is_unique", "is_unique", "Value of l_suppkey, l_shipdate is not unique", "l_suppkey,l_shipdate", "ERROR",
    "(SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_shipdate) AS n FROM li_dq)", "n > 1 AND l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL"))
def d10_check_unique_nulls_distinct(spark, d):
    check = C.check_unique(["l_suppkey", "l_shipdate"], nulls_distinct=True)
    return C.findings(C.evaluate(B.lineitem_dq(spark, d), [check]), LI_PK)


@query("d16_check_scd2_overlap_strict", f"WITH {EDGE_SCD_CTES} " + finding_sql(
    EDGE_PK, "scd2_no_overlap", "scd2_no_overlap", "Version overlaps the previous version", "child_id,parent_id,active_from,active_to", "ERROR",
    "(SELECT *, lag(active_to) OVER w AS pe, lag(1) OVER w AS had FROM (SELECT * REPLACE (CASE WHEN event_id % 31 = 0 THEN NULL ELSE active_to END AS active_to) FROM edges_scd) "
    "WINDOW w AS (PARTITION BY child_id, parent_id ORDER BY active_from))", "pe > active_from OR (had = 1 AND pe IS NULL)"))
def d16_check_scd2_overlap_strict(spark, d):
    """Every 31st version left open: strict counts an earlier open version as an overlap."""
    e = B.edges_scd(spark, d).withColumn("active_to", F.when(F.col("event_id") % 31 != 0, F.col("active_to")))
    return C.findings(C.evaluate(e, [C.check_scd2_overlap(["child_id", "parent_id"], "active_from", "active_to", strict=True)]), EDGE_PK)


# -- D20 with roles: defaults of all tables merged with a table's own checks --------------------
ROLE_DEFAULTS = {
    "roles": {"system_keys": ["child_id", "parent_id"], "start": "active_from", "end": "active_to", "audit": ["loaded_by"]},
    "checks": [
        {"template": "scd2_overlap", "name": "overlap", "when_roles_present": ["system_keys", "start", "end"]},
        {"template": "scd2_zero_length", "name": "zero", "criticality": "warn", "when_roles_present": ["start", "end"]},
        {"template": "not_null", "name": "audit", "params": {"roles": ["audit"]}, "when_roles_present": ["audit"]},
        {"template": "in_range", "name": "percent", "params": {"columns": ["percentage"], "min": 0.0, "max": 1.0}},
        {"template": "scd2_chronology", "name": "order", "when_roles_present": ["start", "end"]},
    ]}
EDGE_CONFIG = {"checks": [
    {"template": "in_range", "name": "percent", "criticality": "warn", "params": {"columns": ["percentage"], "min": 0.2, "max": 1.0}},
    {"template": "scd2_chronology", "name": "order", "enabled": False},
    {"template": "not_null", "name": "keys", "params": {"roles": ["system_keys", "end"]}}]}
LINE_CONFIG = {"roles": {"system_keys": LI_PK, "audit": ["l_suppkey"]}, "checks": [
    {"template": "in_range", "name": "percent", "params": {"columns": ["l_discount"], "min": 0.0, "max": 0.09}},
    {"template": "unique", "name": "pk", "criticality": "warn", "params": {"roles": ["system_keys"]}, "when_roles_present": ["system_keys"]},
    {"template": "code", "name": "code", "params": {"columns": ["status_code"]}}]}
#: A table's own template beside the common ones.
LINE_TEMPLATES = C.TEMPLATES.extended(code=lambda p, r: [C.check_pattern(c, "^[ANR]-[OF]$") for c in p["columns"]])


def role_sql(table, pk, name, crit, src, where):
    return f"SELECT '{table}' AS table_name, concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in pk)}) AS pk, '{name}' AS check_name, '{crit}' AS criticality FROM {src} WHERE {where}"


ROLES_SQL = " UNION ALL ".join([
    role_sql("edges", EDGE_PK, "overlap", "ERROR", EDGE_FIND["d16_check_scd2_overlap"][5], "pe > active_from"),
    role_sql("edges", EDGE_PK, "zero", "WARN", "edges_scd", "active_from = active_to"),
    role_sql("edges", EDGE_PK, "percent", "WARN", "edges_scd", "NOT (percentage BETWEEN 0.2 AND 1.0)"),
    role_sql("edges", EDGE_PK, "keys_2", "ERROR", "edges_scd", "active_to IS NULL"),
    role_sql("lineitem", LI_PK, "audit", "ERROR", "li_dq", "l_suppkey IS NULL"),
    role_sql("lineitem", LI_PK, "percent", "ERROR", "li_dq", "NOT (l_discount BETWEEN 0.0 AND 0.09)"),
    role_sql("lineitem", LI_PK, "pk", "WARN", "(SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM li_dq)", "n > 1"),
    role_sql("lineitem", LI_PK, "code", "ERROR", "li_dq", "status_code IS NOT NULL AND NOT regexp_matches(status_code, '^[ANR]-[OF]$')")])


@query("d20_roles", f"WITH {LI}, {EDGE_SCD_CTES} {ROLES_SQL}")
def d20_roles(spark, d):
    """Two tables under one set of defaults: line items have no start and end, edges no audit column, so those checks are skipped."""
    out = None
    for table, df, pk, config, templates in (("edges", B.edges_scd(spark, d), EDGE_PK, EDGE_CONFIG, C.TEMPLATES),
                                             ("lineitem", B.lineitem_dq(spark, d), LI_PK, LINE_CONFIG, LINE_TEMPLATES)):
        found = C.findings(C.evaluate(df, C.checks_for(df, config, ROLE_DEFAULTS, templates)), pk)
        rows = found.select(F.lit(table).alias("table_name"), F.concat_ws("|", *[F.col(k).cast("string") for k in pk]).alias("pk"),
                            "check_name", "criticality")
        out = rows if out is None else out.unionByName(rows)
    return out


# -- bespoke checks ----------------------------------------------------------------------
@query("d22_self_parenting", f"""
WITH {B.EDGES_CTE} SELECT child_id, parent_id, active_from, event_id, percentage, active_to
FROM edges WHERE child_id IS NOT NULL AND child_id = parent_id""")
def d22_self_parenting(spark, d):
    return BS.self_parenting(B.edges(spark, d), "child_id", "parent_id")


@query("d23_phase_collisions", """
SELECT l_orderkey, CAST(l_shipdate AS DATE) AS ship_date, l_linestatus,
       count(DISTINCT l_returnflag) AS distinct_phase_count,
       string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS conflicting_phases,
       string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag, ','
                  ORDER BY l_linenumber, l_returnflag) AS milestone_details
FROM lineitem GROUP BY 1, 2, 3 HAVING count(DISTINCT l_returnflag) > 1""")
def d23_phase_collisions(spark, d):
    li = Tables(spark, d).lineitem.withColumn("ship_date", F.col("l_shipdate").cast("date"))
    pc = BS.phase_collisions(li, "l_orderkey", "ship_date", "l_linestatus", "l_returnflag", "l_linenumber")
    return pc.select("l_orderkey", "ship_date", "l_linestatus", "distinct_phase_count",
                     F.array_join("conflicting_phases", ",").alias("conflicting_phases"),
                     F.array_join(F.transform("milestone_details",
                                              lambda x: F.concat(x["milestone"].cast("string"), F.lit(":"), x["phase"])),
                                  ",").alias("milestone_details"))


# rel ids of chains of every length (top first), with planted corruptions: every 13th path swaps its
# endpoints, every 17th breaks its last pair, every 19th loses its dots.
REL_CTE = f"""
{chains_cte()},
rel AS (
  SELECT list_transform(list_reverse(chain), lambda x: 'N' || x) AS n, 'N' || top AS tp, 'N' || bottom AS bt,
         (top * 100003 + chain[len(chain) - 1] * 101 + bottom) % 1000 AS h FROM chains
),
rel_p AS (SELECT *, list_transform(range(1, len(n)), lambda i: n[i] || '.' || n[i + 1]) AS p FROM rel),
rel_ids AS (
  SELECT CASE WHEN h % 19 = 0 THEN replace(array_to_string(p, '_'), '.', '_')
              WHEN h % 17 = 0 THEN array_to_string(list_append(p[1:len(p) - 1], bt || '.' || bt), '_')
              ELSE array_to_string(p, '_') END AS rel_id,
         CASE WHEN h % 13 = 0 THEN bt ELSE tp END AS ultimate_parent_id,
         CASE WHEN h % 13 = 0 THEN tp ELSE bt END AS ultimate_child_id
  FROM rel_p
)"""


def rel_ids(spark, d, starts=None, ends=None):
    n = lambda c: F.concat(F.lit("N"), c.cast("string"))
    r = path_rel_ids(B.edges(spark, d), "child_id", "parent_id", n, starts, ends).withColumn(
        "h", (F.col("top") * 100003 + F.col("second") * 101 + F.col("bottom")) % 1000)
    head = F.left("rel_id", F.length("rel_id") - F.length(F.substring_index("rel_id", "_", -1)))
    broken = F.concat(head, "bottom_id", F.lit("."), "bottom_id")
    swapped = F.col("h") % 13 == 0
    return r.select(F.when(F.col("h") % 19 == 0, F.replace("rel_id", F.lit("."), F.lit("_")))
                     .when(F.col("h") % 17 == 0, broken).otherwise(F.col("rel_id")).alias("rel_id"),
                    F.when(swapped, F.col("bottom_id")).otherwise(F.col("top_id")).alias("ultimate_parent_id"),
                    F.when(swapped, F.col("top_id")).otherwise(F.col("bottom_id")).alias("ultimate_child_id"))


@query("d24_path_endpoints_valid", f"""
WITH RECURSIVE {B.EDGES_CTE}, {REL_CTE}
SELECT rel_id, ultimate_parent_id, ultimate_child_id,
       COALESCE(trim(split_part(rel_id, '.', 1)) = trim(ultimate_parent_id)
                AND trim(string_split(rel_id, '.')[-1]) = trim(ultimate_child_id), false) AS endpoints_valid
FROM rel_ids""")
def d24_path_endpoints_valid(spark, d):
    r = rel_ids(spark, d)
    return r.withColumn("endpoints_valid", BS.path_endpoints_valid(F.col("rel_id"), F.col("ultimate_parent_id"),
                                                                    F.col("ultimate_child_id")))


@query("d25_path_pattern_valid", f"""
WITH RECURSIVE {B.EDGES_CTE}, {REL_CTE},
p AS (SELECT rel_id, string_split(rel_id, '.') AS parts FROM rel_ids)
SELECT rel_id, CASE WHEN rel_id IS NULL THEN false WHEN len(parts) < 2 THEN false WHEN len(parts) = 2 THEN true
  ELSE list_bool_and(list_transform(parts[2:len(parts) - 1], lambda x:
         length(x) % 2 = 1 AND substring(x, (length(x) - 1) // 2 + 1, 1) = '_'
         AND left(x, (length(x) - 1) // 2) = right(x, (length(x) - 1) // 2)))
  END AS pattern_valid
FROM p""")
def d25_path_pattern_valid(spark, d):
    r = rel_ids(spark, d)
    return r.select("rel_id", BS.path_pattern_valid(F.col("rel_id")).alias("pattern_valid"))


@query("d27_duplicate_grain", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def d27_duplicate_grain(spark, d):
    return BS.duplicate_grain(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])
