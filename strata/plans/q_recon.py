"""Registered reconciliation queries.

System A = customers; system B = the same customers with every 11th missing, every
13th renamed slightly (' Ltd'), every 19th renamed entirely, every 17th with a new
registration number, and every 23rd duplicated under a new id (only in B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import recon as R
from strata.plans import bindings as B
from strata.plans.q_dq import REL_CTE, rel_ids
from strata.plans.q_temporal import t14_compare_histories
from strata.plans.registry import QUERIES, query
from strata.sources.tables import Tables


def system_a(spark, d):
    c = Tables(spark, d).customer
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.concat(F.lit("NO-"), F.col("c_nationkey").cast("string"), F.lit("-"),
                             F.col("c_custkey").cast("string")).alias("number"))


def system_b(spark, d):
    c = Tables(spark, d).customer
    k = F.col("c_custkey")
    base = c.where(k % 11 != 0).select(
        k.alias("id"),
        F.when(k % 19 == 0, F.concat(F.lit("Renamed "), k.cast("string")))
         .when(k % 13 == 0, F.concat(F.col("c_name"), F.lit(" Ltd"))).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 17 == 0, F.concat(F.lit("NO-X-"), k.cast("string")))
         .otherwise(F.concat(F.lit("NO-"), F.col("c_nationkey").cast("string"), F.lit("-"), k.cast("string"))).alias("number"))
    extra = c.where(k % 23 == 0).select((k + 100000).alias("id"), F.col("c_name").alias("name"),
                                        F.lit(None).cast("string").alias("number"))
    return base.unionByName(extra)


SYS_CTE = """
sys_a AS (SELECT c_custkey AS id, c_name AS name, concat('NO-', c_nationkey, '-', c_custkey) AS number FROM customer),
sys_b AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 19 = 0 THEN concat('Renamed ', c_custkey)
              WHEN c_custkey % 13 = 0 THEN c_name || ' Ltd' ELSE c_name END AS name,
         CASE WHEN c_custkey % 17 = 0 THEN concat('NO-X-', c_custkey)
              ELSE concat('NO-', c_nationkey, '-', c_custkey) END AS number
  FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL
  SELECT c_custkey + 100000, c_name, NULL FROM customer WHERE c_custkey % 23 = 0
)"""

PRIMARY = {"id": "id"}
SECONDARY = {"name": "name", "number": "number"}


def _msg_sql(l: str, r: str) -> str:
    return (f"CASE WHEN NOT match_found THEN NULL WHEN {l} IS NULL AND {r} IS NULL THEN 'Both values NULL' "
            f"WHEN {l} IS NULL THEN 'Missing in data' WHEN {r} IS NULL THEN 'Missing in master' "
            f"WHEN CAST({l} AS VARCHAR) = CAST({r} AS VARCHAR) THEN 'Matched' ELSE 'Differs' END")


C1_CTE = f"""{SYS_CTE},
rec0 AS (
  SELECT d.id AS data_id, d.name AS data_name, d.number AS data_number,
         m.id AS master_id, m.name AS master_name, m.number AS master_number,
         (d.id IS NOT NULL AND m.id IS NOT NULL) AS match_found
  FROM sys_b d FULL JOIN sys_a m ON d.id = m.id
),
rec AS (
  SELECT *, {_msg_sql('data_name', 'master_name')} AS msg_name,
         {_msg_sql('data_number', 'master_number')} AS msg_number, 'id=id, name=name, number=number' AS mapping
  FROM rec0
)"""


def _rec(spark, d):
    return R.reconcile(system_b(spark, d), system_a(spark, d), PRIMARY, SECONDARY, how="full")


@query("c1_reconcile", f"WITH {C1_CTE} SELECT * FROM rec")
def c1_reconcile(spark, d):
    return _rec(spark, d)


def _said(l, r, lcol, rcol):
    return f"""CASE WHEN {lcol} IS NULL AND {rcol} IS NULL THEN 'Both values NULL'
         WHEN {lcol} IS NULL THEN concat('CDM {r} ', chr(39), {rcol}, chr(39), ' is no {l} in data')
         WHEN {rcol} IS NULL THEN concat('data {l} ', chr(39), {lcol}, chr(39), ' is no {r} in CDM')
         WHEN CAST({lcol} AS VARCHAR) = CAST({rcol} AS VARCHAR) THEN concat('Matched ', chr(39), {rcol}, chr(39))
         ELSE concat('data {l} ', chr(39), {lcol}, chr(39), ' differs from CDM {r} ', chr(39), {rcol}, chr(39)) END"""


@query("c1_reconcile_sources", f"""
WITH {SYS_CTE},
d AS (SELECT CASE WHEN id % 29 <> 0 THEN id END AS id, name, number FROM sys_b),
j AS (SELECT d.id AS data_id, d.name AS data_name, d.number AS data_number, m.id AS CDM_id, m.name AS CDM_name, m.number AS CDM_number,
             d.id IS NOT NULL AND m.id IS NOT NULL AND d.name IS NOT NULL AND m.name IS NOT NULL AS match_found
      FROM d FULL JOIN sys_a m ON d.id = m.id AND d.name = m.name)
SELECT *, CASE WHEN NOT match_found THEN NULL WHEN data_number IS NULL AND CDM_number IS NULL THEN 'Both values NULL'
               WHEN data_number IS NULL THEN 'Missing in data' WHEN CDM_number IS NULL THEN 'Missing in CDM'
               WHEN data_number = CDM_number THEN 'Matched' ELSE 'Differs' END AS msg_number,
       'id=id, name=name, number=number' AS mapping,
       concat({_said('id', 'id', 'data_id', 'CDM_id')}, '; ', {_said('name', 'name', 'data_name', 'CDM_name')}) AS join_message,
       'table' AS data_input_method, 'sys_b' AS data_source, 'sql_query' AS CDM_input_method, 'sys_a.sql' AS CDM_source,
       '2024-06-01 00:00:00' AS checked_at
FROM j""")
def c1_reconcile_sources(spark, d):
    """Two primary keys, some of them NULL, with messages and where each side comes from."""
    b = system_b(spark, d).withColumn("id", F.when(F.col("id") % 29 != 0, F.col("id")))
    return R.reconcile(b, system_a(spark, d), {"id": "id", "name": "name"}, {"number": "number"}, right_name="CDM", join_message=True,
                       sources={"data": ("table", "sys_b"), "CDM": ("sql_query", "sys_a.sql")}, checked_at="2024-06-01 00:00:00")


@query("c2_reconcile_summary", f"""
WITH {C1_CTE}
SELECT count(*) AS total_rows, CAST(SUM(CASE WHEN match_found THEN 1 ELSE 0 END) AS BIGINT) AS matches,
  CAST(SUM(CASE WHEN data_id IS NOT NULL AND master_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_in_master,
  CAST(SUM(CASE WHEN data_id IS NULL AND master_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_in_data,
  CAST(SUM(CASE WHEN msg_name = 'Differs' THEN 1 ELSE 0 END) AS BIGINT) AS differs_name,
  CAST(SUM(CASE WHEN msg_number = 'Differs' THEN 1 ELSE 0 END) AS BIGINT) AS differs_number
FROM rec""")
def c2_reconcile_summary(spark, d):
    return R.reconcile_summary(_rec(spark, d), PRIMARY, list(SECONDARY))


C3_CTE = f"""{SYS_CTE},
er AS (
  SELECT COALESCE(a.id, b.id) AS reconciled_id, b.id AS b_id,
    CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL THEN 'Matched on ID'
         WHEN a.id IS NULL THEN 'Only in B (Missing in A)' ELSE 'Only in A (Missing in B)' END AS id_match_status,
    a.name AS a_name, b.name AS b_name,
    COALESCE(lower(trim(a.name)) = lower(trim(b.name)), false) AS is_name_exact_match,
    ROUND(CASE WHEN a.name IS NULL AND b.name IS NULL THEN 1.0
               WHEN a.name IS NULL OR b.name IS NULL THEN 0.0
               WHEN length(trim(a.name)) = 0 AND length(trim(b.name)) = 0 THEN 1.0
               ELSE 1.0 - CAST(levenshtein(lower(trim(a.name)), lower(trim(b.name))) AS DOUBLE)
                          / greatest(length(trim(a.name)), length(trim(b.name))) END, 6) AS name_similarity_score,
    a.number AS a_number, b.number AS b_number,
    COALESCE(trim(a.number) = trim(b.number), false) AS is_number_exact_match
  FROM sys_a a FULL JOIN sys_b b ON a.id = b.id
)"""


def _er(spark, d):
    return R.entity_reconcile(system_a(spark, d), system_b(spark, d))


@query("c3_entity_reconcile", f"WITH {C3_CTE} SELECT * FROM er")
def c3_entity_reconcile(spark, d):
    return _er(spark, d)


@query("c4_entity_reconcile_summary", f"""
WITH {C3_CTE}
SELECT id_match_status AS reconciliation_status, count(*) AS total,
  CAST(SUM(CASE WHEN is_name_exact_match THEN 1 ELSE 0 END) AS BIGINT) AS exact_name_matches,
  CAST(SUM(CASE WHEN NOT is_name_exact_match AND name_similarity_score >= 0.85 THEN 1 ELSE 0 END) AS BIGINT) AS minor_mismatches,
  CAST(SUM(CASE WHEN NOT is_name_exact_match AND name_similarity_score < 0.85 THEN 1 ELSE 0 END) AS BIGINT) AS major_mismatches,
  CAST(SUM(CASE WHEN is_number_exact_match THEN 1 ELSE 0 END) AS BIGINT) AS exact_number_matches,
  CAST(SUM(CASE WHEN NOT is_number_exact_match THEN 1 ELSE 0 END) AS BIGINT) AS number_mismatches,
  ROUND(count(*) * 100.0 / SUM(count(*)) OVER (), 1) AS percentage_of_total
FROM er GROUP BY id_match_status""")
def c4_entity_reconcile_summary(spark, d):
    return R.entity_reconcile_summary(_er(spark, d))


def _edges_b(spark, d):
    e = B.edges(spark, d)
    return e.where(F.col("event_id") % 11 != 0).withColumn(
        "parent_id", F.when(F.col("child_id") % 97 == 0, F.col("parent_id") + 50000).otherwise(F.col("parent_id")))


PRESENCE_CTE = f"""{B.EDGES_CTE},
eb AS (SELECT child_id, CASE WHEN child_id % 97 = 0 THEN parent_id + 50000 ELSE parent_id END AS parent_id
       FROM edges WHERE event_id % 11 <> 0),
st AS (
  SELECT parent_id AS entity_id, 'a' AS side FROM edges UNION ALL SELECT child_id, 'a' FROM edges
  UNION ALL SELECT parent_id, 'b' FROM eb UNION ALL SELECT child_id, 'b' FROM eb
),
pr AS (SELECT entity_id, bool_or(side = 'a') AS in_a, bool_or(side = 'b') AS in_b FROM st
       WHERE entity_id IS NOT NULL GROUP BY entity_id)"""


def _presence(spark, d):
    return R.presence(B.edges(spark, d), _edges_b(spark, d), "parent_id", "child_id")


@query("c5_presence_summary", f"""
WITH {PRESENCE_CTE}
SELECT count(*) AS total_entities, CAST(SUM(CASE WHEN in_a AND in_b THEN 1 ELSE 0 END) AS BIGINT) AS in_both,
  CAST(SUM(CASE WHEN in_a AND NOT in_b THEN 1 ELSE 0 END) AS BIGINT) AS only_in_a,
  CAST(SUM(CASE WHEN NOT in_a AND in_b THEN 1 ELSE 0 END) AS BIGINT) AS only_in_b
FROM pr""")
def c5_presence_summary(spark, d):
    return R.presence_summary(_presence(spark, d))


@query("c6_presence_exceptions", f"""
WITH {PRESENCE_CTE}
SELECT entity_id, in_a, in_b, CASE WHEN in_a THEN 'Missing in B' ELSE 'Missing in A' END AS exception
FROM pr WHERE NOT (in_a AND in_b)""")
def c6_presence_exceptions(spark, d):
    return R.presence_exceptions(_presence(spark, d))


# C7 is the history comparison of T14 (same operator, registered under its recon id).
query("c7_history_reconcile", QUERIES["t14_compare_histories"].sql)(t14_compare_histories)


@query("c9_restrict_paths", f"""
WITH RECURSIVE {B.EDGES_CTE}, {REL_CTE},
roots AS (SELECT c_custkey AS parent_id FROM customer WHERE c_mktsegment = 'BUILDING'),
leaves AS (SELECT DISTINCT child_id FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges x WHERE x.parent_id = e.child_id))
SELECT DISTINCT * FROM rel_ids
WHERE ultimate_parent_id IN (SELECT concat('N', parent_id) FROM roots)
  AND ultimate_child_id IN (SELECT concat('N', child_id) FROM leaves)""")
def c9_restrict_paths(spark, d):
    e = B.edges(spark, d)
    c = Tables(spark, d).customer
    tops = c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    parents = e.select(F.col("parent_id").alias("child_id")).distinct()
    bottoms = e.select("child_id").distinct().join(parents, "child_id", "left_anti")
    name = lambda x, out: F.concat(F.lit("N"), F.col(x).cast("string")).alias(out)
    roots, leaves = tops.select(name("c_custkey", "r")), bottoms.select(name("child_id", "l"))
    # only walks from a leaf to a root are taken: a path with swapped ends has a parent as its child, and no parent is a leaf
    return R.restrict_paths(rel_ids(spark, d, bottoms, tops), roots, leaves, "ultimate_parent_id", "ultimate_child_id", "r", "l")
