"""Registered temporal-algebra queries (T1-T10, T14, T15) over the ownership-edge and line-item bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import temporal as T
from strata.operators.graph import simple_paths
from strata.plans import bindings as B
from strata.plans.registry import query
from strata.session import materialise
from strata.sources.tables import Tables

FAR = "TIMESTAMP '9999-12-31 23:59:59'"

STD_CTE = f"""{B.EDGES_CTE},
edges_std AS (
  SELECT child_id, parent_id, CAST(active_from AS TIMESTAMP) AS active_from,
         COALESCE(CAST(active_to AS TIMESTAMP), {FAR}) AS active_to, percentage, event_id
  FROM edges
)"""


def _std(spark, d):
    return T.standardize_intervals(B.edges(spark, d), "active_from", "active_to")


@query("t1_standardize_intervals", f"""
WITH {STD_CTE} SELECT child_id, parent_id, active_from, active_to, percentage FROM edges_std""")
def t1_standardize_intervals(spark, d):
    return _std(spark, d).select("child_id", "parent_id", "active_from", "active_to", "percentage")


SEG_SQL = """
{src}_b AS (
  SELECT DISTINCT {k}, x AS boundary FROM (
    SELECT {k}, {s} AS x FROM {src} UNION ALL SELECT {k}, {e} AS x FROM {src})
  WHERE x IS NOT NULL
),
{src}_s AS (
  SELECT {k}, boundary AS seg_start,
         lead(boundary) OVER (PARTITION BY {k} ORDER BY boundary) AS seg_end
  FROM {src}_b
),
{src}_segs AS (SELECT * FROM {src}_s WHERE seg_end IS NOT NULL AND seg_end > seg_start)"""


def seg_sql(src: str, keys: str, s: str, e: str) -> str:
    return SEG_SQL.format(src=src, k=keys, s=s, e=e)


@query("t2_segments_from_columns", f"""
WITH {B.EDGES_CTE}, {seg_sql('edges', 'child_id', 'active_from', 'active_to')}
SELECT child_id, seg_start, seg_end FROM edges_segs""")
def t2_segments_from_columns(spark, d):
    return T.segments_from_columns(B.edges(spark, d), ["child_id"], ["active_from", "active_to"])


T3_CTES = f"""{B.EDGES_CTE},
anchor AS (SELECT DISTINCT child_id, parent_id FROM edges),
src_edge AS (
  SELECT child_id, parent_id, CAST(active_from AS TIMESTAMP) AS boundary, 'edge_from' AS source FROM edges
  UNION ALL
  SELECT child_id, parent_id, CAST(active_to AS TIMESTAMP), 'edge_to' FROM edges
),
src_settle AS (
  SELECT o_custkey AS child_id, CAST(CAST(o_orderdate AS DATE) + 15 AS TIMESTAMP) AS boundary,
         'settle_from' AS source FROM orders
  UNION ALL
  SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) + 45 AS TIMESTAMP), 'settle_to' FROM orders
),
combined AS (
  SELECT a.child_id, a.parent_id, s.boundary, s.source
  FROM anchor a JOIN src_edge s
    ON a.child_id IS NOT DISTINCT FROM s.child_id AND a.parent_id IS NOT DISTINCT FROM s.parent_id
  WHERE s.boundary IS NOT NULL
  UNION ALL
  SELECT a.child_id, a.parent_id, s.boundary, s.source
  FROM anchor a JOIN src_settle s ON a.child_id IS NOT DISTINCT FROM s.child_id
  WHERE s.boundary IS NOT NULL
),
{seg_sql('combined', 'child_id, parent_id', 'boundary', 'boundary')}"""


def _t3(spark, d):
    e = B.edges(spark, d)
    o = Tables(spark, d).orders
    settle = o.select(F.col("o_custkey").alias("child_id"),
                      F.date_add(F.col("o_orderdate").cast("date"), 15).alias("settle_from"),
                      F.date_add(F.col("o_orderdate").cast("date"), 45).alias("settle_to"))
    anchor = e.select("child_id", "parent_id")
    return T.segments_from_sources(anchor, ["child_id", "parent_id"], [
        (e, "active_from", "active_to", "edge"),
        (settle, "settle_from", "settle_to", "settle"),
    ])


@query("t3_segments_from_sources", f"""
WITH {T3_CTES} SELECT child_id, parent_id, seg_start, seg_end FROM combined_segs""")
def t3_segments_from_sources(spark, d):
    return _t3(spark, d)[1]


@query("t3_provenance", f"""
WITH {T3_CTES}
SELECT child_id, parent_id, boundary,
       string_agg(DISTINCT source, ',' ORDER BY source) AS opened_by_sources
FROM combined GROUP BY child_id, parent_id, boundary""")
def t3_provenance(spark, d):
    prov = _t3(spark, d)[0]
    return prov.withColumn("opened_by_sources", F.array_join("opened_by_sources", ","))


T4_CTES = f"""{STD_CTE}, {seg_sql('edges_std', 'child_id', 'active_from', 'active_to')},
t4 AS (
  SELECT s.child_id, s.seg_start, s.seg_end, e.parent_id, e.percentage
  FROM edges_std_segs s JOIN edges_std e
    ON s.child_id = e.child_id AND s.seg_start >= e.active_from AND s.seg_end <= e.active_to
)"""


def _t4(spark, d):
    std = _std(spark, d)
    segs = T.segments_from_columns(std, ["child_id"], ["active_from", "active_to"])
    win = std.select("child_id", "parent_id", "percentage",
                     F.col("active_from").alias("win_start"), F.col("active_to").alias("win_end"))
    cov = T.cover_join(segs, win, ["child_id"], bucket="year")
    return cov.select("child_id", "seg_start", "seg_end", "parent_id", "percentage")


@query("t4_state_for_segments", f"WITH {T4_CTES} SELECT * FROM t4")
def t4_state_for_segments(spark, d):
    return _t4(spark, d)


@query("t5_coalesce_segments", f"""
WITH {T4_CTES},
x AS (SELECT child_id, parent_id, seg_start, seg_end, CAST(floor(percentage * 10) AS BIGINT) AS band FROM t4),
f AS (
  SELECT *, CASE WHEN lag(seg_end) OVER w IS NULL OR lag(seg_end) OVER w <> seg_start
                      OR NOT (band IS NOT DISTINCT FROM lag(band) OVER w) THEN 1 ELSE 0 END AS nf
  FROM x WINDOW w AS (PARTITION BY child_id, parent_id ORDER BY seg_start)
),
g AS (
  SELECT *, SUM(nf) OVER (PARTITION BY child_id, parent_id ORDER BY seg_start
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
  FROM f
)
SELECT child_id, parent_id, MIN(seg_start) AS seg_start, MAX(seg_end) AS seg_end, MAX(band) AS band
FROM g GROUP BY child_id, parent_id, grp""")
def t5_coalesce_segments(spark, d):
    x = _t4(spark, d).withColumn("band", F.floor(F.col("percentage") * 10).cast("bigint")).drop("percentage")
    return T.coalesce_segments(x, ["child_id", "parent_id"], ["band"], "seg_start", "seg_end")


@query("t6_intervals_from_events", f"WITH {B.EDGES_CTE} SELECT * FROM edges")
def t6_intervals_from_events(spark, d):
    return B.edges(spark, d)


@query("t7_trim_intervals", f"""
WITH {B.EDGES_CTE}
SELECT * REPLACE (greatest(active_from, DATE '1996-01-01') AS active_from) FROM edges
WHERE active_to IS NULL OR active_to > greatest(active_from, DATE '1996-01-01')""")
def t7_trim_intervals(spark, d):
    return T.trim_intervals(B.edges(spark, d), "active_from", "active_to", F.lit("1996-01-01").cast("date"))


# -- T8: chains of every length (rel id "A.B_B.C_C.D", bottom first), segments where all edges are valid ------
# Chains start at the companies that hold assets (the least customer that ordered a part) and end at fund
# companies (customers of the BUILDING segment).
CHAINS_CTE = """
pairs AS (SELECT DISTINCT child_id, parent_id FROM edges WHERE child_id <> parent_id),
walk AS (
  SELECT child_id AS bottom, parent_id AS top, [child_id, parent_id] AS chain FROM pairs {start}
  UNION ALL
  SELECT w.bottom, p.parent_id, list_append(w.chain, p.parent_id) FROM walk w JOIN pairs p ON w.top = p.child_id
  WHERE NOT list_contains(w.chain, p.parent_id)
),
chains AS (
  SELECT bottom, top, chain, array_to_string(list_transform(range(1, len(chain)), lambda i: chain[i] || '.' || chain[i + 1]), '_') AS path_id
  FROM walk {end}
),
path_edges AS (SELECT path_id, unnest(list_transform(range(1, len(chain)), lambda i: chain[i] || '.' || chain[i + 1])) AS pair_rel_id FROM chains)"""


def chains_cte(start: str = "", end: str = "") -> str:
    """Recursive CTEs (WITH RECURSIVE) ending in ``chains`` and ``path_edges``; ``edges`` comes before."""
    return CHAINS_CTE.format(start=start, end=end)


COMPANY_SQL = "SELECT l_partkey AS asset_id, MIN(o_custkey) AS company_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"
FUND_COMPANIES = "c_mktsegment = 'BUILDING'"
ASSET_CHAINS_CTE = chains_cte(f"WHERE child_id IN (SELECT company_id FROM ({COMPANY_SQL}))",
                              f"WHERE top IN (SELECT c_custkey FROM customer WHERE {FUND_COMPANIES})")

PATHS_CTE = f"""{STD_CTE},{ASSET_CHAINS_CTE},
ei AS (
  SELECT concat(child_id, '.', parent_id) AS pair_rel_id, active_from AS ws, active_to AS we, percentage
  FROM edges_std
),
iv AS (SELECT p.path_id, e.pair_rel_id, e.ws, e.we, e.percentage FROM path_edges p JOIN ei e USING (pair_rel_id)),
{seg_sql('iv', 'path_id', 'ws', 'we')},
cov AS (
  SELECT s.path_id, s.seg_start, s.seg_end, iv.pair_rel_id, iv.percentage
  FROM iv_segs s JOIN iv ON s.path_id = iv.path_id AND s.seg_start >= iv.ws AND s.seg_end <= iv.we
),
n_edges AS (SELECT path_id, count(*) AS n FROM path_edges GROUP BY 1),
rel AS (SELECT c.path_id, seg_start AS s, seg_end AS e, CAST(count(*) AS BIGINT) AS n_edges, ROUND(product(percentage), 6) AS ownership
        FROM cov c JOIN n_edges n USING (path_id) GROUP BY c.path_id, seg_start, seg_end, n HAVING count(DISTINCT pair_rel_id) = n)"""


def asset_companies(spark, d):
    """(asset_id, company_id): asset = part, its company = the least customer that ordered it."""
    t = Tables(spark, d)
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("l_partkey").alias("asset_id")).agg(F.min("o_custkey").alias("company_id")))


def chains(spark, d, starts=None, ends=None):
    """(path_id, chain, bottom, top) of every simple chain child -> ... -> ancestor, of every length."""
    c = simple_paths(B.edges(spark, d), "child_id", "parent_id", starts, ends)
    return c.select(pair_path(F.col("chain")).alias("path_id"), "chain", "bottom", "top")


def pair_ids(chain):
    """[a, b, c] -> ['a.b', 'b.c']."""
    return F.transform(F.sequence(F.lit(1), F.size(chain) - 1), lambda i: F.concat(
        F.element_at(chain, i).cast("string"), F.lit("."), F.element_at(chain, i + 1).cast("string")))


def pair_path(chain):
    return F.array_join(pair_ids(chain), "_")


def asset_chains(spark, d):
    """Chains from the companies of assets up to fund companies, written once."""
    funds = Tables(spark, d).customer.where(FUND_COMPANIES).select("c_custkey")
    return materialise(chains(spark, d, asset_companies(spark, d).select("company_id"), funds), "asset-chains")


def path_edges(paths):
    """(path_id, pair_rel_id) rows of chains."""
    return paths.select("path_id", F.explode(pair_ids(F.col("chain"))).alias("pair_rel_id"))


def edge_intervals_by_rel(spark, d):
    std = _std(spark, d)
    return std.select(F.concat(F.col("child_id").cast("string"), F.lit("."),
                               F.col("parent_id").cast("string")).alias("pair_rel_id"),
                      "active_from", "active_to", "percentage")


def covered(spark, d, paths):
    """T8 segments of paths, one row per path, written once: ``segments`` holds (seg_start, seg_end, n_edges, ownership), the product of the
    percentages of the edges that cover the segment, unknown ones left out."""
    cov = T.all_covered_segments(path_edges(paths), "path_id", "pair_rel_id", edge_intervals_by_rel(spark, d), "pair_rel_id",
                                 "active_from", "active_to", segments="segments", product="percentage")
    owned = F.transform("segments", lambda x: F.struct(x["seg_start"].alias("seg_start"), x["seg_end"].alias("seg_end"), x["n_edges"].alias("n_edges"),
                                                       F.round(x["product"], 6).alias("ownership")))
    return materialise(cov.select("path_id", owned.alias("segments")), "covered-segments").where(F.size("segments") > 0)


@query("t8_all_covered_segments", f"""
WITH RECURSIVE {PATHS_CTE}
SELECT path_id, s AS seg_start, e AS seg_end, n_edges, ownership FROM rel""")
def t8_all_covered_segments(spark, d):
    return covered(spark, d, asset_chains(spark, d)).select("path_id", F.inline("segments"))


@query("t9_as_of_join", f"""
WITH {B.EDGES_CTE}
SELECT o.o_orderkey, o.o_custkey AS child_id, CAST(o.o_orderdate AS DATE) AS order_date,
       e.parent_id, e.percentage
FROM orders o LEFT JOIN edges e
  ON e.child_id = o.o_custkey AND e.active_from <= CAST(o.o_orderdate AS DATE)
 AND (e.active_to IS NULL OR CAST(o.o_orderdate AS DATE) < e.active_to)""")
def t9_as_of_join(spark, d):
    pts = Tables(spark, d).orders.select("o_orderkey", F.col("o_custkey").alias("child_id"),
                                         F.col("o_orderdate").cast("date").alias("order_date"))
    j = T.as_of_join(pts, B.edges(spark, d), ["child_id"], "order_date", "active_from", "active_to", series=["parent_id"], bucket="year")
    return j.select("o_orderkey", "child_id", "order_date", "parent_id", "percentage")


@query("t14_compare_histories", f"""
WITH {B.EDGES_CTE},
A AS (SELECT child_id, parent_id, CAST(active_from AS TIMESTAMP) AS s,
             COALESCE(CAST(active_to AS TIMESTAMP), {FAR}) AS e, percentage AS value_a FROM edges),
Bv AS (SELECT child_id, parent_id, CAST(active_from AS TIMESTAMP) AS s,
              COALESCE(CAST(active_to AS TIMESTAMP), {FAR}) AS e,
              CASE WHEN event_id % 13 = 0 THEN percentage + 0.01 ELSE percentage END AS value_b
       FROM edges WHERE event_id % 11 <> 0),
ab AS (SELECT child_id, parent_id, s, e FROM A UNION ALL SELECT child_id, parent_id, s, e FROM Bv),
{seg_sql('ab', 'child_id, parent_id', 's', 'e')},
j AS (
  SELECT g.child_id, g.parent_id, g.seg_start, g.seg_end, A.value_a, Bv.value_b
  FROM ab_segs g
  LEFT JOIN A ON A.child_id = g.child_id AND A.parent_id = g.parent_id AND A.s <= g.seg_start AND g.seg_start < A.e
  LEFT JOIN Bv ON Bv.child_id = g.child_id AND Bv.parent_id = g.parent_id AND Bv.s <= g.seg_start AND g.seg_start < Bv.e
)
SELECT *, ROUND(value_a - value_b, 6) AS variance,
  CASE WHEN value_a IS NULL THEN 'Missing in A' WHEN value_b IS NULL THEN 'Missing in B'
       WHEN ROUND(value_a, 4) = ROUND(value_b, 4) THEN 'Match' ELSE 'Mismatch' END AS status
FROM j WHERE value_a IS NOT NULL OR value_b IS NOT NULL""")
def t14_compare_histories(spark, d):
    e = B.edges(spark, d)
    cap = lambda df: (df.withColumn("active_from", F.col("active_from").cast("timestamp"))
                        .withColumn("active_to", F.coalesce(F.col("active_to").cast("timestamp"), T.far_future())))
    a = cap(e)
    b = cap(e.where(F.col("event_id") % 11 != 0).withColumn(
        "percentage", F.when(F.col("event_id") % 13 == 0, F.col("percentage") + F.lit(0.01))
                       .otherwise(F.col("percentage"))))
    return T.compare_histories(a, b, ["child_id", "parent_id"], "percentage", "active_from", "active_to", bucket="year")


@query("t15_allocation_violations", f"""
WITH {T4_CTES}
SELECT child_id, seg_start, seg_end, ROUND(SUM(percentage), 6) AS total_value, CAST(count(*) AS BIGINT) AS n_rows
FROM t4 GROUP BY child_id, seg_start, seg_end HAVING SUM(percentage) > 1.0 + 1e-6""")
def t15_allocation_violations(spark, d):
    v = T.allocation_violations(B.edges(spark, d), ["child_id"], "percentage", "active_from", "active_to", bucket="year")
    return v.withColumn("total_value", F.round("total_value", 6))


@query("t10_priority_phase_intervals", """
WITH ev AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, l_linestatus,
         CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS prio
  FROM lineitem
),
best AS (SELECT * FROM ev QUALIFY prio = min(prio) OVER (PARTITION BY l_orderkey, l_linenumber)),
grp AS (SELECT *, CASE WHEN d <= DATE '1999-01-01' THEN NULL ELSE d END AS gd,
               CASE WHEN d <= DATE '1999-01-01' THEN NULL ELSE prio END AS gp FROM best),
g AS (SELECT l_orderkey, l_linestatus, gd, gp, MIN(d) AS start,
             string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS ms
      FROM grp GROUP BY l_orderkey, l_linestatus, gd, gp)
SELECT l_orderkey, l_linestatus, start, ms AS milestones,
       lead(start) OVER (PARTITION BY l_orderkey ORDER BY start, l_linestatus, gp NULLS FIRST) AS "end"
FROM g""")
def t10_priority_phase_intervals(spark, d):
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("d"), "l_linestatus",
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3).alias("prio"))
    r = T.priority_phase_intervals(li, "l_orderkey", "l_linenumber", "d", "l_linestatus", "prio",
                                   F.lit("1999-01-01").cast("date"))
    return r.select("l_orderkey", "l_linestatus", "start",
                    F.array_join(F.sort_array(F.col("milestones").cast("array<string>")), ",").alias("milestones"),
                    "end")
