"""Reconciliation of two systems."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import full_outer


def column_message(left: Column, right: Column, left_name: str, right_name: str) -> Column:
    """Per-column comparison message for a matched pair of rows."""
    return (F.when(left.isNull() & right.isNull(), F.lit("Both values NULL"))
             .when(left.isNull(), F.lit(f"Missing in {left_name}"))
             .when(right.isNull(), F.lit(f"Missing in {right_name}"))
             .when(left.cast("string") == right.cast("string"), F.lit("Matched"))
             .otherwise(F.lit("Differs")))


def key_message(left: Column, right: Column, l_name: str, r_name: str, left_name: str, right_name: str) -> Column:
    """Message of one primary column pair: which side lacks the value, or that it matched."""
    l, r = left.cast("string"), right.cast("string")
    return (F.when(l.isNull() & r.isNull(), F.lit("Both values NULL"))
             .when(l.isNull(), F.concat(F.lit(f"{right_name} {r_name} '"), r, F.lit(f"' is no {l_name} in {left_name}")))
             .when(r.isNull(), F.concat(F.lit(f"{left_name} {l_name} '"), l, F.lit(f"' is no {r_name} in {right_name}")))
             .when(l == r, F.concat(F.lit("Matched '"), r, F.lit("'")))
             .otherwise(F.concat(F.lit(f"{left_name} {l_name} '"), l, F.lit(f"' differs from {right_name} {r_name} '"), r, F.lit("'"))))


def reconcile(data: DataFrame, master: DataFrame, primary: dict[str, str], secondary: dict[str, str],
              how: str = "full", left_name: str = "data", right_name: str = "master", join_message: bool = False,
              sources: dict[str, tuple[str, str]] | None = None, checked_at: str | None = None) -> DataFrame:
    """Join ``data`` to ``master`` on the primary column map, prefix both sides,
    flag ``match_found`` (every primary column of both sides is known) and add one message per secondary column
    pair (only for matched rows) plus the mapping text.

    ``join_message`` adds the messages of all primary pairs in one column. ``sources`` = {side name: (input method,
    source)} adds ``<side>_input_method`` and ``<side>_source``, ``checked_at`` a ``checked_at`` column. A full
    reconciliation is split on hot keys, and rows with a NULL key are not shuffled."""
    lp, rp = f"{left_name}_", f"{right_name}_"
    d = data.select(*[F.col(c).alias(lp + c) for c in data.columns])
    m = master.select(*[F.col(c).alias(rp + c) for c in master.columns])
    if how == "full":
        j = full_outer(d, m, [(lp + l, rp + r) for l, r in primary.items()])
    else:
        j = d.join(m, [F.col(lp + l) == F.col(rp + r) for l, r in primary.items()], how)
    match = reduce(lambda a, b: a & b, [F.col(lp + l).isNotNull() & F.col(rp + r).isNotNull() for l, r in primary.items()])
    msgs = {f"msg_{l}": F.when(match, column_message(F.col(lp + l), F.col(rp + r), left_name, right_name))
            for l, r in secondary.items()}
    mapping = ", ".join(f"{l}={r}" for l, r in {**primary, **secondary}.items())
    out = j.withColumn("match_found", match).withColumns(msgs).withColumn("mapping", F.lit(mapping))
    if join_message:
        out = out.withColumn("join_message", F.concat_ws("; ", *[key_message(F.col(lp + l), F.col(rp + r), l, r, left_name, right_name)
                                                                 for l, r in primary.items()]))
    for side, (method, source) in (sources or {}).items():
        out = out.withColumns({f"{side}_input_method": F.lit(method), f"{side}_source": F.lit(source)})
    return out if checked_at is None else out.withColumn("checked_at", F.lit(checked_at))


def reconcile_summary(rec: DataFrame, primary: dict[str, str], secondary: Sequence[str],
                      left_name: str = "data", right_name: str = "master") -> DataFrame:
    """One conditional aggregate over the reconciliation (the reference runs four
    separate counts): totals, matches, rows missing on either side, and per secondary
    column the number of differing matched rows."""
    lk, rk = next(iter(primary.items()))
    lp, rp = F.col(f"{left_name}_{lk}"), F.col(f"{right_name}_{rk}")
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    aggs = [F.count(F.lit(1)).alias("total_rows"), cnt(F.col("match_found")).alias("matches"),
            cnt(lp.isNotNull() & rp.isNull()).alias(f"missing_in_{right_name}"),
            cnt(lp.isNull() & rp.isNotNull()).alias(f"missing_in_{left_name}")]
    aggs += [cnt(F.col(f"msg_{c}") == "Differs").alias(f"differs_{c}") for c in secondary]
    return rec.agg(*aggs)


def similarity(a: Column, b: Column) -> Column:
    """1 - levenshtein / greater length on lower-trimmed strings; both NULL -> 1,
    one NULL -> 0, both blank -> 1."""
    la, lb = F.lower(F.trim(a)), F.lower(F.trim(b))
    return (F.when(a.isNull() & b.isNull(), F.lit(1.0))
             .when(a.isNull() | b.isNull(), F.lit(0.0))
             .when((F.length(F.trim(a)) == 0) & (F.length(F.trim(b)) == 0), F.lit(1.0))
             .otherwise(F.lit(1.0) - F.levenshtein(la, lb).cast("double")
                        / F.greatest(F.length(F.trim(a)), F.length(F.trim(b)))))


def entity_reconcile(a: DataFrame, b: DataFrame, a_name: str = "A", b_name: str = "B") -> DataFrame:
    """Full outer join of two entity lists (id, name, number) on id (rows without id stay alone): status,
    exact name match, name similarity and exact number match."""
    x = a.select(F.col("id").alias("a_id"), F.col("name").alias("a_name"), F.col("number").alias("a_number"))
    y = b.select(F.col("id").alias("b_id"), F.col("name").alias("b_name"), F.col("number").alias("b_number"))
    j = full_outer(x, y, [("a_id", "b_id")])
    status = (F.when(F.col("a_id").isNotNull() & F.col("b_id").isNotNull(), F.lit("Matched on ID"))
               .when(F.col("a_id").isNull(), F.lit(f"Only in {b_name} (Missing in {a_name})"))
               .otherwise(F.lit(f"Only in {a_name} (Missing in {b_name})")))
    return j.select(
        F.coalesce("a_id", "b_id").alias("reconciled_id"), "b_id", status.alias("id_match_status"),
        "a_name", "b_name",
        F.coalesce(F.lower(F.trim("a_name")) == F.lower(F.trim("b_name")), F.lit(False)).alias("is_name_exact_match"),
        F.round(similarity(F.col("a_name"), F.col("b_name")), 6).alias("name_similarity_score"),
        "a_number", "b_number",
        F.coalesce(F.trim("a_number") == F.trim("b_number"), F.lit(False)).alias("is_number_exact_match"))


def entity_reconcile_summary(rec: DataFrame, minor: float = 0.85) -> DataFrame:
    """C4: per status: count, % of all rows (1 dp, broadcast one-row total), exact name
    matches, minor (similarity >= ``minor``) and major mismatches, number matches."""
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    g = rec.groupBy(F.col("id_match_status").alias("reconciliation_status")).agg(
        F.count(F.lit(1)).alias("total"),
        cnt(F.col("is_name_exact_match")).alias("exact_name_matches"),
        cnt(~F.col("is_name_exact_match") & (F.col("name_similarity_score") >= minor)).alias("minor_mismatches"),
        cnt(~F.col("is_name_exact_match") & (F.col("name_similarity_score") < minor)).alias("major_mismatches"),
        cnt(F.col("is_number_exact_match")).alias("exact_number_matches"),
        cnt(~F.col("is_number_exact_match")).alias("number_mismatches"))
    tot = g.agg(F.sum("total").alias("_all"))
    return (g.crossJoin(F.broadcast(tot))
             .withColumn("percentage_of_total", F.round(F.col("total") * 100.0 / F.col("_all"), 1)).drop("_all"))


def presence(a_edges: DataFrame, b_edges: DataFrame, parent: str, child: str) -> DataFrame:
    """C5/C6 base: every entity appearing as parent or child in either system with a
    presence flag per system (stacked roles, one aggregate)."""
    def roles(e: DataFrame, side: str) -> DataFrame:
        return e.select(F.explode(F.array(F.col(parent), F.col(child))).alias("entity_id")).where(
            F.col("entity_id").isNotNull()).withColumn("side", F.lit(side))
    s = roles(a_edges, "a").unionByName(roles(b_edges, "b"))
    return s.groupBy("entity_id").agg(F.max(F.when(F.col("side") == "a", True).otherwise(False)).alias("in_a"),
                                      F.max(F.when(F.col("side") == "b", True).otherwise(False)).alias("in_b"))


def presence_summary(p: DataFrame) -> DataFrame:
    """Totals of entities in both / only A / only B."""
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return p.agg(F.count(F.lit(1)).alias("total_entities"), cnt(F.col("in_a") & F.col("in_b")).alias("in_both"),
                 cnt(F.col("in_a") & ~F.col("in_b")).alias("only_in_a"), cnt(~F.col("in_a") & F.col("in_b")).alias("only_in_b"))


def presence_exceptions(p: DataFrame) -> DataFrame:
    """Entities missing from one of the systems."""
    return p.where(~(F.col("in_a") & F.col("in_b"))).withColumn(
        "exception", F.when(F.col("in_a"), F.lit("Missing in B")).otherwise(F.lit("Missing in A")))


def restrict_paths(paths: DataFrame, roots: DataFrame, leaves: DataFrame, top: str, bottom: str,
                   root_col: str, leaf_col: str) -> DataFrame:
    """Paths from a root to a leaf (semi joins), de-duplicated (the reference's
    UNION ALL of leaves can repeat a path)."""
    r = paths.join(roots.select(F.col(root_col).alias("__r")).distinct(), F.col(top) == F.col("__r"), "left_semi")
    return r.join(leaves.select(F.col(leaf_col).alias("__l")).distinct(), F.col(bottom) == F.col("__l"),
                  "left_semi").distinct()
