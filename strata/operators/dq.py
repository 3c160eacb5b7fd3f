"""Row-level data-quality flags, quarantine split and summaries.

Flags are 0/1 integer columns named ``DQ_hard_*`` / ``DQ_soft_*`` added in one
projection. Reference checks join to the *distinct* reference keys; the join strategy
is left to AQE, which broadcasts the reference side only when its measured runtime
size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Flag column prefixes of the reference data model.
DQ_HARD = "DQ_hard_"
DQ_SOFT = "DQ_soft_"


def flag_nulls(df: DataFrame, cols: Sequence[str], exempt: Sequence[str] = ()) -> DataFrame:
    """``DQ_hard_null_<c>`` = 1 when ``c`` is NULL, for cols minus exempt."""
    keep = [c for c in dict.fromkeys(cols) if c not in set(exempt)]
    new = {f"{DQ_HARD}null_{c}" for c in keep}
    return df.select(*[c for c in df.columns if c not in new],
                     *[F.when(F.col(c).isNull(), 1).otherwise(0).alias(f"{DQ_HARD}null_{c}") for c in keep])


def flag_missing_ref(df: DataFrame, ref: DataFrame, keymap: dict[str, str], name: str,
                     hard: bool = True) -> DataFrame:
    """``DQ_{hard|soft}_<name>`` = 1 when the row's keys have no match among the
    distinct reference keys (``keymap`` = {df column: ref column})."""
    rk = ref.select(*[F.col(r).alias(f"__ref_{i}") for i, r in enumerate(keymap.values())]).distinct()
    rk = rk.withColumn("__ref_hit", F.lit(1))
    cond = [F.col(f"_d.{l}") == F.col(f"_r.__ref_{i}") for i, l in enumerate(keymap)]
    flag = f"{DQ_HARD if hard else DQ_SOFT}{name}"
    j = df.alias("_d").join(rk.alias("_r"), cond, "left")
    return j.select(*[F.col(f"_d.{c}") for c in df.columns],
                    F.when(F.col("_r.__ref_hit").isNull(), 1).otherwise(0).alias(flag))


def flag_rules(df: DataFrame, rules: dict[str, str], hard: bool = True) -> DataFrame:
    """D3: ``DQ_hard_<rule>`` = 1 when the SQL predicate is TRUE (NULL -> 0)."""
    prefix = DQ_HARD if hard else DQ_SOFT
    new = {f"{prefix}{n}" for n in rules}
    return df.select(*[c for c in df.columns if c not in new],
                     *[F.expr(f"CASE WHEN {sql} THEN 1 ELSE 0 END").alias(f"{prefix}{n}") for n, sql in rules.items()])


def duplicate_counts(df: DataFrame, individual: Sequence[str] = (),
                     composite: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Per key set, keys occurring more than once: (check_name, key_value, dup_count).
    Check names: ``ind__<col>`` and ``cmp__<a>_<b>``. Each key set is one partial
    aggregate; the sets are unioned."""
    sets = [([c], f"ind__{c}") for c in individual] + [(list(s), "cmp__" + "_".join(s)) for s in composite]
    parts = []
    for keys, label in sets:
        parts.append(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
                       .where(F.col("dup_count") > 1)
                       .select(F.lit(label).alias("check_name"),
                               F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key_value"),
                               "dup_count"))
    return reduce(DataFrame.unionByName, parts)


def assert_unique(df: DataFrame, individual: Sequence[str] = (), composite: Sequence[Sequence[str]] = ()) -> None:
    """D4/D27 gate: raise when any key set has a duplicate (an emptiness probe, no collect)."""
    dups = duplicate_counts(df, individual, composite)
    if not dups.isEmpty():
        raise ValueError(f"uniqueness violated: {dups.limit(5).collect()}")


def quarantine_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row verdicts = greatest of the hard / soft flags. Quarantine = any hard or soft
    failure; clean = no hard failure (soft failures are in both, as in the reference),
    with every ``DQ_`` column dropped."""
    hard = [c for c in df.columns if c.startswith(DQ_HARD)]
    soft = [c for c in df.columns if c.startswith(DQ_SOFT)]
    verdict = lambda cols: (F.greatest(*map(F.col, cols)) if len(cols) > 1
                            else F.col(cols[0]) if cols else F.lit(0))
    flagged = df.withColumns({f"{DQ_HARD}quarantine": verdict(hard), f"{DQ_SOFT}quarantine": verdict(soft)})
    quarantine = flagged.where((F.col(f"{DQ_HARD}quarantine") == 1) | (F.col(f"{DQ_SOFT}quarantine") == 1))
    clean = flagged.where(F.col(f"{DQ_HARD}quarantine") == 0)
    clean = clean.drop(*[c for c in clean.columns if c.startswith("DQ_")])
    return quarantine, clean


def missing_reference(df: DataFrame, ref: DataFrame, keymap: dict[str, str], name: str) -> DataFrame:
    """D6 detail: reference keys absent from the data, one row each
    (check name, column names, ``' | '``-joined value)."""
    rk = ref.select(*keymap.values()).distinct()
    dk = df.select(*[F.col(l).alias(r) for l, r in keymap.items()]).distinct()
    missing = rk.join(dk, list(keymap.values()), "left_anti")
    return missing.select(F.lit(name).alias("validation_check_name"),
                          F.lit(" | ".join(keymap.values())).alias("column_names"),
                          F.concat_ws(" | ", *[F.col(r).cast("string") for r in keymap.values()]).alias("missing_value"))


def missing_reference_summary(detail: DataFrame) -> DataFrame:
    """D6 summary: count of missing reference keys per check. The reference also glues
    every missing value into one string; that is an unbounded single-row collect, so
    the values stay in the distributed detail table instead."""
    return detail.groupBy("validation_check_name", "column_names").agg(F.count(F.lit(1)).alias("count"))


def quarantine_summary(q: DataFrame, ts: str, table: str, window: str = "120 minutes") -> DataFrame:
    """D7 (W4 batch twin): per tumbling window of ``ts``: rows, hard, soft failures."""
    return (q.groupBy(F.window(F.col(ts), window).alias("w"))
             .agg(F.count(F.lit(1)).alias("row_count"),
                  F.sum(F.col(f"{DQ_HARD}quarantine")).alias("hard_count"),
                  F.sum(F.col(f"{DQ_SOFT}quarantine")).alias("soft_count"))
             .select(F.lit(table).alias("table_name"), F.col("w.start").alias("window_start"),
                     "row_count", "hard_count", "soft_count"))


def quarantine_log(q: DataFrame, table: str, ts: str) -> DataFrame:
    """D8 (W6 batch twin): heterogeneous failing rows as (source_table, ts, json row)."""
    payload = [c for c in q.columns if c != ts]
    return q.select(F.lit(table).alias("source_table"), F.col(ts).alias("ingestion_ts"),
                    F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("raw_data"))
