"""Table mutation as DataFrame -> DataFrame functions.

Parquet snapshots are immutable, so every mutation returns the *next* snapshot
(``merged = f(target, source)``) and a sink writes it to a fresh folder
(:mod:`strata.sources.sinks`). Merges lay the target's rows beside the source's on the null-safe keys by a
left join and an anti join, which AQE splits for a hot key (a full outer join it would not); scoped deletes test the batch's distinct periods with a
left join (AQE broadcasts that side when its measured size is small), never a
driver-collected IN list.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import full_outer


def align_schema(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pad the source with NULLs for target columns it lacks and add new source
    columns (with their own types) to the target as NULL. Returns both aligned, with
    the target's column order followed by new columns."""
    ttypes, stypes = dict(target.dtypes), dict(source.dtypes)
    cols = list(target.columns) + [c for c in source.columns if c not in ttypes]
    typ = {**stypes, **ttypes}
    pad = lambda df, have: df.select(*[F.col(c) if c in have else F.lit(None).cast(typ[c]).alias(c)
                                       for c in cols])
    return pad(target, ttypes), pad(source, stypes)


def assert_one_row_per_key(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two source rows share their (null-safe) merge keys."""
    twice = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).first()
    if twice is not None:
        raise ValueError(f"merge source has {twice['n']} rows for key {[twice[k] for k in keys]}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], delete: str | None = None,
                 period_col: str | None = None, delete_filter: str | Column | None = None,
                 include_period_in_keys: bool = True, scope: DataFrame | None = None) -> DataFrame:
    """Upsert ``source`` into ``target`` on null-safe ``keys``.

    * matched rows take the source values (an update when any non-key column differs
      null-safely; identical otherwise);
    * unmatched source rows are inserted; unmatched target rows are kept, except
    * ``delete='scoped'``: unmatched target rows whose ``period_col`` is among the
      batch's periods (or ``scope`` rows) are deleted, optionally narrowed by
      ``delete_filter``; the period joins the keys unless ``include_period_in_keys``
      is False;
    * ``delete='full'``: unmatched target rows matching ``delete_filter`` (all when
      None) are deleted; a row whose filter is NULL is kept, as in SQL DELETE.

    A source with two rows of one key is an error: it raises before anything is merged.
    """
    keys = list(keys)
    if delete == "scoped":
        if not period_col:
            raise ValueError("period_col is required when delete='scoped'")
        if include_period_in_keys and period_col not in keys:
            keys.append(period_col)
    assert_one_row_per_key(source, keys)
    t, s = align_schema(target, source)
    cols = t.columns
    s = s.select(*[F.col(f"`{c}`").alias(f"__s_{c}") for c in cols], F.lit(True).alias("__s"))
    j = full_outer(t.withColumn("__t", F.lit(True)), s, [(k, f"__s_{k}") for k in keys], null_safe=True)
    matched_src = F.col("__s").isNotNull()
    out = j.select(*[F.when(matched_src, F.col(f"`__s_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in cols],
                   F.col("__t").isNotNull().alias("__in_t"), matched_src.alias("__in_s"))
    if delete is None:
        return out.drop("__in_t", "__in_s")
    deletable = F.col("__in_t") & ~F.col("__in_s")
    if delete_filter is not None:
        matches = F.expr(delete_filter) if isinstance(delete_filter, str) else delete_filter
        deletable = deletable & F.coalesce(matches, F.lit(False))
    if delete == "scoped":
        periods = (scope if scope is not None else source).select(F.col(period_col).alias("__p")).distinct()
        periods = periods.withColumn("__in_scope", F.lit(True))
        out = out.join(periods, out[period_col].eqNullSafe(periods["__p"]), "left").drop("__p")
        deletable = deletable & F.col("__in_scope").isNotNull()
    elif delete != "full":
        raise ValueError(f"unknown delete mode {delete!r}")
    return out.where(~deletable).select(*cols)


def incremental_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """Append source rows newer than ``max(target.ts)`` (all rows when the target
    is empty), de-duplicated, whose (keys, ts) are not yet in the target (plain
    equality, as the reference). Never updates. The watermark is a one-row aggregate."""
    wm = target.agg(F.max(ts_col).alias("__wm"))
    fresh = (source.crossJoin(F.broadcast(wm))
                   .where(F.col("__wm").isNull() | (F.col(ts_col) > F.col("__wm")))
                   .drop("__wm").distinct())
    on = list(keys) + [ts_col]
    new = fresh.alias("_s").join(target.select(*on).alias("_t"),
                                 [F.col(f"_s.{k}") == F.col(f"_t.{k}") for k in on], "left_anti")
    return target.unionByName(new.select(*target.columns))


def replace_load(df: DataFrame) -> DataFrame:
    """The table recreated from the query: ``SELECT DISTINCT *``."""
    return df.distinct()


def insert_by_date(target: DataFrame, source: DataFrame, keys: Sequence[str], date_col: str, d,
                   mode: str = "single_day") -> DataFrame:
    """Insert source rows of day ``d`` (``single_day``) or from ``d`` on
    (``multi_day``) whose keys are absent from the target."""
    lit = F.lit(d) if not isinstance(d, Column) else d
    pick = F.col(date_col) == lit if mode == "single_day" else F.col(date_col) >= lit
    new = source.where(pick).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def insert_missing(target: DataFrame, source: DataFrame, id_col: str) -> DataFrame:
    """Full copy of the source rows whose id is absent from the target."""
    new = source.join(target.select(id_col).distinct(), id_col, "left_anti")
    return target.unionByName(new.select(*target.columns))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, columns missing from a source become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_hash(df: DataFrame, exclude: Sequence[str] = (), out: str = "row_hash", bits: int = 256,
             null_token: str | None = None) -> DataFrame:
    """SHA-2 of all non-excluded columns as strings joined by ``||``.

    Faithful default: NULLs are skipped, so (a, NULL, b) and (a, b, NULL) collide;
    ``null_token`` substitutes a marker instead."""
    cols = [c for c in df.columns if c not in set(exclude) and c != out]
    parts = [F.col(c).cast("string") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return df.withColumn(out, F.sha2(F.concat_ws("||", *parts), bits))


def scd2_hash_merge(target: DataFrame, source: DataFrame, now, hash_col: str = "row_hash",
                    start: str = "START_AT", end: str = "END_AT") -> DataFrame:
    """Hash-keyed SCD2. Current target rows (``end`` NULL) whose hash is absent
    from the source are closed at ``now``; source rows whose hash is not current are
    opened at ``now``; history rows pass through."""
    n = F.lit(now) if not isinstance(now, Column) else now
    hist = target.where(F.col(end).isNotNull())
    cur = target.where(F.col(end).isNull())
    src_h = source.select(hash_col).distinct().withColumn("__in_src", F.lit(True))
    cur2 = cur.join(src_h, hash_col, "left")
    closed = cur2.withColumn(end, F.when(F.col("__in_src").isNull(), n.cast(target.schema[end].dataType))
                             .otherwise(F.col(end))).drop("__in_src")
    new = (source.join(cur.select(hash_col), hash_col, "left_anti")
                 .withColumn(start, n.cast(target.schema[start].dataType))
                 .withColumn(end, F.lit(None).cast(target.schema[end].dataType)))
    return hist.unionByName(closed.select(*target.columns)).unionByName(new.select(*target.columns))

