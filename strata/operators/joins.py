"""Join operators.

Broadcast policy: only one-row aggregates are broadcast by hint. Dimension joins carry
none: AQE turns them into broadcasts from measured sizes and keeps the shuffle join
(with skew splitting) beyond its threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], null_safe: bool = False) -> DataFrame:
    """All columns of both sides (names must differ), rows as in a full outer join on ``on`` (left, right) pairs.

    A full outer join is never split by AQE, so one hot key or the NULL keys end in one task. Here it is a left join,
    whose left side AQE does split, and the right rows that meet none (an anti join, which it splits too). Unless
    ``null_safe``, rows with a NULL key meet nothing and go round the shuffle."""
    pairs = [(F.col(f"_l.`{a}`"), F.col(f"_r.`{b}`")) for a, b in on]
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    whole = lambda cols: reduce(lambda x, y: x & y, [F.col(f"`{c}`").isNotNull() for c in cols])
    l_keys, r_keys = [a for a, _ in on], [b for _, b in on]
    l_in, r_in = (left, right) if null_safe else (left.where(whole(l_keys)), right.where(whole(r_keys)))
    met = l_in.alias("_l").join(r_in.alias("_r"), same, "left").select(
        *[F.col(f"_l.`{c}`") for c in left.columns], *[F.col(f"_r.`{c}`") for c in right.columns])
    known = l_in.select(*[F.col(f"`{a}`") for a in dict.fromkeys(l_keys)]).distinct()
    rest = [r_in.alias("_r").join(known.alias("_l"), same, "left_anti")]
    if not null_safe:
        rest += [left.where(~whole(l_keys)), right.where(~whole(r_keys))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rest, met)


def join_inner(left: DataFrame, right: DataFrame, keys: Sequence[str] | Column) -> DataFrame:
    """J1"""
    return left.join(right, keys if isinstance(keys, Column) else list(keys), "inner")


def enrich(df: DataFrame, dims: Sequence[tuple[DataFrame, Column | Sequence[str]]]) -> DataFrame:
    """Chain of left joins adding dimension attributes."""
    out = df
    for dim, on in dims:
        out = out.join(dim, on if isinstance(on, Column) else list(on), "left")
    return out


def full_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join; the keys, and other columns that both sides have (dimensions), come out coalesced, the left
    side's value first."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in right.columns})
    j = full_outer(left, renamed, [(k, f"__r_{k}") for k in keys])
    both = set(left.columns) & set(right.columns)
    return j.select(*[F.coalesce(F.col(f"`{c}`"), F.col(f"`__r_{c}`")).alias(c) if c in both else F.col(f"`{c}`") for c in left.columns],
                    *[F.col(f"`__r_{c}`").alias(c) for c in right.columns if c not in both])


def keep_in(df: DataFrame, ids: DataFrame, key: str, id_col: str | None = None) -> DataFrame:
    """Left semi join to an id list."""
    id_col = id_col or key
    return df.join(ids.select(F.col(id_col).alias("__id")).distinct(), F.col(key) == F.col("__id"), "left_semi")


def not_in(ref: DataFrame, df: DataFrame, keymap: dict[str, str]) -> DataFrame:
    """Reference rows with no match in ``df`` (left anti, ``keymap`` ref->df)."""
    d = df.select(*[F.col(v).alias(f"__k{i}") for i, v in enumerate(keymap.values())]).distinct()
    cond = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keymap)]
    return ref.join(d, cond, "left_anti")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join with ``<=>`` on every key (NULL matches NULL); keys from the left."""
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    rcols = [c for c in right.columns if c not in keys]
    return left.alias("_l").join(right.alias("_r"), cond, how).select(
        *[F.col(f"_l.{c}") for c in left.columns], *[F.col(f"_r.{c}") for c in rcols])


def broadcast_dim(df: DataFrame, dim: DataFrame, on: Column | Sequence[str], how: str = "inner") -> DataFrame:
    """Join to a dimension. No hint: AQE broadcasts it when its measured size allows."""
    return df.join(dim, on if isinstance(on, Column) else list(on), how)


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a one-row frame on every row. A frame of several rows raises when
    the result is computed; an empty one gives no rows. The frame is reduced to one row first,
    so what is broadcast is bounded."""
    cols = one_row.columns
    single = (one_row.agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*cols)).alias("__r"))
              .where(F.when(F.col("__n") > 1, F.raise_error(F.lit("attach_scalar: more than one row")).cast("boolean"))
                     .otherwise(F.col("__n") == 1)))
    return df.crossJoin(F.broadcast(single.select(*[F.col(f"__r.`{c}`").alias(c) for c in cols])))


def bucket_to_period(txn: DataFrame, periods: DataFrame, ts: str, period_end: str,
                     keys: Sequence[str] = (), unmatched: str = "Unbucketed", unit: str = "month") -> DataFrame:
    """Each transaction to the period with ``prev_end < ts <= period_end``; the
    first period is open on the left; transactions after the last period keep a NULL
    period and ``bucket_status = unmatched``.

    An equi-join: every period is filed under the calendar ``unit``s it touches, a
    transaction looks under its own, and the exact bounds are the residual. The open first
    period starts at the earliest transaction (a one-row minimum), so it is filed like any other."""
    from pyspark.sql import Window
    first_txn = txn.agg(F.min(ts).alias("__lo"))
    w = Window.partitionBy(*keys).orderBy(period_end)
    p = periods.select(*keys, period_end).distinct()
    p = (p.withColumn("__prev", F.lag(period_end).over(w)) if keys
         else p.join(_previous(p, period_end), period_end, "left"))
    start, end = F.col("__a").cast("timestamp"), F.col(period_end).cast("timestamp")
    p = (p.crossJoin(F.broadcast(first_txn)).withColumn("__a", F.coalesce("__prev", "__lo"))
          .where(F.col(period_end) >= F.col("__a"))
          .withColumn("__u", F.explode(F.sequence(F.date_trunc(unit, start), F.date_trunc(unit, end), F.expr(f"interval 1 {unit}"))))
          .select(*keys, period_end, "__prev", "__u"))
    t = txn.withColumn("__u", F.date_trunc(unit, F.col(ts).cast("timestamp")))
    cond = [F.col(f"_t.{k}") == F.col(f"_p.{k}") for k in keys] + [
        F.col("_t.__u") == F.col("_p.__u"), F.col(f"_t.{ts}") <= F.col(f"_p.{period_end}"),
        F.col("_p.__prev").isNull() | (F.col(f"_t.{ts}") > F.col("_p.__prev"))]
    j = t.alias("_t").join(p.alias("_p"), cond, "left")
    return j.select(*[F.col(f"_t.{c}") for c in txn.columns], F.col(f"_p.{period_end}").alias(period_end),
                    F.when(F.col(f"_p.{period_end}").isNull(), F.lit(unmatched)).otherwise(F.lit("Bucketed"))
                     .alias("bucket_status"))


def _previous(periods: DataFrame, period_end: str) -> DataFrame:
    """(period end, end of the period before) over a list of distinct reporting dates."""
    from pyspark.sql import Window
    return periods.select(period_end, F.lag(period_end).over(Window.orderBy(period_end)).alias("__prev"))


def pair_periods(df: DataFrame, keys: Sequence[str], period: str, prev: DataFrame,
                 measures: Sequence[str]) -> DataFrame:
    """Each (keys, period) row next to its previous period's measures, via the
    (period -> previous period) map ``prev`` and one equi join (instead of
    ``ON x IN (a, b)``)."""
    cur = df.join(prev, period, "left")
    old = df.select(*keys, F.col(period).alias("__pp"), *[F.col(m).alias(f"prev_{m}") for m in measures])
    j = cur.alias("_c").join(old.alias("_o"), [F.col(f"_c.{k}") == F.col(f"_o.{k}") for k in keys]
                             + [F.col("_c.prev_period") == F.col("_o.__pp")], "left")
    return j.select("_c.*", *[F.col(f"_o.prev_{m}") for m in measures])


def mapped_join(left: DataFrame, right: DataFrame, mapping: dict[str, str], how: str = "left",
                prefix: str = "") -> DataFrame:
    """Config-driven join from a ``{left col: right col}`` map; right columns
    optionally prefixed."""
    r = right.select(*[F.col(c).alias(f"{prefix}{c}") for c in right.columns])
    cond = [F.col(l) == F.col(f"{prefix}{rc}") for l, rc in mapping.items()]
    return left.join(r, cond, how)


def trim_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, how: str = "inner") -> DataFrame:
    """Equi join on TRIM-normalised keys."""
    return left.join(right, F.trim(left[lkey]) == F.trim(right[rkey]), how)


def key_date_grid(df: DataFrame, key: str, member: str, date: str) -> DataFrame:
    """Per key, every member x every date seen for that key - an equi join of
    the two distinct projections (size = sum over keys of members x dates)."""
    m = df.select(key, member).distinct()
    d = df.select(key, date).distinct()
    return m.join(d, key, "inner")


def join_coalesced(left: DataFrame, right: DataFrame, lexpr: Column, rexpr: Column, how: str = "inner") -> DataFrame:
    """Equi join on expressions (e.g. a key coalesced after a full outer join)."""
    return left.join(right, lexpr == rexpr, how)
