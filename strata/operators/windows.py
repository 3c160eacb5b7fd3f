"""Window-function operators.

Scale notes
-----------
* ``keep_latest`` avoids a per-key sort: when every ordering column has the same
  direction it is a ``max``/``min`` of a struct, which Spark computes with a partial
  (map-side) aggregate, so a key holding a third of the table is reduced inside each
  input partition before the shuffle. Ties are broken by the remaining columns, so the
  pick is deterministic (``row_number`` is not).
* ``running_total`` and ``fill_forward`` take a ``bucket``: the window is then a two-level
  prefix scan (:mod:`strata.operators.prefix`), so that a hot key is split over its buckets.
* Totals ``OVER ()`` (N12) are a one-row aggregate joined back by broadcast, never
  an unpartitioned window (which funnels the whole table through one task).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators import prefix


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                descending: bool = True) -> DataFrame:
    """One row per ``keys`` - the row with the greatest (``descending``) or least
    ``order`` tuple; remaining columns break ties (NULL sorts lowest)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest]).alias("_pick")
    agg = F.max(packed) if descending else F.min(packed)
    return (df.groupBy(*keys).agg(agg.alias("_pick"))
              .select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in list(order) + rest])
              .select(*df.columns))


def rank_rows(df: DataFrame, partition: Sequence[str] | None, order: dict[str, str],
              name: str = "rank") -> DataFrame:
    """``row_number`` over ``{col: 'asc'|'desc'}`` (the reference calls it rank)."""
    ords = [F.col(c).desc() if d.lower() == "desc" else F.col(c).asc() for c, d in order.items()]
    w = Window.partitionBy(*(partition or [])).orderBy(*ords)
    return df.withColumn(name, F.row_number().over(w))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence, measures: dict[str, str],
                  bucket: Column | None = None) -> DataFrame:
    """Cumulative sums ``{out: measure}`` ROWS UNBOUNDED PRECEDING..CURRENT ROW. With ``bucket`` (a
    value that grows with ``order``, plain names then) a key is scanned bucket by bucket."""
    if bucket is not None:
        return prefix.scan(df, keys, order, bucket, sums={out: F.col(m) for out, m in measures.items()})
    w = (Window.partitionBy(*keys).orderBy(*_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({out: F.sum(m).over(w) for out, m in measures.items()})


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str],
                 flag: str | None = None, blank_is_missing: bool = True, bucket: Column | None = None) -> DataFrame:
    """Carry the last non-missing value forward for every column in ``cols``
    in one projection. For strings ``''`` counts as missing too. ``flag`` (N5) names a
    boolean column that is true when any value on the row was filled. With ``bucket`` (a value
    that grows with ``order``, plain names then) a key is scanned bucket by bucket."""
    w = (Window.partitionBy(*keys).orderBy(*_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    types = dict(df.dtypes)
    missing = {}
    for c in cols:
        m = F.col(c).isNull()
        if blank_is_missing and types[c] == "string":
            m = m | (F.col(c) == "")
        missing[c] = m
    if bucket is not None:
        known = {f"__f_{c}": F.when(~missing[c], F.col(c)) for c in cols}
        out = prefix.scan(df, keys, order, bucket, lasts=known)
        if flag:
            out = out.withColumn(flag, reduce(lambda a, b: a | b, [missing[c] & F.col(f"__f_{c}").isNotNull() for c in cols]))
        return out.select(*[F.col(f"__f_{c}").alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns],
                          *([flag] if flag else []))
    filled = {c: F.last(F.when(~missing[c], F.col(c)), ignorenulls=True).over(w) for c in cols}
    out = df
    if flag:
        any_filled = F.lit(False)
        for c in cols:
            any_filled = any_filled | (missing[c] & filled[c].isNotNull())
        out = out.withColumn(flag, any_filled)
    return out.withColumns(filled)


def period_delta(df: DataFrame, keys: Sequence[str], order: Sequence, measures: dict[str, str],
                 default=None) -> DataFrame:
    """``{out: measure}`` with ``out = measure - lag(measure)``; first period gives
    ``default`` (NULL in the view flavour, 0 in the analyst flavour)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    exprs = {}
    for out, m in measures.items():
        prev = F.lag(m).over(w)
        if default is not None:
            prev = F.coalesce(prev, F.lit(default))
        exprs[out] = F.col(m) - prev
    return df.withColumns(exprs)


def close_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str = "end",
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """``end = lead(start)`` per key (open end stays NULL)."""
    w = Window.partitionBy(*keys).orderBy(F.col(start), *_cols(tiebreak))
    return df.withColumn(end, F.lead(start).over(w))


def rolling_variance(df: DataFrame, keys: Sequence[str], order_col: str, cols: Sequence[str],
                     lookback: int, threshold: float | None = None) -> DataFrame:
    """For each value column the mean of the next ``lookback`` rows by ``order_col``
    (ordered descending by date this is the previous periods), the % difference
    ``(x - avg) / avg * 100`` (NULL when avg is 0/NULL), the greatest absolute %
    difference and the column holding it; ``threshold`` adds a working
    ``high_variance`` flag."""
    w = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(1, lookback)
    avgs = {f"{c}_rolling_avg": F.avg(c).over(w) for c in cols}
    out = df.withColumns(avgs)
    pct = {f"{c}_pct_diff": F.try_divide(F.col(c) - F.col(f"{c}_rolling_avg"),
                                         F.col(f"{c}_rolling_avg")) * F.lit(100.0) for c in cols}
    out = out.withColumns(pct)
    absd = [F.abs(F.col(f"{c}_pct_diff")) for c in cols]
    greatest = F.greatest(*absd) if len(absd) > 1 else absd[0]
    out = out.withColumn("max_abs_pct_diff", greatest)
    which = F.lit(None).cast("string")
    for c in reversed(cols):
        which = F.when(F.abs(F.col(f"{c}_pct_diff")) == F.col("max_abs_pct_diff"), F.lit(c)).otherwise(which)
    out = out.withColumn("max_diff_column", which)
    if threshold is not None:
        out = out.withColumn("high_variance", F.coalesce(F.col("max_abs_pct_diff") > threshold, F.lit(False)))
    return out


def keep_min_priority(df: DataFrame, keys: Sequence[str], prio: str) -> DataFrame:
    """Rows carrying the best (minimum) priority of their partition (ties kept).

    Computed as aggregate + join rather than ``min() OVER`` so the minimum is found
    with a partial aggregate even when one key dominates."""
    best = df.groupBy(*keys).agg(F.min(prio).alias("_best"))
    cond = [F.col(f"_d.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in keys]
    return (df.alias("_d").join(best.alias("_b"), cond, "inner")
              .where(F.col(f"_d.{prio}") == F.col("_b._best"))
              .select(*[F.col(f"_d.{c}") for c in df.columns]))


def grand_total(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Attach ``{out: sum(measure)}`` over the whole frame via a broadcast one-row
    aggregate (never an unpartitioned window)."""
    tot = df.agg(*[F.sum(m).alias(out) for out, m in measures.items()])
    return df.crossJoin(F.broadcast(tot))


def previous_period(dates: DataFrame, date_col: str, out: str = "prev_date") -> DataFrame:
    """Previous distinct date. The window is global but only ever runs over the
    distinct reporting dates (a handful per year), never over fact rows."""
    d = dates.select(date_col).distinct()
    return d.withColumn(out, F.lag(date_col).over(Window.orderBy(date_col)))
