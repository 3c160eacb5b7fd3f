"""Ordered windows over hot keys, split by time: a two-level prefix scan.

A running window keeps a key in one task. Here rows are scanned inside (key, bucket), where ``bucket``
is a coarse value that grows with the order (a truncated time); every bucket's state (sum, last value, least
value) is one row, the states before a bucket are combined over these few rows, and the result is joined back on
(key, bucket). A key with a third of all rows spreads over as many tasks as it has buckets.

Order columns are names, ascending with NULLs first (Spark's default, and that of the structs that pick
a bucket's last row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"


def time_bucket(col: str, unit: str) -> Column:
    """The usual bucket of a time column: its start of ``unit`` ('year', 'month', 'day', 'hour')."""
    return F.date_trunc(unit, F.col(col).cast("timestamp"))


def _joined(rows: DataFrame, states: DataFrame, keys: Sequence[str]) -> DataFrame:
    same = [F.col(f"_r.{k}").eqNullSafe(F.col(f"_s.{k}")) for k in [*keys, BUCKET]]
    own = [c for c in states.columns if c not in (*keys, BUCKET)]
    return (rows.alias("_r").join(states.alias("_s"), same, "left")
            .select(*[F.col(f"_r.`{c}`") for c in rows.columns], *[F.col(f"_s.`{c}`") for c in own]))


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, sums: dict[str, Column] | None = None,
         lasts: dict[str, Column] | None = None, current: bool = True) -> DataFrame:
    """``df`` with running sums and last non-NULL values over ``keys`` in ``order``, the row itself included
    unless ``current`` is False. Equals the windows ROWS UNBOUNDED PRECEDING .. CURRENT ROW (or 1 PRECEDING)."""
    sums, lasts = sums or {}, lasts or {}
    keys = list(keys)
    inputs = {**{f"__s_{o}": c for o, c in sums.items()}, **{f"__l_{o}": c for o, c in lasts.items()}}
    rows = df.withColumns({BUCKET: bucket, **inputs})
    place = F.struct(*[F.col(c) for c in order])
    states = rows.groupBy(*keys, BUCKET).agg(
        *[F.sum(f"__s_{o}").alias(f"__s_{o}") for o in sums],
        *[F.max_by(F.col(f"__l_{o}"), F.when(F.col(f"__l_{o}").isNotNull(), place)).alias(f"__l_{o}") for o in lasts])
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = states.select(*keys, BUCKET, *[F.sum(f"__s_{o}").over(before).alias(f"__cs_{o}") for o in sums],
                          *[F.last(f"__l_{o}", ignorenulls=True).over(before).alias(f"__cl_{o}") for o in lasts])
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    part = rows.withColumns({**{f"__s_{o}": F.sum(f"__s_{o}").over(inside) for o in sums},
                             **{f"__l_{o}": F.last(f"__l_{o}", ignorenulls=True).over(inside) for o in lasts}})
    whole = _joined(part, carry, keys)
    out = {}
    for o in sums:  # NULL only while nothing has been added
        a, b = F.col(f"__s_{o}"), F.col(f"__cs_{o}")
        out[o] = F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    for o in lasts:
        out[o] = F.coalesce(f"__l_{o}", f"__cl_{o}")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    return whole.select(*kept, *[c.alias(o) for o, c in out.items()])


def following(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, col: str, out: str) -> DataFrame:
    """``df`` with ``out``: the value of ``col`` in the key's next row (``lead``), across buckets."""
    keys = list(keys)
    rows = df.withColumn(BUCKET, bucket)
    place = F.struct(*[F.col(c) for c in order])
    firsts = rows.groupBy(*keys, BUCKET).agg(F.min_by(F.struct(F.col(col)), place).alias("__first"))
    after = Window.partitionBy(*keys).orderBy(BUCKET)
    carry = firsts.select(*keys, BUCKET, F.lead("__first").over(after).alias("__next"))
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    part = rows.withColumn("__in", F.lead(F.struct(F.col(col))).over(inside))
    whole = _joined(part, carry, keys)
    nxt = F.coalesce("__in", "__next")[col]
    return whole.select(*[F.col(f"`{c}`") for c in df.columns if c != out], nxt.alias(out))
