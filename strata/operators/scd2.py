"""SCD2 "apply changes" over a change feed (batch form; the streaming form
runs it per micro-batch over the keys that the batch touches)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators import prefix


def scd2_apply_changes(changes: DataFrame, keys: Sequence[str], seq: str, tracked: Sequence[str],
                       untracked: Sequence[str] = (), ignore_null_updates: bool = True,
                       tiebreak: Sequence[str] = (), start: str = "__START_AT",
                       end: str = "__END_AT", bucket: Column | None = None) -> DataFrame:
    """Versions per key ordered by ``seq`` (``tiebreak`` makes ties deterministic).

    * with ``ignore_null_updates`` a NULL in a change keeps the previous value: every
      column is first filled with the last non-NULL value of the key's history;
    * a new version starts when any *tracked* column (after filling) differs
      null-safely from the previous change;
    * untracked columns take their latest value inside the version;
    * ``start`` = the version's first sequence value, ``end`` = the next version's start
      (NULL for the current one).

    With ``bucket`` (a value that grows with ``seq``) a key's history is scanned bucket by bucket, so that a
    hot key is split over tasks. A version is named by the place of its first change."""
    order, keys = [seq, *[c for c in tiebreak if c != seq]], list(keys)
    cols = [*tracked, *untracked]
    place = F.struct(*[F.col(c) for c in order])

    def running(df: DataFrame, lasts: dict[str, Column], current: bool = True) -> DataFrame:
        if bucket is not None:
            return prefix.scan(df, keys, order, bucket, lasts=lasts, current=current)
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
        return df.withColumns({o: F.last(c, ignorenulls=True).over(w) for o, c in lasts.items()})

    rows = changes.select(*dict.fromkeys([*keys, *order, *cols]))
    if ignore_null_updates:
        rows = running(rows, {f"__v_{c}": F.col(c) for c in cols})
    else:
        rows = rows.withColumns({f"__v_{c}": F.col(c) for c in cols})
    # the previous change as one struct: NULL only before the first one
    rows = running(rows, {"__before": F.struct(*[F.col(f"__v_{c}") for c in tracked], F.lit(1).alias("__one"))}, current=False)
    changed = reduce(lambda a, b: a | b, [~F.col(f"__v_{c}").eqNullSafe(F.col(f"__before.__v_{c}")) for c in tracked], F.lit(False))
    opens = F.col("__before").isNull() | changed
    rows = running(rows, {"__version": F.when(opens, place)})
    last_of = lambda c: F.max_by(F.col(f"__v_{c}"), place).alias(c)
    versions = rows.groupBy(*keys, "__version").agg(*[last_of(c) for c in cols])
    versions = versions.select(*keys, "__version", F.col(f"__version.{seq}").alias(start), *cols)
    if bucket is not None:
        own = versions.withColumn(seq, F.col(start)) if seq not in versions.columns else versions
        got = prefix.following(own, keys, ["__version"], bucket, start, end)
        return got.select(*keys, start, *cols, end)
    vw = Window.partitionBy(*keys).orderBy("__version")
    return versions.withColumn(end, F.lead(start).over(vw)).select(*keys, start, *cols, end)
