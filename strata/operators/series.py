"""Calendarised series: spine, null-safe fill, cumulatives, forward fill.

``calendarise`` densifies a per-grain monthly/quarterly series from each grain's first
period to the global last period. Design for scale:

* facts are aggregated to (grain, period) first - partial aggregation collapses hot
  grains inside each input partition before any shuffle;
* gaps are filled from the aggregated facts themselves: every fact row is spread, with
  ``lead`` and ``sequence``, over the periods up to the grain's next one (the last period is
  a one-row aggregate), carrying its sums in its own period only. Grouping treats NULL keys
  as equal, so no join on the grain is needed at all;
* running totals and the NAV forward fill are windows partitioned by the full grain
  over the (small) period series of one grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_STEP = {"month": "1 month", "quarter": "3 months"}


def period_start(col, unit: str):
    return F.date_trunc(unit, col).cast("date")


def period_label(col, unit: str):
    """``yyyy-MM`` for months, ``yyyy-Qn`` for quarters."""
    if unit == "month":
        return F.date_format(col, "yyyy-MM")
    return F.concat(F.year(col).cast("string"), F.lit("-Q"), F.quarter(col).cast("string"))


def calendarise(df: DataFrame, grain: Sequence[str], date_col: str, sums: Sequence[str],
                maxes: Sequence[str] = (), unit: str = "month",
                cumulative: dict[str, str] | None = None,
                ffill: Sequence[str] = ()) -> DataFrame:
    """Dense per-grain period series.

    ``sums`` are summed per period and 0 on empty periods; ``maxes`` are maxed and
    NULL on empty periods; ``cumulative`` = ``{out: sum_col}`` running totals;
    ``ffill`` columns are carried forward. Output has ``Period`` (period start date)
    and ``Period_Label``.
    """
    grain = list(grain)
    facts = (df.withColumn("Period", period_start(F.col(date_col), unit))
               .groupBy(*grain, "Period")
               .agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxes]))
    last = facts.agg(F.max("Period").alias("_last"))
    step = F.expr(f"interval {_STEP[unit]}")
    ahead = F.lead("Period").over(Window.partitionBy(*grain).orderBy("Period"))
    spread = (facts.withColumn("_ahead", ahead).crossJoin(F.broadcast(last))
                   .select(*grain, *sums, *maxes, F.posexplode(F.sequence("Period", F.coalesce((F.col("_ahead") - step).cast("date"), F.col("_last")), step)).alias("_k", "Period")))
    own = F.col("_k") == 0
    dense = spread.select(*grain, "Period", *[F.when(own, F.col(c)).otherwise(F.lit(0.0)).alias(c) for c in sums],
                          *[F.when(own, F.col(c)).alias(c) for c in maxes])
    w = (Window.partitionBy(*grain).orderBy("Period")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    exprs = {out: F.sum(c).over(w) for out, c in (cumulative or {}).items()}
    exprs.update({c: F.last(c, ignorenulls=True).over(w) for c in ffill})
    return dense.withColumns(exprs).withColumn("Period_Label", period_label(F.col("Period"), unit))
