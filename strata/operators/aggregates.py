"""Aggregation operators (all single-pass, partial-aggregation friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agg_sum(df: DataFrame, keys: Sequence[str], measures: dict[str, tuple[str, str]]) -> DataFrame:
    """A1/A3: ``{out: (fn, col)}`` with fn in sum/max/min/count/avg per group."""
    fns = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count, "avg": F.avg}
    return df.groupBy(*keys).agg(*[fns[fn](c).alias(out) for out, (fn, c) in measures.items()])


def sum_by_type(df: DataFrame, type_col: str, spec: dict[str, tuple[Sequence[str], Column | str]]) -> list[Column]:
    """A2: conditional sums ``{out: (type values, amount expr)}`` -> aggregate columns,
    ``SUM(CASE WHEN type IN (...) THEN amount ELSE 0 END)``."""
    out = []
    for name, (types, amount) in spec.items():
        amt = F.col(amount) if isinstance(amount, str) else amount
        out.append(F.sum(F.when(F.col(type_col).isin(list(types)), amt).otherwise(F.lit(0.0))).alias(name))
    return out


def distinct_count(df: DataFrame, keys: Sequence[str], col: str, out: str = "n_distinct") -> DataFrame:
    """A4: exact count distinct per group."""
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(out))


def collect_sorted(df: DataFrame, keys: Sequence[str], col: str, out: str, sep: str | None = None,
                   distinct: bool = True) -> DataFrame:
    """Sorted set (or list) of values per group; ``sep`` joins it to a string.

    Size of a collected array is bounded by the number of *distinct* values per group
    (enums such as phases/technologies), not by group row count."""
    coll = F.collect_set(col) if distinct else F.collect_list(col)
    arr = F.sort_array(coll)
    return df.groupBy(*keys).agg((F.array_join(arr, sep) if sep is not None else arr).alias(out))


def first_non_null(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: str) -> DataFrame:
    """Per group, each column's value at the greatest ``order`` among rows where it is
    non-NULL (deterministic ``max_by`` instead of ``first(ignorenulls)``)."""
    return df.groupBy(*keys).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col(order), F.col(c)))).alias(c)
        for c in cols])


def any_true(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """``bool_or`` coverage flags (NULL counts as false)."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags])


def product_of(array_col: Column, field: str | None = None) -> Column:
    """Product of an array (of structs' ``field``); NULL if any element is NULL."""
    arr = F.transform(array_col, lambda x: x[field]) if field else array_col
    return F.aggregate(arr, F.lit(1.0).cast("double"),
                       lambda acc, x: F.when(acc.isNull() | x.isNull(), F.lit(None).cast("double"))
                       .otherwise(acc * x.cast("double")))


def pivot_metric(df: DataFrame, keys: Sequence[str], name_col: str, value_col: str,
                 values: Sequence[str], agg: str = "max") -> DataFrame:
    """Long -> wide with explicit pivot values (no extra job to find them).

    ``agg`` is ``max`` (the deterministic form of the reference's ``first``), ``min``,
    ``sum``, ``avg`` or ``count`` of the (keys, name) pair's values."""
    if agg not in ("max", "min", "sum", "avg", "count"):
        raise ValueError(f"unknown aggregate {agg!r}")
    return df.groupBy(*keys).pivot(name_col, list(values)).agg(getattr(F, agg)(value_col))


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "metric",
         value: str = "value") -> DataFrame:
    """A10: wide -> long (``unpivot``); value columns are cast to a common double."""
    casted = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(list(ids), list(cols), name, value)


def summary_string(df: DataFrame, keys: Sequence[str], cols: Sequence[str], out: str = "summary",
                   sep: str = ", ") -> DataFrame:
    """One string per group listing the sorted distinct ``col=value`` pairs."""
    pair = F.concat_ws("=", *[F.concat_ws("|", *[F.col(c).cast("string") for c in cols])])
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(pair)), sep).alias(out))


def pct_of_total(df: DataFrame, key: Sequence[str], out_count: str = "n", out_pct: str = "pct") -> DataFrame:
    """Count per key and its share of all rows, percent, via a broadcast grand total."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias(out_count))
    total = counts.agg(F.sum(out_count).alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
                  .withColumn(out_pct, F.col(out_count) * F.lit(100.0) / F.col("_total"))
                  .drop("_total"))


def share_of_period(df: DataFrame, period: Sequence[str], slice_col: str, measures: Sequence[str]) -> DataFrame:
    """Per (period, slice) sums and their share of the period total
    (``try_divide`` -> NULL on zero totals). Two aggregations, the second over the
    already-aggregated slices, joined on the period keys."""
    by_slice = df.groupBy(*period, slice_col).agg(*[F.sum(m).alias(m) for m in measures])
    totals = by_slice.groupBy(*period).agg(*[F.sum(m).alias(f"_tot_{m}") for m in measures])
    j = by_slice.join(totals, list(period), "inner")
    return j.select(*period, slice_col, *measures,
                    *[F.try_divide(F.col(m), F.col(f"_tot_{m}")).alias(f"{m}_share") for m in measures])


def distinct_key_rows(df: DataFrame, pk: Sequence[str]) -> Column:
    """Number of distinct primary keys (as an aggregate column)."""
    return F.count_distinct(F.struct(*pk))


def dup_counts(df: DataFrame, keys: Sequence[str], out: str = "dup_count") -> DataFrame:
    """Rows per key set."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
