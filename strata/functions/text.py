"""Scalar helpers (all built-in Column expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(c: Column) -> Column:
    """Company-name normaliser: collapse whitespace, lower + trim, 'limited' -> 'ltd',
    strip ',' and '.'."""
    x = F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    x = F.regexp_replace(x, r"\blimited\b", "ltd")
    return F.regexp_replace(x, r"[,.]", "")


def metric_slug(c: Column) -> Column:
    """Metric-name slug: runs of whitespace/parentheses -> '_', trailing '_' removed, lower."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"[\s()]+", "_"), r"_+$", ""))


def quarter_label(c: Column) -> Column:
    """``YYYY-Qn`` label of a date."""
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def bounded_ts(c: Column, lo: str = "1900-01-01", hi: str = "2260-12-31") -> Column:
    """Interval-bounds sanitiser: timestamps outside [lo, hi] become NULL."""
    return F.when((c < F.lit(lo).cast("timestamp")) | (c > F.lit(hi).cast("timestamp")), F.lit(None)).otherwise(c)
