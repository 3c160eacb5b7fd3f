"""FX rates, track record, metric dictionary, KPI variance and mapped dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import metric_slug
from strata.operators.aggregates import melt
from strata.operators.joins import full_merge
from strata.operators.windows import keep_latest, rank_rows, rolling_variance
from strata.sources.tables import Tables

def quarter_end(c):
    return F.last_day(F.add_months(F.date_trunc("quarter", c), 2))


METRIC_NAMES = {"1-URGENT": "Gross IRR", "2-HIGH": "Net IRR", "3-MEDIUM": "TVPI"}


def track_record_eav(spark: SparkSession, d: str) -> DataFrame:
    """EAV datapoints: entity = customer nation, metric from order priority, value
    from the order total, dated by the order date."""
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.lit("DPI")
    for k, v in reversed(list(METRIC_NAMES.items())):
        name = F.when(F.col("o_orderpriority") == k, F.lit(v)).otherwise(name)
    return j.select(F.col("n_name").alias("entity"), name.alias("datapoint_name"),
                    (F.col("o_totalprice") / F.lit(100000.0)).alias("value"),
                    F.col("o_orderdate").cast("date").alias("reporting_date"), F.col("o_orderkey").alias("revision"))


def track_record(eav: DataFrame) -> DataFrame:
    """M19 (first step): latest value per (entity, metric, year) -> metric slug columns per
    (entity, year) with explicit pivot values; ``is_active`` marks each entity's latest
    year."""
    y = eav.withColumn("year", F.year("reporting_date"))
    latest = keep_latest(y, ["entity", "datapoint_name", "year"], ["reporting_date", "revision"])
    vals = ["gross_irr", "net_irr", "tvpi", "dpi"]
    wide = (latest.withColumn("metric", metric_slug(F.col("datapoint_name"))).groupBy("entity", "year").pivot("metric", vals).agg(F.max("value")))
    last = wide.groupBy("entity").agg(F.max("year").alias("_last"))
    return wide.join(last, "entity").withColumn("is_active", F.col("year") == F.col("_last")).drop("_last")


def track_record_report(snapshot: DataFrame, eav: DataFrame, funds: DataFrame, metrics: Sequence[str], years: Sequence[int],
                        dictionary: DataFrame | None = None) -> DataFrame:
    """One row per (fund, metric): its latest known value and date, its value on 31 December of each of ``years``,
    the fund's dimensions as of its last report, and the metric's display name and definition.

    ``snapshot`` (fund_id, report_date, metric columns) and ``eav`` (fund_id, report_date, datapoint_name, value, revision) are
    laid side by side per fund and date (``metrics``: the datapoints' slugs to pivot); both are melted, and one aggregate
    finds the latest value and the year ends. ``funds``: fund_id, fund, currency, start_date, end_date. A fund is active at its
    last report when that lies in [start, end)."""
    points = keep_latest(eav, ["fund_id", "report_date", "datapoint_name"], ["revision"])
    wide = (points.withColumn("metric", metric_slug(F.col("datapoint_name"))).groupBy("fund_id", "report_date").pivot("metric", list(metrics))
            .agg(F.max("value")))
    both = full_merge(snapshot, wide, ["fund_id", "report_date"])
    names = [c for c in both.columns if c not in ("fund_id", "report_date")]
    long = melt(both, ["fund_id", "report_date"], names, "raw_metric", "value")
    known = F.when(F.col("value").isNotNull(), F.struct("report_date", "value"))
    year_end = lambda y: F.max(F.when(F.col("report_date") == F.lit(f"{y}-12-31").cast("date"), F.col("value"))).alias(str(y))
    g = long.groupBy("fund_id", "raw_metric").agg(F.max(known).alias("k"), *[year_end(y) for y in years])
    last = both.groupBy("fund_id").agg(F.max("report_date").alias("last_report"))
    dims = funds.join(last, "fund_id").withColumn("fund_is_active", F.coalesce(
        (F.col("last_report") >= F.col("start_date")) & (F.col("end_date").isNull() | (F.col("last_report") < F.col("end_date"))), F.lit(False)))
    out = g.where(F.col("k").isNotNull()).join(dims.select("fund_id", "fund", "currency", F.col("start_date").alias("inception_date"), "fund_is_active"), "fund_id", "left")
    if dictionary is not None:
        d = dictionary.groupBy(F.col("normalised_metric").alias("raw_metric")).agg(F.max("metric").alias("metric"), F.max("definition").alias("definition"))
        out = out.join(d, "raw_metric", "left")
    else:
        out = out.withColumns({"metric": F.lit(None).cast("string"), "definition": F.lit(None).cast("string")})
    return out.select("fund_id", "fund", "currency", "inception_date", "fund_is_active", "raw_metric", "metric", "definition",
                      F.col("k.report_date").alias("latest_metric_date"), F.col("k.value").alias("latest_metric_value"), *[str(y) for y in years])


def metric_dictionary(eav: DataFrame, wide: DataFrame, not_metrics: Sequence[str], display: DataFrame, definitions: DataFrame,
                      domain: str = "fund", system: str = "SRCE_SYST_1001", names: tuple[str, str] = ("datapointsexport", "track_record_fund")) -> DataFrame:
    """Every metric that is known as a datapoint name in rows (``eav``.datapoint_name, as its slug) or as a column of a wide
    table, with its display name (``display``: metric, display_name) and definition (``definitions``: metric, definition)."""
    rows = eav.select(metric_slug(F.col("datapoint_name")).alias("normalised_metric")).distinct().withColumn("dataset_name", F.lit(names[0]))
    columns = [c.lower() for c in wide.columns if c not in set(not_metrics)]
    cols = (wide.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns]).cast("array<string>")).alias("normalised_metric"))
            .withColumn("dataset_name", F.lit(names[1])))
    known = rows.unionByName(cols)
    j = (known.join(display.select(F.col("metric").alias("m1"), F.col("display_name").alias("metric")), F.col("normalised_metric") == F.col("m1"), "left")
         .join(definitions.select(F.col("metric").alias("m2"), "definition"), F.col("normalised_metric") == F.col("m2"), "left"))
    return j.select(F.lit(domain).alias("domain"), F.lit(system).alias("source_system_id"), "dataset_name", "normalised_metric", "metric", "definition")


def kpi_variance(tables: dict[str, tuple[DataFrame, dict]]) -> DataFrame:
    """For tables of different shape, how far each row's numbers lie from the mean of the periods before.

    ``tables`` = {name: (df, {"match_keys", "load_date", "partition_by", "order_by": {column: direction}, "window", "exclude"})}. Of each
    match key the row loaded last counts; the numeric columns (double or float, without ``exclude``) are found in the schema.
    One union: (table_name, keys ('column=value' joined by '|'), max_pct_diff, max_variance_column)."""
    out = None
    for name, (df, c) in tables.items():
        measures = [n for n, t in df.dtypes if t in ("double", "float") and n not in c.get("exclude", ())]
        if not measures:
            raise ValueError(f"{name}: no numeric column to compare")
        active = keep_latest(df, c["match_keys"], [c["load_date"]])
        ranked = rank_rows(active, c["partition_by"], c["order_by"])
        v = rolling_variance(ranked, c["partition_by"], "rank", measures, c["window"])
        keys = F.concat_ws("|", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in c["match_keys"]])
        rows = v.select(F.lit(name).alias("table_name"), keys.alias("keys"), F.col("max_abs_pct_diff").alias("max_pct_diff"),
                        F.col("max_diff_column").alias("max_variance_column"))
        out = rows if out is None else out.unionByName(rows)
    return out


def mapped_dimension(source: DataFrame, mapping: DataFrame, system: str, key: str, mapped_key: str,
                     dims: Sequence[tuple[DataFrame, str, str]] = (), end: str = "END_AT") -> DataFrame:
    """A source's rows under their ids in the common model: ``mapping`` (source_id, source_system_id, ``mapped_key``) of one
    system, then a chain of dimensions [(df, left column, right column)], of which only current rows (``end`` NULL) count."""
    own = mapping.where(F.col("source_system_id") == system).select(F.col("source_id").alias("__source"), mapped_key)
    out = source.join(own, F.col(key) == F.col("__source")).drop("__source")
    for df, left, right in dims:
        current = df.where(F.col(end).isNull()).drop(end)
        out = out.join(current.withColumnRenamed(right, f"__{right}"), F.col(left) == F.col(f"__{right}"), "left").drop(f"__{right}")
    return out


def fx_rates(spark: SparkSession, d: str, every: bool = False) -> DataFrame:
    """FX binding: one rate per nation currency and month end of the order dates in which its customers ordered
    (``every``: and each month end of any order); odd months are quoted inversely (GBP -> currency)."""
    t = Tables(spark, d)
    g = (t.nation.select("n_nationkey").crossJoin(t.orders.select(F.last_day("o_orderdate").alias("ref_date")).distinct()) if every else
         t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .select(F.col("c_nationkey").alias("n_nationkey"), F.last_day("o_orderdate").alias("ref_date")).distinct())
    rate = F.lit(1.0) + F.col("n_nationkey") / F.lit(10.0) + F.month("ref_date") / F.lit(100.0)
    ccy = F.concat(F.lit("CUR_"), F.col("n_nationkey").cast("string"))
    odd = F.month("ref_date") % 2 == 1
    return g.select(F.when(odd, F.lit("GBP")).otherwise(ccy).alias("source_currency"),
                    F.when(odd, ccy).otherwise(F.lit("GBP")).alias("destination_currency"),
                    F.round(rate, 6).alias("fx_rate"), "ref_date")


def fx_to_base(fx: DataFrame, codes: DataFrame, base: str = "GBP") -> DataFrame:
    """M1: rates to the base currency from direct legs (X -> base) and inverted
    inverse legs (base -> X); currencies without a code are dropped; cross rates
    between two non-base currencies are ignored; both legs kept when both exist."""
    direct = fx.where(F.col("destination_currency") == base).select(
        F.col("source_currency").alias("currency"), "ref_date", F.col("fx_rate").alias("rate_to_base"),
        F.lit("direct").alias("leg"))
    inverse = fx.where(F.col("source_currency") == base).select(
        F.col("destination_currency").alias("currency"), "ref_date",
        F.round(F.lit(1.0) / F.col("fx_rate"), 8).alias("rate_to_base"), F.lit("inverse").alias("leg"))
    both = direct.unionByName(inverse)
    return both.join(codes, "currency", "inner")
