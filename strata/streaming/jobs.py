"""Structured Streaming forms of the flag / dedupe / quarantine pipeline.

Streams are read incrementally from append-only parquet folders (``scan_stream``),
transformed with the same stateless operators as the batch path (flags, quarantine
verdicts), and written with ``trigger(availableNow=True)`` - the triggered,
run-to-completion model of the reference pipelines. A job that is given its sink and
checkpoint folders resumes where it stopped: batches written through ``foreachBatch`` go
to one folder per batch id, which a retry overwrites. Without folders a run is a fresh
one under the session's shared ``spark.checkpoint.dir``.
The quality gate (W7, W8) flags nulls, rules, missing references and repeated keys and writes the clean and the
quarantined side of one read; the SCD2 table (W3) is merged per batch, reading only the buckets of the keys that the batch
touches. Quarantine windows and the windowed uniqueness check carry watermarks and so bounded
state; the watermark-free dedupe and uniqueness check (reference behaviour) keep every key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import dq as DQ
from strata.session import scratch_path


def stream_dedupe(stream: DataFrame, keys: Sequence[str], watermark: tuple[str, str] | None = None) -> DataFrame:
    """Drop repeated keys. Without ``watermark`` state is unbounded (as the
    reference); with ``(ts_col, delay)`` duplicates are dropped within the watermark
    and state is purged behind it."""
    if watermark is None:
        return stream.dropDuplicates(list(keys))
    ts, delay = watermark
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def uniqueness_counts(stream: DataFrame, individual: Sequence[str] = (), composite: Sequence[Sequence[str]] = (),
                      within: tuple[str, str, str] | None = None) -> DataFrame:
    """Running count per key set (``ind__c`` / ``cmp__a_b``), by the keys alone; a
    micro-batch that brings any ``dup_count <> 1`` fails in :func:`fail_on_duplicates`.

    Without ``within`` every key ever seen is kept. ``within = (ts_col, window, delay)`` bounds
    the state: keys are counted per sliding event-time window (half a window apart, so that two
    events closer than half a window always share one) and dropped behind the watermark."""
    sets = [([c], f"ind__{c}") for c in individual] + [(list(s), "cmp__" + "_".join(s)) for s in composite]
    src, extra = stream, []
    if within is not None:
        ts, window, delay = within
        half = f"{_seconds(stream.sparkSession, window) // 2} seconds"
        src = stream.withWatermark(ts, delay)
        extra = [F.window(ts, window, half).alias("window")]
    # a row meets every key set in one aggregation: keys of other sets are NULL beside the set's name, one state holds all
    cols = list(dict.fromkeys(c for k, _ in sets for c in k))
    met = [F.struct(F.lit(label).alias("check_name"), *[F.when(F.lit(c in k), F.col(c)).alias(c) for c in cols]) for k, label in sets]
    src = src.select(F.explode(F.array(*met)).alias("__k"), *([within[0]] if within else []))
    counts = src.groupBy(F.col("__k").alias("__k"), *extra).agg(F.count(F.lit(1)).alias("dup_count"))
    value = F.coalesce(*[F.when(F.col("__k.check_name") == label, F.concat_ws("|", *[F.col(f"__k.`{c}`").cast("string") for c in k]))
                         for k, label in sets])
    return counts.select(F.col("__k.check_name").alias("check_name"), value.alias("key_value"), "dup_count", *(["window"] if within else []))


def _seconds(spark: SparkSession, interval: str) -> int:
    return int(spark.sql(f"SELECT unix_timestamp(timestamp'1970-01-02' + interval {interval}) "
                         "- unix_timestamp(timestamp'1970-01-02') AS s").first()["s"])


def fail_on_duplicates(batch: DataFrame, batch_id: int) -> None:
    """``foreachBatch`` gate for W2: raise when the batch holds a duplicate."""
    if not batch.where(F.col("dup_count") != 1).isEmpty():
        raise ValueError(f"uniqueness expectation failed in micro-batch {batch_id}")


def flag_stream(stream: DataFrame, not_null: Sequence[str], rules: dict[str, str],
                soft_rules: dict[str, str] | None = None) -> DataFrame:
    """Stateless row-wise flags on a stream (same operators as the batch path)."""
    df = DQ.flag_nulls(stream, not_null)
    df = DQ.flag_rules(df, rules)
    if soft_rules:
        df = DQ.flag_rules(df, soft_rules, hard=False)
    return df


def quarantine_stream(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The quarantine split applied to a stream (two sinks)."""
    return DQ.quarantine_split(flagged)


def quarantine_counts(quarantine: DataFrame, ts: str, table: str, window: str = "120 minutes",
                      delay: str = "120 minutes") -> DataFrame:
    """Tumbling-window counts of quarantined rows under a watermark."""
    return DQ.quarantine_summary(quarantine.withWatermark(ts, delay), ts, table, window)


def append_flows(streams: Sequence[DataFrame]) -> DataFrame:
    """Several streams appended to one sink (union by name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def run_available_now(spark: SparkSession, df: DataFrame, name: str, mode: str = "append",
                      foreach_batch: Callable[[DataFrame, int], None] | None = None, sink: str | None = None,
                      checkpoint: str | None = None) -> str:
    """Run a stream to completion with ``availableNow``; returns the sink folder.

    With ``sink`` and ``checkpoint`` a later call reads only what is new. Update and complete
    mode, and any job with ``foreach_batch``, write one folder per batch id (``batch=<id>``), so
    that a retried batch replaces itself; read them with :func:`latest_state` or as one table."""
    sink = sink or scratch_path(spark, f"{name}-sink")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None or mode in ("complete", "update"):
        def sink_batch(batch: DataFrame, batch_id: int) -> None:
            if foreach_batch is None:
                batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
                return
            held = batch.persist()  # read twice
            try:
                foreach_batch(held, batch_id)
                held.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
            finally:
                held.unpersist()
        q = w.foreachBatch(sink_batch).start()
    else:
        q = w.format("parquet").option("path", sink).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return sink


def latest_state(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """Rows of an update-mode sink: per key the row of its last batch (a partial maximum, no sort)."""
    rows = spark.read.parquet(sink)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return (rows.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("__r"))
            .select(*keys, *[F.col(f"__r.`{c}`").alias(c) for c in rest]))


def stream_enrich(stream: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """A stream joined to a static table (re-read with every micro-batch); stateless."""
    return stream.join(dim, on, how)


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that a stream has begun to write, or no rows."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def quality_gate(spark: SparkSession, stream: DataFrame, name: str, not_null: Sequence[str] = (), rules: dict[str, str] | None = None,
                 soft_rules: dict[str, str] | None = None, refs: Sequence[tuple] = (), unique: Sequence[str] = (), order: Sequence[str] = (),
                 sink: str | None = None, checkpoint: str | None = None) -> tuple[str, str]:
    """W7 + W8 with all four kinds of flags: (clean folder, quarantine folder), both written from one read of each batch.

    ``refs`` = [(reference, {column: reference column}, name, hard)]: the distinct reference keys are joined to the batch
    (:func:`strata.operators.dq.flag_missing_ref`). ``unique``: a row whose keys came before is flagged ``DQ_hard_duplicate``: in an
    earlier batch, by the table of keys seen, or earlier in its own batch by ``order``. Rows with a NULL key are
    no duplicates. Every batch writes folders of its own id, so a retried batch replaces itself and does not meet its own keys."""
    sink = sink or scratch_path(spark, f"{name}-gate")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    clean, quarantine, seen = (f"{sink}/{x}" for x in ("clean", "quarantine", "seen"))
    keys = list(unique)

    def run(batch: DataFrame, batch_id: int) -> None:
        df = flag_stream(batch, not_null, rules or {}, soft_rules)
        for ref, keymap, ref_name, hard in refs:
            df = DQ.flag_missing_ref(df, ref, keymap, ref_name, hard)
        if keys:
            whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
            schema = T.StructType([*[batch.schema[k] for k in keys], T.StructField("batch", T.LongType())])
            known = _read_or_empty(spark, seen, schema).where(F.col("batch") < batch_id).select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
            first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) if order else F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
            df = df.withColumn("__n", first).join(known.withColumn("__hit", F.lit(1)), [F.col(k) == F.col(f"__{k}") for k in keys], "left")
            again = whole & ((F.col("__n") > 1) | F.col("__hit").isNotNull())
            df = df.withColumn("DQ_hard_duplicate", again.cast("int")).drop("__n", "__hit", *[f"__{k}" for k in keys])
        held = df.persist()
        try:
            bad, good = DQ.quarantine_split(held)
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
            good.write.mode("overwrite").parquet(f"{clean}/batch={batch_id}")
            if keys:
                held.select(*keys).dropna().distinct().write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
        finally:
            held.unpersist()

    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return clean, quarantine


def scd2_stream(spark: SparkSession, changes: DataFrame, name: str, keys: Sequence[str], seq: str, tracked: Sequence[str],
                untracked: Sequence[str] = (), tiebreak: Sequence[str] = (), sink: str | None = None,
                checkpoint: str | None = None, buckets: int = 64, **options) -> str:
    """An SCD2 table kept up by a change stream; returns its folder, read by :func:`scd2_versions`.

    Changes are logged by bucket of their keys and batch. A batch rebuilds the versions of the keys it touches from their own
    changes (so late ones re-open history) and rewrites their buckets as a new edition; of other buckets it reads nothing,
    of the touched ones only the touched keys' changes and the last edition. With more ``buckets`` a batch reads less. A
    retried batch replaces its own log and editions."""
    cols = list(dict.fromkeys([*keys, seq, *tracked, *untracked, *tiebreak]))
    sink = sink or scratch_path(spark, f"{name}-scd2")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    log, table = f"{sink}/changes", f"{sink}/versions"
    bucket = F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")

    def rebuilt(rows: DataFrame) -> DataFrame:
        from strata.operators.scd2 import scd2_apply_changes
        return scd2_apply_changes(rows, keys, seq, tracked, untracked, tiebreak=tiebreak, **options)

    def run(batch: DataFrame, batch_id: int) -> None:
        def write(df: DataFrame, path: str) -> None:  # one file a bucket
            (df.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "batch").parquet(path))

        held = batch.select(*cols, bucket, F.lit(batch_id).cast("long").alias("batch")).persist()
        try:
            write(held, log)
            touched = [r["bucket"] for r in held.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
            if not touched:
                return
            own = held.select(*keys).distinct()
            history = spark.read.schema(held.schema).parquet(log).where(F.col("bucket").isin(touched) & (F.col("batch") <= batch_id))
            same = [F.col(f"_a.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in keys]
            fresh = rebuilt(history.alias("_a").join(own.alias("_b"), same, "left_semi").select(*cols))
            schema = T.StructType([*fresh.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())])
            before = _read_or_empty(spark, table, schema).where(F.col("bucket").isin(touched) & (F.col("batch") < batch_id))
            last = before.groupBy("bucket").agg(F.max("batch").alias("batch"))
            kept = before.join(last, ["bucket", "batch"], "left_semi").alias("_a").join(own.alias("_b"), same, "left_anti")
            edition = kept.select(*fresh.columns, "bucket").unionByName(fresh.withColumn("bucket", bucket))
            write(edition.withColumn("batch", F.lit(batch_id).cast("long")), table)
        finally:
            held.unpersist()

    q = changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return sink


def scd2_versions(spark: SparkSession, sink: str, *_spec, **_options) -> DataFrame:
    """The SCD2 table that :func:`scd2_stream` keeps: the last edition of every bucket. (The stream's specification may be
    named again; the table is already built by it.)"""
    rows = spark.read.parquet(f"{sink}/versions")
    last = rows.groupBy("bucket").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["bucket", "batch"], "left_semi").drop("bucket", "batch")
