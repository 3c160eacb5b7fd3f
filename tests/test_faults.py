"""Cases that once gave wrong or incomplete results."""

import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from strata.operators import graph as G
from strata.operators import joins as J
from strata.operators import merge as MG
from strata.operators import temporal as T
from strata.operators.scd2 import scd2_apply_changes
from strata.session import scratch_path
from strata.sources.tables import scan_stream
from strata.streaming import jobs as W


def test_scalar_of_two_rows_raises_and_empty_gives_nothing(spark):
    df, two = spark.range(3), spark.range(2).withColumnRenamed("id", "s")
    assert [r.s for r in J.attach_scalar(df, two.where("s = 1")).collect()] == [1, 1, 1]
    with pytest.raises(Exception, match="more than one row"):
        J.attach_scalar(df, two).collect()
    assert J.attach_scalar(df, two.where("s > 5")).count() == 0


def test_delete_filter_of_null_keeps_the_row(spark):
    tgt = spark.createDataFrame([(1, "P", "a"), (2, None, "a"), (3, "P", "a"), (4, "Q", "a")], "id int, st string, p string")
    src = spark.createDataFrame([(1, "P", "a")], "id int, st string, p string")
    for mode, more in (("full", {}), ("scoped", {"period_col": "p"})):
        out = MG.merge_upsert(tgt, src, ["id"], delete=mode, delete_filter="st = 'P'", **more).collect()
        assert sorted(r.id for r in out) == [1, 2, 4]


def test_period_outside_the_keys_and_given_scope(spark):
    tgt = spark.createDataFrame([(1, "x", "p1"), (2, "y", "p2"), (3, "z", "p3")], "id int, v string, p string")
    src = spark.createDataFrame([(1, "X", "p2")], "id int, v string, p string")
    out = MG.merge_upsert(tgt, src, ["id"], delete="scoped", period_col="p", include_period_in_keys=False)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "X", "p2"), (3, "z", "p3")]
    scope = spark.createDataFrame([("p3",)], "p string")
    out = MG.merge_upsert(tgt, src, ["id"], delete="scoped", period_col="p", include_period_in_keys=False, scope=scope)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "X", "p2"), (2, "y", "p2")]


def test_duplicate_merge_keys_raise(spark):
    tgt = spark.createDataFrame([(1, "a")], "id int, v string")
    src = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    with pytest.raises(ValueError, match="2 rows"):
        MG.merge_upsert(tgt, src, ["id"])


def test_windows_outside_the_span_cover_nothing(spark):
    ts = lambda y: dt.datetime(y, 1, 1)
    seg = spark.createDataFrame([("k", ts(2010), ts(2011)), ("k", ts(2011), ts(2012))], "k string, seg_start timestamp, seg_end timestamp")
    win = spark.createDataFrame([("k", 1, ts(2000), ts(2001)), ("k", 2, ts(2020), ts(2021)), ("k", 3, ts(2009), ts(2013))],
                                "k string, w int, win_start timestamp, win_end timestamp")
    for how, rows in (("inner", 2), ("left", 2)):
        assert [r.w for r in T.cover_join(seg, win, ["k"], bucket="year", how=how).collect()] == [3] * rows
    out = T.cover_join(seg, win.where("w < 3"), ["k"], bucket="year", how="left").collect()
    assert [r.w for r in out] == [None, None]


def test_hot_key_covered_the_same_with_buckets(spark):
    day = F.expr("timestamp'2000-01-01' + make_interval(0, 0, 0, CAST(id % 3000 AS INT))")
    seg = spark.range(4000).select(F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("k"), day.alias("seg_start"),
                                   (day + F.expr("interval 1 day")).alias("seg_end"))
    win = spark.range(900).select(F.lit("a").alias("k"), F.col("id").alias("w"), day.alias("win_start"),
                                  (day + F.expr("interval 40 days")).alias("win_end"))
    plain, split = T.cover_join(seg, win, ["k"]), T.cover_join(seg, win, ["k"], bucket="month")
    one = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)"))).first()
    assert one(plain) == one(split) and one(plain)[0] > 20000


def _cycles(spark, edges, **options):
    return G.detect_cycles(spark.createDataFrame(edges, "c string, p string"), "c", "p", **options)


def test_long_cycle_and_two_components(spark):
    ring = [(f"n{i:02d}", f"n{(i + 1) % 12:02d}") for i in range(12)]
    other = [("x", "y"), ("y", "z"), ("z", "x"), ("y", "x"), ("z", "leaf"), ("root", "x"), ("q", "q")]
    rows = _cycles(spark, ring + other).collect()
    by = {}
    for r in rows:
        assert r.start_node == r.end_node == r.path[0] == r.path[-1] and len(r.path) == r.depth + 1
        by.setdefault(frozenset(r.path), []).append(tuple(r.path))
    assert {k: len(v) for k, v in by.items()} == {frozenset(x for x, _ in ring): 12, frozenset("xyz"): 3, frozenset("xy"): 2,
                                                 frozenset("q"): 1}
    assert all(len(set(v)) == len(v) for v in by.values())


def test_given_depth_reports_what_it_leaves_out(spark):
    ring = [(f"n{i}", f"n{(i + 1) % 5}") for i in range(5)]
    with pytest.warns(UserWarning, match="depth 3"):
        assert _cycles(spark, ring, max_depth=3).count() == 0
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert _cycles(spark, ring, max_depth=5).count() == 5


def test_ownership_limits_are_reported_and_pushed_restrictions_agree(spark):
    d = dt.date
    e = spark.createDataFrame([(i, i + 1, 0.5, d(2000, 1, 1), None) for i in range(20)], "c int, p int, w double, f date, t date")
    e = e.unionByName(e.where("c = 0").withColumn("f", F.lit(d(1990, 1, 1))).withColumn("t", F.lit(d(2000, 1, 1))))
    args = ("c", "p", "w", "f", "t")
    whole = G.ownership_paths(e, *args)
    assert whole.count() == 210 + 1 - 1  # the two halves of the first edge are one interval
    with pytest.warns(UserWarning, match="levels above 3"):
        assert G.ownership_paths(e, *args, max_level=3).agg(F.max("level")).first()[0] == 3
    with pytest.warns(UserWarning, match="percentages"):
        assert G.ownership_paths(e, *args, min_pct=0.1).agg(F.max("level")).first()[0] == 3
    some = G.ownership_paths(e, *args, leaves=spark.createDataFrame([(3,)], "id int"), roots=spark.createDataFrame([(20,)], "id int"))
    assert [(r.ultimate_child_id, r.ultimate_parent_id, r.level) for r in some.collect()] == [(3, 20, 17)]
    assert G.ownership_paths(e, *args, as_of=d(1995, 1, 1)).count() == 1


def test_source_without_a_shared_key_raises(spark):
    a = spark.createDataFrame([(1,)], "k int")
    s = spark.createDataFrame([(2, dt.datetime(2000, 1, 1), None)], "other int, f timestamp, t timestamp")
    with pytest.raises(ValueError, match="shares no key"):
        T.segments_from_sources(a, ["k"], [(s, "f", "t", "s")])


def test_versions_that_share_a_start_are_ordered(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [(1, t, 1, "a"), (1, t, 2, "b"), (1, t, 3, "c"), (1, dt.datetime(2021, 1, 1), 4, "d")]
    df = spark.createDataFrame(rows, "k int, ts timestamp, n int, v string")
    out = {r.v: r["__END_AT"] for r in scd2_apply_changes(df, ["k"], "ts", ["v"], tiebreak=["n"]).collect()}
    assert out == {"a": t, "b": t, "c": dt.datetime(2021, 1, 1), "d": None}


def _landing(spark, rows, path):
    spark.createDataFrame(rows, "id long, ts timestamp, v string").coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    schema = "id long, ts timestamp, v string"
    return scan_stream(spark, path, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)


def test_duplicate_five_seconds_later_fails_the_batch(spark):
    path, t = scratch_path(spark, "t-land"), dt.datetime(2020, 1, 1)
    _landing(spark, [(1, t, "a"), (2, t, "b")], path)
    for within in (None, ("ts", "1 minute", "10 minutes")):
        counts = lambda: W.uniqueness_counts(_stream(spark, path), individual=["id"], within=within)  # noqa: E731, B023
        W.run_available_now(spark, counts(), "t-w2", mode="update", foreach_batch=W.fail_on_duplicates)
    _landing(spark, [(1, t + dt.timedelta(seconds=5), "a")], path)
    for within in (None, ("ts", "1 minute", "10 minutes")):
        with pytest.raises(Exception, match="uniqueness expectation failed"):
            W.run_available_now(spark, W.uniqueness_counts(_stream(spark, path), individual=["id"], within=within), "t-w2",
                                mode="update", foreach_batch=W.fail_on_duplicates)


@pytest.mark.parametrize("file_events, files", [(500_000, 4), (5, 16)])
def test_a_table_of_many_files_is_streamed_in_four_batches(spark, monkeypatch, file_events, files):
    from strata.plans import q_stream as Q
    root, t = scratch_path(spark, "t-root"), dt.datetime(2020, 1, 1)
    for i in range(3):  # later files hold times of all quarters
        _events(spark, [(j, t + dt.timedelta(minutes=j), j % 4) for j in range(i, 80, 3)], f"{root}/events.parquet")
    monkeypatch.setattr(Q, "FILE_EVENTS", file_events)
    landed = []
    monkeypatch.setattr(Q, "scan_stream", lambda spark, path, *a, **more: landed.append(path) or scan_stream(spark, path, *a, **more))
    stream = Q.events_stream(spark, root).select("event_id", "user_id", "ts")
    sink = W.run_available_now(spark, W.uniqueness_counts(stream, individual=["event_id"], composite=[["user_id", "ts"], ["user_id"]]), "t-w2", mode="update")
    got = spark.read.parquet(sink)
    assert got.select("batch").distinct().count() == 4
    assert len(spark.read.parquet(landed[0]).inputFiles()) == files
    seen = W.latest_state(spark, sink, ["check_name", "key_value"])
    assert {r.check_name: (r.n, r.most) for r in seen.groupBy("check_name").agg(F.count("*").alias("n"), F.max("dup_count").alias("most")).collect()} == {
        "ind__event_id": (80, 1), "cmp__user_id_ts": (80, 1), "cmp__user_id": (4, 20)}


def _events(spark, rows, path):
    more = [(*r, "click", 1.0, "{}") for r in rows]
    spark.createDataFrame(more, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.mode("append").parquet(path)


def test_a_stopped_stream_resumes_without_doubling(spark):
    path, sink, ckpt = (scratch_path(spark, x) for x in ("t-land", "t-sink", "t-ckpt"))
    t = dt.datetime(2020, 1, 1)
    for i in range(3):
        _landing(spark, [(i, t, "a"), (i + 10, t, "b")], path)
    run = lambda: W.run_available_now(spark, _stream(spark, path), "t", foreach_batch=lambda b, i: None, sink=sink, checkpoint=ckpt)
    run()
    assert spark.read.parquet(sink).count() == 6
    run()
    assert spark.read.parquet(sink).count() == 6
    _landing(spark, [(99, t, "c")], path)
    run()
    got = spark.read.parquet(sink)
    assert got.count() == 7 and got.select("batch").distinct().count() == 4


def test_scd2_over_micro_batches_equals_one_batch(spark):
    path = scratch_path(spark, "t-land")
    day = lambda n: dt.datetime(2020, 1, n)
    batches = [[(1, day(1), "a"), (2, day(1), "x")], [(1, day(5), "b"), (2, day(3), "x")], [(1, day(3), "c"), (2, day(9), None)]]
    for rows in batches:
        _landing(spark, rows, path)
    sink = W.scd2_stream(spark, _stream(spark, path), "t-scd", ["id"], "ts", ["v"])
    got = W.scd2_versions(spark, sink, ["id"], "ts", ["v"])
    want = scd2_apply_changes(spark.read.parquet(path), ["id"], "ts", ["v"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 4


def test_stream_joined_to_a_static_table(spark):
    path = scratch_path(spark, "t-land")
    _landing(spark, [(1, dt.datetime(2020, 1, 1), "a"), (2, dt.datetime(2020, 1, 1), "q")], path)
    dim = spark.createDataFrame([("a", "Alpha")], "v string, name string")
    out = spark.read.parquet(W.run_available_now(spark, W.stream_enrich(_stream(spark, path), dim, "v"), "t-j19"))
    assert sorted((r.id, r.name) for r in out.collect()) == [(1, "Alpha"), (2, None)]
