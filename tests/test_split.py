"""Hot keys: operators that split a key give the results of the plain window or join."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import joins as J
from strata.operators import merge as MG
from strata.operators import prefix as P
from strata.operators import recon as R
from strata.operators import temporal as T
from strata.operators import windows as N
from strata.operators.scd2 import scd2_apply_changes


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows over 40 days; a third under key 'hot', some under NULL; ties in time, gaps in the values."""
    i = F.col("id")
    day = F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, CAST(pmod(id * 7919, 40) AS INT))")
    return spark.range(3000).select(
        F.when(i % 3 == 0, "hot").when(i % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (i % 29).cast("string"))).alias("k"),
        i, day.alias("ts"), F.when(i % 4 != 0, (i % 17).cast("double")).alias("v"),
        F.when(i % 5 == 0, "").when(i % 7 != 0, F.concat(F.lit("s"), (F.expr("id div 60") % 3).cast("string"))).alias("s")).cache()


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def split(df):
    """The plan's windows over rows are partitioned by the bucket too."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "__bucket" in plan


def test_running_total(hot):
    one = N.running_total(hot, ["k"], ["ts", "id"], {"t": "v"})
    two = N.running_total(hot, ["k"], ["ts", "id"], {"t": "v"}, bucket=P.time_bucket("ts", "day"))
    assert split(two) and rows(one) == rows(two)


@pytest.mark.parametrize("unit", ["day", "week", "year"])
def test_fill_forward(hot, unit):
    one = N.fill_forward(hot, ["k"], ["ts", "id"], ["v", "s"], flag="filled")
    two = N.fill_forward(hot, ["k"], ["ts", "id"], ["v", "s"], flag="filled", bucket=P.time_bucket("ts", unit))
    assert split(two) and rows(one) == rows(two)


def test_following_and_exclusive_scan(hot):
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = hot.withColumns({"nxt": F.lead("v").over(w), "before": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1))})
    got = P.following(hot, ["k"], ["ts", "id"], P.time_bucket("ts", "day"), "v", "nxt")
    got = P.scan(got, ["k"], ["ts", "id"], P.time_bucket("ts", "day"), sums={"before": F.col("v")}, current=False)
    assert rows(want) == rows(got)


@pytest.mark.parametrize("keep_nulls", [True, False])
def test_scd2(hot, keep_nulls):
    spec = dict(keys=["k"], seq="ts", tracked=["s"], untracked=["v"], tiebreak=["id"], ignore_null_updates=keep_nulls)
    one = scd2_apply_changes(hot, **spec)
    two = scd2_apply_changes(hot, **spec, bucket=P.time_bucket("ts", "week"))
    assert split(two) and rows(one) == rows(two) and one.count() > 500


def history(spark, n=900):
    """Versions per (k, series), a third of them under one key; some end early."""
    i = F.col("id")
    start = F.expr("date'2024-01-01' + CAST(id % 30 AS INT) * 3")
    return spark.range(n).select(F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (i % 29).cast("string"))).alias("k"), F.expr("id div 30").alias("series"),
                                 start.alias("a"), F.when(i % 30 != 29, F.date_add(start, F.when(i % 11 == 0, 1).otherwise(3))).alias("z"), i.alias("payload"))


def test_as_of_equals_the_range_join(spark, hot):
    points = hot.select("k", "id", F.col("ts").cast("date").alias("d")).unionByName(spark.createDataFrame([(None, -1, dt.date(2024, 1, 5)), ("none", -2, dt.date(2024, 1, 5)),
                                                                                                    ("hot", -3, None)], "k string, id long, d date"))
    hist = history(spark)
    for how in ("left", "inner"):
        p, h = points.alias("p"), hist.alias("h")
        want = p.join(h, [F.col("p.k") == F.col("h.k"), F.col("h.a") <= F.col("p.d"), F.col("h.z").isNull() | (F.col("p.d") < F.col("h.z"))], how).select(
            "p.k", "id", "d", "series", "a", "z", "payload")
        for bucket in (None, "month"):
            got = T.as_of_join(points, hist, ["k"], "d", "a", "z", how=how, series=["series"], bucket=bucket)
            assert rows(want) == rows(got)
            text = got._jdf.queryExecution().optimizedPlan().toString()
            assert "a#" not in [x for x in text.split("\n") if "Join" in x and "<=" in x]  # no range condition in a join


def test_overlapping_versions_raise(spark):
    hist = spark.createDataFrame([("x", 1, dt.date(2024, 1, 1), dt.date(2024, 1, 9)), ("x", 2, dt.date(2024, 1, 5), None)], "k string, v int, a date, z date")
    points = spark.createDataFrame([("x", dt.date(2024, 1, 6))], "k string, d date")
    with pytest.raises(Exception, match="overlapping versions"):
        T.as_of_join(points, hist, ["k"], "d", "a", "z").collect()


def test_compare_histories_and_allocation_with_buckets(spark):
    a = history(spark).withColumn("payload", F.col("payload").cast("double"))
    b = a.where("payload % 13 <> 0").withColumn("payload", F.when(F.col("payload") % 7 == 0, F.col("payload") + 1).otherwise(F.col("payload")))
    one, two = (T.compare_histories(a, b, ["k", "series"], "payload", "a", "z", bucket=u) for u in (None, "month"))
    assert rows(one) == rows(two) and {r["status"] for r in one.collect()} == {"Match", "Mismatch", "Missing in B"}
    share = a.withColumn("payload", F.lit(0.15))
    one, two = (T.allocation_violations(share, ["k"], "payload", "a", "z", bucket=u) for u in (None, "month"))
    one, two = (x.withColumn("total_value", F.round("total_value", 6)) for x in (one, two))
    assert rows(one) == rows(two) and one.count() > 5
    # against a plain cover join
    capped = share.withColumns({"a": F.col("a").cast("timestamp"), "z": F.coalesce(F.col("z").cast("timestamp"), T.far_future())})
    segs = T.segments_from_columns(capped, ["k"], ["a", "z"])
    plain = (T.cover_join(segs, capped.withColumnsRenamed({"a": "win_start", "z": "win_end"}), ["k"]).groupBy("k", "seg_start", "seg_end")
             .agg(F.round(F.sum("payload"), 6).alias("total_value"), F.count("*").alias("n_rows")).where("total_value > 1"))
    assert rows(plain) == rows(one)


def test_full_outer_on_hot_and_null_keys(spark, hot):
    left = hot.select(F.col("k").alias("lk"), F.col("id").alias("lid"))
    right = hot.where("id % 10 < 2").groupBy(F.col("k").alias("rk")).agg(F.count("*").alias("n")).unionByName(
        spark.createDataFrame([("only", 1), (None, 2), ("hot", 5)], "rk string, n long"))
    for safe in (False, True):
        cond = F.col("lk").eqNullSafe(F.col("rk")) if safe else F.col("lk") == F.col("rk")
        got = J.full_outer(left, right, [("lk", "rk")], null_safe=safe)
        assert "FullOuter" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert rows(left.join(right, cond, "full")) == rows(got)


def test_no_full_outer_join_is_left_in_merges(spark, hot):
    tgt = hot.select("id", "k", "v")
    src = hot.where("id % 3 = 1").select("id", "k", (F.col("v") + 1).alias("v"))
    merged = MG.merge_upsert(tgt, src, ["id"])
    e = hot.select(F.col("k").alias("id"), F.col("s").alias("name"), F.col("s").alias("number")).distinct()
    frames = [merged, R.entity_reconcile(e, e.where("id <> 'hot'")), R.reconcile(e, e, {"id": "id"}, {"name": "name"}),
              J.full_merge(tgt, src.withColumnRenamed("v", "w"), ["id"])]
    assert all("FullOuter" not in f._jdf.queryExecution().optimizedPlan().toString() for f in frames)
    got = {r["id"]: r["v"] for r in merged.collect()}
    assert all(got[r["id"]] == (r["v"] if r["id"] % 3 != 1 else None if r["v"] is None else r["v"] + 1) for r in tgt.collect())


def test_full_merge_coalesces_dimensions(spark):
    a = spark.createDataFrame([(1, None, 5), (2, "x", 6)], "id int, dim string, m int")
    b = spark.createDataFrame([(1, "y", 7), (3, "z", 8)], "id int, dim string, w int")
    assert rows(J.full_merge(a, b, ["id"])) == [("x", 2, 6, None), ("y", 1, 5, 7), ("z", 3, None, 8)]
