"""Properties of the operators on the real test tables (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import dq as DQ
from strata.operators import temporal as T
from strata.plans import bindings as B

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")


def test_segments_disjoint_and_cover_span(spark):
    e = T.standardize_intervals(B.edges(spark, SF), "active_from", "active_to")
    segs = T.segments_from_columns(e, ["child_id"], ["active_from", "active_to"])
    # consecutive segments of a key touch exactly: no gaps, no overlaps
    from pyspark.sql import Window
    w = Window.partitionBy("child_id").orderBy("seg_start")
    bad = segs.withColumn("prev_end", F.lag("seg_end").over(w)).where(
        F.col("prev_end").isNotNull() & (F.col("prev_end") != F.col("seg_start")))
    assert bad.isEmpty()
    span = e.groupBy("child_id").agg(F.min("active_from").alias("lo"), F.max("active_to").alias("hi"))
    cov = segs.groupBy("child_id").agg(F.min("seg_start").alias("lo"), F.max("seg_end").alias("hi"))
    assert span.exceptAll(cov).isEmpty()


def test_coalesce_segments_idempotent(spark):
    e = T.standardize_intervals(B.edges(spark, SF), "active_from", "active_to")
    x = e.select("child_id", "parent_id", "active_from", "active_to",
                 F.floor(F.col("percentage") * 4).alias("band"))
    once = T.coalesce_segments(x, ["child_id", "parent_id"], ["band"], "active_from", "active_to")
    twice = T.coalesce_segments(once, ["child_id", "parent_id"], ["band"], "active_from", "active_to")
    assert once.exceptAll(twice.select(*once.columns)).isEmpty()
    assert once.count() == twice.count()


def test_quarantine_covers_input_and_clean_has_no_hard_failures(spark):
    df = DQ.flag_nulls(B.lineitem_dq(spark, SF), ["l_suppkey"])
    df = DQ.flag_rules(df, {"big_qty": "l_quantity > 45"}, hard=False)
    q, clean = DQ.quarantine_split(df)
    n = df.count()
    assert q.count() + clean.count() >= n
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    assert q.where("DQ_hard_null_l_suppkey = 1").count() == df.where("l_suppkey IS NULL").count() > 0
    assert clean.where(F.col("l_suppkey").isNull()).isEmpty()
    assert clean.count() == df.where("l_suppkey IS NOT NULL").count()
    assert clean.select(*keys).exceptAll(df.select(*keys)).isEmpty()


def test_cover_join_bucketed_equals_plain(spark):
    e = T.standardize_intervals(B.edges(spark, SF), "active_from", "active_to")
    segs = T.segments_from_columns(e, ["child_id"], ["active_from", "active_to"])
    win = e.select("child_id", "parent_id", F.col("active_from").alias("win_start"), F.col("active_to").alias("win_end"))
    plain = T.cover_join(segs, win, ["child_id"])
    salted = T.cover_join(segs, win, ["child_id"], bucket="year")
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()
