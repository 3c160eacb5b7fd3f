"""Hand fixtures with expected results (the reference's own examples)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import bespoke as BS
from strata.operators import checks as C
from strata.operators import dq as DQ
from strata.operators import graph as G
from strata.operators import merge as MG
from strata.operators import temporal as T
from strata.sources import ingest as I


def test_cast_date_with_format(spark):
    df = spark.createDataFrame([("01-07-2023",)], "event_date string")
    out = I.cast_to_schema(df, {"event_date": "DATE"}, date_formats={"event_date": "dd-MM-yyyy"}).first()
    assert out["event_date"] == dt.date(2023, 7, 1)


def test_cast_timestamp_with_format(spark):
    df = spark.createDataFrame([("01-07-2023 14:45:00",)], "event_time string")
    out = I.cast_to_schema(df, {"event_time": "TIMESTAMP"}, ts_formats={"event_time": "dd-MM-yyyy HH:mm:ss"}).first()
    assert out["event_time"] == dt.datetime(2023, 7, 1, 14, 45)


def test_cast_quoted_iso(spark):
    df = spark.createDataFrame([('"2020-01-01T14:45:00"',)], "event_time string")
    out = I.cast_to_schema(df, {"event_time": "TIMESTAMP"}).first()
    assert out["event_time"] == dt.datetime(2020, 1, 1, 14, 45)


def test_cast_invalid_raises_and_try_mode(spark):
    df = spark.createDataFrame([("abc",)], "int_col string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        I.cast_to_schema(df, {"int_col": "INT"}).collect()
    assert I.cast_to_schema(df, {"int_col": "INT"}, on_error="null").first()["int_col"] is None


def test_format_for_non_temporal_column_raises(spark):
    df = spark.createDataFrame([("1",)], "x string")
    with pytest.raises(ValueError):
        I.cast_to_schema(df, {"x": "INT"}, ts_formats={"x": "yyyy"})


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, 0, 0, "a"), (2, 1, 0, "b"), (3, 0, 1, "c")],
                               "id int, DQ_hard_null_col1 int, DQ_soft_join_check int, other_data string")
    q, clean = DQ.quarantine_split(df)
    assert sorted(r.id for r in q.collect()) == [2, 3]
    assert sorted(r.id for r in clean.collect()) == [1, 3]
    assert not [c for c in clean.columns if c.startswith("DQ_")]


def test_merge_scoped_delete(spark):
    tgt = spark.createDataFrame([(1, "a", "2025-08-01"), (2, "b", "2025-08-01"), (3, "c", "2025-08-02"),
                                 (4, "d", "2025-07-31")], "id int, v string, period string")
    src = spark.createDataFrame([(1, "A", "2025-08-01"), (5, "e", "2025-08-02")], "id int, v string, period string")
    out = {(r.id, r.v) for r in MG.merge_upsert(tgt, src, ["id"], delete="scoped", period_col="period").collect()}
    # 2 and 3 are in batch periods but absent from the batch -> deleted; 4 is out of scope
    assert out == {(1, "A"), (4, "d"), (5, "e")}


def test_merge_full_delete_with_filter(spark):
    tgt = spark.createDataFrame([(1, "a", "2025-09-02"), (2, "b", "2025-08-01"), (3, "c", "2025-09-05")],
                                "id int, v string, load_dt string")
    src = spark.createDataFrame([(1, "A", "2025-09-02")], "id int, v string, load_dt string")
    out = {r.id for r in MG.merge_upsert(tgt, src, ["id"], delete="full", delete_filter="load_dt >= '2025-09-01'").collect()}
    assert out == {1, 2}


def test_merge_pad_and_evolve(spark):
    tgt = spark.createDataFrame([(1, "x")], "id int, v string")
    padded = MG.merge_upsert(tgt, spark.createDataFrame([(1,), (2,)], "id int"), ["id"])
    assert {(r.id, r.v) for r in padded.collect()} == {(1, None), (2, None)}
    evolved = MG.merge_upsert(tgt, spark.createDataFrame([(2, "y", 7)], "id int, v string, extra int"), ["id"])
    assert dict(evolved.dtypes)["extra"] == "int"
    assert {(r.id, r.extra) for r in evolved.collect()} == {(1, None), (2, 7)}


def test_merge_twice_equals_once(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    once = MG.merge_upsert(tgt, src, ["id"])
    twice = MG.merge_upsert(once, src, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dq_summary_success_rate(spark):
    df = spark.range(100).withColumnRenamed("id", "pk").withColumn("x", F.when(F.col("pk") < 5, None).otherwise(1))
    _, findings, summary = C.run_checks(df, [C.check_not_null("x")], ["pk"], "t")
    s = summary.first()
    assert s.success_rate == 95.0 and s.status == "Issues Found" and s.failed_rows == 5
    assert findings.count() == 5
    ok = C.run_checks(df.where("pk >= 5"), [C.check_not_null("x")], ["pk"], "t")[2].first()
    assert ok.success_rate == 100.0 and ok.status == "Success"


def _cycles(spark, rows, depth=10):
    df = spark.createDataFrame(rows, "company_core_id string, parent_company_id string")
    return G.detect_cycles(df, "company_core_id", "parent_company_id", max_depth=depth).collect()


def test_cycles_found(spark):
    rows = _cycles(spark, [("A", "B"), ("B", "A"), ("C", "D"), ("D", "E"), ("F", "F")])
    assert {frozenset(r.path) for r in rows} == {frozenset({"A", "B"}), frozenset({"F"})}
    assert all(len(r.path) == r.depth + 1 for r in rows)
    assert len(rows) == 3  # A>B>A, B>A>B, F>F


def test_cycle_depth_limit_and_null(spark):
    assert _cycles(spark, [("A", "B"), ("B", "C"), ("C", "A")], depth=1) == []
    assert _cycles(spark, [("A", None)]) == []


def test_self_parenting(spark):
    df = spark.createDataFrame([("101", "101", "x"), ("999", "100", "y"), (None, None, "z"), ("", "5", "w")],
                               "company_core_id string, parent_company_id string, other_col string")
    out = BS.self_parenting(df, "company_core_id", "parent_company_id").collect()
    assert [r.company_core_id for r in out] == ["101"]


def test_path_endpoints(spark):
    df = spark.createDataFrame([("TOP.MID_MID.BOTTOM", "TOP", "BOTTOM", True),
                                ("TOP.MID_MID.BOTTOM", "BOTTOM", "TOP", False),
                                ("TOP.MID_MID.BOTTOM", "X", "BOTTOM", False),
                                (None, "TOP", "BOTTOM", False)],
                               "rel_id string, p string, c string, expected boolean")
    out = df.select("expected", BS.path_endpoints_valid(F.col("rel_id"), F.col("p"), F.col("c")).alias("ok")).collect()
    assert all(r.expected == r.ok for r in out)


@pytest.mark.parametrize("rel_id,expected", [
    ("A.B_B.C_C.D_D.E", True), ("US-100.UK-200_UK-200.JP-300", True), ("A.B", True),
    ("COMP_1", False), ("COMP_1.COMP_2_COMP_3.COMP_4", False), ("COMP_1.COMP_2-COMP_2.COMP_3", False),
    ("", False), (None, False)])
def test_path_pattern(spark, rel_id, expected):
    df = spark.createDataFrame([(rel_id,)], "rel_id string")
    assert df.select(BS.path_pattern_valid(F.col("rel_id")).alias("v")).first().v is expected


def test_all_edges_covered_worked_example(spark):
    far = None
    edges = spark.createDataFrame([
        ("A.B", 0.60, dt.date(2019, 1, 1), dt.date(2020, 1, 1)), ("A.B", 0.55, dt.date(2020, 1, 1), far),
        ("B.C", 0.80, dt.date(2018, 6, 1), dt.date(2019, 6, 1)), ("B.C", 0.70, dt.date(2019, 6, 1), dt.date(2020, 3, 1)),
        ("B.C", 0.65, dt.date(2020, 3, 1), far)], "pair_rel_id string, percentage double, f date, t date")
    edges = T.standardize_intervals(edges, "f", "t")
    paths = spark.createDataFrame([("A.B_B.C", "A.B"), ("A.B_B.C", "B.C")], "path_id string, pair_rel_id string")
    cov = T.all_covered_segments(paths, "path_id", "pair_rel_id", edges, "pair_rel_id", "f", "t")
    got = (cov.groupBy("seg_start").agg(F.round(F.product("percentage"), 4).alias("p"))
              .orderBy("seg_start").collect())
    assert [(r.seg_start.date(), r.p) for r in got] == [
        (dt.date(2019, 1, 1), 0.48), (dt.date(2019, 6, 1), 0.42), (dt.date(2020, 1, 1), 0.385),
        (dt.date(2020, 3, 1), 0.3575)]


def test_parse_path_drops_consecutive_duplicates(spark):
    df = spark.createDataFrame([("A.B_B.C_C.D",), ("A",)], "rel_id string")
    chain, pairs = G.parse_path(F.col("rel_id"))
    out = df.select(chain.alias("c"), pairs.alias("p")).collect()
    assert out[0].c == ["A", "B", "C", "D"] and out[0].p == ["A.B", "B.C", "C.D"]
    assert out[1].c == ["A"] and out[1].p == []
