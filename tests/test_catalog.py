"""Small operators around tables: comments, views, findings, constraints, gates."""

import pytest
from pyspark.sql import functions as F

from strata.functions.text import bounded_ts
from strata.operators import bespoke as BS
from strata.operators import dq as DQ
from strata.session import checkpoint_dir, scratch_path
from strata.sources import ingest as I
from strata.sources import sinks as SK


def test_comments_land_in_the_metadata(spark):
    out = I.attach_comments(spark.range(1), {"id": {"description": {"comment": "key", "unit": "-"}}})
    assert out.schema["id"].metadata == {"comment": "key", "unit": "-"}


def test_view_is_replaced(spark):
    SK.publish_view(spark.range(1), "v_test")
    SK.publish_view(spark.range(3), "v_test")
    assert spark.table("v_test").count() == 3


def test_findings_are_written_and_emptied(spark):
    path = scratch_path(spark, "issues")
    df = spark.range(2)
    assert SK.write_issues(df, path) and spark.read.parquet(path).count() == 2
    assert not SK.write_issues(df.where("id > 5"), path) and spark.read.parquet(path).count() == 0


def test_constraints_are_parsed(spark):
    df = spark.createDataFrame([("t", "PRIMARY KEY (a)"), ("t", "FOREIGN KEY (b) REFERENCES db.u (c)")], "t string, c string")
    rows = [tuple(r) for r in BS.pk_fk_constraints(df, "t", "c").collect()]
    assert rows == [("t", "PK", "a", None, None), ("t", "FK", "b", "db.u", "c")]


def test_gates_raise(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception):
        DQ.assert_unique(df, ["k"])
    DQ.assert_unique(df, ["v"], [["k", "v"]])
    with pytest.raises(ValueError):
        BS.assert_grain(df, ["k"])
    assert BS.assert_grain(df, ["k", "v"]).count() == 2


def test_timestamps_out_of_bounds_are_null(spark):
    df = spark.sql("SELECT timestamp'1850-01-01' AS a, timestamp'2020-01-01' AS b")
    r = df.select(bounded_ts(F.col("a")).alias("a"), bounded_ts(F.col("b")).alias("b")).first()
    assert r.a is None and r.b is not None


def test_variant_schema_of_odd_payloads(spark):
    parse = lambda *docs: spark.createDataFrame([(x,) for x in docs], "j string").select(F.parse_json("j").alias("v"))
    assert I.infer_variant_schema(parse('{"a": 1}', '{"b": "x"}'), "v").startswith("STRUCT<")
    assert I.infer_variant_schema(parse("{}"), "v") == "STRUCT<>"
    with pytest.raises(ValueError):
        I.infer_variant_schema(parse("[1]"), "v")


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
