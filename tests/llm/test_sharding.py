import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm.sharding import assign_shards, shard_documents

OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), chr(0) || 'null') AS k,
         CAST(coalesce(strlen(text), 0) + 16 AS BIGINT) AS size, text FROM documents),
keys AS (SELECT DISTINCT k FROM d),
jumps AS (
  SELECT k, 0::BIGINT AS b FROM keys
  UNION ALL
  SELECT k, CAST(floor((b + 1) * (4294967296.0::DOUBLE
             / (('0x' || substr(md5(k || ':' || b), 1, 8))::BIGINT + 1))) AS BIGINT)
  FROM jumps WHERE b < 41),
home AS (SELECT k, max(b) FILTER (b < 40) AS shard, max(b) FILTER (b < 41) AS grown FROM jumps GROUP BY k)
SELECT doc_id, size, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5('slot:' || k), size) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM d JOIN home USING (k)
"""




def result(df):
    return [tuple(r) for r in df.collect()]


def test_matches_recursive_sql(spark, sf):
    """The walk of jumps, written as a recursive query in another engine."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = shard_documents(docs, 40).select("doc_id", "size", "law", "shard", "slot", "grown_shard")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(result(got)) == sorted(con.execute(OP7_SQL).fetchall())


def test_growing_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    for n in (1, 2, 7, 40, 129):
        both = assign_shards(assign_shards(df, "k", n), "k", n + 1, "grown")
        assert both.where("shard <> grown and grown <> %d" % n).count() == 0
        moved = both.where("shard <> grown").count()
        assert abs(moved - 20000 / (n + 1)) < 6 * (20000 / (n + 1)) ** 0.5 + 1
        counts = [r["count"] for r in both.groupBy("shard").count().collect()]
        assert len(counts) == n and max(counts) < 1.5 * 20000 / n + 60


def test_odd_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (None, None, "x"), (None, "b", None), (2, "", "y"), (3, "\u00e9" * 50000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = shard_documents(docs, 40).collect()
    assert len(got) == 6
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {r["size"] for r in got if r["doc_id"] == 3} == {100016}
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert sorted(r["text_crc32"] for r in got if r["doc_id"] is None) == [0, 1908338681]
    assert shard_documents(docs.where(F.lit(False)), 40).count() == 0
    with pytest.raises(ValueError):
        assign_shards(docs, "doc_id", 0)
