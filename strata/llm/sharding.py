"""Sharding by jump consistent hashing, native.

A key walks a sequence of jumps b0 = 0 < b1 < b2 < ...; its shard among ``n`` is the last
jump below ``n``. The next jump after ``b`` is ``floor((b + 1) / u)`` with ``u`` uniform in
(0, 1] drawn from the key and ``b`` alone, so the sequence does not depend on ``n``: one
more shard takes 1/(n+1) of the keys, all into itself, and no ring table is kept.

Cases: null keys hash as the empty string with a marker of their own and share one shard;
equal keys share a shard whatever the other columns (law ``key``); null or empty texts count
no bytes (crc32 0); ties in the slot order are broken by crc32 and size, after which rows are interchangeable;
an empty table gives an empty table; an input column named like an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import md5_int, without

#: Sub-ranges of a shard's slot order, numbered on their own and then offset.
SLOT_BUCKETS = 4096


def key_text(key) -> F.Column:
    return F.when(key.isNull(), F.lit("\u0000null")).otherwise(key.cast("string"))


def jump_shard(key, shards: int) -> F.Column:
    """Shard of ``key`` (a string column) among ``shards``: a fold over at most ``shards``
    jumps whose later steps are idle once a jump has passed the end."""
    if shards < 1:
        raise ValueError("at least one shard")

    def step(state, _):
        done = state["nxt"] >= shards
        draw = md5_int(F.md5(F.concat_ws(":", key, state["nxt"].cast("string"))), 8)
        jump = F.floor((state["nxt"] + 1) * (F.lit(4294967296.0) / (draw + 1))).cast("long")
        return F.when(done, state).otherwise(F.struct(state["nxt"].alias("at"), jump.alias("nxt")))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("nxt"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), zero, step, lambda s: s["at"]).cast("int")


def assign_shards(df: DataFrame, key_col: str, shards: int, out: str = "shard") -> DataFrame:
    """``df`` with ``out``: the shard of the key; no shuffle."""
    base = without(df, [out])
    return base.withColumn(out, jump_shard(key_text(F.col(f"`{key_col}`")), shards))


def number_slots(df: DataFrame, group: str, order: list, bucket) -> DataFrame:
    """``df`` with ``slot``: a gapless number from 0 in each ``group``, ordered by ``bucket`` (a
    long that ``order``'s leading part decides) and ``order``. Rows are numbered inside (group,
    bucket) and offset by a running count over buckets, so no group meets in one task."""
    b = without(df, ["slot", "__bucket"]).withColumn("__bucket", bucket)
    counts = b.groupBy(group, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "__bucket",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    ranked = b.withColumn("slot", F.row_number().over(inside) - 1)
    return (ranked.join(offsets, [group, "__bucket"])
            .withColumn("slot", F.col("slot") + F.col("__offset")).drop("__bucket", "__offset"))


def shard_documents(docs: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row. Only the key, the
    byte count and the checksum are shuffled, never the text."""
    key, text = F.col(f"`{key_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(
        key.alias(key_col),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"))
    rows = assign_shards(rows, key_col, shards)
    rows = assign_shards(rows, key_col, shards + 1, "grown_shard")
    rank = F.md5(F.concat_ws(":", F.lit("slot"), key_text(F.col(f"`{key_col}`"))))
    rows = number_slots(rows, "shard", [rank, "text_crc32", "size"], md5_int(rank, 3) % SLOT_BUCKETS)
    return rows.select(key_col, "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"),
                       "grown_shard")
