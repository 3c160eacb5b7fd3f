"""Mixing sources to target weights, native.

Target words per source come from water-filling (weights share the total; a target stops at
``max_repeat`` times its source's size, the excess goes to the others by weight). A
low-discrepancy schedule orders the mix: slot ``i`` is the golden-ratio point
``frac(i * 0.618...)`` read through the cumulative targets, and its rank among its source's
slots names the block of the source it takes. A source's documents stand in hashed order,
repeated while the target lasts, cut into blocks of equal tokens.

Slots past a source's last block are dropped and blocks that the finite schedule left without
a slot are appended at its end, so every source gives exactly ``floor(target)`` words.

Cases: null text has size 0, takes nothing and is still returned; null sources form one source,
sorted last; ties in hashed order are broken by id and size, after which rows are
interchangeable; an empty table gives an empty table; other input columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import md5_int, n_words, written

GOLDEN = 0.6180339887498949
#: Sub-ranges of a source's hashed order; a hot source is summed range by range.
ORDER_BUCKETS = 4096
#: Consecutive slots that are ranked together before their counts are offset.
SEGMENT = 1 << 16


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeat: int) -> DataFrame:
    """(source, source_size, target, lo, hi) from (source, source_size): one row per source.
    ``lo``..``hi`` is the source's share of [0, 1) in the schedule.

    Water-filling in one window pass: in order of cap / weight, a source is full when its cap
    lies below the level that the words and weights left over would give it."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = (sizes.withColumn("w", cycle[(F.row_number().over(by_name) - 1) % len(weights)])
         .withColumn("cap", F.lit(max_repeat) * F.col("source_size"))
         .withColumn("total", total))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / F.sum("w").over(after))
    s = s.withColumn("full", F.col("cap") <= F.col("level") * F.col("w"))
    # full sources are a prefix of that order, and levels fall after the first open one
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy())
    s = s.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(common * F.col("w")))
    run = by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_targets = F.sum("target").over(Window.partitionBy())
    hi = F.try_divide(F.sum("target").over(run), all_targets)
    upto = F.coalesce(F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    lo = F.try_divide(upto, all_targets)
    return s.select("source", F.col("source_size").cast("long").alias("source_size"), "target",
                    lo.alias("lo"), hi.alias("hi"))


def schedule(targets: DataFrame, block_tokens: int) -> DataFrame:
    """(source, block, slot, length): which slot of the mix takes which block of which source.

    Points are matched to sources by an equi-join on grid cells with the exact bounds as
    residual; ranks are counted per segment of slots and offset, so a source that owns most
    slots is never ranked in one task."""
    cells = 1024
    t = targets.where(F.floor("target") > 0).withColumn("blocks", F.ceil(F.floor("target") / block_tokens))
    slots = t.agg(F.sum("blocks")).first()[0] or 0  # one number
    points = (targets.sparkSession.range(slots).select(F.col("id").alias("slot"))
              .withColumn("segment", F.floor(F.col("slot") / SEGMENT))
              .withColumn("u", F.col("slot") * GOLDEN - F.floor(F.col("slot") * GOLDEN))
              .withColumn("cell", F.floor(F.col("u") * cells)))
    owners = t.select("source", "blocks", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))).alias("cell"))
    hits = (points.join(owners, "cell")
            .where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
            .select("source", "blocks", "segment", "slot"))
    counts = hits.groupBy("source", "segment").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source", "segment", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = (hits.withColumn("r", F.row_number().over(Window.partitionBy("source", "segment").orderBy("slot")) - 1)
              .join(offsets.withColumnRenamed("source", "o").withColumnRenamed("segment", "s"),
                    F.col("source").eqNullSafe(F.col("o")) & (F.col("segment") == F.col("s")))
              .withColumn("block", F.col("r") + F.col("offset"))
              .where(F.col("block") < F.col("blocks")).select("source", "block", "slot"))
    # blocks without a slot go to the end of the schedule, block by block
    had = counts.groupBy("source").agg(F.sum("n").alias("had"))
    late = (t.join(had.withColumnRenamed("source", "o"), F.col("source").eqNullSafe(F.col("o")), "left")
            .withColumn("had", F.coalesce("had", F.lit(0)))
            .where(F.col("had") < F.col("blocks"))
            .select("source", F.explode(F.sequence(F.col("had"), F.col("blocks") - 1)).alias("block"))
            .select("source", "block", (F.lit(slots) + F.col("block")).alias("slot")))
    every = ranked.select("source", "block", F.col("slot").cast("long").alias("slot")).unionByName(
        late.select("source", "block", F.col("slot").cast("long").alias("slot")))
    limits = targets.select(F.col("source").alias("o"), F.floor("target").alias("words"))
    return (every.join(limits, F.col("source").eqNullSafe(F.col("o")))
            .select("source", F.col("block").cast("long").alias("block"), "slot",
                    F.least(F.lit(block_tokens), F.col("words") - F.col("block") * block_tokens)
                    .cast("long").alias("length")))


def positions(sized: DataFrame) -> DataFrame:
    """(id, source, size, start): where a document's words begin in its source's hashed order.
    Prefix sums run inside (source, hash range) and are offset by a sum over ranges."""
    h = F.md5(F.concat_ws(":", F.lit("mix"), F.col("id").cast("string")))
    d = sized.withColumn("h", h).withColumn("bucket", md5_int(F.col("h"), 3) % ORDER_BUCKETS)
    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("o"), F.col("bucket").alias("b"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("source", "bucket").orderBy("h", "id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (d.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(offsets, F.col("source").eqNullSafe(F.col("o")) & (F.col("bucket") == F.col("b")))
            .select("id", "source", "size", (F.col("inner") + F.col("offset")).alias("start")))


def pieces(placed: DataFrame, targets: DataFrame, block_tokens: int) -> DataFrame:
    """(id, source, size, start, block, piece): the words of each document that each block of
    its source's repeated order holds, up to the target."""
    t = targets.select(F.col("source").alias("o"), "source_size", F.floor("target").alias("words"))
    d = placed.where("size > 0").join(t, F.col("source").eqNullSafe(F.col("o"))).where("start < words")
    d = d.withColumn("lap", F.explode(F.sequence(F.lit(0).cast("long"),
                                                 F.floor((F.col("words") - 1 - F.col("start")) / F.col("source_size")))))
    d = (d.withColumn("a", F.col("start") + F.col("lap") * F.col("source_size"))
         .withColumn("z", F.least(F.col("a") + F.col("size"), F.col("words"))))
    d = d.withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / block_tokens),
                                                   F.floor((F.col("z") - 1) / block_tokens))))
    piece = (F.least(F.col("z"), (F.col("block") + 1) * block_tokens)
             - F.greatest(F.col("a"), F.col("block") * block_tokens))
    return d.select("id", "source", "size", "start", "lap", F.col("block").cast("long").alias("block"),
                    piece.cast("long").alias("piece"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3, block_tokens: int = 64,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized, targets, plan): the documents with their place, one row per source, and the mix
    itself as (slot, source, block, id, start, lap, piece): which words of which document each
    slot takes. ``sized`` is written once to the shared scratch folder and read thrice."""
    sized = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                        n_words(F.col(f"`{text_col}`")).alias("size"))
    sized = written(sized, "mix-sizes")
    targets = written(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                                     weights, max_repeat), "mix-targets")
    placed = positions(sized)
    slots = schedule(targets, block_tokens)
    cut = pieces(placed, targets, block_tokens)
    s = slots.select(F.col("source").alias("o"), F.col("block").alias("b"), "slot")
    plan = (cut.join(s, F.col("source").eqNullSafe(F.col("o")) & (F.col("block") == F.col("b")))
            .select("slot", "source", "block", "id", "size", "start", "lap", "piece"))
    return sized, targets, plan


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(id, source, size, source_size, target, taken, first_slot, last_slot) per document: what the plan takes of it, and
    the first and last slot of the mix that holds words of it (NULL where it takes none)."""
    sized, targets, plan = mix(docs, **options)
    # a document is named by (id, source, size): rows equal in all three share their words evenly
    key = ["id", "source", "size"]
    got = plan.groupBy(*key).agg(F.sum("piece").alias("words"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    rows = sized.groupBy(*key).agg(F.count("*").alias("rows"))
    per = (rows.join(got.select(*[F.col(k).alias(f"g_{k}") for k in key], "words", "first_slot", "last_slot"),
                     F.col("id").eqNullSafe(F.col("g_id")) & F.col("source").eqNullSafe(F.col("g_source"))
                     & (F.col("size") == F.col("g_size")), "left")
           .select(*key, "rows", F.coalesce("words", F.lit(0)).alias("words"), "first_slot", "last_slot"))
    per = per.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    extra = F.when(F.col("copy") <= F.col("words") % F.col("rows"), 1).otherwise(0)
    taken = (F.floor(F.col("words") / F.col("rows")) + extra).cast("long")
    t = targets.select(F.col("source").alias("o"), "source_size", "target")
    return (per.join(t, F.col("source").eqNullSafe(F.col("o")))
            .select("id", "source", "size", "source_size", "target", taken.alias("taken"), "first_slot", "last_slot"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             **options) -> DataFrame:
    """``docs`` as the mix takes them: a document of which ``taken`` words are wanted stands in
    ``ceil(taken / size)`` equal rows, none when the mix passes it by (texts without words
    included). Rows equal in id, source and size share the group's words evenly."""
    _, _, plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    got = plan.groupBy("id", "source", "size").agg(F.sum("piece").alias("words"))
    sized = docs.withColumn("__size", n_words(F.col(f"`{text_col}`")))
    rows = (sized.where(F.col("__size") > 0).groupBy(F.col(f"`{id_col}`").alias("k"), F.col(f"`{source_col}`").alias("s"),
                                                     F.col("__size").alias("z")).agg(F.count("*").alias("rows")))
    copies = (rows.join(got, F.col("k").eqNullSafe(F.col("id")) & F.col("s").eqNullSafe(F.col("source")) & (F.col("z") == F.col("size")))
              .select("k", "s", "z", F.ceil(F.col("words") / (F.col("rows") * F.col("z"))).cast("int").alias("__copies")))
    d, c = sized.alias("__d"), copies.alias("__c")  # qualified: the input may have columns of these names
    same = (F.col(f"__d.`{id_col}`").eqNullSafe(F.col("__c.k")) & F.col(f"__d.`{source_col}`").eqNullSafe(F.col("__c.s"))
            & (F.col("__d.__size") == F.col("__c.z")))
    return (d.join(c, same).select(*[F.col(f"__d.`{x}`") for x in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__c.__copies"))).alias("__copy"))
            .drop("__copy"))
