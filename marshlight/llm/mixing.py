"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks.

Slot k of the schedule takes the golden-ratio point of k; the point falls into the interval of one source. The
r-th slot of a source takes the r-th block of its shuffled documents, so after any number of slots each source has
had its share but for a few blocks. Offsets and ranks are prefix sums in two steps, over buckets and inside a bucket,
so neither a source nor a stretch of slots is ever one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .text import word_count

WEIGHTS = (5, 2, 1)
GOLDEN = 2654435769  # 2^32 divided by the golden ratio
CELLS = 4096


def slot_point(k: Column) -> Column:
    """Golden-ratio point of slot k as an integer below 2^32; the sequence starts anew after 2^31 slots."""
    return ((k % (1 << 31)) * F.lit(GOLDEN)) % (1 << 32)


def running_start(df: DataFrame, group: list[str], bucket: str, order: list[str], size: Column, name: str) -> DataFrame:
    """`df` with the sum of `size` over the rows before each row of its group, by bucket and then `order`."""
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    sums = df.groupBy(*group, bucket).agg(F.sum(size).alias("_sum"))
    across = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, bucket, F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_before"))
    right = sums.toDF(*[f"_{c}" for c in [*group, bucket]], "_before")
    on = [rows[c].eqNullSafe(right[f"_{c}"]) for c in [*group, bucket]]
    return rows.join(right, on).select(*df.columns, (F.col("_in") + F.col("_before")).alias(name))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, weight, target of each source of (source, size).

    Sources in order of code point, null last, take the weights in turn. They divide `share` of all words by weight; a target
    ends at `most` times its source's size and what is over is divided by weight again, until no target is above.
    Each round brings two sums to the driver.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    table = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    table = stage(table.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)))
    cap = most * F.col("source_size")
    goal = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, None
    while True:
        held = cap < level * F.col("weight")
        n, caps, free = table.agg(
            F.count(F.when(held, 1)), F.coalesce(F.sum(F.when(held, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~held, F.col("weight"))), F.lit(0))).first()
        if n == full or not free:
            break
        full, level = n, (goal - caps) / free
    return table.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")).cast("double"))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """(source, rank, k): slots in order k, each with its source and its rank among that source's slots.

    A tenth more slots than the targets need are drawn, and the slots a source does not need are left out; what
    a source still lacks follows after the last point, so every source has its slots whatever their number.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target"), F.count("*")).first()
    points = int(total[0] / block * 1.1) + 8 if total[0] else 0
    words, size = F.round("target").cast("long"), F.col("source_size")
    slots = F.floor(words / size) * F.ceil(size / block) + F.ceil(words % size / block)  # the last block of a pass is shorter
    needed = targets.where(F.col("target") >= 0.5).withColumn("slots", slots)
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)  # one row a source
    edges = (
        needed.withColumn("high", F.floor(F.sum("target").over(upto) / F.lit(total[0] or 1.0) * (1 << 32)).cast("long"))
        .withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy(F.col("source").asc_nulls_last())), F.lit(0)))
        .where(F.col("low") < F.col("high")))
    width = (1 << 32) // CELLS
    cells = edges.select("source", "slots", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
    slots = spark.range(points).select(F.col("id").alias("k"), slot_point(F.col("id")).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") / width))
    drawn = slots.join(cells, "cell").where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    drawn = drawn.select("source", "slots", "k", F.shiftright("k", 16).alias("stretch"))
    ranked = running_start(stage(drawn), ["source"], "stretch", ["k"], F.lit(1), "rank")
    ranked = stage(ranked.where(F.col("rank") < F.col("slots")).select("source", F.col("rank").cast("long").alias("rank"), "k"))
    had = ranked.groupBy("source").agg(F.count("*").alias("had")).withColumnRenamed("source", "_source")
    lacking = needed.join(had, needed["source"].eqNullSafe(had["_source"]), "left").select(
        "source", F.coalesce("had", F.lit(0)).alias("had"), "slots").where(F.col("had") < F.col("slots"))
    rest = lacking.select("source", F.explode(F.sequence("had", F.col("slots") - 1)).alias("rank"))
    return ranked.unionByName(rest.withColumn("k", points + F.col("rank")))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = 256) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of `docs`: the words of it that the mix holds.

    A size is the number of words between \\x20 and \\x09-\\x0D. Each source's documents are put in the order of the md5 of their
    id and cut into blocks of `block` words; its last block is shorter. The schedule deals the blocks, a second
    time once all were dealt, until the source's target (rounded) is met, in part of a block if need be.

    A null source is a source, the last one. Null and empty texts have size 0 and are never taken. Repeated rows are documents
    of their own, a null doc_id counts as the empty text; other columns are ignored. An empty table gives an
    empty table; if no text has words, targets and taken are 0.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = stage(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), F.xxhash64("text").alias("text_hash"))
        .withColumn("bucket", F.substring("key", 1, 3)))
    targets = source_targets(sized, weights, share, most)
    placed = stage(running_start(sized.where("size > 0"), ["source"], "bucket", ["key", "text_hash"], F.col("size"), "at"))
    of = targets.select(F.col("source").alias("_source"), "source_size", "target")
    # One row for each block of a source that is dealt: how far into it the first and the second pass read.
    slots = schedule(targets, block).join(of, F.col("source").eqNullSafe(F.col("_source")))
    blocks = F.ceil(F.col("source_size") / block)
    slots = slots.withColumn("pass", F.floor(F.col("rank") / blocks)).withColumn("block", F.col("rank") % blocks)
    begin = F.col("pass") * F.col("source_size") + F.col("block") * block
    dealt = slots.withColumn("reach", F.least(F.lit(block), F.round("target").cast("long") - begin))
    dealt = dealt.groupBy("_source", "block").agg(*[F.coalesce(F.max(F.when(F.col("pass") == p, F.col("reach"))), F.lit(0)).alias(f"reach{p}") for p in (0, 1)])
    dealt = dealt.withColumnRenamed("block", "_block")
    parts = placed.select("source", "at", "size", F.explode(F.sequence(
        F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))).alias("block"))
    low = F.greatest(F.col("at") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("at") + F.col("size") - F.col("block") * block, F.lit(block))
    read = lambda reach: F.greatest(F.least(high, reach) - low, F.lit(0))
    taken = (
        parts.join(dealt, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
        .groupBy("source", "at").agg(F.sum(read(F.col("reach0")) + read(F.col("reach1"))).alias("taken"))
        .toDF("_source", "_at", "taken"))
    met = placed.join(taken, placed["source"].eqNullSafe(taken["_source"]) & (placed["at"] == taken["_at"]), "left")
    rows = met.select("doc_id", "source", "size", "taken").unionByName(
        sized.where("size = 0").select("doc_id", "source", "size", F.lit(0).alias("taken")))
    return rows.join(of, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
