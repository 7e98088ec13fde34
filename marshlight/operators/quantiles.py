"""Exact quantiles of groups without a size bound.

Spark's `percentile` holds all distinct values of a group in one task. That is right for a facility's
monthly series, which has one value per month, and wrong for a national column. Here the values are staged,
so the facts are read once; approximate quantiles a little below and above each wanted one cut them into
buckets, and only the narrow buckets that contain a wanted rank are counted and sorted. The approximation
decides how narrow they are, not the result. No step moves more than counts, edges and those buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

ACCURACY = 8192  # of the edges: a bucket around a rank has about 6 / ACCURACY of a group's values


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Columns `keys`, `prob`, `quantile` (linear interpolation); missing values are left out."""
    keys = list(keys)
    v = F.col(value).cast("double")
    rows = stage(df.filter(v.isNotNull()).select(*keys, v.alias("_v")))
    around = sorted({min(max(p + off, 0.0), 1.0) for p in probs for off in (-2 / ACCURACY, 2 / ACCURACY)})
    # Staged, so the real size decides how they are joined.
    edges = stage(rows.groupBy(*keys).agg(F.percentile_approx("_v", around, ACCURACY).alias("_e")))
    if keys:
        placed = rows.join(edges, keys)
    else:
        placed = rows.withColumn("_e", edges.select("_e").scalar())
    # How many edges lie below the value.
    below = sum(((F.get("_e", F.lit(i)) < F.col("_v")).cast("int") for i in range(len(around))), F.lit(0))
    placed = placed.select(*keys, "_v", below.alias("_b"))
    # At most one row per edge and one more reach this window for each group.
    per_bucket = placed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    order = Window.partitionBy(*keys).orderBy("_b")
    per_bucket = per_bucket.withColumn(
        "_before", F.sum("_bn").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_bn")
    ).withColumn("_total", F.sum("_bn").over(Window.partitionBy(*keys)))
    wanted = F.transform(
        F.array(*[F.lit(float(p)) for p in probs]),
        lambda p: F.struct(p.alias("prob"), (p * (F.col("_total") - 1)).alias("at")),
    )
    # A bucket is needed if it holds the rank below or above a wanted position.
    hit = F.filter(
        wanted,
        lambda w: (F.ceil(w["at"]) >= F.col("_before")) & (F.floor(w["at"]) < F.col("_before") + F.col("_bn")),
    )
    needed = stage(per_bucket.withColumn("_w", hit).filter(F.size("_w") > 0).select(*keys, "_b", "_before", "_w"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v")
    counts = placed.join(needed.select(*keys, "_b"), [*keys, "_b"], "left_semi").groupBy(*keys, "_b", "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = counts.join(needed, [*keys, "_b"]).withColumn(
        "_end", F.col("_before") + F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    hits = ranked.select(*keys, "_v", "_n", "_end", F.explode("_w").alias("w"))
    start = F.col("_end") - F.col("_n")
    low, high = F.floor("w.at"), F.ceil("w.at")
    out = hits.groupBy(*keys, F.col("w.prob").alias("prob"), F.col("w.at").alias("_at")).agg(
        F.max(F.when((low >= start) & (low < F.col("_end")), F.col("_v"))).alias("_low"),
        F.max(F.when((high >= start) & (high < F.col("_end")), F.col("_v"))).alias("_high"),
    )
    out = out.withColumn(
        "quantile", F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_at") - F.floor("_at"))
    )
    return out.select(*keys, "prob", "quantile")
