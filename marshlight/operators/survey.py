"""Survey estimates with design-based confidence intervals.

Microdata are reduced to one row per (domain, stratum, cluster) in one aggregation; all variance work runs
on those rows. The stratum sizes count every cluster of the design, also those without a member in the
domain: their scores are zero, so they enter through the cluster count alone and are never materialised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import ratio

Z95 = 1.959963984540054  # fixed value: normal quantile at 0.975


def domain_means(df: DataFrame, y: Sequence[str], domain: str, weight: str, cluster: str,
                 stratum: str) -> DataFrame:
    """Long table (domain, indicator, estimate, se): weighted mean and linearised standard error.

    With z = w (y - mean) / sum(w) for members of the domain and 0 elsewhere, the variance is
    sum over strata of n/(n-1) * sum over clusters (z_c - mean z)^2. A stratum with one cluster adds 0.
    """
    w, place = F.col(weight), ["domain", "stratum", "cluster"]
    sums = []
    for i, c in enumerate(y):
        v = F.col(c).cast("double")
        sums += [F.count(v).alias(f"_n{i}"), F.sum(F.when(v.isNotNull(), w)).alias(f"_w{i}"), F.sum(w * v).alias(f"_wy{i}")]
    per_cluster = df.filter(F.col(domain).isNotNull()).groupBy(
        F.col(domain).alias("domain"), F.col(stratum).alias("stratum"), F.col(cluster).alias("cluster")).agg(*sums)
    # Only rows of clusters are unfolded by indicator, never the microdata.
    values = F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(f"_n{i}").alias("n"), F.col(f"_w{i}").alias("sw"), F.col(f"_wy{i}").alias("swy"))
                       for i, c in enumerate(y)])
    cells = per_cluster.select(*place, F.explode(values).alias("v")).filter("v.n > 0").select(*place, "v.indicator", "v.sw", "v.swy")
    means = cells.groupBy("domain", "indicator").agg(F.sum("sw").alias("W"), F.sum("swy").alias("WY"))
    means = means.withColumn("estimate", ratio("WY", "W"))
    design = df.select(F.col(stratum).alias("stratum"), F.col(cluster).alias("cluster")).distinct()
    design = design.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    z = ratio(F.col("swy") - F.col("estimate") * F.col("sw"), F.col("W"))
    scored = cells.join(means, ["domain", "indicator"]).withColumn("z", z)
    strata = scored.groupBy("domain", "indicator", "stratum").agg(
        F.sum("z").alias("sz"), F.sum(F.col("z") * F.col("z")).alias("szz")
    ).join(design, "stratum")
    spread = F.greatest(F.col("szz") - F.col("sz") * F.col("sz") / F.col("n"), F.lit(0.0))
    part = F.when(F.col("n") > 1, F.col("n") / (F.col("n") - 1) * spread).otherwise(0.0)
    variance = strata.groupBy("domain", "indicator").agg(F.sqrt(F.sum(part)).alias("se"))
    return means.select("domain", "indicator", "estimate").join(variance, ["domain", "indicator"])


def percent_interval(estimates: DataFrame) -> DataFrame:
    """95 % limits clipped to [0, 1], all three as percentages."""
    low = F.greatest(F.col("estimate") - Z95 * F.col("se"), F.lit(0.0))
    high = F.least(F.col("estimate") + Z95 * F.col("se"), F.lit(1.0))
    return estimates.select(
        "domain", "indicator",
        (F.col("estimate") * 100).alias("SAMPLE_AVERAGE"),
        (low * 100).alias("CI_LOWER_BOUND"),
        (high * 100).alias("CI_UPPER_BOUND"),
    )


def indicator_table(df: DataFrame, y: Sequence[str], admin: DataFrame, domain: str = "ADM1_NAME",
                    weight: str = "wt", cluster: str = "V021", stratum: str = "V023",
                    how: str = "left") -> DataFrame:
    """One row per region and three columns per indicator, regions matched by name."""
    long = percent_interval(domain_means(df, y, domain, weight, cluster, stratum))
    cells = [
        F.max(F.when(F.col("indicator") == name, F.col(col))).alias(f"{name.upper()}_{col}")
        for name in y
        for col in ("SAMPLE_AVERAGE", "CI_LOWER_BOUND", "CI_UPPER_BOUND")
    ]
    wide = long.groupBy(F.col("domain").alias(domain)).agg(*cells)
    return admin.join(wide, domain, how)


# Under-five age segments in months, closed at the left.
AGE_SEGMENTS = [(0, 1), (1, 3), (3, 6), (6, 12), (12, 24), (24, 36), (36, 48), (48, 60)]


def segment_sums(window: int = 120, interview: str = "V008", born: str = "B3", died_at: str = "B7",
                 weight: str = "V005") -> list[Column]:
    """Aggregates e0, d0, e1, ...: weighted exposure and deaths of births by age segment (synthetic cohort method).

    A cohort that lives through a segment wholly inside the window counts fully; one that enters before
    the window or leaves after it counts half. A death counts with its cohort's share, and in full at the
    end of the window. All segments are sums over the births as they are, so no birth is unfolded.
    """
    end = F.col(interview)                 # last month of the window is the one before the interview
    start = end - window
    w, age = F.col(weight) / 1e6, F.col(died_at)
    sums = []
    for i, (low, high) in enumerate(AGE_SEGMENTS):
        enter, leave = F.col(born) + low, F.col(born) + high  # first month in the segment, first month after it
        full = (enter >= start) & (leave <= end)
        early = (enter < start) & (leave > start) & (leave <= end)
        late = (enter >= start) & (enter < end) & (leave > end)
        alive = age.isNull() | (age >= low)
        dies = (age >= low) & (age < high)
        sums.append(F.sum(F.when(alive & full, w).when(alive & (early | late), w * 0.5).otherwise(0.0)).alias(f"e{i}"))
        sums.append(F.sum(F.when(dies & (full | late), w).when(dies & early, w * 0.5).otherwise(0.0)).alias(f"d{i}"))
    return sums


def _death_probability(seg_deaths: Column, seg_exposure: Column) -> Column:
    return 1 - F.coalesce(ratio(seg_deaths, seg_exposure), F.lit(0.0))


def under_five_mortality(births: DataFrame, domain: str = "V024", cluster: str = "V021",
                         window: int = 120) -> DataFrame:
    """Deaths under five per 1000 births by region, with a delete-one-cluster jackknife interval.

    Cluster totals are subtracted from region totals: every replicate is a row of eight sums, and the
    births are read once.
    """
    n_seg = len(AGE_SEGMENTS)
    per_cluster = births.groupBy(domain, cluster).agg(*segment_sums(window))
    exposed = F.lit(0.0)
    for i in range(n_seg):
        exposed = exposed + F.col(f"e{i}")
    per_cluster = per_cluster.filter(exposed > 0)  # clusters without a birth in the window are no replicate
    total = per_cluster.groupBy(domain).agg(
        F.count(F.lit(1)).alias("k"),
        *[F.sum(f"{c}{i}").alias(f"t{c}{i}") for i in range(n_seg) for c in "de"],
    )

    def rate(deaths: list[Column], exposure: list[Column]) -> Column:
        survive = F.lit(1.0)
        for d, e in zip(deaths, exposure):
            survive = survive * _death_probability(d, e)
        return (1 - survive) * 1000

    total = total.withColumn("R", rate([F.col(f"td{i}") for i in range(n_seg)],
                                       [F.col(f"te{i}") for i in range(n_seg)]))
    left_out = per_cluster.join(total, domain).withColumn("r_i", rate(
        [F.col(f"td{i}") - F.col(f"d{i}") for i in range(n_seg)],
        [F.greatest(F.col(f"te{i}") - F.col(f"e{i}"), F.lit(0.0)) for i in range(n_seg)],
    ))
    pseudo = F.col("k") * F.col("R") - (F.col("k") - 1) * F.col("r_i")
    se = F.sqrt(ratio(F.sum((pseudo - F.col("R")) * (pseudo - F.col("R"))), F.first("k") * (F.first("k") - 1)))
    out = left_out.groupBy(domain, "R").agg(se.alias("se"))
    return out.select(domain, "R", "se", F.greatest(F.col("R") - 1.96 * F.col("se"), F.lit(0.0)).alias("LCI"),
                      (F.col("R") + 1.96 * F.col("se")).alias("UCI"))
