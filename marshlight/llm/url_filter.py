"""URL filters: host and path rules found by hashed expressions, as block lists of safe browsing do it.

Each URL is unfolded into expressions, a suffix of its host with a prefix of its path. Expressions and rules
meet in an equality join on a short prefix of their digests; the full digests confirm, then precedence decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import ascii_lower

DIGEST_PREFIX = 8  # hex digits: 32 bits


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or url."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://` or url."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) triples as a table."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def expressions(urls: DataFrame, lengths: list[int], labels: int) -> DataFrame:
    """(host, path) with each suffix of at most `labels` host labels and each path prefix of the given lengths."""
    part = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(part), F.lit(labels))),
        lambda k: F.array_join(F.slice(part, -k, k), "."))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    return (
        urls.withColumn("suffix", F.explode(suffixes))
        .withColumn("length", F.explode(prefixes))
        .withColumn("prefix", F.substring(F.col("path"), F.lit(1), F.col("length")))
        .withColumn("digest", digest(F.col("suffix"), F.col("prefix")))
        .select("host", "path", "digest")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of `pages`.

    A rule fits its host and all subdomains of it if the path starts with the rule's path. The longest rule
    (characters of host and path) wins; of rules as long as each other a block wins, then the first by code
    point. Without a rule: rule null and verdict `default`.

    A null url, or one without `://`, has an empty host and path; only a rule with both empty could fit it.
    Repeated rows each get their verdict, a null page_id is kept, other columns of `pages` are ignored. Rules with a null field
    are ignored, a repeated rule counts once. Without rules, or without pages, the default or an empty table.
    """
    kept = rules.select("host", "path", "verdict").dropna().distinct()
    listed = kept.select(
        F.concat("host", "path").alias("rule"), "verdict", digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.length("path").alias("length"), F.size(F.split("host", r"\.", -1)).alias("labels"))
    # As many numbers as rule paths have different lengths, whatever the number of rules.
    lengths = sorted(r[0] for r in listed.select("length").distinct().collect())
    labels = listed.agg(F.max("labels")).first()[0]
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    if not lengths:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    short = lambda c: F.substring(c, 1, DIGEST_PREFIX)
    listed = listed.withColumn("short", short(F.col("rule_digest")))
    seen = expressions(parsed.select("host", "path").distinct(), lengths, labels).withColumn("short", short(F.col("digest")))
    best = (
        seen.join(listed, "short")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.min(F.struct(
            (-F.length("rule")).alias("shorter"), (F.col("verdict") != "block").alias("allows"), "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
