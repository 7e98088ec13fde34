"""Line dedup: repeated lines found from hashes alone, returned as compressed keep bitmaps per document.

Lines travel as (hash, document, position). They are partitioned by ranges of the hash and sorted by document
and position within; a window over that order marks first occurrences and counts documents as it passes. A hash
that a third of all documents share is split by a salt of the document, and what the salted runs found is added up.
Text is only touched at both ends: to make hashes and to apply a bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .text import SPACES, ascii_lower

SALTS = 64


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without \\x20 and \\x09-\\x0D at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has `min_chars` characters or more: two 64-bit hashes, document, position."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    key = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return key.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"), "doc_id", "text_hash", "pos")


def mark_lines(lines: DataFrame) -> DataFrame:
    """`lines` in ranges of their hash, with new_doc (first of its document) and first (first of the salted hash)."""
    key = ["h1", "h2", "salt"]
    order = Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_first(), "text_hash", "pos")
    before = F.lag(F.struct("doc_id")).over(order)
    return lines.repartitionByRange(*key).withColumns({
        "first": before.isNull(), "new_doc": before.isNull() | ~before["doc_id"].eqNullSafe(F.col("doc_id"))})


def drop_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(doc_id, text_hash, runs, n_dropped) of documents that lose lines; runs are [start, length] of dropped lines.

    A key found in `min_docs` documents or more loses its lines in every document; with `keep_first` the first
    line in order of document and position stays. The runs are a run-length coded bitmap of the document's lines.
    """
    marked = stage(mark_lines(line_table(docs, min_chars)))
    salted = marked.groupBy("h1", "h2", "salt").agg(
        F.sum(F.col("new_doc").cast("long")).alias("n"),
        F.min(F.when(F.col("first"), F.struct("doc_id", "text_hash", "pos"))).alias("at"))
    whole = salted.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min("at").alias("at")).where(F.col("n") >= min_docs)
    # Staged, so that Spark knows its size: a small one is broadcast, with a large one a hot hash is a skewed join it splits.
    common = stage(whole.select("h1", "h2", "at"))
    lost = marked.join(common, ["h1", "h2"])
    if keep_first:
        lost = lost.where(~F.struct("doc_id", "text_hash", "pos").eqNullSafe(F.col("at")))
    p = F.col("at_pos")
    starts = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
    ends = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
    return (
        lost.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("at_pos"))
        .select("doc_id", "text_hash", F.zip_with(starts, ends, lambda a, b: F.struct(
            a.alias("start"), (b - a + 1).alias("length"))).alias("runs"), F.size("at_pos").cast("long").alias("n_dropped"))
    )


def kept_lines(lines: Column, runs: Column) -> Column:
    """The lines outside the dropped runs, joined by \\n."""
    n = F.size(runs)
    before = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["start"] + F.get(runs, i - 1)["length"]).alias("start"),
        F.when(i == n, F.size(lines)).otherwise(F.get(runs, i)["start"]).alias("end")))
    parts = F.transform(before, lambda r: F.slice(lines, r["start"] + 1, r["end"] - r["start"]))
    return F.array_join(F.flatten(parts), "\n")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text (what is kept), was_text, n_lines, n_dropped, runs and the asked-for `columns` of every row of `docs`.

    A null or empty text is one empty line, whose key is too short to be dropped (was_text is false for null). A text that loses
    every line becomes empty. Rows with the same doc_id count as one document and are judged each; repeated rows and a
    null doc_id stay. Columns that are not asked for are ignored; an empty table gives an empty table.
    """
    found = drop_bitmaps(docs.select("doc_id", "text"), min_docs, min_chars, keep_first).toDF("_doc_id", "_text_hash", "_runs", "_dropped")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), *columns)
    lines = split_lines(F.col("text"))
    kept = F.when(F.col("_runs").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept_lines(lines, F.col("_runs")))
    return keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_hash") == F.col("_text_hash")), "left").select(
        "doc_id", kept.alias("text"), F.col("text").isNotNull().alias("was_text"), F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("_runs", F.array()).alias("runs"), *columns)
