"""Benchmark decontamination by templates: passages are found even where numbers, names and units were replaced.

Every token that is a number, a name (it has a capital) or a unit becomes a typed placeholder; windows of canonical tokens are
joined by hash. Documents are first searched for shorter seeds, of which every window holds one at a fixed stride, so most
documents leave after a fraction of the work; the rest are searched at every place. Windows that lie on one diagonal form a
passage; those of them count whose slots are consistent, that is where each benchmark value stands for one value of the document.
A window of too many placeholders says too little as a template: it is hashed word for word, as are items shorter than a seed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

WINDOW = 8  # tokens
SEED = 5
ALONE = 2  # items of no more tokens are found only where they are the whole text
#: Words that are units of measure wherever they stand.
UNITS = ("km", "cm", "mm", "kg", "mg", "lb", "lbs", "oz", "mph", "kmh", "usd", "eur", "gbp", "percent", "meters", "metres",
         "miles", "inches", "feet", "kilograms", "grams", "pounds", "ounces", "liters", "litres", "gallons", "dollars",
         "euros", "cents", "hours", "minutes", "seconds", "days", "weeks", "months", "years")
NUMBER, NAME, UNIT = "#", "@", "%"  # no token is one of these
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|\p{L}+"


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def slot_type(token: Column) -> Column:
    """The placeholder of a token; null for a literal. A token is digits or letters, and digits sort before `:`."""
    return F.when(token < ":", NUMBER).when(F.lower(token) != token, NAME).when(token.isin(*UNITS), UNIT)


def template(tokens: Column) -> Column:
    """A hash for each token, the same for all tokens of one placeholder."""
    return F.transform(tokens, lambda t: F.xxhash64(F.coalesce(slot_type(t), t)))


def literals(template_of: Column) -> Column:
    """Number of tokens that are no placeholders."""
    for slot in (NUMBER, NAME, UNIT):
        template_of = F.array_remove(template_of, F.xxhash64(F.lit(slot)))
    return F.size(template_of)


def window_hashes(width: Column, least: Column, stride: int = 1) -> Column:
    """pos, hash, strong of all windows of `width` tokens at every `stride`-th place; none if there are fewer tokens.

    Reads the columns `tokens` and `template`. A window with `least` literals or more is strong and hashed as a template; others word
    for word. As equal words make equal templates, both sides of a match always take the same way.
    """
    last = F.size("template") - width

    def hashed(i: Column) -> Column:
        part = F.slice("template", i + 1, width)
        strong = literals(part) >= least
        return F.struct(i.alias("pos"), F.when(strong, F.xxhash64(part)).otherwise(F.xxhash64(F.slice("tokens", i + 1, width))).alias("hash"),
                        strong.alias("strong"))

    fits = (last >= 0) & ((width > ALONE) | (last == 0))
    return F.when(fits, F.transform(F.sequence(F.lit(0), last, F.lit(stride)), hashed)).otherwise(F.array())


def needed(width: Column, seed: int) -> Column:
    """Literals that make a window strong: more than half of its tokens, and more than it has if it is shorter than a seed."""
    return F.when(width >= seed, F.floor(width / 2).cast("int") + 1).otherwise(width + 1)


def with_template(rows: DataFrame) -> DataFrame:
    return rows.withColumn("template", template(F.col("tokens")))


def benchmark_windows(benchmark: DataFrame, window: int, seed: int) -> DataFrame:
    """item_id, tokens, template, width, windows (pos, hash, strong) of items that have tokens."""
    t = with_template(benchmark.select("item_id", tokens_of(F.col("text")).alias("tokens")).where(F.size("tokens") > 0))
    t = t.withColumn("width", F.least(F.lit(window), F.size("tokens")))
    return t.withColumn("windows", window_hashes(F.col("width"), needed(F.col("width"), seed)))


def seed_kinds(widths: list[int], window: int, seed: int) -> list[tuple[int, int]]:
    """Width and least literals of the seeds that a text must share with an item of one of `widths` to hold one of its windows.

    A strong window has few placeholders, so a seed in it has `seed - (window - 1) // 2` literals at least and is hashed as a template.
    Items shorter than a seed are looked for by as many words as the shortest of them has, word for word.
    """
    few = [w for w in widths if ALONE < w < seed]
    kinds = [(seed, seed - (window - 1) // 2)] if any(w >= seed for w in widths) else []
    kinds += [(min(few), min(few) + 1)] if few else []
    return kinds + [(w, w + 1) for w in widths if w <= ALONE]


def seeds_of(rows: DataFrame, kinds: list[tuple[int, int]], strides: dict[int, int], wanted: Callable[[int], Column], *keys: str) -> DataFrame:
    """The seeds (hash) of the texts in `rows`, a width w at every `strides[w]`-th place (1 if not given) where `wanted(w)` holds."""
    none = F.array().cast("array<bigint>")
    hashes = [F.when(wanted(w), window_hashes(F.lit(w), F.lit(least), strides.get(w, 1))["hash"]).otherwise(none) for w, least in kinds]
    return rows.select(*keys, F.explode(F.flatten(F.array(*hashes))).alias("hash"))


def rare_first(windows: DataFrame, share: float) -> DataFrame:
    """`windows` (item, strong, pos, hash) with `rare`: no text can qualify for an item without one of these.

    Of n windows a text needs m = `share` n, so it has one of any n - m + 1 of them. These are those that the fewest items have, so
    a window that very many items share brings no pairs of its own.
    """
    common = windows.groupBy("hash").agg(F.count_distinct("item").alias("n_items"))
    w = windows.join(common, "hash")
    rare = F.lit(False)
    for keys, counted in ((["item"], F.lit(True)), (["item", "strong"], F.col("strong"))):
        group = Window.partitionBy(*keys)
        n = F.count("*").over(group)
        rank = F.row_number().over(group.orderBy("n_items", "pos"))
        rare = rare | (counted & (rank <= n - F.greatest(F.ceil(share * n), F.lit(1)) + 1))
    return w.withColumn("rare", rare).drop("n_items")


def find_passages(docs: DataFrame, benchmark: DataFrame, share: float = 0.5, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, item_id, n_windows, n_found: documents that hold at least `share` of the windows of a benchmark item, or of its strong ones.

    Windows have `window` tokens; an item with fewer is one window. Strong ones, more than half of them literal, are found with other
    numbers, names and units, if each of their values stands for one value of the document; two may stand for the same. Other windows,
    and items with fewer than `seed` tokens, are found word for word; items of one or two tokens only where they are the whole text.

    Null and empty texts, of documents or items, hold nothing. Repeated rows give their pairs once; a null doc_id or item_id is a
    value like others. Other columns are ignored; if either table is empty, so is the result. Texts are searched whole, however long.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    items = stage(benchmark_windows(benchmark.select("item_id", "text").distinct(), window, seed).withColumn("item", F.xxhash64("item_id", "tokens")))
    widths = sorted(r[0] for r in items.select("width").distinct().collect()) or [window]  # at most `window` numbers
    stride = max(1, min([w for w in widths if w >= seed], default=seed) - seed + 1)  # so that the shortest window holds a seed that is looked up
    kinds = seed_kinds(widths, window, seed)
    seeds = stage(seeds_of(items, kinds, {}, lambda w: (F.col("width") >= seed) == F.lit(w >= seed)).distinct())
    tokens = with_template(rows.select("doc_id", "text_hash", tokens_of(F.col("text")).alias("tokens")))
    looked_up = seeds_of(tokens, kinds, {seed: stride}, lambda w: F.lit(True), "doc_id", "text_hash")
    suspects = stage(looked_up.join(seeds, "hash", "left_semi").select("doc_id", "text_hash").distinct())
    near = rows.withColumnRenamed("doc_id", "_doc_id").join(
        suspects, F.col("_doc_id").eqNullSafe(suspects["doc_id"]) & (rows["text_hash"] == suspects["text_hash"]), "left_semi")
    near = stage(near.select(F.col("_doc_id").alias("doc_id"), "text_hash", tokens_of(F.col("text")).alias("tokens"))
                 .dropDuplicates(["doc_id", "text_hash"]).withColumn("doc", F.xxhash64("doc_id", "text_hash")))

    every = F.flatten(F.array(*[window_hashes(F.lit(w), needed(F.lit(w), seed)) for w in widths]))
    places = stage(with_template(near.select("doc", "tokens")).select("doc", F.explode(every).alias("w")).select("doc", "w.pos", "w.hash").join(
        items.select(F.explode("windows.hash").alias("hash")).distinct(), "hash", "left_semi"))
    listed = items.select("item", F.explode("windows").alias("w")).select(
        "item", F.col("w.pos").alias("item_pos"), "w.hash", "w.strong")
    listed = stage(rare_first(listed.withColumnRenamed("item_pos", "pos"), share).withColumnRenamed("pos", "item_pos"))
    pairs = places.join(listed.where("rare").select("item", "hash"), "hash").select("doc", "item").distinct()
    passages = places.join(pairs, "doc").join(listed, ["item", "hash"]).groupBy("doc", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct("item_pos", "strong")).alias("found"))
    both = passages.join(near.select("doc", "doc_id", F.col("tokens").alias("doc_tokens")), "doc").join(
        items.select("item", "item_id", "tokens", "width", F.size("windows").cast("long").alias("n_windows"),
                     F.size(F.filter("windows", lambda w: w["strong"])).alias("n_strong")), "item")

    def consistent(w: Column) -> Column:
        """No token of the item stands for two of the document; literals stand for themselves."""
        own = F.slice("tokens", w["item_pos"] + 1, F.col("width"))
        pairs = F.arrays_zip(own, F.slice("doc_tokens", w["item_pos"] + F.col("shift") + 1, F.col("width")))
        return F.size(F.array_distinct(pairs)) == F.size(F.array_distinct(own))

    held = both.select("doc", "item", "doc_id", "item_id", "n_windows", "n_strong", F.explode(F.filter("found", consistent)).alias("w")).distinct()
    total = held.groupBy("doc", "item", "doc_id", "item_id", "n_windows", "n_strong").agg(
        F.count("*").alias("n_found"), F.count_if("w.strong").alias("strong_found"))
    enough = (F.col("n_found") >= share * F.col("n_windows")) | (
        (F.col("n_strong") > 0) & (F.col("strong_found") >= share * F.col("n_strong")))
    return total.where(enough).select("doc_id", "item_id", "n_windows", "n_found").distinct()
