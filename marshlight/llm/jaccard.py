"""N-gram Jaccard join: every link between documents whose word shingles are alike, and the groups they form.

Documents with the same shingles are one set. Two sets that are alike share one of their first shingles, in an order
that is the same for all sets (common shingles last), so sets meet in lists by these. A list is cut into tiles by set size; in a tile
hashed bitmaps bound the overlap of each pair from above by counting bits, and only what passes meets its sorted shingles.
Sets that are known to be in one group are not compared again: first each set meets one pivot, then for some rounds the likeliest
partner outside its group, then all that is left. So a group of thousands of near copies costs links in proportion to its size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .text import most_frequent, pieces, scramble, shingle_hashes, word_hashes

COMMON = 100_000  # shingles found to be common, kept last; a bound on what is broadcast, without effect on the result
TILE = 1024  # sets in a tile
BITS = 2  # bits of a bitmap for each shingle
LEAST_BITS = 2048
_CHUNK = 1 << 20


def set_sizes_agree(low: int, high: int, percent: int) -> bool:
    return 100 * low >= percent * high


def prefix_length(n: int, percent: int) -> int:
    """How many first shingles are enough: a set alike has at least ceil(n * percent / 100) shingles in common."""
    return n - -(-n * percent // 100) + 1


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit for each hash, in a power of two of bits, LEAST_BITS or about BITS times the number of shingles."""
    bits = max(LEAST_BITS, 1 << math.ceil(math.log2(max(1, BITS * len(shingles)))))
    out = np.zeros(bits, dtype=np.uint8)
    out[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def fold_to(words: np.ndarray, size: int) -> np.ndarray:
    """A bitmap over fewer bits, as if made with `size` words: hashes keep their low bits."""
    while len(words) > size:
        words = words[: len(words) // 2] | words[len(words) // 2:]
    return words


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    for a, b in pieces(texts, _CHUNK):
        words, counts = word_hashes(texts[a:b])
        at = 0
        for n in counts:
            yield shingle_hashes(words[at:at + n], width)
            at += n


def digest(shingles: np.ndarray) -> int:
    """64-bit name of a set; two different sets share one with a chance of 2^-64."""
    return int(np.add.reduce(scramble(shingles + np.uint64(len(shingles)))).astype(np.int64)) if len(shingles) else 0


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts, so that only a part of the texts is there in several forms at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [(t or "").encode("utf-8") for t in batch.column(column).to_pylist()]


def common_shingles(docs: DataFrame, width: int, most: int = COMMON) -> np.ndarray:
    """Sorted hashes of shingles that many documents share: seen three times or more among some 4000 neighbours."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n = [], 0, 0
        for batch in slices(batches):
            for shingles in shingle_sets(texts_of(batch, 0), width):
                held.append(shingles)
                size, n = size + len(shingles), n + 1
                if n == 4000 or size > 3_000_000:
                    yield emit(held)
                    held, size, n = [], 0, 0
        if held:
            yield emit(held)

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        hashes, n = np.unique(np.concatenate(held), return_counts=True)
        keep = n >= 3
        return pa.RecordBatch.from_arrays([pa.array(hashes[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["h", "n"])

    seen = stage(docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    rows = most_frequent(seen, "n", most).select("h").toArrow()["h"].to_numpy()
    return np.sort(rows.view(np.uint64))


def set_table(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """doc_id, n, node (digest of the set), the first shingles and the bitmap of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(common)  # COMMON numbers at most

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ns, nodes, firsts, maps = [], [], [], []
            for s in shingle_sets(texts_of(batch, 1), width):
                ns.append(len(s))
                nodes.append(digest(s))
                maps.append(bitmap(s).tobytes())
                place = np.searchsorted(shared.value, s)
                late = np.zeros(len(s), dtype=bool)
                inside = place < len(shared.value)
                late[inside] = shared.value[place[inside]] == s[inside]
                firsts.append(np.concatenate([s[~late], s[late]])[:prefix_length(len(s), percent) if len(s) else 0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array(firsts, pa.list_(pa.int64())), pa.array(maps, pa.binary())],
                ["doc_id", "n", "node", "first", "bitmap"])

    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {_id_type(docs)}, n long, node long, first array<long>, bitmap binary")


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """node and shingles (sorted, as bytes) of every text of `docs` (text)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(texts_of(batch, 0), width))
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    return docs.select("text").mapInArrow(measure, "node long, shingles binary")


def overlap_bound(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> int:
    """No more shingles than this are in both sets: a bit that only one bitmap has is a shingle that only its set has."""
    size = min(len(a), len(b))
    a, b = fold_to(a, size), fold_to(b, size)
    return min(n_a - int(np.bitwise_count(a & ~b).sum()), n_b - int(np.bitwise_count(b & ~a).sum()))


def possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps (maps: node, n, bitmap) leave a link possible."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n, m, x, y in zip(*(batch.column(k) for k in range(2, 6))):
                n, m = n.as_py(), m.as_py()
                low, high = min(n, m), max(n, m)
                both = overlap_bound(*(v for s, k in ((x, n), (y, m)) for v in (np.frombuffer(s.as_buffer(), dtype=np.uint64), k))) if set_sizes_agree(low, high, percent) else -1
                good.append(100 * both >= percent * (n + m - both) if both >= 0 else False)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left, right = (maps.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("bitmap").alias(f"m{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ma", "mb").mapInArrow(test, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingles are alike, by intersection of sorted arrays."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(test, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach from each node of `links` (a, b).

    Labels spread along links and then jump to the label of their label, until none changes.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = stage(spread.join(jump, F.col("label") == F.col("at"), "left").select("node", "old", F.least("label", "further").alias("label")))
        labels = moved.select("node", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "component")


ROUNDS = 3  # of likeliest partners, at most, before all that is left is compared


def tile_pairs(best_only: bool, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidate pairs of tiles, which arrive in order of their key; columns with key, right, node, n, component, bitmap."""

    def compare(rows: pa.Table) -> list[tuple[int, int]]:
        right, node, n, group = (rows.column(c).to_numpy() for c in ("right", "node", "n", "component"))
        one_tile = not right.any()
        lefts, rights = (np.arange(len(n)),) * 2 if one_tile else (np.flatnonzero(~right), np.flatnonzero(right))
        low, high = np.minimum.outer(n[lefts], n[rights]), np.maximum.outer(n[lefts], n[rights])
        open_pairs = np.not_equal.outer(group[lefts], group[rights]) & (100 * low >= percent * high)
        i, j = np.nonzero(np.triu(open_pairs, 1) if one_tile else open_pairs)
        if not len(i):
            return []
        i, j = lefts[i], rights[j]
        maps = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in rows.column("bitmap")]
        width = min(len(m) for m in maps)
        table = np.stack([fold_to(m, width) for m in maps])
        overlap = np.empty(len(i), dtype=np.int64)
        step = max(1, (1 << 20) // width)
        for at in range(0, len(i), step):
            x, y = table[i[at:at + step]], table[j[at:at + step]]
            extra = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
            missing = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
            overlap[at:at + step] = np.minimum(n[i[at:at + step]] - extra, n[j[at:at + step]] - missing)
        fine = 100 * overlap >= percent * (n[i] + n[j] - overlap)
        i, j, overlap = i[fine], j[fine], overlap[fine]
        if best_only and len(i):  # the likeliest partner of each set
            x, y = np.concatenate([i, j]), np.concatenate([j, i])
            likely = np.concatenate([overlap, overlap]) / (n[x] + n[y])
            order = np.lexsort((node[y], -likely, x))
            x, y = x[order], y[order]
            first = np.ones(len(x), dtype=bool)
            first[1:] = x[1:] != x[:-1]
            i, j = x[first], y[first]
        return list(zip(np.minimum(node[i], node[j]).tolist(), np.maximum(node[i], node[j]).tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            keys = held.column("key").to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if len(cuts):
                yield from emit(held.slice(0, cuts[-1]), cuts[:-1])
                held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            keys = held.column("key").to_numpy()
            yield from emit(held, np.flatnonzero(keys[1:] != keys[:-1]) + 1)

    def emit(rows: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for a, b in zip([0, *cuts], [*cuts, rows.num_rows]):
            found.update(compare(rows.slice(a, b - a)))
        listed = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in listed], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def tiles(lists: DataFrame, percent: int, tile: int) -> DataFrame:
    """Rows of lists (h, node, n, component) dealt to pairs of tiles of bands of size that can hold links.

    Sets of one link lie in one band or in neighbours. Each row goes to its tile with every tile of its own and of
    the next band on the one side, and with those of the band before on the other, unless all rows there are of one
    group or too far in size.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    rows = lists.withColumn("band", band)
    count = stage(rows.groupBy("h", "band").agg(
        F.ceil(F.count("*") / tile).cast("int").alias("k"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("n").alias("least"), F.max("n").alias("most")))
    next_to = lambda d, c: count.select("h", (F.col("band") + d).alias("band"), *[F.col(x).alias(f"{c}_{x}") for x in ("k", "low", "high", "least", "most")])
    near = count.join(next_to(-1, "after"), ["h", "band"], "left").join(next_to(1, "before"), ["h", "band"], "left")
    mixed = lambda c: (F.least("low", f"{c}_low") < F.greatest("high", f"{c}_high"))
    near = near.select(
        "h", "band", "k", F.when(F.col("low") < F.col("high"), F.col("k")).otherwise(0).alias("inner"),
        *[F.when(mixed(c), F.col(f"{c}_k")).otherwise(0).alias(c) for c in ("after", "before")], "after_least", "before_most")
    own = F.pmod(F.xxhash64("node", F.lit("tile")), F.col("k")).cast("int")
    step = lambda k: F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    key = lambda a, b, next_band: F.xxhash64("h", F.col("band") - (0 if next_band != "before" else 1), a, F.lit(next_band != "own"), b)
    place = lambda a, b, side, right: F.struct(key(a, b, side).alias("key"), right.alias("right"))
    places = F.concat(
        F.transform(step(F.col("inner")), lambda j: place(F.least(F.col("own"), j), F.greatest(F.col("own"), j), "own", F.col("own") > j)),
        F.transform(step(F.when(percent * F.col("after_least") <= 100 * F.col("n"), F.col("after")).otherwise(0)), lambda j: place(F.col("own"), j, "after", F.lit(False))),
        F.transform(step(F.when(100 * F.col("before_most") >= percent * F.col("n"), F.col("before")).otherwise(0)), lambda j: place(j, F.col("own"), "before", F.lit(True))))
    return rows.join(near, ["h", "band"]).withColumn("own", own).withColumn("place", F.explode(places)).select(
        "place.key", "place.right", "node", "n", "component")


def link_groups(docs: DataFrame, width: int = 4, percent: int = 85, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs`.

    A document's set holds its distinct shingles of `width` words (words as between \\x20 and \\x09-\\x0D, A-Z lower-cased); with fewer
    words the whole sequence is one shingle. Two documents link when 100 * intersection >= `percent` * union. component_id is the
    smallest doc_id that links reach. Null, empty and blank texts have no shingle and link with nothing.

    Repeated rows stay, in one component; rows with a null doc_id link like others, and only a group of null ids alone has a null
    component. Other columns are ignored; an empty table gives an empty table. Texts are read whole, however long.
    """
    docs = docs.select("doc_id", "text")
    measured = stage(set_table(docs, width, percent, common_shingles(docs, width)))
    nodes = stage(measured.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n")))
    # Lists of sets by first shingle, without those that hold one set. Lists of the same sets are one.
    postings = measured.where("n > 0").select(F.explode("first").alias("h"), "node", "n")
    met = postings.groupBy("h").count().where("count > 1").select("h")
    lists = stage(postings.join(met, "h").distinct())
    same = lists.groupBy("h").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64("node") % 1_000_000_007).alias("y"))
    lists = stage(lists.join(same.where("c > 1").groupBy("c", "x", "y").agg(F.min("h").alias("h")).select("h"), "h"))
    held = lists.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    maps = stage(measured.select(F.col("node").alias("_node"), F.col("doc_id").alias("_doc_id"), "n", "bitmap").join(
        held, (F.col("_node") == F.col("node")) & F.col("_doc_id").eqNullSafe(F.col("doc_id"))).select("node", "n", "bitmap"))

    def tested(pairs: DataFrame) -> DataFrame | None:
        """The links among candidate pairs, or None without candidates; only texts of sets in a pair are read again."""
        pairs = stage(pairs)
        if pairs.isEmpty():
            return None
        wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "doc_id"), "node"))
        texts = docs.join(wanted.select(F.col("doc_id").alias("_doc_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")
        full = full_sets(texts, width).groupBy("node").agg(F.first("shingles").alias("shingles"))  # repeated rows once
        sets = stage(full.join(wanted.select("node"), "node", "left_semi"))
        return stage(verified(pairs, sets, percent))

    # Each set meets one pivot: of the smallest sets in its lists, by band, the one that most of its lists have.
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    banded = lists.withColumn("band", band)
    pivots = banded.groupBy("h", "band").agg(F.min("node").alias("pivot"))
    votes = banded.join(pivots, ["h", "band"]).where("node != pivot").groupBy("node", "pivot").agg(F.count("*").alias("votes"))
    pairs = votes.groupBy("node").agg(F.max_by("pivot", F.struct("votes", "pivot")).alias("pivot")).select(
        F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = tested(possible(pairs, maps, percent))
    if links is None:
        links = docs.sparkSession.createDataFrame([], "a long, b long")
    groups = components(links)
    for best_only in [*[True] * ROUNDS, False]:
        labelled = lists.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = labelled.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h")
        open_lists = stage(labelled.join(mixed, "h"))
        dealt = tiles(open_lists, percent, tile).join(maps.select("node", "bitmap"), "node").repartition("key").sortWithinPartitions("key")
        found = stage(dealt.mapInArrow(tile_pairs(best_only, percent), "a long, b long").distinct())
        # A set without a likely partner now has none later: groups only grow.
        partners = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        lists = stage(lists.join(partners, "node", "left_semi"))
        more = tested(found)
        if more is not None:
            links = links.union(more)
            groups = components(links)
        elif best_only:
            break  # not even a likely partner is left

    known = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = known.join(smallest, "component").select("node", "component_id")
    full = measured.where("n > 0").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(measured.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
