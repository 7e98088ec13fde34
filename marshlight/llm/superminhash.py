"""Near-duplicate groups by SuperMinHash: signatures, banding, verification on full sets, union-find.

An element takes a random permutation of the places of a signature; in its j-th place it counts j plus a random fraction. A place of
the signature keeps the least. So an element gives each place another rank, which makes the share of equal places a better estimate of
the Jaccard similarity than independent hashes do, and once the largest value is below j no later step can change anything: long texts stop at once.

160 places in 32 bands of 5 miss a pair of similarity 0.85 with a chance of 1e-8. Sets that are equal are one node. In a band's bucket each node first
meets the bucket's least; nodes that are in one group by then are not compared again. What is left is compared in tiles by a byte of each
place, by size and by bitmaps that bound the overlap from above, and each pair that may be alike is confirmed on its full sets. First each
node of a tile meets its likeliest partner, then all that is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .jaccard import bitmap, fold_to
from .text import pieces, scramble, shingle_hashes, word_hashes

BANDS = 32
ROWS = 5
PLACES = BANDS * ROWS
TILE = 512  # nodes of a bucket in a tile
SIGMAS = 6  # how far below its expected share the estimate of a linked pair may lie
_CHUNK = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(elements: np.ndarray, starts: np.ndarray, places: int = PLACES) -> np.ndarray:
    """A row of `places` numbers for each set; `elements` holds the hashes of all sets, set k from starts[k] to starts[k + 1].

    The j-th step is taken for the elements of all sets at once, and sets whose places are all below j drop out.
    A value has j in its upper and the fraction in its lower 32 bits. An empty set keeps the largest number everywhere.
    """
    n = len(starts) - 1
    out = np.full((n, places), np.iinfo(np.uint64).max, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(starts))
    state, order = elements.copy(), None
    for j in range(places):
        if j:
            done = out.max(axis=1) < (np.uint64(j) << np.uint64(32))
            active = ~done[owner]
            if not active.any():
                break
            if order is None:  # step 0 swaps places 0 and `first`
                rows = np.flatnonzero(active)
                order = np.tile(np.arange(places, dtype=np.uint8), (len(rows), 1))
                order[np.arange(len(rows)), first[rows]] = 0
                order[:, 0] = first[rows]
            else:
                order = order[active]
            owner, state = owner[active], state[active]
        state += _STEP
        drawn = scramble(state)
        other = (j + (drawn >> np.uint64(32)) % np.uint64(places - j)).astype(np.int64)
        value = (np.uint64(j) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        if j == 0:
            first = place = other
        else:
            at = np.arange(len(owner))
            place = order[at, other].astype(np.int64)
            order[at, other] = order[:, j]
            order[:, j] = place
        np.minimum.at(out.reshape(-1), owner * places + place, value)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    out = np.zeros((len(signature), signature.shape[1] // rows), dtype=np.uint64)
    for k in range(rows):
        out = scramble(out + signature[:, k::rows][:, :out.shape[1]])
    return out + np.arange(out.shape[1], dtype=np.uint64)


def set_name(shingles: np.ndarray) -> bytes:
    """128 bits for a set."""
    salts = scramble(np.array([1, 2], dtype=np.uint64) + np.uint64(len(shingles)))
    return b"".join(int(np.add.reduce(scramble(shingles ^ salt))).to_bytes(8, "big") for salt in salts)


def _sets(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of batches whose texts are about a megabyte, and the sorted shingle hashes of each text."""
    for batch in batches:
        texts = [(t or "").encode("utf-8") for t in batch.column(column).to_pylist()]
        for a, b in pieces(texts, _CHUNK):
            words, counts = word_hashes(texts[a:b])
            ends = np.cumsum(counts)
            yield batch.slice(a, b - a), [shingle_hashes(words[e - c:e], width) for c, e in zip(counts, ends)]


def measured_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (shingles), node (name of the set), sketch (a byte of each place), bitmap, keys (of the bands) of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, 1, width):
            starts = np.cumsum([0, *map(len, sets)])
            signature = signatures(np.concatenate(sets), starts)
            sketch = scramble(signature).astype(np.uint8)
            keys = band_keys(signature).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts)), pa.array([set_name(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sketch], pa.binary()),
                 pa.array([bitmap(s).tobytes() for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.reshape(-1)))],
                ["doc_id", "n", "node", "sketch", "bitmap", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, n long, node binary, sketch binary, bitmap binary, keys array<long>")


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are alike. Only texts of one document of each node in a pair are read again."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, 0, width):
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_name(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "doc_id"), "node"))
    ids = wanted.select(F.col("doc_id").alias("_doc")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi").select("text")
    named = texts.mapInArrow(full, "node binary, shingles binary").join(wanted.select("node"), "node", "left_semi")
    sets = stage(named.groupBy("node").agg(F.first("shingles").alias("shingles")))
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(test, "a binary, b binary")


def union_find(links: DataFrame) -> DataFrame:
    """(node, root): the least node that links (a, b) reach, for each node in a link.

    Each task unites the links it holds (union by least, path halving) and hands on one link for each node it has met; labels then
    spread along these and jump to the label of their label until none changes.
    """

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def flush() -> pa.RecordBatch:
            found = [(x, find(x)) for x in list(root)]
            root.clear()
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low, high = sorted((find(a), find(b)))
                root[high] = low
            if len(root) > 500_000:
                yield flush()
        yield flush()

    united = links.select("a", "b").mapInArrow(unite, "a binary, b binary")
    both = stage(united.union(united.select("b", "a")).distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        hooked = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        further = labels.select(F.col("node").alias("at"), F.col("root").alias("further"))
        moved = stage(hooked.join(further, F.col("root") == F.col("at"), "left").select("node", "old", F.least("root", "further").alias("root")))
        labels = moved.select("node", "root")
        if moved.where("old != root").isEmpty():
            return labels


def least_equal(percent: int, places: int = PLACES) -> int:
    """Equal bytes of the sketches of a linked pair: the expected number less SIGMAS standard deviations of independent places."""
    share = percent / 100
    return int(places * share - SIGMAS * (places * share * (1 - share)) ** 0.5)


def most_common(maps: list[np.ndarray], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """No more shingles than this are in both sets of each pair (i, j): a bit that only one bitmap has is a shingle that only its set has."""
    width = np.fromiter(map(len, maps), dtype=np.int64, count=len(maps))
    both, out = np.minimum(width[i], width[j]), np.empty(len(i), dtype=np.int64)
    for w in np.unique(both):
        at = np.flatnonzero(both == w)
        used, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        table, (first, second) = np.stack([fold_to(maps[k], w) for k in used]), place.reshape(2, -1)
        for a in range(0, len(at), step := max(1, _CHUNK // int(w))):
            part = at[a:a + step]
            x, y = table[first[a:a + step]], table[second[a:a + step]]
            out[part] = np.minimum(
                n[i[part]] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), n[j[part]] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
    return out


def _tile_pairs(percent: int, likeliest: bool):
    """Pairs of different groups in a tile that may be alike; with `likeliest` one partner of each node.

    A pair that meets in several bands is taken in the first, which the sketches tell: five equal bytes in a row of places.
    """
    least = least_equal(percent)

    def compare(rows: pa.Table) -> list[tuple[bytes, bytes]]:
        right = rows.column("right").to_numpy()
        n = rows.column("n").to_numpy()
        node, root = (np.array(rows.column(c).to_pylist(), dtype=object) for c in ("node", "root"))
        _, group = np.unique(root, return_inverse=True)
        sketch = np.stack([np.frombuffer(s.as_buffer(), dtype=np.uint8) for s in rows.column("sketch")])
        band = rows.column("band")[0].as_py()
        one = not right.any()
        lefts, rights = (np.arange(len(n)),) * 2 if one else (np.flatnonzero(~right), np.flatnonzero(right))
        some: list[tuple[np.ndarray, np.ndarray]] = []
        for i in lefts:
            js = rights[rights > i] if one else rights
            js = js[(group[js] != group[i]) & (100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i]))]
            same = sketch[js] == sketch[i]
            good = same.sum(axis=1) >= least
            if band:
                good &= ~same[:, :band * ROWS].reshape(len(js), band, ROWS).all(axis=2).any(axis=1)
            if good.any():
                some.append((np.full(int(good.sum()), i), js[good]))
        if not some:
            return []
        i, j = (np.concatenate(x) for x in zip(*some))
        both = most_common([np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in rows.column("bitmap")], n, i, j)
        fine = 100 * both >= percent * (n[i] + n[j] - both)
        i, j, both = i[fine], j[fine], both[fine]
        if likeliest and len(i):
            order = np.lexsort((-both / (n[i] + n[j]), i))
            i, j = i[order], j[order]
            first = np.diff(i, prepend=-1) != 0
            i, j = i[first], j[first]
        return [tuple(sorted((node[x], node[y]))) for x, y in zip(i, j)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def emit(rows: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
            found = {p for a, b in zip([0, *cuts], [*cuts, rows.num_rows]) for p in compare(rows.slice(a, b - a))}
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            keys = held.column("tile").to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if len(cuts):
                yield emit(held.slice(0, cuts[-1]), cuts[:-1])
                held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            keys = held.column("tile").to_numpy()
            yield emit(held, np.flatnonzero(keys[1:] != keys[:-1]) + 1)

    return run


def open_pairs(buckets: DataFrame, nodes: DataFrame, percent: int, tile: int, likeliest: bool) -> DataFrame:
    """Pairs of nodes of different groups in a bucket (key, band, node, root) that their sizes, sketches and bitmaps let be alike.

    A bucket of more than `tile` nodes is cut in parts; a node meets each pair of parts that has its own.
    """
    counts = buckets.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("k"))
    own = F.pmod(F.xxhash64("node", F.lit("part")), F.col("k")).cast("int")
    part = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part")
    placed = buckets.join(counts, "key").withColumn("own", own).select("key", "band", "node", "root", "own", part)
    dealt = placed.select(
        F.xxhash64("key", F.least("own", "part"), F.greatest("own", "part")).alias("tile"), (F.col("own") > F.col("part")).alias("right"), "band", "node", "root")
    full = dealt.join(nodes.select("node", "n", "sketch", "bitmap"), "node").repartition("tile").sortWithinPartitions("tile")
    return full.mapInArrow(_tile_pairs(percent, likeliest), "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of `docs`.

    A document's set holds its distinct shingles of `width` words (runs of characters other than \\x20 and \\x09-\\x0D, A-Z lower-cased); with
    fewer words the whole sequence is one. Two documents link when 100 * intersection >= `percent` * union, confirmed on full sets.
    component_id is the least doc_id that links reach; kept marks the rows that have it. Null, empty and blank texts have no shingle and
    link with nothing.

    Repeated rows stay, in one component, each kept if one is. Rows without doc_id link like others; a group without any id has a
    null component_id, and its rows are kept. Other columns are ignored; an empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    measured = stage(measured_sets(docs, width))
    nodes = stage(measured.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bitmap").alias("bitmap"), F.first("keys").alias("keys")))
    postings = nodes.select(F.posexplode("keys").alias("band", "key"), "node")
    buckets = stage(postings.join(postings.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("pivot")).where("c > 1"), "key").select(
        "key", "band", "node", "pivot"))
    votes = buckets.where("node != pivot").groupBy("node", "pivot").agg(F.count("*").alias("votes"))
    stars = votes.groupBy("node").agg(F.max_by("pivot", F.struct("votes", "pivot")).alias("pivot"))
    tested = stage(_alike(stars.select(F.col("pivot").alias("a"), F.col("node").alias("b")), nodes, percent))
    links = stage(confirmed(tested, docs, nodes, width, percent))
    groups = union_find(links)
    for likeliest in (True, False):
        labelled = buckets.select("key", "band", "node").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        buckets = stage(labelled.join(mixed, "key"))
        found = stage(open_pairs(buckets, nodes, percent, tile, likeliest).join(tested, ["a", "b"], "left_anti"))
        if not found.isEmpty():
            links = links.union(stage(confirmed(found, docs, nodes, width, percent)))
            tested = tested.union(found)
            groups = union_find(links)
    known = nodes.select("node", "doc_id").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = known.join(known.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("node", "component_id")
    grouped = measured.where("n > 0").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    rows = grouped.unionByName(measured.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), a < b, that sizes and sketches let be alike."""
    least = least_equal(percent)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for c in (4, 5))
            n, m = (batch.column(c).to_numpy() for c in (2, 3))
            good = ((x == y).sum(axis=1) >= least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            yield batch.select([0, 1]).filter(pa.array(good))

    left, right = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(test, "a binary, b binary")
