"""Conversation prefix trie: a node for every distinct sequence of first turns, with sums over its subtree.

A prefix is named by the exclusive or of 128 bits for each (depth, turn), so prefixes of a conversation are a running fold and the name of a
parent follows from the node's own turn. Distinct names are enumerated by an aggregation. A node with one member heads a plain path
whose figures are known at once; what is left, the shared part, is cut into subtrees of bounded size. Shards of such
subtrees each get a minimal perfect hash: every name has a slot, checked against the name that is stored there. Counts are scattered into flat
arrays by slot and added through the array of parent slots, deepest level first.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .scan import placed, running
from .text import scramble

LIMIT = 4096  # members over which a node's subtree is worked off in a round of its own
SHARD = 200_000  # nodes in a shard, about
CHUNK = 20_000  # ids in one piece of text


class PerfectHash:
    """A minimal perfect hash of distinct pairs of 64-bit numbers, with the pairs in its slots.

    Pairs that fall alone into a place of a level get it; the others go on to a smaller level. A slot is the rank of its place.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray) -> None:
        self.places: list[np.ndarray] = []
        left = np.arange(len(a))
        while len(left):
            if len(self.places) > 200:
                raise ValueError("the same prefix name twice")
            size = 2 * len(left) + 1
            at = self._at(a[left], b[left], len(self.places), size)
            alone = np.bincount(at, minlength=size) == 1
            self.places.append(alone)
            left = left[~alone[at]]
        counts = [int(p.sum()) for p in self.places]
        self.first = np.cumsum([0, *counts])
        self.rank = [np.cumsum(p) - 1 for p in self.places]
        self.names = np.zeros((len(a), 2), dtype=np.uint64)
        slots = self._slot(a, b)
        self.names[slots] = np.stack([a, b], axis=1)
        if len(np.unique(slots)) != len(a) or not (self.find(a, b) == slots).all():
            raise ValueError("a slot is taken twice")

    @staticmethod
    def _at(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (scramble(a ^ scramble(b + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        for level, alone in enumerate(self.places):
            at = self._at(a[left], b[left], level, len(alone))
            hit = alone[at]
            out[left[hit]] = self.first[level] + self.rank[level][at[hit]]
            left = left[~hit]
        return out

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each pair; -1 for a pair that is not among those hashed."""
        slots = self._slot(a, b)
        known = slots >= 0
        known[known] = (self.names[slots[known]] == np.stack([a[known], b[known]], axis=1)).all(axis=1)
        return np.where(known, slots, -1)


def add_up(names: np.ndarray, parents: np.ndarray, depth: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Each of `values` summed over the subtree of every node; parents that aren't among `names` (both n x 2) get nothing."""
    table = PerfectHash(names[:, 0], names[:, 1])
    slots = table.find(names[:, 0], names[:, 1])
    parent_slot = np.empty(len(slots), dtype=np.int64)
    parent_slot[slots] = table.find(parents[:, 0], parents[:, 1])
    by_depth = slots[np.argsort(-depth, kind="stable")]
    deep = np.empty(len(slots), dtype=np.int64)
    deep[slots] = depth
    cuts = np.flatnonzero(np.diff(deep[by_depth])) + 1
    out = []
    for value in values:
        total = np.zeros(len(slots), dtype=np.int64)
        total[slots] = value
        for level in np.split(by_depth, cuts):
            inner = level[parent_slot[level] >= 0]
            np.add.at(total, parent_slot[inner], total[inner])
        out.append(total[slots])
    return out


def turn_keys(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), key, size of every turn that has a conv_id; texts are not carried further.

    The order is turn (null first), then `key`; a null role or text counts as empty. Equal rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    narrow = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", key.alias("key"), F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("_tie"))
    return placed(narrow, "conv_id", ["conv_id", "turn", "key", "_tie"]).select("conv_id", "pos", "key", "size")


def shared_heads(turns: DataFrame, family: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: (conv_id, depth, key, size, left) of turns, and (conv_id, length).

    Conversation c starts with the first h turns of c - c % family (all if it has fewer, none if there is no such conversation) and goes
    on with its own turns behind its first h; h is crc32 of its digits modulo `heads`. `left` is the number of turns after a turn.
    """
    keyed = turn_keys(turns)
    first = keyed.where(F.col("pos") < heads - 1).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "key", "size"))).alias("first"))  # fewer than `heads` rows of each
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    each = keyed.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    base = first.select(F.col("conv_id").alias("base"), "first")
    head = F.slice(F.coalesce("first", F.array().cast("array<struct<pos:long,key:binary,size:long>>")), F.lit(1), F.col("h"))
    each = stage(each.join(base, "base", "left").withColumn("head", head).withColumn("led", F.size("head")).withColumn(
        "length", F.col("led") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv_id", "h", "led", "length", "head"))
    left = F.col("length") - F.col("depth")
    led = each.select("conv_id", "length", F.explode("head").alias("t")).withColumn("depth", F.col("t.pos") + 1).select(
        "conv_id", "depth", "t.key", "t.size", left.alias("left"))
    own = keyed.join(each.select("conv_id", "h", "led", "length"), "conv_id").where("pos >= h").withColumn(
        "depth", F.col("pos") + 1 - F.col("h") + F.col("led")).select("conv_id", "depth", "key", "size", left.alias("left"))
    return led.union(own), each.select("conv_id", "length")


def _ends(rows: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256) over the conv_ids of rows (d1, d2, conv_id), ascending, with commas between.

    A node where very many conversations end gets their ids in long pieces of text, so few rows come to its task, one after the other.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []
        for batch in batches:
            for a, b, c in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (a, b) != key or len(ids) == CHUNK:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = (a, b), []
                ids.append(c)
            if len(out) > 1000:
                yield table(out, "text")
                out = []
        if ids:
            out.append((*key, ids[0], ",".join(map(str, ids))))
        yield table(out, "text")

    def table(rows: list[tuple], last: str) -> pa.RecordBatch:
        names = ["d1", "d2", "conv_id", last] if last == "text" else ["d1", "d2", last]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string() if n == last else pa.int64()) for k, n in enumerate(names)], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, out = None, None, []
        for batch in batches:
            for a, b, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (a, b) != key:
                    if key is not None:
                        out.append((*key, now.hexdigest()))
                    key, now = (a, b), sha256(text.encode())
                else:
                    now.update(b"," + text.encode())
        if key is not None:
            out.append((*key, now.hexdigest()))
        yield table(out, "ends_sha256")

    order = ["d1", "d2", "conv_id"]
    packed = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, "d1 long, d2 long, conv_id long, text string")
    return packed.repartition("d1", "d2").sortWithinPartitions(*order).mapInArrow(digest, "d1 long, d2 long, ends_sha256 string")


def _shard_sums(nodes: DataFrame) -> DataFrame:
    """nodes (d1, d2, p1, p2, depth, leaves, saved, ...), a partition being a shard, with leaves and saved summed over subtrees."""
    names = nodes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        flat = {n: rows.column(n).to_numpy() for n in names}
        pair = lambda *c: np.stack([flat[n].view(np.uint64) for n in c], axis=1)
        leaves, saved = add_up(pair("d1", "d2"), pair("p1", "p2"), flat["depth"], [flat["leaves"], flat["saved"]])
        flat |= {"leaves": leaves, "saved": saved}
        yield pa.RecordBatch.from_arrays([pa.array(flat[n]) for n in names], names)

    return nodes.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in nodes.dtypes))


def prefix_trie(turns: DataFrame, conversations: DataFrame, limit: int = LIMIT, shard: int = SHARD) -> DataFrame:
    """Every node of the trie over `turns` (conv_id, depth from 1, key, size, left: turns after it) and `conversations` (conv_id, length).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves (childless nodes in the subtree, itself
    included), saved_tokens (sum over the subtree of (n_convs - 1) * size of the node's turn), ends_sha256 (SHA-256 of the ascending ids
    of members that end here, comma-joined). Keys are equal exactly where turns are. The root has depth 0 and a null parent.

    A shard holds subtrees of nodes with at most `limit` members (then `limit` times as many, each such node counted once its smaller
    ones are done), about `shard` nodes. Conversations without turns end at the root. Without conversations there is no node.
    """
    salted = [F.xxhash64("depth", "key"), F.xxhash64(F.lit(1), "depth", "key")]
    prefixes = running(turns.withColumns({"d1": salted[0], "d2": salted[1]}), "conv_id", ["conv_id", "depth"], ["d1", "d2"], np.bitwise_xor)
    nodes = prefixes.groupBy("depth", "d1", "d2").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.min("key").alias("key"), F.max("key").alias("other"), F.max("size").alias("size"),
        F.max("left").alias("left"))
    checked = F.when(F.col("key") == F.col("other"), F.col("key")).otherwise(F.raise_error(F.lit("two prefixes have one name")).cast("binary"))
    nodes = stage(nodes.withColumn("key", checked).select(
        "depth", "d1", "d2", "n", "conv_id", "size", "left", F.col("d1").bitwiseXOR(salted[0]).alias("p1"), F.col("d2").bitwiseXOR(salted[1]).alias("p2")))
    shared = nodes.where("n > 1")
    # A parent that is not shared has the same only member.
    parents = shared.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    linked = stage(nodes.join(parents, ["depth", "p1", "p2"], "left"))
    children = linked.where("parent_conv_id IS NOT NULL").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("single"))
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(float(limit)))).cast("int")
    on_shared = prefixes.join(shared.select("depth", "d1", "d2", "n"), ["depth", "d1", "d2"])
    tops = on_shared.withColumn("level", level).groupBy("conv_id", "level").agg(F.min(F.struct("depth", "d1", "d2")).alias("top"))
    open_nodes = stage(linked.where("n > 1").withColumn("level", level).join(tops, ["conv_id", "level"]).join(children, ["depth", "d1", "d2"], "left").select(
        "d1", "d2", "p1", "p2", "depth", "n", "conv_id", F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"), F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("single")).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("size")).alias("saved"), "level", F.col("top.d1").alias("t1"), F.col("top.d2").alias("t2")))
    per_level = {r["level"]: r["rows"] for r in open_nodes.groupBy("level").agg(F.count("*").alias("rows")).collect()}  # log of the largest count, so few
    summed: DataFrame | None = None
    for k in sorted(per_level):
        now = open_nodes.where(F.col("level") == k).drop("level")
        if summed is not None:
            sent = summed.where("d1 = t1 AND d2 = t2").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2"), (F.col("depth") - 1).alias("depth")).agg(
                F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
            now = now.join(sent, ["depth", "d1", "d2"], "left").withColumns({
                c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}).select(*now.columns)
        done = stage(_shard_sums(now.repartition(max(1, -(-per_level[k] // shard)), "t1", "t2")))
        summed = done if summed is None else summed.unionByName(done)

    ended = _ends(on_shared.where("left = 0").select("d1", "d2", "conv_id").union(
        conversations.where("length = 0").select(F.lit(0).cast("long"), F.lit(0).cast("long"), "conv_id")))
    ended = stage(ended)
    none = F.sha2(F.lit(""), 256)
    single = linked.where("n = 1").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"), "d1", "d2", F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("left") > 0, 1).otherwise(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("left") == 0, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none).alias("ends_sha256"))
    figures = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = single.select(*figures)
    below = linked.where("depth = 1 AND n = 1").select(F.lit(1).alias("one"), F.lit(1).alias("leaves"), F.lit(0).alias("saved"))
    if summed is not None:
        below = below.union(summed.where("depth = 1").select(F.lit(1), "leaves", "saved"))
        ends_of = ended.where("NOT (d1 = 0 AND d2 = 0)")
        out = out.union(summed.join(ends_of, ["d1", "d2"], "left").select(
            "conv_id", "depth", "parent_conv_id", "n", "n_children", "leaves", "saved", F.coalesce("ends_sha256", none)))
    # The root is one row of sums, so it is looked up and not joined.
    sums = below.agg(F.sum("one").alias("c"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    whole = conversations.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    at_root = ended.where("d1 = 0 AND d2 = 0").first()
    root = [] if not whole["n"] else [(
        whole["least"], 0, None, whole["n"], sums["c"] or 0, sums["leaves"] or 1, sums["saved"] or 0,
        at_root["ends_sha256"] if at_root else sha256(b"").hexdigest())]
    kinds = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in figures)
    named = turns.sparkSession.createDataFrame(root, kinds).unionByName(out)
    # The children of the root have the root's smallest member as their parent's.
    return named.select(*[
        F.when(F.col("depth") == 1, F.lit(whole["least"])).otherwise(F.col(c)).cast("long").alias(c) if c == "parent_conv_id" else
        F.col(c) if c == "ends_sha256" else F.col(c).cast("long").alias(c) for c in figures])
