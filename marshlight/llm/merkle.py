"""Merkle dataset manifest: a tree of digests over the rows of each group, and a proof for every row.

Nodes are worked off in time order (time-forward processing). The label of a node is (last leaf below it, level), so a node comes
after all that it waits for. A priority queue by label holds what was sent: going up, a child sends its digest to its parent;
in the reversed sweep a node sends its proof to its children, each of whom puts its siblings in front. The queue holds eight messages for
each level at most.

Leaves are dealt in blocks of 512 consecutive ones, each the whole subtree of a node three levels up. What leaves a block is a message
to a node of a later round: Spark's sort by block and label is the part of the queue that lies outside. So no task holds more than
a block, and n leaves take log512(n) rounds each way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .scan import placed

FAN = 8
RAISED = 3  # levels in a block
BLOCK = FAN**RAISED
DIGEST = 64  # characters of a digest
_MESSAGE = 1 << 62  # sorts behind every leaf, so the reversed sweep meets it first


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Hexadecimal SHA-256 of the values one behind the other, each as `field` writes it."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def levels_above(n: int) -> int:
    """How often n nodes are gathered by eight until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def label(level: int, index: int, n: int) -> tuple[int, int]:
    """Time of a node over n leaves: the last leaf below it, then its level."""
    return min((index + 1) * FAN**level, n) - 1, level


def sweep_up(leaves: list[bytes], levels: int) -> list[list[bytes]]:
    """Digests by level of the tree over `leaves`; the last list holds one node if `levels` are enough."""
    n, nodes = len(leaves), [leaves, *[[] for _ in range(levels)]]
    queue: list[tuple[tuple[int, int], int, bytes]] = []

    def send(level: int, index: int, digest: bytes) -> None:
        if level < levels:
            heapq.heappush(queue, (label(level + 1, index // FAN, n), index, digest))

    for at, leaf in enumerate(leaves):
        send(0, at, leaf)
        while queue and queue[0][0][0] <= at:
            now, run = queue[0][0], []
            while queue and queue[0][0] == now:
                run.append(heapq.heappop(queue)[2])
            digest = sha256(b"".join(run)).hexdigest().encode()
            nodes[now[1]].append(digest)
            send(now[1], len(nodes[now[1]]) - 1, digest)
    return nodes


def sweep_down(nodes: list[list[bytes]], proof: bytes, path: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(leaf, proof, path) of every leaf, the last one first, from proof and path of the top node.

    A proof holds the digests of siblings from the leaf upwards; a path has two bytes a level: the node's place in its run, and the
    length of the run.
    """
    n, top = len(nodes[0]), len(nodes) - 1
    queue = [((-(n - 1), -top), 0, proof, path)]
    while queue:
        (_, level), index, proof, path = heapq.heappop(queue)
        if level == 0:
            yield index, proof, path
            continue
        below = -level - 1
        first = index * FAN
        run = nodes[below][first:first + FAN]
        for k in range(len(run)):
            when = label(below, first + k, n)
            heapq.heappush(queue, ((-when[0], -when[1]), first + k, b"".join(run[:k] + run[k + 1:]) + proof, bytes((k, len(run))) + path))


def fold(digest: bytes, proof: bytes, path: bytes) -> bytes:
    """The root that `digest` leads to with the siblings of a proof."""
    at = 0
    for k, size in zip(path[::2], path[1::2]):
        left, right = at + DIGEST * k, at + DIGEST * (size - 1)
        digest = sha256(proof[at:left] + digest + proof[left:right]).hexdigest().encode()
        at = right
    return digest


def _blocks(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple[int, int], list[tuple]]]:
    """Rows in order, by tree and block; `names` without these two."""
    key, rows = None, []
    for batch in batches:
        for tree, block, *row in zip(*(batch.column(n).to_pylist() for n in ("tree", "block", *names))):
            if (tree, block) != key:
                if rows:
                    yield key, rows
                key, rows = (tree, block), []
            rows.append(tuple(row))
    if rows:
        yield key, rows


def raise_blocks(leaves: DataFrame) -> DataFrame:
    """(tree, n, pos, digest) of the nodes three levels above leaves of the same columns, or of roots that come before."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, block), rows in _blocks(batches, ("n", "digest")):
            n = rows[0][0]
            levels = min(RAISED, levels_above(n))
            top = sweep_up([d.encode() for _, d in rows], levels)[-1][0]
            out.append((tree, -(-n // BLOCK), block, top.decode()))
            if len(out) == 1000:
                yield _arrow(out, _NODE)
                out = []
        yield _arrow(out, _NODE)

    dealt = leaves.select("tree", "n", "pos", "digest", F.floor(F.col("pos") / BLOCK).alias("block"))
    return dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(up, "tree long, n long, pos long, digest string")


_NODE = [("tree", pa.int64()), ("n", pa.int64()), ("pos", pa.int64()), ("digest", pa.string())]
_PROOF = [("tree", pa.int64()), ("pos", pa.int64()), ("proof", pa.string()), ("path", pa.binary()), ("top", pa.string()), ("root", pa.string())]


def _arrow(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])


def lower_proofs(leaves: DataFrame, messages: DataFrame, keep: list[str], claim: str | None) -> DataFrame:
    """Proof, path, top, root of every leaf, the columns `keep` (long or text), and the root that its `claim` folds to.

    `messages` has (tree, pos, proof, path, top, root) of the node above each block; pos is the number of the block.
    """
    kinds = dict(leaves.dtypes)
    kept = [(c, pa.string() if kinds[c] == "string" else pa.int64()) for c in keep]
    fields = [*_PROOF, *kept, *([("folded_root", pa.string())] if claim else [])]

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, _), rows in _blocks(batches, ("pos", "n", "digest", "proof", "path", "top", "root", *keep, *([claim] if claim else []))):
            _, _, _, proof, path, top, root = rows[0][:7]  # the message
            own = rows[:0:-1]
            nodes = sweep_up([r[2].encode() for r in own], min(RAISED, levels_above(own[0][1])))
            for k, proof_of, path_of in sweep_down(nodes, proof.encode(), path):
                pos, *_ = row = own[k]
                claimed = (fold(row[-1].encode(), proof_of, path_of).decode(),) if claim else ()
                out.append((tree, pos, proof_of, path_of, top, root, *row[7:7 + len(keep)], *claimed))
            if len(out) >= 2000:
                yield _arrow(out, fields)
                out = []
        yield _arrow(out, fields)

    typed = lambda names: [F.lit(None).cast(t).alias(n) for n, t in names]
    message_fields = (("proof", "string"), ("path", "binary"), ("top", "string"), ("root", "string"))
    more = [(c, kinds[c]) for c in [*keep, *([claim] if claim else [])]]
    rows = leaves.select("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "n", "digest", *typed(message_fields), *[n for n, _ in more])
    sent = messages.select("tree", F.col("pos").alias("block"), F.lit(_MESSAGE).alias("pos"), F.lit(None).cast("long").alias("n"),
                           F.lit(None).cast("string").alias("digest"), *[n for n, _ in message_fields], *typed(more))
    queue = rows.union(sent).repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("pos").desc())
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return queue.mapInArrow(down, ", ".join(f"`{n}` {names[t]}" for n, t in fields))


def rounds_up(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes at each round below the last, and (tree, digest) of the roots. Leaves: tree, n, pos, digest and more."""
    rounds, roots = [leaves], None
    while True:
        above = stage(raise_blocks(rounds[-1]))
        done = above.where("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.union(done)
        rest = above.where("n > 1")
        if rest.isEmpty():
            return rounds, roots
        rounds.append(rest)


def rounds_down(rounds: list[DataFrame], tops: DataFrame, keep: list[str], claim: str | None) -> DataFrame:
    """Proofs of the leaves of the first round; `tops` has (tree, pos = 0, proof, path, top, root) of each tree's root."""
    messages = None
    for k in range(len(rounds) - 1, -1, -1):
        # A tree of one block gets the message of its root here; trees that went on get those of their next round.
        whole = rounds[k].where(F.col("n") <= BLOCK).select("tree").distinct()
        sent = tops.join(whole, "tree", "left_semi").select("tree", "pos", "proof", "path", "top", "root")
        messages = sent if messages is None else sent.unionByName(messages)
        if k:
            messages = stage(lower_proofs(rounds[k], messages, [], None))
    return lower_proofs(rounds[0], messages, keep, claim)


def manifest(rows: DataFrame, tree: str, key: str, leaf: str, claim: str | None = None) -> DataFrame:
    """key, leaf, subroot, root, proof and path of every row; with `claim` also folded_root.

    Rows with equal `tree` form one tree, its leaves in the order of `key`, then `leaf` (hexadecimal digests); eight consecutive nodes
    are gathered by the SHA-256 of their digests, the last run with fewer, until one is left: the subroot. The subroots, in
    the order of `tree`, are gathered likewise to the root. `proof` holds the siblings' digests from the leaf to the root one behind the
    other, `path` the place and length of each run (see `sweep_down`); `fold` checks one against a root. `claim` is a column with another digest
    for the row; folded_root is what it leads to with the siblings of the row.

    Nulls in `tree` and `key` come first and are values like others; equal rows are leaves of their own. A null leaf isn't allowed (leaf_digest
    has none). Other columns are ignored; an empty table gives an empty table.
    """
    columns = [F.col(tree).alias("group"), F.col(key).alias("key"), F.col(leaf).alias("digest")]
    if claim:
        columns.append(F.col(claim).alias("claim"))
    ordered = placed(rows.select(*columns), "group", ["group", "key", "digest"])
    sizes = stage(ordered.groupBy("group").agg(F.count("*").alias("n")).withColumn("all", F.lit(0)))
    trees = stage(placed(sizes, "all", ["all", "group"], "tree").drop("all"))
    named = ordered.join(trees.withColumnRenamed("group", "_group"), F.col("group").eqNullSafe(F.col("_group"))).drop("group", "_group")
    leaves = stage(named)
    rounds, subroots = rounds_up(leaves)
    n_trees = trees.count()
    upper = stage(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("pos"), "digest"))
    upper_rounds, roots = rounds_up(upper)
    top = roots.select("tree", F.lit(0).cast("long").alias("pos"), F.lit("").alias("proof"), F.lit("").cast("binary").alias("path"),
                       F.col("digest").alias("top"), F.col("digest").alias("root"))
    tops = stage(rounds_down(upper_rounds, top, ["digest"], None).select(
        F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "proof", "path", F.col("digest").alias("top"), "root"))
    keep = ["key", "digest"]
    found = rounds_down(rounds, tops, keep, "claim" if claim else None)
    return found.select(F.col("key").alias(key), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root", "proof", "path",
                        *(["folded_root"] if claim else []))
