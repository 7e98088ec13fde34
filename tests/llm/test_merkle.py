"""The Merkle manifest against a plain tree built in memory."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from marshlight.llm import merkle
from tests.llm.frames import awkward, empty


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """The root over `leaves` and the siblings of each leaf, upwards."""
    proofs, level, at = [""] * len(leaves), list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, here in enumerate(at):
            run = level[here // 8 * 8:here // 8 * 8 + 8]
            proofs[k] += "".join(run[:here % 8] + run[here % 8 + 1:])
            at[k] = here // 8
        level = [digest(*level[i:i + 8]) for i in range(0, len(level), 8)]
    return level[0], proofs


def plain_manifest(rows):
    """(tree, key, leaf) rows to (key, leaf, subroot, root, proof), in any order."""
    first = lambda v: (v is not None, v if v is not None else 0)
    trees = {}
    for tree, key, leaf in sorted(rows, key=lambda r: (first(r[0]) if r[0] is not None else (False, ""), first(r[1]), r[2])):
        trees.setdefault(tree, []).append((key, leaf))
    subroots = {t: plain_tree([leaf for _, leaf in own]) for t, own in trees.items()}
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    root, above = plain_tree([subroots[t][0] for t in order]) if order else ("", [])
    return sorted(((key, leaf, subroots[t][0], root, subroots[t][1][k] + above[order.index(t)])
                   for t, own in trees.items() for k, (key, leaf) in enumerate(own)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "tree string, key long, leaf string")
    return sorted((tuple(r) for r in merkle.manifest(df, "tree", "key", "leaf").select("key", "leaf", "subroot", "root", "proof").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_manifest_is_that_of_a_plain_tree(spark, seed):
    rng = random.Random(seed)
    rows = [("en", i, digest(str(i))) for i in range(4700)]  # more than one round of blocks
    rows += [("de", i, digest("de", str(i))) for i in range(rng.choice([512, 513]))]
    rows += [(f"lang{k}", k, digest(str(k))) for k in range(20)] + [(None, None, digest("x"))] * 9 + [("é", 1, digest("y")), ("Z", 2, digest("z"))]
    rng.shuffle(rows)
    assert run(spark, rows) == plain_manifest(rows)


def test_one_tree_one_leaf_and_none(spark):
    assert run(spark, [("en", 1, digest("a"))]) == [(1, digest("a"), digest("a"), digest("a"), "")]
    assert run(spark, []) == []


def test_ranges_that_cut_a_group_go_on_counting(spark):
    from marshlight.llm.scan import placed
    rows = [(0 if i % 3 else i, i) for i in range(3000)] + [(None, i) for i in range(500)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = placed(spark.createDataFrame(rows, "g long, x long").repartition(7), "g", ["g", "x"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    groups = {}
    for r in got:
        groups.setdefault(r["g"], []).append((r["x"], r["pos"]))
    assert len(groups[0]) == 2001 and len(groups[None]) == 500  # g is 0 for i = 0 too
    for own in groups.values():
        assert [p for _, p in sorted(own)] == list(range(len(own)))


def test_a_tampered_claim_folds_to_another_root(spark):
    rows = spark.createDataFrame([("en", i, digest(str(i)), digest(str(i) if i % 4 else "other")) for i in range(700)], "t string, k long, leaf string, c string")
    got = merkle.manifest(rows, "t", "k", "leaf", claim="c").collect()
    assert len(got) == 700
    for r in got:
        assert (r["folded_root"] == r["root"]) == bool(r["k"] % 4)
        assert merkle.fold(r["leaf"].encode(), r["proof"].encode(), bytes(r["path"])).decode() == r["root"]


def test_fields_of_leaves(spark):
    row = spark.createDataFrame([(7, None, "ä")], "a long, b string, c string")
    got = row.select(merkle.leaf_digest(F.col("a"), F.col("b"), F.col("c"))).collect()[0][0]
    assert got == digest("1:7", "-", "2:ä")


def test_awkward_and_empty_tables(spark):
    leaf = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    df = awkward(spark).withColumn("leaf", leaf)
    got = merkle.manifest(df, "lang", "doc_id", "leaf").collect()
    assert len(got) == 13 and len({r["root"] for r in got}) == 1
    want = plain_manifest([(r["lang"], r["doc_id"], r["leaf"]) for r in df.collect()])
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in got), key=repr) == want
    assert merkle.manifest(empty(spark).withColumn("leaf", leaf), "lang", "doc_id", "leaf").count() == 0


def test_the_queue_stays_small():
    """Blocks of full size: nodes of each level are right, every proof leads to the top."""
    leaves = [digest(str(i)).encode() for i in range(300)]
    nodes = merkle.sweep_up(leaves, 3)
    assert [len(n) for n in nodes] == [300, 38, 5, 1]
    seen = []
    for at, proof, path in merkle.sweep_down(nodes, b"", b""):
        seen.append(at)
        assert merkle.fold(leaves[at], proof, path) == nodes[3][0]
    assert seen == list(range(299, -1, -1))
