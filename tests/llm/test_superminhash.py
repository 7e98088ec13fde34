"""SuperMinHash near-dedup against all pairs, and its signatures against the step-by-step rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marshlight.llm import superminhash
from marshlight.llm.text import scramble
from tests.llm.frames import awkward, documents, empty
from tests.llm.test_jaccard import brute, corpus


@pytest.mark.parametrize(("seed", "width", "percent", "tile"), [(4, 3, 85, 512), (5, 5, 80, 8), (6, 3, 85, 4)])
def test_groups_are_those_of_all_pairs(spark, seed, width, percent, tile):
    rows = corpus(seed)
    df = documents(spark, [(i, t, "en", "a") for i, t in rows])
    got = superminhash.near_duplicates(df, width, percent, tile).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, width, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_awkward_and_empty_tables(spark):
    got = superminhash.near_duplicates(awkward(spark), 3, 85).collect()
    assert len(got) == 13
    by = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in got}
    assert by[1, 0] == (1, True) and by[4, 1] == (4, True) and by[None, 0] == (None, True)
    assert next(c for (i, n), c in by.items() if i == 7) == (6, False)
    assert superminhash.near_duplicates(empty(spark)).count() == 0


def test_rows_repeated_very_often_are_one_node(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words), "en", "a")] * 2000 + [(2, " ".join(words[:-3]), "en", "a")] * 2000 + [(None, " ".join(words[3:]), "en", "a")] * 50
    got = superminhash.near_duplicates(documents(spark, rows), 3, 85).collect()
    assert len(got) == 4050 and {r["component_id"] for r in got} == {1}
    assert sum(r["kept"] for r in got) == 2000


def test_pairs_just_below_the_limit_are_not_handed_on(spark):
    """Copies of one text with changed words: most pairs share bands and have sketches that allow a link, few sets do."""
    rng = np.random.default_rng(8)
    base, rows = [f"w{i}" for i in range(150)], []
    for doc in range(300):
        words = list(base)
        for k, at in enumerate(rng.choice(150, 4, replace=False)):
            words[at] = f"x{doc}_{k}"
        rows.append((doc, " ".join(words), "en", "a"))
    df = documents(spark, rows)
    nodes = superminhash.measured_sets(df, 3).withColumn("root", F.col("node")).persist()
    buckets = nodes.select(F.posexplode("keys").alias("band", "key"), "node", "root")
    sets = [set(zip(w, w[1:], w[2:])) for w in (r[1].split() for r in rows)]
    close = sum(100 * len(x & y) >= 82 * len(x | y) for i, x in enumerate(sets) for y in sets[:i])
    got = superminhash.open_pairs(buckets, nodes, 85, 512, False).count()
    assert got <= close < 300 * 299 // 2 // 20
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in superminhash.near_duplicates(df, 3, 85).collect()} == brute([r[:2] for r in rows], 3, 85)


def test_the_bound_of_bitmaps_lies_above_the_overlap():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**64, 9000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, k, replace=False)) for k in (1, 9, 900, 1000, 1100, 2100, 5000)]
    i, j = np.triu_indices(len(sets), 1)
    got = superminhash.most_common([superminhash.bitmap(s) for s in sets], np.array([len(s) for s in sets]), i, j)
    assert all(len(np.intersect1d(sets[a], sets[b])) <= g <= min(len(sets[a]), len(sets[b])) for a, b, g in zip(i, j, got))


def one_by_one(elements, places):
    """The rule for one set, an element after the other, every step taken."""
    out = [2**64 - 1] * places
    for e in elements:
        order, state = list(range(places)), int(e)
        for j in range(places):
            state = (state + int(superminhash._STEP)) % 2**64
            drawn = int(scramble(np.array([state], dtype=np.uint64))[0])
            k = j + (drawn >> 32) % (places - j)
            order[j], order[k] = order[k], order[j]
            out[order[j]] = min(out[order[j]], j << 32 | drawn & 0xFFFFFFFF)
    return out


def test_signatures_stop_early_without_changing_anything():
    rng = np.random.default_rng(9)
    sizes = [0, 1, 2, 9, 40, 400]
    elements = rng.integers(0, 2**64, sum(sizes), dtype=np.uint64)
    starts = np.cumsum([0, *sizes])
    got = superminhash.signatures(elements, starts, 32)
    for k in range(len(sizes)):
        assert got[k].tolist() == one_by_one(elements[starts[k]:starts[k + 1]], 32)


def test_estimates_vary_less_than_independent_hashes_do():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(150):
        pool = rng.integers(0, 2**64, 115, dtype=np.uint64)
        a, b = pool[:100], pool[15:]  # similarity 85 / 115
        s = superminhash.signatures(np.concatenate([a, b]), np.array([0, 100, 200]))
        errors.append((s[0] == s[1]).mean() - 85 / 115)
    independent = (85 / 115) * (30 / 115) / superminhash.PLACES
    assert abs(np.mean(errors)) < 0.01 and np.var(errors) < 0.85 * independent
