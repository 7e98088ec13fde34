"""The n-gram Jaccard join against all pairs, on small tables with large groups."""

import random

import numpy as np
import pytest

from marshlight.llm import jaccard, text
from tests.llm.frames import awkward, documents, empty


def shingles(words, width):
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def brute(rows, width, percent):
    sets = {i: shingles((t or "").encode().lower().split(), width) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=260):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 5)))
    base = [[word() for _ in range(rng.choice([2, 3, 5, 8, 40, 120, 300]))] for _ in range(40)]
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(n):
        words = list(base[0] if i % 3 == 0 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = word()
        if rng.random() < 0.3:
            words += passage
        rows.append((i, rng.choice([" ", "\n"]).join(words).replace("a", "A" if rng.random() < 0.5 else "a")))
    return rows


@pytest.mark.parametrize(("seed", "width", "percent", "tile"), [(1, 4, 85, 1024), (2, 5, 80, 8), (3, 4, 85, 4)])
def test_groups_are_those_of_all_pairs(spark, seed, width, percent, tile):
    rows = corpus(seed)
    df = documents(spark, [(i, t, "en", "a") for i, t in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_groups(df, width, percent, tile).collect()}
    assert got == brute(rows, width, percent)


def test_groups_of_awkward_tables(spark):
    got = jaccard.link_groups(awkward(spark)).collect()
    assert len(got) == 13
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert by[1, 0] == 1 and by[3, 0] == 3 and by[4, 1] == 4
    assert next(c for (i, n), c in by.items() if i == 7) == 6
    assert jaccard.link_groups(empty(spark)).count() == 0


def test_repeated_rows_do_not_multiply(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    df = documents(spark, [(1, " ".join(words), "en", "a")] * 400 + [(2, " ".join([*words, "end"]), "en", "a")] * 400)
    seen = []
    checked = jaccard.verified

    def counting(pairs, sets, percent):
        out = checked(pairs, sets, percent)
        seen.append((sets.count(), out.count()))
        return out

    monkeypatch.setattr(jaccard, "verified", counting)
    out = jaccard.link_groups(df).collect()
    assert len(out) == 800 and {r["component_id"] for r in out} == {1}
    assert seen and all(pair == (2, 1) for pair in seen)


def test_word_hashes_are_those_of_single_words():
    texts = [b"The end", b"", b"  the\tEND \x0b x", "é É".encode(), b"the"]
    words, counts = text.word_hashes(texts)
    assert counts.tolist() == [2, 0, 3, 2, 1]
    assert words[0] == words[2] == words[7] and words[1] == words[3] and words[5] != words[6]
    alone = [text.word_hashes([w])[0][0] for w in (b"zz the", b"the")]
    assert alone[1] == words[0]
    many = [f"w{i}".encode() for i in range(50_000)]
    assert len(np.unique(text.word_hashes([b" ".join(many)])[0])) == 50_000


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(3)
    for n, m, both in ((10, 12, 8), (500, 480, 450), (3000, 2600, 100)):
        pool = rng.integers(0, 2**63, n + m - both, dtype=np.int64).astype(np.uint64)
        a, b = pool[:n], pool[n - both:]
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        size = min(len(x), len(y))
        x, y = jaccard.fold_to(x, size), jaccard.fold_to(y, size)
        assert n - int(np.bitwise_count(x & ~y).sum()) >= both
        assert (jaccard.fold_to(jaccard.bitmap(a), size) == x).all()
