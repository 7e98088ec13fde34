"""The prefix trie against one built of dictionaries."""

import random
from hashlib import md5, sha256
from zlib import crc32

import numpy as np
import pytest

from marshlight.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string, n string, level string, size string, d1 string"
CLASH = ("x",) * 6


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), md5(f"{len(role.encode())}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def plain(rows):
    paths = rebuilt(rows)
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, own in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in own if len(paths[c]) == len(p))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(children.get(p, [])), sum(q not in children for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **sizes):
    turns, conversations = prefix_trie.shared_heads(frame(spark, rows), family=5, heads=9)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(turns, conversations, **sizes).collect()), key=repr)


def talk(seed, n, hot=0.0):
    rng = random.Random(seed)
    texts = ["hello", "yes é", "no", "", None, "tell me more"]
    rows = []
    for c in range(n):
        if rng.random() < hot:
            turns = [("user", "hello"), ("assistant", "hi"), ("user", "bye")]
        else:
            turns = [(rng.choice(["user", "assistant", None]), rng.choice(texts)) for _ in range(rng.choice([1, 2, 3, 5, 12]))]
        rows += [(c - 7, None if k == 0 and rng.random() < 0.2 else k, r, t) for k, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "n", "hot", "sizes"), [(1, 60, 0.0, {}), (2, 90, 0.5, {"limit": 2, "shard": 5}), (3, 120, 0.3, {"limit": 4, "shard": 50})])
def test_nodes_are_those_of_a_plain_trie(spark, seed, n, hot, sizes):
    rows = talk(seed, n, hot)
    assert run(spark, rows, **sizes) == plain(rows)


def test_repeated_rows_null_ids_and_long_conversations(spark):
    rows = [(10, 1, "user", "same")] * 400 + [(11, 1, "user", "same")] * 30 + [(None, 1, "user", "x")] * 20 + [(12, k, "user", f"t{k}") for k in range(300)]
    rows += [(3, 0, "user", "a long text " * 5000), (20, None, None, None)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_perfect_hash_has_a_slot_for_each_name_and_rejects_others():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 50_000):
        a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
        table = prefix_trie.PerfectHash(a, b)
        assert sorted(table.find(a, b)) == list(range(n))
        assert (table.find(a + np.uint64(1), b) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.PerfectHash(np.zeros(2, dtype=np.uint64), np.zeros(2, dtype=np.uint64))


def test_ends_of_one_node_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    ids = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(1, 2, i) for i in ids] + [(1, 3, 5)], "d1 long, d2 long, conv_id long").repartition(5)
    got = {(r["d1"], r["d2"]): r["ends_sha256"] for r in prefix_trie._ends(df).collect()}
    assert got == {(1, 2): sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), (1, 3): sha256(b"5").hexdigest()}
