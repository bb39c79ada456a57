import hashlib
import zlib

import numpy as np
import pytest

from touchline.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    """conv_id -> [(role, text)] in order."""
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(
        f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).digest())
    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    rows = set()
    for node, cs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        inner = {x[:-1] for x in members if x}
        ends = sorted(c for c in cs if len(convs[c]) == len(node))
        rows.add((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs),
                  sum(len(x) == len(node) + 1 for x in below), sum(x not in inner for x in below),
                  sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
                  hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


def got(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, n=60, turns=9, words=3):
    r = np.random.default_rng(seed)
    ids = r.choice(np.arange(-150, 450), n, replace=False)
    return [(int(c), int(t), "user" if t % 2 == 0 else "assistant", "w" * int(r.integers(1, words)))
            for c in ids for t in range(int(r.integers(1, turns)))]


@pytest.mark.parametrize("stretch, shard_rows", [(4096, 100_000), (4096, 20), (2, 15), (3, 1000), (1, 7)])
def test_equals_brute_force(spark, stretch, shard_rows):
    rows = made(stretch + shard_rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    convs = sequences(rows)
    assert got(P.trie(df, stretch, shard_rows)) == brute(convs)
    assert got(P.rebuilt_trie(df, stretch=stretch, shard_rows=shard_rows)) == brute(rebuilt(convs))


def test_one_long_conversation_and_hot_first_turn(spark):
    rows = [(7, t, "user", f"t{t % 3}") for t in range(300)]
    rows += [(c, t, "user", f"t{t}") for c in range(1000, 1060) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(P.trie(df, stretch=16, shard_rows=40)) == brute(sequences(rows))


def test_many_members_of_one_node_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(P, "ID_BLOCK", 7)
    rows = [(c, 0, "user", "hello") for c in range(95, 1105, 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(P.trie(df, shard_rows=50)) == brute(sequences(rows))


def test_odd_rows(spark):
    big = (1 << 60) + 1
    rows = [(None, 0, "user", "lost"), (None, None, None, None), (1, None, None, None), (1, 0, "user", None),
            (1, 0, "user", None), (1, 0, "", "user"), (2, 1, "us", "er"), (2, 1, "u", "ser"), (big, 0, "user", "x" * 50_000),
            (big + 2, 0, "user", "x" * 50_000), (big + 2, -5, None, "\U0001F600é"), (-7, None, "a", ""), (200, 3, "a", "b")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", pos long, digest long, shard long").repartition(3)
    convs = sequences(rows)
    assert got(P.trie(df)) == brute(convs)
    assert got(P.rebuilt_trie(df)) == brute(rebuilt(convs))


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.trie(empty).count() == 0 and P.rebuilt_trie(empty).count() == 0
    assert P.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(1)
    keys = P.distinct_keys(r.integers(0, 1 << 63, (20_000, 2), np.uint64))
    table = P.SlotTable(keys)
    assert sorted(table.verified(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        table.verified(r.integers(0, 1 << 63, (50, 2), np.uint64))
    with pytest.raises(ValueError):
        P.SlotTable(np.repeat(keys[:1], 2, axis=0))
    assert len(P.SlotTable(np.zeros((0, 2), np.uint64)).keys) == 0


def test_a_digest_collision_is_an_error(spark, monkeypatch):
    import pandas as pd
    rows = pd.DataFrame({"shard": 0, "conv_id": [1, 1, 2, 2], "pos": [0, 1, 0, 1], "chars": [0, 1, 0, 1], "n_turns": 1,
                         "turn_key": [None, b"a" * 16, None, b"b" * 16], "digest": [P.ROOT, None, P.ROOT, None]})
    assert len(P._local_nodes(rows)) == 3
    monkeypatch.setattr(P, "turn_value", lambda key: 5)
    with pytest.raises(ValueError):
        P._local_nodes(rows)
