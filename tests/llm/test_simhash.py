import random

import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from touchline.llm import simhash as S
from touchline.llm.components import components

from .conftest import CLASHING, ODD


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
        "\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes):
    """Least position of each position's group."""
    up = list(range(len(codes)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(codes):
        for j in range(i):
            if bin(int(a) ^ int(codes[j])).count("1") <= 3:
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(codes))]


def near_codes(rng, n, seeds):
    base = rng.integers(0, 2**63, seeds, dtype=np.uint64)[rng.integers(0, seeds, n)]
    for _ in range(int(rng.integers(0, 7))):
        flip = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        base = base ^ np.where(rng.random(n) < 0.6, flip, np.uint64(0))
    return np.unique(base)


def test_fingerprints_match_the_contract(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()
    for text in [r.text for r in rows] + [None, "", " ", "One", "one TWO", "É é A\u2003b c d"]:
        assert S.fingerprint(text) == plain_fingerprint(text)


def test_index_finds_all_neighbours_and_groups():
    rng = np.random.default_rng(8)
    for _ in range(25):
        codes = near_codes(rng, int(rng.integers(1, 300)), 6)
        codes = codes[np.argsort(S.gray_rank(codes))]
        index = S.GrayIndex(codes)
        q, node = index.search(codes, 3)
        far = np.bitwise_count(codes[:, None] ^ codes[None, :])
        assert {(int(a), int(b)) for a, b in zip(q, node)} == {(int(a), int(b)) for a, b in zip(*np.nonzero(far <= 3))}
        assert index.connected(3, step=16).tolist() == plain_groups(codes)
        key = rng.integers(0, 3, len(codes))
        a, b = S.bucket_links(key, codes, np.arange(len(codes)), 3)
        assert all(far[x, y] >= 0 and key[x] == key[y] for x, y in zip(a, b))


def test_gray_rank_orders_like_the_reflected_sequence():
    assert S.gray_rank(np.array([k ^ (k >> 1) for k in range(64)], np.uint64)).tolist() == list(range(64))


@pytest.mark.parametrize("max_bucket", [4096, 2])
def test_links_connect_the_same_groups(spark, max_bucket):
    codes = near_codes(np.random.default_rng(9), 250, 9)
    df = spark.createDataFrame([(int(c.view(np.int64)), i) for i, c in enumerate(codes)], "fp long, node long")
    sets = {r.node: r.component for r in components(S.links(df, 3, max_bucket)).collect()}
    assert [sets.get(i, i) for i in range(len(codes))] == plain_groups(codes)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 600)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{k: 500 for k in range(501, 600)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_and_stage(spark, documents):
    text = "the quick brown fox jumps over the lazy dog again and again until the night comes and all is quiet " * 3
    rows = [*ODD, (50, text), (49, text.upper()), (51, text + "x"), (60, "entirely different text with its own words")]
    df = documents(rows, CLASHING)
    got = S.digest(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.fingerprint == f"{plain_fingerprint(dict((i, t) for i, t in rows if i == r.doc_id).get(r.doc_id)):016x}" \
            if r.doc_id not in (None, 5) else True
    sets = {r.doc_id: r.component_id for r in got}
    assert sets[50] == sets[49] == 49 and sets[5] == 4 and sets[1] == sets[2] == sets[3] == 1
    kept = S.first_of_groups(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({sets[i] for i in sets if i is not None})
    assert S.digest(df.limit(0)).count() == 0 and S.first_of_groups(df.limit(0)).count() == 0


def test_repeated_ids_with_unrelated_texts(documents):
    rng = random.Random(21)
    a, b, c, d = (" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(80)) for _ in range(4))
    df = documents([(5, a), (5, b), (5, b), (7, a), (8, b), (3, c), (9, c), (9, d), (4, d), (5, c)], CLASHING)
    kept = sorted((r.doc_id, r.text) for r in S.first_of_groups(df).collect())
    assert kept == sorted([(5, a), (5, b), (3, c), (4, d)])
