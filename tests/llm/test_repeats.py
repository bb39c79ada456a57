"""Substring and suffix-array deduplication against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

from touchline.llm import repeats, substring, suffixarray

from .conftest import CLASHING, ODD


def plain_bytes(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i:i + 200] for _, b in texts for i in range(len(b) - 199))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def plain_words(rows):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    low = {}
    for d, w in texts:
        for i in range(len(w) - 49) if d is not None else ():
            k = tuple(w[i:i + 50])
            low[k] = min(low.get(k, d), d)
    out = []
    for d, w in texts:
        gone = np.zeros(len(w) + 1, bool)
        for i in range(len(w) - 49) if d is not None else ():
            if low[tuple(w[i:i + 50])] < d:
                gone[i:i + 50] = True
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def fixture_rows():
    rng = random.Random(5)
    words = ["alpha", "be", "gamma", "dé", "eps", "z"] + [f"w{k}" for k in range(300)]
    passages = [" ".join(rng.choices(words, k=n)) for n in (60, 90, 55, 200, 48, 50, 51)]
    rows = []
    for i in range(120):
        t = " ".join(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(0, 60)))
                     for _ in range(rng.randint(0, 5)))
        if rng.random() < 0.2 and t:
            k = rng.randrange(len(t))
            t = t[:k] + "X" + t[k + 1:]
        rows.append((i, t))
    odd = [(400 + k if d is not None else None, t) for k, (d, t) in enumerate(ODD) if t is None or len(t) < 5000]
    return rows + odd + [(None, passages[3]), (202, "Thor " * 400), (203, "Thor " * 300 + passages[0]), (203, passages[3]),
                         (7, rows[7][1]), (300, "a" * 900), (301, "ab" * 150), (302, "b" * 200)]


@pytest.mark.parametrize("max_group", [repeats.MAX_GROUP, 20, 3, 1])
def test_against_brute_force(documents, max_group):
    rows = fixture_rows()
    df = documents(rows, CLASHING)
    assert sorted((tuple(r) for r in suffixarray.digest(df, max_group).collect()), key=str) == plain_bytes(rows)
    assert sorted((tuple(r) for r in substring.digest(df, max_group).collect()), key=str) == plain_words(rows)


def test_long_texts_kept_parts_and_empty_tables(documents):
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(1, f"head {passage} tail"), (2, f"other {passage}"), (3, "x" * 60_000), (4, "word " * 20_000)]
    df = documents(rows)
    kept = {r.doc_id: r.kept for r in substring.remove_repeats(df).collect()}
    assert kept[1] == f"head {passage} tail" and kept[2] == "other"
    cut = {r.doc_id: r for r in suffixarray.remove_repeats(df).collect()}
    assert bytes(cut[1].kept) == b"head tail" or bytes(cut[1].kept) == b"headtail"
    assert [tuple(s) for s in cut[3].spans] == [(0, 60_000)]
    for op in (substring, suffixarray):
        assert op.digest(df.limit(0)).count() == 0


def test_every_window_has_an_anchor_that_depends_on_its_content_alone():
    rng = np.random.default_rng(3)
    codes = rng.integers(1, 4, 3000).astype(np.uint64)
    codes[1000:1400] = codes[200:600]
    hashes = repeats.gram_hashes(codes, 8)
    at, first, last = repeats.anchors(hashes, 43)
    picked = {}
    for p, a, z in zip(at.tolist(), first.tolist(), last.tolist()):
        for w in range(a, z + 1):
            assert w <= p <= w + 42
            picked[w] = p - w
    assert sorted(picked) == list(range(3000 - 49))
    assert all(picked[200 + k] == picked[1000 + k] for k in range(350))


@pytest.mark.parametrize("scheme", [substring.SCHEME, suffixarray.SCHEME])
def test_longer_keys_depend_on_the_window_alone_and_leave_none_out(scheme):
    span, longest = scheme.width - scheme.gram, []
    for step in scheme.steps:
        sides = {}
        for place in range(span + 1):
            for n in {1, 2, step, place + 1} & set(range(1, place + 2)):
                runs = list(repeats.cells(place, n, span, step))
                assert [k for a, z, _, _ in runs for k in range(a, z + 1)] == list(range(n))
                for a, z, left, right in runs:
                    for k in range(a, z + 1):
                        at = place - k
                        assert left <= at and at + scheme.gram + right <= scheme.width  # inside the window
                        assert sides.setdefault(at, (left, right)) == (left, right)     # by its place alone
        longest.append(min(map(sum, sides.values())))
    assert 0 < longest[0] < longest[1] < span


def test_large_groups_are_dealt_by_longer_keys(spark, documents, monkeypatch):
    """One phrase in every row: no group handed to a task is above the bound, and nothing is lost."""
    words = [f"w{k}" for k in range(400)]
    rng, phrase = random.Random(8), "the same eight words stand in every text"
    passage = " ".join(rng.choices(words, k=60))
    rows = [(k, " ".join(rng.choices(words, k=45)) + f" {phrase} " + " ".join(rng.choices(words, k=45))
             + (f" {passage}" if k % 3 == 0 else "")) for k in range(90)]
    rows += [(100 + k, rows[k][1]) for k in range(0, 90, 9)]
    sizes, real = [], repeats.matches

    def watched(found, scheme):
        sizes.append(found.groupBy("key").count().agg({"count": "max"}).first()[0] or 0)
        return real(found, scheme)
    monkeypatch.setattr(repeats, "matches", watched)
    df = documents(rows)
    got = sorted((tuple(r) for r in substring.digest(df, 8).collect()), key=str)
    assert got == plain_words(rows) and len(sizes) > 1 and max(sizes) <= 8
    del sizes[:]
    got = sorted((tuple(r) for r in suffixarray.digest(df, 8).collect()), key=str)
    assert got == plain_bytes(rows) and len(sizes) > 1 and max(sizes) <= 8


def test_long_texts_are_cut_into_stretches(documents, monkeypatch):
    """Same result with stretches of a few windows (workers are in-process copies, so call directly)."""
    text = " ".join(f"w{k % 97}x{k % 31}" for k in range(4000)).encode()
    whole = list(repeats.stretches(text, 200))
    monkeypatch.setattr(repeats, "STRETCH", 300)
    cut = list(repeats.stretches(text, 200))
    assert len(whole) == 1 and sum(len(u) - 199 for _, u in cut) == len(text) - 199
    assert all(text[s:s + len(u)] == u for s, u in cut)

    def windows(parts):
        out = {}
        for start, units in parts:
            hashes = repeats.gram_hashes(suffixarray.codes(units), 16)
            for p, a, z in zip(*(x.tolist() for x in repeats.anchors(hashes, 185)), strict=True):
                out.update({start + w: p - w for w in range(a, z + 1)})
        return out
    assert windows(whole) == windows(cut)
    assert list(repeats.stretches(b"short", 200)) == []


def test_cover_ranks_tell_equal_stretches_apart():
    rng = np.random.default_rng(4)
    grid = rng.integers(0, 2, (40, suffixarray.COLUMNS)).astype(np.uint8)
    grid[20:] = grid[:20]
    grid[30, 300] ^= 1
    ranks = suffixarray.cover_ranks(np.ascontiguousarray(grid).view(">u8").astype(np.uint64))
    for j, rank in enumerate(ranks):
        a = j * suffixarray.STEP
        parts = [grid[i, a:a + suffixarray.MIDDLE].tobytes() for i in range(40)]
        for x in range(40):
            assert (rank[x] == rank[x - 20]) == (parts[x] == parts[x - 20])
