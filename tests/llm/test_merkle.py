import zlib

import pytest

from pyspark.sql import functions as F

from touchline.llm import merkle as M

from .conftest import CLASHING, DOCS, ODD

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def leaf(r, text):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return M.sha("".join(map(enc, (r[0], r[3], r[2], r[4], text))))


def fold(nodes, fan):
    """(root, [per leaf the list of (left, right) siblings])."""
    paths, at = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        new, new_at = [], []
        for i in range(0, len(nodes), fan):
            run = nodes[i:i + fan]
            for k in range(len(run)):
                for x in at[i + k]:
                    paths[x].append((run[:k], run[k + 1:]))
            new.append(M.sha("".join(run)))
            new_at.append([x for k in range(len(run)) for x in at[i + k]])
        nodes, at = new, new_at
    return nodes[0], paths


def brute(rows, fan=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((leaf(r, r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    trees = {s: fold([x[0] for x in groups[s]], fan) for s in names}
    root, tops = fold([trees[s][0] for s in names], fan)
    out = []
    for k, s in enumerate(names):
        for (d, r), path in zip(groups[s], trees[s][1], strict=True):
            end = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                low = r[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
                end = leaf(r, low)
            proof = ""
            for left, right in path + tops[k]:
                end = M.sha("".join(left) + end + "".join(right))
                proof += "".join(left + right)
            out.append((r[0], d, trees[s][0], root, M.sha(proof), end, end == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def rows_of(sizes):
    return [(1000 * k + i, f"Text {i} Of {s}", "en", s, i) for k, (s, n) in enumerate(sizes) for i in range(n)]


@pytest.mark.parametrize("fan, levels", [(16, 3), (2, 1), (2, 2), (3, 2)])
def test_equals_brute_force(spark, fan, levels):
    rows = rows_of([(None, 3), ("", 1), ("b", 40), ("a", 17), ("é", 16), ("hot", 130), ("z", 2)])
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    assert got(M.manifest(df, M.tampered_fifth(), fan, levels)) == brute(rows, fan)


def test_a_proof_alone_gives_the_root(spark):
    df = spark.createDataFrame(rows_of([("a", 20), ("b", 3)]), DOCS)
    for r in M.manifest(df, F.lit(False)).collect():
        assert M.folded(r["leaf"], r["proof"]) == r["root"] and r["verified"]
        assert M.sha(M.siblings(r["proof"])) == r["proof_sha256"]


def test_many_sources_and_one_large(spark):
    rows = rows_of([("hot", 4500)] + [(f"s{i}", 1) for i in range(300)])
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    result = got(M.digest(df))
    assert result == brute(rows)
    assert len({r[3] for r in result}) == 1 and 0 < sum(r[6] for r in result) < len(result)


def test_one_document(spark):
    rows = [(3, "A", None, "s", None)]
    result = got(M.digest(spark.createDataFrame(rows, DOCS)))
    assert result == brute(rows) and result[0][1] == result[0][2] == result[0][3]


def test_odd_rows(spark):
    big = (1 << 60) + 1
    rows = [(d, t, None if i % 3 else "en", "s" if i % 2 else None, None if i % 4 else i) for i, (d, t) in enumerate(ODD)]
    rows += [(big, "A", "en", "s", 1), (big + 2, "B", "en", "s", 1), (None, "C", "en", "s", 1), (4, "x,y;Z", "en", "s", 9),
             (4, "same", "en", "s", 9), (4, "same", "en", "s", 9)]
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    for name in CLASHING + ("tree", "pos", "leaf", "all", "name", "other", "n"):
        df = df.withColumn(name, F.lit(name))
    assert got(M.digest(df)) == brute(rows)


def test_empty(spark):
    assert M.digest(spark.createDataFrame([], DOCS)).count() == 0


def test_queue_stays_small():
    up = M.Sweep(4096, 3, 16)
    for k in range(4096):
        up.leaf(k, M.sha(str(k)))
    assert up.most <= 16 * 3 and len(up.tops) == 1
