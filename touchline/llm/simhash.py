"""SimHash near-duplicates through a Gray-order hierarchical index.

A text's fingerprint takes each of 64 bits from the majority of its shingles'
hashes. Distinct fingerprints within ``max_bits`` differing bits are linked;
documents linked directly or through others form one group.

Blocking: the 64 bits are dealt into ``max_bits + 1`` sets, so two
fingerprints within the limit agree on at least one set entirely and meet in
that set's bucket. A bucket above ``max_bucket`` rows is split again by a
second and third way to deal the bits, which is exact for the same reason;
no bucket is capped.

Index of a bucket: fingerprints are sorted by Gray rank, which puts codes
with long common patterns side by side. Every run of ``FAN`` neighbours gets
a parent that holds the bits they share (mask and pattern); children keep
only the rest. A query walks down from the roots, adding the differences with
each node's own bits, and drops a whole group once the sum passes the limit.
Groups whose leaves are already connected with the query are skipped too, so
a bucket full of near copies does not cost all its pairs. A bucket gives at
most one link per fingerprint (to the least of its connected set).

Defined results: NULL and empty texts have fingerprint zero and are linked
like any other. Rows with a NULL doc_id get the component of their
fingerprint but link nothing. Repeated rows get the same answer. An empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import whole_row, written
from touchline.llm.components import components

FAN = 8
SMALL = 16
#: Shingles whose hashes are held at once.
PIECE = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for i in range(0, n, PIECE):
        part = words[i:i + PIECE + shingle - 1]
        grams = map(join, zip(*(part[k:] for k in range(shingle)))) if len(part) >= shingle else [join(part)]
        hashes = np.array([digest(g, seed) for g in grams], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(column: str | Column, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf("long")
    def bits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle, seed) for t in batch], np.uint64).view(np.int64))
    return bits(column)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _settle(label: np.ndarray) -> np.ndarray:
    while True:
        nxt = label[label]
        if np.array_equal(nxt, label):
            return label
        label = nxt


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the sets of a and b; label holds each element's least known member."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        label = _settle(label)
    return label


class GrayIndex:
    """Hierarchical index over fingerprints sorted by Gray rank."""

    def __init__(self, codes: np.ndarray, fan: int = FAN):
        self.codes = codes
        mask = np.full(len(codes), ~np.uint64(0))
        #: From the leaves up: pattern, mask, own bits (those the parent lacks).
        self.levels = [[codes, mask, mask]]
        self.fan = fan
        while len(self.levels[-1][0]) > fan:
            pattern, mask, _ = self.levels[-1]
            starts = np.arange(0, len(pattern), fan)
            first = np.repeat(pattern[starts], fan)[:len(pattern)]
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ first), starts)
            self.levels[-1][2] = mask & ~np.repeat(shared, fan)[:len(pattern)]
            self.levels.append([pattern[starts] & shared, shared, shared])

    def _uniform(self, label: np.ndarray) -> list[np.ndarray]:
        """Per level, the set that all leaves of a node belong to, or -1."""
        out = [label]
        for _ in self.levels[1:]:
            low = out[-1]
            starts = np.arange(0, len(low), self.fan)
            least = np.minimum.reduceat(low, starts)
            out.append(np.where(least == np.maximum.reduceat(low, starts), least, -1))
        return out

    def search(self, queries: np.ndarray, limit: int, skip: list[np.ndarray] | None = None,
               own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All (query number, code number) within ``limit`` bits, but for skipped sets."""
        top = len(self.levels) - 1
        q = np.repeat(np.arange(len(queries)), len(self.levels[top][0]))
        node = np.tile(np.arange(len(self.levels[top][0])), len(queries))
        spent = np.zeros(len(q), np.int64)
        for level in range(top, -1, -1):
            pattern, _, bits = self.levels[level]
            spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & bits[node])
            go = spent <= limit
            if skip is not None:
                go &= skip[level][node] != own[q]
            q, node, spent = q[go], node[go], spent[go]
            if level:
                size = np.minimum(self.fan, len(self.levels[level - 1][0]) - node * self.fan)
                q, spent = np.repeat(q, size), np.repeat(spent, size)
                first = np.repeat(node * self.fan - np.cumsum(size) + size, size)
                node = first + np.arange(len(first))
        return q, node

    def connected(self, limit: int, step: int = 256) -> np.ndarray:
        """For each code, the least number of its connected set."""
        label = np.arange(len(self.codes))
        for i in range(0, len(self.codes), step):
            queries = self.codes[i:i + step]
            q, node = self.search(queries, limit, self._uniform(label), label[i:i + step])
            label = _unite(label, q + i, node)
        return label


def bucket_links(key: np.ndarray, codes: np.ndarray, node: np.ndarray, limit: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its set) within each bucket; any row order."""
    rank = gray_rank(codes)
    order = np.lexsort((rank, key))
    key, codes, node = key[order], codes[order], node[order]
    label = np.arange(len(key))
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(key)])
    small = np.repeat(sizes <= SMALL, sizes)
    a_all, b_all = [], []
    for d in range(1, SMALL):  # a small bucket is a single leaf group
        if d >= len(key):
            break
        near = (key[d:] == key[:-d]) & small[d:]
        if not near.any():
            break
        a = np.flatnonzero(near)
        a = a[np.bitwise_count(codes[a] ^ codes[a + d]) <= limit]
        a_all.append(a)
        b_all.append(a + d)
    if a_all:
        label = _unite(label, np.concatenate(a_all), np.concatenate(b_all))
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        label[s:s + n] = GrayIndex(codes[s:s + n]).connected(limit) + s
    linked = np.flatnonzero(label != np.arange(len(key)))
    return node[linked], node[label[linked]]


def _masks(n: int) -> list[list[int]]:
    """Three ways to deal 64 bits into n sets."""
    ways = [[i * n // 64 for i in range(64)], [i % n for i in range(64)],
            [(i // n + i) % n for i in range(64)]]
    masks = [[sum(1 << i for i in range(64) if way[i] == k) for k in range(n)] for way in ways]
    return [[m - (1 << 64) if m >> 63 else m for m in way] for way in masks]


def links(prints: DataFrame, max_bits: int = 3, max_bucket: int = 4096) -> DataFrame:
    """Links (a, b) that connect what is within ``max_bits``; prints: fp, node (one row per fp)."""
    rows = prints.select("fp", "node", F.lit(0).cast("long").alias("key"))
    ways = _masks(max_bits + 1)
    done = None
    for depth, way in enumerate(ways):
        dealt = rows.select("fp", "node", F.posexplode(F.array(*[
            F.col("fp").bitwiseAND(F.lit(m)) for m in way])).alias("part", "bits"), "key")
        rows = dealt.select("fp", "node", F.xxhash64("key", F.lit(depth), "part", "bits").alias("key"))
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        last = depth == len(ways) - 1
        hot = None
        if not last:
            hot = written(sizes.where(F.col("n") > max_bucket).select("key"), "hot")
            if hot.isEmpty():
                last = True
        cool = rows if last else rows.join(hot, "key", "left_anti")
        done = cool if done is None else done.unionByName(cool)
        if last:
            break
        rows = written(rows.join(hot, "key", "left_semi"), "hotrows")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole buckets at a time: rows arrive sorted by key."""
        held: list[pd.DataFrame] = []
        n = 0

        def flush(frame: pd.DataFrame) -> pd.DataFrame:
            a, b = bucket_links(frame["key"].to_numpy(), frame["fp"].to_numpy().view(np.uint64),
                                frame["node"].to_numpy(), max_bits)
            return pd.DataFrame({"a": a, "b": b})
        for frame in frames:
            held.append(frame)
            n += len(frame)
            if n < 200_000:
                continue
            both = pd.concat(held)
            inner = both["key"] != both["key"].iloc[-1]
            if inner.any():
                yield flush(both[inner])
                both = both[~inner]
            held, n = [both], len(both)
        if held:
            yield flush(pd.concat(held))

    return (done.repartition("key").sortWithinPartitions("key")
            .mapInPandas(search, "a long, b long").distinct())


def _grouped(documents: DataFrame, shingle: int, max_bits: int, seed: int, max_bucket: int) -> DataFrame:
    """doc_id, fp, label (a fingerprint of the group), component_id; one row per input row.

    Fingerprints are the nodes: an id may have several, of unrelated texts.
    """
    prints = written(documents.select("doc_id", fingerprint_column("text", shingle, seed).alias("fp")), "prints")
    distinct = prints.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("least"))
    sets = components(links(distinct.select("fp", F.col("fp").alias("node")), max_bits, max_bucket))
    labelled = written(distinct.join(sets, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label")), "labelled")
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    # Written, so that the last join reads it through an exchange of its own, whose
    # hot fingerprints Spark may split.
    named = written(labelled.join(ids, "label").select(F.col("fp").alias("d_fp"), "label", "component_id"), "named")
    return (prints.join(named, prints["fp"] == F.col("d_fp"), "left")
            .select("doc_id", "fp", "label", "component_id"))


def groups(documents: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42,
           max_bucket: int = 4096) -> DataFrame:
    """doc_id, fp (signed long), component_id; one row per input row."""
    return _grouped(documents, shingle, max_bits, seed, max_bucket).select("doc_id", "fp", "component_id")


def first_of_groups(documents: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """Documents with the least doc_id of their group; the input's columns.

    Documents without an id stay. Of rows that repeat the id of a group's
    first document within that group, one stays.
    """
    found = _grouped(documents, shingle, max_bits, seed, 4096)
    is_first = F.col("doc_id") == F.col("component_id")
    first = written(found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(is_first).alias("is_first"))
        .where("is_first").select(F.col("doc_id").alias("first_id"), "n"), "first")
    rows = documents.select(F.col("doc_id").alias("own_id"), whole_row(documents).alias("doc"))
    # The list grows with the documents, so it is never broadcast, however small today.
    kept = rows.join(first.hint("merge"), F.col("own_id") == F.col("first_id"))
    if not first.where(F.col("n") > 1).isEmpty():
        # Rows of a repeated id are told apart by their fingerprints: one per group that it is the first of.
        chosen = (found.where(is_first).join(first.where(F.col("n") > 1), F.col("doc_id") == F.col("first_id"))
                  .groupBy("doc_id", "label").agg(F.min("fp").alias("c_fp")).withColumnRenamed("doc_id", "c_id"))
        many = (kept.where(F.col("n") > 1).withColumn("fp", fingerprint_column(F.col("doc.text"), shingle, seed))
                .join(chosen, (F.col("own_id") == F.col("c_id")) & (F.col("fp") == F.col("c_fp")))
                .dropDuplicates(["own_id", "fp"]))
        kept = kept.where(F.col("n") == 1).select("doc").unionAll(many.select("doc"))
    return kept.select("doc").unionAll(rows.where(F.col("own_id").isNull()).select("doc")).select("doc.*")


def digest(documents: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return groups(documents, shingle, max_bits, seed).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
