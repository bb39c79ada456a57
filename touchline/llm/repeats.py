"""Repeated windows across texts: sampling, routing and joining back.

Shared by the two substring operators. A text is a sequence of units (words
or bytes), a window is ``width`` consecutive units of one document.

Sampling: every window picks the gram of ``gram`` units in it with the least
hash (leftmost on ties). Equal windows pick the same gram at the same place,
so all windows that could be equal meet under that gram's hash. Neighbouring
windows mostly pick the same gram; each run of them is one anchor row: gram
hash, content hash of the run's text, document, position, number of windows.

Plan: (1) anchor rows are counted by gram hash, with map-side combine; (2)
rows whose gram occurs once cannot match and go; (3) the rest are reduced to
one row per distinct (gram, content), again with map-side combine, so copies
collapse; (4) only those fetch their text, by one equi-join with the
documents; (5) texts are dealt by a key, and each task matches the windows
of whole groups, a bounded block at a time; (6) the matched runs join back to
all anchor rows and are gathered per document.

The key is a stretch of the window of variable length. It starts as the gram.
Where more than ``max_group`` distinct texts share it, it is lengthened to the
units around the gram that lie in the window, up to a multiple of the first of
``Scheme.steps`` on either side; where that is still shared by too many, by
the next, smaller step, which leaves fewer units of the window out. A run of
windows is cut where the stretch changes. What is left after the last step is
keyed by the whole window (its 128-bit digest), where a group is one class and
needs no task of its own: it is aggregated with map-side combine. So no task
holds more than ``max_group`` texts of a group and a block beside them, at any
size of input, and nothing is capped. Texts of one gram are told apart by a
64-bit hash of their content (step 3), which is not compared further; windows
in a group are compared in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import written

#: Odd constants for hashing.
MUL = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Windows handled at once within one text.
STRETCH = 1 << 20
ROWS_PER_BLOCK = 16_384
#: Distinct texts that may share a key (some 8 KB each while they are matched).
MAX_GROUP = 4_096
#: Least (negative: greatest) id of a class without ids. No number that Python sees
#: is ever NULL: pandas would make its column a float and round large ids.
NONE = (1 << 63) - 1


@dataclass(frozen=True)
class Scheme:
    """How texts become units. Functions must be importable (workers load them by name)."""
    width: int
    gram: int
    #: text -> units (anything that ``codes`` and ``cut`` accept)
    units: Callable
    #: units -> uint64 code per unit
    codes: Callable
    #: (units, start, end) -> bytes of that stretch
    cut: Callable
    #: frame of contexts -> (row, first window, last window, least doc) arrays
    match: Callable
    #: bytes of a stretch -> its units
    again: Callable
    #: steps by which keys are lengthened, from large to small
    steps: tuple[int, ...]
    #: whether a window only counts against documents with a smaller id
    ordered: bool


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``gram`` (a power of two) units, mixed."""
    h, size, base = codes, 1, MUL
    with np.errstate(over="ignore"):
        while size < gram:
            h = h[:-size] * base + h[size:]
            base = base * base
            size *= 2
        h = (h ^ (h >> np.uint64(29))) * MIX
        return h ^ (h >> np.uint64(32))


def anchors(hashes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram position, first window, last window) of each run of windows with one pick."""
    if len(hashes) < span:
        return (np.zeros(0, np.int64),) * 3
    low = np.uint64(0xFFFFFF)  # places of a stretch fit in 24 bits
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:len(hashes) - span + 1], least[span - size:])
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    return (least[first] & low).astype(np.int64), first, np.r_[first[1:], len(least)] - 1


def stretches(units, width: int) -> Iterator[tuple]:
    """(first window, units of a stretch of windows); cutting a run of windows in two does no harm."""
    for start in range(0, len(units) - width + 1, STRETCH):
        yield start, units[start:start + STRETCH + width - 1]


ANCHOR = "gram long, body long, did long, h long, pos long, shape int"


def anchor_rows(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """One row per anchor. texts: did, h, text. shape: windows * 256 + place of the gram."""
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        span = scheme.width - scheme.gram + 1
        for frame in frames:
            parts, held = [], 0
            for did, h, text in zip(frame["did"], frame["h"], frame["text"], strict=True):
                for start, units in stretches(scheme.units(text), scheme.width):
                    hashes = gram_hashes(scheme.codes(units), scheme.gram)
                    at, first, last = anchors(hashes, span)
                    body = [xxhash.xxh64_intdigest(scheme.cut(units, a, z + scheme.width), o)
                            for a, z, o in zip(first.tolist(), last.tolist(), (at - first).tolist(), strict=True)]
                    parts.append(pd.DataFrame({
                        "gram": hashes[at].view(np.int64), "body": np.array(body, np.uint64).view(np.int64),
                        "did": did, "h": h, "pos": first + start,
                        "shape": ((last - first + 1) * 256 + at - first).astype(np.int32)}))
                    held += len(at)
                    if held > 100_000:
                        yield pd.concat(parts)
                        parts, held = [], 0
            if parts:
                yield pd.concat(parts)
    return texts.mapInPandas(rows, ANCHOR)


def keyed(documents: DataFrame) -> DataFrame:
    """did, h, text, doc_id. Where ids are unique and present they are the key; else a
    content hash is added to it (rows equal in both get equal results)."""
    ids = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    unique = ids.where((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty()
    h = F.lit(0).cast("long") if unique else F.xxhash64(F.coalesce("text", F.lit("")))
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("did"), h.alias("h"),
                            F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long"))


def packed(column: str) -> Column:
    """Texts compressed for the shuffle."""
    @F.pandas_udf("binary")
    def pack(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zstandard
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in texts:
            yield pd.Series([compress((t or "").encode("utf-8")) for t in batch], dtype=object)
    return pack(column)


def unpacked(blob: bytes) -> str:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(blob).decode("utf-8") if len(blob) else ""


#: key: what the text is dealt by; at: its first window within the windows of (gram, body).
CONTEXT = "key long, gram long, body long, at int, n long, low long, high long, shape int, text binary"

NAMES = [c.split()[0] for c in CONTEXT.split(", ")]


def contexts(classes: DataFrame, blobs: DataFrame, scheme: Scheme) -> DataFrame:
    """The text of one anchor of each class. classes: gram, body, n, low, high, one (did, h, pos, shape)."""
    wanted = (classes.select("one.did", "one.h", F.struct(
        "gram", "body", "n", "low", "high", "one.pos", "one.shape").alias("x"))
        .join(blobs, ["did", "h"]).select("did", "h", "blob", "x.*"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, units = None, None
        for frame in frames:
            text = []
            for did, h, blob, pos, shape in zip(frame["did"], frame["h"], frame["blob"], frame["pos"],
                                                frame["shape"], strict=True):
                if key != (did, h):
                    key, units = (did, h), scheme.units(unpacked(blob))
                text.append(scheme.cut(units, pos, pos + (shape >> 8) - 1 + scheme.width))
            yield frame[["gram", "body", "n", "low", "high", "shape"]].assign(key=frame["gram"], at=0, text=text)[NAMES]
    # The blob rides along with each row only inside a task.
    return wanted.mapInPandas(cut, CONTEXT)


def cells(place: int, n: int, span: int, step: int) -> Iterator[tuple[int, int, int, int]]:
    """(first window, last window, units left, units right of the gram) of the runs of windows
    with one key. place: of the gram in the first window. Depends on the gram's place in a window alone."""
    def sides(k: int) -> tuple[int, int]:
        return (place - k) // step * step, max(span - 1 - place + k, 0) // step * step
    for (left, right), run in groupby(range(n), sides):
        ks = list(run)
        yield ks[0], ks[-1], left, right


def lengthened(found: DataFrame, scheme: Scheme, step: int) -> DataFrame:
    """The contexts cut into runs of windows that can share a longer key, under that key."""
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        span = scheme.width - scheme.gram
        for frame in frames:
            for i in range(0, len(frame), ROWS_PER_BLOCK // 16):
                out = []
                for r in frame.iloc[i:i + ROWS_PER_BLOCK // 16].itertuples(index=False):
                    units, place = scheme.again(r.text), r.shape & 255
                    for a, z, left, right in cells(place, r.shape >> 8, span, step):
                        key = xxhash.xxh64_intdigest(
                            scheme.cut(units, place - left, place + scheme.gram + right), left << 8 | right)
                        out.append((key - (1 << 64) * (key >> 63), r.gram, r.body, r.at + a, r.n, r.low, r.high,
                                    (z - a + 1) * 256 + place - a, scheme.cut(units, a, z + scheme.width)))
                yield pd.DataFrame(out, columns=NAMES)
    return found.mapInPandas(rows, CONTEXT)


MATCH = "gram long, body long, first int, last int, least long"


def matches(found: DataFrame, scheme: Scheme) -> DataFrame:
    """Matched runs of windows per class, whole groups of one key at a time."""
    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0

        def flush(frame: pd.DataFrame) -> pd.DataFrame:
            row, first, last, least = scheme.match(frame)
            at = frame["at"].to_numpy()[row]
            return pd.DataFrame({"gram": frame["gram"].to_numpy()[row], "body": frame["body"].to_numpy()[row],
                                 "first": (at + first).astype(np.int32), "last": (at + last).astype(np.int32),
                                 "least": least})
        for frame in frames:
            held.append(frame)
            n += len(frame)
            if n < ROWS_PER_BLOCK:
                continue
            both = pd.concat(held, ignore_index=True)
            whole = (both["key"] != both["key"].iloc[-1]).to_numpy()
            if whole.any():
                yield flush(both[whole].reset_index(drop=True))
                both = both[~whole].reset_index(drop=True)
            held, n = [both], len(both)
        if held:
            yield flush(pd.concat(held, ignore_index=True))
    return found.repartition("key").sortWithinPartitions("key").mapInPandas(blocks, MATCH)


def window_matches(found: DataFrame, scheme: Scheme) -> DataFrame:
    """The same under the longest key, the whole window: single windows by digest, no group in one task."""
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for frame in frames:
            for i in range(0, len(frame), 256):
                part, out = frame.iloc[i:i + 256], []
                for r in part.itertuples(index=False):
                    units = scheme.again(r.text)
                    for k in range(r.shape >> 8):
                        digest = xxhash.xxh3_128_digest(scheme.cut(units, k, k + scheme.width))
                        out.append((r.gram, r.body, r.at + k, digest, r.n, r.low, r.high))
                yield pd.DataFrame(out, columns=["gram", "body", "k", "digest", "n", "low", "high"])
    single = found.mapInPandas(rows, "gram long, body long, k int, digest binary, n long, low long, high long")
    classes = single.groupBy("digest").agg(F.sum("n").alias("all"), F.min("low").alias("least"))
    hit = single.join(classes, "digest")
    hit = hit.where(F.col("least") < F.col("high")) if scheme.ordered else hit.where(F.col("all") > 1)
    return hit.select("gram", "body", F.col("k").alias("first"), F.col("k").alias("last"), "least")


def hot_matches(found: DataFrame, scheme: Scheme, max_group: int) -> Iterator[DataFrame]:
    """Matches of groups that are too large for a task: under longer keys, down to single windows."""
    for step in scheme.steps:
        found = written(lengthened(found, scheme, step), "contexts")
        many = written(found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > max_group).select("key"), "hot-keys")
        if many.isEmpty():
            yield matches(found, scheme)
            return
        yield matches(found.join(many, "key", "left_anti"), scheme)
        found = found.join(many, "key", "left_semi")
    yield window_matches(found, scheme)


def covered(documents: DataFrame, scheme: Scheme, max_group: int = MAX_GROUP) -> DataFrame:
    """doc_id (as text), blob (packed text), runs (start << 32 | end, in units); one row per input row."""
    texts = keyed(documents)
    rows = anchor_rows(texts.select("did", "h", "text"), scheme)
    often = written(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1), "grams")
    live = written(rows.join(often, "gram"), "anchors")
    ids = F.when(F.col("did") != -1 << 63, F.col("did"))
    one = F.struct("did", "h", "pos", "shape")
    classes = live.groupBy("gram", "body").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.min(ids), F.lit(NONE)).alias("low"),
        F.coalesce(F.max(ids), F.lit(-NONE)).alias("high"),
        F.min(one).alias("one"))
    blobs = texts.select("did", "h", "doc_id", packed("text").alias("blob"))
    keys = blobs.drop("doc_id")
    many = written(live.where(F.col("times") > max_group).select("gram", "body").distinct().groupBy("gram").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group).select("gram"), "hot-grams")
    if many.isEmpty():
        hits = matches(contexts(classes, keys, scheme), scheme)
    else:
        hits = matches(contexts(classes.join(many, "gram", "left_anti"), keys, scheme), scheme)
        hot = classes.join(many, "gram", "left_semi")
        # Only texts that hold one of these contexts are packed and moved again.
        own = written(hot, "hot-classes")
        held = texts.join(own.select("one.did", "one.h").distinct(), ["did", "h"], "left_semi")
        hot_keys = held.select("did", "h", packed("text").alias("blob"))
        for part in hot_matches(contexts(own, hot_keys, scheme), scheme, max_group):
            hits = hits.unionAll(part)
    back = live.select("gram", "body", "did", "h", "pos").join(hits, ["gram", "body"])
    if scheme.ordered:
        back = back.where((F.col("did") != -1 << 63) & (F.col("least") < F.col("did")))
    start, end = F.col("pos") + F.col("first"), F.col("pos") + F.col("last") + scheme.width
    runs = (back.select("did", "h", (F.shiftleft(start, 32) + end).alias("run")).groupBy("did", "h")
            .agg(F.collect_list("run").alias("runs")))
    return blobs.join(runs, ["did", "h"], "left").select(F.col("doc_id").cast("string").alias("doc_id"), "blob", "runs")


def with_long_id(df: DataFrame) -> DataFrame:
    """The ids that ``covered`` gave as text, as numbers again."""
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def merged_runs(runs) -> list[tuple[int, int]]:
    """Disjoint (start, end) in order from packed runs."""
    out: list[list[int]] = []
    if runs is None:
        return []
    for x in np.unique(np.asarray(runs, np.int64)).tolist():
        s, e = x >> 32, x & 0xFFFFFFFF
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def names(keys: np.ndarray) -> np.ndarray:
    """Dense numbers of equal keys, in order of the keys."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]]).astype(np.uint64)
    return out


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    return names((a << np.uint64(32)) | b)


def runs_of(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of True in each row of a matrix."""
    edge = np.diff(np.pad(flag, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return row, first, end - 1
