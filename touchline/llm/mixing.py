"""Mixing sources to target weights by cube-method balanced sampling.

Targets: sources share all words by their weights; a target stops at
``most`` times its source's words and the excess is shared out again by
weight until none is above.

Copies: with r = target / words of its source, every document is taken
floor(r) times, and once more with inclusion probability r - floor(r). The
cube method picks the extra copies so that, in each source, words and
documents come out as the probabilities say.

Flight: three documents with fractional probabilities and two totals (words,
documents) leave a one-dimensional null space; a random step along it, of
mean zero, takes at least one probability to 0 or 1 and keeps both totals.
Documents enter from the longest to the shortest, so what stays open is
small. A source is dealt into blocks of at most ``block`` documents, each
with every size (every k-th in order of size), so that no source decides
what a task holds. A block leaves two open documents at most; those are
the next round's documents.

Landing: the two documents that a source has left are settled by the best
randomised choice that keeps their probabilities: both together only as
often as they must be.

All draws are seeded by source, round and block, and the order of documents
depends on their contents only, so reruns agree.

Defined results: a NULL or empty text has size 0 and takes nothing. A NULL
source is a source like any other and comes last. Rows with equal ids are
documents of their own; rows equal in id and text may swap their results. A
corpus without words has targets of 0; an empty table gives no rows. Only
doc_id, source and text are read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import written
from touchline.llm.places import with_places

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 4096
SEED = "mix"
#: Probabilities so near to 0 or 1 are 0 or 1.
NEAR = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """tree, source_size, target. sizes: tree, source_size; one row per source, weighted in the order of tree.

    Each round adds up two numbers over the sources; no source's row reaches the driver.
    """
    places = with_places(sizes.withColumn("all", F.lit("")), "all", ["tree"], "place")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = written(places.select("tree", "source_size", turn.cast("long").alias("weight")), "sources")
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    capped, share, n = F.lit(False), F.lit(0.0), 0
    while True:
        got = rows.agg(F.coalesce(F.sum(F.when(capped, F.col("source_size") * most)), F.lit(0)).alias("held"),
                       F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
                       F.count_if(capped).alias("n")).first()
        if not got["weight"]:
            break
        share = F.col("weight") * (total - got["held"]) / F.lit(got["weight"])
        if n and got["n"] == n:
            break
        n, above = got["n"], share > F.col("source_size") * most
        if rows.where(above & ~capped).isEmpty():
            break
        capped = above | capped
        # The condition would grow with each round; its result is kept instead.
        rows = written(rows.select("tree", "source_size", "weight", capped.alias("capped")), "sources")
        capped, n = F.col("capped"), 0
    return rows.select("tree", "source_size", F.when(capped, F.col("source_size").cast("double") * most)
                       .otherwise(share).cast("double").alias("target"))


def _step(p: list[float], size: list[int], at: list[int], u: tuple[float, ...], draw: float) -> None:
    """Move the probabilities along u or against it, as far as they go, with mean zero."""
    ahead = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(at, u, strict=True) if x)
    back = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(at, u, strict=True) if x)
    move = ahead if draw * (ahead + back) < back else -back
    for i, x in zip(at, u, strict=True):
        p[i] += move * x
        if p[i] < NEAR:
            p[i] = 0.0
        elif p[i] > 1 - NEAR:
            p[i] = 1.0


def flight(size: list[int], p: list[float], draw) -> list[float]:
    """Probabilities after the flight: two fractional ones at most, with the same sums of p and size * p."""
    p, at, after = list(p), [], 0
    while True:
        at = [i for i in at if 0 < p[i] < 1]
        while len(at) < 3 and after < len(p):
            if 0 < p[after] < 1:
                at.append(after)
            after += 1
        same = next(((i, k) for n, i in enumerate(at) for k in at[n + 1:] if size[i] == size[k]), None)
        if same:            # equal sizes: moving one against the other keeps both totals
            _step(p, size, list(same), (1.0, -1.0), draw())
        elif len(at) == 3:
            a, b, c = (size[i] for i in at)
            long = float(max(abs(b - c), abs(c - a), abs(a - b)))
            _step(p, size, at, ((b - c) / long, (c - a) / long, (a - b) / long), draw())
        else:
            return p


def landing(p: list[float], draw) -> list[float]:
    """Settle at most two fractional probabilities; both only as often as they must be."""
    p, at = list(p), [i for i, x in enumerate(p) if 0 < x < 1]
    if len(at) == 1:
        p[at[0]] = float(draw() < p[at[0]])
    elif at:
        i, k = at
        both, x = max(0.0, p[i] + p[k] - 1), draw()
        first = x < p[i]   # i with p[i]; k fills up from the end, so they meet only in ``both``
        p[i], p[k] = float(first), float(x < both or x >= 1 - (p[k] - both))
    return p


ROWS = "tree string, id string, size long, key long, n long, p double"


def _round(rows: DataFrame, number: int, last: bool, block: int, seed: str) -> DataFrame:
    """Fly each block of ROWS once, and land the last round's."""
    names = [c.split()[0] for c in ROWS.split(", ")]

    def fly(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            draw = random.Random(f"{seed}|{number}|{rows['tree'].iloc[0]}|{rows['block'].iloc[0]}").random
            p = flight(rows["size"].tolist(), rows["p"].tolist(), draw)
            if last:
                p = landing(p, draw)
            return rows[names].assign(p=p)

        for frame in frames:
            for _, part in frame.groupby(["tree", "block"], sort=False):
                if held and (held[0]["tree"].iloc[0] != part["tree"].iloc[0] or held[0]["block"].iloc[0] != part["block"].iloc[0]):
                    yield done()
                    held = []
                held.append(part)
        if held:
            yield done()

    order = ["less", "key", "id"]
    placed = with_places(rows.withColumn("less", -F.col("size")), "tree", order)
    blocks = F.ceil(F.col("n") / block).cast("long")
    return (placed.withColumn("block", F.col("pos") % blocks).repartition("tree", "block")
            .sortWithinPartitions("tree", "block", *order).mapInPandas(fly, ROWS))


def chosen(rows: DataFrame, most: int, block: int = BLOCK, seed: str = SEED) -> DataFrame:
    """ROWS with p of 0 or 1. most: rows of the largest source."""
    done, number = [], 0
    while True:
        last = most <= block
        flown = written(_round(rows, number, last, block, seed), "flown")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.where(~open_))
        if last:
            break
        left = flown.where(open_)
        counts = left.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
        rows, most, number = left.drop("n").join(counts, "tree"), 2 * -(-most // block), number + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK,
        seed: str = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken: one row per document."""
    if block < 4:
        raise ValueError("a block needs four documents: each leaves two, and blocks of three or less need not shrink")
    text = F.coalesce("text", F.lit(""))
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~"))   # in the sources' order, NULL last
    rows = written(documents.select(
        tree.alias("tree"), F.col("doc_id").cast("string").alias("id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col("doc_id"), text).alias("key")), "sizes")
    sources = rows.groupBy("tree").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = written(targets(sources.drop("n"), weights, most).withColumnRenamed("tree", "t").join(
        sources.select(F.col("tree").alias("t"), "n"), "t").select(
            F.col("t").alias("tree"), "source_size", "target", "n", F.floor(ratio).cast("long").alias("whole"),
            (ratio - F.floor(ratio)).alias("p")), "mix-plan")
    both = rows.join(plan, "tree")
    fraction = (F.col("p") > NEAR) & (F.col("p") < 1 - NEAR)
    largest = plan.where(fraction).agg(F.max("n")).first()[0]
    extra = F.when(F.col("p") >= 0.5, 1).otherwise(0)
    settled = both.where(~fraction).select("tree", "id", "size", extra.cast("long").alias("extra"))
    if largest:
        flown = chosen(both.where(fraction).select("tree", "id", "size", "key", "n", "p"), largest, block, seed)
        settled = settled.unionByName(flown.select("tree", "id", "size", F.col("p").cast("long").alias("extra")))
    copies = F.col("whole") + F.col("extra")
    source = F.when(F.col("tree") != "~", F.substring("tree", 2, 1 << 30))
    return settled.join(plan, "tree").select(
        F.col("id").cast(documents.schema["doc_id"].dataType).alias("doc_id"), "size", source.alias("source"),
        "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def digest(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies."""
    return mix(documents).select("doc_id", "size", "source_size", "target", "taken", "copies")
