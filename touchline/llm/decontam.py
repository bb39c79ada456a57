"""Benchmark decontamination: BM25 retrieval by block-max WAND, then overlap.

The inverted index is over the benchmark's items (small next to the corpus);
the queries are the training passages: windows of twice the longest item's
words, one every such length, so any item lies whole in some window. Scores
are BM25 with each item's weights divided by its score for its own text, so
1 means that every word of the item is in the passage and one threshold fits
all items.

Search: items are numbered in blocks. For each term the index keeps its
postings and the largest weight per block. A passage first adds up the block
maxima of its distinct terms (a batch of passages at once); blocks whose sum
stays below the threshold cannot hold a hit and are skipped without a look at
their postings. Within the other blocks a document-at-a-time WAND walk moves a
pivot over the postings, and only items whose bound reaches the threshold are
scored. Nothing above the threshold is lost.

Verification: of the item's question and of its answer, each at least
``overlap`` of the 5-word shingles must occur in the passage. Without an
answer column, the answer is the last sentence of the item's text, the
question the rest (the whole text if it has one sentence).

The index is broadcast in shards of about ``shard_items`` items and
``shard_chars`` characters (or one item, if that is longer), dealt by a hash,
each a pass over the corpus. Shards are built, sent out, searched and dropped
one after the other, so what the driver and a worker hold is bounded whatever
the benchmark's size.
Number of items, document frequencies, mean and greatest length are those of
the whole benchmark in every shard, so scores do not depend on the shards;
a shard's driver work reads the frequencies of its own words only.

Defined results: NULL and empty texts match nothing, and items without a word
are never matched. Repeated rows of documents give one row per (doc_id,
item_id), repeated rows of the benchmark count as one; the same text under
several ids matches on each. An item with a NULL item_id is an item like any
other: its documents are contaminated, with a NULL item_id. Empty tables give
an empty result. Only doc_id, item_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import text_digest, whole_row, written

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.6   # share of an item's own score
    overlap: float = 0.8     # of the 5-word shingles of question and answer
    shingle: int = 5
    k1: float = 1.2
    b: float = 0.75
    block: int = 8           # items in a block
    shard_items: int = 20_000
    shard_chars: int = 20_000_000


@dataclass(frozen=True)
class Totals:
    """What the weights need of the whole benchmark, whatever part of it is indexed."""
    n: int                # items with a word
    mean: float           # words in an item
    longest: int
    held: dict[str, int]  # word -> items that hold it


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(tokens: list[str], n: int) -> set[tuple[str, ...]]:
    if not tokens:
        return set()
    return {tuple(tokens[i:i + n]) for i in range(max(1, len(tokens) - n + 1))}


def question_and_answer(text: str) -> tuple[str, str]:
    parts = [p for p in _SENTENCE.split(text.strip()) if words(p)]
    return (text, text) if len(parts) < 2 else (" ".join(parts[:-1]), parts[-1])


class Index:
    """Inverted index of items with block maxima."""

    def __init__(self, items: list[tuple[int | None, str]], settings: Settings, totals: Totals | None = None):
        self.settings = s = settings
        tokens = [words(t) for _, t in items]
        keep = [k for k, t in enumerate(tokens) if t]
        self.ids = [items[k][0] for k in keep]
        tokens = [tokens[k] for k in keep]
        self.question = [shingles(words(q), s.shingle) for q, _ in
                         (question_and_answer(items[k][1]) for k in keep)]
        self.answer = [shingles(words(a), s.shingle) for _, a in
                       (question_and_answer(items[k][1]) for k in keep)]
        if totals is None:
            totals = Totals(len(tokens), sum(map(len, tokens)) / max(1, len(tokens)), max(map(len, tokens), default=1),
                            Counter(w for t in tokens for w in set(t)))
        n, mean, held, self.length = len(tokens), totals.mean, totals.held, totals.longest
        idf = {w: math.log(1 + (totals.n - c + 0.5) / (c + 0.5)) for w, c in held.items()}
        self.terms = {w: i for i, w in enumerate(sorted(held))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for k, t in enumerate(tokens):
            weight = {w: idf[w] * c * (s.k1 + 1) / (c + s.k1 * (1 - s.b + s.b * len(t) / mean))
                      for w, c in Counter(t).items()}
            whole = sum(weight.values())
            for w, x in weight.items():
                postings[self.terms[w]].append((k, x / whole))
        self.items = [np.array([k for k, _ in p], np.int32) for p in postings]
        self.weights = [np.array([x for _, x in p]) for p in postings]
        self.n_blocks = -(-n // s.block) if n else 0
        starts, blocks, most = [0], [], []
        for p in postings:
            best: dict[int, float] = {}
            for k, x in p:
                best[k // s.block] = max(best.get(k // s.block, 0.0), x)
            blocks += best
            most += best.values()
            starts.append(len(blocks))
        self.starts = np.array(starts)
        self.blocks, self.most = np.array(blocks, np.int64), np.array(most)

    def live_blocks(self, passage: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) pairs whose block maxima reach the threshold; passages in order."""
        step = max(1, 4_000_000 // max(1, self.n_blocks))  # passages whose sums are held at once
        if n > step:
            cuts = np.searchsorted(passage, range(0, n + step, step))
            parts = [self.live_blocks(passage[a:z] - k * step, term[a:z], step)
                     for k, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            return (np.concatenate([p + k * step for k, (p, _) in enumerate(parts)]),
                    np.concatenate([b for _, b in parts]))
        size = self.starts[term + 1] - self.starts[term]
        entry = np.repeat(self.starts[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
        bound = np.bincount(np.repeat(passage, size) * self.n_blocks + self.blocks[entry],
                            self.most[entry], n * self.n_blocks)
        hit = np.flatnonzero(bound >= self.settings.threshold - 1e-9)
        return hit // self.n_blocks, hit % self.n_blocks

    def walk(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """WAND within a block: all items that reach the threshold, with their scores."""
        goal = self.settings.threshold - 1e-9
        first, end = block * self.settings.block, (block + 1) * self.settings.block
        lists = []
        for t in terms:
            items = self.items[t]
            a, z = np.searchsorted(items, (first, end))
            if a < z:
                w = self.weights[t][a:z].tolist()
                lists.append([0, items[a:z].tolist(), w, max(w)])
        out = []
        while lists:
            lists.sort(key=lambda x: x[1][x[0]])
            bound, pivot = 0.0, None
            for x in lists:
                bound += x[3]
                if bound >= goal:
                    pivot = x[1][x[0]]
                    break
            if pivot is None:
                break
            if lists[0][1][lists[0][0]] == pivot:
                score = sum(x[2][x[0]] for x in lists if x[1][x[0]] == pivot)
                if score >= goal:
                    out.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for x in lists:
                while x[0] < len(x[1]) and x[1][x[0]] < target:
                    x[0] += 1
            lists = [x for x in lists if x[0] < len(x[1])]
        return out

    def hits(self, text: str | None) -> list[tuple[int | None, float, float, float]]:
        """(item_id, score, question overlap, answer overlap) of verified items, one row each."""
        s, tokens = self.settings, words(text)
        if not tokens or not self.ids:
            return []
        get, step = self.terms.get, self.length
        codes = np.array([get(w, -1) for w in tokens])
        n = max(1, -(-len(tokens) // step))
        at = np.flatnonzero(codes >= 0)
        if not len(at):
            return []
        # Each word lies in the window that starts at or before it and in the one before that.
        window = at // step
        pair = np.concatenate([window, window[window > 0] - 1]) * len(self.terms)
        pair = np.unique(pair + np.concatenate([codes[at], codes[at[window > 0]]]))
        passage, term = pair // len(self.terms), pair % len(self.terms)
        found: dict[int, tuple[float, float, float]] = {}
        for p, block in zip(*self.live_blocks(passage, term, n), strict=True):
            a, z = np.searchsorted(passage, (p, p + 1))
            scored = self.walk(term[a:z].tolist(), int(block))
            if not scored:
                continue
            have = shingles(tokens[p * step:(p + 2) * step], s.shingle)
            raw = None
            for k, score in scored:
                part = []
                for want in (self.question[k], self.answer[k]):
                    size = len(next(iter(want)))
                    if size < s.shingle:
                        raw = raw or tokens[p * step:(p + 2) * step]
                        have_n = shingles(raw, size)
                    else:
                        have_n = have
                    part.append(len(want & have_n) / len(want))
                if min(part) >= s.overlap:
                    found[k] = max(found.get(k, (0.0, 0.0, 0.0)), (score, *part))
        return [(self.ids[k], *x) for k, x in sorted(found.items())]


def _word_sets(items: DataFrame) -> DataFrame:
    """length, ws (distinct words): one row per item with a word."""
    @F.pandas_udf("length long, ws array<string>")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            lists = [words(t) for t in batch]
            yield pd.DataFrame({"length": [len(t) for t in lists], "ws": [sorted(set(t)) for t in lists]})
    return items.select(tokens("text").alias("t")).select("t.*").where(F.col("length") > 0)


def _dealt(benchmark: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """The distinct items, and in how many bounded shards they are indexed."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    return items, max(-(-size["n"] // settings.shard_items), -(-size["chars"] // settings.shard_chars)) if size["n"] else 0


def _by_id(rows) -> list[tuple[int | None, str]]:
    return sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _indexes(items: DataFrame, n: int, settings: Settings) -> Iterator[Index]:
    """Indexes of the items in ``n`` shards, dealt by a hash; each is built when it is asked for."""
    items = written(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "items")
    sets = _word_sets(items)
    size = sets.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), F.max("length").alias("longest")).first()
    held = written(sets.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c")), "held")
    for k in range(n):
        part = items.where(F.col("shard") == k)
        own = _word_sets(part).select(F.explode("ws").alias("w")).distinct()
        yield Index(_by_id(part.select("item_id", "text").collect()), settings,
                    Totals(size["n"], size["mean"], size["longest"],
                           {r[0]: r[1] for r in held.join(own, "w").select("w", "c").collect()}))


def _over_shards(documents: DataFrame, benchmark: DataFrame, settings: Settings,
                 search: Callable[[Broadcast], DataFrame]) -> DataFrame | None:
    """The results of ``search`` over a broadcast index of each shard, together; None without items.

    One shard stays in the plan. Of several, one at a time is built and sent
    out; its result is written, and its index leaves the driver and the
    workers before the next one is built.
    """
    context = documents.sparkSession.sparkContext
    items, n = _dealt(benchmark, settings)
    if n < 2:
        return search(context.broadcast(Index(_by_id(items.collect()), settings))) if n else None
    out = None
    shards = _indexes(items, n, settings)
    for _ in range(n):
        index = context.broadcast(next(shards))
        part = written(search(index), "hits")
        index.destroy()
        out = part if out is None else out.unionAll(part)
    return out


#: Documents' ids go through Python as text: beside a NULL, pandas would round numbers.
HITS = "doc_id string, item_id long, score double, question_overlap double, answer_overlap double"


def contaminated(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row per verified pair."""
    narrow = documents.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")

    def hits(index: Broadcast) -> DataFrame:
        def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = [(d, *h) for d, t in zip(frame["doc_id"], frame["text"], strict=True)
                        for h in index.value.hits(t)]
                got = pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                                   dtype=object)  # so that a NULL beside it does not round an id
                yield got.astype({"item_id": "Int64", "score": float, "question_overlap": float,
                                  "answer_overlap": float})
        return narrow.mapInPandas(search, HITS)
    out = _over_shards(documents, benchmark, settings, hits)
    if out is None:
        out = documents.sparkSession.createDataFrame([], HITS)
    return out.withColumn("doc_id", F.col("doc_id").cast("long")).groupBy("doc_id", "item_id").agg(
        F.round(F.max("score"), 6).alias("score"), F.max("question_overlap").alias("question_overlap"),
        F.max("answer_overlap").alias("answer_overlap"))


def _clean(index: Broadcast) -> Column:
    """Whether a text holds no item of a broadcast index."""
    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([not index.value.hits(t) for t in batch], dtype=bool)
    return clean("text")


def clean_documents(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents without a verified item; the input's columns.

    One shard is a filter. Several leave the digests of the texts that hold an
    item, and documents meet these in an anti-join.
    """
    spark = documents.sparkSession
    items, n = _dealt(benchmark, settings)
    if n < 2:
        return documents.where(_clean(spark.sparkContext.broadcast(Index(_by_id(items.collect()), settings)))) if n else documents
    found = _over_shards(documents, benchmark, settings, lambda index: documents.where(~_clean(index)).select(
        text_digest(F.col("text")).alias("found")).distinct())
    own = documents.select(whole_row(documents).alias("doc"), text_digest(F.col("text")).alias("own"))
    return own.join(found, F.col("own") == F.col("found"), "left_anti").select("doc.*")
