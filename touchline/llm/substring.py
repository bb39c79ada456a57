"""Substring deduplication over words with prefix-partitioned suffix trees.

A word goes if it is covered by a window of ``WIDTH`` words whose word
sequence also starts in a document with a smaller doc_id; windows are judged
on the input.

Partition: the suffix that starts with a window is dealt by a key of variable
length out of its first ``WIDTH`` words (see ``repeats``): first the window's
sampled gram, and for a group of more than ``max_group`` texts the words before
and behind it as well, in two steps, then the whole window. Equal windows have
equal keys and meet in one group; groups are packed into blocks of bounded
size. The key is taken around the sampled gram, not from the suffix's first
word on, so that only one text per run of windows is dealt.

Subtree: each block's suffixes are grown top down, ``EDGE`` words at a time.
A node is the set of suffixes with one common prefix; those alone in their
node are leaves and drop out. What is left at depth ``WIDTH`` are the deep
internal nodes: repeats of at least that length. Each takes the smallest
doc_id below it, and its suffixes' windows go from all greater ones.

Defined results: a NULL or empty text has no words. A NULL doc_id is neither
smaller nor greater than any other: such rows keep their words and remove
none. Rows that repeat an id keep what only they share. An empty table gives
an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import repeats
from touchline.llm.repeats import Scheme, merged_runs, paired

WIDTH, GRAM, EDGE = 50, 8, 5
CENTRE = WIDTH - GRAM
COLUMNS = CENTRE + WIDTH
NEVER = repeats.NONE


def units(text: str) -> list[bytes]:
    return text.encode("utf-8").split()


def codes(words: list[bytes]) -> np.ndarray:
    import xxhash
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def cut(words: list[bytes], start: int, end: int) -> bytes:
    return b" ".join(words[start:end])


def again(data: bytes) -> list[bytes]:
    return data.split(b" ")


def deep_nodes(grid: np.ndarray, row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each suffix (row, start) the number of its node at depth WIDTH, -1 for leaves above it.

    grid: word numbers. Edges of EDGE words are named first, so growing a
    node is one sort of its suffixes by the next edge's name.
    """
    n = grid.shape[1]
    two = [paired(grid[:, j], grid[:, j + 1]) for j in range(n - 1)]
    four = [paired(two[j], two[j + 2]) for j in range(n - 3)]
    edge = np.stack([paired(four[j], grid[:, j + 4]) for j in range(n - 4)], axis=1)
    node = np.zeros(len(row), np.uint64)
    alive = np.arange(len(row))
    at = start.astype(np.uint64)
    for depth in range(0, WIDTH, EDGE):
        if not len(alive):
            break
        if depth == 0:  # suffixes at different distances from the gram never share a node
            grown = paired(at[alive], edge[row[alive], start[alive]])
        else:
            grown = paired(node[alive], edge[row[alive], start[alive] + depth])
        size = np.bincount(grown.astype(np.int64))
        inner = size[grown.astype(np.int64)] > 1
        alive, grown = alive[inner], grown[inner]
        node[alive] = grown
    out = np.full(len(row), -1, np.int64)
    out[alive] = node[alive].astype(np.int64)
    return out


def match(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with a smaller doc_id elsewhere, with that id, per context."""
    shape = frame["shape"].to_numpy()
    n_windows, first = (shape >> 8).astype(np.int64), (CENTRE - (shape & 255)).astype(np.int64)
    numbers: dict[bytes, int] = {}
    grid = np.zeros((len(frame), COLUMNS), np.uint64)
    for k, text in enumerate(frame["text"]):
        words = text.split(b" ")
        grid[k, first[k]:first[k] + len(words)] = [numbers.setdefault(w, len(numbers) + 1) for w in words]
    low, high = frame["low"].to_numpy(), frame["high"].to_numpy()
    row = np.repeat(np.arange(len(frame)), n_windows)
    window = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    node = deep_nodes(grid, row, first[row] + window)
    least = low[row]
    deep = np.flatnonzero(node >= 0)
    if len(deep):
        by_node = np.full(node.max() + 1, NEVER)
        np.minimum.at(by_node, node[deep], least[deep])
        least[deep] = by_node[node[deep]]
    hit = np.flatnonzero(least < high[row])
    if not len(hit):
        return (np.zeros(0, np.int64),) * 4
    joint = (row[hit][1:] == row[hit][:-1]) & (window[hit][1:] == window[hit][:-1] + 1) & (
        least[hit][1:] == least[hit][:-1])
    start = np.flatnonzero(np.r_[True, ~joint])
    end = np.r_[start[1:], len(hit)] - 1
    return row[hit][start], window[hit][start], window[hit][end], least[hit][start]


SCHEME = Scheme(WIDTH, GRAM, units, codes, cut, match, again, (21, 7), ordered=True)


def remove_repeats(documents: DataFrame, max_group: int = repeats.MAX_GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space); one row per input row."""
    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, blob, runs in zip(frame["doc_id"], frame["blob"], frame["runs"], strict=True):
                words, gone = units(repeats.unpacked(blob)), merged_runs(runs)
                edge = [0, *(x for run in gone for x in run), len(words)]
                rest = [w for s, e in zip(edge[::2], edge[1::2], strict=True) for w in words[s:e]]
                out.append((doc_id, len(words), len(words) - len(rest), b" ".join(rest).decode("utf-8")))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
    return repeats.with_long_id(repeats.covered(documents, SCHEME, max_group).mapInPandas(
        kept, "doc_id string, n_words long, n_removed long, kept string"))


def digest(documents: DataFrame, max_group: int = repeats.MAX_GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(documents, max_group).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
