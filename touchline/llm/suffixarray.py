"""Suffix-array deduplication over bytes, blockwise with cover-sample ranks.

A byte goes if it is covered by a ``WIDTH``-byte string that also starts
anywhere else, in the same document or another; overlapping occurrences count
and strings are judged on the input.

``repeats`` routes all suffixes whose first ``WIDTH`` bytes may occur again to
one task by a sampled gram within them. There they are ranked a bucket at a
time: a bucket holds the suffixes that start at one distance from that gram
(only those can be equal). A suffix's rank in its bucket is the pair of the
cover sample's rank (every eighth position from the gram, computed beforehand
by doubling and cut off at the tie's length) and of the bytes on either side
of it. The ranks tell equal suffixes from different ones, which is all that
is needed; they are not the order of the suffixes. A block of contexts has
bounded size, and only one bucket of it is ranked at a time; where more than
``max_group`` texts share a gram, they are dealt by the bytes around it too,
in two steps, then by the whole window.

Distances are measured from the gram, so all suffixes of a bucket have the
same distance to the sample and one residue is cover enough.

Defined results: a NULL or empty text has no bytes. Repeated rows are copies
of each other. An empty table gives an empty result. Only doc_id and text are
read. Kept bytes may split a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import repeats
from touchline.llm.repeats import Scheme, merged_runs, names, paired, runs_of

WIDTH, GRAM, STEP = 200, 16, 8
#: Column of the gram when contexts are laid side by side; a multiple of STEP.
CENTRE = WIDTH - GRAM
COLUMNS = CENTRE + WIDTH
MIDDLE = WIDTH - STEP  # length settled by the sample


def units(text: str) -> bytes:
    return text.encode("utf-8")


def codes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)


def cut(data: bytes, start: int, end: int) -> bytes:
    return data[start:end]


def again(data: bytes) -> bytes:
    return data


def _laid_out(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts as rows of a byte matrix with their grams in one column; first and last window."""
    shape = frame["shape"].to_numpy()
    first = CENTRE - (shape & 255)
    texts = frame["text"].tolist()
    size = np.array([len(t) for t in texts])
    grid = np.zeros(len(texts) * COLUMNS, np.uint8)
    at = np.repeat(np.arange(len(texts)) * COLUMNS + first - np.cumsum(size) + size, size)
    grid[at + np.arange(size.sum())] = np.frombuffer(b"".join(texts), np.uint8)
    return grid.reshape(-1, COLUMNS), first, first + (shape >> 8) - 1


def cover_ranks(blocks: np.ndarray) -> list[np.ndarray]:
    """Rank of each sample suffix, cut off at MIDDLE bytes, per sample column."""
    n = blocks.shape[1]
    rank = [names(blocks[:, j]) for j in range(n)]
    by_length, size = {1: rank}, 1
    while size * 2 <= MIDDLE // STEP:
        rank = [paired(rank[j], rank[j + size]) for j in range(len(rank) - size)]
        size *= 2
        by_length[size] = rank
    total, left = size, MIDDLE // STEP - size
    for part in sorted(by_length, reverse=True):
        if part <= left:
            rank = [paired(rank[j], by_length[part][j + total]) for j in range(n - total - part + 1)]
            total, left = total + part, left - part
    return rank


def match(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that occur again, per context."""
    grid, first, last = _laid_out(frame)
    times = frame["n"].to_numpy()
    blocks = np.ascontiguousarray(grid).view(">u8").astype(np.uint64)
    ranks = cover_ranks(blocks)
    again = np.zeros((len(grid), CENTRE + 1), bool)
    for a in range(CENTRE + 1):
        rows = np.flatnonzero((first <= a) & (a <= last))
        if not len(rows):
            continue
        j, r = -(-a // STEP), a % STEP
        if r:
            ends = (blocks[rows, j - 1] << np.uint64(8 * r)) | (blocks[rows, j + MIDDLE // STEP] >> np.uint64(64 - 8 * r))
        else:
            ends = blocks[rows, j + MIDDLE // STEP]
        rank = paired(ranks[j][rows], names(ends)).astype(np.int64)
        count = np.bincount(rank, times[rows])
        again[rows, a] = count[rank] > 1
    row, start, end = runs_of(again)
    return row, start - first[row], end - first[row], np.full(len(row), -1, np.int64)


SCHEME = Scheme(WIDTH, GRAM, units, codes, cut, match, again, (92, 23), ordered=False)


def remove_repeats(documents: DataFrame, max_group: int = repeats.MAX_GROUP) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of removed runs), kept (binary); one row per input row."""
    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, blob, runs in zip(frame["doc_id"], frame["blob"], frame["runs"], strict=True):
                data, gone = repeats.unpacked(blob).encode("utf-8"), merged_runs(runs)
                edge = [0, *(x for run in gone for x in run), len(data)]
                rest = b"".join(data[s:e] for s, e in zip(edge[::2], edge[1::2], strict=True))
                out.append((doc_id, len(data), [{"start": s, "end": e} for s, e in gone], rest))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
    return repeats.with_long_id(repeats.covered(documents, SCHEME, max_group).mapInPandas(
        kept, "doc_id string, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"))


def digest(documents: DataFrame, max_group: int = repeats.MAX_GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, blob, runs in zip(frame["doc_id"], frame["blob"], frame["runs"], strict=True):
                data, gone = repeats.unpacked(blob).encode("utf-8"), merged_runs(runs)
                rest, at = hashlib.sha256(), 0
                for s, e in gone:
                    rest.update(data[at:s])
                    at = e
                rest.update(data[at:])
                out.append((doc_id, len(data), sum(e - s for s, e in gone), len(gone), rest.hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return repeats.with_long_id(repeats.covered(documents, SCHEME, max_group).mapInPandas(
        measured, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
