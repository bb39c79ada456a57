"""Merkle manifest of a dataset by time-forward processing.

Leaves of one source, in order, are the leaves of a tree of fan-out
``FAN``; the sources' roots are the leaves of one more such tree. A node's
label is (its last leaf, its level), so every node comes after its children.

Forward sweep: nodes are taken in label order; each sends its digest to its
parent through a priority queue ordered by label, and a node is computed when
its label is the queue's least. The queue is external in two layers: the
sorted shuffle of Spark holds the messages between tasks, and a task that
sweeps one block of ``FAN ** LEVELS`` leaves keeps a heap, which in this
label order never holds more than ``FAN`` digests a level. Blocks are dealt
by (tree, block), so a source with a third of all rows is many tasks; block
roots are the leaves of the next round.

Reversed sweep: in the reverse label order, each node sends its proof suffix
(the siblings from its level up to the root) down to its children, block by
block from the last round to the first, until each leaf has its own.

Only digests, numbers and keys are shuffled, texts never. Places within a
source come from ``with_places``, which splits hot sources.

Defined results: NULL fields are hashed as ``-``, an empty string as ``0:``.
Rows of one source with equal ids are put in order of their digests, a NULL
doc_id first; repeated rows are leaves of their own. A row with a NULL doc_id
is never tampered with. An empty table has no root and gives no rows. Only
doc_id, source, lang, n_chars and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ascii_lower, written
from touchline.llm.places import with_places

FAN = 16
#: Levels of a block.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(n: int, fan: int) -> int:
    """Levels above ``n`` leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // fan), out + 1
    return out


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    values = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.sha2(F.encode(F.concat(*[field(v) for v in values]), "UTF-8"), 256)


def leaves(documents: DataFrame, tampered: Column) -> DataFrame:
    """tree, doc_id, source, leaf, other (the leaf after tampering, NULL where there is none)."""
    rows = documents.select(*[F.col(c) for c in FIELDS])
    other = F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(ascii_lower(F.col("text"))))
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))   # in the sources' order
    return rows.select(tree.alias("tree"), "doc_id", "source", leaf_digest(F.col("text")).alias("leaf"), other.alias("other"))


class Sweep:
    """Forward sweep over the leaves of one block: nodes of ``levels`` levels above ``n`` leaves."""

    def __init__(self, n: int, levels: int, fan: int):
        self.n, self.levels, self.fan = n, levels, fan
        self.queue: list[tuple[int, int, int, str]] = []   # label (last leaf, level), place, digest
        self.tops: list[str] = []
        #: (level, index) -> children's digests, for the reversed sweep
        self.children: dict[tuple[int, int], list[str]] = {}
        self.most = 0

    def _send(self, level: int, index: int, digest: str) -> None:
        if level == self.levels:
            self.tops.append(digest)
            return
        last = min(self.n, (index // self.fan + 1) * self.fan ** (level + 1)) - 1
        heapq.heappush(self.queue, (last, level + 1, index, digest))
        self.most = max(self.most, len(self.queue))

    def leaf(self, place: int, digest: str, keep: bool = False) -> None:
        """Take the next leaf, then all nodes whose labels are now due."""
        self._send(0, place, digest)
        while self.queue and self.queue[0][0] <= place:
            _, level, index, first = heapq.heappop(self.queue)
            parts = [first]
            while self.queue and self.queue[0][1] == level and self.queue[0][2] // self.fan == index // self.fan:
                parts.append(heapq.heappop(self.queue)[3])
            if keep:
                self.children[level, index // self.fan] = parts
            self._send(level, index // self.fan, sha("".join(parts)))


def _block_shape(n: int, block: int, fan: int, levels: int) -> tuple[int, int]:
    """(leaves of a block, levels that it is folded by) in a tree of ``n`` leaves."""
    size = fan ** levels
    return min(size, n - block * size), min(levels, levels_of(n, fan))


def _blocks(frames: Iterator[pd.DataFrame], size: int, start, take, end) -> Iterator:
    """Call ``start(row)`` at each new (tree, block), ``take(row)`` on all rows; yields ``end()`` of each block."""
    key = None
    for frame in frames:
        for row in frame.itertuples(index=False):
            if key != (row.tree, row.pos // size):
                if key is not None:
                    yield end()
                key = (row.tree, row.pos // size)
                start(row)
            take(row)
    if key is not None:
        yield end()


def fold_up(rows: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """The next round's leaves: tree, pos, digest, n; one row per block. rows: tree, pos, digest, n."""
    size = fan ** levels

    def sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict = {}

        def start(row) -> None:
            n, depth = _block_shape(row.n, row.pos // size, fan, levels)
            state.update(tree=row.tree, block=row.pos // size, n=-(-row.n // size), sweep=Sweep(n, depth, fan))

        def end() -> tuple:
            tops = state["sweep"].tops
            if len(tops) != 1:
                raise ValueError(f"a block gave {len(tops)} roots")
            return state["tree"], state["block"], tops[0], state["n"]

        out = []
        for got in _blocks(frames, size, start, lambda row: state["sweep"].leaf(row.pos % size, row.digest), end):
            out.append(got)
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=["tree", "pos", "digest", "n"])
                out = []
        yield pd.DataFrame(out, columns=["tree", "pos", "digest", "n"])

    block = F.floor(F.col("pos") / size).cast("long")
    return (rows.select("tree", "pos", "digest", "n").withColumn("block", block).repartition("tree", "block")
            .sortWithinPartitions("tree", "block", "pos").drop("block")
            .mapInPandas(sweep, "tree string, pos long, digest string, n long"))


def rounds_up(rows: DataFrame, fan: int, levels: int, name: str) -> list[DataFrame]:
    """The leaves of each round, ending with one row per tree."""
    out = [rows]
    most = rows.agg(F.max("n")).first()[0] or 0
    while True:
        out.append(written(fold_up(out[-1], fan, levels), name))
        most = -(-most // fan ** levels)
        if most <= 1:
            return out


def _path_rows(sweep: Sweep, suffix: str, fan: int) -> dict[int, str]:
    """Proof suffixes of a block's leaves: reversed sweep from the block's root, whose own suffix is given.

    A suffix has a part ``left,right;`` for each level, with the digests of the siblings on either side.
    """
    due = [(-(sweep.n - 1), -sweep.levels, 0, suffix)]   # the reverse of the labels
    out: dict[int, str] = {}
    while due:
        _, level, index, above = heapq.heappop(due)
        level = -level
        if level == 0:
            out[index] = above
            continue
        parts = sweep.children[level, index]
        for k in range(len(parts)):
            place = index * fan + k
            last = min(sweep.n, (place + 1) * fan ** (level - 1)) - 1
            heapq.heappush(due, (-last, -(level - 1), place,
                                 f"{''.join(parts[:k])},{''.join(parts[k + 1:])};{above}"))
    return out


def send_down(rows: DataFrame, suffixes: DataFrame, visit, schema: str, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Deliver proof suffixes to the leaves of a round.

    rows: tree, pos, digest, n and further columns; suffixes: tree, pos (block), suffix, subroot, root.
    ``visit(row, suffix, subroot, root)`` gives each leaf's output row.
    """
    size = fan ** levels
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    extra = [c for c in rows.columns if c not in ("tree", "pos", "digest", "n")]
    types = dict(rows.dtypes)
    messages = suffixes.select(
        "tree", (F.col("pos") * size).alias("pos"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("digest"),
        F.lit(0).cast("long").alias("n"), *[F.lit(None).cast(types[c]).alias(c) for c in extra], "suffix", "subroot", "root")
    none = [F.lit(None).cast("string").alias(c) for c in ("suffix", "subroot", "root")]
    both = messages.unionByName(rows.select("tree", "pos", F.lit(1).alias("kind"), "digest", "n", *extra, *none))

    def sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict = {}

        def start(row) -> None:   # the block's message
            if row.kind != 0:
                raise ValueError("a block has no proof from above")
            state.update(message=row, rows=[])

        def take(row) -> None:
            if row.kind == 1:
                state["rows"].append(row)

        def end() -> list[tuple]:   # a block is bounded: FAN ** LEVELS leaves
            held, message = state["rows"], state["message"]
            n, depth = _block_shape(held[0].n, held[0].pos // size, fan, levels)
            up = Sweep(n, depth, fan)
            for row in held:
                up.leaf(row.pos % size, row.digest, keep=True)
            paths = _path_rows(up, message.suffix, fan)
            return [visit(row, paths[row.pos % size], message.subroot, message.root) for row in held]

        for out in _blocks(frames, size, start, take, end):
            yield pd.DataFrame(out, columns=names)

    block = F.floor(F.col("pos") / size).cast("long")
    return (both.withColumn("block", block).repartition("tree", "block")
            .sortWithinPartitions("tree", "block", "kind", "pos").drop("block").mapInPandas(sweep, schema))


def folded(digest: str, suffix: str) -> str:
    """The root that a digest and its proof suffix give."""
    for part in suffix.split(";")[:-1]:
        left, _, right = part.partition(",")
        digest = sha(left + digest + right)
    return digest


def siblings(suffix: str) -> str:
    """The digests of a proof, level by level, left to right."""
    return suffix.replace(",", "").replace(";", "")


SUFFIX = "tree string, pos long, suffix string, subroot string, root string"


def _down(rounds: list[DataFrame], first: DataFrame, fan: int, levels: int, name: str) -> DataFrame:
    """Suffixes of the blocks of the first round, from those of the last."""
    at = first
    for rows in reversed(rounds[1:-1]):
        at = written(send_down(rows, at, lambda row, suffix, subroot, root: (row.tree, row.pos, suffix, subroot, root),
                               SUFFIX, fan, levels), name)
    return at


def manifest(documents: DataFrame, tampered: Column, fan: int = FAN, levels: int = LEVELS,
             proofs: bool = True) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof, proof_sha256, folded_root, verified: one row per document.

    tampered: condition over the documents' columns; such rows are folded from the digest of their lower-cased text.
    ``proof`` holds the siblings level by level, ``left,right;`` each (NULL without ``proofs``).
    """
    rows = with_places(written(leaves(documents, tampered), "leaves"), "tree", ["doc_id", "leaf"])
    rows = written(rows, "leaf-places")
    counts = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(counts, "tree").withColumnRenamed("leaf", "digest")
    ups = rounds_up(rows.select("tree", "pos", "digest", "n"), fan, levels, "merkle-up")
    subroots = with_places(ups[-1].select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest"), "all", ["name"])
    subroots = written(subroots, "subroots")
    n_sources = subroots.count()
    top = subroots.select(F.col("all").alias("tree"), "pos", "digest", F.lit(n_sources).cast("long").alias("n"), "name")
    tops = rounds_up(top.select("tree", "pos", "digest", "n"), fan, levels, "merkle-top")
    root = tops[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.lit("").alias("suffix"),
                           F.lit("").alias("subroot"), F.col("digest").alias("root"))
    blocks = _down(tops, root, fan, levels, "merkle-top-down")
    named = written(send_down(
        top, blocks, lambda row, suffix, subroot, root: (row.name, 0, suffix, row.digest, root), SUFFIX, fan, levels),
        "merkle-subroots")
    blocks = _down(ups, named, fan, levels, "merkle-down")

    def visit(row, suffix: str, subroot: str, root: str) -> tuple:
        end = folded(row.digest if row.other is None else row.other, suffix)
        return (row.id, row.tree, row.digest, subroot, root, suffix if proofs else None, sha(siblings(suffix)), end, end == root)

    # Ids go through Python as text, so that a NULL beside them rounds none.
    out = send_down(rows.select("tree", "pos", "digest", "n", "other", F.col("doc_id").cast("string").alias("id")), blocks, visit,
                    "id string, tree string, leaf string, subroot string, root string, proof string, proof_sha256 string, "
                    "folded_root string, verified boolean", fan, levels)
    source = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
    return out.select(F.col("id").cast(documents.schema["doc_id"].dataType).alias("doc_id"), source.alias("source"),
                      "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified")


def tampered_fifth() -> Column:
    """Rows whose id's checksum is divisible by five."""
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0


def digest(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    return manifest(documents, tampered_fifth(), proofs=False).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
