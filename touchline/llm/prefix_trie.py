"""Conversation prefix trie: a node table with minimal-perfect-hash slots.

A node is a distinct sequence of first turns (role, text); its key is a
128-bit polynomial digest of that sequence, so that a prefix of a long
conversation can be digested from where another task left off.

Shards: a conversation's turns are cut into stretches of ``stretch`` turns,
and whole stretches are dealt by a hash into shards of bounded size. So
neither a very common first turn nor a very long conversation decides what a
task holds. In a shard (numpy arrays, one entry per slot):

1. the distinct prefix digests are enumerated and given the slots of a
   minimal perfect hash; every slot is verified by writing the digest into it
   and reading all of them back, and every row of a slot must agree on parent
   and last turn, so a digest collision is an error and never a wrong count;
2. members, ends and the smallest member are scattered into flat arrays.

Shards are merged by digest (sums and minima, map-side combined). Each node
then has one owner: the stretch of its smallest member. Only there it puts in
its own leaf and tokens; each shard accumulates them through its parent-slot
array, deepest nodes first, and the partial sums of a node add up to its
subtree, because all nodes that a conversation owns lie below each other on
its path. What a conversation owns beyond a stretch is carried to the
stretch's last node.

Members' ids are hashed in order: ids are range-partitioned by (node, id) and
joined to blocks in place, so that a node with a third of all conversations
reaches the one hash (which is sequential by nature) as few rows.

Defined results: rows without a conv_id belong to no conversation. NULL role
or text counts as empty. NULL turns come first; equal turn numbers are put in
order of the MD5 of role and text, repeated rows are turns of their own. A
table without conversations gives no nodes, not even a root. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import written
from touchline.llm.places import with_places

#: Digests are polynomials in BASE modulo a Mersenne prime.
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefix").digest()[:16], "big") % PRIME
ROOT = bytes(16)
#: Turns of a conversation in one shard, and rows in a shard.
STRETCH = 4096
SHARD_ROWS = 100_000
#: Ids in a block of members.
ID_BLOCK = 8192
NONE = np.iinfo(np.int64).max


class SlotTable:
    """Minimal perfect hash of distinct 128-bit keys (n x 2 uint64): each key's slot is in 0..n-1.

    Level by level, keys alone at their place of a bit table get the next
    ranks; the others go on to the next, smaller level.
    """

    LOAD = 1.5

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, base = keys, 0
        while len(left):
            place = self._place(left, len(self.levels), max(2, int(len(left) * self.LOAD)))
            alone = np.bincount(place, minlength=max(2, int(len(left) * self.LOAD))) == 1
            self.levels.append((alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            left = left[~alone[place]]
            if len(self.levels) > 200:
                raise ValueError("keys of a slot table are not distinct")
        self.keys = np.zeros_like(keys)
        slots = self.slots(keys)
        self.keys[slots] = keys
        if len(keys) and (np.bincount(slots, minlength=len(keys)).max() > 1 or (self.keys[slots] != keys).any()):
            raise ValueError("two keys share a slot")

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (keys[:, 0] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(31)) ^ keys[:, 1]) * np.uint64(0x94D049BB133111EB)
            return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; keys that are not in the table get -1 or another key's slot."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(keys[left], level, len(alone))
            hit = alone[place]
            out[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return out

    def verified(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys that must all be in the table."""
        slots = self.slots(keys)
        if len(keys) and (slots.min() < 0 or (self.keys[slots] != keys).any()):
            raise ValueError("a digest is not in its shard's node table")
        return slots


def as_keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)


def distinct_keys(keys: np.ndarray) -> np.ndarray:
    ordered = keys[np.lexsort((keys[:, 1], keys[:, 0]))]
    new = np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)] if len(ordered) else np.zeros(0, bool)
    return ordered[new]


def turn_value(turn_key: bytes) -> int:
    return int.from_bytes(turn_key, "big") % PRIME + 1


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (1, 2, ...), turn_key (MD5 of role and text), chars (code points of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8")))
        .alias("turn_key"), F.length(text).cast("long").alias("chars"))
    placed = with_places(written(rows, "turns"), "conv_id", ["turn", "turn_key"], "place")
    return written(placed.select("conv_id", (F.col("place") + 1).alias("pos"), "turn_key", "chars"), "numbered")


def sizes(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))


def branched(turns: DataFrame, kept: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, sizes) of conversations whose first ``kept`` turns are replaced by those of conversation ``base``.

    kept, base: columns over conv_id; kept is at most ``most``. Shorter
    conversations give what they have, absent ones nothing.
    """
    heads = turns.where(F.col("pos") <= most).groupBy(F.col("conv_id").alias("base_id")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "turn_key", "chars"))).alias("head"))  # ``most`` entries at most
    own = sizes(turns).select("conv_id", F.col("n_turns").alias("n_own"), kept.cast("long").alias("h"), base.alias("base_id"))
    k = F.least("h", F.coalesce(F.size("head").cast("long"), F.lit(0).cast("long")))
    k = F.when(F.col("head").isNull(), F.lit(0).cast("long")).otherwise(k)
    info = written(own.join(heads, "base_id", "left").select(
        "conv_id", "h", k.alias("k"), (k + F.greatest(F.col("n_own") - F.col("h"), F.lit(0).cast("long"))).alias("n_turns"),
        F.slice("head", F.lit(1), k.cast("int")).alias("head")), "branches")
    taken = info.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.*")
    rest = turns.join(info.select("conv_id", "h", "k"), "conv_id").where(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "turn_key", "chars")
    return taken.unionByName(rest), info.select("conv_id", "n_turns")


def _seeds(long_turns: DataFrame, stretch: int) -> DataFrame:
    """conv_id, piece, pos, digest: the prefix digest just before each later stretch of long conversations."""
    names = ["conv_id", "piece", "n", "digest"]

    def folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n, q, out = None, 0, 0, []
        for frame in frames:
            for conv, piece, turn in zip(frame["conv_id"].tolist(), frame["piece"].tolist(), frame["turn_key"], strict=True):
                if key != (conv, piece):
                    if key:
                        out.append((*key, n, q.to_bytes(16, "big")))
                    key, n, q = (conv, piece), 0, 0
                n, q = n + 1, (q * BASE + turn_value(turn)) % PRIME
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if key:
            out.append((*key, n, q.to_bytes(16, "big")))
        yield pd.DataFrame(out, columns=names)

    def chained(pieces: pd.DataFrame) -> pd.DataFrame:   # one row per stretch of one conversation
        q, out = 0, []
        for piece, n, digest in pieces.sort_values("piece")[["piece", "n", "digest"]].itertuples(index=False):
            if piece:
                out.append((pieces["conv_id"].iloc[0], piece, piece * stretch, q.to_bytes(16, "big")))
            q = (q * pow(BASE, int(n), PRIME) + int.from_bytes(digest, "big")) % PRIME
        return pd.DataFrame(out, columns=["conv_id", "piece", "pos", "digest"])

    whole = (long_turns.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "pos")
             .mapInPandas(folded, "conv_id long, piece long, n long, digest binary"))
    return whole.groupBy("conv_id").applyInPandas(chained, "conv_id long, piece long, pos long, digest binary")


LOCAL = ("shard long, digest binary, parent binary, depth long, turn_key binary, chars long, "
         "n long, low long, ends array<long>")


def _local_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """The node table of one shard. rows: shard, conv_id, pos, turn_key, chars, n_turns, digest, by (conv_id, piece, pos).

    A row with a digest starts a stretch: the root, or the node before it (a
    ghost, without members here).
    """
    digests, parents, q = [], [], 0
    given = rows["digest"].tolist()
    for turn, digest in zip(rows["turn_key"].tolist(), given, strict=True):
        if digest is not None:
            q, before = int.from_bytes(digest, "big"), digest
            digests.append(digest)
            parents.append(digest)   # of its own: not accumulated further
        else:
            q = (q * BASE + turn_value(turn)) % PRIME
            parents.append(before)
            before = q.to_bytes(16, "big")
            digests.append(before)
    keys, pos = as_keys(digests), rows["pos"].to_numpy()
    table = SlotTable(distinct_keys(keys))
    slot, n = table.slots(keys), len(table.keys)
    start = np.array([d is not None for d in given])
    member = ~start | (pos == 0)
    depth, chars = np.zeros(n, np.int64), np.zeros(n, np.int64)
    depth[slot], chars[slot[~start]] = pos, rows["chars"].to_numpy()[~start]
    parent, turn = np.full(n, ROOT, object), np.full(n, None, object)
    own = np.flatnonzero(~start)
    all_parents, all_turns = np.array([*parents, None], object)[:-1], np.array([*rows["turn_key"], None], object)[:-1]
    parent[slot[own]], turn[slot[own]] = all_parents[own], all_turns[own]
    if (parent[slot[own]] != all_parents[own]).any() or (turn[slot[own]] != all_turns[own]).any() or (
            depth[slot] != pos).any():
        raise ValueError("two prefixes have one digest")
    conv = rows["conv_id"].to_numpy()
    count, low = np.zeros(n, np.int64), np.full(n, NONE)
    np.add.at(count, slot[member], 1)
    np.minimum.at(low, slot[member], conv[member])
    ends: list[list[int]] = [[] for _ in range(n)]
    done = member & (pos == rows["n_turns"].to_numpy())
    for s, c in zip(slot[done].tolist(), conv[done].tolist(), strict=True):
        ends[s].append(c)
    lone = low == NONE
    return pd.DataFrame({
        "shard": rows["shard"].iloc[0], "digest": [k.astype(">u8").tobytes() for k in table.keys], "parent": parent,
        "depth": depth, "turn_key": turn, "chars": chars, "n": count,
        "low": pd.array(np.where(lone, 0, low), "Int64"), "ends": ends}).assign(
            low=lambda f: f["low"].mask(lone))


def _by_shard(frames: Iterator[pd.DataFrame], work) -> Iterator[pd.DataFrame]:
    """``work`` on each whole shard of a stream that is sorted by shard."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        cuts = [0, *(np.flatnonzero(np.diff(frame["shard"].to_numpy())) + 1).tolist(), len(frame)]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            part = frame.iloc[a:z]
            if held and len(part) and held[0]["shard"].iloc[0] != part["shard"].iloc[0]:
                yield work(pd.concat(held, ignore_index=True))
                held = []
            if len(part):
                held.append(part)
    if held:
        yield work(pd.concat(held, ignore_index=True))


def _accumulate(rows: pd.DataFrame, stretch: int) -> pd.DataFrame:
    """Partial subtree sums of one shard. rows: digest, parent, depth, kind, owner, mine, leaf, saved.

    kind 0: a node; 1: the ghost before a stretch; 2: a carry for a node. The first nodes of a later stretch do
    not add to the node before it, whether that is here or not: what lies beyond a stretch is carried.
    """
    nodes = rows["kind"].to_numpy() < 2
    keys = as_keys(rows["digest"].tolist())
    table = SlotTable(distinct_keys(keys[nodes]))
    slot, n = table.verified(keys), len(table.keys)
    at, real = np.flatnonzero(nodes), np.flatnonzero(rows["kind"].to_numpy() == 0)
    depth, owner = np.zeros(n, np.int64), np.zeros(n, np.int64)
    depth[slot[at]], owner[slot[at]] = rows["depth"].to_numpy()[at], rows["owner"].to_numpy()[at]
    up = np.full(n, -1, np.int64)   # parent slots; none above the root and above ghosts
    below = real[rows["depth"].to_numpy()[real] > 0]
    up[slot[below]] = table.verified(as_keys(rows["parent"].iloc[below].tolist())) if len(below) else 0
    leaf, saved, children = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(leaf, slot, rows["leaf"].to_numpy())
    np.add.at(saved, slot, rows["saved"].to_numpy())
    placed = below[rows["mine"].to_numpy()[below]]
    np.add.at(children, up[slot[placed]], 1)
    order = np.argsort(-depth, kind="stable")
    edge = [0, *(np.flatnonzero(np.diff(depth[order])) + 1).tolist(), n]
    for a, z in zip(edge[:-1], edge[1:], strict=True):
        level = order[a:z]
        d = int(depth[level[0]])
        if d == 0 or (d > 1 and (d - 1) % stretch == 0):
            continue
        level = level[up[level] >= 0]
        np.add.at(leaf, up[level], leaf[level])
        np.add.at(saved, up[level], saved[level])
    parent_owner = np.where(up >= 0, owner[up], NONE)
    return pd.DataFrame({"digest": [k.astype(">u8").tobytes() for k in table.keys], "n_children": children,
                         "n_leaves": leaf, "saved_tokens": saved, "parent_owner": parent_owner})


def _end_hashes(ends: DataFrame) -> DataFrame:
    """digest, ends_sha256 of the ascending, comma-joined ids. ends: digest, id; at least two of each digest."""
    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []
        for frame in frames:
            out = []
            for digest, i in zip(frame["digest"], frame["id"].tolist(), strict=True):
                if held and (digest != key or len(held) == ID_BLOCK):
                    out.append((key, held[0], ",".join(map(str, held))))
                    held = []
                key = digest
                held.append(i)
            if out:
                yield pd.DataFrame(out, columns=["digest", "first", "ids"])
        if held:
            yield pd.DataFrame([(key, held[0], ",".join(map(str, held)))], columns=["digest", "first", "ids"])

    def hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, running = None, None
        for frame in frames:
            out = []
            for digest, ids in zip(frame["digest"], frame["ids"], strict=True):
                if digest != key:
                    if running is not None:
                        out.append((key, running.hexdigest()))
                    key, running = digest, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["digest", "ends_sha256"])
        if running is not None:
            yield pd.DataFrame([(key, running.hexdigest())], columns=["digest", "ends_sha256"])

    order = ("digest", "id")
    joined = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        blocks, "digest binary, first long, ids string")
    return joined.repartition("digest").sortWithinPartitions("digest", "first").mapInPandas(
        hashes, "digest binary, ends_sha256 string")


def node_table(turns: DataFrame, lengths: DataFrame, stretch: int = STRETCH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node: digest, parent, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    turns: conv_id, pos (1, 2, ... without gaps), turn_key, chars. lengths: conv_id, n_turns, also of turnless
    conversations.
    """
    turns = written(turns.select("conv_id", "pos", F.floor((F.col("pos") - 1) / stretch).cast("long").alias("piece"),
                                 "turn_key", "chars"), "trie-turns")
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("piece"), zero.alias("pos"), F.lit(bytearray(ROOT)).alias("digest"))
    whole = lengths.where(F.col("n_turns") > stretch).select("conv_id").withColumn("long", F.lit(True))
    seeds = written(_seeds(turns.join(whole, "conv_id").drop("long"), stretch), "trie-seeds")
    n_rows = turns.count()
    shards = max(1, -(-n_rows // shard_rows))
    starts = roots.unionByName(seeds).select("*", F.lit(None).cast("binary").alias("turn_key"), zero.alias("chars"))
    rows = turns.withColumn("digest", F.lit(None).cast("binary")).unionByName(starts)
    ends_at = lengths.select("conv_id", "n_turns")
    rows = rows.join(ends_at, "conv_id").select(
        F.pmod(F.xxhash64("conv_id", "piece"), F.lit(shards)).alias("shard"), "*")
    order = ["shard", "conv_id", "piece", F.col("digest").isNull(), "pos"]
    local = written(rows.repartition("shard").sortWithinPartitions(*order).mapInPandas(
        lambda frames: _by_shard(frames, _local_nodes), LOCAL), "trie-local")

    end = F.when(F.size("ends") > 0, F.array_min("ends"))
    merged = local.where(F.col("n") > 0).groupBy("digest").agg(
        F.min("parent").alias("parent"), F.max("parent").alias("parent2"), F.min("turn_key").alias("turn_key"),
        F.max("turn_key").alias("turn_key2"), F.max("depth").alias("depth"), F.max("chars").alias("chars"),
        F.sum("n").alias("n_convs"), F.min("low").alias("owner"), F.sum(F.size("ends")).alias("n_ends"),
        F.min(end).alias("first_end"))
    same = F.col("parent").eqNullSafe(F.col("parent2")) & F.col("turn_key").eqNullSafe(F.col("turn_key2"))
    nodes = written(merged.select(
        "digest", "parent", F.when(same, F.col("depth")).otherwise(
            F.raise_error(F.lit("two prefixes have one digest")).cast("long")).alias("depth"),
        "n_convs", "owner", "n_ends", "first_end", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie-nodes")

    # Each shard's nodes, with what they put in where their owner's stretch is.
    known = nodes.select("digest", "owner", "leaf", "saved")
    mine = (F.col("n") > 0) & (F.col("low") == F.col("owner"))
    put = local.select("shard", "digest", "parent", "depth", "n", "low").join(known, "digest").select(
        "shard", "digest", "parent", "depth", F.when(F.col("n") > 0, 0).otherwise(1).alias("kind"), "owner",
        mine.alias("mine"), F.when(mine, F.col("leaf")).otherwise(zero).alias("leaf"),
        F.when(mine, F.col("saved")).otherwise(zero).alias("saved"))
    # What long conversations own beyond a stretch goes to the stretch's last node.
    beyond = nodes.join(whole, nodes.owner == whole.conv_id).groupBy(
        "conv_id", F.floor((F.greatest(F.col("depth"), F.lit(1)) - 1) / stretch).cast("long").alias("piece")).agg(
            F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    later = Window.partitionBy("conv_id").orderBy(F.col("piece").desc())   # one row per stretch
    carried = seeds.join(beyond, ["conv_id", "piece"], "left").select(
        "conv_id", "piece", "digest", F.coalesce(F.sum("leaf").over(later), zero).alias("leaf"),
        F.coalesce(F.sum("saved").over(later), zero).alias("saved"))
    carries = carried.select(
        F.pmod(F.xxhash64("conv_id", F.col("piece") - 1), F.lit(shards)).alias("shard"), "digest",
        F.lit(None).cast("binary").alias("parent"), zero.alias("depth"), F.lit(2).alias("kind"), zero.alias("owner"),
        F.lit(False).alias("mine"), "leaf", "saved")
    sums = (put.unionByName(carries).repartition("shard").sortWithinPartitions("shard")
            .mapInPandas(lambda frames: _by_shard(frames, lambda rows: _accumulate(rows, stretch)),
                         "digest binary, n_children long, n_leaves long, saved_tokens long, parent_owner long")
            .groupBy("digest").agg(F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                                   F.sum("saved_tokens").alias("saved_tokens"), F.min("parent_owner").alias("parent_owner")))
    several = nodes.where(F.col("n_ends") > 1).select("digest")
    ids = _end_hashes(local.where(F.size("ends") > 0).select("digest", "ends").join(several, "digest")
                      .select("digest", F.explode("ends").alias("id")))
    hashed = F.coalesce("ends_sha256", F.sha2(F.encode(F.coalesce(F.col("first_end").cast("string"), F.lit("")), "UTF-8"), 256))
    return nodes.join(sums, "digest").join(ids, "digest", "left").select(
        "digest", F.when(F.col("depth") > 0, F.col("parent")).alias("parent"), "depth", F.col("owner").alias("conv_id"),
        F.when(F.col("depth") > 0, F.col("parent_owner")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", hashed.alias("ends_sha256"))


def trie(conversations: DataFrame, stretch: int = STRETCH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The node table of the conversations as they are."""
    turns = numbered(conversations)
    return node_table(turns, sizes(turns), stretch, shard_rows)


def rebuilt_trie(conversations: DataFrame, most: int = 6, group: int = 100, stretch: int = STRETCH,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The node table of conversations that start like the first of their hundred, for a hashed number of turns."""
    turns = numbered(conversations)
    kept = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most
    base = F.col("conv_id") - F.col("conv_id") % group
    return node_table(*branched(turns, kept, base, most - 1), stretch, shard_rows).drop("digest", "parent")
