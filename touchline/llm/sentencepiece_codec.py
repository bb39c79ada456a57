"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks a text character by character. For the end of every prefix
it keeps one backpointer, the last piece of the best segmentation of that
prefix; a piece is at most ``max_len`` characters long, so only the last
``max_len`` boundaries can still be extended. Whenever all surviving
backpointer paths meet in one boundary, everything before it is final: its
ids are committed and the window is cut there. ``Codec.blocks`` gives the
committed ids of a text block by block, out of slices of the text, so the
search's memory is bounded whatever the length of the text (tested); a row's
text and its ids are values of Spark's rows and are held whole there.

Two kinds of model decide which last piece is best:

``unigram``  the highest sum of piece scores;
``bpe``      the only piece that byte-pair merging would leave at the end of
             that prefix: piece ``b`` may follow piece ``a`` if merging the
             characters of ``a`` and ``b`` gives those two pieces again. Each
             prefix has exactly one such chain, so the ids equal those of
             merging the whole text.

If no piece holds the space mark after another character, all paths meet at
the start of every run of space marks. These boundaries need no look at the
backpointers: the window is cut there, slice by slice, and what lies between
two of them is a window of its own. New windows of at most ``SHORT``
characters advance side by side, one boundary at a time, over a trie of the
pieces, and are committed at their end; longer ones (runs without a space)
are walked with the moving window above, which looks for the boundary where
all paths meet. Windows recur, so each worker remembers the ids of a bounded
number of them.

Text is used as it is (identity normalisation) with one space mark put in
front. Characters without a piece become byte pieces, or the unknown id.
Decoding joins the pieces, turns byte pieces back into UTF-8 and removes the
mark in front, so a text comes back exactly unless it holds the mark
character U+2581 itself, which comes back as a space.

Defined results: NULL and empty texts have no ids; decoding NULL or empty ids
gives an empty text. Ids out of range decode to the replacement character.
Rows, repeated or not, are independent; other columns pass through.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Entries of a worker's memory of short chunks, and of its memory of piece pairs.
MEMORY = 240_000
PAIRS = 100_000
#: Slots of the table of piece pairs (a power of two).
SLOTS = 1 << 20
#: Longest chunk searched side by side.
SHORT = 48
#: Characters of a text cut at a time, of slices held at a time, and of a part given to the moving window.
SLICE = 1 << 16
STRETCH = 1 << 20
PART = 1 << 12
_BYTE = re.compile("<0x([0-9A-F]{2})>")


class Codec:
    """Encoder and decoder over a piece list."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[bool], unk_id: int = 0,
                 kind: str = "bpe"):
        self.pieces, self.kind, self.unk_id = pieces, kind, unk_id
        self.score = {p: s for p, s, ok in zip(pieces, scores, normal, strict=True) if ok}
        self.id = {p: i for i, (p, ok) in enumerate(zip(pieces, normal, strict=True)) if ok}
        self.byte_id = {int(m[1], 16): i for i, (p, ok) in enumerate(zip(pieces, normal, strict=True))
                        if not ok and (m := _BYTE.fullmatch(p))}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.max_len = max(map(len, self.id), default=1)
        by_end: dict[str, set[int]] = {}
        for p in self.id:
            by_end.setdefault(p[-1], set()).add(len(p))
        #: Lengths of the pieces that end in a character, longest first.
        self.lengths = {c: sorted(n, reverse=True) for c, n in by_end.items()}
        self.chunked = not any(MARK in p.lstrip(MARK) for p in self.id)
        # Control characters without a piece stand alone.
        lone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.id))
        self.chunk = re.compile((f"[{lone}]|" if lone else "") + f"{MARK}*[^{MARK}{lone}]+|{MARK}+")
        #: The same over a text in which spaces are not marked yet.
        self.raw_chunk = re.compile((f"[{lone}]|" if lone else "") + f"[ {MARK}]*[^ {MARK}{lone}]+|[ {MARK}]+")
        self.floor = min(self.score.values(), default=0.0) - 10.0
        self.spines: dict[str, tuple[list[str], list[str]] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        #: Chunk -> its ids, packed.
        self.memory: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        self.dtype = np.dtype("<u2" if len(pieces) < 1 << 16 else "<i4")
        self.letter = None
        #: What each id decodes to; bytes of longer characters are marked in ``high``.
        self.shown = np.array([chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p.replace(MARK, " ")
                               for i, p in enumerate(pieces)], dtype=object)
        self.shown[unk_id] = "\ufffd"
        self.high = np.array([self.byte_of.get(i, 0) >= 128 for i in range(len(pieces))])

    def _spines(self, piece: str) -> tuple[list[str], list[str]] | None:
        """How merging builds a piece at its right and at its left edge.

        Merging takes the best score first, the leftmost on ties. None if it
        does not end in the piece itself.
        """
        parts, score = list(piece), self.score
        right, left = [parts[-1]], [parts[0]]
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if parts[-1] != right[-1]:
                right.append(parts[-1])
            if parts[0] != left[-1]:
                left.append(parts[0])
        return right, left

    def _follows(self, a: str, b: str) -> bool:
        """Whether merging leaves the boundary between two pieces alone.

        Both edges grow towards it, the better merge first. A merge across it
        happens if it beats the next growth of either side; on equal scores
        the one further left goes first.
        """
        spines = self.spines
        for piece in (a, b):
            if piece not in spines:
                spines[piece] = self._spines(piece) if piece else ([""], [""])
        if spines[b] is None:
            return False
        if not a:
            return True
        if spines[a] is None:
            return False
        right, left, score = spines[a][0], spines[b][1], self.score
        i = j = 0
        never = float("-inf")
        while True:
            grow_a = score[right[i + 1]] if i + 1 < len(right) else never
            grow_b = score[left[j + 1]] if j + 1 < len(left) else never
            across = score.get(right[i] + left[j], never)
            if across > grow_a and across >= grow_b:
                return False
            if grow_a == never and grow_b == never:
                return True
            if grow_a >= grow_b:
                i += 1
            else:
                j += 1

    def boundaries(self, parts: str | Iterable[str]) -> Iterator[str]:
        """Committed pieces in order, as soon as they are certain.

        The text may come in parts; held are the window (the text since the
        last committed boundary) and one part.
        """
        if isinstance(parts, str):
            parts = [parts[i:i + PART] for i in range(0, len(parts), PART)]
        back: list[int] = [0]        # start of the last piece, by boundary - base
        total: list[float] = [0.0]   # unigram score
        bpe, lengths, score = self.kind == "bpe", self.lengths, self.score
        base, end, window = 0, 0, ""
        pairs = self.pairs
        last: list[str] = [""]
        for part in parts:
            window += part
            while end - base < len(window):
                end += 1
                letter = window[end - base - 1]
                best, start = None, end - 1
                for n in lengths.get(letter, ()):
                    s = end - n
                    if s < base:
                        continue
                    piece = window[s - base:end - base]
                    if piece not in score:
                        continue
                    if bpe:
                        key = (last[s - base], piece)
                        fits = pairs.get(key)
                        if fits is None:
                            if len(pairs) >= PAIRS:
                                pairs.clear()
                            fits = pairs[key] = self._follows(*key)
                        if fits:
                            start = s
                            break
                    else:
                        value = total[s - base] + score[piece]
                        if best is None or value > best:
                            best, start = value, s
                if not bpe:
                    if letter not in score:
                        value = total[end - 1 - base] + self.floor
                        if best is None or value > best:
                            best, start = value, end - 1
                    total.append(best)
                back.append(start)
                last.append(window[start - base:end - base])
                if end - base >= 8 * self.max_len:
                    meet = self._meet(back, base, end)
                    if meet > base:
                        yield from self._path(last, base, meet)
                        cut = meet - base
                        window = window[cut:]
                        del back[:cut], last[:cut]
                        if not bpe:
                            del total[:cut]
                        base = meet
        yield from self._path(last, base, end)

    def _meet(self, back: list[int], base: int, end: int) -> int:
        """The last boundary on every surviving path."""
        alive = set(range(max(base, end - self.max_len + 1), end + 1))
        while len(alive) > 1:
            top = max(alive)
            if top <= base:
                break
            alive.discard(top)
            alive.add(max(back[top - base], base))
        return min(alive)

    @staticmethod
    def _path(last: list[str], base: int, end: int) -> list[str]:
        out = []
        while end > base:
            out.append(last[end - base])
            end -= len(last[end - base])
        return out[::-1]

    def committed(self, parts: str | Iterable[str]) -> Iterator[bytes]:
        """Packed ids of a text by the moving window, a block of committed ones at a time."""
        out: list[int] = []
        previous = None
        for piece in self.boundaries(parts):
            i = self.id.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_id:
                out += [self.byte_id[b] for b in piece.encode("utf-8")]
            elif previous != self.unk_id:
                out.append(self.unk_id)
            previous = out[-1] if out else previous
            if len(out) >= PART:
                yield self._packed(out)
                out = []
        yield self._packed(out)

    def _walked(self, chunk: str) -> bytes:
        return b"".join(self.committed(chunk))

    def _trie(self) -> None:
        """Edges (node, character) -> node as sorted keys; the piece that ends at each node."""
        letters = sorted({c for p in self.id for c in p})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        nodes, ends = {"": 0}, {}
        edges: dict[int, int] = {}
        for piece, i in self.id.items():
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(nodes)
                    edges[nodes[piece[:k - 1]] * self.width + int(self.letter[ord(piece[k - 1])])] = nodes[piece[:k]]
            ends[nodes[piece]] = i
        keys = np.array(sorted(edges), np.int64)
        self.edge_keys, self.edge_to = keys, np.array([edges[k] for k in keys.tolist()], np.int64)
        self.node_piece = np.full(len(nodes), -1, np.int64)
        self.node_piece[list(ends)] = list(ends.values())
        self.piece_len = np.array([len(p) for p in self.pieces])
        self.slot_keys, self.slot_fits = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def _fitting(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """``_follows`` for arrays of piece ids; -1 before means the start.

        Answers are kept in a table with one slot per hash; a newer pair takes
        the slot of an older one.
        """
        n = len(self.pieces)
        keys = (before + 1) * n + piece
        slots = (keys * 0x9E3779B1 >> 15) & (SLOTS - 1)
        fits = self.slot_fits[slots]
        new = np.flatnonzero(self.slot_keys[slots] != keys)
        if len(new):
            asked, back = np.unique(keys[new], return_inverse=True)
            told = []
            for key in asked.tolist():
                a, b = divmod(key, n)
                told.append(self._follows(self.pieces[a - 1] if a else "", self.pieces[b]))
            fits[new] = np.array(told, bool)[back]
            self.slot_keys[slots[new]] = keys[new]
            self.slot_fits[slots[new]] = fits[new]
        return fits

    def _side_by_side(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of many short chunks at once (byte-pair models)."""
        if self.letter is None:
            self._trie()
        size = np.array([len(c) for c in chunks])
        width = int(size.max())
        letters = self.letter[np.array(chunks, dtype=f"U{width}").view(np.uint32).reshape(len(chunks), width)]
        inside = np.arange(width) < size[:, None]
        odd = ((letters == 0) & inside).any(axis=1)
        letters[~inside] = 0
        letters = np.pad(letters, ((0, 0), (0, self.max_len)))
        last = np.full((len(chunks), width + self.max_len + 1), -1, np.int32)
        keys, to = self.edge_keys, self.edge_to
        for start in range(width):
            row = np.flatnonzero((size > start) & ~odd)
            if start:
                row = row[last[row, start] >= 0]
            before, node = last[row, start], np.zeros(len(row), np.int64)
            for n in range(1, self.max_len + 1):
                key = node * self.width + letters[row, start + n - 1].astype(np.int64)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                on = keys[at] == key
                row, before, node = row[on], before[on], to[at[on]]
                if not len(row):
                    break
                piece = self.node_piece[node]
                ends = np.flatnonzero(piece >= 0)
                if len(ends):
                    ends = ends[self._fitting(before[ends].astype(np.int64), piece[ends])]
                    last[row[ends], start + n] = piece[ends]
        # From the ends back to the starts; each step fills one column from the right.
        at = np.where(odd | (last[np.arange(len(chunks)), size] < 0), 0, size)
        lost = (at == 0)
        steps = []
        while (row := np.flatnonzero(at > 0)).size:
            piece = last[row, at[row]]
            broken = row[piece < 0]
            lost[broken], at[broken] = True, 0
            row, piece = row[piece >= 0], piece[piece >= 0]
            at[row] -= self.piece_len[piece]
            step = np.full(len(chunks), -1, np.int32)
            step[row] = piece
            steps.append(step)
        if not steps:
            return [self._walked(c) for c in chunks]
        table = np.stack(steps[::-1], axis=1)
        flat = table[table >= 0].astype(self.dtype).tobytes()
        ends = (np.cumsum((table >= 0).sum(axis=1)) * self.dtype.itemsize).tolist()
        return [self._walked(c) if other else flat[a:z]
                for c, a, z, other in zip(chunks, [0, *ends], ends, lost.tolist(), strict=False)]

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def learn(self, chunks: set[str]) -> None:
        """Search the chunks that are not remembered and remember the short ones."""
        if len(self.memory) >= MEMORY // 2:  # what is still in use moves over again
            self.elder, self.memory = self.memory, {}
        memory, elder, new = self.memory, self.elder, []
        for c in chunks:
            if c not in memory:
                ids = elder.get(c)
                if ids is not None:
                    memory[c] = ids
                elif len(c) <= SHORT:
                    new.append(c)
        if self.kind != "bpe":
            self.memory.update((c, self._walked(c)) for c in new)
            return
        new.sort(key=len)
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            self.memory.update(zip(part, self._side_by_side(part), strict=True))

    def _slices(self, text: str | None) -> Iterator[tuple[list[str], Iterator[str] | None, bool]]:
        """A text in slices of about ``SLICE`` characters: (chunks, run, whether the text ends).

        A slice ends where all paths meet: its last chunk, which may go on,
        opens the next one. A chunk longer than a slice is a run, given in
        parts for the moving window.
        """
        text = text or ""
        at, lead = 0, MARK
        while at < len(text):
            if not self.chunked:
                yield [], itertools.chain([lead], self._marked(text, 0, len(text))), False
                break
            chunks = self.chunk.findall(lead + text[at:at + SLICE].replace(" ", MARK))
            if at + SLICE >= len(text):
                yield chunks, None, False
                break
            open_chunk = chunks.pop()
            if chunks:
                yield chunks, None, False
                at += SLICE - len(open_chunk)
            else:
                end = self.raw_chunk.match(text, at).end()
                yield [], itertools.chain([lead], self._marked(text, at, end)), False
                at = end
            lead = ""
        yield [], None, True

    @staticmethod
    def _marked(text: str, at: int, end: int) -> Iterator[str]:
        return (text[i:min(i + PART, end)].replace(" ", MARK) for i in range(at, end, PART))

    def blocks(self, texts: Iterable[str | None]) -> Iterator[tuple[bytes, bool]]:
        """Packed ids of the texts in order, in committed blocks; True when a text is complete.

        Held are slices of at most ``STRETCH`` characters and one more,
        whatever the length of a text.
        """
        held, size = [], 0
        for text in texts:
            for piece in self._slices(text):
                held.append(piece)
                size += sum(map(len, piece[0]))
                if size >= STRETCH:
                    yield from self._commit(held)
                    held, size = [], 0
        yield from self._commit(held)

    def _commit(self, held: list) -> Iterator[tuple[bytes, bool]]:
        distinct = set()
        distinct.update(*[chunks for chunks, _, _ in held])
        self.learn(distinct)
        known = self.memory
        for chunks, run, last in held:
            if run is not None:
                yield from ((block, False) for block in self.committed(run))
                continue
            try:
                raw = b"".join([known[c] for c in chunks])
            except KeyError:  # a chunk too long to be remembered
                raw = b"".join([known[c] if c in known else self._walked(c) for c in chunks])
            yield raw, last

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        own = []
        for block, last in self.blocks(texts):
            own.append(block)
            if last:
                yield np.frombuffer(b"".join(own), self.dtype).astype(np.int32)
                own = []

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_all([text])).tolist()

    def decode(self, ids) -> str:
        if ids is None or len(ids) == 0:
            return ""
        ids = np.asarray(ids, np.int64)
        ids = np.where((ids < 0) | (ids >= len(self.pieces)), self.unk_id, ids)
        raw = self.high[ids]
        if raw.any():  # parts of characters: runs of them are joined before decoding
            out = []
            edge = np.flatnonzero(np.r_[True, raw[1:] != raw[:-1], True])
            for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if raw[a]:
                    out.append(bytes(self.byte_of[i] for i in ids[a:z].tolist()).decode("utf-8", "replace"))
                else:
                    out.extend(self.shown[ids[a:z]])
        else:
            out = self.shown[ids]
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def load_codec(model: str = MODEL, kind: str = "bpe") -> Codec:
    """The pieces and scores of a model file; one copy per worker."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=model)
    n = range(m.get_piece_size())
    normal = [not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i)) for i in n]
    return Codec([m.id_to_piece(i) for i in n], [m.get_score(i) for i in n], normal, m.unk_id(), kind)


def encode(column: str | Column, model: str = MODEL, kind: str = "bpe") -> Column:
    @F.pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = load_codec(model, kind)
        for batch in texts:
            yield pd.Series(list(codec.encode_all(batch.tolist())), dtype=object)
    return ids(column)


def decode(column: str | Column, model: str = MODEL) -> Column:
    @F.pandas_udf("string")
    def text(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = load_codec(model)
        for batch in ids:
            yield pd.Series([codec.decode(x) for x in batch], dtype=object)
    return text(column)


def encode_and_decode(column: str | Column, model: str = MODEL, kind: str = "bpe") -> Column:
    """Struct of the ids of a text and of what they decode to, by one worker per task."""
    @F.pandas_udf("ids array<int>, decoded string")
    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = load_codec(model, kind)
        for batch in texts:
            ids = pd.Series(list(codec.encode_all(batch.tolist())), dtype=object)
            yield pd.DataFrame({"ids": ids, "decoded": pd.Series([codec.decode(x) for x in ids], dtype=object)})
    return both(column)


def encode_documents(documents: DataFrame, model: str = MODEL, kind: str = "bpe") -> DataFrame:
    """The input with ``ids`` added."""
    return documents.withColumn("ids", encode("text", model, kind))


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The input with ``decoded`` added."""
    return encoded.withColumn("decoded", decode("ids", model))


def round_trip(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, n_ids, n_chars, decoded_sha256, round_trip."""
    text = F.coalesce("text", F.lit(""))
    both = documents.select("doc_id", "text", encode_and_decode("text", model).alias("b"))
    return both.select("doc_id", "b.ids", F.size("b.ids").cast("long").alias("n_ids"),
                       F.length(text).cast("long").alias("n_chars"),
                       F.sha2(F.encode("b.decoded", "UTF-8"), 256).alias("decoded_sha256"),
                       (F.col("b.decoded") == text).alias("round_trip"))
