"""Personal data by a semi-Markov conditional random field.

Base kinds are found by pattern: ``email``, ``ip`` (parts at most 255),
``card`` (13 to 19 digits that pass the Luhn test) and ``phone`` (a plus sign
and 9 to 15 digits). The method adds spans that the patterns miss, such as
phone numbers without a plus sign or spelt-out e-mail addresses.

Model: a text is cut into segments, each either one outside token or an
entity of at most ``MAX_TOKENS`` tokens. A segment's score is a weighted sum
of features of the whole span (its shape, digit groups, Luhn and octet tests,
what stands around it), so boundaries and types are chosen together. Entities
can only lie in regions that hold digits with their separators, an at sign or
its spelling (``[at]``, or ``at`` before a spelt-out ``dot``);
outside these every token is an outside segment, so decoding region by region
gives the best segmentation of the whole text. Forward and backward sums over
the same segments give each segment's probability; the best segmentation's
entities of at least ``min_probability`` that touch no base span are added.

Training: log-likelihood by AdaGrad on made-up regions (the base forms,
variants the patterns miss, and look-alikes such as dates, amounts and serial
numbers, labelled outside) set into the words of a bounded sample of documents
(``sample_docs``, those of least hashed id), and on the sample's own regions,
labelled by the base patterns. What the patterns miss there must not be taught
as outside: a region of the sample in which a first model, of made-up regions
alone, sees more than the base spans is left out of training. Features are
coarse (how a number starts, its digits, groups and last group) or fine (its
whole shape); fine ones are left out of half of the made-up regions, so that the
coarse ones carry forms that were not made up. Everything is seeded.

Offsets are code points, ends exclusive. Defined results: a NULL or empty
text has no spans. Repeated rows each get a row. With an empty table the
model is trained on made-up regions alone and the result is empty. Only
doc_id and text are read.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds in their listed order (fixed by the query's contract).
KINDS = ("email", "ip", "card", "phone")
TYPES = ("out", *KINDS)

_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){2}\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; leftmost and non-overlapping per kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:  # a match can only start where the run before an at sign starts
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _HOST.match(text, at + 1)):
            done = m.end()
            out.append(("email", start, done))
        at = text.find("@", at + 1)
    if not _DIGITS.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if octets(m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


# --- regions and their segments ------------------------------------------

MAX_TOKENS = 24
MAX_CHARS = 64
_NUMERIC = re.compile(r"[+(]{0,2}[0-9](?:[\x20().+/-]{0,3}[0-9])*")
_AT_WORD = re.compile(r"[\[({]\x20?at\x20?[\])}]", re.IGNORECASE | re.ASCII)
_AT_BARE = re.compile(r"\x20at\x20", re.IGNORECASE | re.ASCII)
_AT_ANY = re.compile(f"@|{_AT_WORD.pattern}|{_AT_BARE.pattern}", re.IGNORECASE | re.ASCII)
_BARE_LEFT = re.compile(r"[A-Za-z0-9._%+-]+(?:\x20dot\x20[A-Za-z0-9_-]+)*\Z", re.IGNORECASE | re.ASCII)
_BARE_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:\x20dot\x20[A-Za-z0-9-]+)+", re.IGNORECASE | re.ASCII)
_DOT = re.compile(r"\.|[\[({]\x20?dot\x20?[\])}]|\x20dot\x20", re.IGNORECASE | re.ASCII)
#: Words that stand before and after "at" in plain prose (fixed values).
_PROSE_LEFT = frozenset("look looked looking looks stop arrive arrived meet met stay is was are were be and or not laugh "
                        "aim aimed start started work worked point pointed available".split())
_PROSE_RIGHT = frozenset("the a an this that these those his her its our my your their all least last first once home "
                         "work any each every some".split())
_MAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]+\x20?\Z")
_MAIL_RIGHT = re.compile(r"\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|[\[({]\x20?dot\x20?[\])}])\x20?[A-Za-z0-9-]+)*",
                         re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[\[({]\x20?(?:at|dot)\x20?[\])}]|\S", re.IGNORECASE)
_CUES = (("phone", frozenset("tel phone call fax mobile cell téléphone telefon teléfono".split())),
         ("card", frozenset("card visa mastercard credit amex karte carte tarjeta".split())),
         ("email", frozenset("mail email e contact write".split())),
         ("ip", frozenset("ip host server address addr".split())),
         ("number", frozenset("no nr id order ref isbn serial version invoice build ticket".split())))


@dataclass
class Region:
    """A stretch of text where entities may lie, as tokens (start, end)."""
    text: str
    tokens: list[tuple[int, int]]
    #: segments by the token they end before: (first token, type, features)
    ending: list[list[tuple[int, int, list[str]]]] = field(default_factory=list)
    gold: list[tuple[int, int, int]] = field(default_factory=list)


def _is_numeric(s: str) -> bool:
    return len(_DIGITS.findall(s)) >= 7 or s.count(".") >= 3


def region_spans(text: str) -> list[tuple[int, int]]:
    out = []
    if _DIGITS.search(text):
        out += [m.span() for m in _NUMERIC.finditer(text) if _is_numeric(m[0])]
    marks = [(i, i + 1) for i in _positions(text, "@")]
    low = text if "at" in text or "AT" in text or "At" in text else ""
    marks += [m.span() for m in _AT_WORD.finditer(low)]
    for m in _AT_BARE.finditer(low):
        left = _BARE_LEFT.search(text[max(0, m.start() - MAX_CHARS):m.start()])
        right = _BARE_RIGHT.match(text[m.end():m.end() + MAX_CHARS])
        if left and right:
            out.append((m.start() - len(left[0]), m.end() + right.end()))
    for s, e in marks:
        left = _MAIL_LEFT.search(text[max(0, s - MAX_CHARS):s])
        right = _MAIL_RIGHT.match(text[e:e + MAX_CHARS])
        if left and right:
            out.append((s - len(left[0]), e + right.end()))
    merged: list[list[int]] = []
    for s, e in sorted(out):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return [(s, e) for s, e in merged]


def _positions(text: str, mark: str) -> Iterator[int]:
    at = text.find(mark)
    while at >= 0:
        yield at
        at = text.find(mark, at + 1)


def _near(text: str, start: int, end: int) -> list[str]:
    before, after = text[max(0, start - 24):start], text[end:end + 1]
    words = re.findall(r"[^\W\d_]+", before.lower())[-2:]
    cues = [name for name, words_of in _CUES if any(w in words_of for w in words)]
    last = before[-1:]
    kind = lambda c: "none" if not c else "space" if c.isspace() else "word" if c.isalnum() else c
    return [f"cue:{c}" for c in cues or ["none"]] + [f"left:{kind(last)}", f"right:{kind(after)}"]


def _features(text: str, start: int, end: int, kind: str) -> list[str] | None:
    """Features of a whole span as an entity of a kind; None if it cannot be one."""
    span = text[start:end]
    groups = re.findall("[0-9]+", span)
    n = sum(map(len, groups))
    if kind == "email":
        at = _AT_ANY.search(span)
        if not at:
            return None
        how = "sign" if at[0] == "@" else "bare" if at[0].isascii() and at[0][0] == " " else "marked"
        local, host = span[:at.start()], span[at.end():]
        labels = _DOT.split(host)
        own = [f"{how}|dots:{min(len(labels) - 1, 3)}", f"{how}|at", f"local:{bool(local.strip())}",
               f"tld:{bool(re.search('[A-Za-z]{2,}$', span))}", f"inner:{len(_AT_ANY.findall(span))}",
               f"gap:{' ' in _DOT.sub('', local.strip()) or any(' ' in x.strip() for x in labels)}",
               f"{how}|end:{min(len(labels[-1].strip()), 5)}"]
        if how == "bare":
            own += [f"prose:{_DOT.split(local)[-1].lower() in _PROSE_LEFT}|{labels[0].lower() in _PROSE_RIGHT}"]
    else:
        if re.search("[^0-9 ().+/-]", span):
            return None
        if kind == "ip":
            if span.count(".") < 3 or re.search("[^0-9.]", span):
                return None
            own = [f"parts:{min(len(groups), 6)}", f"octets:{octets(groups)}"]
        elif kind == "card":
            if not 12 <= n <= 20:
                return None
            own = [f"luhn:{luhn(''.join(groups))}", f"n:{n}", f"ok:{13 <= n <= 19}",
                   f"even:{len(groups) == 1 or {len(g) for g in groups[:-1]} == {4}}",
                   f"sep:{''.join(sorted(set(re.sub('[0-9]', '', span))))}"]
        else:
            if not 7 <= n <= 16:
                return None
            plain = re.sub(r"\A00[ .-]?(?=[1-9][0-9]?[ .-])", "+", span)  # an access code is read as a plus sign
            groups = re.findall("[0-9]+", plain)
            sizes, n = [len(g) for g in groups], sum(map(len, groups))
            seps = "".join(sorted(set(re.sub("[0-9+()]", "", span.replace(") ", "").replace(")", "")))))
            lead = next(x for x in ("+", "(0", "(", "0", "1 ", "") if plain.startswith(x) or (
                x == "1 " and groups[0] == "1"))
            thousands = sizes[0] <= 3 and set(sizes[1:]) == {3}
            year = [g for g in groups if len(g) == 4 and g[:2] in ("19", "20") and lead in ("", "1 ")]
            date = bool(year) and max([len(g) for g in groups if g not in year] or [4]) <= 2
            own = [f"lead:{lead}", f"n:{n}", f"lead:{lead}|n:{n}", f"last:{min(sizes[-1], 9)}|{lead in ('', '1 ')}",
                   f"lead:{lead}|groups:{min(len(groups), 6)}", f"long:{min(max(sizes), 9)}|{lead in ('', '1 ')}", f"many:{len(seps) > 1}",
                   f"shape:{'-'.join(str(min(x, 9)) for x in sizes[:6])}", f"paren:{'(' in span and ')' in span}",
                   f"thousands:{thousands}", f"date:{date}", f"year:{bool(year)}", f"book:{groups[0] in ('978', '979')}",
                   f"one:{len(groups) == 1}|{span[:1] == '+'}", f"octets:{span.count('.') >= 3}|{max(sizes) <= 3}"]
    return [f"{kind}|{f}" for f in [*own, *_near(text, start, end), "bias"]]


def build_region(text: str, start: int, end: int) -> Region:
    tokens = [(start + m.start(), start + m.end()) for m in _TOKEN.finditer(text[start:end])]
    region = Region(text, tokens)
    starts_ok = [text[a].isalnum() or text[a] in "+(._%-" for a, _ in tokens]
    ends_ok = [text[b - 1].isalnum() for _, b in tokens]
    for j, (_, b) in enumerate(tokens):
        found = [(j, 0, [f"out|digit:{text[b - 1].isdigit()}", f"out|at:{text[b - 1] == '@'}",
                         f"out|n:{min(b - tokens[j][0], 12)}"])]
        if ends_ok[j]:
            for i in range(j, max(-1, j - MAX_TOKENS), -1):
                a = tokens[i][0]
                if b - a > MAX_CHARS:
                    break
                if not starts_ok[i]:
                    continue
                for t, kind in enumerate(KINDS, 1):
                    got = _features(text, a, b, kind)
                    if got:
                        found.append((i, t, got))
        region.ending.append(found)
    return region


class SemiCrf:
    """Weights by feature; segments are scored whole."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}

    def _scores(self, region: Region) -> list[list[float]]:
        get = self.weights.get
        return [[sum(get(f, 0.0) for f in feats) for _, _, feats in ending] for ending in region.ending]

    def best(self, region: Region) -> list[tuple[int, int, int, float]]:
        """Entities of the best segmentation: (first token, end token, type, probability)."""
        scores = self._scores(region)
        total, back = [0.0], []
        for j, ending in enumerate(region.ending):
            value, k = max((total[seg[0]] + s, -k) for k, (seg, s) in enumerate(zip(ending, scores[j], strict=True)))
            total.append(value)
            back.append(-k)
        ahead, behind = self._sums(region, scores)
        out, j = [], len(region.ending)
        while j:
            i, t, _ = region.ending[j - 1][back[j - 1]]
            if t:
                p = math.exp(min(0.0, ahead[i] + scores[j - 1][back[j - 1]] + behind[j] - ahead[-1]))
                out.append((i, j, t, p))
            j = i
        return out[::-1]

    @staticmethod
    def _sums(region: Region, scores: list[list[float]]) -> tuple[list[float], list[float]]:
        """Log sums over all segmentations before and after each boundary."""
        def add(xs: list[float]) -> float:
            top = max(xs)
            return top + math.log(sum(math.exp(x - top) for x in xs))
        n = len(region.ending)
        ahead = [0.0]
        for j in range(n):
            ahead.append(add([ahead[seg[0]] + s for seg, s in zip(region.ending[j], scores[j], strict=True)]))
        after: list[list[float]] = [[] for _ in range(n + 1)]
        behind = [0.0] * (n + 1)
        for j in range(n, 0, -1):
            if j < n:
                behind[j] = add(after[j])
            for seg, s in zip(region.ending[j - 1], scores[j - 1], strict=True):
                after[seg[0]].append(s + behind[j])
        return ahead, behind

    def fit(self, regions: list[Region], epochs: int = 12, rate: float = 0.5, decay: float = 1e-4,
            seed: int = 7) -> SemiCrf:
        """AdaGrad on the log-likelihood of the labelled segmentations."""
        rng, seen = random.Random(seed), {}
        order = list(regions)
        for _ in range(epochs):
            rng.shuffle(order)
            for region in order:
                scores = self._scores(region)
                ahead, behind = self._sums(region, scores)
                gold = set(region.gold)
                slope: dict[str, float] = {}
                for j, ending in enumerate(region.ending, 1):
                    for (i, t, feats), s in zip(ending, scores[j - 1], strict=True):
                        p = math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[-1]))
                        g = ((i, j, t) in gold) - p
                        if abs(g) > 1e-6:
                            for f in feats:
                                slope[f] = slope.get(f, 0.0) + g
                for f, g in slope.items():
                    g -= decay * self.weights.get(f, 0.0)
                    seen[f] = seen.get(f, 1e-6) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + rate * g / math.sqrt(seen[f])
        return self


def label(region: Region, spans: list[tuple[str, int, int]]) -> Region | None:
    """The region with its labelled segmentation; None if the labels do not fit its segments."""
    first = {a: i for i, (a, _) in enumerate(region.tokens)}
    last = {b: j for j, (_, b) in enumerate(region.tokens, 1)}
    gold, taken = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        i, j, t = first.get(s), last.get(e), TYPES.index(kind)
        if i is None or j is None or i < taken:
            continue
        if not any(x[0] == i and x[1] == t for x in region.ending[j - 1]):
            return None
        gold += [(k, k + 1, 0) for k in range(taken, i)] + [(i, j, t)]
        taken = j
    region.gold = gold + [(k, k + 1, 0) for k in range(taken, len(region.tokens))]
    return region


# --- training data ----------------------------------------------------------

def _card(rng: random.Random, n: int = 16) -> str:
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + d for d in "0123456789" if luhn(body + d))


def _made_up(rng: random.Random) -> tuple[str, str | None]:
    """A made-up string and its kind (None: a look-alike)."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    tld = rng.choice(("com", "org", "net", "de", "fr", "es", "io"))
    card, area = _card(rng, rng.choice((13, 15, 16, 16, 16, 19))), f"{rng.randint(200, 999)}"
    spaced = lambda sep: sep.join(card[i:i + 4] for i in range(0, len(card), 4))
    bad = str((int(card) + 1) % 10 ** len(card)).zfill(len(card))
    octet = [str(rng.randint(0, 255)) for _ in range(4)]
    at, dot = rng.choice((("[at]", "[dot]"), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", " (dot) ")))
    sizes = rng.choices((1, 2, 3, 4, 5, 6), k=rng.randint(2, 5))
    serial = rng.choice("123456789") + rng.choice("-- ./").join(d(n) for n in sizes)  # one digit more in its first group
    if (sizes[0] + 1, *sizes[1:]) in ((3, 4), (3, 3, 4), (1, 3, 3, 4), (4, 4, 4, 4)):
        serial += d(2)
    kind = rng.choices(("email", "ip", "card", "phone", None), (3, 1, 2, 6, 7))[0]
    if kind == "phone":
        return _phone(rng), kind
    return rng.choice({
        "email": (f"{w()}.{d(2)}@{w()}.{tld}", f"{w()}@{w()}.{w()}.{tld}", f"{w()}{at}{w()}{dot}{tld}",
                  f"{w()}.{w()}{at}{w()}.{tld}", f"{w()} dot {w()} at {w()} dot {tld}", f"{w()}.{w()} at {w()} dot {tld}",
                  f"{w()}{d(2)} at {w()} dot {w()} dot {tld}"),
        "ip": (".".join(octet),), "card": (card, spaced(" "), spaced("-")),
        None: (bad, serial, serial, serial, d(rng.randint(7, 20)), d(16), f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}", f"{d(1)}.{d(1)}.{d(2)}.{d(4)}",
               f"300.{d(3)}.{d(2)}.{d(1)}", f"{d(3)} {d(3)} {d(3)}", f"{d(3)}.{d(3)}.{d(3)}",
               f"{rng.randint(1, 999)}{rng.choice(' .')}{d(3)} {d(3)} {d(3)}", f"{rng.randint(1, 99)}.{d(3)}.{d(3)}.{d(3)}",
               f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{w()}@{w()}", f"20{d(2)}-20{d(2)} {d(4)}", f"{d(5)}-{d(4)}",
               f"{w()} [at] {w()}", f"{d(2)}/{d(2)}/20{d(2)} {d(2)}", f"{d(2)}.{d(2)}.20{d(2)}", f"20{d(2)}.{d(2)}.{d(2)}",
               f"20{d(2)} 20{d(2)} 20{d(2)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(8)}-{d(4)}-{d(4)}", f"{d(4)}.{d(2)}.{d(2)}.{d(3)}",
               f"{d(2)}.{d(5)} {d(1)}.{d(5)}", f"{d(2)}-{d(7)}", f"{d(6)} {d(6)}",
               f"{rng.choice(sorted(_PROSE_LEFT))} at {rng.choice(sorted(_PROSE_RIGHT))} dot {rng.choice((tld, w()))}",
               f"{w()} at {rng.choice(sorted(_PROSE_RIGHT))} dot {w()}"),
    }[kind]), kind


def _phone(rng: random.Random) -> str:
    """International, with an access code, with a trunk zero, or in three parts; not every form there is."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    area, country, sep = str(rng.randint(200, 999)), str(rng.randint(30, 99)), rng.choice(" -")
    groups = lambda sizes, by: by.join(d(n) for n in sizes)
    rest = rng.choice(((3, 7), (3, 3, 4), (2, 8), (4, 6), (1, 2, 2, 2, 2)))
    return rng.choice((
        f"+1 ({area}) {d(3)}-{d(4)}", f"+{country} {d(3)} {d(7)}", f"+{d(11)}", f"+{country} {groups(rest, ' ')}",
        f"00{country}{sep}{groups(rest, sep)}", f"00{country}.{groups((3, 3, 4), '.')}",
        "0" + groups(rng.choice(((3, 6), (4, 6), (3, 3, 4), (3, 3, 3), (3, 7), (2, 8),
                                            (1, 2, 2, 2, 2))), rng.choice(" -.")),
        f"0{d(1)}{sep}{groups(rng.choice(((8,), (4, 4), (3, 2, 3), (2, 2, 4))), sep)}",
        f"(0{d(3)}) {groups(rng.choice(((6,), (3, 3), (7,))), ' ')}",
        f"({area}) {d(3)}-{d(4)}", f"({area}) 555-{d(4)}", f"({area}) {d(3)} {d(4)}", f"({area}) {d(3)}.{d(4)}",
        f"{area}-{d(3)}-{d(4)}", f"{area} {d(3)}-{d(4)}", f"1-{area}-{d(3)}-{d(4)}", f"1.{area}.{d(3)}.{d(4)}"))


def sample_regions(texts: list[str], first: SemiCrf) -> list[Region]:
    """Regions of the sample, labelled by the base patterns, but for those in which ``first`` sees more."""
    out = []
    for text in texts:
        base = base_spans(text)
        for s, e in region_spans(text):
            inside = [x for x in base if s <= x[1] and x[2] <= e]
            region = build_region(text, s, e)
            more = [(i, j) for i, j, *_ in first.best(region) if not any(
                x[1] < region.tokens[j - 1][1] and region.tokens[i][0] < x[2] for x in base)]
            if not more and (got := label(region, inside)) is not None:
                out.append(got)
    return out


#: Features that name one form (left out of half of the made-up regions).
FINE = ("phone|shape:", "phone|lead:0|groups:", "phone|lead:+|groups:", "phone|lead:|groups:", "phone|last:")


def _blurred(region: Region) -> Region:
    region.ending = [[(i, t, [f for f in feats if not f.startswith(FINE)]) for i, t, feats in found]
                     for found in region.ending]
    return region


def training_regions(texts: list[str], made: int = 2400, seed: int = 11) -> list[Region]:
    """Made-up regions, set into words of the sample."""
    rng, out = random.Random(seed), []
    words = [w for t in texts for w in t[:2000].split() if w.isalpha()][:20_000] or ["the", "of", "and"]
    cues = {"phone": ("call", "tel", "phone"), "card": ("card", "visa"), "email": ("mail", "contact"),
            "ip": ("host", "server"), None: ("order", "ref", "version")}
    for _ in range(made):
        string, kind = _made_up(rng)
        before = [rng.choice(words) for _ in range(3)]
        if rng.random() < 0.3:
            before[-1] = rng.choice(cues[kind]) + rng.choice(("", ":"))
        head = " ".join(before) + " "
        text = f"{head}{string}{rng.choice(('', '.', ','))} {rng.choice(words)}"
        spans = [] if kind is None else [(kind, len(head), len(head) + len(string))]
        for s, e in region_spans(text):
            inside = [x for x in spans if s <= x[1] and x[2] <= e]
            if (got := label(build_region(text, s, e), inside)) is not None:
                out.append(_blurred(got) if rng.random() < 0.5 else got)
    return out


def train(documents: DataFrame, sample_docs: int = 300, sample_chars: int = 20_000, made: int = 2400) -> SemiCrf:
    """Fit on a sample of at most ``sample_docs`` documents of at most ``sample_chars`` characters."""
    ids = [r[0] for r in documents.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).collect()]
    rows = documents.where(F.col("doc_id").isin(ids) & (F.length("text") <= sample_chars)).select("doc_id", "text")
    texts = [r[1] for r in sorted(rows.dropDuplicates(["doc_id"]).collect())] if ids else []
    made_up = training_regions(texts, made)
    return SemiCrf().fit(made_up + sample_regions(texts, SemiCrf().fit(made_up)))


# --- detection ----------------------------------------------------------------

def find_spans(text: str | None, model: SemiCrf, min_probability: float = 0.9) -> tuple[list, list]:
    """(base spans, added spans), each by kind as listed, then start."""
    text = text or ""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    added = []
    for s, e in region_spans(text):
        if any(a <= s and e <= b for a, b in taken):
            continue
        region = build_region(text, s, e)
        for i, j, t, p in model.best(region):
            a, b = region.tokens[i][0], region.tokens[j - 1][1]
            if p >= min_probability and not any(x < b and a < y for x, y in taken):
                added.append((TYPES[t], a, b))
    added.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
    return base, added


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))


def detect(documents: DataFrame, model: SemiCrf, min_probability: float = 0.9) -> DataFrame:
    """The input with ``pii_spans`` (kind, start, end, base) by kind as listed, then start."""
    weights = documents.sparkSession.sparkContext.broadcast(model.weights)

    @F.pandas_udf(SPAN)
    def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        crf = SemiCrf(weights.value)
        for batch in texts:
            out = []
            for t in batch:
                base, added = find_spans(t, crf, min_probability)
                both = [(*x, True) for x in base] + [(*x, False) for x in added]
                both.sort(key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
                out.append([{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in both])
            yield pd.Series(out)
    return documents.withColumn("pii_spans", spans("text"))


def digest(documents: DataFrame, model: SemiCrf | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_added."""
    model = model or train(documents)
    found = detect(documents.select("doc_id", "text"), model).select("doc_id", "pii_spans")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("pii_spans", lambda x: x["base"])
    count = lambda k: F.size(F.filter("pii_spans", lambda x: x["base"] & (x["kind"] == k))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii_spans")).alias("spans"),
                        F.size(F.filter("pii_spans", lambda x: ~x["base"])).cast("long").alias("n_added"))
