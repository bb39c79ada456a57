"""Secret scans: patterns plus a token-efficiency test.

Base kinds are found by pattern: ``assign`` (a password-like name given a
value), ``access`` (access key ids) and ``hex`` (long hexadecimal runs). The
method adds kind ``random``: a run of 20 or more characters of the base64 and
URL-safe alphabets whose characters per token, under a public byte-pair
vocabulary, are fewer than ``max_ratio``. Words of a language are cheap to
spell for the vocabulary (three or more characters a token); random strings
are not. Known digests (hexadecimal of the usual lengths), UUIDs, plain
numbers and names (words of letters, each of one case or in camel case and
under 20 letters, joined by separators) are identifiers rather than secrets
and are excluded first; so are runs that touch a base span. A run of letters
alone is measured like any other.

Offsets are code points, ends exclusive. Runs of any length are measured
whole, in pieces that the tokenizer handles in linear time.

Defined results: a NULL or empty text has no spans. Repeated rows each get a
row. An empty table gives an empty result. Only the named columns are read.

Python runs in Arrow batches inside map tasks; there is no shuffle.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import whole_row, with_text

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's text is cut before merging (fixed by the vocabulary).
VOCABULARY_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
                      r"""|\s+(?!\S)|\s+""")

#: Base kinds in their listed order (fixed by the query's contract).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

#: The same matches without visiting each short run.
_ACCESS_LONG = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_HEX_ONLY = re.compile(r"(?:0x)?[0-9a-fA-F]+")
_NUMBER = re.compile(r"[0-9+/_=-]+")
_SEPARATORS = re.compile(r"[+/_=-]+")
#: A word of a name: of one case or in camel case.
_WORD = re.compile(r"[a-z]|[A-Z]*(?:[a-z]{2,}[A-Z]+)*(?:[a-z]{2,})?")
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
PIECE = 256
MAX_RATIO = 2.0


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("vocabulary", pat_str=VOCABULARY_PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def n_tokens(run: str, path: str = VOCABULARY) -> int:
    encode = _encoding(path).encode_ordinary
    return sum(len(encode(run[i:i + PIECE])) for i in range(0, len(run), PIECE))


def _word_tokens(word: str, path: str) -> int:
    """Tokens of a word of a name: as it stands, in lower case or after a space, whichever is least."""
    return min(n_tokens(w, path) for w in (word, word.lower(), " " + word, " " + word.lower()))


def is_identifier(run: str, max_ratio: float = MAX_RATIO, path: str = VOCABULARY) -> bool:
    """Digests, UUIDs, numbers and plain names: never reported by the method."""
    if _UUID.fullmatch(run) or _NUMBER.fullmatch(run):
        return True
    if _HEX_ONLY.fullmatch(run):
        return len(run.removeprefix("0x")) in DIGEST_LENGTHS
    # The vocabulary spends a token on each separator, so joined words are measured without them.
    words = [w for w in _SEPARATORS.split(run) if w]
    return (len(words) > 1 and all(len(w) < 20 and _WORD.fullmatch(w) for w in words)
            and sum(map(len, words)) >= max_ratio * sum(_word_tokens(w, path) for w in words))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS_LONG.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX_LONG.finditer(text)]
    return out


def random_spans(text: str, base: list, max_ratio: float, path: str) -> list[tuple[str, int, int]]:
    out = []
    taken = sorted(base, key=lambda x: x[1])
    at, reach = 0, 0   # spans that start before the run's end, and how far they go
    for m in _RUN.finditer(text):
        s, e = m.span()
        while at < len(taken) and taken[at][1] < e:
            reach = max(reach, taken[at][2])
            at += 1
        if reach > s:
            continue
        run = m[0].strip("=/-_+")
        if len(run) < 20 or is_identifier(run, max_ratio, path):
            continue
        if len(run) < max_ratio * n_tokens(run, path):
            start = s + m[0].index(run)
            out.append(("random", start, start + len(run)))
    return out


def find_spans(text: str | None, max_ratio: float = MAX_RATIO, path: str = VOCABULARY) -> list:
    """(kind, start, end) by start, then kind as listed."""
    text = text or ""
    base = base_spans(text)
    spans = base + random_spans(text, base, max_ratio, path)
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redacted(text: str, spans: list, mark: str = "[SECRET]") -> str:
    """The text with every maximal run of covered characters replaced."""
    out, at = [], 0
    merged: list[list[int]] = []
    for _, s, e in spans:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                 T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType())]))


def scan(documents: DataFrame, column: str = "text", max_ratio: float = MAX_RATIO,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """The input with ``secret_spans`` (array of kind, start, end) added."""
    @F.pandas_udf(SPAN)
    def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([[{"kind": k, "start": s, "end": e}
                              for k, s, e in find_spans(t, max_ratio, vocabulary)] for t in batch])
    return documents.withColumn("secret_spans", spans(F.col(column)))


def redact(documents: DataFrame, max_ratio: float = MAX_RATIO, vocabulary: str = VOCABULARY) -> DataFrame:
    """Documents with every secret replaced by a mark; all rows stay."""
    @F.pandas_udf("string")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if t is None else redacted(t, find_spans(t, max_ratio, vocabulary))
                             for t in batch], dtype=object)
    rows = documents.select(whole_row(documents).alias("doc"), clean("text").alias("clean"))
    return rows.select(with_text(documents, F.col("doc"), F.col("clean")).alias("doc")).select("doc.*")


def digest(documents: DataFrame, max_ratio: float = MAX_RATIO, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_random."""
    found = scan(documents.select("doc_id", "text"), "text", max_ratio, vocabulary).select("doc_id", "secret_spans")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("secret_spans", lambda x: x["kind"] != "random")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("secret_spans")).alias("spans"))
