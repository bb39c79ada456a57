"""Quality rules: counts within a document and line frequency across documents.

Base rules count words, symbols, repeated lines and repeated 3-word windows
of each whole text. The method then hashes every normalised line (ASCII lower
case, runs of white space as one space), counts in how many distinct
documents of the same host (``source``) it occurs, removes lines above the
limits, and rejects documents that lose too much.

Limits: a line is removed if it occurs in more than ``max_docs`` distinct
documents of its host and either in more than ``max_share`` of them or in more
than ``always`` of them, so the limit stops rising with the host. A document is
depleted, and so rejected, if removal takes more than ``max_lost`` of its
words or leaves fewer than ``min_left`` of a text that lost any.

Exact copies count as one document (they are the business of the
near-duplicate operators): the key of a document is its content digest.

Defined results: a NULL text is an empty text and fails the base rules. A
NULL source is a host of its own. Repeated rows each get the same row. An
empty table gives an empty result. Only doc_id, source and text are read.

All of it is DataFrame expressions. Lines are reduced to one row per (host,
content, line) with a map-side partial aggregate, so copies and hot hosts
collapse before the shuffle; the frequent-line join and the final join are
equi-joins that Spark may split by skew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import (
    SPACE_CLASS, SPACES, ascii_lower, text_digest, whole_row, with_text, words_of, written,
)

#: Characters counted as symbols (fixed by the query's contract).
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class LineLimits:
    max_docs: int = 20
    max_share: float = 0.02
    always: int = 1000
    max_lost: float = 0.7
    min_left: int = 20


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated one time only."""
    return F.get(F.transform(F.array(value), use), 0)


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    Windows are sorted by hash, so equal ones are neighbours.
    """
    def count(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        same = lambda k, j: F.coalesce(F.get(ordered, k)["h"] == F.get(ordered, j)["h"], F.lit(False))
        hits = F.filter(F.sequence(F.lit(0), last), lambda k: (
            ((k > 0) & same(k, k - 1)) | ((k < last) & same(k, k + 1))))
        starts = F.transform(hits, lambda k: F.get(ordered, k)["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda s: F.array(s, s + 1, s + 2)))))

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
        _once(F.sort_array(placed), count))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array."""
    n = F.size(words)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    return F.when(n < 4, 0).otherwise(
        _once(F.transform(F.sequence(F.lit(0), n - 3), window), _covered)).cast("long")


def base_counts(documents: DataFrame) -> DataFrame:
    """doc_id, source, content key and the contract's counts, one row per input row."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    got = documents.select(
        "doc_id", "source", text_digest(text).alias("content"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _once(words_of(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"))).alias("w"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (got.select("doc_id", "source", "content", "w.n_words", "w.word_chars", "n_symbols",
                       "n_dup_lines", "w.n_repeat_words")
            .withColumn("base_failed", failed))


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(line), SPACE_CLASS, " "))


def document_lines(documents: DataFrame) -> DataFrame:
    """source, content, line (hash), n_words: one row per distinct line of a content."""
    text = F.coalesce("text", F.lit(""))
    return (documents.select("source", text_digest(text).alias("content"),
                             F.explode(F.split(text, "\n", -1)).alias("raw"))
            .select("source", "content", normalised(F.col("raw")).alias("norm"))
            .where(F.col("norm") != "")
            .groupBy("source", "content", F.xxhash64("norm").alias("line"))
            .agg(F.sum(F.size(F.split("norm", " "))).alias("n_words")))


def removed_lines(documents: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """source, content, line, n_words (of all its occurrences): lines above the limits."""
    copies = documents.groupBy("source", text_digest(F.col("text")).alias("content")).agg(
        F.count(F.lit(1)).alias("n_copies"))
    hosts = copies.groupBy("source").agg(F.count(F.lit(1)).alias("host_docs"))
    lines = written(document_lines(documents), "lines")
    counted = lines.groupBy("source", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    often = (counted.where(F.col("n_docs") > limits.max_docs)
             .join(hosts, counted["source"].eqNullSafe(hosts["source"]))
             .where((F.col("n_docs") > limits.max_share * F.col("host_docs")) | (F.col("n_docs") > limits.always))
             .select(counted["source"].alias("f_source"), F.col("line").alias("f_line")))
    kept = lines.join(often, lines["source"].eqNullSafe(F.col("f_source"))
                      & (lines["line"] == F.col("f_line")))
    out = kept.select(lines["source"], "content", "line", "n_words")
    # All copies of a content were summed together: one copy's share.
    out = (out.join(copies.withColumnsRenamed({"source": "c_source", "content": "c_content"}),
                    out["source"].eqNullSafe(F.col("c_source")) & (out["content"] == F.col("c_content")))
           .select("source", "content", "line", (F.col("n_words") / F.col("n_copies")).cast("long").alias("n_words")))
    return out


def judge(documents: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Base counts plus n_removed_words, kept; one row per input row."""
    base = base_counts(documents)
    lost = (removed_lines(documents, limits).groupBy("source", "content")
            .agg(F.sum("n_words").alias("n_removed_words"))
            .withColumnsRenamed({"source": "l_source", "content": "l_content"}))
    both = base.join(lost, base["source"].eqNullSafe(F.col("l_source"))
                     & (base["content"] == F.col("l_content")), "left")
    removed = F.coalesce("n_removed_words", F.lit(0)).cast("long")
    depleted = (removed > 0) & ((removed > limits.max_lost * F.col("n_words"))
                                | (F.col("n_words") - removed < limits.min_left))
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", removed.alias("n_removed_words"),
                       (~F.col("base_failed") & ~depleted).alias("kept"))


def kept_documents(documents: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Documents that pass, without their removed lines; the input's columns.

    ``n_chars`` is set anew where a column of that name exists.
    """
    gone = (removed_lines(documents, limits).groupBy("source", "content")
            .agg(F.collect_set("line").alias("gone"), F.sum("n_words").alias("lost"))
            .withColumnsRenamed({"source": "l_source", "content": "l_content"}))
    own = documents.select(whole_row(documents).alias("doc"), F.col("source").alias("d_source"),
                           text_digest(F.col("text")).alias("d_content"))
    both = own.join(gone, F.col("d_source").eqNullSafe(F.col("l_source"))
                    & (F.col("d_content") == F.col("l_content")), "left")
    text = F.coalesce("doc.text", F.lit(""))
    removed = F.coalesce("lost", F.lit(0))
    fails = _once(words_of(text), lambda w: (
        (F.size(w) < 50) | (100 * _repeat_words(w) > 50 * F.size(w))
        | ((removed > 0) & ((removed > limits.max_lost * F.size(w)) | (F.size(w) - removed < limits.min_left)))))
    left = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(F.array_join(F.filter(
        F.split(text, "\n", -1), lambda x: ~F.array_contains("gone", F.xxhash64(normalised(x)))), "\n"))
    return both.where(~fails).select(with_text(documents, F.col("doc"), left).alias("doc")).select("doc.*")
