"""Ids above 2^53 beside a NULL, in one partition, through every operator and stage: none is rounded."""

import hashlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import (
    decontam, merkle, mixing, pii, prefix_trie, quality, secret_scan, sentencepiece_codec, simhash, substring, suffixarray,
    urlfilter, warc,
)

from .conftest import DOCS

A, B, C = (1 << 60) + 1, (1 << 60) + 3, (1 << 62) + 5
PASSAGE = " ".join(f"word{i}" for i in range(70))
ROWS = [(A, f"start here {PASSAGE} end one"), (B, f"{PASSAGE} other end"), (None, f"{PASSAGE} nobody"), (C, "quite another text")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in ROWS], DOCS).coalesce(1)


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda x: (x is not None, x or 0))


ALL = [None, A, B, C]


def test_substring_and_suffix_array(docs):
    words = {r["doc_id"]: r for r in substring.digest(docs).collect()}
    assert {k: r["n_removed"] for k, r in words.items()} == {A: 0, B: 70, None: 0, C: 0}
    assert words[B]["kept_sha256"] == hashlib.sha256(b"other end").hexdigest()
    assert {r["doc_id"]: r["n_removed"] for r in substring.digest(docs, max_group=1).collect()} == {A: 0, B: 70, None: 0, C: 0}
    spans = {r["doc_id"]: r["n_spans"] for r in suffixarray.digest(docs).collect()}
    assert spans == {A: 1, B: 1, None: 1, C: 0}
    assert ids(substring.remove_repeats(docs)) == ALL and ids(suffixarray.remove_repeats(docs)) == ALL


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(B, PASSAGE), (None, "quite another text")], "item_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()}
    assert got == {(A, B), (B, B), (None, B), (C, None)}
    assert ids(decontam.clean_documents(docs, items)) == []
    assert ids(decontam.clean_documents(docs, items.where("item_id is null"))) == [None, A, B]


def test_warc(spark):
    rows = [(A, "http://a/", "same"), (B, "http://b/", "same"), (None, "http://c/", "same"), (C, None, "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.round_trip(spark, pages).collect()}
    assert got == {A: ("revisit", B, 4), B: ("response", None, 4), None: ("revisit", B, 4), C: ("response", None, 5)}


def test_the_others_keep_every_id(spark, docs):
    for df in (simhash.digest(docs), quality.judge(docs), secret_scan.digest(docs), pii.digest(docs),
               sentencepiece_codec.round_trip(docs), merkle.digest(docs), mixing.digest(docs), secret_scan.redact(docs),
               quality.kept_documents(docs)):
        assert set(ids(df)) <= set(ALL) and {A, B} <= set(ids(df))
    assert ids(simhash.first_of_groups(docs, shingle=3, max_bits=3))[-1] == C
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://x.net/en/").alias("url"), F.col("text").alias("html"))
    assert ids(urlfilter.filter_urls(pages, urlfilter.default_rules(spark)), "page_id") == ALL
    talks = docs.select(F.col("doc_id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), "text")
    assert set(ids(prefix_trie.trie(talks), "conv_id")) == {A, B, C}
