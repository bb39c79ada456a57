"""The whole pipeline against a plain reading of its five stages."""

import random

import pytest
import sentencepiece

import corpus_pipeline
from touchline.llm import decontam, secret_scan, sentencepiece_codec

from .conftest import CLASHING, DOCS
from .test_simhash import plain_fingerprint, plain_groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "ren", "sol") for b in ("k", "p", "ster", "vale", "dor", "m")]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, f"{text(14)}. {text(9)}.") for i in range(6)]
    rows = [(i, f"{text(90)}\nshared line of the house", "big", "en") for i in range(40)]
    rows += [(100 + i, rows[i][1], "big", "en") for i in range(8)]
    rows += [(200, text(60) + " " + items[2][1] + " " + text(30), "x", "en"), (201, text(70) + " token = abcdef99", "x", "en"),
             (202, "short", "x", "en"), (203, None, "x", "en"), (204, "same " * 90, "x", "en"), (None, text(80), None, None)]
    docs = [(d, t, lang, s, None if t is None else len(t)) for d, t, s, lang in rows]
    root = str(tmp_path_factory.mktemp("corpus"))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(docs, DOCS)
    for name in CLASHING:
        if name not in ("ids",):
            df = df.withColumn(name, F.lit(1))
    df.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows, items


def plain_pipeline(rows, items):
    out = []
    lines = {}
    for d, t, s, _ in rows:
        for x in set((t or "").split("\n")):
            lines.setdefault((s, x.strip().lower()), set()).add(t)
    hosts = {s: len({t or "" for _, t, s2, _ in rows if s2 == s}) for _, _, s, _ in rows}
    for d, t, s, _ in rows:
        w = (t or "").split()
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        if len(w) < 50 or 100 * len(covered) > 50 * len(w):
            continue
        bad = {x for x in t.split("\n") if x.strip() and len(lines[s, x.strip().lower()]) > max(20, min(0.02 * hosts[s], 1000))}
        lost = sum(len(x.split()) for x in t.split("\n") if x in bad)
        if lost and (lost > 0.7 * len(w) or len(w) - lost < 20):
            continue
        out.append((d, "\n".join(x for x in t.split("\n") if x not in bad)))
    named = sorted((x for x in out if x[0] is not None))
    group = plain_groups([plain_fingerprint(t) for _, t in named])
    out = [x for i, x in enumerate(named) if group[i] == i] + [x for x in out if x[0] is None]
    index = decontam.Index(items, decontam.Settings())
    out = [x for x in out if not any(" ".join(decontam.words(i)) in " ".join(decontam.words(x[1])) for _, i in items)]
    assert index.ids == [i for i, _ in items]
    out = [(d, secret_scan.redacted(t, secret_scan.find_spans(t))) for d, t in out]
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    return sorted(((d, t, library.encode(t)) for d, t in out), key=str)


def test_run_equals_a_plain_reading(spark, folder):
    root, rows, items = folder
    got = corpus_pipeline.run(spark, root)
    found = sorted(((r.doc_id, r.text, r.ids) for r in got.collect()), key=str)
    assert found == plain_pipeline(rows, items)
    assert 200 not in {d for d, *_ in found} and 201 in {d for d, *_ in found} and 100 not in {d for d, *_ in found}
    assert all(r.round_trip for r in got.collect())


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).columns == docs.columns
        assert stage(spark, docs.limit(0), folder[0]).count() == 0
