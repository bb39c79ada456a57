import random
import weakref

from conftest import SF_SMALL
from touchline.llm import decontam as D

from .conftest import CLASHING, ODD


def plain_scores(index, items, text, settings):
    """BM25 of every item against every window, without any index."""
    tokens, out = D.words(text), {}
    for p in range(max(1, -(-len(tokens) // index.length))):
        have = set(tokens[p * index.length:(p + 2) * index.length])
        for k, item in enumerate(index.ids):
            score = sum(w for t, i in index.terms.items() if t in have
                        for d, w in zip(index.items[i], index.weights[i], strict=True) if d == k)
            if score >= settings.threshold - 1e-9:
                out[item] = max(out.get(item, 0.0), score)
    return out


def test_search_loses_nothing():
    rng, settings = random.Random(6), D.Settings(overlap=0.0)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) + ". " + " ".join(rng.choices(vocabulary, k=4)))
             for i in range(40)] + [(90, ""), (91, "...")]
    index = D.Index(items, settings)
    for _ in range(60):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 70)))
        got = {i: s for i, s, *_ in index.hits(text)}
        want = plain_scores(index, items, text, settings)
        assert got.keys() == want.keys()
        assert all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_planted_items_are_found_and_others_are_not(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    items = {r.item_id: " ".join(D.words(r.text)) for r in bench.collect()}
    want = {(r.doc_id, i) for r in df.collect() for i, t in items.items() if t in " ".join(D.words(r.text))}
    got = {(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()}
    assert want <= got and want
    by_shards = D.contaminated(df, bench, D.Settings(shard_items=7))
    assert {(r.doc_id, r.item_id) for r in by_shards.collect()} == got
    clean = D.clean_documents(df, bench)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in df.collect()} - {d for d, _ in got}


def test_scores_do_not_depend_on_shards_or_copies(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(80)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(6, 30)))) for i in range(30)]
    docs = [(i, " ".join([*rng.choices(vocabulary, k=9), t, *rng.choices(vocabulary, k=40)])) for i, t in items]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    loose = {"threshold": 0.3, "overlap": 0.0}
    rows = lambda b, **kw: sorted(map(tuple, D.contaminated(df, b, D.Settings(**loose, **kw)).collect()))
    want = rows(bench)
    assert {(i, i) for i, _ in items} < {x[:2] for x in want} and len({x[2] for x in want}) > 30
    assert rows(bench, shard_items=7) == want and rows(bench, shard_chars=500) == want
    copies = bench.unionAll(spark.createDataFrame(items[:1] * 25, bench.schema))
    assert rows(copies) == want and rows(copies, shard_items=7) == want
    sizes = [len(x.ids) for x in D._indexes(*D._dealt(copies, D.Settings(shard_items=7)), D.Settings())]
    assert sum(sizes) == 30 and max(sizes) < 20


def test_one_shard_is_held_at_a_time(spark, documents, monkeypatch):
    live, most = weakref.WeakSet(), []

    build = D.Index.__init__

    def watched(self, *args):
        most.append(len(live))
        live.add(self)
        build(self, *args)

    items = [(i, f"item {i} holds the words a{i} b{i} c{i} d{i} e{i}. and its answer is f{i} g{i}") for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents([*ODD, *[(100 + i, f"before {t} after") for i, t in items[::3]], (100, "clean here"), (70, "clean too")], CLASHING)
    want = {(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()}
    left = sorted(map(str, D.clean_documents(df, bench).collect()))
    monkeypatch.setattr(D.Index, "__init__", watched)
    sharded = D.Settings(shard_items=7)
    assert {(r.doc_id, r.item_id) for r in D.contaminated(df, bench, sharded).collect()} == want
    assert len(want) == 10 and len(most) == 5 and max(most) == 0
    clean = D.clean_documents(df, bench, sharded)
    assert clean.columns == df.columns and sorted(map(str, clean.collect())) == left
    assert len(most) == 10 and max(most) == 0


def test_items_without_an_id_count(spark, documents):
    q = "who was the first to cross the wide northern sea alone? it was a baker from the old town"
    bench = spark.createDataFrame([(None, q), (2**60 + 1, q), (None, "a quite other item of eight words here")],
                                  "item_id long, text string")
    df = documents([*ODD, (60, f"so {q} yes"), (61, "and a quite other item of eight words here then"), (62, "clean one")])
    for settings in (D.Settings(), D.Settings(shard_items=1)):
        got = {(r.doc_id, r.item_id) for r in D.contaminated(df, bench, settings).collect()}
        assert got == {(60, None), (60, 2**60 + 1), (61, None)}
        left = [r.doc_id for r in D.clean_documents(df, bench, settings).collect()]
        assert len(left) == df.count() - 2 and 62 in left and not {60, 61} & set(left)


def test_both_question_and_answer_are_needed(spark, documents):
    bench = spark.createDataFrame([(1, "What is the tallest of all the mountains here? It is the great grey one over there."),
                                   (2, None), (None, "x y z"), (3, "  ")], "item_id long, text string")
    q, a = "what is the tallest of all the mountains here", "it is the great grey one over there"
    df = documents([*ODD, (40, f"so {q} well {a} yes"), (41, f"so {q} well no"), (42, f"{a} only"),
                    (43, "filler " * 5000 + f"{q} {a}" + " filler" * 5000), (40, f"so {q} well {a} yes")], CLASHING)
    got = sorted((r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect())
    assert got == [(40, 1), (43, 1)]
    assert D.contaminated(df.limit(0), bench).count() == 0 and D.contaminated(df, bench.limit(0)).count() == 0
    assert D.clean_documents(df, bench.limit(0)).count() == df.count()
