import random
import tracemalloc

import numpy as np
import sentencepiece

from conftest import SF_SMALL
from touchline.llm import sentencepiece_codec as C

from .conftest import CLASHING, ODD


def test_ids_equal_the_library_on_random_texts():
    library, codec, rng = sentencepiece.SentencePieceProcessor(model_file=C.MODEL), C.load_codec(), random.Random(4)
    for letters in ("abcdefghi", " \u2581a", "the in", "的一是日本語 ab", "aaaa", "\U0001F600é \n\t0123", " "):
        for _ in range(60):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 500)))
            ids = codec.encode(text)
            assert ids == library.encode(text)
            assert codec.decode(ids) == text.replace("\u2581", " ")


def test_window_is_bounded_and_committed_early():
    codec, read = C.load_codec(), 0

    def parts():
        nonlocal read
        for _ in range(2000):
            read += 16
            yield "thequickbrownfox"

    seen = widest = 0
    pieces = []
    for piece in codec.boundaries(parts()):
        widest = max(widest, read - seen)   # read and not yet committed
        pieces.append(piece)
        seen += len(piece)
    assert "".join(pieces) == "thequickbrownfox" * 2000 and widest <= 16 * codec.max_len
    ids = np.frombuffer(b"".join(codec.committed("thequickbrownfox" * 2000)), codec.dtype).tolist()
    assert [codec.id[p] for p in pieces] == ids


def test_texts_of_any_length_are_committed_in_blocks_of_flat_memory(monkeypatch):
    codec, peaks = C.load_codec(), []
    library = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    monkeypatch.setattr(C, "SLICE", 1 << 12)
    monkeypatch.setattr(C, "STRETCH", 1 << 14)
    unit = "the quick brown fox, 日本 " * 40 + "\n" + "x1y2z3" * 900 + "  \t"
    list(codec.blocks([unit]))
    for times in (20, 200):
        text = unit * times
        tracemalloc.start()
        n = sum(last for _, last in codec.blocks(iter([text])))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert n == 1
    assert peaks[1] < 1.3 * peaks[0] + 100_000
    found = [block for block, _ in codec.blocks([unit * 20])]
    assert len([b for b in found if b]) > 20
    for text in (unit * 3, "\n" + unit, "x" * 9000, " " * 9000, "a" + " " * 9000 + "b", " \n" * 3000, "\u2581 a" * 3000,
                 "word " * 5000, "x" * 4095 + " y", "x" * 4096, "x" * 4097 + "\n"):
        assert codec.encode(text) == library.encode(text), text[:20]


def test_unigram_finds_the_best_sum():
    rng = random.Random(5)
    pieces = ["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "cab"]
    for _ in range(200):
        scores = [rng.uniform(-5, -1) for _ in pieces]
        codec = C.Codec(pieces, scores, [True] * len(pieces), kind="unigram")
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 60)))
        best = [0.0] + [float("-inf")] * len(text)
        for end in range(1, len(text) + 1):
            best[end] = max(best[end - len(p)] + s for p, s in zip(pieces, scores, strict=True)
                            if text[:end].endswith(p))
        got = list(codec.boundaries(text))
        assert "".join(got) == text
        assert abs(sum(codec.score[p] for p in got) - best[-1]) < 1e-9


def test_query_round_trips(spark, documents):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    text = {r.doc_id: r.text for r in df.collect()}
    for r in C.round_trip(df).collect():
        assert r.round_trip and r.ids == library.encode(text[r.doc_id])
    odd = documents(ODD, CLASHING)
    rows = C.round_trip(odd).collect()
    assert len(rows) == len(ODD) and all(r.round_trip for r in rows)
    assert {len(r.ids) for r in rows if r.doc_id in (1, 2)} == {0}
    assert C.round_trip(odd.limit(0)).count() == 0
    apart = C.decode_documents(C.encode_documents(odd.select("doc_id", "text"))).collect()
    assert all(r.decoded == (r.text or "") for r in apart)
