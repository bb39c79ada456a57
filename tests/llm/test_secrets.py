import hashlib
import random
import re

from conftest import SF_SMALL
from touchline.llm import secret_scan as S

from .conftest import CLASHING, ODD


def plain(text):
    """The contract's base kinds, written out."""
    out = []
    a = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(a, text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_base_spans_match_the_contract():
    rng = random.Random(1)
    parts = ["password", "PassWord", "token", "api_key", "apikey", "=", ":", " ", '"', "AKIA", "ABCD1234EFGH5678", "deadbeef",
             "0123456789abcdef", "x", "\u017fecret=abcdefgh", "é", "secret", "abcdef", "=="]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        got = sorted(S.base_spans(text), key=lambda x: (x[1], S.KINDS.index(x[0])))
        assert got == plain(text), text


def test_random_strings_are_found_and_identifiers_are_not():
    rng = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    hits = sum(any(k == "random" for k, *_ in S.find_spans("see " + "".join(rng.choices(alphabet, k=40)) + " ok"))
               for _ in range(200))
    assert hits >= 190
    for fine in ("d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000", "12345678901234567890123",
                 "international-organization-2024", "Donaudampfschifffahrtsgesellschaft", "/usr/local/share/python3/site"):
        assert not [x for x in S.find_spans(f"a {fine} b") if x[0] == "random"], fine


def test_letters_alone_are_measured_and_names_are_not():
    rng = random.Random(4)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = lambda run: [x for x in S.find_spans(f"see {run} ok") if x[0] == "random"]
    for alphabet, n, least in ((upper + lower, 20, 195), (upper + lower, 40, 199), (upper, 24, 195), (lower, 32, 185),
                               (upper + lower + "0123456789", 20, 198)):
        runs = ["".join(rng.choices(alphabet, k=n)) for _ in range(200)]
        assert sum(found(x) == [("random", 4, 4 + n)] for x in runs) >= least, (alphabet, n)
    for fine in ("Rindfleischetikettierungsueberwachungsaufgaben", "pneumonoultramicroscopicsilicovolcanoconiosis",
                 "lentokonesuihkuturbiinimoottoriapumekaanikko", "INTERNATIONALIZATION", "GESCHWINDIGKEITSBEGRENZUNG",
                 "IncomprehensibilitiesOfNature", "COPY_DICT_WITHOUT_KEYS", "bernoulli_logit_glm_lupmf",
                 "org/apache/spark/rdd/JdbcRDD", "oboe-lh-low-b-key-stencil"):
        assert not found(fine), fine
    assert found("qXvTzKpWmRjLbNcH/GdYsFqZk") and found("-".join(["key", "xqzvkjwpbtmrnhgcdlsf" * 2]))


def test_grouped_letters_are_measured_without_their_separators():
    rng = random.Random(6)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    for alphabet, groups, size, mark in ((upper, 5, 5, "-"), (lower, 4, 8, "-"), (upper, 2, 16, "/"), (lower, 5, 5, "_")):
        runs = [mark.join("".join(rng.choices(alphabet, k=size)) for _ in range(groups)) for _ in range(200)]
        hits = sum(any(k == "random" for k, *_ in S.find_spans(f"see {x} ok")) for x in runs)
        assert hits >= 180, (alphabet, groups, size)
    for fine in ("the_quick_brown_fox_jumps_over", "MAX-RETRY-COUNT-PER-REQUEST", "src/main/java/org/example/Helper",
                 "state-of-the-art-methods", "--include-untracked-files--"):
        assert not [x for x in S.find_spans(f"a {fine} b") if x[0] == "random"], fine


def test_runs_that_touch_a_base_span_are_left_to_it():
    key = "qXvTzKpWmRjLbNcHGdYsFqZkPt"
    text = " ".join(f"token={key}{i} {key}{i}" for i in range(300))
    spans = S.find_spans(text)
    base = {(s, e) for k, s, e in spans if k == "assign"}
    free = [(s, e) for k, s, e in spans if k == "random"]
    assert len(base) == 300 and len(free) == 300
    assert all(text[s - 1] == " " for s, _ in free)


def test_query_on_real_rows(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in df.collect()}
    for r in S.digest(df).collect():
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in plain(text[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_odd_rows_and_redaction(documents):
    df = documents([*ODD, (20, "my token = abcdef123 end"), (21, "k" * 30_000 + "AKIA" + "A1" * 40_000)], CLASHING)
    got = {r.doc_id: r for r in S.digest(df).collect()}
    assert got[1].n_assign == 0 and got[2].spans == "" and got[20].spans == "assign:3:20"
    clean = S.redact(df)
    assert clean.columns == df.columns and clean.count() == df.count()
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows[20].text == "my [SECRET] end" and rows[20].n_chars == 15 and rows[1].text is None
    assert S.digest(df.limit(0)).count() == 0 and S.redact(df.limit(0)).count() == 0
