from touchline.llm import quality as Q

from .conftest import CLASHING, ODD


def good(k, n=80):
    return " ".join(f"word{k}x{j}" for j in range(n))


def test_boilerplate_lines_go_and_depleted_documents_are_rejected(documents):
    line = "Terms  apply to ALL visitors of this site"
    rows = [(i, f"{good(i)}\n{line}", "a") for i in range(60)]
    rows += [(100, "\n".join([line + " really"] + [good(100, 60)]), "a"), (101, (line + "\n") * 40 + good(7, 10), "a"),
             (200, f"{good(200)}\n{line.lower()}", "b"), (300, good(300) + "\nown line", None)]
    df = documents(rows, CLASHING)
    got = {r.doc_id: r for r in Q.judge(df).collect()}
    assert got[0].n_removed_words == 8 and got[0].kept
    assert got[101].n_removed_words == 320 and not got[101].kept
    assert got[200].n_removed_words == 0 and got[200].kept and got[300].kept
    kept = Q.kept_documents(df)
    assert kept.columns == df.columns
    texts = {r.doc_id: r for r in kept.collect()}
    assert texts[0].text == good(0) and texts[0].n_chars == len(good(0)) and 101 not in texts
    assert texts[200].text == rows[62][1]
    assert sorted(texts) == sorted(i for i, r in got.items() if r.kept)


def test_exact_copies_count_once(documents):
    df = documents([(i, good(1), "a") for i in range(80)] + [(100 + i, good(i), "a") for i in range(5)])
    assert all(r.kept and r.n_removed_words == 0 for r in Q.judge(df).collect())


def test_limits_are_exclusive_and_stop_rising_with_the_host(documents):
    df = documents([(i, good(i) + "\nat the limit" * (i < 10) + "\nabove it" * (i < 11), "a") for i in range(100)])
    lost = lambda **k: {r.n_removed_words for r in Q.judge(df, Q.LineLimits(**k)).collect()}
    assert lost(max_docs=10, max_share=0.0) == {0, 2}
    assert lost(max_docs=3, max_share=0.10) == {0, 2}
    assert lost(max_docs=3, max_share=0.50) == {0}
    assert lost(max_docs=3, max_share=0.50, always=10) == {0, 2}
    assert lost(max_docs=3, max_share=0.50, always=9) == {0, 2, 5}


def test_counts_and_odd_rows(documents):
    df = documents([*ODD, (50, "a b c a b c"), (51, "x\n\nx\n \ny#*"), (52, "a a a a")], CLASHING)
    rows = Q.judge(df).collect()
    assert len(rows) == len(ODD) + 3
    got = {r.doc_id: r for r in rows}
    assert got[50].n_repeat_words == 6 and got[52].n_repeat_words == 4
    assert (got[51].n_dup_lines, got[51].n_symbols, got[51].n_words, got[51].word_chars) == (1, 2, 3, 5)
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept
    assert Q.judge(df.limit(0)).count() == 0 and Q.kept_documents(df.limit(0)).count() == 0
