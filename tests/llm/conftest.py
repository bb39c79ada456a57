import pytest

from touchline.llm.common import share_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers_see_the_package(spark):
    share_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source]) rows."""
    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit(name))
        return df
    return make


#: Names that the operators use on the way.
CLASHING = ("content", "gone", "lost", "n", "fp", "node", "first_id", "ids", "spans", "blob", "runs", "h", "did",
            "clean", "doc", "n_words", "kept", "component_id", "secret_spans", "pii_spans", "decoded", "row", "digest")

#: NULLs, empty and white-space texts, ties, repeated rows, repeated ids, long texts.
ODD = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, " \t\n "), (4, "same words here"), (5, "same words here"),
       (5, "same words here"), (6, "other " * 3), (7, "x" * 60_000), (8, "long text with words " * 5_000),
       (9, "ünï\u2003cödé \U0001F600 text\x00")]
