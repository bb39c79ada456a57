"""Training-data pipeline over ``documents``: five stages, each one operator.

Every stage works on all rows that its predecessor kept. Its result is
written to the shared folder and read back as the next stage's input, so a
lost executor costs one stage at most.

1. quality rules: rejected documents go, lines above the limits are cut out
2. SimHash near-dedup: the document with the least id of each group stays
3. benchmark decontamination: documents that hold a benchmark item go
4. secret scans: secrets are replaced by a mark, all documents stay
5. SentencePiece: ids are added, decoded again and compared with the text

All but the last return the columns of ``documents``; the last adds ``ids``,
``n_ids`` and ``round_trip``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontam, quality, secret_scan, sentencepiece_codec, simhash
from touchline.llm.common import read_table, share_package, whole_row, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: XXH64 fingerprints, a token vocabulary and piece merges have no SQL form.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    return simhash.first_of_groups(docs, shingle=3, max_bits=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    return secret_scan.redact(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    both = docs.select(whole_row(docs).alias("doc"), sentencepiece_codec.encode_and_decode("text").alias("both"))
    added = [F.col("both.ids").alias("ids"), F.size("both.ids").cast("long").alias("n_ids"),
             (F.col("both.decoded") == F.coalesce("doc.text", F.lit(""))).alias("round_trip")]
    own = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in ("ids", "n_ids", "round_trip")]
    return both.select(*own, *added)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
