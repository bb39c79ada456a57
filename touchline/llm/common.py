"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_path

#: Words are runs of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of words of a text; NULL counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def text_digest(text: Column) -> Column:
    """128-bit content key of a text (NULL as empty)."""
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that names made on the way cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def with_text(df: DataFrame, row: Column, text: Column) -> Column:
    """The struct with a new ``text`` and, where ``df`` has it, ``n_chars``."""
    row = row.withField("text", text)
    return row.withField("n_chars", F.length(text).cast("long")) if "n_chars" in df.columns else row


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared scratch folder and read it back.

    A lost executor then costs a re-read, not a recomputation, and the
    optimizer sees real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows in an Arrow batch: texts are long, and a worker holds a few batches at once.
BATCH_ROWS = 1000


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package where PYTHONPATH does not name it, and
    keep their batches small where the session has Spark's default."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
