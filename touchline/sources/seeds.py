"""Seed dimensions from literals.

The rows are literals in the plan, so Spark knows their size and broadcasts
them without a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.schemas import COUNTRY_SEED, SEASON_SEED


def _literal(spark: SparkSession, rows: list[tuple], columns: list[tuple[str, str]]) -> DataFrame:
    made = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns, strict=True)])
                     for row in rows])
    return spark.range(1).select(F.inline(made))


def dim_seasons(spark: SparkSession, seed: Sequence[tuple[int, int]] = SEASON_SEED) -> DataFrame:
    """(Season_ID, Season_Year) from (year, id) pairs."""
    rows = [(i, year) for year, i in seed]
    return _literal(spark, rows, [("Season_ID", "int"), ("Season_Year", "int")])


def dim_countries(spark: SparkSession, seed: Sequence[tuple[str, int]] = COUNTRY_SEED) -> DataFrame:
    """(Country_ID, Country_Name) from (name, id) pairs."""
    rows = [(i, name) for name, i in seed]
    return _literal(spark, rows, [("Country_ID", "int"), ("Country_Name", "string")])
