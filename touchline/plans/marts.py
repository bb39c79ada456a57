"""Precomputed report tables (M1-M5).

The reference answers slow dashboards with materialized views that are not
in its code. The Spark equivalent is a mart table per report, written with
``saveAsTable`` (or as plain Parquet) after each load; the marts that hold a
season are partitioned by it and refreshed one season at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators import reports
from touchline.sources.warehouse import replace_partition, save_counted

MARTS = {
    "mart_standings": lambda star: reports.standings(star, per_league=True),
    "mart_top_scorers": reports.top_scorers,
    "mart_home_away": reports.home_away,
    "mart_consistent_players": reports.consistent_players,
    "mart_impactful_players": reports.impactful_players,
    "mart_best_goalkeepers": reports.best_goalkeepers,
    "mart_aggressive_teams": reports.aggressive_teams,
}


def match_results_mart(star) -> DataFrame:
    """M4: every fixture with both team names and the score.

    The home and away goals come from the two fact_team rows of a fixture,
    pivoted per fixture (groups of two rows), not from a self-join.
    """
    f = star.dim_fixtures.select("Fixture_ID", "Season_ID", "League_ID", "Match_Date",
                                 "Home_Team_ID", "Away_Team_ID")
    ft = star.fact_team.select("Fixture_ID", "Team_ID", "Goals_Scored")
    j = ft.join(f, "Fixture_ID")
    score = j.groupBy("Fixture_ID").agg(
        F.max(F.when(F.col("Team_ID") == F.col("Home_Team_ID"), F.col("Goals_Scored"))).alias("Home_Goals"),
        F.max(F.when(F.col("Team_ID") == F.col("Away_Team_ID"), F.col("Goals_Scored"))).alias("Away_Goals"))
    home = star.dim_teams.select(F.col("Team_ID").alias("Home_Team_ID"),
                                 F.col("Team_Name").alias("Home_Team"))
    away = star.dim_teams.select(F.col("Team_ID").alias("Away_Team_ID"),
                                 F.col("Team_Name").alias("Away_Team"))
    out = f.join(score, "Fixture_ID").join(home, "Home_Team_ID", "left").join(away, "Away_Team_ID", "left")
    result = (F.when(F.col("Home_Goals") > F.col("Away_Goals"), "H")
              .when(F.col("Home_Goals") < F.col("Away_Goals"), "A")
              .when(F.col("Home_Goals") == F.col("Away_Goals"), "D"))
    return out.select("Fixture_ID", "Season_ID", "League_ID", "Match_Date", "Home_Team", "Away_Team",
                      "Home_Goals", "Away_Goals", result.alias("Result"))


ALL_MARTS = {**MARTS, "mart_match_results": match_results_mart}
#: Marts with a Season_ID, which can be refreshed one season at a time.
SEASON_MARTS = ("mart_standings", "mart_home_away", "mart_match_results")


def write_marts(star, root: str, mode: str = "overwrite") -> dict[str, str]:
    """M1: materialize every report as a Parquet table under ``root``."""
    paths = {}
    for name, build in ALL_MARTS.items():
        path = f"{root.rstrip('/')}/{name}"
        build(star).write.mode(mode).parquet(path)
        paths[name] = path
    return paths


def _season_last(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "Season_ID"], F.col("Season_ID").cast("int").alias("Season_ID"))


def save_marts(star, database: str, root: str) -> dict[str, int]:
    """M1 as catalog tables, season marts partitioned by season; rows per mart."""
    star.dim_seasons.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/{database}.db'")
    rows = {}
    for name, build in ALL_MARTS.items():
        by_season = name in SEASON_MARTS
        df = _season_last(build(star)) if by_season else build(star)
        rows[name] = save_counted(df, f"{database}.{name}", f"{root.rstrip('/')}/{name}",
                                  "Season_ID" if by_season else None)
    return rows


def refresh_season(star, database: str, season_id: int, root: str | None = None) -> None:
    """Replace one season's partition of the season marts; ``star`` holds that season
    (``warehouse.load_star(spark, db, season_id)``). Other seasons are not touched, and
    each mart changes all at once (``replace_partition``). New folders go under ``root``,
    by default next to the mart's own."""
    spark = star.dim_seasons.sparkSession
    for name in SEASON_MARTS:
        table = f"{database}.{name}"
        df = ALL_MARTS[name](star).where(F.col("Season_ID") == season_id).drop("Season_ID")
        own = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
        replace_partition(df, table, "Season_ID", season_id, f"{root.rstrip('/')}/{name}" if root else f"{own}_versions")
