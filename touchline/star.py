"""The star schema as a bundle of DataFrames.

Seven dimensions and two facts. Column names follow the warehouse DDL (the
contract); ids are ``long``, counters ``int``, ratios ``double``.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

STAR_TABLES = (
    "dim_seasons", "dim_countries", "dim_leagues", "dim_venues", "dim_teams",
    "dim_players", "dim_fixtures", "fact_player", "fact_team",
)


@dataclass
class Star:
    dim_seasons: DataFrame
    dim_countries: DataFrame
    dim_leagues: DataFrame
    dim_venues: DataFrame
    dim_teams: DataFrame
    dim_players: DataFrame
    dim_fixtures: DataFrame
    fact_player: DataFrame
    fact_team: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]
