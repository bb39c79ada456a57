"""Raw envelopes -> star (the batch transform, entry point A).

Takes the four endpoint frames (already validity-filtered), or functions that
give them, and returns a star whose tables are planned on first access. A
report over it therefore asks only for the endpoints it reads; staging the
parsed documents is up to the caller (``sources.envelopes.stage_envelopes``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from touchline.operators import dims, facts
from touchline.sources import seeds
from touchline.star import STAR_TABLES

Source = DataFrame | Callable[[], DataFrame]


class EnvelopeStar:
    """The nine star tables over envelopes, each built when it is first used."""

    def __init__(self, fixtures: Source, teams: Source, players: Source, stats: Source,
                 seasons: DataFrame, countries: DataFrame, strict: bool, league_source: str):
        self._sources = {"fixtures": fixtures, "teams": teams, "players": players, "stats": stats}
        self.dim_seasons, self.dim_countries = seasons, countries
        self._strict, self._league_source = strict, league_source

    def _env(self, name: str) -> DataFrame:
        source = self._sources[name]
        if not isinstance(source, DataFrame):
            source = self._sources[name] = source()
        return source

    @cached_property
    def _work(self) -> DataFrame:
        return dims.fixtures_work(self._env("fixtures"), self.dim_seasons)

    @cached_property
    def dim_leagues(self) -> DataFrame:
        return dims.build_dim_leagues(self._env("fixtures"), self.dim_countries)

    @cached_property
    def dim_venues(self) -> DataFrame:
        return dims.build_dim_venues(self._env("teams"), self.dim_countries)

    @cached_property
    def dim_teams(self) -> DataFrame:
        leagues = self.dim_leagues if self._league_source == "country" else None
        fixtures = self._work if self._league_source == "fixtures" else None
        return dims.build_dim_teams(self._env("teams"), self.dim_countries, leagues, self._league_source, fixtures)

    @cached_property
    def dim_players(self) -> DataFrame:
        return dims.build_dim_players(self._env("players"))

    @cached_property
    def dim_fixtures(self) -> DataFrame:
        return dims.build_dim_fixtures(self._work)

    @cached_property
    def fact_player(self) -> DataFrame:
        return facts.build_fact_player(self._env("players"))

    @cached_property
    def fact_team(self) -> DataFrame:
        return facts.build_fact_team(self._env("stats"), self._work, self._strict)

    def items(self):
        return [(name, getattr(self, name)) for name in STAR_TABLES]


def transform_envelopes(spark: SparkSession, fixtures_env: Source, teams_env: Source,
                        players_env: Source, stats_env: Source, *,
                        seasons: DataFrame | None = None, countries: DataFrame | None = None,
                        strict: bool = True, league_source: str = "parameters") -> EnvelopeStar:
    return EnvelopeStar(
        fixtures_env, teams_env, players_env, stats_env,
        seasons if seasons is not None else seeds.dim_seasons(spark),
        countries if countries is not None else seeds.dim_countries(spark), strict, league_source)
