"""Queries over the JSON path: proxy envelopes -> parse -> validate -> star."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import dims, facts, reports
from touchline.operators.flatten import fixture_param
from touchline.plans.proxy import ProxyStar
from touchline.plans.proxy_envelopes import ProxyEnvelopes
from touchline.plans.transform import transform_envelopes
from touchline.schemas import (CORRUPT_COLUMN, ENDPOINT_FIXTURES, ENDPOINT_PLAYERS, ENDPOINT_STATISTICS,
                               ENDPOINT_TEAMS)
from touchline.session import scratch_path
from touchline.sources import seeds
from touchline.sources.envelopes import read_envelopes, split_valid, stage_envelopes


class JsonProxy:
    """Endpoints are landed and staged on first use only."""

    def __init__(self, spark: SparkSession, sf_dir: str, defects: bool = False):
        self.spark = spark
        self.proxy = ProxyStar(spark, sf_dir)
        self.docs = ProxyEnvelopes(self.proxy, defects)
        self._staged: dict[str, DataFrame] = {}

    @cached_property
    def landing(self) -> str:
        return scratch_path(self.spark, "landing")

    def staged(self, endpoint: str) -> DataFrame:
        """Documents landed as JSON-lines files, read by the JSON scan (S1) and staged
        as Parquet: one parse per document; later reads prune nested columns."""
        if endpoint not in self._staged:
            landed = self.docs.land(endpoint, self.landing)
            path = f"{self.landing}/staged_{endpoint.replace('/', '_')}"
            parsed = read_envelopes(self.spark, landed, endpoint, glob=None, multiline=False)
            stage_envelopes(parsed, endpoint, path)
            schema = parsed.schema.add("_reason", "string").add("_status", "string")
            self._staged[endpoint] = self.spark.read.schema(schema).parquet(path)
        return self._staged[endpoint]

    def valid(self, endpoint: str) -> DataFrame:
        return self.staged(endpoint).where(F.col("_status") == "valid").drop("_reason", "_status", CORRUPT_COLUMN)

    def quarantine(self, endpoint: str) -> DataFrame:
        return self.staged(endpoint).where(F.col("_status") == "quarantine").drop("_status")

    @property
    def seasons(self) -> DataFrame:
        return self.proxy.dim_seasons

    @property
    def countries(self) -> DataFrame:
        return self.proxy.dim_countries

    @cached_property
    def leagues(self) -> DataFrame:
        return dims.build_dim_leagues(self.valid(ENDPOINT_FIXTURES), self.countries)

    @cached_property
    def fixtures_work(self) -> DataFrame:
        return dims.fixtures_work(self.valid(ENDPOINT_FIXTURES), self.seasons)

    def star(self, **options):
        """The transform over lazily landed endpoints: a report lands only what it reads."""
        return transform_envelopes(
            self.spark, lambda: self.valid(ENDPOINT_FIXTURES), lambda: self.valid(ENDPOINT_TEAMS),
            lambda: self.valid(ENDPOINT_PLAYERS), lambda: self.valid(ENDPOINT_STATISTICS),
            seasons=self.seasons, countries=self.countries, **options)


def _j(s, d, defects: bool = False) -> JsonProxy:
    return JsonProxy(s, d, defects)


def fixtures_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures against seeded seasons that cover only some of the years."""
    seasons = seeds.dim_seasons(spark, [(1995, 1), (1996, 2), (1997, 3)])
    return dims.build_dim_fixtures(dims.fixtures_work(_j(spark, sf_dir).valid(ENDPOINT_FIXTURES), seasons)).select(
        "Fixture_ID", "Season_ID", "Home_Team_ID", "Away_Team_ID")


def venues_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues against seeded countries that miss some of them."""
    countries = seeds.dim_countries(spark, [("ASIA", 11), ("EUROPE", 12)])
    return dims.build_dim_venues(_j(spark, sf_dir).valid(ENDPOINT_TEAMS), countries)


def multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 in its own form: one indented document over many lines per file.

    One document per nation, so there are as many files as nations.
    """
    proxy = ProxyStar(spark, sf_dir)
    path = scratch_path(spark, "multiline")
    nations = proxy.t.nation.select("n_nationkey", "n_name")
    docs = nations.select(F.col("n_nationkey").alias("n"), F.to_json(F.struct(
        F.lit(ENDPOINT_TEAMS).alias("get"),
        F.struct(F.col("n_nationkey").cast("string").alias("league"), F.col("n_name").alias("season")).alias("parameters"),
        F.array(F.struct(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")).alias("team")))
        .alias("response")), {"pretty": "true"}).alias("doc"))
    docs.write.partitionBy("n").option("lineSep", "\n").text(path)
    parsed = read_envelopes(spark, path, ENDPOINT_TEAMS, glob="*.txt", recursive=True)
    valid, _ = split_valid(parsed, ENDPOINT_TEAMS)
    return valid.select(F.col("parameters.league").alias("League"), F.explode("response.team").alias("t")).select(
        "League", F.col("t.id").alias("Team_ID"), F.col("t.name").alias("Team_Name"))


#: Queries over clean documents: name -> function of a ``JsonProxy``.
JSON_VIEWS = {
    "flatten_team_stats": lambda j: facts.team_statistics(j.valid(ENDPOINT_STATISTICS)),
    "flatten_team_stats_lenient": lambda j: facts.team_statistics(j.valid(ENDPOINT_STATISTICS), strict=False),
    "flatten_player_stats": lambda j: facts.build_fact_player(j.valid(ENDPOINT_PLAYERS)).drop("Player_Stat_ID"),
    "dim_leagues": lambda j: j.leagues,
    "dim_venues": lambda j: dims.build_dim_venues(j.valid(ENDPOINT_TEAMS), j.countries),
    "dim_teams": lambda j: dims.build_dim_teams(j.valid(ENDPOINT_TEAMS), j.countries),
    "dim_teams_fanout": lambda j: dims.build_dim_teams(
        j.valid(ENDPOINT_TEAMS), j.countries, j.leagues, league_source="country"),
    "dim_players_latest": lambda j: dims.build_dim_players(j.valid(ENDPOINT_PLAYERS)),
    "fixtures_enriched": lambda j: j.fixtures_work,
    "fact_team_from_fixtures": lambda j: facts.build_fact_team(
        j.valid(ENDPOINT_STATISTICS), j.fixtures_work).drop("Team_Stat_ID"),
    "json_star_standings": lambda j: reports.standings(j.star(), per_league=True),
    "standings_fanout": lambda j: reports.standings(j.star(league_source="country"), per_league=True, fanout=True),
    "home_away_fanout": lambda j: reports.home_away(j.star(league_source="country"), fanout=True),
}

#: Queries over partly damaged documents.
DEFECT_VIEWS = {
    "envelope_valid": lambda j: j.valid(ENDPOINT_STATISTICS).select(fixture_param().alias("Fixture_ID")),
    "envelope_quarantine": lambda j: j.quarantine(ENDPOINT_STATISTICS)
        .groupBy(F.col("_reason").alias("Reason")).agg(F.count(F.lit(1)).alias("Documents")),
    "quarantine_bad_key": lambda j: j.quarantine(ENDPOINT_STATISTICS)
        .where(F.col("_reason") == "no usable id").select(
            F.explode("response.team.id").alias("Team_ID"), F.col("parameters.fixture").alias("Fixture")),
}

JSON_QUERIES = {
    **{name: (lambda s, d, view=view: view(_j(s, d))) for name, view in JSON_VIEWS.items()},
    **{name: (lambda s, d, view=view: view(_j(s, d, True))) for name, view in DEFECT_VIEWS.items()},
    "dim_seasons": lambda s, d: ProxyStar(s, d).dim_seasons,
    "dim_countries": lambda s, d: ProxyStar(s, d).dim_countries,
    "fixtures_seeded": fixtures_seeded,
    "venues_seeded": venues_seeded,
    "multiline_scan": multiline_scan,
}
