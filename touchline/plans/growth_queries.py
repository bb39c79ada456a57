"""Registered queries for tables that grow: corrections, backlogs, buckets, loads and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import dims, reports
from touchline.plans import marts
from touchline.plans.json_proxy import JsonProxy
from touchline.plans.proxy import ProxyStar
from touchline.plans.proxy_envelopes import ProxyEnvelopes, write_documents
from touchline.schemas import ENDPOINT_FIXTURES, ENDPOINT_PLAYERS, ENDPOINT_STATISTICS, ENDPOINT_TEAMS
from touchline.session import scratch_path
from touchline.sources import drift, warehouse
from touchline.sources.envelopes import parse_envelopes, stage_envelopes
from touchline.sources.tables import ParquetTables
from touchline.streaming import bitmap_backlog, deltas
from touchline.streaming import incremental as inc


# -- M1, B5: marts kept by signed deltas ------------------------------------------
def _corrected_sums(spark: SparkSession, star: ProxyStar) -> DataFrame:
    """Team sums after three batches: some fixtures come late, some are wrong at first and sent again.

    First: all fixtures but every fourth; of those divisible by three a third
    season, wrong goals and cards. Second: every fourth, and those divisible by
    six again, now with the right season but still wrong goals. Third: all that
    are divisible by three as they are, and those divisible by five unchanged.
    """
    root = scratch_path(spark, "deltas")
    path = f"{root}/truth"
    deltas.team_rows(star).write.parquet(path)
    rows, f = spark.read.parquet(path), F.col("Fixture_ID")

    def batch(epoch: int, which: Column, wrong_season: Column, wrong_goals: Column) -> None:
        sent = rows.where(which).withColumns({
            "Season_ID": F.when(wrong_season, F.lit(3)).otherwise(F.col("Season_ID")),
            "Goals_Scored": F.when(wrong_goals, F.col("Goals_Scored") + 2).otherwise(F.col("Goals_Scored")),
            "Winner_Team": F.when(wrong_goals, ~F.col("Winner_Team")).otherwise(F.col("Winner_Team")),
            "Red_Cards": F.when(wrong_goals, F.lit(None)).otherwise(F.col("Red_Cards"))})
        deltas.apply_epoch(sent, sent, root, epoch)

    never = F.lit(False)
    batch(0, f % 4 != 0, f % 3 == 0, f % 3 == 0)
    batch(1, (f % 4 == 0) | (f % 6 == 0), never, f % 6 == 0)
    batch(2, (f % 3 == 0) | (f % 5 == 0), never, never)
    return deltas.sums(spark, root)


def _corrected_player_sums(spark: SparkSession, star: ProxyStar) -> DataFrame:
    """Player sums after three batches: every third fixture names wrong players and counts at first, some come late."""
    root = scratch_path(spark, "player-deltas")
    path = f"{root}/truth"
    deltas.player_rows(star).write.parquet(path)
    rows, f = spark.read.parquet(path), F.col("Fixture_ID")
    wrong = f % 3 == 0
    damaged = rows.withColumns({
        "Player_ID": F.when(wrong & (f % 2 == 0), F.col("Player_ID") + 1).otherwise(F.col("Player_ID")),
        "Rating": F.when(wrong, F.col("Rating") + 0.25).otherwise(F.col("Rating")),
        "Goals_Scored": F.when(wrong, F.lit(None)).otherwise(F.col("Goals_Scored")),
        "Position": F.when(wrong, F.lit("G")).otherwise(F.col("Position"))})
    for epoch, sent in enumerate((damaged.where(f % 4 != 0), rows.where((f % 4 == 0) | (f % 6 == 0)), rows.where(wrong | (f % 5 == 0)))):
        deltas.apply_epoch(sent, sent, root, epoch, mart=deltas.PLAYER)
    return deltas.sums(spark, root, mart=deltas.PLAYER)


def _player_delta_mart(view):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = ProxyStar(spark, sf_dir)
        return view(_corrected_player_sums(spark, star), star)
    return q


def _delta_mart(view):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = ProxyStar(spark, sf_dir)
        return view(_corrected_sums(spark, star), star)
    return q


def season_refreshed_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season marts whose season 3 was written from damaged facts and then replaced, all or nothing."""
    star = ProxyStar(spark, sf_dir)
    root = scratch_path(spark, "season-marts")
    database = "marts_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}.db'")
    wrong = reports.home_away(star).withColumn("Home_Goals", F.when(
        F.col("Season_ID") == 3, F.col("Home_Goals") + 1).otherwise(F.col("Home_Goals")))
    table = f"{database}.mart_home_away"
    warehouse.save_counted(marts._season_last(wrong), table, f"{root}/mart_home_away", "Season_ID")
    right = reports.home_away(star).where(F.col("Season_ID") == 3).drop("Season_ID")
    warehouse.replace_partition(right, table, "Season_ID", 3, f"{root}/versions")
    return spark.table(table).select(*reports.HOME_AWAY_COLUMNS)


# -- J5, K4: bucketed facts ---------------------------------------------------------
def _bucketed(spark: SparkSession, sf_dir: str):
    root = scratch_path(spark, "bucketed")
    database = "buckets_" + root.rsplit("-", 1)[1]
    star = ProxyStar(spark, sf_dir)
    # One appearance per line item; Parquet footers hold their number.
    warehouse.save_bucketed_star(star, database, root, buckets=warehouse.bucket_count(star.t.lineitem.count()))
    return warehouse.load_star(spark, database)


# -- B1-B3: the backlog ---------------------------------------------------------------
def pending_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending fixtures from documents, some of them damaged, of another endpoint or empty."""
    docs = ProxyEnvelopes(ProxyStar(spark, sf_dir), defects=True)
    empty = F.regexp_replace("doc", r'"response":\[.*\]\}$', '"response":[]}')
    fixture = F.get_json_object("doc", "$.parameters.fixture").cast("long")
    players = docs.docs(ENDPOINT_PLAYERS).select(F.when(fixture % 5 == 0, empty).otherwise(F.col("doc")).alias("doc"))
    root = scratch_path(spark, "backlog")

    def parsed(endpoint: str, texts: DataFrame) -> DataFrame:   # once; later reads prune the columns
        path = f"{root}/{endpoint.replace('/', '_')}"
        stage_envelopes(parse_envelopes(texts, "doc", endpoint), endpoint, path)
        return spark.read.parquet(path)
    return bitmap_backlog.backlog(
        parsed(ENDPOINT_FIXTURES, docs.docs(ENDPOINT_FIXTURES)), parsed(ENDPOINT_PLAYERS, players),
        parsed(ENDPOINT_STATISTICS, docs.docs(ENDPOINT_STATISTICS)))


# -- B5: versions of a document -----------------------------------------------------------
def upsert_equal_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sent twice with one file time; the second file drops a team and changes a count."""
    star = ProxyStar(spark, sf_dir)
    path = scratch_path(spark, "equal-times") + "/table"
    rows = star.fact_team.select("Fixture_ID", "Team_ID", "Fouls").withColumns({
        inc.SOURCE_MTIME: F.lit("2024-01-01 00:00:00").cast("timestamp"),
        "Fixture_ID_Range": F.floor(F.col("Fixture_ID") / 1000).cast("long")})
    twice = F.col("Fixture_ID") % 3 == 0
    first = rows.withColumn("Fouls", F.when(twice, F.col("Fouls") + 100).otherwise(F.col("Fouls")))
    dropped = rows.where(twice).withColumns({"Team_ID": -F.col("Team_ID"), "Fouls": F.lit(1)})
    keys = ["Fixture_ID", "Team_ID"]
    for name, batch in (("a.json", first.unionByName(dropped)), ("b.json", rows.where(twice))):
        inc.upsert_partitions(batch.withColumn(inc.SOURCE_FILE, F.lit(name)), path, keys, "Fixture_ID_Range", inc.SOURCE_MTIME)
    return spark.read.parquet(path).select(*keys, "Fouls")


def ingested_team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team statistics through the file stream, in two runs: all documents, then a part of them again."""
    docs, root = ProxyEnvelopes(ProxyStar(spark, sf_dir)), scratch_path(spark, "ingest-stats")
    docs.stage_sides(f"{root}/sides")
    whole = docs.docs(ENDPOINT_STATISTICS)
    fixture = F.get_json_object("doc", "$.parameters.fixture").cast("long")
    wrong = F.regexp_replace("doc", r'(?<="type":"Fouls","value":)\d+', "99")
    wrong = F.regexp_replace(wrong, r'"type":"Offsides"', '"type":"Offside"')
    runs = (whole.select(F.when(fixture % 4 == 0, wrong).otherwise(F.col("doc")).alias("doc")),
            whole.where(fixture % 4 == 0))
    for n, sent in enumerate(runs):
        write_documents(sent, f"{root}/landing/run={n}", mode="append")
        inc.ingest_envelopes(spark, f"{root}/landing/*", ENDPOINT_STATISTICS, f"{root}/table", f"{root}/quarantine",
                             f"{root}/checkpoint", inc.statistics_rows, ["Fixture_ID", "Team_ID"], "Fixture_ID_Range",
                             ["Fixture_ID"], glob="*.txt.gz", multiline=False)
    return spark.read.parquet(f"{root}/table").drop("Fixture_ID_Range", inc.SOURCE_MTIME, inc.SOURCE_FILE)


# -- K5: rejects observed in the write -------------------------------------------------------
def load_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rejects of a damaged export, counted while its table is written."""
    s, root = ParquetTables(spark, sf_dir).supplier, scratch_path(spark, "observed")
    database = "loads_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}.db'")
    capacity = F.when(F.col("s_suppkey") % 7 == 0, "n/a").otherwise(F.floor(F.abs("s_acctbal")).cast("string"))
    country = F.when(F.col("s_suppkey") % 5 == 0, "12x").otherwise("3")
    warehouse.write_csv(s.select(F.col("s_suppkey").cast("string").alias("Venue_ID"), F.col("s_name").alias("Venue_Name"),
                                 country.alias("Country_ID"), capacity.alias("Capacity")), f"{root}/csv")
    seen = warehouse.save_observed(warehouse.read_csv_raw(spark, f"{root}/csv"), "dim_venues", f"{database}.dim_venues",
                                   f"{root}/dim_venues")
    stored = spark.table(f"{database}.dim_venues").agg(
        F.count(F.lit(1)).alias("Stored"), F.count("Capacity").alias("With_Capacity"))
    return stored.select(F.lit(seen["rows"]).cast("long").alias("Rows"),
                         F.lit(seen["bad_Country_ID"]).cast("long").alias("Bad_Country_ID"),
                         F.lit(seen["bad_Capacity"]).cast("long").alias("Bad_Capacity"), "Stored", "With_Capacity")


# -- S6: drift ---------------------------------------------------------------------------------
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams documents with a new field, a field that is gone and one of another type, against the declared schema."""
    path = scratch_path(spark, "drift")
    docs = ProxyEnvelopes(ProxyStar(spark, sf_dir)).docs(ENDPOINT_TEAMS)
    changed = F.regexp_replace("doc", r'"capacity":(\d+)', '"capacity":"$1"')
    changed = F.regexp_replace(changed, r'"city":"[^"]*",', "")
    changed = F.regexp_replace(changed, r'"country":', '"founded":1900,"country":')
    docs.select(changed.alias("doc")).write.text(path)
    return drift.drift(spark.read.text(path).withColumnRenamed("value", "doc"), ENDPOINT_TEAMS)


# -- J6: teams at the time of the match ---------------------------------------------------------
def _spells(star: ProxyStar) -> DataFrame:
    return dims.team_spells(dims.team_matches(star.fact_player, star.dim_fixtures))


def _json(view):
    return lambda s, d: view(JsonProxy(s, d))


GROWTH_QUERIES = {
    "delta_standings": _delta_mart(deltas.standings),
    "delta_home_away": _delta_mart(deltas.home_away),
    "delta_aggressive_teams": _delta_mart(deltas.aggressive_teams),
    "delta_top_scorers": _player_delta_mart(deltas.top_scorers),
    "delta_consistent_players": _player_delta_mart(deltas.consistent_players),
    "delta_impactful_players": _player_delta_mart(deltas.impactful_players),
    "delta_best_goalkeepers": _player_delta_mart(deltas.best_goalkeepers),
    "season_refreshed_marts": season_refreshed_marts,
    "bucketed_standings": lambda s, d: reports.standings(_bucketed(s, d)),
    "bucketed_home_away": lambda s, d: reports.home_away(_bucketed(s, d)),
    "pending_bitmap": pending_bitmap,
    "upsert_equal_times": upsert_equal_times,
    "ingested_team_stats": ingested_team_stats,
    "load_observed": load_observed,
    "schema_drift": schema_drift,
    "top_scorers_by_season": lambda s, d: reports.top_scorers_by_season(ProxyStar(s, d)),
    "team_spells": lambda s, d: _spells(ProxyStar(s, d)),
    "impactful_players_by_spell": lambda s, d: reports.impactful_players(
        reports.at_the_time(ProxyStar(s, d)), min_matches=2, by_team=True),
    "team_leagues": lambda s, d: dims.team_leagues(ProxyStar(s, d).dim_fixtures),
    "dim_teams_from_fixtures": _json(lambda j: dims.build_dim_teams(
        j.valid(ENDPOINT_TEAMS), j.countries, league_source="fixtures", fixtures=j.fixtures_work)),
}
