"""Bucketed facts, observed loads, all-or-nothing partitions, drift, leagues from fixtures, seasons' scorers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from envelopes import fixture, fixtures_doc, teams_doc
from touchline.operators import dims, reports
from touchline.operators.quality import fk_report
from touchline.plans.proxy import ProxyStar
from touchline.sources import drift, seeds, warehouse
from touchline.sources.envelopes import parse_envelopes


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def database(spark, scratch):
    name = "growth_" + scratch.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/{name}.db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_bucketed_facts_join_in_place(spark, scratch, database):
    star = ProxyStar(spark, SF_SMALL)
    rows = warehouse.save_bucketed_star(star, database, scratch, buckets=4)
    assert rows["fact_team"] == star.fact_team.count()
    loaded = warehouse.load_star(spark, database)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (reports._team_fixture(loaded), reports.match_results(loaded)):
            plan = _plan(df)
            below = plan[plan.index("SortMergeJoin"):]
            assert "Exchange" not in below and "Bucketed: true" in below
        per_season = _plan(loaded.fact_player.join(loaded.dim_fixtures, "Fixture_ID").groupBy("Season_ID").count())
        assert "Exchange" not in per_season[per_season.index("SortMergeJoin"):]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rejects_are_metrics_of_the_one_write(spark, scratch, database):
    raw = spark.createDataFrame([("1", "2021"), ("x", None), ("3", "20.5")], "Season_ID string, Season_Year string")
    seen = warehouse.save_observed(raw, "dim_seasons", f"{database}.dim_seasons", f"{scratch}/seasons")
    assert seen == {"rows": 3, "bad_Season_ID": 1, "bad_Season_Year": 1}
    assert spark.table(f"{database}.dim_seasons").count() == 3


def test_a_refresh_that_fails_leaves_the_old_rows(spark, scratch, database, monkeypatch):
    table = f"{database}.mart"
    old = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "x string, Season_ID int")
    warehouse.save_counted(old, table, f"{scratch}/mart", "Season_ID")
    new = spark.createDataFrame([("n",)], "x string")
    rows = lambda: sorted(map(tuple, spark.table(table).collect()))

    def fail(*args):
        raise RuntimeError("lost between the two steps")
    with monkeypatch.context() as m:
        m.setattr(warehouse, "point_partition", fail)
        with pytest.raises(RuntimeError):
            warehouse.replace_partition(new, table, "Season_ID", 1, f"{scratch}/versions")
    assert rows() == [("a", 1), ("b", 1), ("c", 2)]
    reader = spark.table(table).where("Season_ID = 1")      # planned before the refresh
    reader.explain("formatted")
    warehouse.replace_partition(new, table, "Season_ID", 1, f"{scratch}/versions")
    assert rows() == [("c", 2), ("n", 1)]
    warehouse.replace_partition(new, table, "Season_ID", 3, f"{scratch}/versions")   # a new season
    assert rows() == [("c", 2), ("n", 1), ("n", 3)]


def test_reference_check_reads_each_table_once(spark, scratch, database):
    star = ProxyStar(spark, SF_SMALL)
    warehouse.save_star_tables(star, database, scratch)
    loaded = warehouse.load_star(spark, database)
    loaded.fact_team = loaded.fact_team.unionAll(loaded.fact_team.limit(1).withColumn("Team_ID", F.lit(-5).cast("long")))
    loaded.dim_teams = loaded.dim_teams.where("Team_ID <> 2")
    got = {(r.Child_Table, r.Child_Column): r.Orphan_Rows for r in fk_report(loaded).collect()}
    gone = loaded.fact_team.where("Team_ID = 2").count()
    assert got["fact_team", "Team_ID"] == gone + 1
    assert got["dim_fixtures", "Home_Team_ID"] == star.dim_fixtures.where("Home_Team_ID = 2").count() > 0
    assert got["fact_player", "Player_ID"] == 0 and len(got) == 15
    plan = _plan(fk_report(warehouse.load_star(spark, database)))
    assert plan.count("FileScan") == 9 and plan.count("Exchange") <= 3 and "Join" not in plan


def _env(spark, docs, endpoint):
    return parse_envelopes(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc", endpoint)


def test_leagues_from_fixtures(spark):
    seasons = seeds.dim_seasons(spark, [(2022, 1), (2023, 2)])
    work = dims.fixtures_work(_env(spark, [fixtures_doc([
        fixture(1, 10, 20, 1, 0, season=2022, league=39), fixture(2, 20, 10, 1, 0, season=2022, league=39),
        fixture(3, 10, 30, 1, 0, season=2022, league=48), fixture(4, 10, 30, 1, 0, season=2023, league=48)])], "fixtures"), seasons)
    assert sorted(map(tuple, dims.team_leagues(work).collect())) == [
        (1, 10, 39), (1, 10, 48), (1, 20, 39), (1, 30, 48), (2, 10, 48), (2, 30, 48)]
    teams = _env(spark, [teams_doc([(10, "A", "England"), (20, "B", "England"), (40, "D", "Spain")], league="1")], "teams")
    got = dims.build_dim_teams(teams, seeds.dim_countries(spark), league_source="fixtures", fixtures=work)
    assert sorted((r.Team_ID, r.League_ID) for r in got.collect() if r.League_ID) == [(10, 39), (10, 48), (20, 39)]
    assert [(r.Team_ID, r.League_ID) for r in got.collect() if r.League_ID is None] == [(40, None)]
    with pytest.raises(ValueError):
        dims.build_dim_teams(teams, seeds.dim_countries(spark), league_source="fixtures")


def test_scorers_of_each_season_are_limited_before_the_shuffle(spark):
    star = ProxyStar(spark, SF_SMALL)
    df = reports.top_scorers_by_season(star, k=3)
    assert "WindowGroupLimit" in _plan(df)
    rows = df.collect()
    for season in {r.Season_ID for r in rows}:
        one = [r.Player_ID for r in sorted(rows, key=lambda r: r.Place) if r.Season_ID == season]
        assert one == [r.Player_ID for r in reports.top_scorers(star, k=3, season_id=season).collect()]


def test_spells_of_a_transferred_player(spark):
    days = [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, None)]
    fixtures = spark.createDataFrame(days, "Fixture_ID long, day int").select(
        "Fixture_ID", F.expr("timestamp_seconds(day * 86400)").alias("Match_Date"))
    rows = [(f, t, 9) for f, t in ((1, 10), (2, 10), (3, 20), (4, 10), (6, 10), (7, 30))] + [(f, 50, 8) for f in range(1, 7)]
    fact = spark.createDataFrame([*rows, (5, 99, None)], "Fixture_ID long, Team_ID long, Player_ID long").repartition(3)
    matches = dims.team_matches(fact, fixtures)
    got = [(r.Player_ID, r.Spell, r.Team_ID, r.First_Date.day, r.Last_Date.day, r.Matches) for r in dims.team_spells(matches).collect()]
    assert sorted(got) == [(8, 1, 50, 2, 7, 6), (9, 1, 10, 2, 3, 2), (9, 2, 20, 4, 4, 1), (9, 3, 10, 5, 7, 2)]
    at = {(r.Player_ID, r.Fixture_ID): r.Team_ID for r in dims.with_team_at(fact, matches, fixtures).collect()}
    assert at[9, 3] == 20 and at[9, 4] == 10 and at[9, 7] is None and at[None, 5] is None and len(at) == 13
    plan = _plan(dims.team_spells(matches))
    assert "hashpartitioning(Player_ID" not in "".join(line for line in plan.splitlines() if "Window" in line)


def test_drift_and_bootstrap(spark):
    docs = spark.createDataFrame([
        ('{"get":"teams","results":1,"response":[{"team":{"id":1,"name":"A","code":"x"},"venue":{"id":null}}]}',),
        ('{"get":"teams","results":"2","response":[{"team":{"id":2,"name":null,"logo":"l"}}]}',), ("{broken",)], "doc string")
    got = {(r.Path, r.Change): (r.Declared, r.Observed) for r in drift.drift(docs, "teams").collect()}
    assert got["response[].team.code", "new"] == (None, "STRING")
    assert got["results", "retyped"] == ("bigint", "VARIANT")
    assert got["response[].team.country", "missing"] == ("string", None)
    assert not any(path in ("response[].team.id", "get", "response[].venue.id") for path, _ in got)
    ddl = drift.bootstrap_ddl(docs)
    again = spark.read.schema(ddl).json(docs.rdd.map(lambda r: r[0]))
    assert [r[0] for r in again.select(F.get("response", F.lit(0))["team"]["id"].alias("id")).where("id is not null").collect()] == [1, 2]
    assert drift.drift(docs.limit(0), "teams").count() > 0      # nothing landed: all is missing
    with pytest.raises(ValueError):
        drift.bootstrap_ddl(docs.limit(0))


def test_equal_times_and_files(spark, scratch):
    from touchline.streaming.incremental import upsert_partitions
    schema = "Fixture_ID long, Team_ID long, Fouls int, _t long, p int"
    stored = spark.createDataFrame([(1, 10, 5, 100, 0), (1, 20, 5, 100, 0)], schema)
    again = spark.createDataFrame([(1, 10, 7, 100, 0)], schema)
    for batch in (stored, again, again):
        upsert_partitions(batch, f"{scratch}/t", ["Fixture_ID", "Team_ID"], "p", "_t")
    assert [(r.Team_ID, r.Fouls) for r in spark.read.parquet(f"{scratch}/t").collect()] == [(10, 7)]
    named = lambda df, f: df.withColumn("_source_file", F.lit(f))
    for batch in (named(again, "b.json"), named(stored, "a.json")):     # the file name decides, not the order
        upsert_partitions(batch, f"{scratch}/u", ["Fixture_ID", "Team_ID"], "p", "_t")
    assert [(r.Team_ID, r.Fouls) for r in spark.read.parquet(f"{scratch}/u").collect()] == [(10, 7)]


def test_queries_without_the_optional_folders(tmp_path):
    """With the llm folder gone but corpus_pipeline.py left, the other queries are still listed."""
    import os
    import shutil
    import subprocess
    import sys
    from conftest import ROOT
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "tests", "__pycache__"))
    (copy / "corpus_pipeline.py").write_text("import touchline.llm\n")
    code = "import __spark_entry__ as E; q = E.queries(); assert 'pipeline' not in q and set(q) == set(E.oracle_sql()); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(copy)}, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) > 50
