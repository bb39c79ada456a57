"""Star sinks and typed loads round-trip."""

import glob
import os

from conftest import SF_SMALL, write_docs
from envelopes import stats_doc
from touchline.plans.marts import write_marts
from touchline.plans.proxy import ProxyStar
from touchline.schemas import STAR_DDL
from touchline.sources.envelopes import read_envelopes, stage_envelopes
from touchline.sources.warehouse import (conform, load_star_csv, load_star_tables, write_star_csv,
                                         write_star_tables)
from touchline.star import STAR_TABLES


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_and_parquet_round_trip_whole_star(spark, scratch):
    star = ProxyStar(spark, SF_SMALL)
    write_star_csv(star, f"{scratch}/csv")
    loaded = load_star_csv(spark, f"{scratch}/csv")
    for name in STAR_TABLES:
        df = getattr(loaded, name)
        assert df.schema.simpleString().replace("bigint", "long") == \
            conform(getattr(star, name), name).schema.simpleString().replace("bigint", "long")
        assert _same(df, conform(getattr(star, name), name)), name
    # seed tables land as a single CSV file (K3)
    local = f"{scratch}/csv/dim_seasons".replace("file:", "")
    assert len(glob.glob(os.path.join(local, "part-*.csv"))) == 1

    write_star_tables(star, f"{scratch}/pq")
    tables = load_star_tables(spark, f"{scratch}/pq")
    assert _same(tables.fact_team, conform(star.fact_team, "fact_team"))
    assert tables.fact_player.columns == [c.split(" ")[0] for c in STAR_DDL["fact_player"].split(", ")]


def test_load_by_header_name_not_position(spark, scratch):
    # columns in a different order than the DDL (Q-2) and one junk value
    path = f"{scratch}/seasons"
    write_docs(path, {"part-0.csv": "Season_Year,Season_ID\n2021,1\n2022,x\n"})
    from touchline.sources.warehouse import read_csv_typed
    rows = sorted(read_csv_typed(spark, path, "dim_seasons").collect(), key=lambda r: r.Season_Year)
    assert [(r.Season_ID, r.Season_Year) for r in rows] == [(1, 2021), (None, 2022)]


def test_marts_and_staging(spark, scratch):
    paths = write_marts(ProxyStar(spark, SF_SMALL), f"{scratch}/marts")
    assert spark.read.parquet(paths["mart_top_scorers"]).count() == 10
    write_docs(f"{scratch}/landing", {"a.json": stats_doc(1, [(1, [("Fouls", 2)])]),
                                      "b.json": "{broken"})
    stage_envelopes(read_envelopes(spark, f"{scratch}/landing", "fixtures/statistics"),
                    "fixtures/statistics", f"{scratch}/staged")
    staged = spark.read.parquet(f"{scratch}/staged")
    assert sorted((r._status, r._reason or "") for r in staged.select("_status", "_reason").collect()) \
        == [("quarantine", "corrupt"), ("valid", "")]


def test_csv_keeps_every_string(spark, scratch):
    from touchline.sources.warehouse import read_csv_typed, write_csv
    names = ["A\nB", 'say "hi"', "x,y", "", None, " padded ", "back\\slash", "\r\n", "é;|"]
    teams = conform(spark.createDataFrame([(i, n) for i, n in enumerate(names)], "Team_ID long, Team_Name string"),
                    "dim_teams")
    assert teams.schema == spark.createDataFrame([], STAR_DDL["dim_teams"]).schema   # NULL columns are typed
    write_csv(teams, f"{scratch}/teams")
    back = {r.Team_ID: r.Team_Name for r in read_csv_typed(spark, f"{scratch}/teams", "dim_teams").collect()}
    assert back == dict(enumerate(names))


def test_catalog_tables_prune_seasons_and_refresh_one(spark, scratch):
    from pyspark.sql import functions as F
    from touchline.operators import reports
    from touchline.plans.marts import refresh_season, save_marts
    from touchline.sources.warehouse import load_star, save_star_tables
    star = ProxyStar(spark, SF_SMALL)
    db = "star_test_" + scratch.rsplit("-", 1)[1]
    rows = save_star_tables(star, db, f"{scratch}/tables")
    assert rows["fact_team"] == star.fact_team.count() and set(rows) == set(STAR_TABLES)
    season = load_star(spark, db, season_id=3)
    plan = season.fact_team._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Season_ID" in plan and "= 3)" in plan
    whole = reports.standings(load_star(spark, db))
    assert _same(reports.standings(season), whole.where("Season_ID = 3"))
    save_marts(load_star(spark, db), db, f"{scratch}/marts")
    before = spark.table(f"{db}.mart_standings").collect()
    columns = [c for c in spark.table(f"{db}.mart_standings").columns if c != "Season_ID"]
    spark.table(f"{db}.mart_standings").where("Season_ID = 4").write.parquet(f"{scratch}/four")
    spark.read.parquet(f"{scratch}/four").createOrReplaceTempView("four")
    spark.sql(f"INSERT OVERWRITE {db}.mart_standings PARTITION (Season_ID = 3) SELECT {', '.join(columns)} FROM four")
    assert sorted(map(tuple, before), key=str) != sorted(
        map(tuple, spark.table(f"{db}.mart_standings").collect()), key=str)
    refresh_season(season, db, 3)
    after = spark.table(f"{db}.mart_standings").collect()
    assert sorted(map(tuple, before), key=str) == sorted(map(tuple, after), key=str)
    assert spark.table(f"{db}.mart_home_away").where(F.col("Season_ID") == 3).count() > 0
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_rejects_are_counted(spark):
    from touchline.sources.warehouse import load_rejects
    raw = spark.createDataFrame([("1", "2021"), ("x", None), ("3", "20.5")], "Season_ID string, Season_Year string")
    got = {r.Column_Name: (r.Rows, r.Rejected, r.Missing) for r in load_rejects(raw, "dim_seasons").collect()}
    assert got == {"Season_ID": (3, 1, False), "Season_Year": (3, 1, False)}
    missing = {r.Column_Name: r.Missing for r in load_rejects(raw.drop("Season_Year"), "dim_seasons").collect()}
    assert missing == {"Season_ID": False, "Season_Year": True}
