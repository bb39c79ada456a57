"""Marts kept by signed deltas against full recomputation."""

import random
from types import SimpleNamespace

from pyspark.sql import functions as F

from touchline.operators import reports
from touchline.streaming import deltas as D


def _star(spark, rows):
    rows = spark.createDataFrame(rows, D.TEAM.ddl)
    teams = rows.select("Team_ID").where("Team_ID is not null").distinct()
    return SimpleNamespace(
        dim_fixtures=rows.select("Fixture_ID", "Season_ID", "League_ID", "Home_Team_ID", "Away_Team_ID").distinct(),
        fact_team=rows.where("Team_ID is not null").select("Fixture_ID", *D.TEAM.columns[5:]),
        dim_teams=teams.select("Team_ID", F.concat(F.lit("T"), F.col("Team_ID").cast("string")).alias("Team_Name")),
        dim_seasons=spark.createDataFrame([(1, 2021), (2, 2022)], "Season_ID int, Season_Year int"),
        dim_leagues=spark.createDataFrame([(7, "L7"), (8, "L8")], "League_ID long, League_Name string"))


def _fixture(r, f):
    """Two rows of a fixture, with NULLs now and then."""
    home, away = r.sample(range(1, 9), 2)
    season, league, h, a = r.choice((1, 2, None)), r.choice((7, 8)), r.choice((0, 1, 2, None)), r.choice((0, 1, 3))
    out = []
    for t, own, other in ((home, h, a), (away, a, h)):
        win = None if own is None or other is None else own > other
        out.append((f, season, league, home, away, t, own, other, win, r.choice((None, 4, 9)), r.choice((1, 2)), r.choice((None, 0, 1))))
    return out


def _rows(df):
    return sorted(map(str, df.collect()))


def test_batches_with_corrections_equal_recomputation(spark, scratch):
    r, now = random.Random(8), {}
    for epoch in range(4):
        batch = {f: _fixture(r, f) for f in r.sample(range(1, 40), 15)}
        gone = [f for f in batch if r.random() < 0.2]       # documents that now hold no teams
        for f in gone:
            batch[f] = []
        now |= batch
        rows = spark.createDataFrame([x for v in batch.values() for x in v], D.TEAM.ddl).repartition(3)
        ids = spark.createDataFrame([(f,) for f in batch], "Fixture_ID long")
        for _ in range(2 if epoch == 2 else 1):             # one epoch is replayed
            D.apply_epoch(rows, ids, scratch, epoch, size=10)
        star = _star(spark, [x for v in now.values() for x in v])
        sums = D.sums(spark, scratch)
        assert _rows(D.standings(sums, star)) == _rows(reports.standings(star))
        assert _rows(D.home_away(sums, star)) == _rows(reports.home_away(star))
        assert _rows(D.aggressive_teams(sums, star)) == _rows(reports.aggressive_teams(star))
    before = D.sums(spark, scratch, epoch=2)
    D.compact(spark, scratch, 2, f"{scratch}/compact")
    assert _rows(D.sums(spark, f"{scratch}/compact", epoch=2)) == _rows(before.select(*before.columns))
    assert _rows(D.sums(spark, f"{scratch}/compact")) == _rows(D.sums(spark, scratch))


def test_only_touched_ranges_are_read(spark, scratch):
    r = random.Random(1)
    rows = spark.createDataFrame([x for f in range(1, 60) for x in _fixture(r, f)], D.TEAM.ddl)
    D.apply_epoch(rows, rows.select("Fixture_ID"), scratch, 0, size=10)
    touched = spark.createDataFrame([(12,), (47,)], "Fixture_ID long")
    df = D.earlier_rows(spark, scratch, touched, [1, 4], 1)
    assert df.count() == 4
    ranges = {f.split("Fixture_ID_Range=")[1].split("/")[0] for f in spark.read.schema(
        D.TEAM.stored).parquet(f"{scratch}/rows").where("Fixture_ID_Range in (1, 4)").inputFiles()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(ranges) == 6 and "PartitionFilters" in plan and "Fixture_ID_Range#" in plan.split("PartitionFilters")[1][:200]


def test_player_marts_equal_recomputation(spark, scratch):
    r, now = random.Random(3), {}
    names = spark.createDataFrame([(p, f"P{p}", p % 3) for p in range(1, 9)], "Player_ID long, Player_Name string, Team_ID long")
    teams = spark.createDataFrame([(t, f"T{t}") for t in range(3)], "Team_ID long, Team_Name string")
    for epoch in range(3):
        batch = {f: [(f, r.randint(1, 8), r.choice((20, 60, 90, None)), r.choice(("G", "F", None)), r.choice((None, 6.25, 7.1)),
                      r.choice((None, 0, 2)), r.choice((None, 1)), r.choice((None, 3)), r.choice((0, 2, None)))
                     for _ in range(r.randint(0, 6))] for f in r.sample(range(1, 30), 14)}
        now |= batch
        rows = spark.createDataFrame([x for v in batch.values() for x in v], D.PLAYER.ddl).repartition(3)
        ids = spark.createDataFrame([(f,) for f in batch], "Fixture_ID long")
        D.apply_epoch(rows, ids, scratch, epoch, size=10, mart=D.PLAYER)
        fact = spark.createDataFrame([x for v in now.values() for x in v], D.PLAYER.ddl)
        star = SimpleNamespace(fact_player=fact, dim_players=names, dim_teams=teams)
        kept = D.sums(spark, scratch, mart=D.PLAYER)
        assert _rows(D.top_scorers(kept, star)) == _rows(reports.top_scorers(star))
        for view in ("consistent_players", "impactful_players", "best_goalkeepers"):
            assert _rows(getattr(D, view)(kept, star, min_matches=2)) == _rows(getattr(reports, view)(star, min_matches=2)), view
