"""Report semantics on a tiny hand-made star."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from touchline.operators import reports


def _star(spark):
    fixtures = spark.createDataFrame(
        [(1, 9, 1, 10, 20), (2, 9, 1, 20, 10), (3, 9, 1, 10, 30), (4, 9, 1, 30, 20)],
        "Fixture_ID long, League_ID long, Season_ID int, Home_Team_ID long, Away_Team_ID long")
    # fixture 1: 10 beats 20 2-0; fixture 2: draw 1-1; fixture 3: 10 beats 30 1-0;
    # fixture 4: unplayed (NULL goals)
    fact_team = spark.createDataFrame([
        (1, 10, 2, 0, True, 10, 1, 0), (1, 20, 0, 2, False, 14, 3, None),
        (2, 20, 1, 1, False, 8, 2, 1), (2, 10, 1, 1, False, 9, 1, 0),
        (3, 10, 1, 0, True, 11, 0, 0), (3, 30, 0, 1, False, 12, 4, 1),
        (4, 30, None, None, False, 5, 0, 0), (4, 20, None, None, False, 6, 0, 0)],
        "Fixture_ID long, Team_ID long, Goals_Scored int, Goals_Conceded int, Winner_Team boolean,"
        " Fouls int, Yellow_Cards int, Red_Cards int")
    teams = spark.createDataFrame([(10, "Ten", 9), (20, "Twenty", 9), (30, "Thirty", 9)],
                                  "Team_ID long, Team_Name string, League_ID long")
    players = spark.createDataFrame([(100, "P100", 10), (200, "P200", 20), (300, "P300", 30)],
                                    "Player_ID long, Player_Name string, Team_ID long")
    fp_rows = []
    for f in range(1, 13):
        fp_rows.append((f, 10, 100, 90, "G", 7.0 + (f % 3), f % 2, 1, 3, 1))
        fp_rows.append((f, 20, 200, 30 if f % 2 else 90, "F", 6.0, 1, None, 0, 0))
        fp_rows.append((f, 30, 300, 90, "G", 8.0, 0, 0, 2, 2))
    fact_player = spark.createDataFrame(
        fp_rows, "Fixture_ID long, Team_ID long, Player_ID long, Minutes_Played int, Position string,"
                 " Rating double, Goals_Scored int, Assists int, Saves int, Goals_Conceded int")
    return SimpleNamespace(
        dim_fixtures=fixtures, fact_team=fact_team, dim_teams=teams, dim_players=players,
        fact_player=fact_player,
        dim_seasons=spark.createDataFrame([(1, 2023)], "Season_ID int, Season_Year int"),
        dim_leagues=spark.createDataFrame([(9, "Nine")], "League_ID long, League_Name string"))


def test_standings_faithful_counts_draws_and_unplayed_as_losses(spark):
    rows = {r.Team: r for r in reports.standings(_star(spark)).collect()}
    assert (rows["Ten"].League_Points, rows["Ten"].Wins, rows["Ten"].Draws, rows["Ten"].Loses) == (7, 2, 1, 1)
    assert rows["Ten"].League_Position == 1 and rows["Ten"].Goal_Difference == 3
    assert rows["Twenty"].Loses == 3 and rows["Twenty"].Home_Losses == 1
    corrected = {r.Team: r for r in reports.standings(_star(spark), corrected=True).collect()}
    assert corrected["Ten"].Loses == 0 and corrected["Twenty"].Loses == 1


def test_standings_global_equals_per_league_with_one_league(spark):
    star = _star(spark)
    a = reports.standings(star, per_league=False)
    b = reports.standings(star, per_league=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_home_away_single_pass_equals_two_aggregates(spark):
    star = _star(spark)
    a, b = reports.home_away(star, single_pass=True), reports.home_away(star, single_pass=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ten = [r for r in a.collect() if r.Team_Name == "Ten"][0]
    # Q-7 kept: every match of the team counts in both averages
    assert (ten.Home_Points, ten.Away_Points, ten.Avg_Home_Points) == (6, 1, 2.0)


def test_player_reports(spark):
    star = _star(spark)
    top = reports.top_scorers(star).collect()
    assert [(r.Player_ID, r.total_goals) for r in top] == [(200, 12), (100, 6), (300, 0)]
    cons = reports.consistent_players(star).collect()
    # P200 plays 60+ minutes only 6 times; P100 and P300 tie on 8.0, Player_ID breaks it
    assert [(r.Player_Name, r.Avg_Rating) for r in cons] == [("P100", 8.0), ("P300", 8.0)]
    imp = {r.Player_Name: r for r in reports.impactful_players(star).collect()}
    assert imp["P200"].Goal_Contributions is None and imp["P100"].Goal_Contributions == 18
    gk = reports.best_goalkeepers(star).collect()
    assert [(r.Player_Name, r.Save_Percentage) for r in gk] == [("P100", 75.0), ("P300", 50.0)]


def test_aggressive_teams_averages_and_order(spark):
    rows = reports.aggressive_teams(_star(spark)).collect()
    assert [(r.Team_Name, r.Avg_Fouls_Per_Game) for r in rows] == [
        ("Ten", 10.0), ("Twenty", 9.33), ("Thirty", 8.5)]
    assert rows[1].Avg_Reds_Per_Game == 0.5 and rows[1].Total_Reds == 1   # NULL not averaged


def test_round_ratio_half_up(spark):
    from touchline.functions.numeric import round_ratio
    r = spark.range(1).select(round_ratio(F.lit(57), F.lit(200)).alias("a"),
                              round_ratio(F.lit(1), F.lit(0)).alias("b"),
                              round_ratio(F.lit(107), F.lit(40)).alias("c")).first()
    assert (r.a, r.b, r.c) == (0.29, None, 2.68)


def test_team_of_two_leagues_is_one_row_by_default_and_multiplied_in_fanout(spark):
    star = _star(spark)
    star.dim_teams = spark.createDataFrame(
        [(10, "Ten", 9), (10, "Ten", 8), (20, "Twenty", 9), (30, "Thirty", 9)],
        "Team_ID long, Team_Name string, League_ID long")
    once = {r.Team: (r.League_Points, r.League_Position) for r in reports.standings(star).collect()}
    assert once == {"Ten": (7, 1), "Twenty": (1, 2), "Thirty": (0, 3)}
    twice = {r.Team: (r.League_Points, r.Wins, r.Goals_For) for r in reports.standings(star, fanout=True).collect()}
    assert twice["Ten"] == (14, 4, 8) and twice["Twenty"][0] == 1
    home = {r.Team_Name: r for r in reports.home_away(star, fanout=True).collect()}
    assert home["Ten"].Home_Points == 12 and home["Ten"].Avg_Home_Points == 2.0
    assert len(reports.home_away(star).collect()) == 3
    # join-then-aggregate: 12 matches of P100 count twice, so a limit of 20 keeps only P100
    assert [r.Player_Name for r in reports.consistent_players(star, min_matches=20, fanout=True).collect()] == ["P100"]
    assert [r.Matches_Played for r in reports.best_goalkeepers(star, fanout=True).collect()] == [24, 12]
    assert {r.Player_Name: r.Goal_Contributions for r in reports.impactful_players(star, fanout=True).collect()
            }["P100"] == 36
    assert {r.Team_Name: r.Total_Fouls for r in reports.aggressive_teams(star, fanout=True).collect()}["Ten"] == 60


def test_ratios_are_exact_and_do_not_overflow(spark):
    from touchline.functions.numeric import round_avg, round_ratio
    r = spark.range(1).select(
        round_ratio(F.lit(10**18 + 1), F.lit(10**18)).alias("a"),
        round_avg(F.lit(6e10), F.lit(4 * 10**10)).alias("b"),
        round_ratio(F.lit(9007199254740993), F.lit(2)).alias("c")).first()
    assert (r.a, r.b, r.c) == (1.0, 1.5, 4503599627370496.5)
