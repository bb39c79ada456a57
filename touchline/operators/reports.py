"""The seven league reports over a star.

Each report takes any object with the star's table attributes (``Star``,
``ProxyStar``, a loaded warehouse) and returns a DataFrame.

Common plan rules:
  * aggregate the fact on its keys first, then join the (possibly large)
    dimensions to the much smaller aggregate. ``dim_teams`` may hold a team
    once per league of its country: by default it is reduced to one row per
    team and name; with ``fanout=True`` the sums and counts are multiplied by
    the number of those rows, which equals join-then-aggregate;
  * every ordering says where NULLs go and ends on a unique key, so top-k
    results are deterministic (the reference leaves both open);
  * ratios use ``round_ratio`` (exact half-up), averages are computed in
    double, never integer-truncated.

Faithful vs corrected: the faithful mode keeps the reference's column
semantics (a draw is a "loss", every match counts as a home match, ...);
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.numeric import round_avg, round_ratio
from touchline.operators.dims import team_matches, with_team_at
from touchline.operators.ranking import rank_by

STANDINGS_ORDER = [("League_Points", True), ("Goal_Difference", True), ("Goals_For", True)]
STANDINGS_COLUMNS = [
    "Season_ID", "League_ID", "Season_Year", "League_Name", "League_Position", "Team",
    "League_Points", "Wins", "Draws", "Loses", "Goal_Difference", "Goals_For", "Goals_Against",
    "Away_Wins", "Home_Losses",
]


def _flag(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) term; NULL cond counts 0."""
    return F.when(cond, 1).otherwise(0)


def _teams(star, fanout: bool) -> DataFrame:
    """Team_ID, Team_Name, _times (rows of the team that a fact row is joined to)."""
    times = F.count(F.lit(1)) if fanout else F.lit(1).cast("long")
    return star.dim_teams.groupBy("Team_ID", "Team_Name").agg(times.alias("_times"))


def _multiplied(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.col("_times") for c in columns})


def _team_fixture(star) -> DataFrame:
    """fact_team rows with their fixture's season, league and sides."""
    f = star.dim_fixtures.select("Fixture_ID", "Season_ID", "League_ID", "Home_Team_ID",
                                 "Away_Team_ID")
    return star.fact_team.join(f, "Fixture_ID")


# -- R1 ---------------------------------------------------------------------
def match_results(star, corrected: bool = False) -> DataFrame:
    """Per (season, league, team) points, record and goals (the CTE of R1)."""
    ft = _team_fixture(star)
    win = F.col("Winner_Team") == F.lit(True)
    draw = F.col("Goals_Scored") == F.col("Goals_Conceded")
    if corrected:
        ft = ft.where(F.col("Goals_Scored").isNotNull() & F.col("Goals_Conceded").isNotNull())
        loss = F.col("Goals_Scored") < F.col("Goals_Conceded")
    else:
        loss = F.col("Winner_Team") == F.lit(False)   # faithful: draws count as losses
    home = F.col("Home_Team_ID") == F.col("Team_ID")
    away = F.col("Away_Team_ID") == F.col("Team_ID")
    return (ft.groupBy("Season_ID", "League_ID", "Team_ID").agg(
        F.sum(F.when(win, 3).when(draw, 1).otherwise(0)).alias("League_Points"),
        F.sum(_flag(win)).alias("Wins"),
        F.sum(_flag(draw)).alias("Draws"),
        F.sum(_flag(loss)).alias("Loses"),
        F.sum("Goals_Scored").alias("Goals_For"),
        F.sum("Goals_Conceded").alias("Goals_Against"),
        F.sum(_flag(away & win)).alias("Away_Wins"),
        F.sum(_flag(home & loss)).alias("Home_Losses"))
        .withColumn("Goal_Difference", F.col("Goals_For") - F.col("Goals_Against")))


STANDINGS_SUMS = ["League_Points", "Wins", "Draws", "Loses", "Goal_Difference", "Goals_For", "Goals_Against",
                  "Away_Wins", "Home_Losses"]


def standings(star, per_league: bool = True, corrected: bool = False, fanout: bool = False) -> DataFrame:
    """R1 league table.

    ``per_league=False`` is the reference's single ranking across all
    seasons and leagues; ``per_league=True`` ranks within each season and
    league. Both use the distributed ``rank_by``.
    """
    return standings_of(match_results(star, corrected), star, per_league, fanout)


def standings_of(mr: DataFrame, star, per_league: bool = True, fanout: bool = False) -> DataFrame:
    """R1 from the sums of ``match_results``, however they were kept."""
    teams = _teams(star, fanout).withColumnRenamed("Team_Name", "Team")
    seasons = star.dim_seasons.select("Season_ID", "Season_Year")
    leagues = star.dim_leagues.select("League_ID", "League_Name")
    named = (_multiplied(mr.join(teams, "Team_ID"), STANDINGS_SUMS).drop("_times")
             .join(seasons, "Season_ID", "left").join(leagues, "League_ID", "left"))
    parts = ["Season_ID", "League_ID"] if per_league else []
    ranked = rank_by(named, STANDINGS_ORDER, parts, name="League_Position")
    order = ([F.col("Season_ID").asc_nulls_last(), F.col("League_ID").asc_nulls_last()]
             if per_league else [])
    return ranked.select(*STANDINGS_COLUMNS).orderBy(
        *order, F.col("League_Position").asc(), F.col("Team").asc())


# -- R2 ---------------------------------------------------------------------
def top_scorers(star, k: int = 10, season_id: int | None = None) -> DataFrame:
    """R2 top scorers; ``season_id`` restricts to one season (Q-9)."""
    fp = star.fact_player.select("Fixture_ID", "Player_ID", "Goals_Scored")
    if season_id is not None:
        fx = star.dim_fixtures.where(F.col("Season_ID") == season_id).select("Fixture_ID")
        fp = fp.join(fx, "Fixture_ID", "left_semi")
    goals = fp.groupBy("Player_ID").agg(F.sum("Goals_Scored").alias("total_goals")) \
        .where(F.col("total_goals").isNotNull())
    return top_scorers_of(goals, star, k)


def top_scorers_of(goals: DataFrame, star, k: int = 10) -> DataFrame:
    """R2 from ``total_goals`` per Player_ID."""
    players = star.dim_players.select("Player_ID", "Player_Name")
    return (goals.join(players, "Player_ID")
            .orderBy(F.col("total_goals").desc_nulls_last(), F.col("Player_ID").asc())
            .limit(k).select("Player_ID", "Player_Name", "total_goals"))


def top_scorers_by_season(star, k: int = 10) -> DataFrame:
    """R2 for every season at once: the ``k`` best of each.

    The place is a row number that is cut off at ``k``, so each task keeps only
    its own ``k`` best rows of a season before the shuffle; fixtures outside a
    season do not count.
    """
    fx = star.dim_fixtures.where(F.col("Season_ID").isNotNull()).select("Fixture_ID", "Season_ID")
    goals = (star.fact_player.where(F.col("Goals_Scored").isNotNull()).select("Fixture_ID", "Player_ID", "Goals_Scored")
             .join(fx, "Fixture_ID").groupBy("Season_ID", "Player_ID").agg(F.sum("Goals_Scored").alias("total_goals")))
    best = Window.partitionBy("Season_ID").orderBy(F.col("total_goals").desc(), F.col("Player_ID").asc())
    top = goals.withColumn("Place", F.row_number().over(best).cast("long")).where(F.col("Place") <= k)
    return top.join(star.dim_players.select("Player_ID", "Player_Name"), "Player_ID").select(
        "Season_ID", "Place", "Player_ID", "Player_Name", "total_goals")


# -- R3 ---------------------------------------------------------------------
HOME_AWAY_COLUMNS = ["Season_ID", "League_ID", "Team_Name", "Home_Points", "Away_Points",
                     "Home_Goals", "Away_Goals", "Avg_Home_Points", "Avg_Away_Points"]


def _side_sums(side: str, corrected: bool) -> list[Column]:
    own = F.col(f"{side}_Team_ID") == F.col("Team_ID")
    win = F.col("Winner_Team") == F.lit(True)
    draw = F.col("Goals_Scored") == F.col("Goals_Conceded")
    matches = F.sum(_flag(own)) if corrected else F.count(F.lit(1))   # Q-7
    return [
        F.sum(F.when(own & win, 3).when(own & draw, 1).otherwise(0)).alias(f"{side}_Points"),
        F.sum(F.when(own, F.col("Goals_Scored")).otherwise(0)).alias(f"{side}_Goals"),
        matches.alias(f"{side}_Matches"),
    ]


def home_away_of(perf: DataFrame, star, fanout: bool = False) -> DataFrame:
    """R3 from each side's points, goals and matches per (season, league, team)."""
    named = _multiplied(perf.join(_teams(star, fanout), "Team_ID"), [
        f"{side}_{what}" for side in ("Home", "Away") for what in ("Points", "Goals", "Matches")])
    return (named
            .withColumn("Avg_Home_Points", round_ratio(F.col("Home_Points"), F.col("Home_Matches")))
            .withColumn("Avg_Away_Points", round_ratio(F.col("Away_Points"), F.col("Away_Matches")))
            .orderBy((F.col("Home_Points") + F.col("Away_Points")).desc_nulls_last(),
                     "Season_ID", "League_ID", "Team_ID")
            .select(*HOME_AWAY_COLUMNS))


def home_away(star, single_pass: bool = True, corrected: bool = False, fanout: bool = False) -> DataFrame:
    """R3 home vs away form, keyed on (season, league, team) (fixes Q-8).

    ``single_pass=False`` is the reference's shape: two aggregates of the
    same join, then a join of the two. ``single_pass=True`` computes both
    sets of conditional sums in one aggregate: one shuffle instead of three.
    Both give the same rows.
    """
    ft = _team_fixture(star)
    if corrected:
        ft = ft.where(F.col("Goals_Scored").isNotNull())
    keys = ["Season_ID", "League_ID", "Team_ID"]
    if single_pass:
        perf = ft.groupBy(*keys).agg(*_side_sums("Home", corrected), *_side_sums("Away", corrected))
    else:
        home = ft.groupBy(*keys).agg(*_side_sums("Home", corrected))
        away = ft.groupBy(*keys).agg(*_side_sums("Away", corrected))
        perf = home.join(away, keys)
    return home_away_of(perf, star, fanout)


# -- R4-R6 --------------------------------------------------------------------
def at_the_time(star):
    """The star with each appearance under the team that the player had then.

    R4-R6 with ``by_team=True`` over it count a transferred player once per
    team, under that team's name, instead of under the latest one.
    """
    matches = team_matches(star.fact_player, star.dim_fixtures)
    fact = with_team_at(star.fact_player, matches, star.dim_fixtures)
    return SimpleNamespace(dim_teams=star.dim_teams, dim_players=star.dim_players, fact_player=fact)


def _player_keys(by_team: bool) -> list[str]:
    return ["Player_ID", "Team_ID"] if by_team else ["Player_ID"]


def _player_team(star, fanout: bool) -> DataFrame:
    """dim_players with the team name of the player's (latest) team."""
    return star.dim_players.select("Player_ID", "Player_Name", "Team_ID").join(_teams(star, fanout), "Team_ID")


def _with_team(per_player: DataFrame, star, fanout: bool, min_matches: int, sums: list[str]) -> DataFrame:
    """Named per-player sums, kept where there are enough matches. Without a
    fan-out the filter runs before the joins."""
    if not fanout:
        per_player = per_player.where(F.col("Matches_Played") >= min_matches)
    if "Team_ID" in per_player.columns:   # by team at the time
        named = per_player.join(star.dim_players.select("Player_ID", "Player_Name"), "Player_ID").join(
            _teams(star, fanout), "Team_ID")
    else:
        named = per_player.join(_player_team(star, fanout), "Player_ID")
    named = _multiplied(named, ["Matches_Played", *sums])
    return named.where(F.col("Matches_Played") >= min_matches) if fanout else named


def _top(df: DataFrame, metric: str, k: int, tie: str, cols: list[str]) -> DataFrame:
    ties = [F.col(tie).asc()] + ([F.col("Team_ID").asc()] if "Team_ID" in df.columns and tie != "Team_ID" else [])
    return df.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(k).select(*cols)


def consistent_players(star, min_minutes: int = 60, min_matches: int = 10, k: int = 10,
                       fanout: bool = False, by_team: bool = False) -> DataFrame:
    """R4 highest average rating among regular starters."""
    per_player = (star.fact_player.where(F.col("Minutes_Played") >= min_minutes)
                  .groupBy(*_player_keys(by_team))
                  .agg(F.count("Fixture_ID").alias("Matches_Played"),
                       F.sum("Rating").alias("_rating_sum"), F.count("Rating").alias("_rating_n")))
    return consistent_players_of(per_player, star, min_matches, k, fanout)


def consistent_players_of(per_player: DataFrame, star, min_matches: int = 10, k: int = 10, fanout: bool = False) -> DataFrame:
    """R4 from Matches_Played, _rating_sum and _rating_n of regular starters per player (and team)."""
    out = (_with_team(per_player, star, fanout, min_matches, ["_rating_sum", "_rating_n"])
           .withColumn("Avg_Rating", round_avg(F.col("_rating_sum"), F.col("_rating_n"))))
    return _top(out, "Avg_Rating", k, "Player_ID",
                ["Player_Name", "Team_ID", "Team_Name", "Matches_Played", "Avg_Rating"])


def impactful_players(star, min_matches: int = 10, k: int = 10,
                      coalesce_nulls: bool = False, fanout: bool = False, by_team: bool = False) -> DataFrame:
    """R5 goal contributions. Goals + Assists is NULL when either is NULL
    (Q-10, faithful); ``coalesce_nulls=True`` counts a missing value as 0."""
    g, a = F.col("Goals_Scored"), F.col("Assists")
    if coalesce_nulls:
        g, a = F.coalesce(g, F.lit(0)), F.coalesce(a, F.lit(0))
    contrib = g + a
    per_player = (star.fact_player.groupBy(*_player_keys(by_team))
                  .agg(F.count("Fixture_ID").alias("Matches_Played"),
                       F.sum(g).alias("Total_Goals"), F.sum(a).alias("Total_Assists"),
                       F.sum(contrib).alias("Goal_Contributions"),
                       F.count(contrib).alias("_contrib_n")))
    return impactful_players_of(per_player, star, min_matches, k, fanout)


def impactful_players_of(per_player: DataFrame, star, min_matches: int = 10, k: int = 10, fanout: bool = False) -> DataFrame:
    """R5 from Matches_Played, the three totals and _contrib_n per player (and team)."""
    out = (_with_team(per_player, star, fanout, min_matches,
                      ["Total_Goals", "Total_Assists", "Goal_Contributions", "_contrib_n"])
           .withColumn("Avg_Goal_Contributions",
                       round_ratio(F.col("Goal_Contributions"), F.col("_contrib_n"))))
    return _top(out, "Goal_Contributions", k, "Player_ID",
                ["Player_Name", "Team_Name", "Matches_Played", "Total_Goals", "Total_Assists",
                 "Goal_Contributions", "Avg_Goal_Contributions"])


def best_goalkeepers(star, min_matches: int = 10, k: int = 10, fanout: bool = False, by_team: bool = False) -> DataFrame:
    """R6 save percentage of goalkeepers. The numerator sums every save, the
    denominator only rows where both values exist (Q-11, kept)."""
    per_player = (star.fact_player.where(F.col("Position") == "G")
                  .groupBy(*_player_keys(by_team))
                  .agg(F.count("Fixture_ID").alias("Matches_Played"),
                       F.sum("Saves").alias("Total_Saves"),
                       F.sum("Goals_Conceded").alias("Goals_Allowed"),
                       F.sum(F.col("Saves") + F.col("Goals_Conceded")).alias("_faced")))
    return best_goalkeepers_of(per_player, star, min_matches, k, fanout)


def best_goalkeepers_of(per_player: DataFrame, star, min_matches: int = 10, k: int = 10, fanout: bool = False) -> DataFrame:
    """R6 from Matches_Played, Total_Saves, Goals_Allowed and _faced of goalkeepers per player (and team)."""
    out = (_with_team(per_player, star, fanout, min_matches, ["Total_Saves", "Goals_Allowed", "_faced"])
           .withColumn("Save_Percentage",
                       round_ratio(F.col("Total_Saves"), F.col("_faced"), scale=100)))
    return _top(out, "Save_Percentage", k, "Player_ID",
                ["Player_Name", "Team_Name", "Matches_Played", "Total_Saves", "Goals_Allowed",
                 "Save_Percentage"])


# -- R7 -----------------------------------------------------------------------
def aggressive_teams(star, k: int = 10, fanout: bool = False) -> DataFrame:
    """R7 fouls and cards per game, grouped by team name as in the reference.

    Pre-aggregated per Team_ID (sums and non-null counts re-aggregate
    exactly), then named, then merged per name.
    """
    per_team = star.fact_team.groupBy("Team_ID").agg(
        F.count("Fixture_ID").alias("m"),
        F.sum("Fouls").alias("f"), F.count("Fouls").alias("fn"),
        F.sum("Yellow_Cards").alias("y"), F.count("Yellow_Cards").alias("yn"),
        F.sum("Red_Cards").alias("r"), F.count("Red_Cards").alias("rn"))
    return aggressive_teams_of(per_team, star, k, fanout)


def aggressive_teams_of(per_team: DataFrame, star, k: int = 10, fanout: bool = False) -> DataFrame:
    """R7 from the sums (f, y, r) and counts (m, fn, yn, rn) per Team_ID."""
    named = _multiplied(per_team.join(_teams(star, fanout), "Team_ID"), ["m", "f", "fn", "y", "yn", "r", "rn"])
    per_name = named.groupBy("Team_Name").agg(
        F.sum("m").alias("Matches_Played"),
        F.sum("f").alias("Total_Fouls"), F.sum("fn").alias("fn"),
        F.sum("y").alias("Total_Yellows"), F.sum("yn").alias("yn"),
        F.sum("r").alias("Total_Reds"), F.sum("rn").alias("rn"))
    out = (per_name
           .withColumn("Avg_Fouls_Per_Game", round_ratio(F.col("Total_Fouls"), F.col("fn")))
           .withColumn("Avg_Yellows_Per_Game", round_ratio(F.col("Total_Yellows"), F.col("yn")))
           .withColumn("Avg_Reds_Per_Game", round_ratio(F.col("Total_Reds"), F.col("rn"))))
    return _top(out, "Avg_Fouls_Per_Game", k, "Team_Name",
                ["Team_Name", "Matches_Played", "Total_Fouls", "Total_Yellows", "Total_Reds",
                 "Avg_Fouls_Per_Game", "Avg_Yellows_Per_Game", "Avg_Reds_Per_Game"])
