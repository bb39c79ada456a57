"""DuckDB SQL for ``growth_queries``: what the tables must hold in the end, from the raw tables."""

from __future__ import annotations

from touchline.plans.json_oracles import flatten_team_stats_sql
from touchline.plans.oracles import (AGGRESSIVE_TEAMS, BEST_GOALKEEPERS, CONSISTENT_PLAYERS, IMPACTFUL_PLAYERS, TOP_SCORERS,
                                     home_away_sql, ratio_sql, standings_sql, with_proxy)

PENDING_BITMAP = with_proxy("""
SELECT Fixture_ID FROM dim_fixtures f
WHERE Fixture_ID % 5 = 0
   OR (SELECT sum(CAST(floor(l_quantity) AS BIGINT)) FROM lineitem
       WHERE l_orderkey = f.Fixture_ID AND l_suppkey = f.Home_Team_ID) % 101 IN (1, 2, 3)
   OR NOT EXISTS (SELECT 1 FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_orderkey = f.Fixture_ID)""")

UPSERT_EQUAL_TIMES = with_proxy("SELECT Fixture_ID, Team_ID, Fouls FROM fact_team")

LOAD_OBSERVED = """
SELECT count(*) AS Rows, count(*) FILTER (s_suppkey % 5 = 0) AS Bad_Country_ID,
       count(*) FILTER (s_suppkey % 7 = 0) AS Bad_Capacity, count(*) AS Stored,
       count(*) FILTER (s_suppkey % 7 <> 0) AS With_Capacity
FROM supplier"""

# What was changed, and what the documents never hold.
SCHEMA_DRIFT = """
SELECT 'teams' AS Endpoint, Path, Change, Declared, Observed FROM (VALUES
  ('parameters.fixture', 'missing', 'string', NULL), ('parameters.season', 'missing', 'string', NULL),
  ('parameters.team', 'missing', 'string', NULL), ('response[].team.founded', 'new', NULL, 'BIGINT'),
  ('response[].venue.capacity', 'retyped', 'bigint', 'STRING'), ('response[].venue.city', 'missing', 'string', NULL)
) AS t(Path, Change, Declared, Observed)"""

TOP_SCORERS_BY_SEASON = with_proxy("""
SELECT Season_ID, Place, Player_ID, p_name AS Player_Name, total_goals FROM (
  SELECT Season_ID, Player_ID, total_goals,
         row_number() OVER (PARTITION BY Season_ID ORDER BY total_goals DESC, Player_ID) AS Place
  FROM (SELECT f.Season_ID, l.l_partkey AS Player_ID, CAST(sum(l.l_linenumber % 4) AS BIGINT) AS total_goals
        FROM lineitem l JOIN dim_fixtures f ON f.Fixture_ID = l.l_orderkey
        WHERE l.l_linenumber % 4 > 0 GROUP BY ALL))
JOIN part ON p_partkey = Player_ID WHERE Place <= 10""")

_SPELLS = """
seen AS (
  SELECT l_partkey AS p, Match_Date AS d, max(l_suppkey) AS team, count(*) AS n
  FROM lineitem JOIN dim_fixtures ON Fixture_ID = l_orderkey GROUP BY ALL),
steps AS (
  SELECT *, CASE WHEN lag(team) OVER (PARTITION BY p ORDER BY d) IS NOT DISTINCT FROM team THEN 0 ELSE 1 END AS new FROM seen),
runs AS (SELECT *, sum(new) OVER (PARTITION BY p ORDER BY d) AS spell FROM steps)"""
TEAM_SPELLS = with_proxy("""
SELECT p AS Player_ID, CAST(spell AS BIGINT) AS Spell, any_value(team) AS Team_ID, min(d) AS First_Date, max(d) AS Last_Date,
       CAST(sum(n) AS BIGINT) AS Matches
FROM runs GROUP BY p, spell""", _SPELLS)

_BOTH = "FILTER (l_linenumber % 4 > 0 AND l_linenumber % 3 > 0)"
IMPACTFUL_BY_SPELL = with_proxy(f"""
SELECT p_name AS Player_Name, s_name AS Team_Name, n AS Matches_Played, g AS Total_Goals, a AS Total_Assists,
       both_ AS Goal_Contributions, average AS Avg_Goal_Contributions
FROM (SELECT *, row_number() OVER (ORDER BY both_ DESC NULLS LAST, l_partkey, team) AS place FROM (
  SELECT l_partkey, seen.team, count(*) AS n, CAST(sum(NULLIF(l_linenumber % 4, 0)) AS BIGINT) AS g,
         CAST(sum(NULLIF(l_linenumber % 3, 0)) AS BIGINT) AS a,
         CAST(sum(l_linenumber % 4 + l_linenumber % 3) {_BOTH} AS BIGINT) AS both_,
         {ratio_sql(f"sum(l_linenumber % 4 + l_linenumber % 3) {_BOTH}", f"count(*) {_BOTH}")} AS average
  FROM lineitem JOIN dim_fixtures f ON f.Fixture_ID = l_orderkey JOIN seen ON seen.p = l_partkey AND seen.d = f.Match_Date
  GROUP BY ALL)
  JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = team WHERE n >= 2)
WHERE place <= 10""", _SPELLS)

TEAM_LEAGUES = with_proxy("""
SELECT Season_ID, Home_Team_ID AS Team_ID, League_ID FROM dim_fixtures
UNION SELECT Season_ID, Away_Team_ID, League_ID FROM dim_fixtures""")

DIM_TEAMS_FROM_FIXTURES = with_proxy("""
SELECT s_suppkey AS Team_ID, s_name AS Team_Name, CAST(played.League_ID AS BIGINT) AS League_ID,
       s_suppkey AS Home_Venue_ID, 'logos/team/' || CAST(s_suppkey AS VARCHAR) || '.png' AS Team_Logo
FROM supplier LEFT JOIN (SELECT DISTINCT unnest([Home_Team_ID, Away_Team_ID]) AS t, League_ID FROM dim_fixtures) played
  ON played.t = s_suppkey""")


def growth_oracles() -> dict[str, str]:
    return {
        "delta_standings": standings_sql(per_league=True),
        "delta_home_away": home_away_sql(),
        "delta_aggressive_teams": AGGRESSIVE_TEAMS,
        "delta_top_scorers": TOP_SCORERS,
        "delta_consistent_players": CONSISTENT_PLAYERS,
        "delta_impactful_players": IMPACTFUL_PLAYERS,
        "delta_best_goalkeepers": BEST_GOALKEEPERS,
        "season_refreshed_marts": home_away_sql(),
        "bucketed_standings": standings_sql(per_league=True, json_star=True),
        "bucketed_home_away": home_away_sql(json_star=True),
        "pending_bitmap": PENDING_BITMAP,
        "upsert_equal_times": UPSERT_EQUAL_TIMES,
        "ingested_team_stats": flatten_team_stats_sql(),
        "load_observed": LOAD_OBSERVED,
        "schema_drift": SCHEMA_DRIFT,
        "top_scorers_by_season": TOP_SCORERS_BY_SEASON,
        "team_spells": TEAM_SPELLS,
        "impactful_players_by_spell": IMPACTFUL_BY_SPELL,
        "team_leagues": TEAM_LEAGUES,
        "dim_teams_from_fixtures": DIM_TEAMS_FROM_FIXTURES,
    }
