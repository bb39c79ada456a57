"""DuckDB oracles for the JSON-path queries.

The documents are rendered from line items, so each oracle recomputes the
expected flat result straight from the line items with the value recipe of
``proxy_envelopes`` and the strict / lenient coercion rules applied by hand.
"""

from __future__ import annotations

from touchline.plans.oracles import home_away_sql, standings_sql, with_proxy

SIDE_CTES = """
stat_side AS (
  SELECT l.l_orderkey AS Fixture_ID, l.l_suppkey AS Team_ID, l.l_suppkey = b.Home_Team_ID AS Is_Home,
         count(*) AS n, sum(CAST(floor(l.l_quantity) AS BIGINT)) % 101 AS q,
         sum(l.l_linenumber) % 7 AS r, sum(l.l_linenumber) AS lines,
         sum(CAST(floor(l.l_quantity) AS BIGINT)) % 5 AS goals
  FROM lineitem l
  JOIN fixture_base b ON l.l_orderkey = b.Fixture_ID
   AND (l.l_suppkey = b.Home_Team_ID OR l.l_suppkey = b.Away_Team_ID)
  GROUP BY l.l_orderkey, l.l_suppkey, b.Home_Team_ID),
doc_state AS (
  SELECT Fixture_ID,
         CASE q WHEN 2 THEN 'wrong endpoint: fixtures/lineups' WHEN 1 THEN 'corrupt'
                WHEN 3 THEN 'no usable id' END AS reason
  FROM stat_side WHERE Is_Home),
valid_fixture AS (SELECT Fixture_ID FROM doc_state WHERE reason IS NULL),
json_leagues AS (
  SELECT DISTINCT CAST(f.League_ID AS BIGINT) AS League_ID, n.n_name AS League_Name,
         n.n_regionkey AS Country_ID,
         'logos/league/' || CAST(f.League_ID AS VARCHAR) || '.png' AS League_Logo
  FROM dim_fixtures f JOIN nation n ON n.n_nationkey = f.League_ID)
"""


# Expected columns, written out: (column, value from a side's counters).
def _team_stat_columns(lenient: bool) -> str:
    possession = "CAST(q AS DOUBLE)" if lenient else "CASE WHEN r = 5 THEN NULL ELSE CAST(q AS DOUBLE) END"
    return f"""CAST(q % 10 AS INTEGER) AS Shots_On_Target, CAST(q % 11 AS INTEGER) AS Shots_Off_Target,
  CAST(q % 23 + 4 AS INTEGER) AS Total_Shots, CAST(q % 7 AS INTEGER) AS Blocked_Shots,
  CAST(q % 9 AS INTEGER) AS Shots_Inside_Box, CAST(q % 8 AS INTEGER) AS Shots_Outside_Box,
  CAST(n AS INTEGER) AS Fouls, CAST(lines % 12 AS INTEGER) AS Corner_Kicks, CAST(lines % 5 AS INTEGER) AS Offsides,
  {possession} AS Possession_Percentage, CAST(lines % 4 AS INTEGER) AS Yellow_Cards,
  CASE WHEN r IN (4, 6) THEN NULL ELSE CAST(r AS INTEGER) END AS Red_Cards,
  CAST(q % 6 AS INTEGER) AS Goalkeeper_Saves, CAST(q * 5 + 300 AS INTEGER) AS Total_Passes,
  CAST(q * 4 + 200 AS INTEGER) AS Passes_Accurate, CAST(r AS DOUBLE) AS Passes_Percentage,
  CAST(CAST(n AS VARCHAR) || '.' || CAST(r AS VARCHAR) AS DOUBLE) AS Expected_Goals"""


def flatten_team_stats_sql(lenient: bool = False) -> str:
    return with_proxy(f"SELECT Fixture_ID, Team_ID, {_team_stat_columns(lenient)} FROM stat_side", SIDE_CTES)


FACT_TEAM_FROM_FIXTURES = with_proxy(f"""
SELECT Fixture_ID, Team_ID, CAST(goals AS INTEGER) AS Goals_Scored, CAST(others - goals AS INTEGER) AS Goals_Conceded,
  2 * goals > others AS Winner_Team, {_team_stat_columns(False)}
FROM (SELECT *, sum(goals) OVER (PARTITION BY Fixture_ID) AS others FROM stat_side)""", SIDE_CTES)

FLATTEN_PLAYER_STATS = """
WITH a AS (
  SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber AS l, l_returnflag AS flag,
         CAST(floor(l_quantity) AS INTEGER) AS q, CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS tax,
         l_linenumber <> 7 AS has
  FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_orderkey AS Fixture_ID, l_suppkey AS Team_ID, l_partkey AS Player_ID,
  CASE WHEN has THEN least(90, 2 * q) END AS Minutes_Played,
  CASE WHEN has THEN CASE flag WHEN 'R' THEN 'G' WHEN 'A' THEN 'D' WHEN 'N' THEN 'F' END END AS Position,
  CASE WHEN has THEN CAST(tax || '.' || CAST(l AS VARCHAR) AS DOUBLE) END AS Rating,
  CASE WHEN has THEN l > 4 END AS Substitute,
  CAST(CASE WHEN has THEN NULLIF(l % 4, 0) END AS INTEGER) AS Goals_Scored,
  CASE WHEN has THEN q % 4 END AS Goals_Conceded,
  CAST(CASE WHEN has THEN NULLIF(l % 3, 0) END AS INTEGER) AS Assists, CASE WHEN has THEN q % 9 END AS Saves,
  CASE WHEN has THEN q * 3 END AS Passes, CAST(CASE WHEN has THEN l % 3 END AS INTEGER) AS Passes_Key,
  CASE WHEN has THEN CAST(q + 40 AS DOUBLE) END AS Pass_Accuracy,
  CAST(CASE WHEN has THEN l % 2 END AS INTEGER) AS Yellow_Cards, CASE WHEN has THEN (l = 5)::INTEGER END AS Red_Cards,
  CASE WHEN has THEN q % 6 END AS Shots, CASE WHEN has THEN q % 3 END AS Shots_On_Target,
  CASE WHEN has THEN q % 5 END AS Tackles, CAST(CASE WHEN has THEN (q + l) % 4 END AS INTEGER) AS Blocks,
  CAST(CASE WHEN has THEN (q + 2 * l) % 6 END AS INTEGER) AS Interceptions,
  CAST(CASE WHEN has THEN q % 12 + l END AS INTEGER) AS Duels, CASE WHEN has THEN q % 8 END AS Duels_Won,
  CAST(CASE WHEN has THEN (q + l) % 9 END AS INTEGER) AS Dribbles_Attempted,
  CAST(CASE WHEN has THEN (q + 3 * l) % 5 END AS INTEGER) AS Dribbles_Success,
  CAST(CASE WHEN has THEN (2 * q + l) % 7 END AS INTEGER) AS Dribbled_Past,
  CASE WHEN has THEN q % 7 END AS Fouls_Committed, CAST(CASE WHEN has THEN l % 2 END AS INTEGER) AS Fouls_Drawn,
  CASE WHEN has THEN (l = 3)::INTEGER END AS Penalty_Scored, CASE WHEN has THEN (l = 2)::INTEGER END AS Penalty_Missed,
  CASE WHEN has THEN (l = 1)::INTEGER END AS Penalty_Saved, CASE WHEN has THEN (l = 4)::INTEGER END AS Penalty_Won,
  CASE WHEN has THEN (q = 13)::INTEGER END AS Penalty_Committed, CASE WHEN has THEN q % 2 END AS Offside
FROM a"""

ENVELOPE_VALID = with_proxy("SELECT Fixture_ID FROM valid_fixture", SIDE_CTES)
ENVELOPE_QUARANTINE = with_proxy("""
SELECT reason AS Reason, count(*) AS Documents FROM doc_state WHERE reason IS NOT NULL GROUP BY reason""",
                                 SIDE_CTES)

DIM_SEASONS = with_proxy("SELECT Season_ID, Season_Year FROM dim_seasons")
DIM_COUNTRIES = with_proxy("SELECT Country_ID, Country_Name FROM dim_countries")
DIM_LEAGUES = with_proxy("SELECT * FROM json_leagues", SIDE_CTES)
DIM_VENUES = """
SELECT s.s_suppkey AS Venue_ID, s.s_name AS Venue_Name, n.n_name AS City, r.r_regionkey AS Country_ID,
       CAST(floor(abs(s.s_acctbal)) AS INTEGER) AS Capacity
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""
DIM_TEAMS = """
SELECT s_suppkey AS Team_ID, s_name AS Team_Name, CAST(s_nationkey AS BIGINT) AS League_ID,
       s_suppkey AS Home_Venue_ID, 'logos/team/' || CAST(s_suppkey AS VARCHAR) || '.png' AS Team_Logo
FROM supplier"""
DIM_TEAMS_FANOUT = with_proxy("""
SELECT s.s_suppkey AS Team_ID, s.s_name AS Team_Name, l.League_ID, s.s_suppkey AS Home_Venue_ID,
       'logos/team/' || CAST(s.s_suppkey AS VARCHAR) || '.png' AS Team_Logo
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN json_leagues l ON l.Country_ID = n.n_regionkey""", SIDE_CTES)
DIM_PLAYERS_LATEST = with_proxy("SELECT Player_ID, Player_Name, Team_ID FROM dim_players")
FIXTURES_ENRICHED = with_proxy("""
SELECT f.Fixture_ID, CAST(f.League_ID AS BIGINT) AS League_ID, f.Season_ID, f.Home_Team_ID,
  f.Away_Team_ID, f.Venue_ID, f.Match_Date, f.Match_Time,
  CAST(h.goals AS INTEGER) AS Goals_Home, CAST(a.goals AS INTEGER) AS Goals_Away,
  h.goals > a.goals AS Home_win, a.goals > h.goals AS Away_win,
  CASE WHEN h.goals > a.goals THEN f.Home_Team_ID WHEN a.goals > h.goals THEN f.Away_Team_ID END
    AS Winner_Team_ID,
  'FT' AS Status
FROM dim_fixtures f
JOIN stat_side h ON h.Fixture_ID = f.Fixture_ID AND h.Is_Home
JOIN stat_side a ON a.Fixture_ID = f.Fixture_ID AND NOT a.Is_Home""", SIDE_CTES)


QUARANTINE_BAD_KEY = with_proxy("""
SELECT s.Team_ID, 'unknown' AS Fixture FROM stat_side s JOIN doc_state d USING (Fixture_ID)
WHERE d.reason = 'no usable id'""", SIDE_CTES)
FIXTURES_SEEDED = with_proxy("""
SELECT Fixture_ID, CAST(CASE WHEN year(Match_Date) BETWEEN 1995 AND 1997 THEN year(Match_Date) - 1994 END AS INTEGER)
  AS Season_ID, Home_Team_ID, Away_Team_ID
FROM dim_fixtures""")
VENUES_SEEDED = """
SELECT s_suppkey AS Venue_ID, s_name AS Venue_Name, n_name AS City,
       CAST(CASE r_name WHEN 'ASIA' THEN 11 WHEN 'EUROPE' THEN 12 END AS INTEGER) AS Country_ID,
       CAST(floor(abs(s_acctbal)) AS INTEGER) AS Capacity
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""
MULTILINE_SCAN = """
SELECT CAST(n_nationkey AS VARCHAR) AS League, CAST(n_nationkey AS BIGINT) AS Team_ID, n_name AS Team_Name FROM nation"""


def json_oracles() -> dict[str, str]:
    return {
        "flatten_team_stats": flatten_team_stats_sql(False),
        "flatten_team_stats_lenient": flatten_team_stats_sql(True),
        "flatten_player_stats": FLATTEN_PLAYER_STATS,
        "envelope_valid": ENVELOPE_VALID,
        "envelope_quarantine": ENVELOPE_QUARANTINE,
        "dim_seasons": DIM_SEASONS,
        "dim_countries": DIM_COUNTRIES,
        "dim_leagues": DIM_LEAGUES,
        "dim_venues": DIM_VENUES,
        "dim_teams": DIM_TEAMS,
        "dim_teams_fanout": DIM_TEAMS_FANOUT,
        "dim_players_latest": DIM_PLAYERS_LATEST,
        "fixtures_enriched": FIXTURES_ENRICHED,
        "fact_team_from_fixtures": FACT_TEAM_FROM_FIXTURES,
        "json_star_standings": standings_sql(per_league=True, json_star=True),
        "standings_fanout": standings_sql(per_league=True, json_star=True, fanout=True),
        "home_away_fanout": home_away_sql(fanout=True, json_star=True),
        "quarantine_bad_key": QUARANTINE_BAD_KEY,
        "fixtures_seeded": FIXTURES_SEEDED,
        "venues_seeded": VENUES_SEEDED,
        "multiline_scan": MULTILINE_SCAN,
    }
