"""Independent SQL oracles (DuckDB dialect) over the driver's views.

Each oracle recomputes a registered query from the raw tables
(``region nation customer supplier part orders lineitem events``) in plain
SQL, with the proxy star of FIXTURES.md section C inlined as CTEs. They are
written from the definitions, not generated from the Spark plans.

Conventions shared with the Spark side: aggregates are cast to fixed types
(BIGINT sums and counts), NULLs sort last, every top-k ends on a unique key,
and ratios are rounded exactly (``ratio_sql``) because engines round
half-way doubles differently.
"""

from __future__ import annotations


def ratio_sql(num: str, den: str, digits: int = 2, scale: int = 1) -> str:
    """num * scale / den rounded half-up to ``digits``; NULL for a zero divisor.

    Whole part and remainder of a HUGEINT division; a remainder of at least
    half the divisor rounds up.
    """
    f = 10 ** digits
    n, d = f"CAST({num} AS HUGEINT) * {f * scale}", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    return f"(CAST(({n}) // {d} + (CASE WHEN 2 * (({n}) % {d}) >= {d} THEN 1 ELSE 0 END) AS DOUBLE) / {f})"


PROXY_CTES = """
dim_seasons AS (
  SELECT DISTINCT CAST(year(o_orderdate) - 1994 AS INTEGER) AS Season_ID,
         CAST(year(o_orderdate) AS INTEGER) AS Season_Year
  FROM orders),
dim_countries AS (
  SELECT r_regionkey AS Country_ID, r_name AS Country_Name FROM region),
dim_leagues AS (
  SELECT n_nationkey AS League_ID, n_name AS League_Name, n_regionkey AS Country_ID,
         'logos/league/' || CAST(n_nationkey AS VARCHAR) || '.png' AS League_Logo
  FROM nation),
dim_venues AS (
  SELECT s.s_suppkey AS Venue_ID, s.s_name AS Venue_Name, n.n_name AS City,
         n.n_regionkey AS Country_ID, CAST(floor(abs(s.s_acctbal)) AS INTEGER) AS Capacity
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
dim_teams AS (
  SELECT s_suppkey AS Team_ID, s_name AS Team_Name, s_nationkey AS League_ID,
         s_suppkey AS Home_Venue_ID,
         'logos/team/' || CAST(s_suppkey AS VARCHAR) || '.png' AS Team_Logo
  FROM supplier),
fixture_base AS (
  SELECT l_orderkey AS Fixture_ID, min(l_suppkey) AS Home_Team_ID, max(l_suppkey) AS Away_Team_ID
  FROM lineitem GROUP BY l_orderkey HAVING min(l_suppkey) <> max(l_suppkey)),
dim_fixtures AS (
  SELECT b.Fixture_ID, c.c_nationkey AS League_ID,
         CAST(year(o.o_orderdate) - 1994 AS INTEGER) AS Season_ID,
         b.Home_Team_ID, b.Away_Team_ID, b.Home_Team_ID AS Venue_ID,
         o.o_orderdate AS Match_Date,
         CAST('1970-01-01 ' || strftime(o.o_orderdate, '%H:%M:%S') AS TIMESTAMP) AS Match_Time
  FROM fixture_base b
  JOIN orders o ON o.o_orderkey = b.Fixture_ID
  JOIN customer c ON c.c_custkey = o.o_custkey),
team_side AS (
  SELECT l.l_orderkey AS Fixture_ID, l.l_suppkey AS Team_ID,
         l.l_suppkey = b.Home_Team_ID AS Is_Home,
         CAST(sum(CAST(floor(l.l_quantity) AS BIGINT)) % 5 AS INTEGER) AS Goals,
         CAST(count(*) AS INTEGER) AS Fouls,
         CAST(sum(l.l_linenumber) % 4 AS INTEGER) AS Yellow_Cards,
         CAST(NULLIF(sum(l.l_linenumber) % 7, 6) AS INTEGER) AS Red_Cards
  FROM lineitem l
  JOIN fixture_base b ON l.l_orderkey = b.Fixture_ID
   AND (l.l_suppkey = b.Home_Team_ID OR l.l_suppkey = b.Away_Team_ID)
  GROUP BY l.l_orderkey, l.l_suppkey, b.Home_Team_ID),
fact_team AS (
  SELECT s.Fixture_ID, s.Team_ID, s.Goals AS Goals_Scored, o.Goals AS Goals_Conceded,
         s.Goals > o.Goals AS Winner_Team, s.Fouls, s.Yellow_Cards, s.Red_Cards
  FROM team_side s JOIN team_side o ON s.Fixture_ID = o.Fixture_ID AND s.Team_ID <> o.Team_ID),
fact_player AS (
  SELECT l_orderkey AS Fixture_ID, l_suppkey AS Team_ID, l_partkey AS Player_ID,
         CAST(least(90, 2 * CAST(floor(l_quantity) AS INTEGER)) AS INTEGER) AS Minutes_Played,
         CASE l_returnflag WHEN 'R' THEN 'G' WHEN 'A' THEN 'D' WHEN 'N' THEN 'F' END AS Position,
         round(l_discount * 100) AS Rating,
         CAST(NULLIF(l_linenumber % 4, 0) AS INTEGER) AS Goals_Scored,
         CAST(NULLIF(l_linenumber % 3, 0) AS INTEGER) AS Assists,
         CAST(CAST(floor(l_quantity) AS INTEGER) % 9 AS INTEGER) AS Saves,
         CAST(CAST(floor(l_quantity) AS INTEGER) % 4 AS INTEGER) AS Goals_Conceded
  FROM lineitem),
dim_players AS (
  SELECT x.Player_ID, p.p_name AS Player_Name, x.Team_ID
  FROM (SELECT l_partkey AS Player_ID, l_suppkey AS Team_ID,
               row_number() OVER (PARTITION BY l_partkey
                                  ORDER BY l_orderkey DESC, l_suppkey DESC) AS rn
        FROM lineitem) x
  JOIN part p ON p.p_partkey = x.Player_ID
  WHERE x.rn = 1)
"""


def with_proxy(body: str, extra_ctes: str = "") -> str:
    """``WITH <proxy star>[, extra] <body>``."""
    ctes = PROXY_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


# The reports are computed from two tables that the Spark side does not have:
# ``played`` with both scores of a fixture on one row, and ``appearances``
# straight from the line items.
PLAYED = """
goals AS (
  SELECT l_orderkey AS k, l_suppkey AS team, sum(CAST(floor(l_quantity) AS BIGINT)) % 5 AS g
  FROM lineitem GROUP BY ALL),
played AS (
  SELECT d.Season_ID AS season, d.League_ID AS league, d.Home_Team_ID AS home, d.Away_Team_ID AS away,
         h.g AS hg, a.g AS ag
  FROM dim_fixtures d
  JOIN goals h ON h.k = d.Fixture_ID AND h.team = d.Home_Team_ID
  JOIN goals a ON a.k = d.Fixture_ID AND a.team = d.Away_Team_ID),
outings AS (
  SELECT season, league, home AS team, TRUE AS at_home, hg AS own, ag AS other FROM played
  UNION ALL
  SELECT season, league, away, FALSE, ag, hg FROM played)"""

# One row per (team, league) of the team's country: the reference's fan-out.
COUNTRY_TEAMS = """
, used_leagues AS (SELECT DISTINCT League_ID FROM dim_fixtures),
named_teams AS (
  SELECT s.s_suppkey AS team, s.s_name AS name
  FROM supplier s JOIN nation own ON own.n_nationkey = s.s_nationkey
  LEFT JOIN (SELECT n.n_regionkey AS region FROM used_leagues u JOIN nation n ON n.n_nationkey = u.League_ID) l
    ON l.region = own.n_regionkey)"""
SINGLE_TEAMS = """
, named_teams AS (SELECT s_suppkey AS team, s_name AS name FROM supplier)"""


def standings_sql(per_league: bool, corrected: bool = False, json_star: bool = False, fanout: bool = False) -> str:
    """A team's place is one more than the number of teams with a better score."""
    lost = "own < other" if corrected else "own <= other"
    group = "season, league, " if per_league else ""
    within = "PARTITION BY season, league " if per_league else ""
    league = "CAST(league AS BIGINT)" if json_star else "league"
    return with_proxy(f"""
SELECT season AS Season_ID, {league} AS League_ID, CAST(season + 1994 AS INTEGER) AS Season_Year,
       (SELECT n_name FROM nation WHERE n_nationkey = league) AS League_Name,
       CAST(1 + better AS BIGINT) AS League_Position, name AS Team,
       pts AS League_Points, won AS Wins, drawn AS Draws, lost AS Loses, diff AS Goal_Difference,
       scored AS Goals_For, let_in AS Goals_Against, won_away AS Away_Wins, lost_home AS Home_Losses
FROM ladder JOIN scores USING ({group}pts, diff, scored)""", PLAYED + (COUNTRY_TEAMS if fanout else SINGLE_TEAMS) + f""",
record AS (
  SELECT season, league, team, name, count(*) FILTER (own > other) AS won, count(*) FILTER (own = other) AS drawn,
         count(*) FILTER ({lost}) AS lost, CAST(sum(own) AS BIGINT) AS scored, CAST(sum(other) AS BIGINT) AS let_in,
         count(*) FILTER (own > other AND NOT at_home) AS won_away, count(*) FILTER (at_home AND {lost}) AS lost_home
  FROM outings JOIN named_teams USING (team) GROUP BY season, league, team, name),
ladder AS (
  SELECT *, 3 * won + drawn AS pts, scored - let_in AS diff FROM record),
scores AS (
  SELECT {group}pts, diff, scored, coalesce(sum(count(*)) OVER (
    {within}ORDER BY pts DESC, diff DESC, scored DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS better
  FROM ladder GROUP BY {group}pts, diff, scored)""")


def home_away_sql(fanout: bool = False, json_star: bool = False) -> str:
    league = "CAST(league AS BIGINT)" if json_star else "league"

    def points(side: str) -> str:
        return f"(3 * count(*) FILTER ({side} AND own > other) + count(*) FILTER ({side} AND own = other))"
    return with_proxy(f"""
SELECT season AS Season_ID, {league} AS League_ID, name AS Team_Name,
       {points("at_home")} AS Home_Points, {points("NOT at_home")} AS Away_Points,
       CAST(coalesce(sum(own) FILTER (at_home), 0) AS BIGINT) AS Home_Goals,
       CAST(coalesce(sum(own) FILTER (NOT at_home), 0) AS BIGINT) AS Away_Goals,
       {ratio_sql(points("at_home"), "count(*)")} AS Avg_Home_Points,
       {ratio_sql(points("NOT at_home"), "count(*)")} AS Avg_Away_Points
FROM outings JOIN named_teams USING (team) GROUP BY season, league, team, name""",
                      PLAYED + (COUNTRY_TEAMS if fanout else SINGLE_TEAMS))


# -- R2, R4-R6: players from their line items; the latest one names the team ---
APPEARANCES = """
appearances AS (
  SELECT l_partkey AS player, CAST(floor(l_quantity) AS BIGINT) AS q, l_linenumber AS line,
         CAST(round(l_discount * 100) AS BIGINT) AS rating, l_returnflag AS flag, l_orderkey AS o, l_suppkey AS s
  FROM lineitem),
squad AS (
  SELECT player, p_name AS player_name, last_seen.s AS team, s_name AS team_name
  FROM (SELECT player, max({'o': o, 's': s}) AS last_seen FROM appearances GROUP BY player)
  JOIN part ON p_partkey = player JOIN supplier ON s_suppkey = last_seen.s)"""


def _best(columns: str, measures: str, where: str, order: str, least: int | None = 10) -> str:
    """The ten best players by ``order`` among those with enough appearances."""
    enough = f"WHERE n >= {least}" if least else f"WHERE {order} IS NOT NULL"
    return with_proxy(f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (ORDER BY {order} DESC NULLS LAST, player) AS place
  FROM totals JOIN squad USING (player) {enough})
WHERE place <= 10""", APPEARANCES + f""",
totals AS (SELECT player, count(*) AS n, {measures} FROM appearances WHERE {where} GROUP BY player)""")


_GOALS, _ASSISTS = "NULLIF(line % 4, 0)", "NULLIF(line % 3, 0)"

TOP_SCORERS = _best(
    "player AS Player_ID, player_name AS Player_Name, goals AS total_goals",
    f"CAST(sum({_GOALS}) AS BIGINT) AS goals", "TRUE", "goals", least=None)

CONSISTENT_PLAYERS = _best(
    "player_name AS Player_Name, team AS Team_ID, team_name AS Team_Name, n AS Matches_Played, average AS Avg_Rating",
    f"{ratio_sql('sum(rating)', 'count(*)')} AS average", "2 * q >= 60", "average")

IMPACTFUL_PLAYERS = _best(
    "player_name AS Player_Name, team_name AS Team_Name, n AS Matches_Played, goals AS Total_Goals, "
    "assists AS Total_Assists, both_ AS Goal_Contributions, average AS Avg_Goal_Contributions",
    f"CAST(sum({_GOALS}) AS BIGINT) AS goals, CAST(sum({_ASSISTS}) AS BIGINT) AS assists, "
    f"CAST(sum(line % 4 + line % 3) FILTER (line % 4 > 0 AND line % 3 > 0) AS BIGINT) AS both_, "
    + ratio_sql("sum(line % 4 + line % 3) FILTER (line % 4 > 0 AND line % 3 > 0)",
                "count(*) FILTER (line % 4 > 0 AND line % 3 > 0)") + " AS average", "TRUE", "both_")

BEST_GOALKEEPERS = _best(
    "player_name AS Player_Name, team_name AS Team_Name, n AS Matches_Played, saves AS Total_Saves, "
    "let_in AS Goals_Allowed, share AS Save_Percentage",
    "CAST(sum(q % 9) AS BIGINT) AS saves, CAST(sum(q % 4) AS BIGINT) AS let_in, "
    + ratio_sql("sum(q % 9)", "sum(q % 9) + sum(q % 4)", scale=100) + " AS share", "flag = 'R'", "share")

# -- R7 -----------------------------------------------------------------------
AGGRESSIVE_TEAMS = with_proxy(f"""
SELECT name AS Team_Name, m AS Matches_Played, f AS Total_Fouls, y AS Total_Yellows, r AS Total_Reds,
       {ratio_sql("f", "m")} AS Avg_Fouls_Per_Game, {ratio_sql("y", "m")} AS Avg_Yellows_Per_Game,
       {ratio_sql("r", "rm")} AS Avg_Reds_Per_Game
FROM (SELECT *, row_number() OVER (ORDER BY {ratio_sql("f", "m")} DESC, name) AS place FROM (
  SELECT s_name AS name, count(*) AS m, CAST(sum(n) AS BIGINT) AS f, CAST(sum(lines % 4) AS BIGINT) AS y,
         CAST(sum(lines % 7) FILTER (lines % 7 < 6) AS BIGINT) AS r, count(*) FILTER (lines % 7 < 6) AS rm
  FROM (SELECT l_orderkey AS k, l_suppkey AS team, count(*) AS n, sum(l_linenumber) AS lines
        FROM lineitem GROUP BY ALL) x
  JOIN fixture_base b ON b.Fixture_ID = x.k AND x.team IN (b.Home_Team_ID, b.Away_Team_ID)
  JOIN supplier ON s_suppkey = x.team GROUP BY s_name))
WHERE place <= 10""")


def report_oracles() -> dict[str, str]:
    return {
        "standings_global": standings_sql(per_league=False),
        "standings_per_league": standings_sql(per_league=True),
        "standings_corrected": standings_sql(per_league=True, corrected=True),
        "top_scorers": TOP_SCORERS,
        "home_away": home_away_sql(),
        "home_away_single_pass": home_away_sql(),
        "consistent_players": CONSISTENT_PLAYERS,
        "impactful_players": IMPACTFUL_PLAYERS,
        "best_goalkeepers": BEST_GOALKEEPERS,
        "aggressive_teams": AGGRESSIVE_TEAMS,
    }
