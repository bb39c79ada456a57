"""DuckDB oracles for ``more_queries``."""

from __future__ import annotations

from touchline.plans.oracles import standings_sql, with_proxy
from touchline.schemas import STAR_DDL

EAV_PIVOT_EVENTS = """
SELECT user_id, max(value) FILTER (event_type = 'click') AS max_click,
       max(value) FILTER (event_type = 'view') AS max_view, max(value) FILTER (event_type = 'error') AS max_error,
       max(value) FILTER (event_type = 'purchase') AS max_purchase,
       max(value) FILTER (event_type = 'signup') AS max_signup
FROM events GROUP BY user_id"""

EVENTS_PROPS_JSON = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k FROM events"

_SRC = r"""
WITH src AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR) AS q
  FROM lineitem),
raw AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber WHEN 1 THEN q || '.0' WHEN 2 THEN q WHEN 3 THEN q || '%'
      WHEN 4 THEN '-' || q WHEN 5 THEN ' ' || q || ' ' WHEN 6 THEN '1.' || q ELSE 'n/a' END AS raw
  FROM src)
"""
# A plain cast that is not strict: '12.0' is 12, '-3.7' is -3, 'n/a' is NULL.
_INT_LENIENT = "CAST(trunc(TRY_CAST(trim({x}) AS DOUBLE)) AS INTEGER)"

COERCE_INT = _SRC + r"""
SELECT l_orderkey, l_linenumber, raw,
  CASE WHEN regexp_full_match(raw, '\d+') THEN CAST(raw AS INTEGER) END AS int_strict,
  """ + _INT_LENIENT.format(x="raw") + """ AS int_lenient
FROM raw"""

COERCE_PCT = _SRC + r"""
SELECT l_orderkey, l_linenumber, raw,
  CASE WHEN regexp_full_match(raw, '\d+%') THEN CAST(replace(raw, '%', '') AS INTEGER) END AS pct_strict,
  """ + _INT_LENIENT.format(x="replace(raw, '%', '')") + """ AS pct_lenient
FROM raw"""

COERCE_DEC = _SRC + r"""
SELECT l_orderkey, l_linenumber, raw,
  CASE WHEN regexp_full_match(raw, '\d+\.\d+') THEN CAST(raw AS DOUBLE) END AS dec_strict,
  CASE WHEN regexp_full_match(trim(raw), '[+-]?\d+(\.\d+)?') THEN CAST(trim(raw) AS DOUBLE) END
    AS dec_lenient
FROM raw"""

SURROGATE_KEY_DENSE = with_proxy("""
SELECT CAST(row_number() OVER (ORDER BY Fixture_ID, Team_ID) AS BIGINT) AS Team_Stat_ID,
       Fixture_ID, Team_ID
FROM fact_team""")

PK_DUPLICATES = """
SELECT l_orderkey, l_linenumber, count(*) AS Duplicates
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

_PK_KEYS = {"dim_seasons": "Season_ID", "dim_countries": "Country_ID", "dim_leagues": "League_ID",
            "dim_venues": "Venue_ID", "dim_teams": "Team_ID", "dim_players": "Player_ID",
            "dim_fixtures": "Fixture_ID", "fact_team": "Fixture_ID, Team_ID",
            "fact_player": "Fixture_ID, Team_ID"}   # not a key: one row per player
PK_REPORT = with_proxy("\nUNION ALL\n".join(
    f"SELECT '{t}' AS Table_Name, (SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)) "
    f"AS Duplicate_Keys" for t, k in _PK_KEYS.items()))

_REFERENCES = """
dim_leagues.Country_ID dim_countries.Country_ID
dim_venues.Country_ID dim_countries.Country_ID
dim_teams.League_ID dim_leagues.League_ID
dim_teams.Home_Venue_ID dim_venues.Venue_ID
dim_players.Team_ID dim_teams.Team_ID
dim_fixtures.League_ID dim_leagues.League_ID
dim_fixtures.Season_ID dim_seasons.Season_ID
dim_fixtures.Home_Team_ID dim_teams.Team_ID
dim_fixtures.Away_Team_ID dim_teams.Team_ID
dim_fixtures.Venue_ID dim_venues.Venue_ID
fact_player.Fixture_ID dim_fixtures.Fixture_ID
fact_player.Team_ID dim_teams.Team_ID
fact_player.Player_ID dim_players.Player_ID
fact_team.Fixture_ID dim_fixtures.Fixture_ID
fact_team.Team_ID dim_teams.Team_ID
"""
FK_ORPHANS = with_proxy("\nUNION ALL\n".join(
    f"SELECT '{c}' AS Child_Table, '{col}' AS Child_Column, '{p}' AS Parent_Table, "
    f"(SELECT count(*) FROM {c} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {p} y WHERE y.{pcol} = x.{col})) AS Orphan_Rows"
    for (c, col), (p, pcol) in ([x.split(".") for x in line.split()] for line in _REFERENCES.strip().splitlines())))

PENDING_ALL = """
SELECT o_orderkey AS Fixture_ID FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
PENDING_BACKLOG = PENDING_ALL + "\nORDER BY Fixture_ID LIMIT 5"

STREAM_INGEST_EVENTS = """
SELECT event_type, count(*) AS Events,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS Value_Cents
FROM events GROUP BY event_type"""

MART_MATCH_RESULTS = with_proxy("""
SELECT f.Fixture_ID, f.Season_ID, f.League_ID, f.Match_Date, th.Team_Name AS Home_Team,
       ta.Team_Name AS Away_Team, h.Goals_Scored AS Home_Goals, a.Goals_Scored AS Away_Goals,
       CASE WHEN h.Goals_Scored > a.Goals_Scored THEN 'H' WHEN h.Goals_Scored < a.Goals_Scored THEN 'A'
            WHEN h.Goals_Scored = a.Goals_Scored THEN 'D' END AS Result
FROM dim_fixtures f
JOIN fact_team h ON h.Fixture_ID = f.Fixture_ID AND h.Team_ID = f.Home_Team_ID
JOIN fact_team a ON a.Fixture_ID = f.Fixture_ID AND a.Team_ID = f.Away_Team_ID
LEFT JOIN dim_teams th ON th.Team_ID = f.Home_Team_ID
LEFT JOIN dim_teams ta ON ta.Team_ID = f.Away_Team_ID""")


CSV_ROUNDTRIP = with_proxy("""
SELECT ft.Fixture_ID, ft.Team_ID, ft.Goals_Scored, ft.Goals_Conceded, ft.Winner_Team, ft.Fouls,
       ft.Yellow_Cards, ft.Red_Cards, f.Match_Date, f.Season_ID
FROM fact_team ft JOIN dim_fixtures f ON f.Fixture_ID = ft.Fixture_ID""")

JSON_ROUNDTRIP = with_proxy("""
SELECT Fixture_ID, Team_ID, Player_ID, Minutes_Played, Position, Rating, Goals_Scored, Assists,
       Saves, Goals_Conceded
FROM fact_player""")


# Every column of each table by name; those that the proxy lacks are NULL.
_HELD = {"fact_player": "Fixture_ID Team_ID Player_ID Minutes_Played Position Rating Goals_Scored Assists Saves Goals_Conceded",
         "fact_team": "Fixture_ID Team_ID Goals_Scored Goals_Conceded Winner_Team Fouls Yellow_Cards Red_Cards"}


def _row_text(table: str) -> str:
    out = []
    for name, kind in (c.strip().split(" ") for c in STAR_DDL[table].split(",")):
        if name not in _HELD.get(table, name).split():
            value = "'-'"
        elif kind == "double":
            value = f"coalesce(CAST(CAST(round({name} * 100) AS BIGINT) AS VARCHAR), '-')"
        elif kind == "timestamp":
            value = f"coalesce(CAST(CAST(epoch(CAST({name} AS TIMESTAMP)) AS BIGINT) AS VARCHAR), '-')"
        else:
            value = f"coalesce(CAST({name} AS VARCHAR), '-')"
        out.append(f"'{name}=' || {value} || ';'")
    return " || ".join(out)


LOAD_STAR_TABLES = with_proxy("\nUNION ALL\n".join(
    f"SELECT '{t}' AS Table_Name, count(*) AS Row_Count, "
    f"CAST(sum(CAST('0x' || substr(md5({_row_text(t)}), 1, 8) AS BIGINT)) AS BIGINT) AS Checksum FROM {t}"
    for t in STAR_DDL))

SEASON_STANDINGS = f"SELECT * FROM ({standings_sql(per_league=True, json_star=True)}) WHERE Season_ID = 3"

LOAD_REJECTS = """
SELECT * FROM (
  SELECT 'Venue_ID' AS Column_Name, count(*) AS Rows, 0 AS Rejected, FALSE AS Missing FROM supplier
  UNION ALL SELECT 'Venue_Name', count(*), 0, FALSE FROM supplier
  UNION ALL SELECT 'City', count(*), 0, TRUE FROM supplier
  UNION ALL SELECT 'Country_ID', count(*), count(*) FILTER (s_suppkey % 5 = 0), FALSE FROM supplier
  UNION ALL SELECT 'Capacity', count(*), count(*) FILTER (s_suppkey % 7 = 0), FALSE FROM supplier)"""

SURROGATE_KEY_HASH = """
SELECT DISTINCT CAST(('0x' || substr(d, 1, 16))::UBIGINT // 2 AS BIGINT) AS Key, d AS Digest, A, B FROM (
  SELECT A, B, sha256(coalesce(length(A::VARCHAR) || ':' || A::VARCHAR, '-') || ','
                      || coalesce(length(B::VARCHAR) || ':' || B::VARCHAR, '-')) AS d
  FROM (SELECT CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS A,
               CASE WHEN l_linenumber % 2 = 1 THEN l_partkey END AS B FROM lineitem))"""

INGEST_ALL = with_proxy("""
SELECT 'fixtures' AS Endpoint, count(*) AS Stored, CAST(sum(Fixture_ID) AS BIGINT) AS Key_Sum, 0 AS Quarantined
FROM dim_fixtures
UNION ALL SELECT 'teams', count(*), CAST(sum(s_suppkey) AS BIGINT), 0 FROM supplier
UNION ALL SELECT 'fixtures/players', count(*), CAST(sum(l_orderkey + l_suppkey + l_partkey) AS BIGINT), 0
FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey)
UNION ALL
SELECT 'fixtures/statistics', count(*) FILTER (bad = 0), CAST(sum(Fixture_ID + Team_ID) FILTER (bad = 0) AS BIGINT),
       count(*) FILTER (bad = 1) // 2
FROM (SELECT Fixture_ID, Team_ID, max(CASE WHEN at_home AND total % 101 IN (1, 2, 3) THEN 1 ELSE 0 END)
             OVER (PARTITION BY Fixture_ID) AS bad
      FROM (SELECT b.Fixture_ID, l_suppkey AS Team_ID, l_suppkey = b.Home_Team_ID AS at_home,
                   sum(CAST(floor(l_quantity) AS BIGINT)) AS total
            FROM lineitem JOIN fixture_base b ON b.Fixture_ID = l_orderkey AND l_suppkey IN (b.Home_Team_ID, b.Away_Team_ID)
            GROUP BY ALL))""")


def more_oracles() -> dict[str, str]:
    return {
        "load_star_tables_roundtrip": LOAD_STAR_TABLES,
        "season_standings": SEASON_STANDINGS,
        "load_rejects": LOAD_REJECTS,
        "surrogate_key_hash": SURROGATE_KEY_HASH,
        "ingest_all_endpoints": INGEST_ALL,
        "eav_pivot_events": EAV_PIVOT_EVENTS,
        "events_props_json": EVENTS_PROPS_JSON,
        "coerce_int": COERCE_INT,
        "coerce_pct": COERCE_PCT,
        "coerce_dec": COERCE_DEC,
        "surrogate_key_dense": SURROGATE_KEY_DENSE,
        "pk_duplicates": PK_DUPLICATES,
        "pk_report": PK_REPORT,
        "fk_orphans": FK_ORPHANS,
        "pending_backlog": PENDING_BACKLOG,
        "pending_backlog_all": PENDING_ALL,
        "stream_ingest_events": STREAM_INGEST_EVENTS,
        "mart_match_results": MART_MATCH_RESULTS,
        "csv_roundtrip": CSV_ROUNDTRIP,
        "json_roundtrip": JSON_ROUNDTRIP,
    }
