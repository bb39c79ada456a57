"""Declared schemas: raw API envelopes per endpoint and the star tables.

Reading with a declared schema avoids an inference pass and keeps column
types stable when a batch happens to lack a field. Scalar statistics of a
player are read as strings and converted with ``try_cast`` (what the
reference does with ``cast``, but ANSI-safe). A team statistic's ``value``
is an int, a string or null in the API, so it is read as ``variant``,
which keeps a JSON number apart from a JSON string.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (API endpoint names, API
# field paths, statistic type labels, warehouse column names).
# ---------------------------------------------------------------------------
ENDPOINT_FIXTURES = "fixtures"
ENDPOINT_TEAMS = "teams"
ENDPOINT_PLAYERS = "fixtures/players"
ENDPOINT_STATISTICS = "fixtures/statistics"
ENDPOINTS = (ENDPOINT_FIXTURES, ENDPOINT_TEAMS, ENDPOINT_PLAYERS, ENDPOINT_STATISTICS)

# Player statistics: (warehouse column, path inside statistics[0], type).
# "commited" is the API's spelling.
PLAYER_STAT_FIELDS = [
    ("Minutes_Played", "games.minutes", "int"),
    ("Position", "games.position", "string"),
    ("Rating", "games.rating", "double"),
    ("Substitute", "games.substitute", "boolean"),
    ("Goals_Scored", "goals.total", "int"),
    ("Goals_Conceded", "goals.conceded", "int"),
    ("Assists", "goals.assists", "int"),
    ("Saves", "goals.saves", "int"),
    ("Passes", "passes.total", "int"),
    ("Passes_Key", "passes.key", "int"),
    ("Pass_Accuracy", "passes.accuracy", "double"),
    ("Yellow_Cards", "cards.yellow", "int"),
    ("Red_Cards", "cards.red", "int"),
    ("Shots", "shots.total", "int"),
    ("Shots_On_Target", "shots.on", "int"),
    ("Tackles", "tackles.total", "int"),
    ("Blocks", "tackles.blocks", "int"),
    ("Interceptions", "tackles.interceptions", "int"),
    ("Duels", "duels.total", "int"),
    ("Duels_Won", "duels.won", "int"),
    ("Dribbles_Attempted", "dribbles.attempts", "int"),
    ("Dribbles_Success", "dribbles.success", "int"),
    ("Dribbled_Past", "dribbles.past", "int"),
    ("Fouls_Committed", "fouls.committed", "int"),
    ("Fouls_Drawn", "fouls.drawn", "int"),
    ("Penalty_Scored", "penalty.scored", "int"),
    ("Penalty_Missed", "penalty.missed", "int"),
    ("Penalty_Saved", "penalty.saved", "int"),
    ("Penalty_Won", "penalty.won", "int"),
    ("Penalty_Committed", "penalty.commited", "int"),
    ("Offside", "offsides", "int"),
]

# Team statistics, entity-attribute-value: (API type label, warehouse
# column, coercion rule, aggregate). Rules: int = integer or digit string,
# pct = "<digits>%", dec = "<digits>.<digits>".
TEAM_STAT_FIELDS = [
    ("Shots on Goal", "Shots_On_Target", "int", "max"),
    ("Shots off Goal", "Shots_Off_Target", "int", "max"),
    ("Total Shots", "Total_Shots", "int", "max"),
    ("Blocked Shots", "Blocked_Shots", "int", "max"),
    ("Shots insidebox", "Shots_Inside_Box", "int", "max"),
    ("Shots outsidebox", "Shots_Outside_Box", "int", "max"),
    ("Fouls", "Fouls", "int", "max"),
    ("Corner Kicks", "Corner_Kicks", "int", "max"),
    ("Offsides", "Offsides", "int", "max"),
    ("Ball Possession", "Possession_Percentage", "pct", "avg"),
    ("Yellow Cards", "Yellow_Cards", "int", "max"),
    ("Red Cards", "Red_Cards", "int", "max"),
    ("Goalkeeper Saves", "Goalkeeper_Saves", "int", "max"),
    ("Total passes", "Total_Passes", "int", "max"),
    ("Passes accurate", "Passes_Accurate", "int", "max"),
    ("Passes %", "Passes_Percentage", "pct", "avg"),
    ("expected_goals", "Expected_Goals", "dec", "max"),
]

# Seed dimensions: (year, id) and (country, id).
SEASON_SEED = [(2021, 1), (2022, 2), (2023, 3), (2024, 4), (2025, 5)]
COUNTRY_SEED = [("England", 1), ("Spain", 2), ("Germany", 3), ("Italy", 4), ("France", 5)]


# ---------------------------------------------------------------------------
# Endpoint element schemas (DDL strings keep the nesting readable).
# ---------------------------------------------------------------------------
def _player_stat_struct() -> str:
    groups: dict[str, list[str]] = {}
    top: list[str] = []
    for _, path, _ in PLAYER_STAT_FIELDS:
        if "." in path:
            g, leaf = path.split(".", 1)
            groups.setdefault(g, []).append(leaf)
        else:
            top.append(path)
    parts = [f"{leaf}: string" for leaf in top]
    parts += [f"{g}: struct<{', '.join(f'{leaf}: string' for leaf in leaves)}>"
              for g, leaves in groups.items()]
    return f"struct<{', '.join(parts)}>"


FIXTURE_ELEMENT = (
    "struct<fixture: struct<id: bigint, date: string, "
    "venue: struct<id: bigint, name: string, city: string>, status: struct<short: string>>, "
    "league: struct<id: bigint, name: string, country: string, logo: string, season: bigint>, "
    "teams: struct<home: struct<id: bigint, name: string, winner: boolean>, "
    "away: struct<id: bigint, name: string, winner: boolean>>, "
    "goals: struct<home: bigint, away: bigint>>"
)
TEAM_ELEMENT = (
    "struct<team: struct<id: bigint, name: string, logo: string, country: string>, "
    "venue: struct<id: bigint, name: string, city: string, capacity: bigint>>"
)
PLAYERS_ELEMENT = (
    "struct<team: struct<id: bigint, name: string>, "
    f"players: array<struct<player: struct<id: bigint, name: string>, "
    f"statistics: array<{_player_stat_struct()}>>>>"
)
STATISTICS_ELEMENT = (
    "struct<team: struct<id: bigint, name: string>, "
    "statistics: array<struct<type: string, value: variant>>>"
)
ELEMENTS = {
    ENDPOINT_FIXTURES: FIXTURE_ELEMENT,
    ENDPOINT_TEAMS: TEAM_ELEMENT,
    ENDPOINT_PLAYERS: PLAYERS_ELEMENT,
    ENDPOINT_STATISTICS: STATISTICS_ELEMENT,
}
PARAMETERS = "struct<fixture: string, league: string, season: string, team: string>"
CORRUPT_COLUMN = "_corrupt_record"


def envelope_ddl(endpoint: str, with_corrupt: bool = False) -> str:
    """Column-list DDL of one envelope, for ``read.schema`` and ``from_json``."""
    cols = ["get string", f"parameters {PARAMETERS}", "results bigint",
            f"response array<{ELEMENTS[endpoint]}>"]
    if with_corrupt:
        cols.append(f"{CORRUPT_COLUMN} string")
    return ", ".join(cols)


# ---------------------------------------------------------------------------
# Star tables (warehouse DDL order and names; ids as long).
# ---------------------------------------------------------------------------
STAR_DDL = {
    "dim_seasons": "Season_ID int, Season_Year int",
    "dim_countries": "Country_ID int, Country_Name string",
    "dim_leagues": "League_ID long, League_Name string, Country_ID int, League_Logo string",
    "dim_venues": "Venue_ID long, Venue_Name string, City string, Country_ID int, Capacity int",
    "dim_teams": "Team_ID long, Team_Name string, League_ID long, Home_Venue_ID long, "
                 "Team_Logo string",
    "dim_players": "Player_ID long, Player_Name string, Team_ID long",
    "dim_fixtures": "Fixture_ID long, League_ID long, Season_ID int, Home_Team_ID long, "
                    "Away_Team_ID long, Venue_ID long, Match_Date timestamp, Match_Time timestamp",
    "fact_player": "Player_Stat_ID long, Fixture_ID long, Team_ID long, Player_ID long, "
                   + ", ".join(f"{c} {t}" for c, _, t in PLAYER_STAT_FIELDS),
    "fact_team": "Team_Stat_ID long, Fixture_ID long, Team_ID long, Goals_Scored int, "
                 "Goals_Conceded int, Winner_Team boolean, "
                 + ", ".join(f"{c} {'double' if agg == 'avg' or rule == 'dec' else 'int'}"
                             for _, c, rule, agg in TEAM_STAT_FIELDS),
}

# Primary keys and foreign keys of the warehouse DDL (checked, not enforced).
PRIMARY_KEYS = {
    "dim_seasons": ["Season_ID"], "dim_countries": ["Country_ID"], "dim_leagues": ["League_ID"],
    "dim_venues": ["Venue_ID"], "dim_teams": ["Team_ID"], "dim_players": ["Player_ID"],
    "dim_fixtures": ["Fixture_ID"], "fact_player": ["Player_Stat_ID"],
    "fact_team": ["Team_Stat_ID"],
}
FOREIGN_KEYS = [
    ("dim_leagues", "Country_ID", "dim_countries", "Country_ID"),
    ("dim_venues", "Country_ID", "dim_countries", "Country_ID"),
    ("dim_teams", "League_ID", "dim_leagues", "League_ID"),
    ("dim_teams", "Home_Venue_ID", "dim_venues", "Venue_ID"),
    ("dim_players", "Team_ID", "dim_teams", "Team_ID"),
    ("dim_fixtures", "League_ID", "dim_leagues", "League_ID"),
    ("dim_fixtures", "Season_ID", "dim_seasons", "Season_ID"),
    ("dim_fixtures", "Home_Team_ID", "dim_teams", "Team_ID"),
    ("dim_fixtures", "Away_Team_ID", "dim_teams", "Team_ID"),
    ("dim_fixtures", "Venue_ID", "dim_venues", "Venue_ID"),
    ("fact_player", "Fixture_ID", "dim_fixtures", "Fixture_ID"),
    ("fact_player", "Team_ID", "dim_teams", "Team_ID"),
    ("fact_player", "Player_ID", "dim_players", "Player_ID"),
    ("fact_team", "Fixture_ID", "dim_fixtures", "Fixture_ID"),
    ("fact_team", "Team_ID", "dim_teams", "Team_ID"),
]


def star_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(STAR_DDL[name])
