"""Registered queries for checks, incremental work, marts and single operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.coerce import TEXT_RULES
from touchline.operators import quality, reports
from touchline.operators.flatten import eav_pivot
from touchline.operators.keys import dense_key, digest_key, hash_key
from touchline.plans.marts import match_results_mart
from touchline.plans.proxy import ProxyStar
from touchline.plans.proxy_envelopes import ProxyEnvelopes
from touchline.schemas import ENDPOINT_FIXTURES, ENDPOINT_PLAYERS, ENDPOINT_STATISTICS, ENDPOINT_TEAMS
from touchline.session import scratch_path
from touchline.sources import warehouse
from touchline.sources.tables import ParquetTables
from touchline.streaming import incremental as inc
from touchline.streaming.incremental import pending, stream_table

# Event types of the driver's ``events`` table.
EVENT_TYPES = ["click", "view", "error", "purchase", "signup"]


def eav_pivot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 on the driver's event log: one row per user, max value per event type."""
    spec = [(t, f"max_{t}", (lambda v: v), "max") for t in EVENT_TYPES]
    ev = ParquetTables(spark, sf_dir).events
    return eav_pivot(ev, ["user_id"], F.col("event_type"), F.col("value"), spec)


def events_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse the JSON ``props`` column with a declared schema."""
    ev = ParquetTables(spark, sf_dir).events
    return ev.select("event_id", F.from_json("props", "k bigint").k.alias("prop_k"))


def coercion_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistic-like text values derived from line items, one shape per line number."""
    li = ParquetTables(spark, sf_dir).lineitem
    q = F.floor("l_quantity").cast("int").cast("string")
    ln = F.col("l_linenumber")
    raw = (F.when(ln == 1, F.concat(q, F.lit(".0"))).when(ln == 2, q)
           .when(ln == 3, F.concat(q, F.lit("%"))).when(ln == 4, F.concat(F.lit("-"), q))
           .when(ln == 5, F.concat(F.lit(" "), q, F.lit(" "))).when(ln == 6, F.concat(F.lit("1."), q))
           .otherwise(F.lit("n/a")))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw"))


def coerce_query(rule: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        fn = TEXT_RULES[rule]
        return coercion_input(spark, sf_dir).select(
            "l_orderkey", "l_linenumber", "raw",
            fn(F.col("raw"), True).alias(f"{rule}_strict"),
            fn(F.col("raw"), False).alias(f"{rule}_lenient"))
    return q


def surrogate_key_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense 1..n key over fact_team's natural key, without a one-task window."""
    ft = ProxyStar(spark, sf_dir).fact_team.select("Fixture_ID", "Team_ID")
    return dense_key(ft, "Team_Stat_ID", ["Fixture_ID", "Team_ID"])


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 on a real positive case: (l_orderkey, l_linenumber) is not unique."""
    li = ParquetTables(spark, sf_dir).lineitem
    return quality.pk_duplicates(li, ["l_orderkey", "l_linenumber"])


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan count per declared foreign key of the proxy star."""
    return quality.fk_report(ProxyStar(spark, sf_dir))


def pk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate key count per table of the proxy star (natural keys)."""
    star = ProxyStar(spark, sf_dir)
    keys = {"dim_seasons": ["Season_ID"], "dim_countries": ["Country_ID"],
            "dim_leagues": ["League_ID"], "dim_venues": ["Venue_ID"], "dim_teams": ["Team_ID"],
            "dim_players": ["Player_ID"], "dim_fixtures": ["Fixture_ID"],
            "fact_team": ["Fixture_ID", "Team_ID"],
            "fact_player": ["Fixture_ID", "Team_ID"]}   # not a key: a real positive case
    return quality.pk_report(star, keys)


def pending_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1-B2: announced ids (orders) not yet done (no line items), next 5."""
    t = ParquetTables(spark, sf_dir)
    announced = t.orders.select(F.col("o_orderkey").alias("Fixture_ID"))
    done = t.lineitem.select(F.col("l_orderkey").alias("Fixture_ID"))
    return pending(announced, done, batch_size=5)


def pending_backlog_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ParquetTables(spark, sf_dir)
    announced = t.orders.select(F.col("o_orderkey").alias("Fixture_ID"))
    done = t.lineitem.select(F.col("l_orderkey").alias("Fixture_ID"))
    return pending(announced, done, batch_size=None)


def stream_ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land ``events`` through a file stream (availableNow), then aggregate.

    The table and checkpoint live under the session's shared checkpoint
    folder; a second run over the same checkpoint would read nothing new.
    """
    root = scratch_path(spark, "stream-events")
    schema = ParquetTables(spark, sf_dir).events.schema.simpleString()[len("struct<"):-1] \
        .replace(":", " ")
    stream_table(spark, sf_dir, schema, f"{root}/table", f"{root}/checkpoint",
                 glob="events.parquet", partition_col="event_type")
    landed = spark.read.parquet(f"{root}/table")
    return landed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("Events"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("Value_Cents"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write fixtures and team facts as header CSV, load them back typed
    by the DDL, and report the loaded fact rows with their fixture date."""
    from touchline.sources.warehouse import read_csv_typed, write_csv, conform
    star = ProxyStar(spark, sf_dir)
    root = scratch_path(spark, "csv-roundtrip")
    write_csv(conform(star.fact_team, "fact_team"), f"{root}/fact_team")
    write_csv(conform(star.dim_fixtures, "dim_fixtures"), f"{root}/dim_fixtures")
    ft = read_csv_typed(spark, f"{root}/fact_team", "fact_team")
    fx = read_csv_typed(spark, f"{root}/dim_fixtures", "dim_fixtures")
    return ft.join(fx.select("Fixture_ID", "Match_Date", "Season_ID"), "Fixture_ID").select(
        "Fixture_ID", "Team_ID", "Goals_Scored", "Goals_Conceded", "Winner_Team", "Fouls",
        "Yellow_Cards", "Red_Cards", "Match_Date", "Season_ID")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the player facts as JSON lines and read them back with the
    declared schema."""
    from touchline.sources.warehouse import conform
    from touchline.schemas import STAR_DDL
    star = ProxyStar(spark, sf_dir)
    path = scratch_path(spark, "json-roundtrip")
    conform(star.fact_player, "fact_player").drop("Player_Stat_ID").write.json(path)
    ddl = STAR_DDL["fact_player"].split(", ", 1)[1]
    return spark.read.schema(ddl).json(path).select(
        "Fixture_ID", "Team_ID", "Player_ID", "Minutes_Played", "Position", "Rating",
        "Goals_Scored", "Assists", "Saves", "Goals_Conceded")


def _saved(spark: SparkSession, sf_dir: str) -> str:
    """The proxy star through CSV into catalog tables of a database of its own."""
    root = scratch_path(spark, "warehouse")
    database = "star_" + root.rsplit("-", 1)[1]
    warehouse.write_star_csv(ProxyStar(spark, sf_dir), f"{root}/csv")
    warehouse.load_csv_to_tables(spark, f"{root}/csv", database, f"{root}/tables")
    return database


def load_star_tables_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables through CSV and the catalog; per table the
    rows and a checksum of every column of every row, by name."""
    return warehouse.table_digests(warehouse.load_star(spark, _saved(spark, sf_dir)))


def season_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 for one season from catalog tables: one partition of the facts is read."""
    return reports.standings(warehouse.load_star(spark, _saved(spark, sf_dir), season_id=3))


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: what a load of a damaged venue export rejects."""
    s = ParquetTables(spark, sf_dir).supplier
    capacity = F.when(F.col("s_suppkey") % 7 == 0, "n/a").otherwise(F.floor(F.abs("s_acctbal")).cast("string"))
    country = F.when(F.col("s_suppkey") % 5 == 0, "12x").when(F.col("s_suppkey") % 5 == 1, F.lit(None)).otherwise("3")
    path = scratch_path(spark, "rejects")
    warehouse.write_csv(s.select(
        F.col("s_suppkey").cast("string").alias("Venue_ID"), F.concat("s_name", F.lit("\n,\"")).alias("Venue_Name"),
        country.alias("Country_ID"), capacity.alias("Capacity")), path)
    return warehouse.load_rejects(warehouse.read_csv_raw(spark, path), "dim_venues")


def surrogate_key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest key over a natural key with NULLs; the key itself is compared."""
    li = ParquetTables(spark, sf_dir).lineitem
    a = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey"))
    b = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_partkey"))
    rows = li.select(a.alias("A"), b.alias("B")).distinct()
    return hash_key(digest_key(rows, "Digest", ["A", "B"]), "Key", ["A", "B"]).select("Key", "Digest", "A", "B")


def ingest_all_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4-B5 for the four endpoints: JSON documents through file streams into tables."""
    proxy = ProxyStar(spark, sf_dir)
    docs, root = ProxyEnvelopes(proxy, defects=True), scratch_path(spark, "ingest")
    docs.stage_sides(f"{root}/sides")
    first = F.get("response", F.lit(0))
    # The proxy writes one players document per appearance, so that is its key.
    player_key = {**inc.fixture_key(), "Team_ID": first["team"]["id"],
                  "Player_ID": F.get(first["players"], F.lit(0))["player"]["id"]}
    plan = {
        ENDPOINT_FIXTURES: (inc.fixture_rows_to_upsert(proxy.dim_seasons), ["Fixture_ID"], ["Fixture_ID"]),
        ENDPOINT_TEAMS: (inc.team_rows_to_upsert(proxy.dim_countries), ["Team_ID"], ["Team_ID"]),
        ENDPOINT_PLAYERS: (lambda env: inc.player_rows_to_upsert(env, key=player_key),
                           list(player_key), list(player_key)),
        ENDPOINT_STATISTICS: (inc.statistics_rows, ["Fixture_ID", "Team_ID"], ["Fixture_ID"]),
    }
    parts = []
    for endpoint, (to_rows, keys, document) in plan.items():
        name = endpoint.replace("/", "_")
        inc.ingest_envelopes(spark, docs.land(endpoint, f"{root}/landing"), endpoint, f"{root}/{name}",
                             f"{root}/{name}_quarantine", f"{root}/{name}_checkpoint", to_rows, keys,
                             f"{keys[0]}_Range", document, glob="*.txt.gz", multiline=False)
        table = spark.read.parquet(f"{root}/{name}")
        bad = spark.read.parquet(f"{root}/{name}_quarantine")
        total = reduce(lambda x, y: x + y, [F.col(k) for k in keys])
        parts.append(table.agg(F.count(F.lit(1)).alias("Stored"), F.sum(total).alias("Key_Sum"))
                     .crossJoin(bad.agg(F.count(F.lit(1)).alias("Quarantined")))   # one row each
                     .select(F.lit(endpoint).alias("Endpoint"), "Stored", "Key_Sum", "Quarantined"))
    return reduce(DataFrame.unionAll, parts)


MORE_QUERIES = {
    "load_star_tables_roundtrip": load_star_tables_roundtrip,
    "season_standings": season_standings,
    "load_rejects": load_rejects,
    "surrogate_key_hash": surrogate_key_hash,
    "ingest_all_endpoints": ingest_all_endpoints,
    "eav_pivot_events": eav_pivot_events,
    "events_props_json": events_props_json,
    "coerce_int": coerce_query("int"),
    "coerce_pct": coerce_query("pct"),
    "coerce_dec": coerce_query("dec"),
    "surrogate_key_dense": surrogate_key_dense,
    "pk_duplicates": pk_duplicates,
    "pk_report": pk_report,
    "fk_orphans": fk_orphans,
    "pending_backlog": pending_backlog,
    "pending_backlog_all": pending_backlog_all,
    "stream_ingest_events": stream_ingest_events,
    "mart_match_results": lambda s, d: match_results_mart(ProxyStar(s, d)),
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
}
