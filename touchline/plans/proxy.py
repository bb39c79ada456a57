"""Proxy star derived from the driver's TPC-H-like tables.

The driver data is not sports data, so a league is derived from it
(definitions in FIXTURES.md section C): a fixture is an order whose line
items come from at least two suppliers; the lowest supplier key plays at
home, the highest away; a player is a part; a line item is one player's
appearance. All values are integer functions of the line items, so an
independent SQL engine can recompute them exactly.

Plan shape, chosen for scale and hot keys:
  * every per-order or per-part reduction is a ``groupBy`` with map-side
    partial aggregation, so an order or part holding a third of all rows
    is reduced before the shuffle;
  * the two sides of a fixture come from one scan: an aggregate per (order,
    supplier), then one per order that keeps the sums of the lowest and the
    highest supplier in fixed-width columns, then ``inline`` of a two-element
    array. No self-join and no window. The rows per (order, supplier) are dealt
    by order before the second aggregate: its wide buffers then hold the orders
    of one partition, not those of every row that was dealt by supplier too.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.tables import ParquetTables

# Fixed values of the proxy (FIXTURES.md section C).
SEASON_YEAR_OFFSET = 1994          # Season_ID = year - 1994
POSITION_BY_RETURNFLAG = {"R": "G", "A": "D", "N": "F"}


def _int(c: Column) -> Column:
    return c.cast("int")


def _qty() -> Column:
    # l_quantity is an integral double (1..50); floor keeps both engines equal.
    return F.floor(F.col("l_quantity")).cast("int")


class ProxyStar:
    """Lazy star: each table is planned on first access only."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = ParquetTables(spark, sf_dir)

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def dim_seasons(self) -> DataFrame:
        year = F.year("o_orderdate")
        return (self.t.orders.select(year.alias("Season_Year")).distinct()
                .select(_int(F.col("Season_Year") - SEASON_YEAR_OFFSET).alias("Season_ID"),
                        _int(F.col("Season_Year")).alias("Season_Year")))

    @cached_property
    def dim_countries(self) -> DataFrame:
        return self.t.region.select(F.col("r_regionkey").alias("Country_ID"),
                                    F.col("r_name").alias("Country_Name"))

    @cached_property
    def dim_leagues(self) -> DataFrame:
        return self.t.nation.select(
            F.col("n_nationkey").alias("League_ID"), F.col("n_name").alias("League_Name"),
            F.col("n_regionkey").alias("Country_ID"),
            F.concat(F.lit("logos/league/"), F.col("n_nationkey").cast("string"), F.lit(".png"))
            .alias("League_Logo"))

    @cached_property
    def dim_venues(self) -> DataFrame:
        s, n = self.t.supplier, self.t.nation
        return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .select(F.col("s_suppkey").alias("Venue_ID"), F.col("s_name").alias("Venue_Name"),
                        F.col("n_name").alias("City"), F.col("n_regionkey").alias("Country_ID"),
                        _int(F.floor(F.abs("s_acctbal"))).alias("Capacity")))

    @cached_property
    def dim_teams(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("Team_ID"), F.col("s_name").alias("Team_Name"),
            F.col("s_nationkey").alias("League_ID"), F.col("s_suppkey").alias("Home_Venue_ID"),
            F.concat(F.lit("logos/team/"), F.col("s_suppkey").cast("string"), F.lit(".png"))
            .alias("Team_Logo"))

    @cached_property
    def dim_players(self) -> DataFrame:
        # Latest appearance wins. (Fixture_ID, Team_ID) packed into one decimal
        # is a fixed-width maximum: a hash aggregate, no sort.
        packed = F.col("l_orderkey").cast("decimal(19,0)") * F.lit(10 ** 18).cast("decimal(19,0)") \
            + F.col("l_suppkey").cast("decimal(18,0)")
        latest = (self.t.lineitem.groupBy(F.col("l_partkey").alias("Player_ID"))
                  .agg(F.max(packed.cast("decimal(38,0)")).alias("m"))
                  .select("Player_ID", F.pmod("m", F.lit(10 ** 18).cast("decimal(38,0)")).cast("long").alias("Team_ID")))
        part = self.t.part.select(F.col("p_partkey").alias("Player_ID"),
                                  F.col("p_name").alias("Player_Name"))
        return latest.join(part, "Player_ID").select("Player_ID", "Player_Name", "Team_ID")

    @cached_property
    def fixture_base(self) -> DataFrame:
        return (self.t.lineitem.groupBy(F.col("l_orderkey").alias("Fixture_ID"))
                .agg(F.min("l_suppkey").alias("Home_Team_ID"), F.max("l_suppkey").alias("Away_Team_ID"))
                .where(F.col("Home_Team_ID") != F.col("Away_Team_ID")))

    @cached_property
    def dim_fixtures(self) -> DataFrame:
        o = self.t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.t.customer.select("c_custkey", "c_nationkey")
        f = self.fixture_base
        return (f.join(o, f.Fixture_ID == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
                .select("Fixture_ID", F.col("c_nationkey").alias("League_ID"),
                        _int(F.year("o_orderdate") - SEASON_YEAR_OFFSET).alias("Season_ID"),
                        "Home_Team_ID", "Away_Team_ID", F.col("Home_Team_ID").alias("Venue_ID"),
                        F.col("o_orderdate").alias("Match_Date"),
                        F.to_timestamp_ntz(F.concat(F.lit("1970-01-01 "),
                                                F.date_format("o_orderdate", "HH:mm:ss")))
                        .alias("Match_Time")))

    # -- facts --------------------------------------------------------------
    @cached_property
    def fixture_sides(self) -> DataFrame:
        """One row per fixture: both team ids and their counters (h_ and a_)."""
        team = F.col("l_suppkey")
        per_team = (self.t.lineitem
                    .groupBy(F.col("l_orderkey").alias("Fixture_ID"), team.alias("team"))
                    .agg(F.sum(_qty().cast("long")).alias("qty"), F.count(F.lit(1)).alias("n"),
                         F.sum(F.col("l_linenumber").cast("long")).alias("lines")))
        # A long by a long is fixed-width, so this stays a hash aggregate.
        aggs = [F.min("team").alias("Home_Team_ID"), F.max("team").alias("Away_Team_ID")]
        for c in ("qty", "n", "lines"):
            aggs += [F.min_by(c, "team").alias(f"h_{c}"), F.max_by(c, "team").alias(f"a_{c}")]
        return per_team.repartition("Fixture_ID").groupBy("Fixture_ID").agg(*aggs).where(F.col("Home_Team_ID") != F.col("Away_Team_ID"))

    @cached_property
    def fact_team(self) -> DataFrame:
        def side(own: str, other: str, team: str) -> Column:
            goals, conceded = _int(F.col(f"{own}_qty") % 5), _int(F.col(f"{other}_qty") % 5)
            lines = F.col(f"{own}_lines")
            return F.struct(F.col(team).alias("Team_ID"), goals.alias("Goals_Scored"),
                            conceded.alias("Goals_Conceded"), (goals > conceded).alias("Winner_Team"),
                            _int(F.col(f"{own}_n")).alias("Fouls"), _int(lines % 4).alias("Yellow_Cards"),
                            _int(F.nullif(lines % 7, F.lit(6))).alias("Red_Cards"))
        return self.fixture_sides.select("Fixture_ID", F.inline(F.array(
            side("h", "a", "Home_Team_ID"), side("a", "h", "Away_Team_ID"))))

    @cached_property
    def fact_player(self) -> DataFrame:
        q = _qty()
        position = None
        for flag, pos in POSITION_BY_RETURNFLAG.items():
            cond = F.col("l_returnflag") == flag
            position = F.when(cond, pos) if position is None else position.when(cond, pos)
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("Fixture_ID"), F.col("l_suppkey").alias("Team_ID"),
            F.col("l_partkey").alias("Player_ID"),
            _int(F.least(F.lit(90), q * 2)).alias("Minutes_Played"),
            position.alias("Position"),
            F.round(F.col("l_discount") * 100).alias("Rating"),
            _int(F.nullif(F.col("l_linenumber") % 4, F.lit(0))).alias("Goals_Scored"),
            _int(F.nullif(F.col("l_linenumber") % 3, F.lit(0))).alias("Assists"),
            _int(q % 9).alias("Saves"),
            _int(q % 4).alias("Goals_Conceded"))
