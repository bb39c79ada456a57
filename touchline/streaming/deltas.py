"""Team and player marts kept by signed deltas.

The sums behind the league table, the home/away and the discipline report
(``TEAM``) and behind the four player reports (``PLAYER``) can be undone: when a document is sent again, what its old rows put in
is subtracted and what its new rows put in is added. A batch then costs what
it touches, not a season.

Two tables, both append-only and partitioned by epoch (one batch):

* ``rows``: the fact rows of every fixture in the batch, whole (a fixture that
  now has none leaves one row without a team or player), by ranges of fixture ids;
* ``deltas``: the signed sums of the batch per (season, league, team) or per player.

Nothing is overwritten in place. A batch reads the newest earlier rows of its
own fixtures only: the epochs before it and the ranges it touches are
partition filters, the fixtures a semi-join. The deltas are written last, so
an epoch without them does not count yet. A replayed epoch writes the same rows and
deltas again over its own folders, so it changes nothing. The marts are the
sum of all deltas, a few rows per key and epoch; ``compact`` folds the epochs
up to one into a single one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import reports
from touchline.operators.reports import _flag

EPOCH, RANGE = "_epoch", "Fixture_ID_Range"


@dataclass(frozen=True)
class Mart:
    """Sums that are kept per key."""
    #: columns of a row, the document's Fixture_ID among them
    ddl: str
    keys: tuple[str, ...]
    #: what one row adds to its key, exact numbers: all of them can be subtracted again
    measures: Callable[[], dict[str, Column]]
    #: measures that can be NULL; their count of values is kept, so that a sum of nothing is NULL again
    nullable: tuple[str, ...]
    #: column without which a row adds nothing
    who: str
    #: measures that are not whole numbers
    decimals: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [c.strip().split(" ")[0] for c in self.ddl.split(",")]

    @property
    def stored(self) -> str:
        return f"{self.ddl}, {EPOCH} int, {RANGE} long"


def _team_measures() -> dict[str, Column]:
    win = F.col("Winner_Team") == F.lit(True)
    loss = F.col("Winner_Team") == F.lit(False)
    draw = F.col("Goals_Scored") == F.col("Goals_Conceded")
    points = F.when(win, 3).when(draw, 1).otherwise(0)
    out = {"Matches": F.lit(1), "League_Points": points, "Wins": _flag(win), "Draws": _flag(draw), "Loses": _flag(loss)}
    for side in ("Home", "Away"):
        own = F.col(f"{side}_Team_ID") == F.col("Team_ID")
        out[f"{side}_Points"] = F.when(own, points).otherwise(0)
        # NULL where the side's goals are unknown, 0 where the match was the other side's.
        out[f"{side}_Goals"] = F.when(own, F.col("Goals_Scored")).otherwise(0)
        out[f"{side}_Wins"] = _flag(own & win)
        out[f"{side}_Losses"] = _flag(own & loss)
    for name in ("Goals_Scored", "Goals_Conceded", "Fouls", "Yellow_Cards", "Red_Cards"):
        out[name] = F.col(name)
    return out


TEAM = Mart(
    "Fixture_ID long, Season_ID int, League_ID long, Home_Team_ID long, Away_Team_ID long, Team_ID long, "
    "Goals_Scored int, Goals_Conceded int, Winner_Team boolean, Fouls int, Yellow_Cards int, Red_Cards int",
    ("Season_ID", "League_ID", "Team_ID"), _team_measures,
    ("Home_Goals", "Away_Goals", "Goals_Scored", "Goals_Conceded", "Fouls", "Yellow_Cards", "Red_Cards"), "Team_ID")

#: Minutes of a regular starter.
REGULAR = 60


def _player_measures() -> dict[str, Column]:
    regular, keeper = F.col("Minutes_Played") >= REGULAR, F.col("Position") == "G"
    return {"Matches": F.lit(1), "Regular_Matches": _flag(regular), "Rating": F.when(regular, F.col("Rating")),
            "Goals": F.col("Goals_Scored"), "Assists": F.col("Assists"),
            "Contributions": F.col("Goals_Scored") + F.col("Assists"), "Keeper_Matches": _flag(keeper),
            "Saves": F.when(keeper, F.col("Saves")), "Allowed": F.when(keeper, F.col("Goals_Conceded")),
            "Faced": F.when(keeper, F.col("Saves") + F.col("Goals_Conceded"))}


PLAYER = Mart(
    "Fixture_ID long, Player_ID long, Minutes_Played int, Position string, Rating double, Goals_Scored int, "
    "Assists int, Saves int, Goals_Conceded int",
    ("Player_ID",), _player_measures, ("Rating", "Goals", "Assists", "Contributions", "Saves", "Allowed", "Faced"),
    "Player_ID", ("Rating",))


def signed_sums(rows: DataFrame, sign: Column, mart: Mart = TEAM) -> DataFrame:
    """Signed sums of the measures per key; ``sign`` is a condition: whether a row is added."""
    aggs = []
    for name, value in mart.measures().items():
        kind = "decimal(28,6)" if name in mart.decimals else "long"   # exact, so that it can be undone
        number = F.coalesce(value.cast(kind), F.lit(0).cast(kind))
        aggs.append(F.sum(F.when(sign, number).otherwise(-number)).alias(name))
        if name in mart.nullable:
            held = value.isNotNull().cast("long")
            aggs.append(F.sum(F.when(sign, held).otherwise(-held)).alias(f"{name}_n"))
    return rows.where(F.col(mart.who).isNotNull()).groupBy(*mart.keys).agg(*aggs)


def team_rows(star) -> DataFrame:
    """Fact rows with what the marts need of their fixture."""
    f = star.dim_fixtures.select("Fixture_ID", "Season_ID", "League_ID", "Home_Team_ID", "Away_Team_ID")
    return star.fact_team.join(f, "Fixture_ID").select(*TEAM.columns)


def player_rows(star) -> DataFrame:
    """Appearances with what the player marts need."""
    return star.fact_player.select(*PLAYER.columns)


def _paths(root: str) -> tuple[str, str]:
    return f"{root.rstrip('/')}/rows", f"{root.rstrip('/')}/deltas"


def earlier_rows(spark: SparkSession, root: str, touched: DataFrame, ranges: list, epoch: int,
                 mart: Mart = TEAM) -> DataFrame:
    """The newest rows before ``epoch`` of the touched fixtures.

    Only their ranges of ids are read: ``ranges`` is a list bounded by the
    number of ranges, pushed to the scan as a partition filter.
    """
    stored = (spark.read.schema(mart.stored).parquet(_paths(root)[0])
              .where((F.col(EPOCH) < epoch) & F.col(RANGE).isin(ranges)).join(touched, "Fixture_ID", "left_semi"))
    newest = stored.groupBy("Fixture_ID").agg(F.max(EPOCH).alias("_newest"))
    return stored.join(newest, "Fixture_ID").where(F.col(EPOCH) == F.col("_newest")).drop("_newest", EPOCH, RANGE)


def apply_epoch(rows: DataFrame, fixtures: DataFrame, root: str, epoch: int, size: int = 100_000,
                mart: Mart = TEAM) -> None:
    """Merge one batch.

    rows: the mart's columns of all rows of the batch's documents; fixtures: Fixture_ID of those documents, also of
    those that hold no rows. Epochs are applied in order; one may be applied again.
    """
    spark = rows.sparkSession
    rows_path, deltas_path = _paths(root)
    touched = fixtures.select("Fixture_ID").where(F.col("Fixture_ID").isNotNull()).distinct()
    whole = touched.join(rows.select(*mart.columns), "Fixture_ID", "left")
    by_range = whole.withColumn(RANGE, F.floor(F.col("Fixture_ID") / size).cast("long"))
    by_range.write.mode("overwrite").partitionBy(RANGE).parquet(f"{rows_path}/{EPOCH}={int(epoch)}")
    new = (spark.read.schema(mart.stored).parquet(rows_path)
           .where(F.col(EPOCH) == int(epoch)))
    ranges = [r[0] for r in new.select(RANGE).distinct().collect()]
    now = new.drop(EPOCH, RANGE)
    before = earlier_rows(spark, root, now.select("Fixture_ID").distinct(), ranges, epoch, mart)
    both = now.withColumn("_added", F.lit(True)).unionByName(before.withColumn("_added", F.lit(False)))
    delta = signed_sums(both, F.col("_added"), mart)
    changed = [F.col(c) != 0 for c in delta.columns if c not in mart.keys]
    some = changed[0]
    for c in changed[1:]:
        some = some | c
    delta.where(some).write.mode("overwrite").parquet(f"{deltas_path}/{EPOCH}={int(epoch)}")


def _summed(deltas: DataFrame, mart: Mart) -> DataFrame:
    names = [c for c in deltas.columns if c not in (*mart.keys, EPOCH)]
    return deltas.groupBy(*mart.keys).agg(*[F.sum(c).alias(c) for c in names]).where(F.col("Matches") != 0)


def sums(spark: SparkSession, root: str, epoch: int | None = None, mart: Mart = TEAM) -> DataFrame:
    """The sums per key after ``epoch`` (after all when None); keys without matches are left out."""
    deltas = spark.read.parquet(_paths(root)[1])
    if epoch is not None:
        deltas = deltas.where(F.col(EPOCH) <= epoch)
    return _summed(deltas, mart).withColumns({c: F.when(F.col(f"{c}_n") != 0, F.col(c)) for c in mart.nullable})


def compact(spark: SparkSession, root: str, epoch: int, target: str, mart: Mart = TEAM) -> None:
    """Fold the deltas of all epochs up to ``epoch`` into one, under ``target``; readers move there when it is whole."""
    deltas = spark.read.parquet(_paths(root)[1])
    old = _summed(deltas.where(F.col(EPOCH) <= epoch), mart).withColumn(EPOCH, F.lit(int(epoch)))
    old.unionByName(deltas.where(F.col(EPOCH) > epoch)).write.partitionBy(EPOCH).parquet(_paths(target)[1])


# -- the marts from the sums ------------------------------------------------------
def standings(kept: DataFrame, star, per_league: bool = True) -> DataFrame:
    """R1 from the kept sums; ``star`` gives the names."""
    mr = kept.select(*TEAM.keys, "League_Points", "Wins", "Draws", "Loses", F.col("Goals_Scored").alias("Goals_For"),
                     F.col("Goals_Conceded").alias("Goals_Against"), "Away_Wins", "Home_Losses",
                     (F.col("Goals_Scored") - F.col("Goals_Conceded")).alias("Goal_Difference"))
    return reports.standings_of(mr, star, per_league)


def home_away(kept: DataFrame, star) -> DataFrame:
    """R3 from the kept sums."""
    return reports.home_away_of(kept.select(
        *TEAM.keys, "Home_Points", "Home_Goals", F.col("Matches").alias("Home_Matches"),
        "Away_Points", "Away_Goals", F.col("Matches").alias("Away_Matches")), star)


def aggressive_teams(kept: DataFrame, star, k: int = 10) -> DataFrame:
    """R7 from the kept sums, over all seasons and leagues."""
    pairs = (("m", "Matches"), ("f", "Fouls"), ("fn", "Fouls_n"), ("y", "Yellow_Cards"), ("yn", "Yellow_Cards_n"),
             ("r", "Red_Cards"), ("rn", "Red_Cards_n"))
    per_team = kept.groupBy("Team_ID").agg(*[F.sum(c).alias(a) for a, c in pairs])
    return reports.aggressive_teams_of(per_team, star, k)


def top_scorers(kept: DataFrame, star, k: int = 10) -> DataFrame:
    """R2 from the kept sums."""
    goals = kept.where(F.col("Goals").isNotNull()).select("Player_ID", F.col("Goals").alias("total_goals"))
    return reports.top_scorers_of(goals, star, k)


def consistent_players(kept: DataFrame, star, min_matches: int = 10, k: int = 10) -> DataFrame:
    """R4 from the kept sums."""
    return reports.consistent_players_of(kept.where(F.col("Regular_Matches") > 0).select(
        "Player_ID", F.col("Regular_Matches").alias("Matches_Played"), F.col("Rating").cast("double").alias("_rating_sum"),
        F.col("Rating_n").alias("_rating_n")), star, min_matches, k)


def impactful_players(kept: DataFrame, star, min_matches: int = 10, k: int = 10) -> DataFrame:
    """R5 from the kept sums."""
    return reports.impactful_players_of(kept.select(
        "Player_ID", F.col("Matches").alias("Matches_Played"), F.col("Goals").alias("Total_Goals"),
        F.col("Assists").alias("Total_Assists"), F.col("Contributions").alias("Goal_Contributions"),
        F.col("Contributions_n").alias("_contrib_n")), star, min_matches, k)


def best_goalkeepers(kept: DataFrame, star, min_matches: int = 10, k: int = 10) -> DataFrame:
    """R6 from the kept sums."""
    return reports.best_goalkeepers_of(kept.where(F.col("Keeper_Matches") > 0).select(
        "Player_ID", F.col("Keeper_Matches").alias("Matches_Played"), F.col("Saves").alias("Total_Saves"),
        F.col("Allowed").alias("Goals_Allowed"), F.col("Faced").alias("_faced")), star, min_matches, k)
