"""Star-schema sinks and the typed load.

* ``write_star_csv``: one CSV folder per table with a header (the reference's
  export format); seed tables are coalesced to one file (K3), everything
  else is written in parallel. Quotes, commas, line breaks, blanks, empty
  strings and NULLs come back as they were.
* ``load_star_csv``: CSV is read as strings and each DDL column is picked
  **by header name** and converted with ``try_cast`` (the reference's
  positional COPY mixes up columns whose CSV order differs from the DDL,
  Q-2); the declared star schema is the contract. ``load_rejects`` counts per
  column what did not convert or was missing.
* ``save_star_tables`` / ``load_star``: catalog tables (Parquet), facts
  partitioned by season, so a report on one season reads one partition.
  Row counts and rejects are observed while writing (K5), without another pass.
* ``save_bucketed_star``: facts and fixtures bucketed and sorted by fixture,
  so that they join in place, whatever their size.
* ``replace_partition``: a partition's new version is written to a folder of
  its own before the catalog points to it, so a failed or running refresh
  never shows a reader half of it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import STAR_DDL, star_schema
from touchline.session import open_partitions
from touchline.sources.tables import catalog_table
from touchline.star import STAR_TABLES, Star

SEED_TABLES = ("dim_seasons", "dim_countries")


def _raw(df: DataFrame, field: T.StructField) -> Column:
    """The column of a DDL field by name, or a typed NULL."""
    found = {c.lower(): c for c in df.columns}.get(field.name.lower())
    return F.col(f"`{found}`") if found else F.lit(None).cast("string")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the DDL columns of ``table`` by name with their DDL types.

    Missing columns become typed NULLs; values that do not convert become
    NULL (``try_cast``), never an error; ``load_rejects`` counts both.
    """
    return df.select(*[
        (_raw(df, f) if isinstance(f.dataType, T.StringType) else _raw(df, f).try_cast(f.dataType)).alias(f.name)
        for f in star_schema(table).fields])


def row_digest(df: DataFrame) -> Column:
    """MD5 of a row with its columns by name: swapped columns and changed values of any type show.

    Doubles count in hundredths, times in seconds.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c * 100).cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_seconds(c.cast("timestamp"))
        parts += [F.lit(f"{f.name}="), F.coalesce(c.cast("string"), F.lit("-")), F.lit(";")]
    return F.md5(F.concat(*parts))


def table_digests(star) -> DataFrame:
    """Table_Name, Row_Count, Checksum (sum of the heads of all rows' digests): one row per star table."""
    head = lambda df: F.conv(F.substring(row_digest(df), 1, 8), 16, 10).cast("long")
    return reduce(DataFrame.unionAll, [
        df.agg(F.count(F.lit(1)).alias("Row_Count"), F.sum(head(df)).alias("Checksum"))
        .select(F.lit(name).alias("Table_Name"), "Row_Count", "Checksum") for name, df in star.items()])


def load_rejects(df: DataFrame, table: str) -> DataFrame:
    """Column_Name, Rows, Rejected (values that do not convert), Missing (no such column).

    One aggregate over the raw rows.
    """
    names = {c.lower() for c in df.columns}
    fields = star_schema(table).fields
    bad = [F.count_if(_raw(df, f).isNotNull() & _raw(df, f).try_cast(f.dataType).isNull()).alias(f.name) for f in fields]
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *bad)
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("Column_Name"), F.col("_rows").alias("Rows"), F.col(f.name).alias("Rejected"),
                 F.lit(f.name.lower() not in names).alias("Missing")) for f in fields])))


#: Written and read alike, so that every string comes back as it was.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "emptyValue": '""'}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """K1/K2/K3: CSV with a header row."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv_raw(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """Header CSV as strings. With ``line_breaks`` a quoted value may hold them; such
    a file is read by one task, so facts (no free text) are read without."""
    # A field without quotes is read as the marker, and so as NULL; "" stays an empty string.
    options = {**CSV_OPTIONS, "emptyValue": "", "nullValue": "\ue000", "multiLine": str(line_breaks).lower(), "inferSchema": "false"}
    return spark.read.options(**options).csv(path)


def read_csv_typed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Header CSV -> strings -> DDL columns by name with try_cast."""
    return conform(read_csv_raw(spark, path, line_breaks=not table.startswith("fact_")), table)


def write_star_csv(star, root: str, mode: str = "overwrite") -> dict[str, str]:
    paths = {}
    for name in STAR_TABLES:
        path = f"{root.rstrip('/')}/{name}"
        write_csv(conform(getattr(star, name), name), path, mode, single_file=name in SEED_TABLES)
        paths[name] = path
    return paths


def load_star_csv(spark: SparkSession, root: str) -> Star:
    """Load every star table from its CSV folder, typed by the DDL."""
    return Star(**{n: read_csv_typed(spark, f"{root.rstrip('/')}/{n}", n) for n in STAR_TABLES})


def write_star_tables(star, root: str, mode: str = "overwrite") -> dict[str, str]:
    """K4: Parquet tables; facts are clustered by fixture for co-located joins."""
    paths = {}
    for name in STAR_TABLES:
        df = conform(getattr(star, name), name)
        if name.startswith("fact_"):
            df = df.repartitionByRange("Fixture_ID").sortWithinPartitions("Fixture_ID")
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(path)
        paths[name] = path
    return paths


def load_star_tables(spark: SparkSession, root: str) -> Star:
    return Star(**{n: spark.read.schema(STAR_DDL[n]).parquet(f"{root.rstrip('/')}/{n}")
                   for n in STAR_TABLES})


# -- catalog tables -------------------------------------------------------------
def _with_season(star, name: str) -> DataFrame:
    """A fact's DDL columns plus the season of its fixture (the partition column)."""
    seasons = star.dim_fixtures.select("Fixture_ID", F.col("Season_ID").cast("int").alias("Season_ID"))
    return conform(getattr(star, name), name).join(seasons, "Fixture_ID", "left").select(
        *star_schema(name).fieldNames(), "Season_ID")


#: Partitions (seasons) that a writing task holds open; with more it sorts its rows by season.
SEASONS_OPEN = 16


def save_counted(df: DataFrame, table: str, path: str, partition_by: str | None = None) -> int:
    """K4/K5: write a catalog table at ``path``; the rows written are counted on the way."""
    seen = Observation(table.replace(".", "_"))
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with open_partitions(df.sparkSession, SEASONS_OPEN):
        writer.saveAsTable(table)
    return seen.get["rows"]


def save_star_tables(star, database: str, root: str) -> dict[str, int]:
    """The star as catalog tables under ``root``; rows per table."""
    star.dim_seasons.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/{database}.db'")
    rows = {}
    for name in STAR_TABLES:
        fact = name.startswith("fact_")
        df = _with_season(star, name) if fact else conform(getattr(star, name), name)
        rows[name] = save_counted(df, f"{database}.{name}", f"{root.rstrip('/')}/{name}", "Season_ID" if fact else None)
    return rows


#: Rows of the largest table that one bucket takes, sorted in one task.
BUCKET_ROWS = 500_000


def bucket_count(rows: int, least: int = 8) -> int:
    """Buckets for a star whose largest table has ``rows`` rows: a bucket stays the same size as tables grow."""
    return max(least, -(-rows // BUCKET_ROWS))


#: Tables that are bucketed by fixture.
FIXTURE_TABLES = ("dim_fixtures", "fact_player", "fact_team")


def save_bucketed_star(star, database: str, root: str, buckets: int = 64) -> dict[str, int]:
    """The star as catalog tables; facts and fixtures in ``buckets`` buckets by Fixture_ID.

    A fact then joins its fixtures without an exchange on either side. Rows
    are dealt by the bucket's own hash before writing, so a table has one file
    per bucket. Choose ``buckets`` so that a bucket fits a task (at 100 TB of
    facts some 10^5); both sides must have the same number.
    """
    spark = star.dim_seasons.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/{database}.db'")
    rows = {}
    for name in STAR_TABLES:
        df, path = conform(getattr(star, name), name), f"{root.rstrip('/')}/{name}"
        if name not in FIXTURE_TABLES:
            rows[name] = save_counted(df, f"{database}.{name}", path)
            continue
        seen = Observation(f"{database}_{name}")
        (df.repartition(buckets, "Fixture_ID").observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
         .bucketBy(buckets, "Fixture_ID").sortBy("Fixture_ID").option("path", path).saveAsTable(f"{database}.{name}"))
        rows[name] = seen.get["rows"]
    return rows


def reject_metrics(raw: DataFrame, table: str) -> list[Column]:
    """``rows`` and, per DDL column, the values that do not convert: metrics for ``observe``."""
    return [F.count(F.lit(1)).alias("rows"), *[
        F.count_if(_raw(raw, f).isNotNull() & _raw(raw, f).try_cast(f.dataType).isNull()).alias(f"bad_{f.name}")
        for f in star_schema(table).fields]]


def save_observed(raw: DataFrame, table: str, name: str, path: str) -> dict[str, int]:
    """Load raw rows typed by the DDL of ``table`` into the catalog table ``name``.

    Rows and rejects per column are metrics of the write itself: the input is
    read once. The raw columns are observed before they are converted.
    """
    seen = Observation(f"load_{uuid.uuid4().hex[:12]}")
    conform(raw.observe(seen, *reject_metrics(raw, table)), table).write.mode("overwrite").option(
        "path", path).saveAsTable(name)
    return dict(seen.get)


def replace_partition(df: DataFrame, table: str, column: str, value: int, root: str) -> str:
    """Make ``df`` (without ``column``) the partition ``column = value`` of a catalog table, all or nothing.

    The rows go to a fresh folder first; then one catalog change points the
    partition there. Whatever fails before leaves the old rows in place, and
    files that a reader holds are not touched. Returns the new folder; earlier
    folders can be removed once no reader needs them.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{column}={value}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    point_partition(spark, table, column, value, path)
    return path


def point_partition(spark: SparkSession, table: str, column: str, value: int, path: str) -> None:
    """Point a partition of a catalog table to a folder."""
    spec = f"PARTITION ({column} = {int(value)})"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def load_csv_to_tables(spark: SparkSession, csv_dir: str, database: str, root: str) -> dict[str, int]:
    """Every CSV folder into its catalog table."""
    return save_star_tables(load_star_csv(spark, csv_dir), database, root)


def load_star(spark: SparkSession, database: str, season_id: int | None = None) -> Star:
    """The star over catalog tables; with ``season_id`` only that season's partition
    of the facts (and its fixtures) is read."""
    tables = {}
    for name in STAR_TABLES:
        df = catalog_table(spark, database, name)
        if season_id is not None and (name.startswith("fact_") or name == "dim_fixtures"):
            df = df.where(F.col("Season_ID") == season_id)
        tables[name] = df.drop("Season_ID") if name.startswith("fact_") else df
    return Star(**tables)
