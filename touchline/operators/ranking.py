"""SQL RANK() and row numbering that never send all rows to one task.

``Window.orderBy(...)`` without ``partitionBy`` plans an
``Exchange SinglePartition``: every row goes to one task. Instead:

* rank only depends on how many rows sort strictly before a row, so rows
  are first counted per distinct (partition keys, sort keys) tuple, a
  partial aggregate that reduces hot keys before the shuffle;
* a global (unpartitioned) order is handled by ``prefix_sum``: range-
  partition and write the rows once, running sum inside each range, plus the
  total of all earlier ranges (one row per range);
* a partitioned rank runs its window over the distinct sort-key tuples of
  each group (for standings: distinct (points, goal difference, goals)
  triples of one season and league), never over raw rows;
* the rank is joined back on the tuple (null-safe); AQE broadcasts the
  tuple table when it is small or splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import scratch_path


def _sort_col(name: str, descending: bool) -> Column:
    c = F.col(name)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows in range partitions, sorted, each with its range and its place in it.

    Written once to the shared folder and read back: everything derived from
    the numbers sees the same copy, whatever the optimizer reuses or coalesces.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranged")
    place = F.monotonically_increasing_id()   # range << 33 | place within it
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .select("*", F.shiftright(place, 33).alias("_range"), place.bitwiseAND((1 << 33) - 1).alias("_place"))
     .write.parquet(path))
    return spark.read.parquet(path)


def _copied(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "ranked")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _offsets(ranged: DataFrame, weight: Column) -> DataFrame:
    """Total weight of all earlier ranges, one row per range."""
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_tot"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_tot").over(earlier), F.lit(0)).alias("_off"))


def prefix_sum(df: DataFrame, order: Sequence[Column], weight: Column, out: str) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over all rows strictly before each row.

    Each range is summed locally and offset by the totals of the earlier
    ranges. Ties on ``order`` must not occur (callers pass a unique order).
    """
    ranged = _ranged(df.withColumn("_w", weight), order)
    before = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("_w").over(before), F.lit(0)))
    offsets = _offsets(ranged, F.col("_w"))
    return (local.join(offsets, F.col("_range") == F.col("_r"))
            .withColumn(out, (F.col("_local") + F.col("_off")).cast("long"))
            .drop("_w", "_range", "_place", "_local", "_off", "_r"))


def rank_by(df: DataFrame, order: Sequence[tuple[str, bool]], partition_by: Sequence[str] = (),
            name: str = "rank") -> DataFrame:
    """Add ``name`` = RANK() OVER (PARTITION BY partition_by ORDER BY order).

    ``order`` is a list of (column, descending). NULLs sort last both ways.
    """
    keys = list(partition_by) + [c for c, _ in order]
    # Both uses read one written copy, so the input is computed once.
    df = _copied(df)
    tuples = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rank_n"))
    sort = [_sort_col(c, d) for c, d in order]
    if partition_by:
        before = Window.partitionBy(*partition_by).orderBy(*sort) \
            .rowsBetween(Window.unboundedPreceding, -1)
        ranks = tuples.withColumn(
            name, (F.coalesce(F.sum("_rank_n").over(before), F.lit(0)) + 1).cast("long"))
    else:
        ranks = prefix_sum(tuples, sort, F.col("_rank_n"), "_before") \
            .withColumn(name, F.col("_before") + 1).drop("_before")
    ranks = ranks.select(*[F.col(k).alias(f"_rk_{i}") for i, k in enumerate(keys)], name)
    cond = [df[k].eqNullSafe(ranks[f"_rk_{i}"]) for i, k in enumerate(keys)]
    return df.join(ranks, cond, "inner").drop(*[f"_rk_{i}" for i in range(len(keys))])


def row_number_by(df: DataFrame, order: Sequence[tuple[str, bool]], name: str = "row_number"
                  ) -> DataFrame:
    """1..n over a global order (ROW_NUMBER() OVER (ORDER BY ...)), distributed.

    ``order`` should be unique; ties get distinct numbers in arbitrary order.
    The rows are shuffled once, by range: their place in it is their number.
    """
    ranged = _ranged(df, [_sort_col(c, d) for c, d in order])
    return (ranged.join(_offsets(ranged, F.lit(1)), F.col("_range") == F.col("_r"))
            .withColumn(name, (F.col("_off") + F.col("_place") + 1).cast("long"))
            .drop("_range", "_place", "_off", "_r"))


def islands(df: DataFrame, key: str, time: str, value: str, name: str = "Island") -> DataFrame:
    """Add ``name``: a number for each run of one ``value`` in order of ``time`` within ``key``.

    Numbers ascend over all keys and times without gaps. (key, time) must be
    unique and not NULL. No window holds a key: rows are sorted in ranges of
    (key, time); a range's first row is compared with the last row of the
    range before, and the runs of earlier ranges are added up, one row per range.
    """
    ranged = _ranged(df, [F.col(key).asc(), F.col(time).asc()])
    within = Window.partitionBy("_range").orderBy("_place")
    last = ranged.groupBy("_range").agg(F.max_by(F.struct(key, value), "_place").alias("_last"))
    before = last.select(F.col("_range").alias("_r"), F.lag("_last").over(Window.orderBy("_range")).alias("_before"))
    earlier = F.coalesce(F.lag(F.struct(key, value)).over(within), F.col("_before"))
    marked = ranged.join(before, F.col("_range") == F.col("_r")).withColumn("_earlier", earlier).drop("_r", "_before")
    new = F.col("_earlier").isNull() | (F.col("_earlier")[key] != F.col(key)) | ~F.col("_earlier")[value].eqNullSafe(F.col(value))
    marked = marked.withColumn("_new", new.cast("long"))
    totals = _offsets(marked, F.col("_new"))
    so_far = F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (marked.withColumn("_local", so_far).join(totals, F.col("_range") == F.col("_r"))
            .withColumn(name, (F.col("_local") + F.col("_off")).cast("long"))
            .drop("_range", "_place", "_earlier", "_new", "_local", "_r", "_off"))
