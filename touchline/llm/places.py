"""Places of rows within groups of any size.

A window over a group would sort a hot group in one task. Here the rows are
range-partitioned by (group, order) and written once with their place in
their range; a group that lies in several ranges gets the sizes of its
earlier stretches as an offset (one row per group and range). Rows that are
equal in all columns of the order may change places with each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import written

_PLACE_BITS = 33  # of monotonically_increasing_id


def with_places(df: DataFrame, group: str, order: Sequence[str], name: str = "pos") -> DataFrame:
    """``df`` plus ``name``: 0, 1, ... within each group, in ascending order, NULLs first.

    ``group`` must not hold NULLs.
    """
    keys = [F.col(group), *[F.col(c).asc_nulls_first() for c in order]]
    place = F.monotonically_increasing_id()
    ranged = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("_place", place), "places")
    stretch = F.shiftright("_place", _PLACE_BITS)
    stretches = ranged.groupBy(F.col(group).alias("_group"), stretch.alias("_range")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = stretches.select("_group", "_range", (F.coalesce(F.sum("_n").over(earlier), F.lit(0))
                                                  - F.col("_first")).alias("_shift"))
    return (ranged.withColumn("_own", stretch)
            .join(shift, (F.col(group) == F.col("_group")) & (F.col("_own") == F.col("_range")))
            .withColumn(name, F.col("_place") + F.col("_shift"))
            .drop("_place", "_own", "_group", "_range", "_shift"))
