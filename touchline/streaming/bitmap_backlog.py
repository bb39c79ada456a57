"""The backlog as bitmaps.

Announced and fetched ids are kept as one bitmap row per 32,768 ids, built
with ``bitmap_construct_agg`` and merged with ``bitmap_or_agg``: an id costs a
bit, sending it again costs nothing, and a batch is merged without looking at
ids that it does not hold. What is pending is bit arithmetic on the words of
the three bitmaps of a bucket, ``announced and not (players and statistics)``;
ids appear as rows only when they are pending. Ids never join ids: the
bitmaps of a bucket meet in one aggregate, four kilobytes each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.schemas import ENDPOINT_PLAYERS, ENDPOINT_STATISTICS
from touchline.streaming.incremental import enqueue, fetched_ids

BITS = 32_768
#: Hexadecimal digits of a word: 60 bits, so that it is a non-negative long.
WORD = 15


def id_bitmaps(ids: DataFrame, column: str = "Fixture_ID") -> DataFrame:
    """Bucket, Bits: the ids of ``column`` (NULLs are left out)."""
    key = F.col(column).cast("long")
    return (ids.where(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("Bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("Bits")))


def merged(*bitmaps: DataFrame) -> DataFrame:
    """Bucket, Bits: the union of stored and new bitmaps."""
    return reduce(DataFrame.unionByName, bitmaps).groupBy("Bucket").agg(F.bitmap_or_agg("Bits").alias("Bits"))


def count_ids(bitmaps: DataFrame) -> DataFrame:
    """Ids: how many ids there are, without listing them."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("Bits")), F.lit(0).cast("long")).alias("Ids"))


def _word(digits: Column, at: Column) -> Column:
    """A word of a bitmap's hexadecimal digits; 0 where there is no bitmap."""
    return F.coalesce(F.conv(F.substr(digits, at * WORD + 1, F.lit(WORD)), 16, 10).cast("long"), F.lit(0).cast("long"))


def _id(bucket: Column, place: Column) -> Column:
    """The id of a place in a bucket; buckets count from 1 upwards for ids from 1, downwards for others."""
    return F.when(bucket > 0, (bucket - 1) * BITS + place + 1).otherwise(bucket * BITS - place)


def listed(buckets: DataFrame, word, column: str = "Fixture_ID") -> DataFrame:
    """The ids whose bit is set in ``word(at)``, a long per word of a bucket; ``buckets`` has a Bucket."""
    digits = BITS // 4
    words = buckets.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit((digits - 1) // WORD))))
    # substr cuts the last word short; its bits count from the end of what there is.
    width = F.least(F.lit(WORD), F.lit(digits) - F.col("_at") * WORD) * 4
    some = words.select("Bucket", "_at", word(F.col("_at")).alias("_word"), width.alias("_width")).where(F.col("_word") != 0)
    bit = some.select("*", F.explode(F.sequence(F.lit(0), F.col("_width") - 1)).alias("_bit"))
    held = bit.where(F.expr("shiftright(_word, cast(_width - 1 - _bit as int)) & 1 = 1"))
    # Bit k of a byte is its k-th lowest; hexadecimal text has the highest first.
    place = F.col("_at") * WORD * 4 + F.col("_bit")
    byte = F.floor(place / 8)
    return held.select(_id(F.col("Bucket"), byte * 8 + (7 - place % 8)).cast("long").alias(column))


def pending_ids(announced: DataFrame, players: DataFrame, statistics: DataFrame, column: str = "Fixture_ID") -> DataFrame:
    """Announced ids of which not both documents were fetched. All three: Bucket, Bits."""
    roles = [df.select("Bucket", *[(F.col("Bits") if i == k else F.lit(None).cast("binary")).alias(f"b{i}")
                                   for i in range(3)]) for k, df in enumerate((announced, players, statistics))]
    buckets = reduce(DataFrame.unionAll, roles).groupBy("Bucket").agg(
        *[F.bitmap_or_agg(f"b{i}").alias(f"b{i}") for i in range(3)]).select(
            "Bucket", *[F.hex(f"b{i}").alias(f"b{i}") for i in range(3)])

    def word(at: Column) -> Column:
        done = _word(F.col("b1"), at).bitwiseAND(_word(F.col("b2"), at))
        return _word(F.col("b0"), at).bitwiseAND(F.bitwise_not(done))
    return listed(buckets, word, column)


def backlog(fixtures_env: DataFrame, players_env: DataFrame, stats_env: DataFrame) -> DataFrame:
    """The pending ids from the three kinds of documents. Only valid documents that hold something count."""
    return pending_ids(id_bitmaps(enqueue(fixtures_env)), id_bitmaps(fetched_ids(players_env, ENDPOINT_PLAYERS)),
                       id_bitmaps(fetched_ids(stats_env, ENDPOINT_STATISTICS)))
