"""Distributed rank / row numbers equal the single-window definitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.keys import dense_key
from touchline.operators.ranking import rank_by, row_number_by


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 3), rnd.choice([None] + list(range(8))), rnd.randint(-3, 3))
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, g int, a int, b int").repartition(6)


def test_rank_global_matches_window(spark):
    df = _data(spark)
    order = [("a", True), ("b", False)]
    got = rank_by(df, order, name="r").select("id", "r")
    w = Window.orderBy(F.col("a").desc_nulls_last(), F.col("b").asc_nulls_last())
    want = df.select("id", F.rank().over(w).cast("long").alias("r"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_rank_partitioned_matches_window(spark):
    df = _data(spark)
    order = [("a", True), ("b", True)]
    got = rank_by(df, order, ["g"], name="r").select("id", "r")
    w = Window.partitionBy("g").orderBy(F.col("a").desc_nulls_last(), F.col("b").desc_nulls_last())
    want = df.select("id", F.rank().over(w).cast("long").alias("r"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_row_number_and_dense_key(spark):
    df = _data(spark, 2000)
    got = row_number_by(df, [("id", False)], "rn").select("id", "rn").collect()
    assert sorted((r.id + 1, r.rn) for r in got) == [(i, i) for i in range(1, 2001)]
    keyed = dense_key(df, "k", ["id"])
    assert keyed.columns[0] == "k"
    assert keyed.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 2000, 2000)


def test_global_rank_windows_never_hold_all_rows(spark):
    """The rows are split by range on the way to the written copy; the only
    single-partition exchange is over per-range totals."""
    import re
    df = _data(spark)
    plan = rank_by(df, [("a", True)], name="r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    assert re.search(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=\[_range", plan)


def test_numbers_do_not_depend_on_optimizer_settings(spark):
    """300,000 rows with extra columns, exchange reuse and coalescing on and off."""
    n = 300_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), (F.col("id") % 1000).alias("a"),
                               F.lit("x").alias("extra"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.exchange.reuse", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for reuse in ("true", "false"):
            for coalesce in ("true", "false"):
                spark.conf.set("spark.sql.exchange.reuse", reuse)
                spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
                keyed = dense_key(df, "key", ["k"])
                assert keyed.columns == ["key", "k", "a", "extra"]
                assert keyed.where(F.col("key") != F.col("k") + 1).count() == 0 and keyed.count() == n
                ranked = rank_by(df, [("a", False)], name="r")
                assert ranked.where(F.col("r") != F.col("a") * (n // 1000) + 1).count() == 0
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_hash_keys_tell_nulls_and_borders_apart(spark):
    from touchline.operators.keys import digest_key, hash_key
    df = spark.createDataFrame([(1, None, "a"), (None, 1, "a"), (None, None, "a"), (1, 1, "a"), (11, None, "a")],
                               "x long, y long, z string")
    assert hash_key(df, "k", ["x", "y"]).select("k").distinct().count() == 5
    assert digest_key(df, "k", ["x", "y"]).select("k").distinct().count() == 5
    assert hash_key(df, "k", ["x", "y"]).where("k < 0 OR k IS NULL").count() == 0
