"""Files, documents and tasks that must not grow faster than the input."""

import glob
import os

from pyspark.sql import functions as F

from touchline.functions.coerce import lenient_int
from touchline.plans.proxy import ProxyStar
from touchline.plans.proxy_envelopes import write_documents
from touchline.schemas import CORRUPT_COLUMN, ENDPOINT_TEAMS
from touchline.sources import envelopes, warehouse
from touchline.sources.envelopes import stage_envelopes
from touchline.streaming import incremental as inc


def _files(path):
    return glob.glob(f"{path.replace('file:', '')}/**/*.parquet", recursive=True)


def test_upsert_writes_a_partition_from_few_tasks(spark, scratch):
    rows = spark.range(8000).select(
        F.col("id").alias("Fixture_ID"), F.lit(1).alias("Team_ID"), (F.col("id") % 7).alias("Fouls"),
        F.floor(F.col("id") / 100).cast("long").alias("Fixture_ID_Range"),
        F.lit("2024-01-01").cast("timestamp").alias(inc.SOURCE_MTIME), F.lit("a").alias(inc.SOURCE_FILE)).repartition(8)
    table, before = f"{scratch}/table", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # all eight tasks stay
    try:
        inc.upsert_partitions(rows, table, ["Fixture_ID", "Team_ID"], "Fixture_ID_Range", inc.SOURCE_MTIME)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert spark.read.parquet(table).select("Fixture_ID").distinct().count() == 8000
    assert len(_files(table)) <= 80 + 8


def _written_plan(spark, path):
    """The plan of the write into ``path``."""
    store = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [store.apply(i).physicalPlanDescription() for i in range(store.size())]
    return [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and path.rsplit("/touchline/", 1)[1] in p][-1]


def test_streamed_table_is_not_sorted_for_its_partitions(spark, scratch):
    source = f"{scratch}/source"
    spark.range(4000).select("id", (F.col("id") % 50).alias("kind")).repartition(8).write.parquet(source)
    inc.stream_table(spark, source, "id long, kind long", f"{scratch}/table", f"{scratch}/checkpoint", partition_col="kind")
    stored = spark.read.parquet(f"{scratch}/table")
    # Fifty values are more than a task holds open, and still whole.
    assert stored.count() == 4000 and stored.select("id").distinct().count() == 4000
    assert "Sort" not in _written_plan(spark, f"{scratch}/table/_epoch=0")


def test_landed_documents_are_small_and_whole(spark, scratch):
    docs = spark.range(25_000).select(F.concat(F.lit('{"get":"teams","parameters":{"league":"'), "id", F.lit('"}}')).alias("doc"))
    write_documents(docs.coalesce(1), scratch)
    back = spark.read.json(scratch, schema="get string, parameters struct<league: string>")
    assert back.select("parameters.league").distinct().count() == 25_000
    parts = glob.glob(f"{scratch.replace('file:', '')}/part-*")
    assert len(parts) == 3 and all(p.endswith(".txt.gz") for p in parts)
    assert sum(os.path.getsize(p) for p in parts) < 25_000 * 40 / 4


def test_documents_do_not_meet_in_a_shuffle(spark, scratch):
    """The newest document per key, also among equal times, files and keys that are NULL."""
    rows = [(0, "1", "2024-01-01", "a"), (1, "1", "2024-01-02", "a"), (2, "1", "2024-01-02", "b"), (3, "2", "2024-01-01", "a"),
            (4, "2", "2024-01-01", "a"), (5, None, "2024-01-01", "a"), (6, None, "2024-01-02", "a"), (7, "3", "2024-01-01", None)]
    env = spark.createDataFrame(rows, "n long, k string, t string, f string").select(
        F.col("n").alias(inc.ARRIVAL), "k", F.to_timestamp("t").alias(inc.SOURCE_MTIME), F.col("f").alias(inc.SOURCE_FILE))
    newest, older = inc.newest_stamps(env, {"K": F.col("k")}, scratch)
    assert sorted(r[0] for r in older.collect()) == [0, 1, 3, 5]
    assert {(r[0], str(r[1])[:10], r[2]) for r in newest.collect()} == {
        ("1", "2024-01-02", "b"), ("2", "2024-01-01", "a"), (None, "2024-01-02", "a"), ("3", "2024-01-01", None)}


def test_plain_numbers_are_cast_without_patterns(spark):
    texts = ["7", "-7", "+7", " 7 ", "7.9", "-0", "007", ".5", "2147483648", "\x017", "", "x", None]
    found = spark.createDataFrame([(t,) for t in texts], "s string").select(lenient_int(F.col("s"))).collect()
    assert [r[0] for r in found] == [7, -7, 7, 7, 7, 0, 7, 0, None, None, None, None, None]
    plan = spark.range(1).select(lenient_int(F.col("id").cast("string")).alias("n"))._jdf.queryExecution().analyzed().toString()
    assert plan.index("try_cast") < plan.lower().index("rlike")


def test_buckets_follow_the_rows(spark):
    assert [warehouse.bucket_count(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [8, 8, 72, 432]


def test_staging_does_not_sort_documents(spark, scratch):
    """Valid and quarantined documents go to their folders as they come."""
    docs = spark.range(4000).select(
        F.when(F.col("id") % 5 == 0, "fixtures").otherwise(ENDPOINT_TEAMS).alias("get"), F.col("id").alias("n"),
        F.expr("cast(null as array<struct<team: struct<id: bigint>>>)").alias("response"),
        F.lit(None).cast("string").alias(CORRUPT_COLUMN)).coalesce(1)
    stage_envelopes(docs, ENDPOINT_TEAMS, scratch)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    counts = {r[0]: r[1] for r in spark.read.parquet(scratch).groupBy("_status").count().collect()}
    assert counts == {"valid": 3200, "quarantine": 800}
    assert "Sort" not in _written_plan(spark, scratch)


def test_staged_files_hold_a_bounded_number_of_documents(spark, scratch, monkeypatch):
    """A task reads a few dozen staged files at most, so few documents a file are few rows to group in it."""
    monkeypatch.setattr(envelopes, "STAGED_DOCUMENTS", 1000)
    docs = spark.range(4500).select(
        F.when(F.col("id") % 5 == 0, "fixtures").otherwise(ENDPOINT_TEAMS).alias("get"), F.col("id").alias("n"),
        F.expr("cast(null as array<struct<team: struct<id: bigint>>>)").alias("response"),
        F.lit(None).cast("string").alias(CORRUPT_COLUMN)).coalesce(1)
    stage_envelopes(docs, ENDPOINT_TEAMS, scratch)
    sizes = sorted(spark.read.parquet(path).count() for path in _files(scratch))
    assert sizes == [600, 900, 1000, 1000, 1000]
    staged = spark.read.parquet(scratch)
    assert staged.select("n").distinct().count() == 4500
    assert staged.where(F.col("_status") == "quarantine").count() == 900


def test_sides_of_a_fixture_are_dealt_narrow(spark, scratch):
    """Rows are dealt by order before the wide aggregate, also with a hot order and keys that are NULL."""
    rows = [(1, 7, 1, 10.0), (1, 7, 2, 5.0), (1, 9, 3, 2.0), (1, 8, 4, 50.0), (2, 4, 1, 3.0), (None, 5, 1, 1.0),
            (None, 6, 2, 2.0), (3, 2, 1, 4.0), (3, None, 2, 9.0), (3, 1, 3, None)] + [(4, i % 40, i, 1.0) for i in range(400)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double") \
        .write.parquet(f"{scratch}/lineitem.parquet")
    sides = ProxyStar(spark, scratch).fixture_sides
    columns = ["Fixture_ID", "Home_Team_ID", "Away_Team_ID", "h_qty", "a_qty", "h_n", "a_n", "h_lines", "a_lines"]
    assert {tuple(r) for r in sides.select(*columns).collect()} == {
        (1, 7, 9, 15, 2, 2, 1, 3, 3), (None, 5, 6, 1, 2, 1, 1, 1, 2), (3, 1, 2, None, 4, 1, 1, 3, 1),
        (4, 0, 39, 10, 10, 10, 10, 1800, 2190)}
    plan = sides._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("partial_min_by") < plan.index("Exchange hashpartitioning(Fixture_ID")
