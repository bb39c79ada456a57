"""The backlog as bitmaps, and which documents count as fetched."""

from pyspark.sql import functions as F

from envelopes import fixture, fixtures_doc, player, players_doc, pstats, stats_doc
from touchline.sources.envelopes import parse_envelopes
from touchline.streaming import bitmap_backlog as B
from touchline.streaming.incremental import done_ids


def _env(spark, docs, endpoint):
    return parse_envelopes(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc", endpoint)


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "Fixture_ID long")


def test_bits_come_back_as_their_ids(spark):
    values = [1, 2, 8, 9, 32767, 32768, 32769, 65536, 10 ** 12, 0, -1, -32767, -32768, -32769, 7]
    bits = B.id_bitmaps(_ids(spark, [*values, 7, 7, None]).repartition(3))
    digits = bits.select("Bucket", F.hex("Bits").alias("Bits"))
    got = [r[0] for r in B.listed(digits, lambda at: B._word(F.col("Bits"), at)).collect()]
    assert sorted(got) == sorted(values)
    assert B.count_ids(bits).first()[0] == len(values)


def test_pending_equals_the_set_difference(spark):
    import random
    r = random.Random(4)
    a, p, s = (set(r.sample(range(-1000, 200_000), 3000)) for _ in range(3))
    p |= set(list(a)[:2000])
    s |= set(list(a)[1000:2500])
    maps = [B.id_bitmaps(_ids(spark, x)) for x in (a, p, s)]
    assert sorted(x[0] for x in B.pending_ids(*maps).collect()) == sorted(a - (p & s))
    half = [B.id_bitmaps(_ids(spark, x)) for x in (list(a)[:1500], list(a)[1200:])]
    assert B.pending_ids(B.merged(*half), *maps[1:]).count() == len(a - (p & s))
    none = B.id_bitmaps(_ids(spark, []))
    assert B.pending_ids(none, *maps[1:]).count() == 0
    assert B.pending_ids(maps[0], none, none).count() == len(a)


def test_failed_fetches_stay_pending(spark):
    ok = [(1, [player(9, "P", [pstats()])])]
    players = _env(spark, [players_doc(1, ok), players_doc(2, ok), players_doc(3, []), players_doc(4, ok), players_doc(5, ok)],
                   "fixtures/players")
    stats = _env(spark, [stats_doc(1, [(1, [("Fouls", 1)])]), stats_doc(2, [(1, [])], get="fixtures/players"),
                         stats_doc(3, [(1, [])]), stats_doc(4, []), '{"get": "fixtures/statistics", "par'], "fixtures/statistics")
    announced = _env(spark, [fixtures_doc([fixture(i, 2, 3, 1, 0) for i in range(1, 6)])], "fixtures")
    assert [r[0] for r in done_ids(players, stats).collect()] == [1]
    assert sorted(r[0] for r in B.backlog(announced, players, stats).collect()) == [2, 3, 4, 5]


def test_no_ids_are_joined(spark):
    maps = [B.id_bitmaps(_ids(spark, [1, 2])) for _ in range(3)]
    assert "Join" not in B.pending_ids(*maps)._jdf.queryExecution().optimizedPlan().toString()
