import base64
import collections
import gzip
import hashlib

from touchline.llm import warc
from touchline.session import scratch_path

PAGES = "page_id long, url string, html string"


def expected(rows):
    by = collections.defaultdict(list)
    for i, _, h in rows:
        by[(h or "").encode()].append(i)
    out = []
    for body, ids in by.items():
        best = max((i for i in ids if i is not None), default=None)
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out += [(i, len(body), sha, "response" if i == best else "revisit", None if i == best else best) for i in ids]
    return sorted(out, key=str)


ROWS = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, "x\r\nEvil: 1", ""), (4, None, None),
        (5, "u", "WARC/1.1\r\n\r\n"), (6, "v", "long" * 200_000), (7, "w", "long" * 200_000), (None, "n", "q"),
        (None, "n", "<p>é</p>"), (8, "z", "\U0001F600\x00"), (9, "r", "twice"), (9, "r", "twice")]


def test_round_trip_equals_a_plain_reading(spark):
    df = spark.createDataFrame(ROWS, PAGES).repartition(3).selectExpr("*", "1 AS row", "'s' AS sha1", "2 AS data")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in warc.round_trip(spark, df).collect()]
    assert sorted(got, key=str) == expected(ROWS)
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_archives_are_plain_gzip_members_and_chunks_join_to_payloads(spark):
    df = spark.createDataFrame(ROWS, PAGES)
    root = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(df, root)
    for r in manifest.collect():
        with open(r.path, "rb") as f:
            f.seek(r.offset)
            raw = gzip.decompress(f.read(r.length))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and b"\r\nEvil" not in raw
    chunks = warc.read_archives(manifest, root).collect()
    assert max(len(c.data) for c in chunks) <= warc.CHUNK
    bodies = collections.defaultdict(list)
    for c in sorted((c for c in chunks if c.page_id in (6, 7)), key=lambda c: c.chunk_no):
        bodies[c.page_id].append(c.data)
    assert b"".join(bodies[7]) == b"long" * 200_000 and b"".join(bodies[6]) == b""
    assert [c.n_bytes for c in chunks if c.page_id == 7 and c.last] == [800_000]


def test_only_chunks_are_shuffled_and_sorted(spark):
    """Oversized payloads, also where every join is by shuffle; the plan cuts before it exchanges payloads."""
    rows = [(k, f"u{k}", ("é" * 90_000 if k % 2 else "b" * 150_000) + str(k // 4)) for k in range(12)]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chunks = warc.chunk_rows(df)
        assert max(len(r.data) for r in chunks.select("data").collect()) <= warc.CHUNK
        plan = chunks._jdf.queryExecution().sparkPlan().toString()
        join = plan[plan.index("SortMergeJoin"):]
        assert "Generate explode" in join
        got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
               for r in warc.round_trip(spark, df).collect()]
        assert sorted(got, key=str) == expected(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_payloads_may_all_be_responses(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyyyyyy"), (4, "d", "yyyyyyyy")], PAGES)
    got = {r.page_id: r.record_type for r in warc.round_trip(spark, df, min_revisit_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
