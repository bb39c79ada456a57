"""WARC archives as a chunked record table.

Writing: payloads are cut into chunk rows (page_id, start, bytes) where they are
read, before anything is shuffled, sorted or handed to Python; the chunks meet
their record's narrow facts (type, response) in a join and are put in order of
record and start; a writer task streams a record's chunks through one
compressor into its archive file, one gzip member per record, and never holds
a whole payload. Each task attempt writes a file of its own under the shared
folder and lists its records (file, offset, length) in a manifest that Spark
commits, so files of lost or repeated attempts are never read.

Reading: the manifest is dealt over tasks; each opens its members at their
offsets, parses the header, and streams the block into chunk rows (record id,
chunk number, bytes so far, running digest). The last chunk's row carries the
whole payload's length and SHA-1.

Repeated payloads: of records with equal payloads (SHA-1 and length) of at
least ``min_revisit_bytes``, that with the largest page_id is the response
and the others are revisits that name it and carry no payload.

Defined results: a NULL html is an empty payload. A NULL url becomes a
``urn:page:`` target. Rows that repeat the largest page_id of their payload
are all responses; a NULL page_id counts as smaller than any other. An empty
table gives empty archives and an empty result. Only page_id, url and html
are read. Line breaks in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import written
from touchline.session import scratch_path

#: Bytes in a chunk row.
CHUNK = 1 << 16
DATE = "2025-01-01T00:00:00Z"
MANIFEST = "path string, offset long, length long, page_id long, record_type string"
CHUNKS = ("record_id string, page_id long, record_type string, refers_to long, chunk_no long, "
          "n_bytes long, digest string, last boolean, header_digest string, data binary")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record_types(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, sha1, n_bytes, response_id (NULL for responses): distinct."""
    own = pages.select("page_id", F.unhex(F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))).alias("sha1"),
                       F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("n_bytes")).distinct()
    best = own.groupBy("sha1", "n_bytes").agg(F.max("page_id").alias("best"))
    other = (~F.col("page_id").eqNullSafe(F.col("best"))) & (F.col("n_bytes") >= min_revisit_bytes)
    return own.join(best, ["sha1", "n_bytes"]).select(
        "page_id", "sha1", "n_bytes", F.when(other, F.col("best")).alias("response_id"))


def chunk_rows(pages: DataFrame, min_revisit_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """One row per payload chunk, at least one per record; revisits have one, without bytes."""
    types = record_types(pages, min_revisit_bytes).withColumnRenamed("page_id", "t_page_id")
    raw = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", raw.alias("raw"), F.unhex(F.sha1(raw)).alias("own_sha1"),
                        F.monotonically_increasing_id().alias("row"))
    last = F.greatest(F.octet_length("raw") - 1, F.lit(0)).cast("long")
    parts = F.transform(F.sequence(F.lit(0).cast("long"), last, F.lit(chunk).cast("long")), lambda s: F.struct(
        s.alias("start"), F.substring("raw", s.cast("int") + 1, F.lit(chunk)).alias("data")))
    # Cut first: what the join moves and sorts are chunks, never whole payloads.
    chunks = rows.select("row", "page_id", "url", "own_sha1", F.explode(parts).alias("part"))
    both = chunks.join(types, F.col("page_id").eqNullSafe(F.col("t_page_id")) & (F.col("own_sha1") == F.col("sha1")))
    own = F.col("response_id").isNull()
    return (both.where(own | (F.col("part.start") == 0))
            .select("row", "page_id", "url", "sha1", "n_bytes", "response_id", F.col("part.start").alias("start"),
                    F.when(own, F.col("part.data")).otherwise(F.lit(b"")).alias("data")))


def _open(root: str):
    import pyarrow.fs as fs
    return fs.FileSystem.from_uri(root)


def _header(row, n_bytes: int) -> tuple[bytes, int]:
    """WARC header plus the start of the block; length of that start."""
    page = None if row.page_id is None else int(row.page_id)
    revisit = row.response_id is not None
    target = row.url if isinstance(row.url, str) else f"urn:page:{'none' if page is None else page}"
    target = "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in target)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_uri(page)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha1:{base32_sha1(row.sha1)}"]
    if revisit:
        lines += [f"WARC-Refers-To: {record_uri(int(row.response_id))}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (0 if revisit else n_bytes)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http, len(http)


def write_archives(pages: DataFrame, root: str, min_revisit_bytes: int = 0, level: int = 1) -> DataFrame:
    """Write the archives; returns the committed manifest."""
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _open(root)
        system.create_dir(folder, recursive=True)
        path = posixpath.join(folder, f"{uuid.uuid4().hex}.warc.gz")
        out, packer, current, at, rows = None, None, None, 0, []

        def put(data: bytes) -> None:
            nonlocal at
            if data:
                out.write(data)
                at += len(data)

        def close_record() -> None:
            if packer is not None:
                put(packer.compress(b"\r\n\r\n"))
                put(packer.flush())
                rows[-1][2] = at - rows[-1][1]

        try:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    if out is None:
                        out = system.open_output_stream(path, compression=None)
                    if row.row != current:
                        close_record()
                        current, packer = row.row, zlib.compressobj(level, zlib.DEFLATED, 31)
                        head, _ = _header(row, int(row.n_bytes))
                        page = None if row.page_id is None else int(row.page_id)
                        rows.append([path, at, 0, page, "response" if row.response_id is None else "revisit"])
                        put(packer.compress(head))
                    put(packer.compress(row.data))
            close_record()
        finally:
            if out is not None:
                out.close()
        frame = pd.DataFrame(rows, columns=["path", "offset", "length", "page_id", "record_type"], dtype=object)
        yield frame.astype({"offset": "int64", "length": "int64", "page_id": "Int64"})

    # Ids go through Python as text: beside a NULL, pandas would round numbers.
    chunks = chunk_rows(pages, min_revisit_bytes).withColumns(
        {c: F.col(c).cast("string") for c in ("page_id", "response_id")})
    # A record's chunks come from one row, thus one map task and one key: they meet in one task.
    return written(chunks.sortWithinPartitions("row", "start").mapInPandas(write, MANIFEST), "warc-manifest")


class _Member:
    """One gzip member as a stream of decompressed bytes."""

    def __init__(self, file, offset: int, length: int):
        file.seek(offset)
        self.file, self.left, self.unpacker, self.buffer = file, length, zlib.decompressobj(31), b""

    def _more(self, n: int) -> bool:
        if self.unpacker.unconsumed_tail:
            got = self.unpacker.decompress(self.unpacker.unconsumed_tail, n)
        elif self.left:
            raw = self.file.read(min(CHUNK, self.left))
            self.left -= len(raw)
            got = self.unpacker.decompress(raw, n)
        else:
            got = self.unpacker.decompress(b"", n)
            if not got:
                return False
        self.buffer += got
        return True

    def until(self, mark: bytes) -> bytes:
        while mark not in self.buffer:
            if not self._more(CHUNK):
                raise ValueError("a record ends within its header")
        head, _, self.buffer = self.buffer.partition(mark)
        return head

    def read(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more(n):
            pass
        got, self.buffer = self.buffer[:n], self.buffer[n:]
        return got


def _page(uri: str | None) -> int | None:
    name = uri.strip("<>").rpartition(":")[2] if uri else "none"
    return None if name == "none" else int(name)


def record_chunks(file, offset: int, length: int, keep_data: bool) -> Iterator[tuple]:
    """The chunk rows of one record, in order, as they are read."""
    member = _Member(file, offset, length)
    fields = dict(line.split(": ", 1) for line in member.until(b"\r\n\r\n").decode("utf-8").split("\r\n")[1:])
    http = member.until(b"\r\n\r\n")
    left = int(fields["Content-Length"]) - len(http) - 4
    digest, so_far, number = hashlib.sha1(), 0, 0
    kind, uri = fields["WARC-Type"], fields["WARC-Record-ID"]
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    while True:
        data = member.read(min(CHUNK, left))
        if left and not data:
            raise ValueError(f"record {uri} is shorter than its length")
        left -= len(data)
        so_far += len(data)
        digest.update(data)
        yield (uri, _page(uri), kind, _page(fields.get("WARC-Refers-To")), number, so_far,
               base32_sha1(digest.digest()), left == 0, told, data if keep_data else None)
        number += 1
        if not left:
            return


def read_archives(manifest: DataFrame, root: str, keep_data: bool = True) -> DataFrame:
    """The chunked record table; ``data`` is NULL without ``keep_data``."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = _open(root)
        path, file = None, None
        for frame in frames:
            rows, held = [], 0
            for r in frame.itertuples(index=False):
                if r.path != path:
                    if file is not None:
                        file.close()
                    path, file = r.path, system.open_input_file(r.path)
                for x in record_chunks(file, int(r.offset), int(r.length), keep_data):
                    rows.append(x)
                    held += len(x[-1] or b"") + 200
                    if held > 16 << 20:
                        yield _frame(rows, names)
                        rows, held = [], 0
            if rows:
                yield _frame(rows, names)
        if file is not None:
            file.close()

    return manifest.select("path", "offset", "length").mapInPandas(read, CHUNKS)


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names, dtype=object).astype(
        {"page_id": "Int64", "refers_to": "Int64", "chunk_no": "int64", "n_bytes": "int64", "last": bool})


def records(chunks: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records read.

    A revisit takes its length from the response that it names; a response
    whose bytes do not give the digest in its header raises an error.
    """
    last = chunks.where("last").select("page_id", "record_type", "refers_to", "n_bytes", "digest", "header_digest")
    sizes = last.where(F.col("record_type") == "response").groupBy(F.col("page_id").alias("r_id"), F.col(
        "digest").alias("r_digest")).agg(F.max("n_bytes").alias("r_bytes"))
    digest = F.when((F.col("record_type") == "response") & (F.col("digest") != F.col("header_digest")),
                    F.raise_error(F.concat(F.lit("payload digest differs: "), F.col("header_digest")))
                    .cast("string")).otherwise(F.col("header_digest"))
    # The manifest is far smaller than what it lists, so its size must not lead to a broadcast.
    return (last.join(sizes.hint("merge"), (F.col("refers_to") == F.col("r_id"))
                      & (F.col("header_digest") == F.col("r_digest")), "left")
            .select("page_id", F.when(F.col("record_type") == "response", F.col("n_bytes"))
                    .otherwise(F.col("r_bytes")).alias("payload_bytes"),
                    digest.alias("payload_digest"), "record_type", "refers_to"))


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back."""
    root = scratch_path(spark, "warc")
    manifest = write_archives(pages.select(F.col("page_id").cast("long"), "url", "html"), root, min_revisit_bytes)
    return records(read_archives(manifest, root, keep_data=False))
