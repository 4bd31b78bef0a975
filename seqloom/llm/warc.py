"""WARC archives: written record by record, read back as a table of chunks.

Writing: each task streams its records into gzip members of an archive in the shared folder and returns a line for each
archive. Equal payloads of at least LEAST_REVISIT bytes are stored once: the record with the largest id holds it, the
others are revisit records that name it.

Reading: a record becomes rows (record id, chunk number, bytes so far, digest so far, last), so a payload of any size
passes through in pieces of CHUNK bytes and is never in memory whole; the digest is carried from chunk to chunk.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import scratch
from .store import Writer, attempt_file, reader

LEAST_REVISIT = 1000
CHUNK = 1 << 18
READ = 1 << 18
#: An archive is closed once it has this many bytes, and the next one begun.
ARCHIVE_BYTES = 1 << 28
DATE = "2024-01-01T00:00:00Z"
NO_ID = -(1 << 63)


def roles(pages: DataFrame) -> DataFrame:
    """page_id, digest, size and the holder of the payload (null if the record holds it itself); narrow columns only.

    Holders come from partial maxima, so a payload that a third of all pages share moves no more than a row a task, and
    only payloads that are on several pages meet the pages again; Spark splits the hot ones in that join.
    """
    own = pages.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    holders = own.where(F.col("size") >= LEAST_REVISIT).groupBy("digest", "size").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "holder")
    return own.join(holders, "digest", "left").select("page_id", "digest", "size", F.when(F.col("holder") != F.col("page_id"), F.col("holder")).alias("holder"))


def head(kind: str, page_id: int | None, url: str | None, digest: str, size: int, body: int, holder: int | None) -> bytes:
    """The header block of a record, as lines of UTF-8."""
    clean = re.sub(r"[\r\n]+", " ", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {clean}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {body}",
    ]
    if holder is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{holder}>"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def write_archives(pages: DataFrame, folder: str | None = None) -> list[str]:
    """Writes a record for every row of pages (page_id, url, payload) and returns the archives' paths.

    The rows with their roles meet the payloads by page_id, which spreads them evenly whatever the payloads are. Tasks
    may run again when executors are lost: each attempt writes files of its own, and only those of ended tasks are named.
    """
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    keyed = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page_id"), "url", F.coalesce("payload", F.lit("")).alias("payload"))
    some = roles(keyed).where("holder is not null").select("page_id", "digest", "holder").distinct()
    rows = keyed.withColumn("digest", F.sha1("payload")).join(some, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "holder")
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def write(batches):
        out, path, records = None, None, 0
        for batch in batches:
            for page_id, url, payload, digest, holder in zip(*batch.columns, strict=True):
                if out is None:
                    out, records = Writer(path := attempt_file(folder, ".warc.gz")), 0
                page_id, holder, data = page_id.as_py(), holder.as_py(), memoryview(payload.as_buffer() or b"")
                body = 0 if holder is not None else len(data)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(pack.compress(head("response" if holder is None else "revisit", None if page_id == NO_ID else page_id, url.as_py(), digest.as_py(), len(data), body, holder)))
                for at in range(0, body, CHUNK):
                    out.write(pack.compress(data[at : at + CHUNK]))
                out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                records += 1
                if out.size >= ARCHIVE_BYTES:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"path": path, "records": records}], schema=schema)
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "records": records}], schema=schema)

    return sorted(r["path"] for r in rows.mapInArrow(write, "path string, records long").collect())  # a line for each archive


class Stream:
    """Bytes of an archive, unpacked member by member as they are asked for; plain files are read as they are."""

    def __init__(self, file):
        self.file, self.left, self.plain = file, b"", None
        self.unpack, self.ready = None, bytearray()

    def more(self) -> bool:
        """Adds some unpacked bytes; False at the end."""
        if not self.left:
            self.left = self.file.read(READ)
            if not self.left:
                return False
        if self.plain is None:
            self.plain = self.left[:2] != b"\x1f\x8b"
        if self.plain:
            self.ready += self.left
            self.left = b""
            return True
        if self.unpack is None or self.unpack.eof:
            self.unpack = zlib.decompressobj(31)
        self.ready += self.unpack.decompress(self.left, READ)
        self.left = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
        return True

    def line(self) -> bytes | None:
        while (at := self.ready.find(b"\n")) < 0:
            if not self.more():
                return None
        out = bytes(self.ready[: at + 1])
        del self.ready[: at + 1]
        return out

    def some(self, most: int) -> bytes:
        """Up to so many bytes; fewer only at the end."""
        while len(self.ready) < most and self.more():
            pass
        out = bytes(self.ready[:most])
        del self.ready[:most]
        return out


def chunks(file, chunk: int = CHUNK) -> Iterator[dict]:
    """The rows of the chunk table of one archive. A record without payload has one row, of no bytes."""
    stream = Stream(file)
    while (line := stream.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue  # blank lines after a record
        fields = {}
        while (line := stream.line()) not in (None, b"\r\n", b"\n"):
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            fields[name.strip().lower()] = value.strip()
        left, sha, done, number = int(fields["content-length"]), hashlib.sha1(), 0, 0
        while True:
            part = stream.some(min(chunk, left))
            if len(part) < min(chunk, left):
                raise EOFError(f"record {fields.get('warc-record-id')} ends early")
            sha.update(part)
            left, done = left - len(part), done + len(part)
            yield {"fields": fields, "chunk": number, "size": done, "sha1": sha.hexdigest(), "last": not left, "data": part}
            number += 1
            if not left:
                break


CHUNK_TABLE = "record_id string, record_type string, refers_to string, stated_bytes long, stated_digest string, chunk long, bytes_so_far long, sha1_so_far string, last boolean"


def read_chunks(spark, paths: list[str], with_data: bool = False, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of archives, an archive a task: CHUNK_TABLE and, if asked for, the bytes of each chunk."""
    out_type = CHUNK_TABLE + (", data binary" if with_data else "")
    if not paths:
        return spark.createDataFrame([], out_type)

    def run(batches):
        kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in out_type.split(", ")])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for c in chunks(reader(path), chunk):
                    f = c["fields"]
                    row = (f.get("warc-record-id"), f.get("warc-type"), f.get("warc-refers-to"), int(f.get("warc-payload-length", -1)), f.get("warc-payload-digest", "").removeprefix("sha1:"), c["chunk"], c["size"], c["sha1"], c["last"], *((c["data"],) if with_data else ()))
                    rows.append(row)
                    size += 500 + (len(c["data"]) if with_data else 0)
                    if size >= 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths)).mapInArrow(run, out_type)


def records(chunk_table: DataFrame) -> DataFrame:
    """A row for each record, from its last chunk: a response has the digest and size of the bytes read, a revisit those it states."""
    page = lambda c: F.nullif(F.regexp_extract(c, r"<urn:page:(-?\d*)>", 1), F.lit("")).cast("long")
    held = F.col("record_type") == "response"
    return chunk_table.where("last").select(
        page("record_id").alias("page_id"),
        F.when(held, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(held, F.col("sha1_so_far")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
        (F.when(held, F.col("sha1_so_far") == F.col("stated_digest")).otherwise(F.lit(True))).alias("intact"),
    )


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Every page as a record, written to archives and read back.

    A null payload counts as empty; payloads below LEAST_REVISIT bytes are always held. Rows repeated with one page_id
    and payload are records of their own: they hold the payload if theirs is the largest page_id. A page without an id
    never is the largest where another has one. An empty table gives none. Other columns are never read.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", F.col("html").alias("payload"))
    return records(read_chunks(spark, write_archives(pages)))
