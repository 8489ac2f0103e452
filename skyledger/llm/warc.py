"""A deterministic, sharded WARC writer and its reader.

Records are cut into shards by ranges of the page id, sorted inside a shard, and written as
one gzip member each; a file is closed once its compressed size reaches a limit. Headers,
record ids and digests are regenerated from the row, so the same table gives the same bytes,
whatever the cluster. Tasks write under temporary names; Spark commits one manifest row per
finished file; only files of the manifest are renamed to their place, and the final manifest
is written last. A reader sees the files of the final manifest and nothing else, so a lost
executor or a second attempt leaves no trace.

Files go through `pyarrow.fs`, so the folder may be any address it knows that all executors
share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import range_bounds, range_index, stored
from skyledger.session import scratch_folder

SHARD_BYTES = 64 << 20
ROLL_BYTES = 32 << 20
MIN_BYTES = 0
LEVEL = 6
MAX_SHARDS = 1_000
DATE = "2024-01-01T00:00:00Z"
# Names of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE, REFERS = "X-Page-ID", "X-Refers-To-Page-ID"

MANIFEST = "shard long, part long, name string, temporary string, bytes long, records long, sha256 string"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary, file string"
)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_id(page, digest: str) -> str:
    name = hashlib.sha1(f"{page}:{digest}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=name, version=5)}>"


def _head(first: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [first, *(f"{name}: {value}" for name, value in fields if value is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _one_line(value: str | None) -> str | None:
    """A header value without control characters, which would end the line; blanks at its ends too."""
    if value is None:
        return None
    return "".join(c if c >= " " and c != "%" and c != "\x7f" else f"%{ord(c):02X}" for c in value).replace(" ", "%20")


def record_bytes(page, url, kind: str, digest: str, size: int, refers_to, payload: bytes) -> bytes:
    """One whole record. A revisit has the headers of its answer and no payload."""
    block = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)])
    if kind == "response":
        block += payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).hexdigest())}"),
        (PAGE, page),
    ]
    if kind == "revisit":
        fields += [
            ("WARC-Profile", SAME_PAYLOAD),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            (REFERS, refers_to),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return _head(VERSION, fields) + block + b"\r\n\r\n"


def info_bytes(name: str) -> bytes:
    block = b"software: skyledger\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", record_id(name, "info")),
        ("WARC-Date", DATE),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(block)),
    ]
    return _head(VERSION, fields) + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class _File:
    """One archive file under its temporary name."""

    def __init__(self, system, base: str, shard: int, part: int, level: int):
        self.system, self.level, self.shard, self.part = system, level, shard, part
        self.name = f"part-{shard:05d}-{part:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        system.create_dir(f"{base}/_temporary", recursive=True)
        self.stream = system.open_output_stream(f"{base}/{self.temporary}", compression=None)
        self.digest, self.bytes, self.records = hashlib.sha256(), 0, 0
        self.write(info_bytes(self.name))

    def write(self, record: bytes) -> None:
        member = _member(record, self.level)
        self.stream.write(member)
        self.digest.update(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.stream.close()
        return (self.shard, self.part, self.name, self.temporary, self.bytes, self.records, self.digest.hexdigest())


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = pa.schema([(n, kinds[t]) for n, t in (x.strip().split(" ") for x in schema.split(","))])
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=fields)


def revisits(narrow: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, size, digest -> page_id, digest, refers_to of the rows that repeat a payload.

    Told from ids and digests alone. Firsts are minima that combine on the map side, and
    Spark splits a digest that many rows share.
    """
    firsts = (
        narrow.where(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    again = F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))
    return narrow.join(firsts, "digest").where(again).select("page_id", "digest", "refers_to").distinct()


def write_archive(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = MIN_BYTES,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    level: int = LEVEL,
) -> DataFrame:
    """Write an archive into a new folder; its final manifest, one row per file.

    A null page is an empty payload; a null url leaves its header out. Of equal payloads of
    at least `min_bytes` the smallest page id is the response and larger ids are revisits;
    rows repeated with that smallest id are responses too, as none comes before the others.
    Null ids come last here and first in their shard. An empty table gives an empty manifest.
    Other columns play no part.
    """
    spark = pages.sparkSession
    picked = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )
    size, digest = F.octet_length("html").cast("long"), F.sha1("html")
    narrow = stored(picked.select("page_id", size.alias("size"), digest.alias("digest")), "warc-digests")
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()["size"]
    shards = max(1, min(MAX_SHARDS, -(-total // shard_bytes)))
    bounds = range_bounds(narrow, "page_id", shards)
    none = F.lit(None)
    # A page moves once, to its shard. What it refers to comes as a row just before it.
    told = revisits(narrow, min_bytes).select(
        "page_id", "digest", F.lit(0).alias("order"), "refers_to", none.cast("string").alias("url"), none.cast("string").alias("html")
    )
    records = picked.select(
        "page_id", digest.alias("digest"), F.lit(1).alias("order"), none.cast("long").alias("refers_to"), "url", "html"
    )
    cut = (
        records.unionByName(told)
        .withColumn("shard", range_index(F.col("page_id"), bounds))
        .repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", "page_id", "digest", "order", "url")
    )

    def write(batches):
        system, base = _file_system(folder)
        file, known = None, None
        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                page, digest, order, refers_to, address, text, shard = (v.as_py() for v in values)
                if order == 0:
                    known = (page, digest, refers_to)
                    continue
                if file and (file.shard != shard or file.bytes >= roll_bytes):
                    part = file.part + 1 if file.shard == shard else 0
                    yield _rows(MANIFEST, [file.close()])
                    file = _File(system, base, shard, part, level)
                file = file or _File(system, base, shard, 0, level)
                payload = text.encode()
                again = known is not None and known[:2] == (page, digest)
                kind, first = ("revisit", known[2]) if again else ("response", None)
                file.write(record_bytes(page, address, kind, base32(digest), len(payload), first, payload))
        if file:
            yield _rows(MANIFEST, [file.close()])

    written = stored(cut.mapInArrow(write, MANIFEST), "warc-written")

    def commit(batches):
        from pyarrow import fs

        system, base = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                place, temporary = f"{base}/{row['name']}", f"{base}/{row['temporary']}"
                if system.get_file_info(temporary).type != fs.FileType.NotFound:
                    system.move(temporary, place)
                if system.get_file_info(place).size != row["bytes"]:
                    raise OSError(f"{place}: not the size that was written")
            yield batch

    written.mapInArrow(commit, MANIFEST).drop("temporary").write.parquet(f"{folder}/manifest")
    system, base = _file_system(folder)
    system.create_dir(f"{base}/_temporary", recursive=True)
    system.delete_dir(f"{base}/_temporary")
    return spark.read.parquet(f"{folder}/manifest")


def _fields(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline().decode().rstrip("\r\n")) != "":
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def read_records(stream):
    """The response and revisit records of an unpacked archive; digests are checked."""
    while line := stream.readline():
        if line.decode().strip() != VERSION:
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = _fields(stream)
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        if fields["warc-type"] not in ("response", "revisit"):
            continue
        if fields["warc-block-digest"] != f"sha1:{base32(hashlib.sha1(block).hexdigest())}":
            raise ValueError(f"block digest of {fields['warc-record-id']}")
        inner = io.BytesIO(block)
        inner.readline()
        answer = _fields(inner)
        payload = inner.read() if fields["warc-type"] == "response" else None
        size, digest = int(answer["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
        if payload is not None and (len(payload), base32(hashlib.sha1(payload).hexdigest())) != (size, digest):
            raise ValueError(f"payload of {fields['warc-record-id']}")
        page, refers_to = fields.get(PAGE.lower()), fields.get(REFERS.lower())
        yield (
            None if page is None else int(page),
            fields.get("warc-target-uri"),
            fields["warc-type"],
            size,
            digest,
            None if refers_to is None else int(refers_to),
            payload,
        )


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files in the final manifest, one task a file, one record at a time."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("name", "bytes")
    files = max(1, manifest.count())

    def read(batches):
        system, base = _file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for record in read_records(io.BufferedReader(stream)):
                        payload = record[-1] if with_payload else None
                        rows.append((*record[:-1], payload, name))
                        size += len(payload or b"") + 200
                        if size > ROLL_BYTES // 8:
                            yield _rows(RECORDS, rows)
                            rows, size = [], 0
                if rows:
                    yield _rows(RECORDS, rows)

    return manifest.repartition(files, "name").mapInArrow(read, RECORDS)


def query(spark, sf_dir: str) -> DataFrame:
    """op3: every page written to archives, and what reading them back gives."""
    from skyledger.llm.common import table

    folder = scratch_folder(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder, with_payload=False).drop("payload", "file", "url")


# DuckDB has no base 32: 5 bits at a time, from the hex digits of the digest.
SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), bits AS (
  SELECT *, list_aggregate([format('{:04b}', instr('0123456789abcdef', h) - 1) FOR h IN string_split(hex, '')],
                           'string_agg', '') AS b
  FROM hashed
), digests AS (
  SELECT page_id, payload_bytes, hex,
         list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                CAST(16 * CAST(substr(b, 5*i + 1, 1) AS INT) + 8 * CAST(substr(b, 5*i + 2, 1) AS INT)
                                   + 4 * CAST(substr(b, 5*i + 3, 1) AS INT) + 2 * CAST(substr(b, 5*i + 4, 1) AS INT)
                                   + CAST(substr(b, 5*i + 5, 1) AS INT) AS INT) + 1, 1) FOR i IN range(32)],
                        'string_agg', '') AS payload_digest
  FROM bits
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id OR (page_id IS NULL AND first_id IS NOT NULL) THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id > first_id OR (page_id IS NULL AND first_id IS NOT NULL) THEN first_id END AS refers_to
FROM firsts
"""
