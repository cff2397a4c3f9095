"""Deterministic sharded WARC writer and reader.

Records are range-sorted by a 64-bit hash of their id (a uniform key, so the range bounds are
known without sampling and one shard never holds more than its share), each shard is written
by one task that rolls to a new file once the compressed size passes ``roll_bytes``. Headers
and digests are made anew from the rows. Files are written under a temporary name that is
unique to the task attempt; the list of what the successful attempts wrote is stored, then the
files are moved to their final names and the manifest is written last. Only files in the
manifest count, so attempts that were lost leave nothing that a reader sees.

Records with equal payloads of at least ``dedup_bytes`` become one ``response`` (the largest
id) and ``revisit`` records that refer to it.

Defined results: null payload is empty; null url becomes an empty target; a null id is written
as an empty id and is never referred to unless all ids of the group are null (then all are
responses). Rows that repeat the largest id are all responses. Other columns are ignored. An
empty table gives no files, an empty manifest and no records.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, scratch_path, ship_package, table, written

MIN_DEDUP_BYTES = 1000
ROLL_BYTES = 256 << 20
SHARD_BYTES = 512 << 20          # payload bytes of one shard (before compression)
SALTS = 16
DATE = "2024-01-01T00:00:00Z"    # fixed: the same input gives the same bytes
CRLF = b"\r\n"
RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, "
                 "record_type string, refers_to long, payload binary, file string")


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str,
                 dedup_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Input of ``write_warc``: every row with its payload (``kind`` 1), and for every row that
    shall be a revisit a small row in front of it that says so (``kind`` 0, no payload).

    Groups are formed on (digest, size) and salted, so a payload that a third of all rows
    share is aggregated map-side and joined over ``SALTS`` tasks. Payloads take no part in the
    join; they are shuffled once, into their shards.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload")
    ).withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    keyed = rows.drop("payload").where(F.col("size") >= dedup_bytes)
    groups = (keyed.groupBy("digest", "size").agg(F.max("id").alias("head"), F.count("*").alias("n"))
                   .where("n > 1 and head is not null").drop("n")
                   .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    revisits = (keyed.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
                     .join(groups, ["digest", "size", "salt"])
                     .where("id is null or id < head")
                     .select("id", "url", "digest", "size", F.col("head").alias("refers_to"),
                             F.lit(None).cast("binary").alias("payload"), F.lit(0).alias("kind")))
    return rows.select("id", "url", "digest", "size", F.lit(None).cast("long").alias("refers_to"),
                       "payload", F.lit(1).alias("kind")).unionByName(revisits)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def _sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes | None, digest: str,
                size: int, refers_to: int | None) -> bytes:
    """One record (not compressed); ``payload`` None makes a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Target-URI: {quote(url or '', safe=_URL_SAFE)}",
        f"WARC-Date: {DATE}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: {_sha1_label(block)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


_URL_SAFE = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) not in '%')


def _gzip_member(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)     # gzip header without time stamp
    return c.compress(data) + c.flush()


def write_warc(records: DataFrame, root: str, shards: int, roll_bytes: int = ROLL_BYTES,
               level: int = 6) -> DataFrame:
    """Write ``plan_records`` rows as archives under ``root``; returns the manifest
    (``path, shard, part, records, bytes, sha256``)."""
    ship_package(records.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        attempt = uuid.uuid4().hex
        out = sink = None
        shard, part, made = 0, 0, []
        revisit: tuple = (None, None)            # the last row that was announced as a revisit

        def close():
            nonlocal out, sink, part
            sink.close()
            made.append((out["tmp"], shard, part, out["n"], out["bytes"], out["sha"].hexdigest()))
            out = sink = None
            part += 1

        for b in batches:
            shard = b.column(b.schema.get_field_index("shard"))[0].as_py() if len(b) else shard
            cols = [b.column(b.schema.get_field_index(c))
                    for c in ("id", "url", "digest", "size", "refers_to", "kind", "payload")]
            for i in range(len(b)):
                page, url, digest, size, head, kind = (c[i].as_py() for c in cols[:6])
                if kind == 0:
                    revisit = (page, url, digest), head
                    continue
                head = revisit[1] if revisit[0] == (page, url, digest) else None
                payload = cols[6][i].as_py() if head is None else None
                data = _gzip_member(make_record(page, url, payload, digest, size, head), level)
                if out and out["bytes"] + len(data) > roll_bytes:
                    close()
                if out is None:
                    tmp = f"_temporary/{attempt}-{shard:05d}-{part:05d}"
                    fs.create_dir(posixpath.join(base, "_temporary"), recursive=True)
                    sink = fs.open_output_stream(posixpath.join(base, tmp), compression=None)
                    out = {"tmp": tmp, "n": 0, "bytes": 0, "sha": hashlib.sha256()}
                sink.write(data)
                out["n"] += 1
                out["bytes"] += len(data)
                out["sha"].update(data)
        if out:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names)

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        for b in batches:
            paths = []
            for tmp, shard, part in zip(*(b.column(i).to_pylist() for i in range(3))):
                name = f"part-{shard:05d}-{part:05d}.warc.gz"
                src, dst = posixpath.join(base, tmp), posixpath.join(base, name)
                if fs.get_file_info(src).type.name != "NotFound":   # else moved by an earlier attempt
                    fs.move(src, dst)
                paths.append(f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array(paths), *b.columns[1:]], ["path", *names[1:]])

    names = ["tmp", "shard", "part", "records", "bytes", "sha256"]
    rest = "shard int, part int, records long, bytes long, sha256 string"
    key = F.shiftrightunsigned(F.xxhash64("id", "digest"), 32)
    sorted_rows = (records.withColumn("key", key)
                          .withColumn("shard", F.floor(F.col("key") * F.lit(shards) / F.lit(1 << 32)).cast("int"))
                          .repartitionById(shards, F.col("shard"))
                          .sortWithinPartitions("shard", "key", "id", "digest", "url", "kind"))
    # int columns come out of Python as int64: keep the declared types
    def typed(f):
        def g(batches):
            for x in f(batches):
                yield x.cast(schema_of(x.schema.names[0]))
        return g

    def schema_of(first: str) -> pa.Schema:
        return pa.schema([(first, pa.string()), ("shard", pa.int32()), ("part", pa.int32()),
                          ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    found = written(sorted_rows.mapInArrow(typed(write), f"tmp string, {rest}"), "warc_written")
    return written(found.mapInArrow(typed(commit), f"path string, {rest}"), "warc_manifest")


def _members(stream) -> Iterator[bytes]:
    """Decompressed gzip members, one record each."""
    d, parts, data = zlib.decompressobj(31), [], stream.read(1 << 20)
    while data:
        parts.append(d.decompress(data))
        if d.eof:
            yield b"".join(parts)
            data, d, parts = d.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(1 << 20)
    if any(parts):
        raise ValueError("truncated WARC file")


def parse_record(record: bytes) -> tuple:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)``; digests
    are computed from the record and compared with its headers."""
    from urllib.parse import unquote
    head, _, rest = record.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:] if ": " in x) | {x[:-1]: "" for x in lines[1:] if x.endswith(":")}
    block = rest[:int(h["Content-Length"])]
    if _sha1_label(block) != h["WARC-Block-Digest"]:
        raise ValueError(f"block digest differs in {h['WARC-Record-ID']}")
    payload = block.partition(CRLF + CRLF)[2]
    digest = base64.b32decode(h["WARC-Payload-Digest"][5:]).hex()
    if h["WARC-Type"] == "response" and (
            hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(h["X-Payload-Length"])):
        raise ValueError(f"payload digest differs in {h['WARC-Record-ID']}")
    return (int(h["X-Page-Id"]) if h.get("X-Page-Id", "").strip() else None,
            unquote(h["WARC-Target-URI"].strip()), int(h["X-Payload-Length"]), digest, h["WARC-Type"],
            int(h["X-Refers-To-Page"]) if "X-Refers-To-Page" in h else None,
            payload if h["WARC-Type"] == "response" else None)


def read_warc(manifest: DataFrame, with_payload: bool = True, batch_bytes: int = 16 << 20) -> DataFrame:
    """Records of the files that a manifest lists (one task per file; a file is a stream, so
    memory is bounded by its largest record and ``batch_bytes``)."""
    ship_package(manifest.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary()), ("file", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, p = file_system(path)
                rows, size = [], 0
                with fs.open_input_stream(p, compression=None) as stream:
                    for record in _members(stream):
                        r = parse_record(record)
                        rows.append((*r[:6], r[6] if with_payload else None, path))
                        size += len(record) if with_payload else 200
                        if size > batch_bytes:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    files = max(1, manifest.count())
    # one task a file, spread by the file's number
    return (manifest.select("path").repartition(files, "path").mapInArrow(read, RECORD_SCHEMA))


def shard_count(pages: DataFrame, payload_col: str, shard_bytes: int = SHARD_BYTES,
                least: int | None = None) -> int:
    """Shards for the table's payload bytes (over all rows)."""
    total = pages.agg(F.sum(F.octet_length(payload_col).cast("long")).alias("b")).first()["b"] or 0
    return max(1, least or 1, -(-total // shard_bytes))


def export_pages(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html", shards: int | None = None,
                 roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """``pages`` to WARC files under ``root``; returns the manifest."""
    n = shards or shard_count(pages, payload_col)
    return write_warc(plan_records(pages, id_col, url_col, payload_col), root, n, roll_bytes)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``pages`` row to a WARC record and back from the archives."""
    pages = table(spark, sf_dir, "pages")
    n = shard_count(pages, "html", shard_bytes=16 << 20)
    manifest = export_pages(pages, scratch_path(spark, "warc"), shards=n, roll_bytes=8 << 20)
    return read_warc(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS digest,
         CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS head FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < head THEN head END AS refers_to
FROM g
"""
