r"""URL verdicts from host and path rules kept in a sorted digest array.

The rules are strings ``host + path``. The index is one file per digest range in the shared
folder: sorted 64-bit xxhash keys, string offsets and the full strings. Executors memory-map
the files, probe a whole batch with one vectorised binary search and confirm every hit
against the stored string, so equal digests of different strings never match.

Defined results: a null url or one without ``://`` has an empty host and path and meets no
rule. A url that no rule fits is allowed (the list holds every blocked place). Empty input
gives no rows; repeated rows give one row each; other columns of the input are ignored.
Rules that are null or without a path are left out; of the same rule with two verdicts, ``block`` holds.
"""

from __future__ import annotations

import posixpath
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, scratch_path, ship_package, table, write_bytes

# The rules of the query (host + path, verdict).
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
SHARD_ENTRIES = 50_000_000
_HEADER = struct.Struct("<QQ")
_LOWER = {i: i + 32 for i in range(65, 91)}


def pack_digests(strings: Sequence[bytes], values: Sequence[int]) -> bytes:
    """File image: counts, sorted digests, offsets, values, strings."""
    digest = np.array([xxhash.xxh64_intdigest(s) for s in strings], dtype=np.uint64)
    order = np.argsort(digest, kind="stable")
    blob = [strings[i] for i in order]
    off = np.zeros(len(blob) + 1, dtype=np.uint64)
    off[1:] = np.cumsum([len(s) for s in blob])
    data = b"".join(blob)
    return b"".join([_HEADER.pack(len(blob), len(data)), digest[order].tobytes(), off.tobytes(),
                     np.asarray(values, dtype=np.uint64)[order].tobytes(), data])


class DigestArray:
    """A memory-mapped sorted digest array."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n, size = _HEADER.unpack(raw[:_HEADER.size].tobytes())
        at = _HEADER.size
        self.keys = raw[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.offsets = raw[at:at + 8 * (n + 1)].view(np.uint64)
        at += 8 * (n + 1)
        self.values = raw[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.data = raw[at:at + size]

    def probe(self, strings: Sequence[bytes], digests: np.ndarray) -> np.ndarray:
        """Value of each string, or -1. Digest hits are confirmed on the full string."""
        out = np.full(len(strings), -1, dtype=np.int64)
        at = np.searchsorted(self.keys, digests)
        live = np.flatnonzero(at < len(self.keys))
        while len(live):                       # runs of equal digests: step through them
            live = live[(at[live] < len(self.keys))]
            live = live[self.keys[at[live]] == digests[live]]
            missed = []
            for i in live.tolist():
                k = int(at[i])
                if self.data[int(self.offsets[k]):int(self.offsets[k + 1])].tobytes() == strings[i]:
                    out[i] = int(self.values[k])
                else:
                    missed.append(i)
            live = np.array(missed, dtype=np.int64)
            at[live] += 1
        return out


def build_digest_array(rules: DataFrame, shards: int | None = None) -> tuple[list[str], list[int], int]:
    """Write ``rules`` (columns ``rule``, ``verdict``) as digest files, one per digest range.

    Returns the file paths (one per shard, in digest order), the distinct lengths of rule
    paths, both small, and the length of the longest rule host. The rules themselves never pass through the driver.
    """
    spark = rules.sparkSession
    ship_package(spark)
    clean = (rules.where("instr(rule, '/') > 0 and verdict is not null")
                  .groupBy("rule").agg(F.max((F.col("verdict") == "block").cast("int")).alias("value")))
    sized = clean.agg(F.count("*").alias("n"), F.max(F.expr("instr(rule, '/') - 1")).alias("host")).first()
    n = int(shards or max(1, -(-sized["n"] // SHARD_ENTRIES)))
    lengths = [r["k"] for r in clean.select(
        F.length(F.expr("substr(rule, instr(rule, '/'))")).alias("k")).distinct().collect()]
    root = scratch_path(spark, "digests")

    def digest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = [xxhash.xxh64_intdigest(s.encode()) * n >> 64 for s in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d, pa.int32())],
                                             ["rule", "value", "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, values, shard = [], [], None
        for b in batches:
            strings += [s.encode() for s in b.column(0).to_pylist()]
            values += b.column(1).to_pylist()
            shard = b.column(2)[0].as_py() if len(b) else shard
        if shard is not None:
            path = f"{root}/{shard:06d}.xxh"
            write_bytes(path, pack_digests(strings, values))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([path])],
                                             ["shard", "path"])

    made = (clean.mapInArrow(digest_of, "rule string, value int, shard int")
                 .repartitionById(n, F.col("shard"))
                 .mapInArrow(write, "shard int, path string").collect())
    paths = [""] * n
    for r in made:
        paths[r["shard"]] = r["path"]
    return paths, sorted(lengths), sized["host"] or 0


def _local(path: str) -> str:
    """A path that can be memory-mapped: the shared mount itself, else Spark's own copy."""
    fs, inner = file_system(path)
    return inner if fs.type_name == "local" else SparkFiles.get(posixpath.basename(path))


def host_and_path(url: str | None) -> tuple[str, str]:
    if not url:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    cut = min((i for i in (rest.find("/"), rest.find("?"), rest.find("#")) if i >= 0),
              default=len(rest))
    tail = rest[cut:]
    end = min((i for i in (tail.find("?"), tail.find("#")) if i >= 0), default=len(tail))
    return rest[:cut].translate(_LOWER), tail[:end]


def judge_urls(urls: DataFrame, id_col: str, url_col: str, rules: DataFrame) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row of ``urls``."""
    spark = urls.sparkSession
    ship_package(spark)
    paths, lengths, longest = build_digest_array(rules)
    for p in filter(None, paths):
        if file_system(p)[0].type_name != "local":
            spark.sparkContext.addFile(p)
    n = len(paths)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [DigestArray(_local(p)) if p else None for p in paths]
        for b in batches:
            hosts, url_paths, keys, owner = [], [], [], []
            for i, url in enumerate(b.column(1).to_pylist()):
                host, path = host_and_path(url)
                hosts.append(host)
                url_paths.append(path)
                if not host:
                    continue
                # longer suffixes are no rule's host
                at = host.find(".", len(host) - longest - 1) if len(host) > longest else -1
                if at < 0 and len(host) > longest:
                    continue
                suffix = host[at + 1:]
                while True:
                    for k in lengths:
                        if k <= len(path):
                            keys.append((suffix + path[:k]).encode("utf-8", "surrogatepass"))
                            owner.append(i)
                    dot = suffix.find(".")
                    if dot < 0:
                        break
                    suffix = suffix[dot + 1:]
            digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
            found = np.full(len(keys), -1, dtype=np.int64)
            shard = (np.array([(int(d) * n) >> 64 for d in digests]) if n > 1
                     else np.zeros(len(keys), dtype=np.int64))
            for s in np.unique(shard).tolist():
                if arrays[s] is not None:
                    at = np.flatnonzero(shard == s)
                    found[at] = arrays[s].probe([keys[j] for j in at.tolist()], digests[at])
            rule: list[str | None] = [None] * len(b)
            verdict = ["allow"] * len(b)
            size = [-1] * len(b)
            for j in np.flatnonzero(found >= 0).tolist():
                i = owner[j]
                if len(keys[j]) > size[i]:
                    size[i], rule[i] = len(keys[j]), keys[j].decode()
                    verdict[i] = "block" if found[j] else "allow"
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(hosts, pa.string()), pa.array(url_paths, pa.string()),
                 pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                [id_col, "host", "path", "rule", "verdict"])

    kind = dict(urls.dtypes)[id_col]
    return urls.select(id_col, url_col).mapInArrow(
        judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every ``pages`` url under the fixed rules."""
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), "page_id", "url", rules)


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages),
p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM u),
r(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, host, path, rh || rp AS rule, rv,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM m WHERE k = 1
"""

__all__ = ["DigestArray", "build_digest_array", "host_and_path", "judge_urls", "op6_url_filter"]
