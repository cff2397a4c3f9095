"""Centroid clustering of integer vectors by a bisector tournament.

Vectors are turned into integers (``floor(scale * x)``), so all arithmetic is exact and the result depends
neither on partitions nor on their order. For centroids a < b, x is no nearer to b than to a exactly if
``x . 2(b - a) <= |b|^2 - |a|^2``. These integer normals and thresholds are computed once a round for all
pairs; a vector then plays k - 1 sign tests, the winner so far against the next centroid, and a
zero favours the smaller number. Only the distance to the winner is computed.

A round is one pass over the table: every task adds up its own vectors by cluster and sends at most
k x dims sums, which Spark adds up. The k centroids (k x dims integers, parameters of the caller) are all that
reaches the driver and goes back to the tasks; rows are never grouped or moved.

Integers are int64 where no product can overflow (components up to ``2 ** 26`` at 64 dims) and Python
integers beyond that, row by row.

Defined results: vectors that are null, of another length, or hold null or non-finite components give no
row. Starting centroids are the kept vectors with the smallest hash of ``<salt>:<id>`` (ties: by the vector);
rows without an id are assigned but never start a centroid. With fewer than k kept rows there are
that many centroids; with none with an id, ``cluster`` and what follows from it are null. Equal rows may start
several centroids; the larger numbers then stay empty and keep their place. A distance or sum beyond a
long is null. Other columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, table, written

LIMB = 60                         # sums travel as high and low parts of this many bits
LONG = (1 << 63) - 1
ROWS = 8192                       # rows a step


def usable(vec: Column, dims: int) -> Column:
    """True for vectors of ``dims`` finite components."""
    return F.coalesce((F.size(vec) == dims) & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles; int64 where all fit well, else Python integers."""
    if not x.size or np.abs(x).max() * scale < 2.0 ** 62:
        return np.floor(x * scale).astype(np.int64)
    exact = [math.floor(v * scale) if abs(v) < 2.0 ** 52 else int(v) * scale for v in x.ravel().tolist()]
    out = np.empty(len(exact), dtype=object)
    out[:] = exact
    return out.reshape(x.shape)


@dataclass
class Bisectors:
    """Centroids (Python integers) and, for pairs a < b, the normal and threshold of the plane between them."""
    centroids: list[list[int]]
    room: int                     # components up to this size are safe in int64
    centre: np.ndarray
    normal: np.ndarray            # [k, k, dims]
    threshold: np.ndarray         # [k, k]


def bisectors(centroids: list[list[int]]) -> Bisectors:
    dims = len(centroids[0])
    room = 1 << ((62 - 3 - max(1, dims - 1).bit_length()) // 2)
    small = all(abs(v) <= room for c in centroids for v in c)
    c = np.array(centroids, dtype=np.int64 if small else object)
    norm = (c * c).sum(axis=1)
    return Bisectors(centroids, room, c, 2 * (c[None, :, :] - c[:, None, :]), norm[None, :] - norm[:, None])


def tournament(x: np.ndarray, b: Bisectors) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row and the squared distance to it."""
    if x.dtype != object and b.centre.dtype != object and len(x) and np.abs(x).max() > b.room:
        # a few large rows: the others keep the fast way
        big = np.abs(x).max(axis=1) > b.room
        if not big.all():
            won, dist = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=object)
            for part in (big, ~big):
                won[part], dist[part] = tournament(x[part], b)
            return won, dist
    if x.dtype == object or b.centre.dtype == object or (len(x) and np.abs(x).max() > b.room):
        x = x.astype(object)
        b = Bisectors(b.centroids, b.room, *(a.astype(object) for a in (b.centre, b.normal, b.threshold)))
    won = np.zeros(len(x), dtype=np.int64)
    for j in range(1, len(b.centroids)):
        side = (x * b.normal[won, j]).sum(axis=1)
        won[side > b.threshold[won, j]] = j
    return won, ((x - b.centre[won]) ** 2).sum(axis=1)


def _matrix(vec: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(vec.flatten().cast(pa.float64())).reshape(len(vec), dims)


def _as_long(x: np.ndarray) -> pa.Array:
    if x.dtype != object:
        return pa.array(x, pa.int64())
    return pa.array([int(v) if v <= LONG else None for v in x], pa.int64())


def _add_up(rows: DataFrame, b: Bisectors, dims: int, scale: int) -> dict[tuple[int, int], tuple[int, int]]:
    """``(cluster, dim) -> (count, sum)`` over all rows."""
    k = len(b.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                x = integers(_matrix(batch.column(0).slice(lo, ROWS), dims), scale)
                won, _ = tournament(x, b)
                count += np.bincount(won, minlength=k)
                if x.dtype != object and np.abs(x).max() >= 1 << 45:     # sums of a step must fit
                    x = x.astype(object)
                for j in np.unique(won).tolist():
                    total[j] += x[won == j].sum(axis=0).astype(object)
        seen = np.flatnonzero(count).tolist()
        sums = [int(v) for j in seen for v in total[j]]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(seen, dtype=np.int32), dims)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(seen))),
             pa.array(np.repeat(count[seen], dims)),
             pa.array([Decimal(v >> LIMB) for v in sums], kind), pa.array([Decimal(v & ((1 << LIMB) - 1)) for v in sums], kind)],
            ["cluster", "dim", "n", "high", "low"])

    got = (rows.select("vec").mapInArrow(run, "cluster int, dim int, n long, high decimal(38,0), low decimal(38,0)")
               .groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("high").cast("string").alias("high"),
                                              F.sum("low").cast("string").alias("low")))
    return {(r["cluster"], r["dim"]): (r["n"], (int(r["high"]) << LIMB) + int(r["low"]))
            for r in got.collect()}                               # k x dims rows


def centroid_digest(c: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()


def cluster(df: DataFrame, id_col: str, vec_col: str, dims: int, k: int = 16, rounds: int = 3, scale: int = 64,
            salt: str = "1") -> tuple[DataFrame, list[list[int]]]:
    """``id, cluster, distance`` of every usable row (written), and the final centroids."""
    spark = df.sparkSession
    ship_package(spark)
    kind = dict(df.dtypes)[id_col]
    rows = df.where(usable(F.col(vec_col), dims)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    first = (rows.where("id is not null")
                 .select("vec", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).alias("hash"))
                 .orderBy("hash", "vec").limit(k).collect())      # k rows
    centroids = [[int(v) for v in integers(np.array(r["vec"], dtype=np.float64), scale).tolist()] for r in first]
    for _ in range(rounds if centroids else 0):
        sums = _add_up(rows, bisectors(centroids), dims, scale)
        centroids = [[sums[j, d][1] // sums[j, d][0] for d in range(dims)] if (j, 0) in sums else c
                     for j, c in enumerate(centroids)]
    if not centroids:
        return rows.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), []
    b = bisectors(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                won, dist = tournament(integers(_matrix(batch.column(1).slice(lo, ROWS), dims), scale), b)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, ROWS), pa.array(won.astype(np.int32)), _as_long(dist)],
                                                 ["id", "cluster", "distance"])

    return written(rows.mapInArrow(run, f"id {kind}, cluster int, distance long"), "bisector"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` (null beyond a long) and ``centroid_sha256``."""
    spark = assigned.sparkSession
    exact = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    each = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(exact.alias("s")).collect()}    # k rows at most
    long = lambda v: None if v is None or v > LONG else int(v)
    whole = None if None in each.values() else long(sum(each.values()))
    known = spark.createDataFrame([(j, long(each.get(j)), whole, centroid_digest(c)) for j, c in enumerate(centroids)],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster", "left")   # k rows


def op12_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` of 64 components in 16 clusters after 3 rounds."""
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", dims=64)
    return with_inertia(assigned, centroids).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                                                    "centroid_sha256")


def _sql(k: int = 16, dims: int = 64, rounds: int = 3, scale: int = 64, salt: str = "1") -> str:
    """The same in DuckDB SQL, one (row, component) a line."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS (SELECT x.rid, c.cluster, sum((x.v - c.v) * (x.v - c.v)) AS dist FROM x JOIN c{n} c USING (d) GROUP BY ALL),
a{n} AS (SELECT rid, arg_min(cluster, dist * {k} + cluster) AS cluster, min(dist) AS distance FROM d{n} GROUP BY rid)""")
        if n < rounds:
            steps.append(f"""
s{n} AS (SELECT cluster, d, sum(v) AS s, count(*)::HUGEINT AS n FROM x JOIN a{n} USING (rid) GROUP BY ALL),
c{n + 1} AS (SELECT cluster, d, CASE WHEN n IS NULL THEN v ELSE (s - (s % n + n) % n) // n END AS v
             FROM c{n} LEFT JOIN s{n} USING (cluster, d))""")
    return f"""
WITH e AS (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings WHERE len(embedding) = {dims}),
f AS (SELECT rid, vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS d FROM e),
ok AS (SELECT rid, any_value(vec_id) AS vec_id FROM f GROUP BY rid HAVING bool_and(v IS NOT NULL AND isfinite(v))),
x AS (SELECT rid, d, floor({scale} * v)::HUGEINT AS v FROM f SEMI JOIN ok USING (rid)),
start AS (SELECT rid, row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS cluster FROM ok
          QUALIFY cluster < {k}),
c0 AS (SELECT cluster, d, v FROM start JOIN x USING (rid)),{','.join(steps)},
per AS (SELECT cluster, sum(distance) AS cluster_inertia FROM a{rounds} GROUP BY cluster),
dig AS (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(cluster_inertia) FROM per) AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN ok USING (rid) JOIN per USING (cluster) JOIN dig USING (cluster)
"""


ORACLE = _sql()
