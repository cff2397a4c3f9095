"""Positions of stored rows, and pairing of tables that share no key by position.

A row's position is the number of rows in the files before its own, plus its index inside the file (which the Parquet
reader gives). Files are in stored order: loads by the time of their first file, a load's files by their part
number. Counts per file are added up in groups of ``GROUP`` files and over the groups, so no window
holds all files; the table of offsets (two longs a file) is broadcast up to ``BROADCAST_FILES`` files and joined otherwise.
Rows are never sorted or numbered in one task.

Parquet tables and folders that Spark wrote, and Parquet files of any name (in the order of their names).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = 1000
LOCAL_FILES = 100_000
BROADCAST_FILES = 1_000_000
POSITION = "position"
# Fixed value: names of the files of one Spark write, e.g. part-00012-<uuid of the job>_00003.c000.snappy.parquet
_PART = r"^part-(\d+)-([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"


def file_offsets(df: DataFrame, local_files: int = LOCAL_FILES) -> DataFrame:
    """``file, rows, offset`` of every file that ``df`` (a plain read of stored files) reads; ``file`` is the
    hash of its path, ``offset`` the number of rows before it."""
    found = (df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("time"),
                       F.col("_metadata.row_index").alias("at"))
               .groupBy("path").agg((F.max("at") + 1).alias("rows"), F.min("time").alias("time")))
    if len(df.inputFiles()) <= local_files:
        return _added_up(df, found.select(F.xxhash64("path").alias("file"), "path", "rows", "time").collect())
    name = F.element_at(F.split("path", "/"), -1)
    files = found.select(F.xxhash64("path").alias("file"), "rows", "time", name.alias("name"),
                         F.regexp_extract(name, _PART, 2).alias("load"), F.regexp_extract(name, _PART, 1).alias("part"))
    files = files.withColumn("part", F.when(F.col("part") != "", F.col("part").cast("long")).otherwise(0))
    loads = files.groupBy("load").agg(F.min("time").alias("began"))
    # files of one write are in groups of part numbers, others are one group
    grouped = files.join(loads, "load").withColumn("group", F.floor(F.col("part") / GROUP))
    group = ["began", "load", "group"]
    before = lambda w: F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = grouped.groupBy(*group).agg(F.sum("rows").alias("rows"))
    starts = totals.select(*group, before(Window.orderBy(*group)).alias("start"))      # one row per GROUP files
    inside = before(Window.partitionBy(*group).orderBy("part", "name"))
    return grouped.withColumn("inside", inside).join(starts, group).select("file", "rows", (F.col("start") + F.col("inside")).alias("offset"))


def _added_up(df: DataFrame, files: list) -> DataFrame:
    """The offsets of collected ``file, path, rows, time`` rows: the order of the plan above."""
    parts, began = [], {}
    for f in files:
        name = f["path"].rsplit("/", 1)[-1]
        m = re.match(_PART, name)
        load = m[2] if m else ""
        began[load] = min(began.get(load, f["time"]), f["time"])
        parts.append((load, int(m[1]) if m else 0, name, f["file"], f["rows"]))
    out, before = [], 0
    for _, _, _, file, rows in sorted(parts, key=lambda p: (began[p[0]], *p)):
        out.append((file, rows, before))
        before += rows
    return df.sparkSession.createDataFrame(out, "file long, rows long, offset long")


def with_stored_position(df: DataFrame, col: str = POSITION, offsets: DataFrame | None = None) -> DataFrame:
    """``df`` (a plain read of stored files) with the 0-based position of every row in stored order;
    ``offsets`` are its ``file_offsets`` where they are known."""
    offsets = (offsets if offsets is not None else file_offsets(df)).select("file", "offset")
    if len(df.inputFiles()) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    rows = df.select("*", F.xxhash64(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.row_index").alias("_at"))
    return rows.join(offsets, rows["_file"] == offsets["file"]).select(*df.columns, (F.col("offset") + F.col("_at")).alias(col))


def pair_by_position(x: DataFrame, y: DataFrame, col: str = POSITION) -> DataFrame:
    """Row i of ``x`` with row i of ``y``, and their position as ``col``: for tables without a key, such as the two
    halves of one table that were written from it in the same order.

    Both are plain reads of stored files. Different numbers of rows are an error. Columns that both have are taken from ``x``.
    """
    taken = {c.lower() for c in x.columns}
    if col.lower() in taken or col.lower() in {c.lower() for c in y.columns}:
        raise ValueError(f"column {col!r} exists; choose another name for the position")
    offsets = [file_offsets(side) for side in (x, y)]
    n = [o.agg(F.sum("rows").alias("n")).first()["n"] or 0 for o in offsets]
    if n[0] != n[1]:
        raise ValueError(f"the tables do not pair up: {n[0]} and {n[1]} rows")
    rest = [c for c in y.columns if c.lower() not in taken]
    return with_stored_position(x, col, offsets[0]).join(with_stored_position(y, col, offsets[1]).select(*rest, col), col)
