"""Shared helpers: table access, written intermediate results, files in the shared folder."""

from __future__ import annotations

import ctypes
import io
import os
import posixpath
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path as _new_path
from ..session import shared_dir

_collecting: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh folder or file name in the shared folder, noted for ``collected``."""
    path = _new_path(spark, what)
    for paths in _collecting:
        paths.append(path)
    return path


@contextmanager
def collected() -> Iterator[list[str]]:
    """The scratch paths made inside, for ``discard`` once nothing reads them any more."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting.remove(paths)


def discard(spark: SparkSession, *what: str | DataFrame) -> None:
    """Delete scratch paths, or what ``written`` made. Only for results that were used up: all that was
    made from them is stored itself."""
    for x in what:
        for path in [x] if isinstance(x, str) else [getattr(x, "_stored_at", None)]:
            if path:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, so
    a lost executor re-reads files instead of re-running what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def written_parts(parts: Iterable[DataFrame], what: str) -> DataFrame:
    """Frames of one schema (one at least) written one after the other to one folder, and read back as one."""
    spark, path = None, None
    for df in parts:
        spark = spark or df.sparkSession
        path = path or scratch_path(spark, what)
        df.write.mode("append").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application).

    What ``--py-files`` does at submit time, for sessions that were started without it. Also makes the batches
    that go to Python smaller where the session has Spark's default of 64 MB: a task holds each a few times over.
    """
    sc = spark.sparkContext
    if spark.conf.get(ARROW_BATCH, None) in ("67108864b", "67108864", "64m", "64MB"):
        spark.conf.set(ARROW_BATCH, "8m")
    if getattr(sc, "_pistil_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(root):        # already imported from a shipped archive
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("pistil", os.path.relpath(p, root)))
    path = _new_path(spark, "py") + ".zip"            # kept for executors that start later
    write_bytes(path, data.getvalue())
    sc.addPyFile(path)
    sc._pistil_shipped = True


def _trim() -> None:
    """Give memory that Arrow and the C library keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # another C library
        pass


def lean(task: Callable[[Any], Any]) -> Callable[[Any], Any]:
    """A function for ``mapInArrow`` or ``applyInArrow`` (of one argument) whose worker is small again when it ends:
    idle workers stay beside the JVM of their executor."""
    def run(data):
        out = task(data)
        if isinstance(out, Iterator):
            return _then_trim(out)
        _trim()
        return out
    return run


def _then_trim(out: Iterator) -> Iterator:
    try:
        yield from out
    finally:
        _trim()


def free_name(taken, name: str) -> str:
    """``name`` with as many underscores in front as no column of ``taken`` has."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI such as ``file:/x``, ``hdfs://...`` or ``/x``."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(path)


def write_bytes(path: str, data: bytes) -> None:
    """Write one file under a temporary name, then move it into place."""
    fs, p = file_system(path)
    fs.create_dir(posixpath.dirname(p), recursive=True)
    tmp = f"{p}.{os.getpid()}.tmp"
    with fs.open_output_stream(tmp, compression=None) as out:
        out.write(data)
    fs.move(tmp, p)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column as ``large_binary`` (UTF-8 bytes of a string), nulls kept."""
    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_large_binary(col.type):
        if pa.types.is_string(col.type):
            col = col.cast(pa.large_string())
        col = col.cast(pa.large_binary())
    return col


def binary_array(buf, offsets) -> pa.Array:
    """A ``binary`` array over one byte buffer cut at ``offsets`` (n + 1 values)."""
    import numpy as np
    off = np.ascontiguousarray(offsets, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1,
                                 [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(buf))])


__all__ = ["binary_array", "collected", "discard", "file_system", "free_name", "lean", "scratch_path", "shared_dir", "ship_package", "table",
           "text_column", "write_bytes", "written", "written_parts"]
