"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pistil", driver_memory: str = "16g") -> SparkSession:
    """A local-mode session configured the way the tests and bench expect.

    On a cluster the caller builds the session; nothing here is required by the
    operators themselves.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def current_session() -> SparkSession:
    """The active session, or in a thread that has none the application's."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.conf.get("spark.master", "") or ""
    except Exception:  # pragma: no cover
        master = ""
    return master.startswith("local")


def default_parallelism(spark: SparkSession) -> int:
    """Cores the cluster offers (falls back to the shuffle partition count where the
    SparkContext is not reachable, e.g. over Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can read and write.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the session.
    Only a local session without that setting (tests) gets a fresh folder of its
    own, which is then also registered as the checkpoint directory.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
            base = None
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
        base = tempfile.mkdtemp(prefix="pistil-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    try:  # lineage cuts (e.g. Spark ML checkpoints) go to the same shared folder
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(base)
    except Exception:  # noqa: BLE001
        pass
    return "/".join([base.rstrip("/"), *parts]) if parts else base


DEFAULT_PARTITION_BYTES = 32 << 20    # stored; shuffled rows take several times that
MIN_PARTITION_BYTES = 8 << 20
MAX_PARTITIONS = 50_000


def stored_bytes(df) -> int:
    """Bytes of the stored tables and files that ``df`` reads (0 when unknown).

    The sum over the plan's leaves, not the optimizer's estimate of ``df`` itself: a join's
    estimate is the product of its sides.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        total = 0
        for i in range(leaves.size()):
            raw = leaves.apply(i).stats().sizeInBytes()
            size = raw if isinstance(raw, int) else int(raw.toString())
            if size < (1 << 62):                 # an unknown size is reported as huge
                total += size
        return total
    except Exception:  # noqa: BLE001 - no plan access (e.g. Spark Connect)
        return 0


def partitions_for(df, bytes_per_partition: int = DEFAULT_PARTITION_BYTES,
                   cap: int = MAX_PARTITIONS) -> int:
    """Shuffle partitions for an exchange whose count Spark will not adapt
    (``repartitionById``, explicit bucket counts).

    From the size of the stored input (no job runs): one partition per
    ``bytes_per_partition``, raised to use every core as long as partitions stay above
    8 MB, and at most ``cap`` (beyond that the number of shuffle blocks, mappers x
    reducers, becomes the bottleneck; larger partitions still sort with spill). Small
    inputs get few partitions (and few output files); frames without a size get
    ``spark.sql.shuffle.partitions``.
    """
    size = stored_bytes(df)
    if size <= 0:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_size = -(-size // bytes_per_partition)
    by_cores = min(default_parallelism(df.sparkSession), -(-size // MIN_PARTITION_BYTES))
    return int(max(1, min(cap, max(by_size, by_cores))))


def storage_options(spark: SparkSession, fmt: str) -> dict[str, str]:
    """Writer options of stored tables: Parquet with zstd where the session has Spark's default codec. Rows in hash
    order hold little that snappy finds."""
    codec = spark.conf.get("spark.sql.parquet.compression.codec", "snappy")
    return {"compression": "zstd"} if fmt == "parquet" and codec == "snappy" else {}


_holders: Counter = Counter()
_holders_lock = Lock()
_freed_before: list[str] = []


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` cached until its last holder leaves. Spark keeps one cache entry for all frames of equal plans, so fits that
    run side by side on the same rows share it, and the ``unpersist`` of the first to end would take it from the others:
    each of their later passes would compute it again from all rows."""
    key = df.semanticHash()
    with _holders_lock:
        _holders[key] += 1
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        with _holders_lock:
            _holders[key] -= 1
            if not _holders[key]:
                del _holders[key]
                df.unpersist()


SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted when it ends (Spark 4.1), and not when the driver happens to
    collect its garbage. For steps that store their results: a frame that runs again makes its shuffles again."""
    with _holders_lock:
        _holders[SHUFFLES_FREED] += 1
        if _holders[SHUFFLES_FREED] == 1:
            _freed_before.append(spark.conf.get(SHUFFLES_FREED, "false"))
        spark.conf.set(SHUFFLES_FREED, "true")
    try:
        yield
    finally:
        with _holders_lock:
            _holders[SHUFFLES_FREED] -= 1
            if not _holders[SHUFFLES_FREED]:
                del _holders[SHUFFLES_FREED]
                spark.conf.set(SHUFFLES_FREED, _freed_before.pop())


def unique_name(prefix: str) -> str:
    """A table/folder name that no other call will use."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return shared_dir(spark, "scratch", unique_name(prefix))

