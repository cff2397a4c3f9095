"""Hash split on a stream.

``orderBy(rand)`` and ``randomSplit`` both refuse a streaming frame; the hash split
is a stateless projection, so new rows are tagged as they arrive and always land in
the same part as they would in a batch run over the same keys. No state store, no
watermark: each micro-batch is independent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.split import DEFAULT_RATIOS, tag_split
from ..session import shared_dir


def split_stream(stream: DataFrame, key_cols: Sequence[str] | str,
                 ratios: Sequence[float] = DEFAULT_RATIOS, seed: int = 42,
                 col: str = "split") -> DataFrame:
    """Tag each streamed row with its split (same answer as the batch ``tag_split``)."""
    return tag_split(stream, key_cols, ratios, seed, col)


def checkpoint_name(path: str) -> str:
    """A folder name that no other output path shares: its last part and a hash of all of it."""
    whole = path.rstrip("/")
    return f"{whole.rsplit('/', 1)[-1]}_{hashlib.sha256(whole.encode()).hexdigest()[:32]}"


def write_split_stream(stream: DataFrame, key_cols: Sequence[str] | str, path: str,
                       checkpoint: str | None = None,
                       ratios: Sequence[float] = DEFAULT_RATIOS, seed: int = 42,
                       fmt: str = "parquet", available_now: bool = True,
                       processing_time: str | None = None) -> StreamingQuery:
    """Append the tagged stream to files under ``path``, partitioned by split.

    The file sink with a checkpoint in the shared folder is exactly-once: a restarted
    query (or a lost executor) replays only uncommitted micro-batches.
    """
    ckpt = checkpoint or shared_dir(stream.sparkSession, "streams", checkpoint_name(path))
    w = (split_stream(stream, key_cols, ratios, seed).writeStream.format(fmt)
         .option("path", path).option("checkpointLocation", ckpt)
         .partitionBy("split").outputMode("append"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stream_split_counts(stream: DataFrame, key_cols: Sequence[str] | str,
                        by: Sequence[str] = (), ratios: Sequence[float] = DEFAULT_RATIOS,
                        seed: int = 42, checkpoint: str | None = None,
                        table: str | None = None) -> StreamingQuery:
    """Running rows per split (and ``by`` columns) as a stateful streaming aggregate.

    Partial aggregation happens inside each micro-batch; the running totals live in
    the state store, checkpointed in the shared folder, so a restart resumes them. Each
    micro-batch rewrites the table ``table`` with the totals so far (two folders take turns,
    the table points to the last complete one), so the result never passes through the driver.
    """
    from ..operators.split import split_counts
    from ..session import unique_name
    spark = stream.sparkSession
    name = table or unique_name("split_counts")
    base = shared_dir(spark, "streams", name)
    counts = split_counts(split_stream(stream, key_cols, ratios, seed), by=by)

    def publish(batch: DataFrame, epoch: int) -> None:
        where = f"{base}/totals_{epoch % 2}"
        batch.write.mode("overwrite").parquet(where)
        if batch.sparkSession.catalog.tableExists(name):
            batch.sparkSession.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
            batch.sparkSession.catalog.refreshTable(name)
        else:
            batch.sparkSession.catalog.createTable(name, path=where, source="parquet")

    return (counts.writeStream.foreachBatch(publish)
            .option("checkpointLocation", checkpoint or f"{base}/checkpoint").outputMode("complete")
            .trigger(availableNow=True).start())
