"""The hash split on a stream gives the batch answer."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pistil.operators.split import tag_split
from pistil.session import scratch_path
from pistil.streaming.split_stream import split_stream, write_split_stream


def test_stream_split_matches_batch(spark):
    src = f"{SF_SMALL}/orders.parquet"
    schema = spark.read.parquet(src).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .option("maxFilesPerTrigger", 1).parquet(SF_SMALL))
    assert stream.isStreaming
    out = scratch_path(spark, "stream_split")
    q = write_split_stream(stream.select("o_orderkey", "o_totalprice"), "o_orderkey", out)
    q.awaitTermination()
    got = spark.read.parquet(out).select("o_orderkey", "split")
    want = tag_split(spark.read.parquet(src), "o_orderkey").select("o_orderkey", "split")
    assert sorted(got.collect()) == sorted(want.collect())


def test_stream_memory_sink(spark):
    src = f"{SF_SMALL}/orders.parquet"
    schema = spark.read.parquet(src).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .parquet(SF_SMALL))
    tagged = split_stream(stream, "o_orderkey").groupBy("split").count()
    q = (tagged.writeStream.format("memory").queryName("split_counts_mem")
         .outputMode("complete").start())
    q.processAllAvailable()
    q.stop()
    total = spark.sql("SELECT sum(`count`) AS n FROM split_counts_mem").first()["n"]
    assert total == 1500


def test_stream_restart_is_exactly_once(spark):
    src = f"{SF_SMALL}/orders.parquet"
    schema = spark.read.parquet(src).schema

    def stream():
        return (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
                .parquet(SF_SMALL).select("o_orderkey"))
    out = scratch_path(spark, "stream_once")
    ckpt = out + "_ckpt"
    write_split_stream(stream(), "o_orderkey", out, checkpoint=ckpt).awaitTermination()
    first = spark.read.parquet(out).count()
    write_split_stream(stream(), "o_orderkey", out, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == first == 1500
