"""Properties of the split, shuffle and position operators."""

import hashlib
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pistil.functions.hashing import hash_hex, keyed_uniform, key_string
from pistil.functions.naming import snake_case
from pistil.operators import prep, split


def py_uniform(key: str, seed: int, salt=None) -> float:
    tag = f"|{salt}|{seed}" if salt else f"|{seed}"
    return int(hashlib.md5((key + tag).encode()).hexdigest()[:8], 16) / 2.0 ** 32


def test_hash_uniform_matches_python(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    got = {r["k"]: r["u"] for r in df.select("k", keyed_uniform("k", 7).alias("u")).collect()}
    assert all(got[k] == py_uniform(str(k), 7) for k in got)


def test_split_disjoint_cover_and_stable(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    a = split.tag_split(o, "o_orderkey").select("o_orderkey", "split")
    b = split.tag_split(o.repartition(7), "o_orderkey").select("o_orderkey", "split")
    assert a.count() == o.count() == a.select("o_orderkey").distinct().count()
    assert sorted(a.collect()) == sorted(b.collect())
    parts = split.hash_split(o, "o_orderkey")
    assert sum(p.count() for p in parts) == o.count()


def test_split_shares_within_three_se(spark):
    n = 20000
    df = spark.range(n).withColumnRenamed("id", "k")
    counts = {r["split"]: r["rows"] for r in
              split.split_counts(split.tag_split(df, "k", (.7, .15, .15), 42)).collect()}
    for name, p in zip(split.SPLIT_NAMES, (.7, .15, .15)):
        se = math.sqrt(p * (1 - p) / n)
        assert abs(counts[name] / n - p) < 3 * se


def test_position_equals_row_number(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    got = prep.with_hash_position(o.repartition(5), ["o_orderkey"], seed=3, buckets=7)
    ref = o.select("o_orderkey", F.row_number().over(
        Window.orderBy(hash_hex(key_string("o_orderkey"), 3), "o_orderkey")).alias("position"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_hash_shuffle_independent_of_partitioning(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    a = [r[0] for r in prep.shuffle_rows(o, ["o_orderkey"], 42).collect()]
    b = [r[0] for r in prep.shuffle_rows(o.repartition(9), ["o_orderkey"], 42).collect()]
    assert a == b and sorted(a) != a


def test_union_keeps_rows(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    tr, va, te = split.hash_split(o, "o_orderkey")
    assert tr.unionByName(va).count() == o.count() - te.count()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x24F), max_size=20))
def test_snake_case_has_no_ascii_capitals(name):
    out = snake_case(name)
    assert not any("A" <= c <= "Z" for c in out)
    assert out.replace("_", "") == name.lower().replace("_", "") or len(out) >= len(name)


def test_hash_order_equals_global_sort(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    fast = [r[0] for r in prep.hash_ordered(o.repartition(3), ["o_orderkey"], 11, 5).collect()]
    slow = [r[0] for r in o.orderBy(hash_hex(key_string("o_orderkey"), 11), "o_orderkey").collect()]
    assert fast == slow


def test_skew_safe_order_with_hot_key(spark):
    # a third of the rows share one key: the skew-safe path spreads them and keeps order
    base = spark.range(3000).withColumnRenamed("id", "k")
    hot = base.withColumn("k", F.when(F.col("k") % 3 == 0, F.lit(-1)).otherwise(F.col("k")))
    out = prep.shuffle_rows(hot, ["k"], 5, skew_safe=True, partitions=6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 1000
    keys = [r["k"] for r in out.collect()]
    ref = [r["k"] for r in hot.orderBy(hash_hex(key_string("k"), 5), "k").collect()]
    assert keys == ref


def test_partitions_for_scales_with_size(spark):
    from pistil.session import partitions_for
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert partitions_for(o) == 1                         # ~40 KB: one partition
    assert partitions_for(o, bytes_per_partition=1024) > 8   # ~KBs per partition
    assert partitions_for(o, bytes_per_partition=1, cap=77) == 77


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "k int")
    pos = prep.with_hash_position(df, ["k"], seed=1, buckets=3)
    assert sorted(r["position"] for r in pos.collect()) == [1, 2, 3, 4]
    tagged = split.tag_split(df, "k")
    assert tagged.where(F.col("split").isNull()).count() == 0


@settings(max_examples=6, deadline=None)
@given(seed=st.integers(0, 10_000), parts=st.integers(1, 9), buckets=st.integers(1, 13),
       in_parts=st.integers(1, 5))
def test_hash_order_and_positions_any_layout(spark, seed, parts, buckets, in_parts):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    o = o.repartition(in_parts)
    ref = o.orderBy(hash_hex(key_string("o_orderkey"), seed), "o_orderkey")
    want = [r[0] for r in ref.collect()]
    assert [r[0] for r in prep.hash_ordered(o, ["o_orderkey"], seed, parts).collect()] == want
    pos = prep.with_hash_position(o, ["o_orderkey"], seed=seed, buckets=buckets)
    got = [k for k, _ in sorted((r["o_orderkey"], r["position"]) for r in pos.collect())]
    by_pos = {r["position"]: r["o_orderkey"] for r in pos.collect()}
    assert [by_pos[i + 1] for i in range(len(want))] == want and len(got) == len(want)


@settings(max_examples=6, deadline=None)
@given(a=st.integers(0, 10), b=st.integers(0, 10), c=st.integers(0, 10),
       seed=st.integers(0, 1000))
def test_split_parts_cover_for_any_ratios(spark, a, b, c, seed):
    total = a + b + c
    if total == 0:
        return
    ratios = (a / total, b / total, c / total)
    if abs(sum(ratios) - 1) >= 1e-6:
        return
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    counts = {r["split"]: r["rows"] for r in
              split.split_counts(split.tag_split(o, "o_orderkey", ratios, seed)).collect()}
    assert sum(counts.values()) == 1500
    for name, r in zip(split.SPLIT_NAMES, ratios):
        if r == 0:
            assert name not in counts


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(1_577_836_800, 1_893_456_000), min_size=20, max_size=60))
def test_zone_stamp_matches_zoneinfo(spark, seconds):
    import datetime as dt
    from pistil.functions.stamps import now_stamp, zone_stamp
    # DST boundaries in Europe/Rome (2025-03-30 01:00 UTC, 2025-10-26 01:00 UTC) +/- 1 s
    seconds = seconds + [1743296399, 1743296400, 1761440399, 1761440400]
    utc = [dt.datetime.fromtimestamp(x, dt.timezone.utc) for x in seconds]
    df = spark.createDataFrame([(u.replace(tzinfo=None),) for u in utc], "ts timestamp_ntz")
    got = [r["s"] for r in df.select(zone_stamp("ts").alias("s")).collect()]
    assert got == [now_stamp(now=u) for u in utc]


def test_exchange_partitions_grow_with_the_stored_bytes(spark, monkeypatch):
    from pistil import session
    monkeypatch.setattr(session, "stored_bytes", lambda df: 6 << 30)
    assert session.partitions_for(spark.range(1)) >= 192      # 32 MB stored, a few hundred MB shuffled


def test_shuffle_files_go_with_the_query_while_asked_for(spark):
    from pistil.session import SHUFFLES_FREED, shuffles_freed
    before = spark.conf.get(SHUFFLES_FREED)
    with shuffles_freed(spark):
        with shuffles_freed(spark):
            assert spark.conf.get(SHUFFLES_FREED) == "true"
        assert spark.conf.get(SHUFFLES_FREED) == "true"
        once = spark.range(100).repartition(4, "id").groupBy((F.col("id") % 10).alias("k")).count()
        assert once.collect() and sorted(once.collect()) == [(k, 10) for k in range(10)]    # and a frame can run again
    assert spark.conf.get(SHUFFLES_FREED) == before


def test_hash_order_in_parts_is_the_whole_order(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    placed = lambda df: [(r[0], r[1]) for r in df.select("o_orderkey", F.spark_partition_id()).collect()]
    whole = placed(prep.hash_ordered(o, ["o_orderkey"], 11, 7))
    parts = [placed(prep.hash_ordered(o, ["o_orderkey"], 11, 7, part=(k, 3))) for k in range(3)]
    assert all(parts) and sum(parts, []) == whole
    plan = prep.hash_ordered(o, ["o_orderkey"], 11, 7)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "_ord_h" not in plan.split("Exchange")[1]    # the hash is not sent
