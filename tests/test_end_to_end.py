"""The original flow end to end: iris-shaped CSV with an Id column -> data pipeline
-> model pipeline, with the default names and settings."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pistil.operators.space import Choice, IntRange, Uniform
from pistil.plans.data_flow import DataFlowConfig, run_data_flow
from pistil.plans.model_flow import ModelFlowConfig, run_model_flow
from pistil.session import scratch_path, shared_dir, unique_name
from pistil.sources.csv import write_csv


@pytest.fixture(scope="module")
def iris_csv(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = li.select(
        (F.monotonically_increasing_id() + 1).cast("int").alias("Id"),
        F.col("l_quantity").alias("SepalLengthCm"),
        (F.col("l_extendedprice") / 1000).alias("SepalWidthCm"),
        F.col("l_discount").alias("PetalLengthCm"),
        F.col("l_tax").alias("PetalWidthCm"),
        F.when(F.col("l_extendedprice") < 35000, "Iris-setosa")
         .when(F.col("l_extendedprice") < 70000, "Iris-versicolor")
         .otherwise("Iris-virginica").alias("Species"))
    return write_csv(df.coalesce(1), scratch_path(spark, "iris_csv"))


def test_flow(spark, iris_csv):
    uid = unique_name("flow")
    cfg = DataFlowConfig(
        source=iris_csv, raw_table=f"{uid}_raw", processed_table=f"{uid}_processed",
        train_table=f"{uid}_train", val_table=f"{uid}_val", test_table=f"{uid}_test",
        table_root=shared_dir(spark, "tables", uid))
    report = {(r["table"], r["split"]): r for r in run_data_flow(spark, cfg).collect()}
    n = report[("raw", None)]["rows"]
    assert n == 6000 and report[("raw", None)]["columns"] == 7      # + row_key
    assert sum(report[("processed", s)]["rows"] for s in ("train", "val", "test")) == n
    assert report[("processed", "train")]["columns"] == 7            # - Id + split
    for s in ("train", "val", "test"):
        assert report[(f"{s}_x", s)]["rows"] == report[("processed", s)]["rows"]
        assert report[(f"{s}_x", s)]["columns"] == 5 and report[(f"{s}_y", s)]["columns"] == 2

    processed = spark.table(f"{uid}_processed")
    assert "id" not in processed.columns and "species" in processed.columns
    small = {"n_estimators": IntRange(5, 11, 5), "max_depth": IntRange(3, 6),
             "min_samples_split": Uniform(0.01, 0.05), "min_samples_leaf": Uniform(0.01, 0.05),
             "bootstrap": Choice([True, False])}
    mcfg = ModelFlowConfig(key_cols=["row_key"], feature_cols=list(cfg.feature_cols),
                               target_col="species", spaces={"random_forest": small},
                               trial_table=None)
    res = run_model_flow(processed, mcfg)
    m = {(r["family"], r["metric"]): r["value"] for r in res.metrics.collect()}
    assert m[("ensemble", "test_accuracy")] > 0.9
    assert m[("ensemble", "test_rows")] == report[("processed", "test")]["rows"]
    assert res.labels == ["Iris-setosa", "Iris-versicolor", "Iris-virginica"]
    p = res.predictions.select(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
                               .alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(p[0] - 1) < 1e-9 and abs(p[1] - 1) < 1e-9


def test_zone_stamp_independent_of_session_zone(spark):
    import __spark_entry__ as E
    from conftest import SF_CHECK
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        a = sorted(E.queries()["zone_stamp"](spark, SF_CHECK).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    b = sorted(E.queries()["zone_stamp"](spark, SF_CHECK).collect())
    assert a == b


def test_model_flow_from_xy_tables(spark, iris_csv):
    from pistil.plans.table_steps import frame_from_xy
    uid = unique_name("flowxy")
    cfg = DataFlowConfig(
        source=iris_csv, raw_table=f"{uid}_raw", processed_table=f"{uid}_processed",
        train_table=f"{uid}_train", val_table=f"{uid}_val", test_table=f"{uid}_test",
        shuffle=None, xy_buckets=4, table_root=shared_dir(spark, "tables", uid))
    run_data_flow(spark, cfg).collect()
    data = frame_from_xy(spark, {"train": f"{uid}_train", "val": f"{uid}_val",
                                 "test": f"{uid}_test"}, ["row_key"], "species")
    assert data.count() == 6000
    small = {"penalty": Choice(["l2"]), "C": Uniform(0.5, 2.0)}
    mcfg = ModelFlowConfig(key_cols=["row_key"], feature_cols=list(cfg.feature_cols),
                           target_col="species", families=["logistic_regression"],
                           spaces={"logistic_regression": small}, max_evals=2)
    m = {(r["family"], r["metric"]): r["value"] for r in run_model_flow(data, mcfg).metrics.collect()}
    assert m[("ensemble", "test_accuracy")] > 0.9


def test_explore_frames(spark, iris_csv):
    from pistil.plans.explore import explore
    from pistil.sources.csv import read_csv
    df = read_csv(spark, iris_csv)
    out = explore(df, ["SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm"],
                  "Species", "PetalLengthCm", ("SepalLengthCm", "SepalWidthCm"), ["Id"])
    assert [r["Id"] for r in out["head"].collect()] == [1, 2, 3, 4, 5]
    assert [r["summary"] for r in out["describe"].collect()] == ["count", "mean", "stddev", "min", "max"]
    assert sum(r["count"] for r in out["class_counts"].collect()) == 6000
    assert out["class_means"].columns == ["Species", "avg(PetalLengthCm)"]
    assert out["corr"].count() == 1


def test_data_flow_table_source_random_shuffle_zero_ratio(spark):
    uid = unique_name("flowt")
    src = f"{uid}_src"
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.option(
        "path", shared_dir(spark, "tables", src)).saveAsTable(src)
    cfg = DataFlowConfig(
        source=src, source_format="table", raw_table=f"{uid}_raw",
        processed_table=f"{uid}_processed", train_table=f"{uid}_train",
        val_table=f"{uid}_val", test_table=f"{uid}_test", id_column="o_custkey",
        key_cols=["o_orderkey"], feature_cols=["o_totalprice"],
        target_col="o_orderpriority", ratios=(0.5, 0.5, 0.0), shuffle="random",
        table_root=shared_dir(spark, "tables", uid))
    rep = {(r["table"], r["split"]): r["rows"] for r in run_data_flow(spark, cfg).collect()}
    assert rep[("raw", None)] == 1500
    assert rep[("processed", "train")] + rep[("processed", "val")] == 1500
    assert ("processed", "test") not in rep and rep[("test_x", "test")] == 0
    assert "o_custkey" not in spark.table(f"{uid}_processed").columns


def test_cli_runs_both_flows(spark, iris_csv):
    from pistil.plans.cli import main
    from pistil.sources.tables import ensure_schema
    db = unique_name("cli")
    ensure_schema(spark, None, db, location=shared_dir(spark, "databases", db))
    rep = main(["data", "--source", iris_csv, "--schema", db, "--train_ratio", "0.5",
                "--val_ratio", "0.25", "--test_ratio", "0.25"], spark)
    rows = {(r["table"], r["split"]): r["rows"] for r in rep.collect()}
    assert rows[("raw", None)] == 6000
    met = main(["model", "--schema", db, "--max_evals", "2"], spark)
    m = {(r["family"], r["metric"]): r["value"] for r in met.collect()}
    assert m[("ensemble", "test_accuracy")] > 0.9


def test_id_column_cannot_be_the_key(spark):
    cfg = DataFlowConfig(source="unused", id_column="Id", key_cols=["id"])
    with pytest.raises(ValueError, match="also a key"):
        run_data_flow(spark, cfg)


def test_model_flow_with_checkpointed_inputs(spark, iris_csv):
    from pistil.sources.csv import read_csv
    from pistil.operators.split import tag_split
    df = tag_split(read_csv(spark, iris_csv), "Id")
    cfg = ModelFlowConfig(key_cols=["Id"], feature_cols=["SepalLengthCm", "SepalWidthCm",
                                                         "PetalLengthCm", "PetalWidthCm"],
                          target_col="Species", families=["logistic_regression"],
                          spaces={"logistic_regression": {"penalty": Choice(["l2"]),
                                                          "C": Uniform(0.5, 2.0)}},
                          max_evals=1, checkpoint_inputs=True)
    m = {(r["family"], r["metric"]): r["value"] for r in run_model_flow(df, cfg).metrics.collect()}
    assert m[("ensemble", "test_accuracy")] > 0.9


def test_refit_max_iter_reaches_the_refit(spark, iris_csv):
    from pistil.sources.csv import read_csv
    from pistil.operators.split import tag_split
    df = tag_split(read_csv(spark, iris_csv), "Id")
    cfg = ModelFlowConfig(key_cols=["Id"], feature_cols=["SepalLengthCm", "PetalWidthCm"],
                          target_col="Species", families=["logistic_regression"],
                          spaces={"logistic_regression": {"penalty": Choice(["l2"]),
                                                          "C": Uniform(0.5, 2.0)}},
                          max_evals=1, max_iter=5, refit_max_iter=1000)
    res = run_model_flow(df, cfg)
    assert res.models["logistic_regression"].getMaxIter() == 1000


def test_appended_loads_pair_row_by_row(spark):
    from pistil.plans.table_steps import frame_from_xy
    uid = unique_name("app")
    cfg = DataFlowConfig(
        source=f"{SF_SMALL}/region.parquet", source_format="parquet", raw_table=f"{uid}_raw", processed_table=f"{uid}_processed",
        train_table=f"{uid}_train", val_table=f"{uid}_val", test_table=f"{uid}_test", id_column=None, feature_cols=["r_regionkey"],
        target_col="r_name", table_root=shared_dir(spark, "tables", uid))
    for mode in ("overwrite", "append", "append"):
        cfg.load_mode = mode
        run_data_flow(spark, cfg)
    raw = spark.table(f"{uid}_raw")
    assert raw.count() == raw.select("row_key").distinct().count() == 15
    data = frame_from_xy(spark, {s: f"{uid}_{s}" for s in ("train", "val", "test")}, ["row_key"], "r_name")
    assert data.count() == 15
    views = [spark.table(f"{uid}_{s}") for s in ("train", "val", "test")]
    assert sum(v.count() for v in views) == 15 and all("split" not in v.columns for v in views)


def test_processed_table_written_in_parts_is_whole_and_in_order(spark, monkeypatch):
    from pistil.functions.hashing import hash_hex, key_string
    from pistil.plans import data_flow
    monkeypatch.setattr(data_flow, "default_parallelism", lambda s: 1)
    monkeypatch.setattr(data_flow, "XY_BUCKET_BYTES", 4096)
    uid, calls = unique_name("parts"), []
    place = data_flow.split_and_order
    monkeypatch.setattr(data_flow, "split_and_order", lambda *a: calls.append(a[-1]) or place(*a))
    cfg = DataFlowConfig(
        source=f"{SF_SMALL}/orders.parquet", source_format="parquet", raw_table=f"{uid}_raw", processed_table=f"{uid}_processed",
        train_table=f"{uid}_train", val_table=f"{uid}_val", test_table=f"{uid}_test", id_column=None, key_cols=["o_orderkey"],
        target_col="o_orderstatus", feature_cols=["o_totalprice"], partitions=4, table_root=shared_dir(spark, "tables", uid))
    run_data_flow(spark, cfg)
    assert calls == [(0, 2), (1, 2)]
    done = spark.table(f"{uid}_processed")
    assert sorted(done.drop("split").collect()) == sorted(spark.table(f"{uid}_raw").collect())
    # buckets by the stored size of each part, not one for a table of any size
    buckets = {s: int(next(r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {uid}_{s}_x").collect() if r["col_name"] == "Num Buckets")) for s in ("train", "val")}
    assert buckets["train"] > buckets["val"] > 1
    # the files of a split follow each other by name in hash order
    h = hash_hex(key_string("o_orderkey"), cfg.seed)
    files = done.where("split = 'train'").groupBy(F.substring_index(F.input_file_name(), "/", -1).alias("f")).agg(F.min(h).alias("a"), F.max(h).alias("b")).orderBy("f").collect()
    assert len(files) == 3 and all(x["b"] < y["a"] for x, y in zip(files, files[1:])) and all(".zstd." in x["f"] for x in files)


def test_hot_key_is_spread_by_the_skew_safe_shuffle(spark):
    uid = unique_name("hot")
    hot = spark.range(9000).select((F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))).alias("k"),
                                   F.col("id").cast("double").alias("f"), F.lit("a").alias("t"))
    src = scratch_path(spark, "hot")
    hot.write.parquet(src)
    cfg = DataFlowConfig(
        source=src, source_format="parquet", raw_table=f"{uid}_raw", processed_table=f"{uid}_processed", train_table=f"{uid}_train",
        val_table=f"{uid}_val", test_table=f"{uid}_test", id_column=None, key_cols=["k"], feature_cols=["f"], target_col="t",
        partitions=8, skew_safe=True, write_xy=False, table_root=shared_dir(spark, "tables", uid))
    run_data_flow(spark, cfg)
    sizes = [r["n"] for r in spark.table(f"{uid}_processed").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 2 * 9000 / 8


def test_repeated_and_null_keys_are_reported(spark):
    from pistil.operators.prep import join_features_target, key_faults
    x = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 3.0), (4, 4.0)], "k int, f double")
    y = spark.createDataFrame([(1, "a"), (4, "b")], "k int, t string")
    assert {(r["k"], r["rows"]) for r in key_faults(x, "k").collect()} == {(1, 2), (None, 1)}
    with pytest.raises(ValueError, match="repeated or NULL"):
        join_features_target(x, y, "k", check_counts=True)


def test_partition_count_of_a_join_follows_the_stored_bytes(spark):
    from pistil.session import partitions_for, stored_bytes
    o, li = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("orders", "lineitem"))
    both = li.join(o, li.l_orderkey == o.o_orderkey)
    assert 10e6 < stored_bytes(both) < 20e6 and partitions_for(both) <= 8


def test_stream_checkpoints_do_not_collide():
    from pistil.streaming.split_stream import checkpoint_name
    assert checkpoint_name("/s/a_b/c") != checkpoint_name("/s/a/b_c")
