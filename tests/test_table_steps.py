"""Table-to-table steps and stored layouts."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pistil.operators import prep
from pistil.operators.space import Choice, IntRange, Uniform
from pistil.plans import table_steps as S
from pistil.session import scratch_path, shared_dir, unique_name
from pistil.sources.csv import write_csv
from pistil.sources.tables import ensure_schema

FEATS = ["sepal_length_cm", "sepal_width_cm", "petal_length_cm", "petal_width_cm"]


@pytest.fixture(scope="module")
def iris_like_csv(spark):
    """An iris-shaped CSV derived from lineitem: Id, four CamelCase features, Species."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = li.select(
        F.monotonically_increasing_id().cast("int").alias("Id"),
        F.col("l_quantity").alias("SepalLengthCm"),
        (F.col("l_extendedprice") / 1000).alias("SepalWidthCm"),
        F.col("l_discount").alias("PetalLengthCm"),
        F.col("l_tax").alias("PetalWidthCm"),
        F.when(F.col("l_extendedprice") < 35000, "setosa")
         .when(F.col("l_extendedprice") < 70000, "versicolor").otherwise("virginica")
         .alias("Species"))
    return write_csv(df.coalesce(1), scratch_path(spark, "iris_like"))


def test_step_by_step_flow(spark, iris_like_csv):
    db = unique_name("steps")
    ensure_schema(spark, None, db, location=shared_dir(spark, "databases", db))
    kw = dict(schema=db)
    res = S.load_data(spark, iris_like_csv, "raw", add_key="row_key", **kw)
    assert res.columns == 7
    rows, cols = S.process_data(spark, "raw", "processed", key_cols=["row_key"], **kw)
    assert (rows, cols) == (res.rows, 6)
    assert spark.table(f"{db}.processed").columns == [*FEATS, "species", "row_key"]
    parts = S.train_val_test_split(spark, "processed", "train", "val", "test",
                                   key_cols=["row_key"], **kw)
    assert sum(r for r, _ in parts.values()) == res.rows
    for t in ("train", "val", "test"):
        S.features_and_target(spark, t, FEATS, "species", key_cols=["row_key"], **kw)
    small = {"n_estimators": IntRange(5, 11, 5), "max_depth": IntRange(3, 5),
             "min_samples_split": Uniform(0.01, 0.05), "min_samples_leaf": Uniform(0.01, 0.05),
             "bootstrap": Choice([True])}
    r = S.hp_tune(spark, "train", "val", "random_forest", feature_cols=FEATS,
                  target_col="species", key_cols=["row_key"], space=small, max_evals=2, **kw)
    assert r.best["val_score"] > 0.9


def test_random_split_without_key(spark):
    db = unique_name("steps_r")
    ensure_schema(spark, None, db, location=shared_dir(spark, "databases", db))
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.saveAsTable(f"{db}.o")
    parts = S.train_val_test_split(spark, "o", "a", "b", "c", schema=db)
    assert sum(r for r, _ in parts.values()) == 1500
    with pytest.raises(ValueError):
        S.train_val_test_split(spark, "o", "a", "b", "c", ratios=(.7, .2, .2), schema=db)


def test_bucketed_xy_join_has_no_exchange(spark):
    li = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    x, y = prep.features_and_target(li, ["o_totalprice"], "o_orderpriority", ["o_orderkey"])
    xn, yn = unique_name("bx"), unique_name("by")
    prep.write_features_target(x, y, xn, yn, ["o_orderkey"], buckets=4,
                               x_path=shared_dir(spark, "tables", xn),
                               y_path=shared_dir(spark, "tables", yn))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = prep.join_features_target(spark.table(xn), spark.table(yn), ["o_orderkey"])
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 1500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_process_without_key_uses_seeded_rand(spark):
    db = unique_name("steps_p")
    ensure_schema(spark, None, db, location=shared_dir(spark, "databases", db))
    src = spark.read.parquet(f"{SF_SMALL}/customer.parquet").toDF(
        "Id", "CName", "CNationkey", "CAcctbal", "CMktsegment")
    src.write.saveAsTable(f"{db}.raw")
    rows, cols = S.process_data(spark, "raw", "proc", schema=db)
    assert (rows, cols) == (150, 4)
    assert spark.table(f"{db}.proc").columns == ["c_name", "c_nationkey", "c_acctbal",
                                                  "c_mktsegment"]
