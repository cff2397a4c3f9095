"""Rejected CSV lines, positions of stored rows, statistics of appended loads."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pistil.operators import profile
from pistil.operators.moments import MomentStore, moments, moments_report
from pistil.operators.positions import file_offsets, pair_by_position, with_stored_position
from pistil.plans import table_steps
from pistil.session import shared_dir, unique_name
from pistil.sources.csv import read_csv_marked
from pistil.sources.tables import load_csv_checked

SCHEMA = "id long, a double, b string"
LINES = ["1,1.5,x", "2,n/a,y", "3,,z", "4,2.5", "5,1,a,b", "", "x,1,b", '6,7,"q,1"', "7,8,"]
BAD = ["2,n/a,y", "4,2.5", "5,1,a,b", "x,1,b"]


def csv(spark, tmp_path, lines, name="in"):
    path = f"{tmp_path}/{name}.csv"
    with open(path, "w") as f:
        f.write("\n".join(["id,a,b", *lines]) + "\n")
    return path


# --- rejected lines ------------------------------------------------------------------------------------------

def test_good_and_rejected_lines_are_all_lines(spark, tmp_path):
    name = unique_name("people")
    load = lambda path, mode: load_csv_checked(spark, path, name, f"{name}_bad", SCHEMA, f"{tmp_path}/{name}", mode=mode)
    got = load(csv(spark, tmp_path, LINES), "overwrite")
    assert (got.rows, got.rejected, got.columns) == (4, 4, 3)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 1.5, "x"), (3, None, "z"), (6, 7.0, "q,1"), (7, 8.0, None)]
    assert sorted(r[0] for r in spark.table(f"{name}_bad").collect()) == sorted(BAD)
    more = load(csv(spark, tmp_path, ["8,1,c", "oops"], "more"), "append")
    assert (more.rows, more.rejected) == (5, 5)
    again = load(csv(spark, tmp_path, ["9,1,c"], "clean"), "overwrite")      # nothing rejected: an empty table
    assert (again.rows, again.rejected) == (1, 0) and spark.table(f"{name}_bad").columns == ["rejected_line"]
    nothing = load(csv(spark, tmp_path, [], "empty"), "overwrite")
    assert (nothing.rows, nothing.rejected) == (0, 0) and spark.table(name).columns == ["id", "a", "b"]
    with pytest.raises(ValueError, match="mode"):
        load(csv(spark, tmp_path, []), "ignore")


def test_file_is_read_once(spark, tmp_path):
    path = csv(spark, tmp_path, LINES)
    marked = read_csv_marked(spark, path, SCHEMA)
    assert marked.columns == ["id", "a", "b", "rejected_line"]
    assert marked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError, match="rejected_line"):
        read_csv_marked(spark, path, "id long, Rejected_Line string")


# --- positions -------------------------------------------------------------------------------------------------

def stored(spark, rows, files, path, mode="overwrite"):
    (rows.repartitionByRange(files, "i").sortWithinPartitions("i").write.mode(mode).parquet(path))
    return spark.read.parquet(path)


def test_positions_of_many_files_and_loads(spark, tmp_path):
    rows = spark.range(1000).withColumnRenamed("id", "i").withColumn("v", F.col("i") * 3)
    path = f"{tmp_path}/many"
    stored(spark, rows.where("i < 600"), 30, path)
    df = stored(spark, rows.where("i >= 600"), 7, path, "append")
    as_plan = file_offsets(df, local_files=0)            # as for very many files
    for got in (with_stored_position(df), with_stored_position(df, offsets=as_plan)):
        assert got.count() == 1000 and got.where("position = i").count() == 1000
    assert sorted(as_plan.collect()) == sorted(file_offsets(df).collect())
    plan = as_plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and plan.count("Join") >= 1
    single = with_stored_position(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), "at")
    assert single.agg(F.max("at"), F.count_distinct("at")).first()[0] == single.count() - 1


def test_keyless_tables_pair_in_stored_order(spark, tmp_path):
    rows = spark.range(500).withColumnRenamed("id", "i").select("i", (F.col("i") * 2).alias("a"), (F.col("i") * 5).alias("b"))
    x = stored(spark, rows, 4, f"{tmp_path}/x").select("i", "a")
    stored(spark, rows, 9, f"{tmp_path}/y")             # other files, the same order
    y = spark.read.schema("b long, i long").parquet(f"{tmp_path}/y")
    got = pair_by_position(spark.read.schema("i long, a long").parquet(f"{tmp_path}/x"), y).collect()
    assert len(got) == 500 and all((r.i, r.a, r.b) == (r.position, 2 * r.position, 5 * r.position) for r in got)
    assert x.count() == 500
    short = stored(spark, rows.limit(3), 1, f"{tmp_path}/short")
    with pytest.raises(ValueError, match="do not pair up"):
        pair_by_position(y, short)
    with pytest.raises(ValueError, match="exists"):
        pair_by_position(y, y.withColumnRenamed("b", "position"))


def test_keyless_xy_tables_reach_the_tuning_step(spark):
    """Features and target written without a key, as the original's steps do, then tuned."""
    uid = unique_name("kl")
    db = f"{uid}_db"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{shared_dir(spark, 'databases', db)}'")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    feats = ["l_quantity", "l_discount"]
    for part, rows in (("train", "l_orderkey % 3 > 0"), ("val", "l_orderkey % 3 = 0")):
        li.where(rows).withColumn("big", (F.col("l_quantity") > 25).cast("string")).write.saveAsTable(f"{db}.{part}")
        table_steps.features_and_target(spark, part, feats, "big", schema=db)
    paired = table_steps.read_xy(spark, "train", None, "big", schema=db)
    assert paired.columns == ["position", *feats, "big"] and paired.where("big <> cast(l_quantity > 25 as string)").count() == 0
    res = table_steps.hp_tune(spark, "train", "val", "logistic_regression", feature_cols=feats, target_col="big", schema=db, max_evals=2)
    assert res.best["val_score"] > 0.8


# --- statistics by load ------------------------------------------------------------------------------------------

def rounded(df):
    return {(r.scope, r["class"], r.column, r.statistic): None if r.value is None else round(r.value, 8) for r in df.collect()}


NUMBERS = [("a", 1.0, 2.0), ("a", 3.0, None), ("b", None, 7.0), (None, 4.0, 1.0), ("a", 1e6, -5.0), ("b", 2.0, 2.0), (None, None, None), ("c", 5.0, 5.0)]
PAIRS = [("x", "y"), ("y", "x")]


def test_merged_moments_equal_the_profile_of_all_rows(spark):
    df = spark.createDataFrame(NUMBERS * 2, "k string, x double, y double")
    want = rounded(profile.profile_report(df, ["x", "y"], "k", PAIRS))
    whole = moments(df, ["x", "y"], "k", PAIRS)
    assert rounded(moments_report(whole)) == want
    parts = None
    for n in range(len(NUMBERS)):
        one = moments(spark.createDataFrame([NUMBERS[n]] * 2, df.schema), ["x", "y"], "k", PAIRS)
        parts = one if parts is None else parts.unionByName(one)
    assert rounded(moments_report(parts)) == want


def test_only_new_loads_are_read(spark, tmp_path):
    df = spark.createDataFrame([(*r, i % 3) for i, r in enumerate(NUMBERS)], "k string, x double, y double, part int")
    path = f"{tmp_path}/t"
    store = MomentStore(spark, f"{tmp_path}/m", ["x", "y"], "k", PAIRS)
    assert store.loads() == []
    for n in range(3):
        df.where(F.col("part") == n).write.mode("append").partitionBy("part").parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
        assert store.add_new(table, "part") == [n] and store.add_new(table, "part") == []
        assert rounded(store.report()) == rounded(profile.profile_report(df.where(F.col("part") <= n), ["x", "y"], "k", PAIRS))
    plan = moments(table.where("part = 2"), ["x"], "k")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    store.add(1, table.where("part = 1"))               # again: counts once
    assert rounded(store.report()) == rounded(profile.profile_report(df, ["x", "y"], "k", PAIRS))
