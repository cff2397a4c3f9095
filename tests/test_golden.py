"""Golden micro-tables for edge behaviour (FIXTURES.md part 2)."""


import pytest
from pyspark.sql import functions as F

from pistil.functions.naming import snake_case, snake_case_all
from pistil.functions.vectors import argmax, index_to_label, mean_arrays
from pistil.functions.stamps import now_stamp, zone_stamp
from pistil.operators import prep, profile, split
from pistil.operators.trials import best_trial
from pistil.session import scratch_path
from pistil.sources.csv import read_csv


def test_rename_rule():
    names = ["SepalLengthCm", "Species", "HTTPServer", "Already_Snake", "X1Y2", "l_orderkey", "A"]
    assert [snake_case(n) for n in names] == [
        "sepal_length_cm", "species", "h_t_t_p_server", "already__snake", "x1_y2",
        "l_orderkey", "a"]


def test_rename_non_ascii_and_spaces():
    assert snake_case("ÄrgerÖl") == "ärgeröl"
    assert snake_case("Petal Width") == "petal _width"


def test_rename_clash(spark):
    with pytest.raises(ValueError, match="a_b"):
        snake_case_all(["aB", "a_b"])
    df = spark.createDataFrame([(1, 2)], "aB int, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        prep.rename_snake_case(df)


def test_missing_id(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert prep.drop_column(df, "id").columns == ["a", "b"]
    with pytest.raises(ValueError):
        prep.drop_column(df, "id", missing="error")


def test_id_case(spark):
    df = spark.createDataFrame([(1, 2.0)], "Id int, b double")
    assert prep.drop_column(df, "id").columns == ["b"]


@pytest.mark.parametrize("ratios", [(.7, .15, .15), (.5, .5, 0)])
def test_ratios_ok(ratios):
    split.check_ratios(*ratios)


@pytest.mark.parametrize("ratios", [(.7, .2, .2), (1.5, -.25, -.25), (float("nan"), .5, .5)])
def test_ratios_bad(ratios):
    with pytest.raises(ValueError):
        split.check_ratios(*ratios)


def test_zero_ratio_gives_empty_part(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    _, _, test = split.hash_split(df, "k", (.5, .5, 0), 42)
    assert test.count() == 0


def test_corr_const(spark):
    df = spark.createDataFrame([(1.0, float(y)) for y in range(5)], "x double, y double")
    assert df.agg(profile.safe_corr("x", "y").alias("c")).first()["c"] is None


def test_corr_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 7.0), (4.0, 1.0)],
                               "x double, y double")
    c = df.agg(profile.safe_corr("x", "y").alias("c")).first()["c"]
    assert c == pytest.approx(0.0339422, abs=1e-7)


def test_csv_ragged(spark):
    path = scratch_path(spark, "ragged") + ".csv"
    lines = ["Id,A,B", "1,1.5,x", "2,NA,", '3,,"q,1"', "4,2.5", "5,1,a,b"]
    spark.createDataFrame([(l,) for l in lines], "v string").coalesce(1).write.text(path)
    df = read_csv(spark, path, header=True, infer_schema=True)
    assert dict(df.dtypes)["A"] == "string"
    rows = {r["Id"]: r for r in df.collect()}
    assert rows[4]["B"] is None
    assert rows[5]["B"] == "a"
    assert rows[3]["B"] == "q,1"


def test_trials_tie(spark):
    t = spark.createDataFrame([("e", 2, -0.9, "ok"), ("e", 1, -0.9, "ok")],
                              "experiment string, trial_id int, val_loss double, status string")
    assert best_trial(t).first()["trial_id"] == 1


def test_trials_nan(spark):
    t = spark.createDataFrame(
        [("e", 1, float("nan"), "ok"), ("e", 2, -0.5, "ok"), ("e", 3, None, "failed")],
        "experiment string, trial_id int, val_loss double, status string")
    assert best_trial(t).first()["trial_id"] == 2


def test_vote(spark):
    df = spark.createDataFrame([([0.2, 0.8], [0.6, 0.4])], "a array<double>, b array<double>")
    r = df.select(mean_arrays("a", "b").alias("p")).select("p", argmax("p").alias("i")).first()
    assert r["p"] == pytest.approx([0.4, 0.6])
    assert r["i"] == 1


def test_vote_three_models(spark):
    df = spark.createDataFrame([([0.3, 0.7], [0.6, 0.4], [0.0, 1.0])],
                               "a array<double>, b array<double>, c array<double>")
    p = df.select(mean_arrays("a", "b", "c").alias("p")).first()["p"]
    assert p == pytest.approx([0.3, 0.7])


def test_argmax_tie(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],)], "p array<double>")
    assert df.select(argmax("p").alias("i")).first()["i"] == 0


def test_int_labels(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "i int")
    out = [r["l"] for r in df.select(
        index_to_label("i", ["10", "20", "30"]).cast("int").alias("l")).orderBy("l").collect()]
    assert out == [10, 20, 30]


def test_zone_stamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-08-12 19:50:00' AS ts")
    assert df.select(zone_stamp("ts").alias("s")).first()["s"] == "20250812_215000"
    import datetime as dt
    from zoneinfo import ZoneInfo
    now = dt.datetime(2025, 8, 12, 19, 50, tzinfo=ZoneInfo("UTC"))
    assert now_stamp(now=now) == "20250812_215000"


def _ragged(spark):
    path = scratch_path(spark, "ragged_modes") + ".csv"
    lines = ["Id,A,B", "1,1.5,x", "2,2.5", "3,3.5,z,extra"]
    spark.createDataFrame([(l,) for l in lines], "v string").coalesce(1).write.text(path)
    return path


def test_csv_parse_modes(spark):
    path = _ragged(spark)
    schema = "Id int, A double, B string"
    assert read_csv(spark, path, schema=schema).count() == 3               # permissive
    kept = read_csv(spark, path, schema=schema, parse_mode="DROPMALFORMED").collect()
    assert [r["Id"] for r in kept] == [1]      # rows are parsed only when materialised
    with pytest.raises(Exception):
        read_csv(spark, path, schema=schema, parse_mode="FAILFAST").collect()
    with pytest.raises(ValueError):
        read_csv(spark, path, parse_mode="LENIENT")


def test_write_modes_and_names(spark):
    from pistil.sources.tables import table_name, write_table
    assert table_name("spark_catalog", "db", "t") == "`spark_catalog`.`db`.`t`"
    assert table_name(None, "db", "we`ird") == "`db`.`we``ird`"
    df = spark.range(3)
    with pytest.raises(ValueError):
        write_table(df, "never_written", mode="upsert")
