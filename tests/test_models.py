"""Modelling operators on Spark ML."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pistil.operators.models import (FitContext, assemble, fit, fit_label_indexer,
                                     get_family, lr_reg_param, predict)
from pistil.operators.space import Choice, IntRange, LogUniform, Uniform, trial_frame
from pistil.operators.split import tag_split
from pistil.operators.tune import tune
from pistil.plans.model_flow import ModelFlowConfig, run_model_flow

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@pytest.fixture(scope="module")
def banded(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    band = (F.when(F.col("l_extendedprice") < 35000, "low")
             .when(F.col("l_extendedprice") < 70000, "mid").otherwise("high"))
    return tag_split(li.withColumn("band", band), KEY, (.7, .15, .15), 42)


@pytest.fixture(scope="module")
def prepared(banded):
    idx = fit_label_indexer(banded, "band")
    out = idx.transform(assemble(banded, FEATS)).select(*KEY, "band", "split", "features", "label")
    return {s: out.where(F.col("split") == s).cache() for s in ("train", "val", "test")}, \
        list(idx.labelsArray[0])


def test_label_order_is_sorted(prepared):
    assert prepared[1] == ["high", "low", "mid"]


def test_lr_matches_c_penalty_optimum(spark, banded):
    # C * sum(log loss) + 0.5 * |W|^2 must be stationary at Spark's optimum.
    feats = ["l_quantity", "l_discount", "l_tax"]
    df = fit_label_indexer(banded, "band").transform(assemble(banded, feats))
    n = df.count()
    C = 0.5
    est = get_family("logistic_regression").build(
        {"penalty": "l2", "C": C}, FitContext(n_rows=n, max_iter=2000))
    est.setTol(1e-12)
    m = est.fit(df)
    rows = df.select("features", "label").collect()
    X = np.array([r["features"].toArray() for r in rows])
    y = np.array([int(r["label"]) for r in rows])
    W = m.coefficientMatrix.toArray()
    b = m.interceptVector.toArray()
    z = X @ W.T + b
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    onehot = np.eye(W.shape[0])[y]
    grad = C * (p - onehot).T @ X + W
    assert np.abs(grad).max() < 1e-3 * max(1.0, np.abs(W).max())
    assert lr_reg_param({"penalty": "none", "C": 3.0}, n) == 0.0


def test_rf_params_take_effect(prepared):
    parts, _ = prepared
    ctx = FitContext(n_rows=parts["train"].count())
    p = {"n_estimators": 7, "max_depth": 2, "min_samples_split": 0.01,
         "min_samples_leaf": 0.01, "bootstrap": False}
    m = fit("random_forest", p, parts["train"], ctx)
    assert m.getNumTrees == 7
    assert all(t.depth <= 2 for t in m.trees)
    big = fit("random_forest", {**p, "max_depth": 8, "min_samples_leaf": 0.001}, parts["train"], ctx)
    assert big.totalNumNodes > m.totalNumNodes


def test_probabilities_sum_to_one(prepared):
    parts, _ = prepared
    m = fit("logistic_regression", {"penalty": "l2", "C": 1.0}, parts["train"],
            FitContext(n_rows=parts["train"].count()))
    sums = predict(m, parts["test"]).select(
        F.aggregate("probability", F.lit(0.0), lambda a, x: a + x).alias("s"))
    lo, hi = sums.agg(F.min("s"), F.max("s")).first()
    assert abs(lo - 1) < 1e-9 and abs(hi - 1) < 1e-9


def test_trial_frame_reproducible(spark):
    space = {"a": IntRange(50, 301, 10), "b": Uniform(0.01, 0.3), "c": LogUniform(-4, 4),
             "d": Choice(["x", "y"])}
    a = trial_frame(spark, space, 50, seed=1).collect()
    b = trial_frame(spark, space, 50, seed=1).collect()
    assert a == b
    assert all(50 <= r["a"] <= 300 and r["a"] % 10 == 0 for r in a)
    assert all(0.01 <= r["b"] < 0.3 for r in a)
    assert all(np.exp(-4) <= r["c"] < np.exp(4) for r in a)
    with pytest.raises(ValueError):
        trial_frame(spark, space, 0)


def test_failed_trial_is_a_row(prepared):
    parts, _ = prepared
    # maxDepth 31 is rejected by Spark: that trial fails, the other one scores
    space = {"n_estimators": IntRange(5, 6), "max_depth": Choice([31, 3]),
             "min_samples_split": Uniform(0.01, 0.02), "min_samples_leaf": Uniform(0.01, 0.02),
             "bootstrap": Choice([True])}
    res = tune(parts["train"], parts["val"], "random_forest", space, max_evals=6, seed=5,
               parallelism=2)
    rows = res.trials.collect()
    status = {r["status"] for r in rows}
    assert status == {"ok", "failed"}
    assert all(r["error"] for r in rows if r["status"] == "failed")
    assert res.best["status"] == "ok"


def test_all_failed_raises(prepared):
    parts, _ = prepared
    space = {"n_estimators": IntRange(5, 6), "max_depth": Choice([31]),
             "min_samples_split": Uniform(0.01, 0.02), "min_samples_leaf": Uniform(0.01, 0.02),
             "bootstrap": Choice([True])}
    with pytest.raises(ValueError, match="failed"):
        tune(parts["train"], parts["val"], "random_forest", space, max_evals=2)


def test_pipeline_with_int_labels(spark, banded):
    data = banded.withColumn("band_id", F.when(F.col("band") == "low", 10)
                             .when(F.col("band") == "mid", 20).otherwise(30))
    small_rf = {"n_estimators": IntRange(5, 11, 5), "max_depth": IntRange(3, 5),
                "min_samples_split": Uniform(0.01, 0.05), "min_samples_leaf": Uniform(0.01, 0.05),
                "bootstrap": Choice([True, False])}
    cfg = ModelFlowConfig(key_cols=KEY, feature_cols=FEATS, target_col="band_id",
                              max_evals=2, spaces={"random_forest": small_rf})
    res = run_model_flow(data, cfg)
    preds = {r["predicted"] for r in res.predictions.select("predicted").distinct().collect()}
    assert preds <= {10, 20, 30}
    m = {(r["family"], r["metric"]): r["value"] for r in res.metrics.collect()}
    assert m[("ensemble", "test_accuracy")] > 0.9
    assert res.trials.count() == 4


def test_custom_metric_and_minimize(prepared):
    parts, _ = prepared
    small = {"n_estimators": IntRange(5, 6), "max_depth": IntRange(2, 6),
             "min_samples_split": Uniform(0.01, 0.02), "min_samples_leaf": Uniform(0.01, 0.02),
             "bootstrap": Choice([True])}

    def error_rate(df):  # a distributed metric callable: lower is better
        return df.agg(F.avg((F.col("label") != F.col("prediction")).cast("double"))).first()[0]

    res = tune(parts["train"], parts["val"], "random_forest", small, max_evals=4,
               metric=error_rate, maximize=False, parallelism=2)
    rows = res.trials.collect()
    assert all(r["val_loss"] == r["val_score"] for r in rows)
    assert res.best["val_loss"] == min(r["val_loss"] for r in rows)


def test_unknown_family_and_metric(prepared):
    parts, _ = prepared
    with pytest.raises(ValueError):
        tune(parts["train"], parts["val"], "svm")
    with pytest.raises(ValueError):
        tune(parts["train"], parts["val"], "random_forest", metric="auc")


def test_training_frame_runs_nothing_for_shuffled_input(spark):
    from pistil.operators.models import training_frame
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    agg = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    sc = spark.sparkContext
    sc.setJobGroup("tf_probe", "training_frame sizing")
    try:
        cached = training_frame(agg)
        assert list(sc.statusTracker().getJobIdsForGroup("tf_probe")) == []
        cached.unpersist()
        spread = training_frame(o, min_partitions=4)
        assert spread.rdd.getNumPartitions() == 4
        spread.unpersist()
    finally:
        sc.setJobGroup(None, None)


def test_engine_settings_reach_the_estimator():
    from pistil.operators.models import build_logistic_regression, build_random_forest
    ctx = FitContext(n_rows=100, engine={"random_forest": {"cacheNodeIds": True,
                                                           "maxMemoryInMB": 512},
                                         "logistic_regression": {"aggregationDepth": 3}})
    rf = build_random_forest({"n_estimators": 5, "max_depth": 3, "min_samples_split": 0.1,
                              "min_samples_leaf": 0.1, "bootstrap": True}, ctx)
    assert rf.getCacheNodeIds() and rf.getMaxMemoryInMB() == 512 and rf.getNumTrees() == 5
    lr = build_logistic_regression({"penalty": "l2", "C": 2.0}, ctx)
    assert lr.getAggregationDepth() == 3 and lr.getRegParam() == pytest.approx(1 / 200)


def test_training_frame_checkpoint_cuts_lineage(spark):
    from pistil.operators.models import training_frame
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    agg = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    cut = training_frame(agg, checkpoint=True)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan            # reads the checkpoint files, not the plan
    assert cut.count() == agg.count()
    cut.unpersist()


def test_array_features_and_integer_labels(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    dim = len(emb.first()["embedding"])
    assert assemble(emb, ["embedding"]).first()["features"].size == dim
    tagged = tag_split(emb, "vec_id", (.7, .15, .15), 42)
    small = {"penalty": Choice(["l2"]), "C": Uniform(0.5, 1.0)}
    res = run_model_flow(tagged, ModelFlowConfig(
        key_cols=["vec_id"], feature_cols=["embedding"], target_col="label",
        families=["logistic_regression"], spaces={"logistic_regression": small},
        max_evals=1))
    preds = {r["predicted"] for r in res.predictions.select("predicted").distinct().collect()}
    assert preds <= set(range(10))              # integer labels come back as themselves
    assert dict(res.predictions.dtypes)["predicted"] == "int"


RF_ANY = {"n_estimators": 5, "max_depth": 4, "min_samples_split": 0.02, "min_samples_leaf": 0.005, "bootstrap": True}


def test_forest_estimator_takes_any_number_of_rows(prepared):
    from pistil.operators.models import build_random_forest
    parts, _ = prepared
    est = build_random_forest(RF_ANY, FitContext(n_rows=10 ** 12))
    assert est.getMinWeightFractionPerNode() == 0.005 and est.getMinInstancesPerNode() == 1
    assert est.fit(parts["train"]).getNumTrees == 5


def test_forest_does_not_depend_on_input_partitioning(spark):
    from pistil.operators.models import fit_label_indexer, place_rows
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    idx = fit_label_indexer(li, "l_returnflag")
    out = []
    for n in (3, 11):
        rows = place_rows(li.repartition(n).select("l_orderkey", "l_linenumber", *cols, "l_returnflag"), ["l_orderkey"], 6)
        train = idx.transform(assemble(rows, cols)).select("features", "label")
        model = fit("random_forest", RF_ANY, train, FitContext(n_rows=li.count()))
        p = predict(model, idx.transform(assemble(li.orderBy("l_orderkey", "l_linenumber", *cols), cols)))
        out.append([tuple(r["probability"]) for r in p.select("probability").collect()])
    assert out[0] == out[1]


def test_many_trials_keep_one_model_and_log_each_once(spark, prepared):
    from pistil.session import shared_dir, unique_name
    from pistil.operators.tune import TrialLog
    parts, _ = prepared
    name = unique_name("trials")
    log = TrialLog(spark, name, shared_dir(spark, "tables", name))
    res = tune(parts["train"], parts["val"], "logistic_regression", max_evals=30, parallelism=8, max_iter=3,
               experiment="many", trial_table=log)
    rows = spark.table(name).collect()
    assert sorted(r["trial_id"] for r in rows) == list(range(1, 31))
    # liblinear cannot do without a penalty: such trials are logged as failed
    tried = {r["trial_id"]: json.loads(r["params"]) for r in rows}
    assert all((r["status"] == "failed") == (tried[r["trial_id"]]["penalty"] == "none" and tried[r["trial_id"]]["solver"] == "liblinear") for r in rows)
    rows = [r for r in rows if r["status"] == "ok"]
    assert len(rows) > 20 and all(r["iterations"] <= 3 for r in rows)
    best = min(rows, key=lambda r: (r["val_loss"], r["trial_id"]))
    assert res.best["trial_id"] == best["trial_id"] and res.best_model is not None


def test_no_validation_rows_is_an_error_before_any_fit(prepared):
    parts, _ = prepared
    with pytest.raises(ValueError, match="no validation rows"):
        tune(parts["train"], parts["val"].limit(0), "random_forest")


def test_custom_family_and_metric_in_the_model_flow(spark):
    from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
    from pistil.operators.models import Family
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    fam = Family("bayes", {"smoothing": Uniform(0.1, 2.0)},
                 lambda p, c: NaiveBayes(featuresCol=c.features_col, labelCol=c.label_col, smoothing=p["smoothing"]), NaiveBayesModel)

    def share_right(df):
        return df.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]

    cfg = ModelFlowConfig(key_cols=["l_orderkey", "l_linenumber"], feature_cols=["l_quantity", "l_extendedprice"],
                          target_col="l_returnflag", families=[fam, "logistic_regression"], max_evals=2, metric=share_right)
    res = run_model_flow(tag_split(li, ["l_orderkey"], (.7, .15, .15), 42), cfg)
    assert set(res.models) == {"bayes", "logistic_regression"}
    assert {r["family"] for r in res.metrics.collect()} == {"bayes", "logistic_regression", "ensemble"}
    with pytest.raises(ValueError, match="keep"):
        run_model_flow(li, ModelFlowConfig(key_cols=[], feature_cols=[], target_col="x", handle_invalid="keep"))


def test_fit_inputs_are_read_by_partition(spark):
    from pistil.plans.model_flow import store_by_split
    li = tag_split(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"), ["l_orderkey"], (.7, .15, .15), 42)
    plan = store_by_split(li).where("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_training_partitions_follow_the_rows(spark):
    from pistil.operators.models import train_partitions
    assert train_partitions(spark.range(5_000_000)) == 20     # a range has no stored bytes to speak of
    assert train_partitions(spark.range(1000)) == 16


def _forest_rows(spark, n=6000):
    import numpy as np
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 40, n), rng.normal(size=n).round(2), rng.integers(0, 5, n)], axis=1)
    y = (x[:, 0] > 23).astype(int) + (x[:, 1] > 0.4)
    rows = [(*map(float, r), float(c)) for r, c in zip(x, y)]
    return rows, lambda rows, parts: assemble(spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(parts), ["a", "b", "c"])


def test_a_forest_depends_on_its_rows_alone(spark):
    """Bootstrap draws are those of the counted cells: neither order nor partitions of the rows matter."""
    rows, frame = _forest_rows(spark)
    ctx = FitContext(n_rows=len(rows), seed=7)
    one, other = (fit("random_forest", RF_ANY, frame(r, parts), ctx) for r, parts in ((rows, 3), (rows[::-1], 11)))
    assert one.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:]
    assert one.getNumTrees == 5 and one.numClasses == 3 and one.numFeatures == 3


def test_forest_nodes_hold_the_rows_that_reach_them(spark):
    """Without bootstrap every root holds all rows, and node class counts are those of the rows that the splits send there."""
    from pistil.operators.forests import forest_nodes
    from pistil.operators.models import save_model
    from pistil.session import scratch_path
    rows, frame = _forest_rows(spark)
    model = fit("random_forest", {**RF_ANY, "bootstrap": False, "max_depth": 5}, frame(rows, 4), FitContext(n_rows=len(rows), seed=7))
    nodes = {}
    for r in forest_nodes(save_model(model, scratch_path(spark, "counted"))).select("treeID", "nodeData.*").collect():
        nodes.setdefault(r["treeID"], {})[r["id"]] = r
    for tree in nodes.values():
        held = {0: rows}
        for i in sorted(tree):
            counts = [sum(1 for r in held[i] if r[3] == c) for c in range(3)]
            assert list(tree[i]["impurityStats"]) == counts and tree[i]["rawCount"] == len(held[i])
            assert tree[i]["prediction"] == counts.index(max(counts))
            if tree[i]["leftChild"] >= 0:
                f, (cut,) = tree[i]["split"]["featureIndex"], tree[i]["split"]["leftCategoriesOrThreshold"]
                held[tree[i]["leftChild"]] = [r for r in held[i] if r[f] <= cut]
                held[tree[i]["rightChild"]] = [r for r in held[i] if r[f] > cut]
                assert min(len(held[tree[i][s]]) for s in ("leftChild", "rightChild")) >= 0.005 * len(rows)
        assert len(tree) > 1
    p = [r["probability"] for r in predict(model, frame(rows, 2)).select("probability", "label").collect()]
    assert all(abs(sum(v) - 1) < 1e-9 for v in p)


def test_bootstrap_counts_of_cells_are_those_of_their_rows(spark):
    """A cell of n rows is drawn Poisson(n) times: the roots' row counts spread like sums of single draws."""
    import math
    rows, frame = _forest_rows(spark)
    model = fit("random_forest", {**RF_ANY, "n_estimators": 40, "max_depth": 1}, frame(rows * 5, 4), FitContext(n_rows=len(rows) * 5, seed=7))
    off = [(t._call_java("rootNode").impurityStats().count() - len(rows) * 5) / math.sqrt(len(rows) * 5) for t in model.trees]
    assert max(map(abs, off)) < 5 and 0.5 < sum(v * v for v in off) / len(off) < 2
