"""Registered queries for the modelling operators and the two pipelines.

Every query fits on the whole ``lineitem`` train part (hash split), never a sample. The
target is a label Spark derives from the table (a price band), because the return flag
is not learnable from these features. What a fit gives cannot be written in SQL number by
number; the queries return what SQL can state about the whole output: which rows it has,
that probabilities add up, that the label is the most likely class, that the optimum is
reached, which parameters were tried.

The tagged table is stored once, partitioned by split; each part is read by partition.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions.hashing import sql_key
from ..operators.ensemble import ensemble_accuracy, soft_vote, union_train_val
from ..operators.models import (FitContext, assemble, fit, fit_label_indexer, load_model, lr_reg_param,
                                place_rows, predict, save_model, training_frame)
from ..operators.space import LR_SPACE, RF_SPACE, sql_sample_space
from ..operators.split import tag_split
from ..operators.tune import tune
from ..session import scratch_path, shared_dir, unique_name
from . import table_steps
from .data_flow import ROW_KEY, DataFlowConfig, run_data_flow
from .model_flow import ModelFlowConfig, run_model_flow, store_by_split
from .registry import LINE_FEATURES, LINE_KEY, LINE_TARGET, RATIOS, SEED, read, sql_split

BAND = "price_band"
# Fixed parameter sets for the single-fit checks, taken from inside the search spaces.
RF_PARAMS = {"n_estimators": 50, "max_depth": 5, "min_samples_split": 0.01,
             "min_samples_leaf": 0.01, "bootstrap": True}
LR_PARAMS = {"penalty": "l2", "C": 1.0, "solver": "lbfgs", "l1_ratio": 0.0}


def _banded(spark, d) -> DataFrame:
    li = read(spark, d, "lineitem")
    band = (F.when(F.col("l_extendedprice") < 35000, "low")
             .when(F.col("l_extendedprice") < 70000, "mid").otherwise("high"))
    return tag_split(li.withColumn(BAND, band), LINE_KEY, RATIOS, SEED)


def _prepared(spark, d):
    df = store_by_split(_banded(spark, d).select(*LINE_KEY, *LINE_FEATURES, BAND, "split"))
    indexer = fit_label_indexer(df.where(F.col("split") != "test"), BAND)

    def prep(name):
        rows = df.where(F.col("split") == name).drop("split")
        if name != "test":                   # fits need rows in a fixed layout, predictions do not
            rows = place_rows(rows, LINE_KEY)
        return indexer.transform(assemble(rows, LINE_FEATURES)).select(*LINE_KEY, BAND, "features", "label")
    return {s: prep(s) for s in ("train", "val", "test")}, list(indexer.labelsArray[0])


def _checked(df: DataFrame, labels, prob="probability", index="prediction", label=None, more=()) -> DataFrame:
    """Of every prediction: whether its probabilities are one distribution and its class is the
    first most likely one."""
    p = F.col(prob)
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    first = F.array_position(p, F.array_max(p)).cast("int") - 1
    named = F.element_at(F.array(*[F.lit(v) for v in labels]), F.col(index).cast("int") + 1)
    return df.select(*LINE_KEY, BAND,
                     (F.size(p) == len(labels)).alias("complete"),
                     (F.round(total, 9) == 1.0).alias("sums_to_one"),
                     (F.col(index).cast("int") == first).alias("most_likely"),
                     ((named if label is None else F.col(label)).isin(*labels)).alias("known_label"), *more)


def q_assemble_features(spark, d):
    """Feature columns as one vector (summed back for the check)."""
    a = assemble(read(spark, d, "lineitem"), LINE_FEATURES)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda acc, x: acc + x)
    return a.select(*LINE_KEY, F.round(total, 2).alias("value"))


def q_label_index(spark, d):
    """Sorted-label class index and rows per label."""
    li = read(spark, d, "lineitem")
    idx = fit_label_indexer(li, LINE_TARGET).transform(li)
    return idx.groupBy(LINE_TARGET, F.col("label").cast("bigint").alias("label_index")).agg(
        F.count(F.lit(1)).alias("count"))


def _single(spark, d, family, params, refit=False, check=None):
    """The checked test predictions of one fit; ``check`` looks at the model and its (cached) training rows."""
    parts, labels = _prepared(spark, d)
    train = training_frame(
        (union_train_val(parts["train"], parts["val"]) if refit else parts["train"])
        .select("features", "label"))
    ctx = FitContext(n_rows=train.count(), seed=SEED)
    model = fit(family, params, train, ctx)
    found = check(model, train, ctx) if check else None
    train.unpersist()
    return _checked(predict(model, parts["test"]), labels), found


def q_rf_predict(spark, d):
    """Forest fitted on train, labels and probabilities on test."""
    return _single(spark, d, "random_forest", RF_PARAMS)[0]


def gradient_norm(model, train: DataFrame, reg: float) -> float:
    """Largest entry of the gradient of the penalised mean log-loss at the fitted coefficients, in
    units of each feature's size: one distributed aggregate per (class, feature)."""
    w, k = model.coefficientMatrix.toArray(), model.numClasses
    scored = predict(model, train).withColumn("x", vector_to_array("features"))
    miss = [F.col("probability")[c] - (F.col("label") == c).cast("double") for c in range(k)]
    sums = [F.avg(miss[c] * F.col("x")[j]).alias(f"g{c}_{j}") for c in range(k) for j in range(w.shape[1])]
    size = [F.max(F.abs(F.col("x")[j])).alias(f"s{j}") for j in range(w.shape[1])]
    row = scored.agg(*sums, *size).first()
    return max(abs(row[f"g{c}_{j}"] + reg * w[c, j]) / max(row[f"s{j}"], 1e-12)
               for c in range(k) for j in range(w.shape[1]))


def q_lr_predict(spark, d):
    """Logistic regression fitted on train, predictions on test, and whether the
    gradient of what the fit minimises vanishes on the training rows."""
    out, flat = _single(spark, d, "logistic_regression", LR_PARAMS,
                        check=lambda model, train, ctx: gradient_norm(model, train, lr_reg_param(LR_PARAMS, ctx.n_rows)) < 1e-3)
    return out.withColumn("gradient_vanishes", F.lit(flat))


def q_refit_predict(spark, d):
    """I8: forest refitted on train + validation, predictions on test."""
    return _single(spark, d, "random_forest", RF_PARAMS, refit=True)[0]


def _params(space) -> list:
    """The tried parameters as columns, read from the logged JSON."""
    kinds = {"n_estimators": "int", "max_depth": "int", "bootstrap": "boolean", "penalty": "string", "solver": "string"}
    return [(F.round(F.get_json_object("params", f"$.{k}").cast("double"), 9) if k not in kinds
             else F.get_json_object("params", f"$.{k}").cast(kinds[k])).alias(k) for k in space]


def _tune(spark, d, family, space, **kw):
    parts, _ = _prepared(spark, d)
    train = training_frame(parts["train"].select("features", "label"))
    val = training_frame(parts["val"].select("features", "label"))
    res = tune(train, val, family, space, max_evals=3, seed=SEED, parallelism=3,
               experiment=f"check_{family}", **kw)
    train.unpersist()
    val.unpersist()
    return res.trials.select("family", "trial_id", *_params(space), "status",
                             F.col("val_score").between(0.0, 1.0).alias("scored"),
                             (F.col("val_loss") == -F.col("val_score")).alias("loss_is_minus_score"))


def q_tune_rf(spark, d):
    """Three seeded forest trials, each scored on validation."""
    return _tune(spark, d, "random_forest", RF_SPACE)


def q_tune_lr(spark, d):
    """Three seeded logistic-regression trials, each scored on validation."""
    return _tune(spark, d, "logistic_regression", LR_SPACE)


def q_trial_log(spark, d):
    """Both families tuned at the same time by the model flow, logging to one trial table
    that does not exist yet."""
    name = unique_name("trials")
    cfg = ModelFlowConfig(key_cols=LINE_KEY, feature_cols=LINE_FEATURES, target_col=BAND, max_evals=2,
                          seed=SEED, parallelism=2, family_parallelism=2, trial_table=name,
                          trial_path=shared_dir(spark, "tables", name))
    run_model_flow(_banded(spark, d), cfg)
    t = spark.table(name)
    return t.select("family", "trial_id", *_params(RF_SPACE), *_params(LR_SPACE), "status",
                    F.regexp_extract("experiment", r"(random_forest|logistic_regression)", 1).alias("experiment_family"))


def _ensemble(spark, d):
    parts, labels = _prepared(spark, d)
    tv = training_frame(union_train_val(parts["train"], parts["val"]).select("features", "label"))
    ctx = FitContext(n_rows=tv.count(), seed=SEED)
    with ThreadPoolExecutor(max_workers=2) as pool:       # independent fits on the same cached rows
        fitted = list(pool.map(lambda f: fit(f[0], f[1], tv, ctx), [("random_forest", RF_PARAMS), ("logistic_regression", LR_PARAMS)]))
    models = dict(zip(("rf", "lr"), fitted))
    tv.unpersist()
    return soft_vote(parts["test"], models, labels, keep=[*LINE_KEY, BAND]), labels


def q_ensemble_predict(spark, d):
    """Soft vote of a forest and a logistic regression on test: the vote is their mean."""
    out, labels = _ensemble(spark, d)
    mean = F.zip_with("rf_probability", "lr_probability", lambda a, b: (a + b) / 2.0)
    near = F.forall(F.zip_with(mean, "probability", lambda a, b: F.abs(a - b) <= 1e-12), lambda x: x)
    return _checked(out, labels, index="prediction_index", label="predicted", more=[near.alias("mean_of_models")])


def q_ensemble_accuracy(spark, d):
    """Test accuracy of the soft-vote ensemble: its rows, and a bound that a vote learned from
    a price's own band must pass."""
    out, _ = _ensemble(spark, d)
    return ensemble_accuracy(out, BAND).select("rows", (F.col("accuracy") > 0.9).alias("accurate"))


def q_model_save_load(spark, d):
    """A fitted forest saved, loaded and compared prediction by prediction."""
    parts, _ = _prepared(spark, d)
    train = training_frame(parts["train"].select("features", "label"))
    model = fit("random_forest", RF_PARAMS, train, FitContext(n_rows=train.count(), seed=SEED))
    train.unpersist()
    path = save_model(model, scratch_path(spark, "rf_model"))
    again = load_model("random_forest", path)
    a = predict(model, parts["test"], prefix="a_")
    b = predict(again, a, prefix="b_")
    same = (F.col("a_prediction") == F.col("b_prediction")) & (F.col("a_probability") == F.col("b_probability"))
    return b.select(*LINE_KEY, same.alias("same"))


def q_model_flow(spark, d):
    """Tune both families, refit, vote, score: the metrics frame, with scores held against
    bounds."""
    cfg = ModelFlowConfig(key_cols=LINE_KEY, feature_cols=LINE_FEATURES, target_col=BAND,
                          max_evals=3, seed=SEED, parallelism=3)
    m = run_model_flow(_banded(spark, d), cfg).metrics
    exact = F.when(F.col("metric") == "test_rows", F.col("value"))
    ok = (F.when(F.col("metric") == "best_trial_id", F.col("value").isin(1.0, 2.0, 3.0))
           .when(F.col("metric") == "best_val_score", F.col("value").between(0.3, 1.0))
           .when(F.col("metric") == "test_accuracy", F.col("value").between(0.5, 1.0))
           .otherwise(F.col("value") >= 0))
    return m.select("family", "metric", exact.alias("rows"), ok.alias("in_bounds"))


def q_append_pairing(spark, d):
    """A0/G1: the same load twice with append, the data flow on it, and features re-paired with
    targets by the persisted row key: every row twice."""
    uid = unique_name("ap")
    where = shared_dir(spark, "tables", uid)
    cfg = DataFlowConfig(
        source=f"{d.rstrip('/')}/lineitem.parquet", source_format="parquet", raw_table=f"{uid}_raw",
        processed_table=f"{uid}_processed", train_table=f"{uid}_train", val_table=f"{uid}_val",
        test_table=f"{uid}_test", id_column=None, key_cols=LINE_KEY, feature_cols=LINE_FEATURES,
        target_col=LINE_TARGET, ratios=RATIOS, seed=SEED, table_root=where)
    for mode in ("overwrite", "append"):
        cfg.load_mode, cfg.write_xy = mode, mode == "append"
        run_data_flow(spark, cfg)
    data = table_steps.frame_from_xy(spark, {s: f"{uid}_{s}" for s in ("train", "val", "test")}, [ROW_KEY], LINE_TARGET)
    return data.select(*LINE_KEY, *LINE_FEATURES, LINE_TARGET, "split")


def q_split_step(spark, d):
    """The split step from table to tables, and the ratios it refuses."""
    uid = unique_name("sp")
    where = shared_dir(spark, "databases", uid)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {uid} LOCATION '{where}'")
    read(spark, d, "orders").write.saveAsTable(f"{uid}.orders")
    parts = ("train", "val", "test")
    try:
        table_steps.train_val_test_split(spark, "orders", *parts, ratios=(0.7, 0.2, 0.2), key_cols=["o_orderkey"], schema=uid)
        refused = False
    except ValueError:
        refused = True
    table_steps.train_val_test_split(spark, "orders", *parts, ratios=RATIOS, seed=SEED, key_cols=["o_orderkey"], schema=uid)
    out = None
    for p in parts:
        t = spark.table(f"{uid}.{p}").select("o_orderkey", F.lit(p).alias("split"), F.lit(refused).alias("bad_ratios_refused"))
        out = t if out is None else out.unionByName(t)
    return out


def q_data_flow(spark, d):
    """Load, process + split, x/y tables keyed by the data's own keys: rows and columns per
    written table."""
    uid = unique_name("dp")
    cfg = DataFlowConfig(
        source=f"{d.rstrip('/')}/lineitem.parquet", source_format="parquet",
        raw_table=f"{uid}_raw", processed_table=f"{uid}_processed",
        train_table=f"{uid}_train", val_table=f"{uid}_val", test_table=f"{uid}_test",
        id_column=None, key_cols=LINE_KEY, feature_cols=LINE_FEATURES, target_col=LINE_TARGET,
        ratios=RATIOS, seed=SEED, shuffle="hash", table_root=shared_dir(spark, "tables", uid),
        row_key=None)
    return run_data_flow(spark, cfg)


MODEL_QUERIES = {
    "assemble_features": q_assemble_features,
    "label_index": q_label_index,
    "rf_predict": q_rf_predict,
    "lr_predict": q_lr_predict,
    "refit_predict": q_refit_predict,
    "tune_rf": q_tune_rf,
    "tune_lr": q_tune_lr,
    "trial_log": q_trial_log,
    "ensemble_predict": q_ensemble_predict,
    "ensemble_accuracy": q_ensemble_accuracy,
    "model_save_load": q_model_save_load,
    "model_flow": q_model_flow,
    "data_flow": q_data_flow,
    "append_pairing": q_append_pairing,
    "split_step": q_split_step,
}


_SPLIT = f"(SELECT {sql_split(H.sql_key(*LINE_KEY))} AS split FROM lineitem)"

MODEL_ORACLES = {
    "assemble_features": (
        f"SELECT {', '.join(LINE_KEY)}, round(((l_quantity + l_extendedprice) + l_discount)"
        " + l_tax, 2) AS value FROM lineitem"),
    "label_index": (
        f"SELECT {LINE_TARGET}, CAST(dense_rank() OVER (ORDER BY {LINE_TARGET}) - 1 AS BIGINT)"
        f" AS label_index, count FROM (SELECT {LINE_TARGET}, count(*) AS count FROM lineitem "
        f"GROUP BY 1)"),
    "data_flow": (
        "SELECT 'raw' AS \"table\", CAST(NULL AS VARCHAR) AS split, count(*) AS rows, "
        "11 AS columns FROM lineitem "
        f"UNION ALL SELECT 'processed', split, count(*), 12 FROM {_SPLIT} GROUP BY split "
        f"UNION ALL SELECT split || '_x', split, count(*), 8 FROM {_SPLIT} GROUP BY split "
        f"UNION ALL SELECT split || '_y', split, count(*), 5 FROM {_SPLIT} GROUP BY split"),
}


_KEYS = ", ".join(LINE_KEY)
_BAND_SQL = ("CASE WHEN l_extendedprice < 35000 THEN 'low' WHEN l_extendedprice < 70000 THEN 'mid' ELSE 'high' END")
_PART = sql_split(sql_key(*LINE_KEY))
_TEST = f"(SELECT *, {_BAND_SQL} AS {BAND} FROM lineitem WHERE {_PART} = 'test')"
_PREDICTED = (f"SELECT {_KEYS}, {BAND}, true AS complete, true AS sums_to_one, true AS most_likely, "
              f"true AS known_label")


def _sql_params(space, null: bool = False) -> str:
    cols = []
    for s in sql_sample_space("trial_id", space, SEED):
        value, name = s.rsplit(" AS ", 1)
        exact = name in ("n_estimators", "max_depth", "bootstrap", "penalty", "solver")
        cols.append(f"{'CASE WHEN false THEN ' if null else ''}{value if exact else f'round({value}, 9)'}"
                    f"{' END' if null else ''} AS {name}")
    return ", ".join(cols)


def _sql_trials(family: str, space, n: int) -> str:
    return (f"SELECT '{family}' AS family, trial_id, {_sql_params(space)}, 'ok' AS status, true AS scored, "
            f"true AS loss_is_minus_score FROM (SELECT unnest(range(1, {n + 1})) AS trial_id)")


def _sql_log(family: str, n: int) -> str:
    rf = family == "random_forest"
    return (f"SELECT '{family}' AS family, trial_id, {_sql_params(RF_SPACE, not rf)}, {_sql_params(LR_SPACE, rf)}, "
            f"'ok' AS status, '{family}' AS experiment_family FROM (SELECT unnest(range(1, {n + 1})) AS trial_id)")


_ROWS = f"(SELECT count(*) FROM {_TEST})"

MODEL_ORACLES |= {
    "rf_predict": f"{_PREDICTED} FROM {_TEST}",
    "lr_predict": f"{_PREDICTED}, true AS gradient_vanishes FROM {_TEST}",
    "refit_predict": f"{_PREDICTED} FROM {_TEST}",
    "ensemble_predict": f"{_PREDICTED}, true AS mean_of_models FROM {_TEST}",
    "ensemble_accuracy": f"SELECT count(*) AS rows, true AS accurate FROM {_TEST}",
    "model_save_load": f"SELECT {_KEYS}, true AS same FROM {_TEST}",
    "tune_rf": _sql_trials("random_forest", RF_SPACE, 3),
    "tune_lr": _sql_trials("logistic_regression", LR_SPACE, 3),
    "trial_log": f"{_sql_log('random_forest', 2)} UNION ALL {_sql_log('logistic_regression', 2)}",
    "model_flow": (
        "SELECT family, metric, CAST(NULL AS DOUBLE) AS rows, true AS in_bounds FROM "
        "(VALUES ('random_forest'), ('logistic_regression')) f(family), (VALUES ('best_trial_id'), ('best_val_score')) m(metric) "
        "UNION ALL SELECT 'ensemble', 'test_accuracy', NULL, true "
        f"UNION ALL SELECT 'ensemble', 'test_rows', CAST({_ROWS} AS DOUBLE), true"),
    "append_pairing": (
        f"SELECT {_KEYS}, {', '.join(LINE_FEATURES)}, {LINE_TARGET}, {_PART} AS split FROM lineitem "
        f"UNION ALL SELECT {_KEYS}, {', '.join(LINE_FEATURES)}, {LINE_TARGET}, {_PART} AS split FROM lineitem"),
    "split_step": (f"SELECT o_orderkey, {sql_split(sql_key('o_orderkey'))} AS split, true AS bad_ratios_refused FROM orders"),
}
