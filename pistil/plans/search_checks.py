"""Registered queries for the search itself: Parzen proposals, scoring of many trials at once, resuming, and
the two limits of the original's models that Spark ML lacks.

Histories and predictions are derived from whole given tables, so their work grows with them.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..operators.forests import NODE, forest_nodes
from ..operators.metrics import confusion_counts, confusion_metrics
from ..operators.models import FitContext, fit, predict, save_model, training_frame
from ..operators.space import LR_SPACE, RF_SPACE, sample_space, sql_sample_space
from ..operators.tpe import propose, sql_propose
from ..operators.tune import TrialLog, tune
from ..session import scratch_path, shared_dir, unique_name
from .model_checks import _PREDICTED, _TEST, _checked, _params, _prepared, _sql_params
from .registry import CLASS_LABELS, LINE_KEY, LINE_TARGET, SEED, read

BOTH = {**RF_SPACE, **LR_SPACE}
CONTINUOUS = ["min_samples_split", "min_samples_leaf", "C", "l1_ratio"]
LEAST_SHARE = 0.2


def _history(spark, d) -> DataFrame:
    """Every event as a finished trial of its type's experiment, with parameters drawn by its id."""
    e = read(spark, d, "events").where("value is not null")
    trials = e.select(F.col("event_type").alias("experiment"), F.col("event_id").alias("trial_id"), (-F.col("value")).alias("val_loss"))
    return sample_space(trials, BOTH, SEED)


def q_tpe_proposals(spark, d):
    """The next two trials of every event type's experiment by the Parzen search over all events, and of one
    experiment that has no trials yet (random)."""
    history = _history(spark, d)
    last = read(spark, d, "events").groupBy(F.col("event_type").alias("experiment")).agg(F.max("event_id").alias("last"))
    asked = (last.unionByName(spark.createDataFrame([("new", 0)], "experiment string, last long"))
                 .select("experiment", F.explode(F.array(F.col("last") + 1, F.col("last") + 2)).alias("trial_id")))
    out = propose(history, asked, BOTH, SEED, status_col=None)
    return out.select(*[F.round(c, 6).alias(c) if c in CONTINUOUS else c for c in out.columns])


def _three_models(spark, d) -> DataFrame:
    """The return flag of every line with three pretend predictions of it, right for a half, two thirds, three quarters
    of the lines by a hash of the key and else the first class, the line status or missing."""
    key = H.key_string(*LINE_KEY)
    u = lambda n: H.hash_uniform(key, SEED, salt=f"m{n}")
    other = {1: F.lit(CLASS_LABELS[0]), 2: F.col("l_linestatus"), 3: F.lit(None).cast("string")}
    share = {1: 0.5, 2: 2 / 3, 3: 0.75}
    return read(spark, d, "lineitem").select(
        F.col(LINE_TARGET).alias("label"), *[F.when(u(n) < share[n], F.col(LINE_TARGET)).otherwise(other[n]).alias(f"p{n}") for n in (1, 2, 3)])


def q_trial_metrics(spark, d):
    """Accuracy, precision, recall, F1 and kappa of three models from one pass over the lines."""
    counts = confusion_counts(_three_models(spark, d), "label", {n: f"p{n}" for n in (1, 2, 3)})
    out = confusion_metrics(counts)
    return out.select("trial", "rows", *[F.round(c, 10).alias(c) for c in out.columns if c not in ("trial", "rows")])


def q_liblinear_predict(spark, d):
    """The liblinear optimum fitted on train, predictions on test, and whether each class's gradient (its
    penalised intercept included) vanishes on the training rows."""
    params = {"penalty": "l2", "C": 0.5, "solver": "liblinear", "l1_ratio": 0.0}
    parts, labels = _prepared(spark, d)
    train = training_frame(parts["train"].select("features", "label"))
    n = train.count()
    model = fit("logistic_regression", params, train, FitContext(n_rows=n, seed=SEED))
    flat = one_vs_rest_gradient(model, train, 1 / (0.5 * n)) < 1e-6
    train.unpersist()
    return _checked(predict(model, parts["test"]), labels).withColumn("gradient_vanishes", F.lit(flat))


def one_vs_rest_gradient(model, train: DataFrame, reg: float) -> float:
    """Largest entry of the gradient of the penalised mean log-loss over all classes' fits, in units of each feature's
    size: one distributed aggregate."""
    x = F.col("x")
    rows = train.select(F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"), "label")
    w = model.coefficients
    miss = []
    for c, wc in zip(range(len(w)) if len(w) > 1 else [1], w):
        margin = F.lit(0.0)
        for j, v in enumerate(wc):
            margin = margin + F.lit(float(v)) * x[j]
        miss.append(F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - (F.col("label") == c).cast("double"))
    dims = range(w.shape[1])
    got = rows.agg(*[F.avg(m * x[j]).alias(f"g{c}_{j}") for c, m in enumerate(miss) for j in dims],
                   *[F.max(F.abs(x[j])).alias(f"s{j}") for j in dims]).first()
    return max(abs(got[f"g{c}_{j}"] + reg * w[c, j]) / max(got[f"s{j}"], 1e-12) for c in range(len(w)) for j in dims)


def q_forest_split_limit(spark, d):
    """A forest with ``min_samples_split`` well above twice ``min_samples_leaf``: rows of its nodes, read from the
    stored model; splits of nodes below the limit (none), nodes that are no split's child (the roots), and whether
    any split is of a node under twice the limit, so that the limit itself is what stops the others."""
    parts, _ = _prepared(spark, d)
    train = training_frame(parts["train"].select("features", "label"))
    n = train.count()
    params = {"n_estimators": 20, "max_depth": 8, "min_samples_split": LEAST_SHARE, "min_samples_leaf": 0.01, "bootstrap": True}
    path = save_model(fit("random_forest", params, train, FitContext(n_rows=n, seed=SEED)), scratch_path(spark, "limited"))
    train.unpersist()
    nodes = forest_nodes(path).select("treeID", f"{NODE}.*")
    child = nodes.where("leftChild >= 0").select("treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"), F.lit(1).alias("child"))
    least = F.ceil(F.lit(LEAST_SHARE) * F.lit(n))
    split = F.col("leftChild") >= 0
    return (nodes.join(child, ["treeID", "id"], "left").groupBy().agg(
        F.count_distinct("treeID").alias("trees"), F.count_if(split & (F.col("rawCount") < least)).alias("small_splits"),
        F.count_if(F.col("child").isNull()).alias("roots"), (F.count_if(split & (F.col("rawCount") < 2 * least)) > 0).alias("limit_binds"),
        (F.count("*") == F.count_distinct("treeID", "id")).alias("numbered_once")))


def q_tune_resume(spark, d):
    """A search of four trials of which two are stored by another run, then resumed: every trial
    once, the stored ones as they were stored, and the best of the whole search."""
    parts, _ = _prepared(spark, d)
    train = training_frame(parts["train"].select("features", "label"))
    val = training_frame(parts["val"].select("features", "label"))
    name = unique_name("resumed")
    where = shared_dir(spark, "tables", name)
    run = dict(family="logistic_regression", seed=SEED, parallelism=2, max_iter=20, experiment="resumed")
    first = tune(train, val, max_evals=2, trial_table=TrialLog(spark, name, where), **run)
    stored = {r["trial_id"]: r["run_id"] for r in first.trials.collect()}
    res = tune(train, val, max_evals=4, trial_table=TrialLog(spark, name, where), resume=True, **run)
    train.unpersist()
    val.unpersist()
    rows = TrialLog(spark, name, where).read()
    kept = F.create_map(*[F.lit(x) for k, v in stored.items() for x in (k, v)])
    best = rows.agg(F.min_by("trial_id", F.struct("val_loss", "trial_id")).alias("t")).first()["t"]
    return rows.select("trial_id", *_params(LR_SPACE), "status", (F.col("run_id") == F.try_element_at(kept, F.col("trial_id"))).alias("as_stored"),
                       F.lit(res.best["trial_id"] == best and res.best_model is not None).alias("best_of_all"))


SEARCH_QUERIES = {
    "tpe_proposals": q_tpe_proposals,
    "trial_metrics": q_trial_metrics,
    "liblinear_predict": q_liblinear_predict,
    "forest_split_limit": q_forest_split_limit,
    "tune_resume": q_tune_resume,
}


def _sql_history() -> str:
    draws = ", ".join(sql_sample_space("event_id", BOTH, SEED))
    return f"(SELECT event_type AS experiment, event_id AS trial_id, -value AS val_loss, {draws} FROM events WHERE value IS NOT NULL)"


def _sql_proposals() -> str:
    asked = ("(SELECT experiment, unnest([last_ + 1, last_ + 2]) AS trial_id FROM (SELECT event_type AS experiment, max(event_id) AS last_ "
             "FROM events GROUP BY 1 UNION ALL SELECT 'new', 0))")
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in CONTINUOUS)
    return f"SELECT * REPLACE ({rounded}) FROM ({sql_propose(_sql_history(), asked, BOTH, SEED)})"


def _sql_metrics() -> str:
    key = H.sql_key(*LINE_KEY)
    u = lambda n: H.sql_hash_uniform(key, SEED, salt=f"m{n}")
    other = {1: f"'{CLASS_LABELS[0]}'", 2: "l_linestatus", 3: "NULL"}
    share = {1: 0.5, 2: 2 / 3, 3: 0.75}
    each = " UNION ALL ".join(f"SELECT {n} AS trial, {LINE_TARGET} AS a, CASE WHEN {u(n)} < {share[n]!r}::DOUBLE THEN {LINE_TARGET} ELSE {other[n]} END AS b "
                              "FROM lineitem" for n in (1, 2, 3))
    return f"""
WITH r AS ({each}),
c AS (SELECT DISTINCT trial, a AS class FROM r UNION SELECT DISTINCT trial, b FROM r),
p AS (SELECT c.trial, c.class, count(*) FILTER (WHERE a IS NOT DISTINCT FROM class)::DOUBLE AS la,
             count(*) FILTER (WHERE b IS NOT DISTINCT FROM class)::DOUBLE AS pr,
             count(*) FILTER (WHERE a IS NOT DISTINCT FROM class AND b IS NOT DISTINCT FROM class)::DOUBLE AS hit
      FROM c JOIN r USING (trial) GROUP BY 1, 2),
m AS (SELECT trial, CAST(sum(la) AS BIGINT) AS rows, sum(hit) / sum(la) AS accuracy, avg(CASE WHEN pr > 0 THEN hit / pr ELSE 0 END) AS precision_macro,
             avg(CASE WHEN la > 0 THEN hit / la ELSE 0 END) AS recall_macro, avg(CASE WHEN la + pr > 0 THEN 2 * hit / (la + pr) ELSE 0 END) AS f1_macro,
             sum(CASE WHEN la + pr > 0 THEN la * 2 * hit / (la + pr) ELSE 0 END) / sum(la) AS f1_weighted,
             sum(la * pr) / sum(la) / sum(la) AS chance FROM p GROUP BY 1)
SELECT trial, rows, round(accuracy, 10) AS accuracy, round(precision_macro, 10) AS precision_macro, round(recall_macro, 10) AS recall_macro,
       round(f1_macro, 10) AS f1_macro, round(f1_weighted, 10) AS f1_weighted, round((accuracy - chance) / (1 - chance), 10) AS kappa FROM m
"""


SEARCH_ORACLES = {
    "tpe_proposals": _sql_proposals(),
    "trial_metrics": _sql_metrics(),
    "liblinear_predict": f"{_PREDICTED}, true AS gradient_vanishes FROM {_TEST}",
    "forest_split_limit": "SELECT 20::BIGINT AS trees, 0::BIGINT AS small_splits, 20::BIGINT AS roots, true AS limit_binds, true AS numbered_once",
    "tune_resume": (f"SELECT trial_id, {_sql_params(LR_SPACE)}, 'ok' AS status, CASE WHEN trial_id <= 2 THEN true END AS as_stored, "
                    "true AS best_of_all FROM (SELECT unnest(range(1, 5)) AS trial_id)"),
}
