"""Model pipeline: tune each family -> refit on train + val -> soft vote -> test accuracy.

Input is one keyed frame (or table) with a ``split`` column, e.g. the ``processed``
table of the data pipeline, or the ``_x``/``_y`` tables re-paired on the key.
The columns in use are stored once, partitioned by split, so each part is read by
partition (``store_input=False`` where the input already is such a table). Train and
validation are placed by key, assembled once and cached (memory, spilling to disk); a
lost executor only recomputes its cached blocks from the stored table. Predictions
stay a distributed frame; only the label list and small trial records reach the
driver.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stamps import experiment_name, now_stamp
from ..operators.ensemble import ensemble_accuracy, refit, soft_vote, union_train_val
from ..operators.metrics import Metric
from ..operators.models import (Family, FitContext, assemble, fit_iterations, fit_label_indexer,
                                free_name, get_family, place_rows, training_frame)
from ..operators.space import Distribution
from ..operators.split import select_splits
from ..operators.tpe import TpeSettings
from ..operators.tune import TrialLog, TuneResult, tune
from ..session import scratch_path
from . import defaults


log = logging.getLogger("pistil.model_flow")


@dataclass
class ModelFlowConfig:
    key_cols: Sequence[str]
    feature_cols: Sequence[str]
    target_col: str
    split_col: str = "split"
    families: Sequence[str | Family] = ("random_forest", "logistic_regression")
    spaces: dict[str, dict[str, Distribution]] = field(default_factory=dict)
    max_evals: int = 3
    metric: str | Metric = "accuracy"
    maximize: bool = True
    seed: int = 42
    parallelism: int = 3              # trials of one family at a time
    family_parallelism: int = 2       # families tuned (and refitted) at a time
    max_iter: int = 100
    refit_max_iter: int = defaults.REFIT_MAX_ITER
    standardize: bool = False
    experiment_base: str = "experiments"
    model_dir: str | None = None
    trial_table: str | None = None
    trial_path: str | None = None     # folder of a trial table that is created
    handle_invalid: str = "error"
    engine: dict[str, dict[str, Any]] = field(default_factory=dict)   # see FitContext
    checkpoint_inputs: bool = False   # write train/val to the shared checkpoint folder
    store_input: bool = True          # store the input once, partitioned by split
    train_partitions: int | None = None   # layout of train/val; None: from the stored bytes
    search: str = "tpe"               # "tpe" (random for the first trials) | "random"
    settings: TpeSettings = TpeSettings()
    stamp: str | None = None          # part of the experiments' names; that of a stored search to resume it
    resume: bool = False              # run only the trials that trial_table does not hold


@dataclass
class ModelFlowResult:
    predictions: DataFrame
    metrics: DataFrame
    trials: DataFrame
    tuned: dict[str, TuneResult]
    models: dict[str, Model]
    labels: list[Any]


def prepare(df: DataFrame, cfg: ModelFlowConfig, indexer, feat: str = "features",
            lab: str = "label") -> DataFrame:
    a = assemble(df, cfg.feature_cols, out=feat, handle_invalid=cfg.handle_invalid)
    a = indexer.transform(a)
    return a.select(*cfg.key_cols, cfg.target_col, feat, lab)


def store_by_split(df: DataFrame, split_col: str = "split") -> DataFrame:
    """``df`` written once to the shared folder, partitioned by split: a filter on the split
    then reads that part's files only."""
    path = scratch_path(df.sparkSession, "by_split")
    df.write.partitionBy(split_col).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_model_flow(data: DataFrame, cfg: ModelFlowConfig) -> ModelFlowResult:
    spark: SparkSession = data.sparkSession
    cols = [*cfg.key_cols, *cfg.feature_cols, cfg.target_col, cfg.split_col]
    if cfg.handle_invalid == "keep":
        raise ValueError("handle_invalid='keep' gives unseen labels a class of their own, which no vote "
                         "can return; use 'error' or 'skip'")
    families = {f.name: f for f in map(get_family, cfg.families)}
    data = data.select(*dict.fromkeys(cols))
    if cfg.store_input:
        data = store_by_split(data, cfg.split_col)
    part = {s: data.where(F.col(cfg.split_col) == s) for s in ("train", "val", "test")}
    target_type = data.schema[cfg.target_col].dataType.simpleString()

    # Internal vector/index columns, named so they cannot clash with input columns
    # (a target called "label" is common).
    feat, lab = free_name(data.columns, "features"), free_name(data.columns, "label")
    # One label list for every model (fitted on train + val), so class i means the
    # same thing in each probability vector.
    indexer = fit_label_indexer(select_splits(data, ["train", "val"], cfg.split_col),
                                cfg.target_col, out=lab, handle_invalid=cfg.handle_invalid)
    labels = list(indexer.labelsArray[0])

    # Fits and scoring read only (features, label): cache just those columns, in a layout
    # that the rows alone decide.
    def placed(name):
        rows = place_rows(part[name].drop(cfg.split_col), cfg.key_cols, cfg.train_partitions)
        return training_frame(prepare(rows, cfg, indexer, feat, lab).select(feat, lab),
                              checkpoint=cfg.checkpoint_inputs)

    train, val = placed("train"), placed("val")
    try:
        t0 = time.perf_counter()
        n_train, n_val = train.count(), val.count()
        log.info("train %d rows, val %d rows cached in %.1fs", n_train, n_val,
                 time.perf_counter() - t0)
        if not n_val:
            raise ValueError("the validation part has no rows; trials cannot be compared")
        stamp = cfg.stamp or now_stamp()
        trial_log = TrialLog(spark, cfg.trial_table, cfg.trial_path) if cfg.trial_table else None

        def tune_family(fam: Family) -> TuneResult:
            return tune(
                train, val, fam, space=cfg.spaces.get(fam.name), max_evals=cfg.max_evals,
                metric=cfg.metric, maximize=cfg.maximize, seed=cfg.seed,
                parallelism=cfg.parallelism,
                experiment=experiment_name(cfg.experiment_base, fam.name, stamp),
                model_dir=cfg.model_dir, trial_table=trial_log,
                max_iter=cfg.max_iter, standardize=cfg.standardize, n_train=n_train,
                engine=cfg.engine, features_col=feat, label_col=lab, search=cfg.search,
                settings=cfg.settings, resume=cfg.resume)

        # Families are independent: their fits are submitted from separate driver
        # threads and share the executors (each fit is itself distributed).
        workers = max(1, min(cfg.family_parallelism, len(families)))
        with ThreadPoolExecutor(max_workers=workers) as pool:
            results = list(pool.map(tune_family, families.values()))
        tuned: dict[str, TuneResult] = {r.family: r for r in results}
        log.info("tuning done in %.1fs", time.perf_counter() - t0)

        train_val = union_train_val(train, val)
        ctx = FitContext(n_rows=n_train + n_val, seed=cfg.seed,
                         max_iter=cfg.refit_max_iter,
                         standardize=cfg.standardize, engine=cfg.engine,
                         features_col=feat, label_col=lab)
        with ThreadPoolExecutor(max_workers=workers) as pool:
            fitted = list(pool.map(
                lambda item: (item[0], refit(train_val, families[item[0]], item[1].best_params, ctx)),
                tuned.items()))
        models = dict(fitted)
        for name, m in models.items():
            log.info("%s refit: iterations %s (cap %d)", name, fit_iterations(m), cfg.refit_max_iter)
        log.info("refit done in %.1fs", time.perf_counter() - t0)
    finally:
        train.unpersist()
        val.unpersist()

    test = prepare(part["test"], cfg, indexer, feat, lab)
    predictions = soft_vote(test, models, labels, keep=[*cfg.key_cols, cfg.target_col],
                            label_type=None if target_type == "string" else target_type)
    acc = ensemble_accuracy(predictions, cfg.target_col)
    trials = None
    for t in tuned.values():
        trials = t.trials if trials is None else trials.unionByName(t.trials)
    # Long form (family, metric, value): the best validation score per family from the
    # trial records, and the ensemble's test accuracy as a distributed aggregate.
    best = spark.createDataFrame(
        [(name, m, float(v)) for name, t in tuned.items()
         for m, v in (("best_trial_id", t.best["trial_id"]),
                      ("best_val_score", t.best["val_score"]))],
        "family string, metric string, value double")
    ens = acc.select(F.explode(F.array(
        F.struct(F.lit("test_accuracy").alias("metric"), F.col("accuracy").alias("value")),
        F.struct(F.lit("test_rows").alias("metric"),
                 F.col("rows").cast("double").alias("value")))).alias("m"))
    metrics = best.unionByName(
        ens.select(F.lit("ensemble").alias("family"), "m.metric", "m.value"))
    return ModelFlowResult(predictions, metrics, trials, tuned, models, labels)
