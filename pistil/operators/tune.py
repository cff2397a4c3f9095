"""Hyperparameter search: propose trials, fit each on train, score on validation.

Trials run in batches of ``parallelism``: the batch's fits are submitted together from a
small driver thread pool (the same scheme as Spark's own CrossValidator), its models are
scored in one pass over the validation rows, and its trials are logged before the next
batch starts. Of all models only the best so far stays on the driver. Every trial, failed
ones included, is a row of the trials frame.

The first trials are random draws; once enough have finished, a batch is proposed by the Parzen
search of ``tpe`` from all trials of earlier batches. Proposals depend on the history and the seed alone, so a
search that was cut off can go on (``resume=True``): stored trials are taken as they are and only
the absent ones run.
"""

from __future__ import annotations

import json
import logging
import math
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock
from typing import Any

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .metrics import Metric, batch_scores, resolve_metric
from .models import FitContext, Family, fit, fit_iterations, get_family, load_model, save_model
from .space import Distribution, row_params, space_fields, trial_frame
from .tpe import TpeSettings, propose

log = logging.getLogger("pistil.tune")

TRIAL_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType(), False),
    T.StructField("family", T.StringType(), False),
    T.StructField("trial_id", T.LongType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("params", T.StringType(), False),
    T.StructField("val_score", T.DoubleType(), True),
    T.StructField("val_loss", T.DoubleType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
    T.StructField("artifact_uri", T.StringType(), True),
    T.StructField("iterations", T.IntegerType(), True),
])


TRIAL_KEY = ["experiment", "family", "trial_id"]


class TrialLog:
    """A trial table that any number of driver processes write to.

    The table is partitioned by trial, and a batch is one write that replaces exactly its own trials'
    partitions (dynamic partition overwrite): Spark stages the files of such a write in a folder of its own and
    moves them in place when it commits, so writers do not see each other, readers see committed
    trials only, and a batch that is written again gives one row a trial. Within a process
    families that are tuned at the same time share one object.
    """

    def __init__(self, spark: SparkSession, table: str, path: str | None = None):
        self.spark, self.table, self._lock = spark, table, Lock()
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRIAL_SCHEMA)
            where = " LOCATION '{}'".format(path.replace("\\", "\\\\").replace("'", "\\'")) if path else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(TRIAL_KEY)}){where}")
            if path:                              # a folder that another process may have filled
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
                spark.catalog.recoverPartitions(table)

    @property
    def path(self) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"]

    def add(self, records: list[dict[str, Any]]) -> None:
        if not records:
            return
        rows = self.spark.createDataFrame(records, schema=TRIAL_SCHEMA).coalesce(1)
        with self._lock:
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*TRIAL_KEY).parquet(self.path))
            self.spark.catalog.recoverPartitions(self.table)

    def read(self) -> DataFrame:
        """All committed trials, those of other processes included (the folder is listed anew)."""
        kinds = {f.name: f.dataType for f in TRIAL_SCHEMA}
        found = self.spark.read.schema(TRIAL_SCHEMA).parquet(self.path)
        return found.select(*[F.col(c).cast(kinds[c]) for c in kinds])


@dataclass
class TuneResult:
    family: str
    experiment: str
    trials: DataFrame
    best: dict[str, Any]
    best_params: dict[str, Any]
    best_model: Model | None


def tune(train: DataFrame, val: DataFrame, family: str | Family,
         space: dict[str, Distribution] | None = None, max_evals: int = 3,
         metric: str | Metric = "accuracy", maximize: bool = True, seed: int = 42,
         parallelism: int = 2, experiment: str | None = None,
         model_dir: str | None = None, trial_table: str | TrialLog | None = None,
         max_iter: int = 100, standardize: bool = False,
         features_col: str = "features", label_col: str = "label",
         n_train: int | None = None,
         engine: dict[str, dict[str, Any]] | None = None,
         search: str = "tpe", settings: TpeSettings = TpeSettings(), resume: bool = False) -> TuneResult:
    """Run ``max_evals`` trials of ``family`` and return the trials and the best one.

    ``train``/``val`` carry an assembled ``features_col`` and an indexed ``label_col``;
    cache them first, every trial reads them. ``model_dir`` keeps each trial's model
    under ``model_dir/<experiment>/<trial_id>``; ``trial_table`` (a name, or a ``TrialLog`` that
    several calls share) gets each batch of trials as it finishes.
    ``search`` is ``"tpe"`` (random until ``settings.startup`` trials have finished) or ``"random"``.
    ``resume`` takes the trials of ``experiment`` that ``trial_table`` holds and runs the others; parameters that
    differ from what this search would have tried are an error (another seed, space or batch size).
    The best trial is the lowest loss among successful trials, first trial id on ties.
    """
    if search not in ("tpe", "random"):
        raise ValueError(f"search must be 'tpe' or 'random', got {search!r}")
    fam = get_family(family)
    space = space or fam.space
    spark: SparkSession = train.sparkSession
    metric_fn = resolve_metric(metric)
    trial_log = TrialLog(spark, trial_table) if isinstance(trial_table, str) else trial_table
    if resume and not (experiment and trial_log):
        raise ValueError("resume needs the experiment's name and its trial_table")
    experiment = experiment or f"{fam.name}_{uuid.uuid4().hex[:8]}"
    draws = {int(r["trial_id"]): row_params(r, space)
             for r in trial_frame(spark, space, max_evals, seed).collect()}     # max_evals small rows
    stored: dict[int, dict[str, Any]] = {}
    if resume:
        mine = (F.col("experiment") == experiment) & (F.col("family") == fam.name) & F.col("trial_id").between(1, max_evals)
        stored = {r["trial_id"]: r.asDict() for r in trial_log.read().where(mine).collect()}
        log.info("%s: %d of %d trials are stored", experiment, len(stored), max_evals)
    n = n_train if n_train is not None else train.count()
    if val.isEmpty():
        raise ValueError("no validation rows to score trials on; give the validation part a ratio above 0")
    ctx = FitContext(n_rows=n, seed=seed, max_iter=max_iter, standardize=standardize,
                     features_col=features_col, label_col=label_col, engine=engine or {})

    def fail(rec, e):
        rec["status"], rec["error"] = "failed", f"{type(e).__name__}: {e}"

    def params_of(ids: list[int], before: list[dict[str, Any]]) -> dict[int, dict[str, Any]]:
        """What to try in a batch, from the trials of earlier batches."""
        done = [r for r in before if r["status"] == "ok" and r["val_loss"] is not None and not math.isnan(r["val_loss"])]
        if search == "random" or len(done) < settings.startup:
            return {t: draws[t] for t in ids}
        fields = space_fields(space)
        history = spark.createDataFrame(
            [(experiment, r["trial_id"], r["val_loss"], *(json.loads(r["params"])[k] for k in space)) for r in done],
            T.StructType([*(TRIAL_SCHEMA[c] for c in ("experiment", "trial_id", "val_loss")), *fields]))
        asked = spark.createDataFrame([(experiment, t) for t in ids], T.StructType([TRIAL_SCHEMA["experiment"], TRIAL_SCHEMA["trial_id"]]))
        got = propose(history, asked, space, seed, status_col=None, settings=settings).collect()      # one row a trial
        return {r["trial_id"]: row_params(r, space) for r in got}

    def run(tid: int, params: dict[str, Any]):
        rec = {"experiment": experiment, "family": fam.name, "trial_id": tid,
               "run_id": uuid.uuid4().hex, "params": json.dumps(params, sort_keys=True),
               "val_score": None, "val_loss": None, "status": "ok", "error": None,
               "artifact_uri": None, "iterations": None}
        model = None
        t0 = time.perf_counter()
        try:
            model = fit(fam, params, train, ctx)
            rec["iterations"] = fit_iterations(model)
            log.info("%s trial %d: fit %.1fs", fam.name, tid, time.perf_counter() - t0)
            if model_dir:
                rec["artifact_uri"] = save_model(
                    model, f"{model_dir.rstrip('/')}/{experiment}/{tid}")
        except Exception as e:  # noqa: BLE001 - a failed trial is a result, not a crash
            fail(rec, e)
            model = None
        return rec, params, model

    def score(batch):
        """All models of a batch, in one pass where the metric allows it."""
        scores, errors = batch_scores({r["trial_id"]: m for r, _, m in batch if m is not None}, val, metric_fn, label_col)
        for rec, _, _ in batch:
            if rec["trial_id"] in errors:
                fail(rec, errors[rec["trial_id"]])
            elif rec["trial_id"] in scores:
                rec["val_score"] = scores[rec["trial_id"]]
                rec["val_loss"] = -rec["val_score"] if maximize else rec["val_score"]

    workers = max(1, min(parallelism, max_evals))
    recs: list[dict[str, Any]] = []
    best: tuple | None = None                     # (order, record, params, model)
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for at in range(1, max_evals + 1, workers):
            ids = list(range(at, min(at + workers, max_evals + 1)))
            wanted = params_of(ids, recs)
            for t in ids:
                if t in stored and json.loads(stored[t]["params"]) != json.loads(json.dumps(wanted[t])):
                    raise ValueError(f"stored trial {t} of {experiment!r} was run with {stored[t]['params']}, not with {wanted[t]}")
            todo = [t for t in ids if t not in stored]
            batch = list(pool.map(lambda t: run(t, wanted[t]), todo))
            score(batch)
            if trial_log:
                trial_log.add([r for r, _, _ in batch])
            for rec, params, model in [*batch, *((stored[t], wanted[t], None) for t in ids if t in stored)]:
                recs.append(rec)
                loss = rec["val_loss"]
                if rec["status"] != "ok" or loss is None:
                    continue
                place = (math.isnan(loss), loss if not math.isnan(loss) else 0.0, rec["trial_id"])
                if best is None or place < best[0]:
                    best = (place, rec, params, model)
            del batch
    recs.sort(key=lambda r: r["trial_id"])
    trials = spark.createDataFrame([{f.name: r[f.name] for f in TRIAL_SCHEMA} for r in recs], schema=TRIAL_SCHEMA)
    if best is None:
        errors = "; ".join(f"trial {r['trial_id']}: {r['error']}" for r in recs)
        raise ValueError(f"all {len(recs)} trials of {fam.name} failed: {errors}")
    _, best_row, best_params, best_model = best
    if best_model is None:                        # a stored trial: its model is read back or fitted again
        best_model = (load_model(fam, best_row["artifact_uri"]) if best_row["artifact_uri"]
                      else fit(fam, best_params, train, ctx))
    return TuneResult(fam.name, experiment, trials, dict(best_row), best_params, best_model)
