"""Model families on Spark ML: feature assembly, label indexing, fit and predict.

Fits are distributed (tree statistics and gradients are aggregated across
partitions); nothing is collected except the fitted model itself.

Parameter mapping from the original (single-machine) hyperparameters to Spark ML:

* random forest: ``n_estimators -> numTrees``, ``max_depth -> maxDepth``,
  ``bootstrap -> bootstrap``, ``min_samples_leaf`` (a fraction of the rows) ->
  ``minWeightFractionPerNode``, features per split ``sqrt``. ``min_samples_split`` (a fraction too) has no setting in
  Spark: after the fit every node of fewer than ``ceil(min_samples_split * rows)`` rows is made a leaf (see
  ``forests``). Shares, not counts: they hold at any number of rows.
* logistic regression: ``penalty='l2'`` with ``C`` -> ``regParam = 1 / (C * n)``,
  ``elasticNetParam = 0``, ``standardization = False`` (the same optimum as
  minimising ``C * sum(loss) + 0.5 * |W|^2``); ``penalty='none'`` -> ``regParam = 0``.
  ``solver='liblinear'`` has another optimum, one fit per class with a penalised intercept (see ``one_vs_rest``); it
  cannot do without a penalty, which fails such a trial as in the original. The other solvers share one
  optimum and ``l1_ratio`` is unused: they are recorded with the trial but do not change the fit. Over many rows
  that optimum is found in a few passes (see ``softmax_newton``).

Bootstrap draws and split candidates depend on how rows lie in partitions.
``training_frame`` therefore places rows by key into a number of partitions that
follows from the data alone, so a seeded fit does not depend on the cluster's cores or
on how the input was partitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir, stored_bytes
from .binned_forest import fit_binned
from .forests import with_least_split
from .one_vs_rest import LARGE, OneVsRestLogistic, OneVsRestLogisticModel
from .softmax_newton import fit_large, fits_large
from .space import LR_SPACE, RF_SPACE, Distribution

FEATURES_COL = "features"
LABEL_COL = "label"


def free_name(taken: Sequence[str], name: str) -> str:
    """``name``, or ``_name``, ``__name``... whichever no existing column uses."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def assemble(df: DataFrame, feature_cols: Sequence[str], out: str = FEATURES_COL,
             handle_invalid: str = "error") -> DataFrame:
    """All feature columns, in order, as one vector column (JVM-side).

    Numeric and boolean columns are used as they are; array columns (e.g. an
    embedding stored as ``array<float>``) are converted with ``array_to_vector``
    and contribute all their elements, in order.
    """
    types = dict(df.dtypes)
    inputs, tmp = [], []
    for c in feature_cols:
        if types.get(c, "").startswith("array<"):
            name = f"_vec_{len(tmp)}_{c}"
            df = df.withColumn(name, array_to_vector(F.col(c)))
            inputs.append(name)
            tmp.append(name)
        else:
            inputs.append(c)
    out_df = VectorAssembler(inputCols=inputs, outputCol=out,
                             handleInvalid=handle_invalid).transform(df)
    return out_df.drop(*tmp) if tmp else out_df


def fit_label_indexer(df: DataFrame, target_col: str, out: str = LABEL_COL,
                      handle_invalid: str = "error") -> StringIndexerModel:
    """Class index in sorted label order (0 = smallest), fitted once and shared by
    every model so their probability columns line up. The fit is one grouped count;
    only the distinct labels reach the driver."""
    return StringIndexer(inputCol=target_col, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid=handle_invalid).fit(df)


TRAIN_PARTITION_BYTES = 64 << 20
TRAIN_PARTITION_ROWS = 250_000
LEAST_TRAIN_PARTITIONS = 16


def train_partitions(df: DataFrame) -> int:
    """Partitions of a training frame: one per ``TRAIN_PARTITION_BYTES`` of the stored input and one per
    ``TRAIN_PARTITION_ROWS`` rows, ``LEAST_TRAIN_PARTITIONS`` at least. The same for the same data on any cluster.

    Stored files may hold a row in a few bytes while a fit holds it in hundreds (a forest adds a count per
    tree), so rows decide too; counting a stored table reads its footers only."""
    by_bytes = -(-stored_bytes(df) // TRAIN_PARTITION_BYTES)
    return max(LEAST_TRAIN_PARTITIONS, by_bytes, -(-df.count() // TRAIN_PARTITION_ROWS))


def place_rows(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in a layout that only their values decide: hashed by ``by`` into ``partitions``
    (default ``train_partitions``) and sorted inside by ``by`` and then all other columns
    that can be ordered."""
    rest = [f.name for f in df.schema.fields if f.name not in by
            and f.dataType.typeName() not in ("map", "variant")]
    n = partitions or train_partitions(df)
    return df.repartition(n, *by).sortWithinPartitions(*by, *rest)


def _input_partitions(df: DataFrame) -> int | None:
    """Partition count of a frame whose plan has no exchange, found without running anything;
    None when the plan has one."""
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    except Exception:  # noqa: BLE001 - e.g. Spark Connect: no plan access
        return None
    return None if "Exchange" in plan else df.rdd.getNumPartitions()


def training_frame(df: DataFrame, min_partitions: int | None = None,
                   storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
                   checkpoint: bool = False) -> DataFrame:
    """Persist a frame that iterative fits will scan many times.

    Every tree level and every gradient step is one task per partition; ``place_rows``
    gives the frame a number of partitions and an order that do not depend on the cluster.
    Cached blocks lost with an executor are recomputed from lineage; with
    ``checkpoint=True`` the frame is first written to the shared checkpoint folder
    (``spark.checkpoint.dir``), so recomputation reads those files instead of
    re-running a long upstream plan. ``min_partitions`` spreads a scan of fewer partitions
    round-robin, for frames that were not placed.
    """
    if min_partitions:
        n = _input_partitions(df)
        if n is not None and n < min_partitions:
            df = df.repartition(min_partitions)
    if checkpoint:
        shared_dir(df.sparkSession)          # make sure the shared folder is registered
        df = df.checkpoint(eager=True)
    return df.persist(storage)


@dataclass
class FitContext:
    """What a family needs besides its hyperparameters."""
    n_rows: int
    seed: int = 42
    max_iter: int = 100
    standardize: bool = False
    features_col: str = FEATURES_COL
    label_col: str = LABEL_COL
    start_rows: int = 250_000         # large logistic fits start from a fit of about so many rows (0: never)
    # Engine settings per family name, applied on top of the mapped params, e.g.
    # {"random_forest": {"cacheNodeIds": True, "maxMemoryInMB": 512}} for deep
    # forests (node-id caching costs one int per tree per row) or
    # {"logistic_regression": {"aggregationDepth": 3}} on very many partitions.
    engine: dict[str, dict[str, Any]] = field(default_factory=dict)


def _with_engine(est: Estimator, family: str, ctx: FitContext) -> Estimator:
    opts = ctx.engine.get(family)
    return est.setParams(**opts) if opts else est


def build_random_forest(p: dict[str, Any], ctx: FitContext) -> Estimator:
    return _with_engine(RandomForestClassifier(
        featuresCol=ctx.features_col, labelCol=ctx.label_col, seed=ctx.seed,
        numTrees=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
        bootstrap=bool(p["bootstrap"]), featureSubsetStrategy="sqrt",
        minWeightFractionPerNode=float(p["min_samples_leaf"])), "random_forest", ctx)


def finish_random_forest(model: Model, p: dict[str, Any], ctx: FitContext) -> Model:
    """The forest without splits of nodes under ``min_samples_split``. Both children of a split hold
    ``min_samples_leaf`` of the rows, so a limit up to twice that is met as it is."""
    if float(p["min_samples_split"]) <= 2 * float(p["min_samples_leaf"]):
        return model
    return with_least_split(model, float(p["min_samples_split"]), ctx.n_rows)


def lr_reg_param(p: dict[str, Any], n_rows: int) -> float:
    if str(p.get("penalty", "l2")) == "none":
        return 0.0
    return 1.0 / (float(p["C"]) * max(1, n_rows))


def build_logistic_regression(p: dict[str, Any], ctx: FitContext) -> Estimator:
    if p.get("solver") == "liblinear":
        if str(p.get("penalty", "l2")) == "none":
            raise ValueError("solver 'liblinear' needs a penalty")
        return _with_engine(OneVsRestLogistic(
            featuresCol=ctx.features_col, labelCol=ctx.label_col, regParam=lr_reg_param(p, ctx.n_rows),
            maxIter=ctx.max_iter, startRows=ctx.start_rows), "logistic_regression", ctx)
    return _with_engine(LogisticRegression(
        featuresCol=ctx.features_col, labelCol=ctx.label_col, family="multinomial",
        regParam=lr_reg_param(p, ctx.n_rows), elasticNetParam=0.0,
        standardization=ctx.standardize, maxIter=ctx.max_iter), "logistic_regression", ctx)


def load_logistic_regression(path: str) -> Model:
    return (OneVsRestLogisticModel if OneVsRestLogisticModel.stored_at(path) else LogisticRegressionModel).load(path)


@dataclass
class Family:
    name: str
    space: dict[str, Distribution]
    build: Callable[[dict[str, Any], FitContext], Estimator]
    model_class: type = field(default=Model)
    finish: Callable[[Model, dict[str, Any], FitContext], Model] | None = None    # applied to a fitted model
    load: Callable[[str], Model] | None = None                                    # default: ``model_class.load``


FAMILIES: dict[str, Family] = {
    "random_forest": Family("random_forest", RF_SPACE, build_random_forest,
                            RandomForestClassificationModel, finish_random_forest),
    "logistic_regression": Family("logistic_regression", LR_SPACE, build_logistic_regression,
                                  LogisticRegressionModel, load=load_logistic_regression),
}


def get_family(family: str | Family) -> Family:
    if isinstance(family, Family):
        return family
    try:
        return FAMILIES[family]
    except KeyError:
        raise ValueError(f"unknown model family {family!r}; known: {sorted(FAMILIES)}") from None


def fit(family: str | Family, params: dict[str, Any], train: DataFrame,
        ctx: FitContext) -> Model:
    fam = get_family(family)
    est = fam.build(params, ctx)
    if isinstance(est, RandomForestClassifier):
        model = fit_binned(est, train)
    elif isinstance(est, LogisticRegression) and ctx.start_rows and ctx.n_rows > LARGE * ctx.start_rows and fits_large(est):
        model = fit_large(est, train, ctx.start_rows)
    else:
        model = est.fit(train)
    return fam.finish(model, params, ctx) if fam.finish else model


def fit_iterations(model: Model) -> int | None:
    """Iterations an iterative fit took (None for others): at the cap, it did not converge."""
    if isinstance(model, OneVsRestLogisticModel):
        return model.totalIterations
    if hasattr(model, "newton_steps"):
        return model.newton_steps
    if isinstance(model, LogisticRegressionModel) and model.hasSummary:
        return int(model.summary.totalIterations)
    return None


def predict(model: Model, df: DataFrame, prefix: str = "",
            probability_array: bool = True) -> DataFrame:
    """Add ``{prefix}prediction`` (class index, double) and ``{prefix}probability``
    (array<double> when ``probability_array``) to ``df``; the input columns stay."""
    m = model.copy()
    m.set(m.predictionCol, f"{prefix}prediction")
    m.set(m.probabilityCol, f"{prefix}probability_vec")
    m.set(m.rawPredictionCol, f"{prefix}raw_prediction")
    out = m.transform(df).drop(f"{prefix}raw_prediction")
    if probability_array:
        out = out.withColumn(f"{prefix}probability",
                             vector_to_array(F.col(f"{prefix}probability_vec"))
                             ).drop(f"{prefix}probability_vec")
    return out


def save_model(model: Model, path: str) -> str:
    if isinstance(model, OneVsRestLogisticModel):
        model.save(path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(family: str | Family, path: str) -> Model:
    fam = get_family(family)
    return fam.load(path) if fam.load else fam.model_class.load(path)
