"""The Parzen search, trial logs, resuming, metrics of many trials, and the two limits Spark ML lacks."""

import hashlib
import json
import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pistil.operators import metrics as metrics_module
from pistil.operators import tune as tune_module
from pistil.operators.forests import NODE, cut_small_splits, forest_nodes
from pistil.operators.metrics import CountMetric, batch_scores, confusion_counts, confusion_metrics, model_counts, resolve_metric
from pistil.operators.models import FitContext, assemble, fit, fit_iterations, fit_label_indexer, load_model, predict, save_model
from pistil.operators.space import Choice, IntRange, LogUniform, Uniform
from pistil.operators.split import tag_split
from pistil.operators.tpe import TpeSettings, propose
from pistil.operators.tune import TrialLog, tune
from pistil.session import held, scratch_path, shared_dir, unique_name

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
SPACE = {"n": IntRange(10, 31, 5), "kind": Choice(["a", "b", "c"]), "x": Uniform(-1.0, 3.0), "rate": LogUniform(-4, 4), "fix": Uniform(2.0, 2.0)}


@pytest.fixture(scope="module")
def parts(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    band = (F.when(F.col("l_extendedprice") < 35000, "low").when(F.col("l_extendedprice") < 70000, "mid").otherwise("high"))
    li = tag_split(li.withColumn("band", band), KEY, (.7, .15, .15), 42)
    out = fit_label_indexer(li, "band").transform(assemble(li, FEATS)).select(*KEY, "split", "features", "label")
    return {s: out.where(F.col("split") == s).cache() for s in ("train", "val", "test")}


# --- proposals, against the algorithm in plain Python ------------------------------------------------------

def uniform(key, salt, seed):
    return int(hashlib.md5(f"{key}|{salt}|{seed}".encode()).hexdigest()[:8], 16) / 2 ** 32


def by_hand(history, trial, space, seed, s, experiment="e"):
    """One experiment, one proposal. ``history``: (trial id, loss, {parameter: value})."""
    ranked = sorted(history, key=lambda h: (h[1], h[0]))
    n_good = min(s.most_good, math.ceil(s.gamma * math.sqrt(len(ranked))))
    out, unit = {}, math.sqrt(3) / math.pi
    for p, (name, d) in enumerate(space.items()):
        if isinstance(d, (Uniform, LogUniform)) and d.lo == d.hi:
            out[name] = d.lo
            continue
        values = list(d.values) if isinstance(d, Choice) else list(range(d.start, d.stop, d.step)) if isinstance(d, IntRange) else None
        number = values.index if values else math.log if isinstance(d, LogUniform) else float
        good, bad = ([number(h[2][name]) for h in side] for side in (ranked[:n_good], ranked[n_good:]))
        good.sort()
        lo, hi = (0, 1) if values else (d.lo, d.hi)

        def width(xs):
            if len(xs) < 2:
                return hi - lo
            return min(hi - lo, max((hi - lo) / min(100, len(xs) + 1), 1.06 * np.std(xs, ddof=1) * len(xs) ** -0.2))

        def cdf(x, mu, sd):
            return 1 / (1 + math.exp(-(x - mu) / (sd * unit)))

        def density(x, xs):
            def kernel(mu, sd):
                e = math.exp(-abs(x - mu) / (sd * unit))
                return e / (1 + e) ** 2 / (sd * unit) / (cdf(hi, mu, sd) - cdf(lo, mu, sd))
            if values:
                return (xs.count(x) + s.prior_weight / len(values)) / (len(xs) + s.prior_weight)
            return (sum(kernel(m, width(xs)) for m in xs) + s.prior_weight * kernel((lo + hi) / 2, hi - lo)) / (len(xs) + s.prior_weight)

        best = None
        for c in range(s.candidates):
            key = f"{experiment}|{trial}|{p}|{c}"
            u1 = uniform(key, "tpe1", seed) * (len(good) + s.prior_weight) - s.prior_weight
            u2 = uniform(key, "tpe2", seed)
            if values:
                x = int(u2 * len(values)) if u1 < 0 else good[int(u1)]
            else:
                mu, sd = ((lo + hi) / 2, hi - lo) if u1 < 0 else (good[int(u1)], width(good))
                q = cdf(lo, mu, sd) + u2 * (cdf(hi, mu, sd) - cdf(lo, mu, sd))
                x = min(hi, max(lo, mu + sd * unit * math.log(q / (1 - q))))
            score = round(math.log(density(x, good)) - math.log(density(x, bad)), 9)
            if best is None or score > best[0]:
                best = (score, x)
        x = best[1]
        out[name] = values[int(x)] if values else math.exp(x) if isinstance(d, LogUniform) else x
    return out


def a_history(n, seed):
    rng = np.random.default_rng(seed)
    return [(t, float(rng.integers(0, 12)), {"n": int(rng.choice([10, 15, 20, 25, 30])), "kind": str(rng.choice(["a", "b", "c"])),
                                             "x": float(rng.uniform(-1, 3)), "rate": float(np.exp(rng.uniform(-4, 4))), "fix": 2.0})
            for t in range(1, n + 1)]


COLUMNS = "experiment string, trial_id long, val_loss double, status string, n int, kind string, x double, rate double, fix double"


def as_frame(spark, histories):
    return spark.createDataFrame([(e, t, loss, "ok", *p.values()) for e, h in histories.items() for t, loss, p in h], COLUMNS)


@pytest.mark.parametrize("n", [3, 20, 150])
def test_proposals_equal_a_history_worked_by_hand(spark, n):
    histories = {e: a_history(n, i) for i, e in enumerate(("e", "f"))}
    s = TpeSettings(startup=3)
    asked = spark.createDataFrame([(e, n + k) for e in histories for k in (1, 2)], "experiment string, trial_id long")
    rows = propose(as_frame(spark, histories), asked, SPACE, 5, settings=s).collect()
    assert len(rows) == 4
    for r in rows:
        want = by_hand(histories[r.experiment], r.trial_id, SPACE, 5, s, r.experiment)
        assert r.proposed_by == "tpe" and (r.n, r.kind) == (want["n"], want["kind"])
        assert r.x == pytest.approx(want["x"], rel=1e-9) and r.rate == pytest.approx(want["rate"], rel=1e-9) and r.fix == 2.0


def test_good_values_are_proposed_and_failed_trials_ignored(spark):
    rows = [("e", t, float(t % 2), "ok", 10, "abac"[t % 4], 2.9 if t % 2 == 0 else -0.9, 1.0, 2.0) for t in range(40)]
    rows += [("e", 100, -99.0, "failed", 30, "c", 0.0, 1.0, 2.0), ("e", 101, None, "ok", 30, "c", 0.0, 1.0, 2.0),
             ("e", 102, float("nan"), "ok", 30, "c", 0.0, 1.0, 2.0), ("e", 103, 0.5, "ok", 7, "z", 99.0, -1.0, None)]
    asked = spark.createDataFrame([("e", t) for t in range(200, 220)] + [("other", 1)], "experiment string, trial_id long")
    got = propose(spark.createDataFrame(rows, COLUMNS), asked, SPACE, 1).collect()
    tpe = [r for r in got if r.proposed_by == "tpe"]
    assert len(tpe) == 20 and {r.experiment for r in got if r.proposed_by == "random"} == {"other"}
    assert {r.kind for r in tpe} == {"a"} and all(r.x > 1.0 for r in tpe)


def test_search_reaches_the_parzen_phase_and_repeats(parts):
    space = {"penalty": Choice(["l2"]), "C": LogUniform(-4, 4), "solver": Choice(["lbfgs"]), "l1_ratio": Uniform(0, 1)}
    run = lambda **kw: tune(parts["train"], parts["val"], "logistic_regression", space, max_evals=7, parallelism=2, max_iter=3,
                            settings=TpeSettings(startup=4), experiment="x", **kw)
    a, b = ([json.loads(r.params) for r in run().trials.orderBy("trial_id").collect()] for _ in range(2))
    random = [json.loads(r.params) for r in run(search="random").trials.orderBy("trial_id").collect()]
    assert a == b and a[:4] == random[:4] and all(x != y for x, y in zip(a[4:], random[4:]))
    with pytest.raises(ValueError, match="search"):
        run(search="grid")


# --- trial logs and resuming ---------------------------------------------------------------------------------

WRITER = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.warehouse.dir", sys.argv[2] + "/w" + sys.argv[1]).getOrCreate())
from pistil.operators.tune import TrialLog
log = TrialLog(spark, "trials", sys.argv[2] + "/trials")
for batch in range(4):
    for again in range(2):               # every batch is written twice
        log.add([dict(experiment="/exp/" + sys.argv[1], family="f", trial_id=batch * 2 + i, run_id=str(again), params="{{}}", val_score=0.5,
                      val_loss=-0.5, status="ok", error=None, artifact_uri=None, iterations=None) for i in (0, 1)])
"""


def test_two_drivers_write_one_trial_table(spark, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "writer.py"
    script.write_text(WRITER.format(root=root))
    both = [subprocess.Popen([sys.executable, str(script), name, str(tmp_path)], stderr=subprocess.PIPE, text=True, cwd=tmp_path) for name in "AB"]
    said = [p.communicate(timeout=300)[1] for p in both]
    assert [p.returncode for p in both] == [0, 0], said
    rows = TrialLog(spark, unique_name("trials"), f"{tmp_path}/trials").read().collect()
    assert sorted((r.experiment, r.trial_id, r.run_id) for r in rows) == [(f"/exp/{e}", t, "1") for e in "AB" for t in range(8)]


def test_resumed_search_runs_only_absent_trials(spark, parts, monkeypatch):
    space = {"penalty": Choice(["l2"]), "C": LogUniform(-4, 4), "solver": Choice(["lbfgs", "liblinear"]), "l1_ratio": Uniform(0, 1)}
    name = unique_name("trials")
    where = shared_dir(spark, "tables", name)
    fitted = []
    plain = tune_module.fit

    def counted(family, params, train, ctx):
        fitted.append(params)
        if len(fitted) == stop_at[0]:
            raise KeyboardInterrupt
        return plain(family, params, train, ctx)

    stop_at = [7]
    monkeypatch.setattr(tune_module, "fit", counted)
    run = lambda **kw: tune(parts["train"], parts["val"], "logistic_regression", space, max_evals=8, parallelism=2, max_iter=5,
                            settings=TpeSettings(startup=4), **kw)
    with pytest.raises(KeyboardInterrupt):
        run(experiment="cut", trial_table=TrialLog(spark, name, where))
    stored = {r.trial_id: r.run_id for r in TrialLog(spark, name, where).read().collect()}
    assert sorted(stored) == [1, 2, 3, 4, 5, 6]
    stop_at[0], fitted[:] = None, []
    resumed = run(experiment="cut", trial_table=TrialLog(spark, name, where), resume=True)
    assert len(fitted) in (2, 3)                       # trials 7 and 8, and the best one's model if it was stored
    rows = {r.trial_id: r for r in TrialLog(spark, name, where).read().collect()}
    assert sorted(rows) == list(range(1, 9)) and all(rows[t].run_id == i for t, i in stored.items())
    whole = run(experiment="cut")
    assert resumed.best["trial_id"] == whole.best["trial_id"] and resumed.best_params == whole.best_params
    assert resumed.best_model is not None
    with pytest.raises(ValueError, match="was run with"):
        run(experiment="cut", trial_table=TrialLog(spark, name, where), resume=True, seed=7)
    with pytest.raises(ValueError, match="resume needs"):
        run(resume=True)


# --- metrics ---------------------------------------------------------------------------------------------------

def test_metrics_of_many_trials_in_one_pass(spark, parts):
    params = {"n_estimators": 4, "max_depth": 3, "min_samples_split": 0.01, "min_samples_leaf": 0.01, "bootstrap": True}
    ctx = FitContext(n_rows=parts["train"].count())
    models = {1: fit("random_forest", params, parts["train"], ctx),
              2: fit("logistic_regression", {"penalty": "l2", "C": 0.01, "solver": "liblinear"}, parts["train"], ctx)}
    counts = model_counts(models, parts["val"])
    for t, m in models.items():
        rows = predict(m, parts["val"]).select("label", "prediction").collect()
        y, p = (np.array([r[c] for r in rows]) for c in ("label", "prediction"))
        assert sum(counts[t].values()) == len(rows)
        assert resolve_metric("accuracy").of(counts[t]) == pytest.approx((y == p).mean())
        f1 = [2 * ((y == c) & (p == c)).sum() / ((y == c).sum() + (p == c).sum()) for c in np.unique([y, p])]
        assert resolve_metric("f1_macro").of(counts[t]) == pytest.approx(np.mean(f1))
    scores, errors = batch_scores(models, parts["val"], CountMetric(lambda n: float(len(n))))
    assert scores == {t: float(len(n)) for t, n in counts.items()} and not errors
    scores, errors = batch_scores({1: models[1], 3: "no model"}, parts["val"], resolve_metric("kappa"))
    assert set(scores) == {1} and set(errors) == {3}


def test_confusion_metrics_with_missing_and_constant_predictions(spark):
    rows = [("a", "a", "b"), ("a", "b", "b"), ("b", None, "b"), (None, None, "b")]
    df = spark.createDataFrame(rows, "y string, p string, q string")
    out = {r.trial: r for r in confusion_metrics(confusion_counts(df, "y", {1: "p", 2: "q"})).collect()}
    assert out[1].accuracy == 0.5 and out[2].accuracy == 0.25 and out[1].rows == 4
    assert out[2].recall_macro == pytest.approx(1 / 3) and out[1].precision_macro == pytest.approx((1 + 0 + 0.5) / 3)
    plain = resolve_metric("kappa").of({("a", "b"): 2, ("a", "a"): 2, ("b", "b"): 4})
    assert plain == pytest.approx((0.75 - 0.5) / 0.5)
    assert confusion_metrics(confusion_counts(df.limit(0), "y", {1: "p"})).count() == 0


# --- limits that Spark ML lacks -------------------------------------------------------------------------------

def splits(nodes):
    return [(r.treeID, r.id, r.rawCount) for r in nodes.select("treeID", f"{NODE}.*").where("leftChild >= 0").collect()]


def test_no_split_below_min_samples_split(spark, parts):
    n = parts["train"].count()
    params = {"n_estimators": 8, "max_depth": 9, "min_samples_split": 0.15, "min_samples_leaf": 0.005, "bootstrap": True}
    ctx = FitContext(n_rows=n)
    free = fit("random_forest", {**params, "min_samples_split": 0.01}, parts["train"], ctx)
    cut = fit("random_forest", params, parts["train"], ctx)
    before, after = (forest_nodes(save_model(m, scratch_path(spark, "f"))) for m in (free, cut))
    limit = math.ceil(0.15 * n)
    assert any(c < limit for _, _, c in splits(before)) and all(c >= limit for _, _, c in splits(after))
    # all other splits are kept, and leaves keep their class counts
    assert len(splits(after)) == sum(c >= limit for _, _, c in splits(before))
    stats = lambda d: {(r.treeID, r.rawCount, *r.impurityStats) for r in d.select("treeID", f"{NODE}.*").collect()}
    assert stats(after) <= stats(before)
    assert cut.getNumTrees == 8 and predict(cut, parts["test"]).count() == parts["test"].count()
    # the same limit on the cut forest changes nothing
    assert sorted(splits(cut_small_splits(after, limit))) == sorted(splits(after))
    one = cut_small_splits(before, n * 10).select("treeID", f"{NODE}.*").collect()
    assert len(one) == 8 and {(r.id, r.leftChild, r.gain) for r in one} == {(0, -1, -1.0)}


def test_limits_hold_in_the_search_itself(parts):
    """Fits run in threads of the search."""
    rf = {"n_estimators": IntRange(3, 5), "max_depth": IntRange(5, 9), "min_samples_split": Uniform(0.2, 0.3), "min_samples_leaf": Uniform(0.01, 0.02),
          "bootstrap": Choice([True, False])}
    lr = {"penalty": Choice(["l2"]), "C": Uniform(0.5, 1.0), "solver": Choice(["liblinear"]), "l1_ratio": Uniform(0, 1)}
    for family, space in (("random_forest", rf), ("logistic_regression", lr)):
        res = tune(parts["train"], parts["val"], family, space, max_evals=3, parallelism=3)
        assert {(r.status, r.error) for r in res.trials.collect()} == {("ok", None)}


@pytest.mark.parametrize("classes", [2, 3])
def test_liblinear_optimum(spark, parts, classes):
    rows = parts["train"].withColumn("label", F.least("label", F.lit(float(classes - 1)))).select("features", "label")
    n = rows.count()
    model = fit("logistic_regression", {"penalty": "l2", "C": 0.3, "solver": "liblinear"}, rows, FitContext(n_rows=n))
    got = rows.collect()
    x = np.array([[*r.features.toArray(), 1.0] for r in got])
    y = np.array([r.label for r in got])
    assert len(model.coefficients) == (1 if classes == 2 else 3) and model.numClasses == classes
    margins = x @ model.coefficients.T
    size = np.abs(x).max(0)
    for i, c in enumerate([1] if classes == 2 else range(3)):
        grad = 0.3 * (1 / (1 + np.exp(-margins[:, i])) - (y == c)) @ x + model.coefficients[i]
        assert np.abs(grad / size).max() < 1e-6 * n
    p = 1 / (1 + np.exp(-(margins if classes == 3 else np.concatenate([-margins, margins], 1))))
    out = predict(model, rows, prefix="m_").collect()
    assert np.allclose([r.m_probability for r in out], p / p.sum(1, keepdims=True), atol=1e-9)
    assert [r.m_prediction for r in out] == (margins.argmax(1) if classes == 3 else (margins[:, 0] > 0) * 1).tolist()
    path = save_model(model, scratch_path(spark, "ovr"))
    again = predict(load_model("logistic_regression", path), rows, prefix="m_").collect()
    assert [r.m_probability for r in again] == [r.m_probability for r in out]


@pytest.mark.parametrize("rare", [0, 2])
def test_large_liblinear_fits_start_from_a_small_one(spark, rare):
    """The same optimum in fewer passes over all rows, also where the small fit lacks a class."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 2)) * [1.0, 3000.0]
    y = (x[:, 0] + x[:, 1] / 3000 + rng.logistic(size=6000) > 0).astype(int)
    y[:rare] = 2
    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y.tolist())], ["features", "label"])
    params = {"penalty": "l2", "C": 40.0, "solver": "liblinear"}
    cold, warm = (fit("logistic_regression", params, rows, FitContext(n_rows=6000, start_rows=k)) for k in (0, 1000))
    assert np.allclose(cold.coefficients, warm.coefficients, rtol=1e-6)
    assert warm.totalIterations < cold.totalIterations or rare


@pytest.mark.parametrize("classes, penalty, rare", [(2, "none", 0), (3, "l2", 2)])
def test_large_softmax_fits_take_few_passes(spark, classes, penalty, rare):
    """Spark's optimum in a few steps over all rows, whatever the features' sizes, also where the small fit lacks a class."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(6000, 3)) * [1.0, 30000.0, 0.0] + [0.0, 50000.0, 4.0]
    z = x[:, 0] + (x[:, 1] - 50000) / 30000
    y = np.argmax(np.stack([c * z for c in range(classes)], axis=1) + rng.gumbel(size=(6000, classes)), axis=1)
    if rare:
        y = np.minimum(y, 1)
        y[:rare] = 2
    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y.tolist())], ["features", "label"]).coalesce(2).cache()
    params = {"penalty": penalty, "C": 0.5, "solver": "lbfgs"}
    exact = {"logistic_regression": {"tol": 1e-11}}
    cold, warm = (fit("logistic_regression", params, rows, FitContext(n_rows=6000, start_rows=k, max_iter=500, engine=exact)) for k in (0, 1000))
    close = lambda a, b: np.allclose(a, b, rtol=2e-3, atol=1e-7)
    assert warm.coefficientMatrix.toArray().shape == (classes, 3) and close(warm.coefficientMatrix.toArray(), cold.coefficientMatrix.toArray())
    assert close(warm.interceptVector.toArray(), cold.interceptVector.toArray())
    assert fit_iterations(warm) < fit_iterations(cold) and (fit_iterations(warm) <= 8 or rare)
    assert warm.getMaxIter() == 500 and warm.getFeaturesCol() == "features"
    again = load_model("logistic_regression", save_model(warm, scratch_path(spark, "softmax_test")))
    assert np.array_equal(again.coefficientMatrix.toArray(), warm.coefficientMatrix.toArray())


def test_large_softmax_fit_of_separable_rows_ends(spark):
    """Without a penalty weights would grow for ever; the fit ends at Spark's tolerance, with every row right."""
    rows = spark.range(6000).select(F.col("id").cast("double").alias("v"), (F.col("id") / 2000).cast("int").cast("double").alias("label"))
    rows = assemble(rows, ["v"]).select("features", "label").coalesce(2).cache()
    model = fit("logistic_regression", {"penalty": "none", "C": 1.0, "solver": "saga"}, rows, FitContext(n_rows=6000, start_rows=1000))
    assert fit_iterations(model) < 100 and predict(model, rows).where("prediction = label").count() > 5950
    assert np.isfinite(model.coefficientMatrix.toArray()).all()


def test_frames_of_equal_plans_stay_cached_for_the_last_holder(spark):
    make = lambda: spark.range(1000).where("id % 7 = 3")
    with held(make()) as a:
        with held(make()) as b:
            assert a.count() == b.count()
        assert a.storageLevel.useMemory
    assert not a.storageLevel.useMemory


def test_forests_side_by_side_count_their_cells_once(spark, parts, monkeypatch):
    """A forest that ends does not take the cached cells of one that still grows."""
    from pistil.operators import binned_forest
    kept, ended = [], []
    grow = binned_forest._splits

    def spied(*args):
        if not ended:
            ended.append(1)                       # inside the first level of the deep forest a shallow one comes and goes
            fit("random_forest", {**params, "max_depth": 1}, parts["train"], ctx)
        kept.append(cells[0].storageLevel.useMemory)
        return grow(*args)

    cells = []
    count = binned_forest._cells
    monkeypatch.setattr(binned_forest, "_cells", lambda *a: cells.append(count(*a)) or cells[-1])
    monkeypatch.setattr(binned_forest, "_splits", spied)
    params = {"n_estimators": 5, "max_depth": 4, "min_samples_split": 0.01, "min_samples_leaf": 0.01, "bootstrap": True}
    ctx = FitContext(n_rows=parts["train"].count())
    fit("random_forest", params, parts["train"], ctx)
    assert len(kept) > 3 and all(kept) and not cells[0].storageLevel.useMemory


def test_forests_are_scored_by_cells(spark, parts, monkeypatch):
    """The counts of every row's own prediction, for values on, between and beyond the thresholds."""
    params = {"n_estimators": 9, "max_depth": 5, "min_samples_split": 0.01, "min_samples_leaf": 0.01, "bootstrap": True}
    ctx = FitContext(n_rows=parts["train"].count())
    models = {1: fit("random_forest", params, parts["train"], ctx), 2: fit("random_forest", {**params, "max_depth": 2}, parts["train"], ctx),
              3: fit("logistic_regression", {"penalty": "l2", "C": 1.0, "solver": "lbfgs"}, parts["train"], ctx)}
    some = parts["val"].select("features", "label")
    edges = metrics_module.thresholds([models[1], models[2]], 4)
    assert sum(map(len, edges)) > 4 and all(np.all(np.diff(e) > 0) for e in edges)
    odd = [(Vectors.dense([v if j == f else 0.05 for j in range(4)]), 1.0) for f, e in enumerate(edges)
           for t in e for v in (t, np.nextafter(t, np.inf), np.nextafter(t, -np.inf))]
    odd += [(Vectors.dense([v] * 4), 2.0) for v in (-np.inf, np.inf, np.nan, 0.0)]
    rows = some.unionByName(spark.createDataFrame(odd, ["features", "label"]))
    plain = model_counts(models, rows)
    monkeypatch.setattr(metrics_module, "CELL_ROWS", 0)
    assert model_counts(models, rows) == plain and sum(plain[1].values()) == rows.count()


def test_liblinear_needs_a_penalty(parts):
    space = {"penalty": Choice(["none"]), "C": Uniform(1.0, 2.0), "solver": Choice(["liblinear"]), "l1_ratio": Uniform(0, 1)}
    with pytest.raises(ValueError, match="needs a penalty"):
        tune(parts["train"], parts["val"], "logistic_regression", space, max_evals=1)
