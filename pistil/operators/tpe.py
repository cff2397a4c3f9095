"""Tree-structured Parzen proposals: the next trials of many experiments from their histories.

For each parameter of an experiment two Parzen densities are built over the values tried so far: l over
the good trials (the ``ceil(gamma * sqrt(n))`` with the lowest losses, ``most_good`` at most), g over all others. Candidates
are drawn from l and the one with the largest l/g is proposed. Parameters are independent of each other, as
in the published algorithm for flat spaces. With fewer than ``startup`` finished trials the proposal is the
plain random draw of ``space.sample_space``.

* Continuous parameters (on the log scale where the space is): every tried value is a kernel of
  bandwidth ``1.06 * sd * m^(-1/5)``, at least ``range / min(100, m + 1)`` and at most the range, and a prior
  of ``prior_weight`` sits in the middle with the range as its bandwidth. Kernels are logistic, cut to the
  range: their distribution function and its inverse are closed forms.
* Choices and integer ranges: shares of the tried values, smoothed by ``prior_weight`` spread over all values.

Everything is a DataFrame plan over a long form (experiment, parameter, value), so any number of
experiments is proposed for at once. Histories are first counted per distinct value, the good trials
found by a limited window (25 rows a partition and experiment are shuffled), and the join of
candidates with values is salted, so an experiment with a large share of all trials is no single task.
Draws are hash-uniform by (experiment, trial, parameter, candidate): the same history gives the same proposals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform, key_string, sql_hash_uniform, sql_key
from .space import Choice, Distribution, IntRange, LogUniform, Uniform, _sql_lit, sample_space, sql_sample_space

SALTS = 16


@dataclass(frozen=True)
class TpeSettings:
    gamma: float = 0.25
    most_good: int = 25
    startup: int = 20
    candidates: int = 24
    prior_weight: float = 1.0


def _categories(d: Distribution) -> int | None:
    """Number of values of a choice or integer range, None for continuous ones."""
    return len(d.values) if isinstance(d, Choice) else d.size if isinstance(d, IntRange) else None


def _bounds(d: Distribution) -> tuple[float, float]:
    return (float(d.lo), float(d.hi)) if isinstance(d, (Uniform, LogUniform)) else (0.0, 1.0)


def _wide(space: dict[str, Distribution]) -> dict[str, Distribution]:
    """The space with ranges of one point as choices of one value."""
    point = {Uniform: float, LogUniform: math.exp}
    return {k: Choice([point[type(d)](d.lo)]) if isinstance(d, (Uniform, LogUniform)) and d.lo == d.hi else d for k, d in space.items()}


def encode(d: Distribution, c: Column) -> Column:
    """A parameter value as a number: its place among the values, or itself (or its log); null if outside."""
    if isinstance(d, Choice):
        at = F.array_position(F.array(*[F.lit(v) for v in d.values]), c)
        return F.when(at > 0, (at - 1).cast("double"))
    if isinstance(d, IntRange):
        at = (c.cast("double") - d.start) / d.step
        return F.when((at == F.floor(at)) & (at >= 0) & (at < d.size), at)
    x = F.log(c.cast("double")) if isinstance(d, LogUniform) else c.cast("double")
    lo, hi = _bounds(d)
    return F.when((x >= lo) & (x <= hi), x)


def decode(d: Distribution, x: Column) -> Column:
    if isinstance(d, Choice):
        return F.element_at(F.array(*[F.lit(v) for v in d.values]), (x + 1).cast("int"))
    if isinstance(d, IntRange):
        return (F.lit(d.start) + F.lit(d.step) * x).cast("int")
    return F.exp(x) if isinstance(d, LogUniform) else x


def _cdf(x: Column, mu: Column, s: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(x - mu) / s))


def _kernel(x: Column, mu: Column, sd: Column) -> Column:
    """Logistic density around ``mu`` with standard deviation ``sd``, cut to ``lo``..``hi``."""
    s = sd * F.lit(math.sqrt(3.0) / math.pi)
    e = F.exp(-F.abs((x - mu) / s))
    return e / ((F.lit(1.0) + e) * (F.lit(1.0) + e)) / s / (_cdf(F.col("hi"), mu, s) - _cdf(F.col("lo"), mu, s))


def _bandwidth(m: Column, sd: Column) -> Column:
    wide = F.col("hi") - F.col("lo")
    least = wide / F.least(F.lit(100.0), m + 1.0)
    return F.least(wide, F.greatest(least, F.coalesce(F.lit(1.06) * sd * F.pow(m.cast("double"), F.lit(-0.2)), wide)))


def _good(ok: DataFrame, group: Sequence[str], trial: str, loss: str, s: TpeSettings) -> DataFrame:
    """Group, trial of the good trials; ``ok`` has finished trials only."""
    n = ok.groupBy(*group).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*group).orderBy(loss, trial)
    top = ok.select(*group, trial, loss).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= s.most_good)
    return (top.join(n, list(group)).where(F.col("_r") <= F.ceil(F.lit(s.gamma) * F.sqrt(F.col("_n").cast("double"))))
               .select(*group, trial, F.lit(True).alias("_good")))


def propose(history: DataFrame, requests: DataFrame, space: dict[str, Distribution], seed: int = 42,
            group_cols: Sequence[str] = ("experiment",), trial_col: str = "trial_id", loss_col: str = "val_loss",
            status_col: str | None = "status", settings: TpeSettings = TpeSettings()) -> DataFrame:
    """``group_cols``, ``trial_col``, one column per parameter, and ``proposed_by`` ('tpe' or 'random') for every
    row of ``requests`` (groups and the ids of the trials to propose).

    ``history`` has the groups, trial ids, losses and one column per parameter. Failed trials and null or NaN losses
    take no part; a value outside the space counts for the other parameters only.
    """
    s, group, space = settings, list(group_cols), _wide(space)
    ok = history.where(F.col(loss_col).isNotNull() & ~F.isnan(F.col(loss_col).cast("double")))
    if status_col:
        ok = ok.where(F.col(status_col) == "ok")
    encoded = F.array(*[F.struct(F.lit(i).alias("p"), encode(d, F.col(name)).alias("x"))
                        for i, (name, d) in enumerate(space.items())])
    marked = ok.join(_good(ok, group, trial_col, loss_col, s), [*group, trial_col], "left")
    tried = (marked.select(*group, F.coalesce("_good", F.lit(False)).alias("good"), F.explode(encoded).alias("e"))
                   .select(*group, "good", "e.p", "e.x").where("x is not null"))
    # one row per distinct value: repeated values (all of a choice) are one entry
    values = tried.groupBy(*group, "p", "x").agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"))
    sides = tried.groupBy(*group, "p").agg(
        F.count_if("good").alias("m_good"), F.count_if(~F.col("good")).alias("m_bad"),
        F.stddev_samp(F.when(F.col("good"), F.col("x"))).alias("sd_good"),
        F.stddev_samp(F.when(~F.col("good"), F.col("x"))).alias("sd_bad"),
        F.sort_array(F.collect_list(F.when(F.col("good"), F.col("x")))).alias("mus"))          # most_good at most

    kinds = F.array(*[F.struct(F.lit(i).alias("p"), F.lit(_categories(d)).cast("int").alias("k"),
                               F.lit(_bounds(d)[0]).alias("lo"), F.lit(_bounds(d)[1]).alias("hi"))
                      for i, d in enumerate(space.values())])
    counts = ok.groupBy(*group).agg(F.count("*").alias("_n"))
    asked = requests.select(*group, trial_col).distinct().join(counts, group, "left")
    ready = asked.where(F.coalesce("_n", F.lit(0)) >= s.startup).select(*group, trial_col)
    u = lambda which: hash_uniform(key_string(*group, trial_col, "p", "c"), seed, salt=f"tpe{which}")
    m, w = F.col("m_good"), F.lit(s.prior_weight)
    cand = (ready.select("*", F.explode(kinds).alias("kind"))
                 .select(*group, trial_col, "kind.*", F.explode(F.sequence(F.lit(0), F.lit(s.candidates - 1))).alias("c"))
                 .join(sides, [*group, "p"], "left").na.fill(0, ["m_good", "m_bad"])
                 .withColumn("b_good", _bandwidth(m, F.col("sd_good"))).withColumn("b_bad", _bandwidth(F.col("m_bad"), F.col("sd_bad")))
                 .withColumn("u1", u(1) * (m + w) - w).withColumn("u2", u(2)))
    prior = F.col("u1") < 0
    middle, wide = (F.col("lo") + F.col("hi")) / 2.0, F.col("hi") - F.col("lo")
    mu = F.when(prior, middle).otherwise(F.get("mus", F.floor("u1").cast("int")))
    cand = (cand.withColumn("mu", mu).withColumn("s", F.when(prior, wide).otherwise(F.col("b_good")) * F.lit(math.sqrt(3.0) / math.pi))
                .withColumn("lo_p", _cdf(F.col("lo"), F.col("mu"), F.col("s")))
                .withColumn("q", F.col("lo_p") + F.col("u2") * (_cdf(F.col("hi"), F.col("mu"), F.col("s")) - F.col("lo_p"))))
    drawn = F.when(F.col("k").isNotNull(), F.when(prior, F.floor(F.col("u2") * F.col("k")).cast("double")).otherwise(F.col("mu"))
                   ).otherwise(F.least(F.col("hi"), F.greatest(F.col("lo"), F.col("mu") + F.col("s") * F.log(F.col("q") / (1.0 - F.col("q"))))))
    cand = cand.select(*group, trial_col, "p", "k", "lo", "hi", "c", "m_good", "m_bad", "b_good", "b_bad", drawn.alias("at"))

    salted = cand.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = values.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int"))
    met = salted.join(spread, [*group, "p", "salt"], "left")
    x, at = F.col("x"), F.col("at")

    def mass(side: str) -> Column:
        near = F.when(F.col("k").isNotNull(), (x == at).cast("double")).otherwise(_kernel(at, x, F.col(f"b_{side}")))
        return F.coalesce(F.sum(F.when(F.col(f"n_{side}") > 0, F.col(f"n_{side}") * near)), F.lit(0.0))

    base = F.when(F.col("k").isNotNull(), F.lit(1.0) / F.col("k")).otherwise(_kernel(at, middle, wide))
    # equal ratios are common among choices: the ninth decimal and then the first candidate decide
    scored = (met.groupBy(*group, trial_col, "p", "c", "at", "k", "lo", "hi", "m_good", "m_bad").agg(mass("good").alias("l"), mass("bad").alias("g"))
                 .withColumn("score", F.round(F.log((F.col("l") + w * base) / (m + w)) - F.log((F.col("g") + w * base) / (F.col("m_bad") + w)), 9)))
    best = scored.groupBy(*group, trial_col, "p").agg(F.max_by("at", F.struct("score", -F.col("c"))).alias("at"))
    wide_form = best.groupBy(*group, trial_col).agg(*[F.max(F.when(F.col("p") == i, F.col("at"))).alias(f"_x{i}") for i in range(len(space))])
    random = sample_space(asked.select(*group, trial_col), space, seed, trial_col, prefix="_r_")
    return random.join(wide_form.withColumn("_tpe", F.lit(True)), [*group, trial_col], "left").select(
        *group, trial_col,
        *[F.when(F.col("_tpe"), decode(d, F.col(f"_x{i}"))).otherwise(F.col(f"_r_{name}")).alias(name)
          for i, (name, d) in enumerate(space.items())],
        F.when(F.col("_tpe"), "tpe").otherwise("random").alias("proposed_by"))


# DuckDB twin, used only by the oracle SQL and the tests.

def _sql_encode(d: Distribution, c: str) -> str:
    if isinstance(d, Choice):
        return f"CAST(list_position([{', '.join(map(_sql_lit, d.values))}], {c}) - 1 AS DOUBLE)"
    if isinstance(d, IntRange):
        return f"CAST(({c} - {d.start}) // {d.step} AS DOUBLE)"
    return f"ln({c})" if isinstance(d, LogUniform) else f"CAST({c} AS DOUBLE)"


def _sql_decode(d: Distribution, x: str) -> str:
    if isinstance(d, Choice):
        return f"([{', '.join(map(_sql_lit, d.values))}])[CAST({x} AS BIGINT) + 1]"
    if isinstance(d, IntRange):
        return f"CAST({d.start} + {d.step} * {x} AS INTEGER)"
    return f"exp({x})" if isinstance(d, LogUniform) else x


def sql_propose(history: str, requests: str, space: dict[str, Distribution], seed: int = 42,
                settings: TpeSettings = TpeSettings()) -> str:
    """``propose`` over an ``experiment, trial_id, val_loss, <parameters>`` table of finished trials."""
    s, unit = settings, math.sqrt(3.0) / math.pi
    rows = ", ".join(f"{{'p': {i}, 'x': {_sql_encode(d, name)}}}" for i, (name, d) in enumerate(space.items()))
    kinds = ", ".join(f"({i}, {_categories(d) or 'NULL'}, {_bounds(d)[0]!r}::DOUBLE, {_bounds(d)[1]!r}::DOUBLE)"
                      for i, d in enumerate(space.values()))
    u = lambda n: sql_hash_uniform(sql_key("experiment", "trial_id", "p", "c"), seed, salt=f"tpe{n}")
    cdf = lambda x, mu, sc: f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({x} - {mu}) / {sc})))"

    def kernel(x, mu, sd):
        e = f"exp(-abs(({x} - {mu}) / ({sd} * {unit!r}::DOUBLE)))"
        sc = f"({sd} * {unit!r}::DOUBLE)"
        return f"({e} / ((1 + {e}) * (1 + {e})) / {sc} / ({cdf('hi', mu, sc)} - {cdf('lo', mu, sc)}))"

    def width(m, sd):
        return f"least(hi - lo, greatest((hi - lo) / least(100.0, {m} + 1.0), coalesce(1.06::DOUBLE * {sd} * pow({m}::DOUBLE, -0.2::DOUBLE), hi - lo)))"

    def mass(side):
        near = f"CASE WHEN k IS NOT NULL THEN CAST(x = at_ AS DOUBLE) ELSE {kernel('at_', 'x', 'b_' + side)} END"
        return f"coalesce(sum(CASE WHEN n_{side} > 0 THEN n_{side} * {near} END), 0)"

    base = f"(CASE WHEN k IS NOT NULL THEN 1.0::DOUBLE / k ELSE {kernel('at_', '((lo + hi) / 2)', '(hi - lo)')} END)"
    w = f"{s.prior_weight!r}::DOUBLE"
    out = ", ".join(f"CASE WHEN b.trial_id IS NULL THEN r.{name} ELSE {_sql_decode(d, f'b.x{i}')} END AS {name}"
                    for i, (name, d) in enumerate(space.items()))
    return f"""
WITH ok AS (SELECT * FROM {history} WHERE val_loss IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY val_loss, trial_id) <=
                  least({s.most_good}, ceil({s.gamma!r} * sqrt(count(*) OVER (PARTITION BY experiment)))) AS good FROM ok),
tried AS (SELECT experiment, good, e.p AS p, e.x AS x FROM (SELECT experiment, good, unnest([{rows}]) AS e FROM ranked)),
vals AS (SELECT experiment, p, x, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE NOT good) AS n_bad FROM tried GROUP BY ALL),
sides AS (SELECT experiment, p, count(*) FILTER (WHERE good) AS m_good, count(*) FILTER (WHERE NOT good) AS m_bad,
                 stddev_samp(x) FILTER (WHERE good) AS sd_good, stddev_samp(x) FILTER (WHERE NOT good) AS sd_bad,
                 list(x ORDER BY x) FILTER (WHERE good) AS mus FROM tried GROUP BY ALL),
counted AS (SELECT experiment, count(*) AS n FROM ok GROUP BY 1),
asked AS (SELECT DISTINCT experiment, trial_id FROM {requests}),
drawn AS (SELECT *, {u(1)} * (m_good + {w}) - {w} AS u1, {u(2)} AS u2, {width('m_good', 'sd_good')} AS b_good, {width('m_bad', 'sd_bad')} AS b_bad
          FROM (SELECT experiment, trial_id, p, k, lo, hi, c, coalesce(m_good, 0) AS m_good, coalesce(m_bad, 0) AS m_bad, sd_good, sd_bad, mus
                FROM asked JOIN counted USING (experiment) CROSS JOIN (VALUES {kinds}) AS kinds(p, k, lo, hi)
                     CROSS JOIN (SELECT unnest(range({s.candidates})) AS c) LEFT JOIN sides USING (experiment, p)
                WHERE n >= {s.startup})),
placed AS (SELECT *, CASE WHEN u1 < 0 THEN (lo + hi) / 2 ELSE mus[CAST(floor(u1) AS BIGINT) + 1] END AS mu,
                  (CASE WHEN u1 < 0 THEN hi - lo ELSE b_good END) * {unit!r}::DOUBLE AS sc FROM drawn),
cut AS (SELECT *, {cdf('lo', 'mu', 'sc')} + u2 * ({cdf('hi', 'mu', 'sc')} - {cdf('lo', 'mu', 'sc')}) AS q FROM placed),
cand AS (SELECT *, CASE WHEN k IS NOT NULL THEN CASE WHEN u1 < 0 THEN floor(u2 * k) ELSE mu END
                        ELSE least(hi, greatest(lo, mu + sc * ln(q / (1 - q)))) END AS at_ FROM cut),
scored AS (SELECT experiment, trial_id, p, c, at_,
                  round(ln(({mass('good')} + {w} * any_value({base})) / (any_value(m_good) + {w}))
                        - ln(({mass('bad')} + {w} * any_value({base})) / (any_value(m_bad) + {w})), 9) AS score
           FROM cand LEFT JOIN vals USING (experiment, p) GROUP BY experiment, trial_id, p, c, at_),
best AS (SELECT experiment, trial_id, p, at_ FROM scored QUALIFY row_number() OVER (PARTITION BY experiment, trial_id, p ORDER BY score DESC, c) = 1),
b AS (SELECT experiment, trial_id, {', '.join(f'max(at_) FILTER (WHERE p = {i}) AS x{i}' for i in range(len(space)))} FROM best GROUP BY ALL),
r AS (SELECT experiment, trial_id, {', '.join(sql_sample_space('trial_id', space, seed))} FROM asked)
SELECT r.experiment, r.trial_id, {out}, CASE WHEN b.trial_id IS NULL THEN 'random' ELSE 'tpe' END AS proposed_by
FROM r LEFT JOIN b ON r.experiment = b.experiment AND r.trial_id = b.trial_id
"""
