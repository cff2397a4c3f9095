"""The registered check queries: one Spark query and, where SQL can express it, one
DuckDB oracle per operator.

Each query reads the driver tables (parquet under ``sf_dir``) or frames Spark derives
from them, over whole tables. Rounding appears only where two engines may differ in
the last bits of a floating-point sum; it is applied identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions.stamps import experiment_path, zone_stamp
from ..functions.vectors import argmax, index_to_label, mean_arrays
from ..operators import prep, profile, split
from ..operators.ensemble import union_train_val
from ..operators.metrics import accuracy
from ..operators.space import LR_SPACE, RF_SPACE, sample_space, sql_sample_space
from ..operators.trials import best_trial, score_to_loss
from ..session import scratch_path, shared_dir, unique_name
from ..sources.csv import read_csv, write_csv
from ..sources.tables import ensure_schema, load_csv_table, table_name, with_row_key, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Role mapping of the driver tables (see SURVEY §7.4).
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_TARGET = "l_returnflag"
LINE_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"),
              ("l_discount", "l_tax"), ("l_extendedprice", "l_tax")]
SEED = 42
RATIOS = (0.7, 0.15, 0.15)
CLASS_LABELS = ["A", "N", "R"]
EXPERIMENT_BASE = "/experiments"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def camel(name: str) -> str:
    """``p_partkey`` -> ``PPartkey``: the inverse of the snake_case rule for such names."""
    return "".join(w[:1].upper() + w[1:] for w in name.split("_"))


# ---------------------------------------------------------------- sources / sinks

def q_csv_scan(spark, d):
    """customer -> '|'-separated CSV -> read back with header and type inference."""
    path = write_csv(read(spark, d, "customer"), scratch_path(spark, "customer_csv"), sep="|")
    return read_csv(spark, path, header=True, infer_schema=True, sep="|")


def _customer_csv(spark, d):
    src = read(spark, d, "customer")
    return write_csv(src, scratch_path(spark, "customer_csv")), src.schema


def q_load_roundtrip(spark, d):
    """The load step (CSV -> table, rows/columns counted) with an explicit schema,
    the at-scale path that skips the inference pass."""
    name = unique_name("customer_raw")
    csv, schema = _customer_csv(spark, d)
    load_csv_table(spark, csv, name, schema=schema,
                   table_path=shared_dir(spark, "tables", name))
    return spark.table(name)


def q_table_scan(spark, d):
    """A4: a table written under a three-part name and read back by that name."""
    db = unique_name("pistil_db")
    ensure_schema(spark, "spark_catalog", db, location=shared_dir(spark, "databases", db))
    full = table_name("spark_catalog", db, "customer")
    write_table(read(spark, d, "customer"), full)
    return spark.table(full)


def q_append_load(spark, d):
    """A0/A5: the load step twice, overwrite then append (rows doubled)."""
    name = unique_name("customer_app")
    csv, schema = _customer_csv(spark, d)
    where = shared_dir(spark, "tables", name)
    load_csv_table(spark, csv, name, mode="overwrite", schema=schema, table_path=where)
    load_csv_table(spark, csv, name, mode="append", schema=schema, table_path=where)
    return spark.table(name)


# ---------------------------------------------------------------- schema operators

def q_drop_column(spark, d):
    """B1: drop one column by name (a missing name would be a no-op)."""
    return prep.drop_column(read(spark, d, "customer"), "c_custkey")


def _camel_frame(df):
    return df.toDF(*[camel(c) for c in df.columns])


def q_snake_case_columns(spark, d):
    """B2: CamelCase names renamed by the snake_case rule (schema only)."""
    return prep.rename_snake_case(_camel_frame(read(spark, d, "part")))


def q_process_table(spark, d):
    """Drop the id-like column, rename, seeded hash order by the key."""
    return prep.process_table(_camel_frame(read(spark, d, "customer")), id_column="CName",
                              key_cols=["CCustkey"], seed=SEED, shuffle="hash")


def q_shuffle_random(spark, d):
    """Seeded random order with rand(seed), as in the original."""
    return prep.shuffle_rows(read(spark, d, "orders"), seed=SEED, method="random")


def q_shuffle_hash(spark, d):
    """1-based position of each key in the seeded hash order."""
    o = read(spark, d, "orders").select("o_orderkey")
    return prep.with_hash_position(o, ["o_orderkey"], seed=SEED)


def q_hash_uniform(spark, d):
    """H1: the per-key hash-uniform draw in [0, 1)."""
    o = read(spark, d, "orders")
    return o.select("o_orderkey", H.keyed_uniform("o_orderkey", SEED).alias("u"))


# ---------------------------------------------------------------- splits

def q_split_random(spark, d):
    """The seeded random split, by Spark's randomSplit and as a tag: each key in exactly one part, and
    each part within four standard errors of its share."""
    o = read(spark, d, "orders").select("o_orderkey")
    parts = split.random_split(o, RATIOS, SEED)
    both = split.tag_random_split(o, RATIOS, SEED).select("o_orderkey", "split", F.lit("tag").alias("how"))
    for name, p in zip(split.SPLIT_NAMES, parts):
        both = both.unionByName(p.select("o_orderkey", F.lit(name).alias("split"), F.lit("parts").alias("how")))
    stored = scratch_path(spark, "random_split")      # one draw for all that follows
    both.write.parquet(stored)
    both = spark.read.parquet(stored)
    shares = dict(zip(split.SPLIT_NAMES, RATIOS))
    want = F.element_at(F.create_map(*[F.lit(x) for k in shares for x in (k, shares[k])]), F.col("split"))
    total = both.groupBy("how").agg(F.count("*").alias("n"))
    fair = (both.groupBy("how", "split").agg(F.count("*").alias("m")).join(total, "how")
                .select("how", (F.abs(F.col("m") / F.col("n") - want) <= 4 * F.sqrt(want * (1 - want) / F.col("n"))).alias("f"))
                .groupBy("how").agg(F.bool_and("f").alias("fair_shares")))
    return (both.groupBy("how", "o_orderkey").agg(F.count("*").alias("times"), F.bool_and(F.col("split").isin(*shares)).alias("known_part"))
                .join(fair, "how"))


def q_split_hash(spark, d):
    """Split name per key from the hash draw."""
    o = read(spark, d, "orders")
    return split.tag_split(o, "o_orderkey", RATIOS, SEED).select("o_orderkey", "split")


def q_split_counts(spark, d):
    """Rows per split and priority in one grouped count."""
    o = split.tag_split(read(spark, d, "orders"), "o_orderkey", RATIOS, SEED)
    return split.split_counts(o, by=["o_orderpriority"])


def q_split_stream(spark, d):
    """The hash split run as a Structured Streaming query (available-now trigger) over
    the orders file, written to a partitioned file sink and read back."""
    from ..streaming.split_stream import write_split_stream
    src = f"{d.rstrip('/')}/orders.parquet"
    schema = spark.read.parquet(src).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .parquet(d).select("o_orderkey"))
    out = scratch_path(spark, "orders_split_stream")
    q = write_split_stream(stream, "o_orderkey", out, ratios=RATIOS, seed=SEED)
    q.awaitTermination()
    return spark.read.parquet(out).select("o_orderkey", "split")


def q_split_stream_counts(spark, d):
    """Split x priority counts kept as a stateful streaming aggregate over orders."""
    from ..streaming.split_stream import stream_split_counts
    src = f"{d.rstrip('/')}/orders.parquet"
    schema = spark.read.parquet(src).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .parquet(d).select("o_orderkey", "o_orderpriority"))
    name = unique_name("split_counts_stream")
    q = stream_split_counts(stream, "o_orderkey", by=["o_orderpriority"], ratios=RATIOS,
                            seed=SEED, table=name)
    q.awaitTermination()
    return spark.table(name)


def q_select_train_val(spark, d):
    """Train and validation rows together by one split filter."""
    tagged = split.tag_split(read(spark, d, "orders"), "o_orderkey", RATIOS, SEED)
    return split.select_splits(tagged, ["train", "val"]).drop("split")


def q_union_train_val(spark, d):
    """the train frame and the validation frame, one after the other."""
    train, val, _ = split.hash_split(read(spark, d, "orders"), "o_orderkey", RATIOS, SEED)
    return union_train_val(train, val)


# ---------------------------------------------------------------- features / target

def _xy(spark, d):
    return prep.features_and_target(read(spark, d, "lineitem"), LINE_FEATURES, LINE_TARGET,
                                    LINE_KEY)


def q_features_x(spark, d):
    """Key + feature columns."""
    return _xy(spark, d)[0]


def q_target_y(spark, d):
    """Key + the target column."""
    return _xy(spark, d)[1]


def q_join_features_target(spark, d):
    """G1: features and target re-paired on the persisted row key (the four-part key of the table
    does not identify its rows at every size)."""
    path = scratch_path(spark, "keyed")
    with_row_key(read(spark, d, "lineitem"), "row_key").write.parquet(path)
    x, y = prep.features_and_target(spark.read.parquet(path), LINE_FEATURES, LINE_TARGET, ["row_key", *LINE_KEY])
    return prep.join_features_target(x, y, "row_key").select(*LINE_KEY, *LINE_FEATURES, LINE_TARGET)


# ---------------------------------------------------------------- profile

def q_row_count(spark, d):
    """Rows and columns of a table."""
    return profile.row_count(read(spark, d, "lineitem"))


def q_head5(spark, d):
    """First five rows by key (distributed top-k)."""
    return profile.head(read(spark, d, "orders"), 5, ["o_orderkey"])


def q_describe_numeric(spark, d):
    """count/mean/stddev/min/max per column, typed long form."""
    out = profile.describe(read(spark, d, "lineitem"), LINE_FEATURES)
    return out.withColumn("value", F.round("value", 4))


def q_describe_strings(spark, d):
    """Spark's own ``describe`` (string values, one row per statistic), read back as numbers in long
    form."""
    out = profile.describe_strings(read(spark, d, "lineitem"), LINE_FEATURES)
    stat = F.col(out.columns[0]).alias("statistic")
    return out.select(stat, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.round(F.col(c).cast("double"), 4).alias("value"))
                                                for c in LINE_FEATURES])).alias("v")).select("statistic", "v.column", "v.value")


def q_class_counts(spark, d):
    """Rows per class."""
    return profile.class_counts(read(spark, d, "lineitem"), LINE_TARGET)


def q_class_means(spark, d):
    """Mean of each feature per class."""
    out = profile.class_means(read(spark, d, "lineitem"), LINE_TARGET, LINE_FEATURES)
    return out.select(LINE_TARGET, *[F.round(f"{c}_mean", 4).alias(f"{c}_mean")
                                     for c in LINE_FEATURES])


def q_event_class_means(spark, d):
    """E3/E4 on another table: count and mean value per event type."""
    out = profile.class_summary(read(spark, d, "events"), "event_type", ["value"])
    return out.select("event_type", "count", F.round("value_mean", 6).alias("value_mean"))


def q_pearson_corr(spark, d):
    """E5: Pearson correlation per column pair (NULL on a constant column)."""
    out = profile.correlations(read(spark, d, "lineitem"), LINE_PAIRS)
    return out.withColumn("corr", F.round("corr", 8))


def q_profile_report(spark, d):
    """Every exploration statistic, whole table and per class, one scan."""
    out = profile.profile_report(read(spark, d, "lineitem"), LINE_FEATURES, LINE_TARGET,
                                 LINE_PAIRS)
    return out.withColumn("value", F.when(F.col("statistic") == "corr", F.round("value", 8))
                          .otherwise(F.round("value", 4)))


# ---------------------------------------------------------------- metrics / naming / trials

def q_accuracy(spark, d):
    """Share of rows whose prediction equals the label."""
    lab = read(spark, d, "labels").select(
        F.col("quality").alias("label"), (F.lit(1) - F.col("toxic")).alias("prediction"))
    return accuracy(lab)


def q_zone_stamp(spark, d):
    """H7: a UTC timestamp rendered in the experiment time zone."""
    e = read(spark, d, "events")
    return e.select("event_id", zone_stamp("ts").alias("stamp"))


def q_experiment_path(spark, d):
    """H8: experiment path from base, lower-cased name and stamp."""
    e = read(spark, d, "events")
    return e.select("event_id", experiment_path(EXPERIMENT_BASE, F.col("event_type"),
                                                zone_stamp("ts")).alias("experiment_path"))


def _event_trials(spark, d):
    e = read(spark, d, "events")
    return e.select(F.col("event_type").alias("experiment"),
                    F.col("event_id").alias("trial_id"),
                    F.col("value").alias("val_score"),
                    score_to_loss("value", maximize=True).alias("val_loss"),
                    F.when(F.col("value").isNull(), F.lit("failed"))
                     .otherwise(F.lit("ok")).alias("status"))


def q_trial_loss(spark, d):
    """H3: loss from score (negated when maximising)."""
    return _event_trials(spark, d).select("trial_id", "val_score", "val_loss")


def q_best_trial(spark, d):
    """D3: lowest-loss successful trial per experiment, smallest id on ties."""
    return best_trial(_event_trials(spark, d)).select(
        "experiment", "trial_id", "val_score", "val_loss")


def q_sample_search_space(spark, d):
    """Both search spaces drawn for every trial id."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("trial_id"))
    out = sample_space(sample_space(o, RF_SPACE, SEED), LR_SPACE, SEED)
    return out.withColumn("C", F.round("C", 9))


# ---------------------------------------------------------------- probability arrays

def _draw_cols(key) -> list:
    """Six hash draws per row (three classes x two pretend models), one projection."""
    return [H.hash_uniform(key, SEED, salt=f"{m}{j}").alias(f"_u_{m}{j}")
            for m in ("a", "b") for j in range(3)]


def _probs(model: str) -> F.Column:
    """A 3-class probability vector from the model's three draws."""
    us = [F.col(f"_u_{model}{j}") for j in range(3)]
    total = (us[0] + us[1]) + us[2]
    return F.array(*[u / total for u in us])


def _voted(spark, d):
    li = read(spark, d, "lineitem").select(*LINE_KEY)
    draws = li.select(*LINE_KEY, *_draw_cols(H.key_string(*LINE_KEY)))
    probs = draws.select(*LINE_KEY, _probs("a").alias("pa"), _probs("b").alias("pb"))
    return probs.select(*LINE_KEY, mean_arrays("pa", "pb", size=3).alias("p"))


def q_soft_vote(spark, d):
    """Element-wise mean of two probability vectors."""
    # no rounding: both engines do the same IEEE operations on exact k/2^32 draws
    return _voted(spark, d).select(*LINE_KEY, *[F.col("p")[j].alias(f"p{j}") for j in range(3)])


def q_argmax_class(spark, d):
    """H5: index of the largest averaged probability (first on ties)."""
    return _voted(spark, d).select(*LINE_KEY, argmax("p").alias("class_index"))


def q_index_to_label(spark, d):
    """H6: class index mapped to its label."""
    return _voted(spark, d).select(
        *LINE_KEY, index_to_label(argmax("p"), CLASS_LABELS).alias("label"))


QUERIES: dict[str, Query] = {
    "csv_scan": q_csv_scan,
    "load_roundtrip": q_load_roundtrip,
    "table_scan": q_table_scan,
    "append_load": q_append_load,
    "drop_column": q_drop_column,
    "snake_case_columns": q_snake_case_columns,
    "process_table": q_process_table,
    "shuffle_random": q_shuffle_random,
    "shuffle_hash": q_shuffle_hash,
    "hash_uniform": q_hash_uniform,
    "split_random": q_split_random,
    "split_hash": q_split_hash,
    "split_counts": q_split_counts,
    "split_stream": q_split_stream,
    "split_stream_counts": q_split_stream_counts,
    "union_train_val": q_union_train_val,
    "select_train_val": q_select_train_val,
    "features_x": q_features_x,
    "target_y": q_target_y,
    "join_features_target": q_join_features_target,
    "row_count": q_row_count,
    "head5": q_head5,
    "describe_numeric": q_describe_numeric,
    "describe_strings": q_describe_strings,
    "class_counts": q_class_counts,
    "class_means": q_class_means,
    "event_class_means": q_event_class_means,
    "pearson_corr": q_pearson_corr,
    "profile_report": q_profile_report,
    "accuracy": q_accuracy,
    "zone_stamp": q_zone_stamp,
    "experiment_path": q_experiment_path,
    "trial_loss": q_trial_loss,
    "best_trial": q_best_trial,
    "sample_search_space": q_sample_search_space,
    "soft_vote": q_soft_vote,
    "argmax_class": q_argmax_class,
    "index_to_label": q_index_to_label,
}


# ================================================================ DuckDB oracles

def sql_split(key_sql: str) -> str:
    lo, hi = split.split_thresholds(RATIOS)
    u = H.sql_hash_uniform(key_sql, SEED)
    return (f"CASE WHEN {u} < {lo!r}::DOUBLE THEN 'train' "
            f"WHEN {u} < {hi!r}::DOUBLE THEN 'val' ELSE 'test' END")


def _sql_stat(stat: str, c: str) -> str:
    return {
        "count": f"CAST(count({c}) AS DOUBLE)",
        "mean": f"avg(CAST({c} AS DOUBLE))",
        "stddev": f"stddev_samp(CAST({c} AS DOUBLE))",
        "min": f"CAST(min({c}) AS DOUBLE)",
        "max": f"CAST(max({c}) AS DOUBLE)",
    }[stat]


def _sql_corr(x: str, y: str) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    den = (f"(stddev_pop(CAST({x} AS DOUBLE)) FILTER (WHERE {both}) * "
           f"stddev_pop(CAST({y} AS DOUBLE)) FILTER (WHERE {both}))")
    return (f"CASE WHEN {den} = 0 THEN NULL ELSE "
            f"covar_pop(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) / {den} END")


def _sql_describe() -> str:
    parts = []
    for c in LINE_FEATURES:
        for s in profile.DESCRIBE_STATS:
            parts.append(f"SELECT '{s}' AS statistic, '{c}' AS \"column\", "
                         f"round({_sql_stat(s, c)}, 4) + 0.0 AS value FROM lineitem")
    return "\nUNION ALL ".join(parts)


def _sql_profile() -> str:
    def block(scope: str, cls: str, group: str) -> list[str]:
        out = [f"SELECT '{scope}' AS scope, {cls} AS class, '*' AS \"column\", "
               f"'rows' AS statistic, round(CAST(count(*) AS DOUBLE), 4) + 0.0 AS value "
               f"FROM lineitem {group}"]
        for c in LINE_FEATURES:
            for s in profile.DESCRIBE_STATS:
                out.append(f"SELECT '{scope}', {cls}, '{c}', '{s}', round({_sql_stat(s, c)}, 4) + 0.0"
                           f" FROM lineitem {group}")
        for x, y in LINE_PAIRS:
            out.append(f"SELECT '{scope}', {cls}, '{x},{y}', 'corr', round({_sql_corr(x, y)}, 8) + 0.0"
                       f" FROM lineitem {group}")
        return out
    parts = block("all", "CAST(NULL AS VARCHAR)", "") + block(
        "class", f"CAST({LINE_TARGET} AS VARCHAR)", f"GROUP BY {LINE_TARGET}")
    return "\nUNION ALL ".join(parts)


def _sql_probs(model: str) -> tuple[str, str, str]:
    key = H.sql_key(*LINE_KEY)
    us = [H.sql_hash_uniform(key, SEED, salt=f"{model}{j}") for j in range(3)]
    total = f"(({us[0]} + {us[1]}) + {us[2]})"
    return tuple(f"({u} / {total})" for u in us)


def _sql_voted() -> str:
    a, b = _sql_probs("a"), _sql_probs("b")
    keys = ", ".join(LINE_KEY)
    ps = ", ".join(f"(({a[j]} + {b[j]}) / 2.0::DOUBLE) AS p{j}" for j in range(3))
    return f"(SELECT {keys}, {ps} FROM lineitem)"


def _sql_argmax() -> str:
    # first index wins ties: compare in order with strict >
    return ("CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END")


def _sql_trials() -> str:
    return ("(SELECT event_type AS experiment, event_id AS trial_id, value AS val_score, "
            "-value AS val_loss, CASE WHEN value IS NULL THEN 'failed' ELSE 'ok' END AS status "
            "FROM events)")


def _sql_zone(ts: str) -> str:
    return f"strftime(timezone('Europe/Rome', timezone('UTC', {ts})), '%Y%m%d_%H%M%S')"


_KEYS = ", ".join(LINE_KEY)
_FEATS = ", ".join(LINE_FEATURES)
_ORDER_U = H.sql_hash_uniform(H.sql_key("o_orderkey"), SEED)

ORACLES: dict[str, str] = {
    # type inference reads the (small) integer ids as 32-bit ints
    "csv_scan": ("SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, "
                 "c_acctbal, c_mktsegment FROM customer"),
    "load_roundtrip": "SELECT * FROM customer",
    "table_scan": "SELECT * FROM customer",
    "append_load": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "drop_column": "SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "snake_case_columns": "SELECT * FROM part",
    "process_table": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "shuffle_random": "SELECT * FROM orders",
    "shuffle_hash": (
        "SELECT o_orderkey, row_number() OVER (ORDER BY "
        f"{H.sql_hash_hex(H.sql_key('o_orderkey'), SEED)}, o_orderkey) AS position FROM orders"),
    "hash_uniform": f"SELECT o_orderkey, {_ORDER_U} AS u FROM orders",
    "split_hash": f"SELECT o_orderkey, {sql_split(H.sql_key('o_orderkey'))} AS split FROM orders",
    "split_counts": (
        f"SELECT {sql_split(H.sql_key('o_orderkey'))} AS split, o_orderpriority, "
        "count(*) AS rows FROM orders GROUP BY 1, 2"),
    "split_stream": f"SELECT o_orderkey, {sql_split(H.sql_key('o_orderkey'))} AS split FROM orders",
    "split_stream_counts": (
        f"SELECT {sql_split(H.sql_key('o_orderkey'))} AS split, o_orderpriority, "
        "count(*) AS rows FROM orders GROUP BY 1, 2"),
    "union_train_val": (
        f"SELECT * FROM orders WHERE {_ORDER_U} < {split.split_thresholds(RATIOS)[1]!r}::DOUBLE"),
    "features_x": f"SELECT {_KEYS}, {_FEATS} FROM lineitem",
    "target_y": f"SELECT {_KEYS}, {LINE_TARGET} FROM lineitem",
    "join_features_target": f"SELECT {_KEYS}, {_FEATS}, {LINE_TARGET} FROM lineitem",
    "row_count": "SELECT count(*) AS rows, 11 AS columns FROM lineitem",
    "head5": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "describe_numeric": _sql_describe(),
    "describe_strings": _sql_describe(),
    "split_random": ("SELECT how, o_orderkey, CAST(1 AS BIGINT) AS times, true AS known_part, true AS fair_shares "
                     "FROM orders, (VALUES ('tag'), ('parts')) h(how)"),
    "select_train_val": (
        f"SELECT * FROM orders WHERE {_ORDER_U} < {split.split_thresholds(RATIOS)[1]!r}::DOUBLE"),
    "class_counts": f"SELECT {LINE_TARGET}, count(*) AS count FROM lineitem GROUP BY 1",
    "class_means": (
        f"SELECT {LINE_TARGET}, "
        + ", ".join(f"round(avg({c}), 4) AS {c}_mean" for c in LINE_FEATURES)
        + f" FROM lineitem GROUP BY 1"),
    "event_class_means": (
        "SELECT event_type, count(*) AS count, round(avg(value), 6) AS value_mean "
        "FROM events GROUP BY 1"),
    "pearson_corr": "\nUNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round({_sql_corr(x, y)}, 8) AS corr FROM lineitem"
        for x, y in LINE_PAIRS),
    "profile_report": _sql_profile(),
    "accuracy": (
        "SELECT avg(CAST((quality = 1 - toxic) AS DOUBLE)) AS accuracy, count(*) AS rows "
        "FROM labels"),
    "zone_stamp": f"SELECT event_id, {_sql_zone('ts')} AS stamp FROM events",
    "experiment_path": (
        f"SELECT event_id, concat_ws('/', '{EXPERIMENT_BASE}', 'iris_' || lower(event_type) "
        f"|| '_' || {_sql_zone('ts')}) AS experiment_path FROM events"),
    "trial_loss": f"SELECT trial_id, val_score, val_loss FROM {_sql_trials()}",
    "best_trial": (
        f"SELECT experiment, trial_id, val_score, val_loss FROM {_sql_trials()} "
        "WHERE status = 'ok' AND val_loss IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY val_loss, trial_id) = 1"),
    "sample_search_space": (
        "SELECT trial_id, " + ", ".join(
            s if not s.endswith(" AS C") else f"round({s[:-5]}, 9) AS C"
            for s in sql_sample_space("trial_id", RF_SPACE, SEED)
            + sql_sample_space("trial_id", LR_SPACE, SEED))
        + " FROM (SELECT o_orderkey AS trial_id FROM orders)"),
    "soft_vote": f"SELECT {_KEYS}, p0, p1, p2 FROM {_sql_voted()}",
    "argmax_class": f"SELECT {_KEYS}, {_sql_argmax()} AS class_index FROM {_sql_voted()}",
    "index_to_label": (
        f"SELECT {_KEYS}, (['A', 'N', 'R'])[{_sql_argmax()} + 1] AS label FROM {_sql_voted()}"),
}
