"""Registered queries for stored tables: lines that do not fit a schema, tables without a key, and statistics of a
table that grows load by load."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep
from ..operators.moments import MomentStore
from ..operators.positions import pair_by_position, with_stored_position
from ..session import scratch_path, shared_dir, unique_name
from ..sources.tables import load_csv_checked
from .registry import LINE_FEATURES, LINE_KEY, LINE_PAIRS, LINE_TARGET, _sql_profile, read

CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def q_csv_rejects(spark, d):
    """A1: all customers as CSV lines, some with a word for a number, a field too many or too few: the lines that
    fit as rows of one table, the others as lines of another, from one read of the file."""
    c = read(spark, d, "customer")
    key = F.col("c_custkey")
    nation = F.when(key % 11 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string"))
    line = (F.when(key % 17 == 0, F.concat_ws(",", key.cast("string"), "c_name"))
             .otherwise(F.concat_ws(",", key.cast("string"), "c_name", nation, F.col("c_acctbal").cast("string"), "c_mktsegment",
                                    F.when(key % 13 == 0, F.lit("more")))))
    path = scratch_path(spark, "faulty_csv")
    c.select(line.alias("line")).write.text(path)
    name = unique_name("checked")
    load = load_csv_checked(spark, path, name, f"{name}_rejects", CUSTOMER, shared_dir(spark, "tables", name), header=False)
    good = spark.table(name).withColumn("rejected_key", F.lit(None).cast("long"))
    bad = spark.table(load.rejects).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(name).schema.fields],
                                           F.split("rejected_line", ",")[0].cast("long").alias("rejected_key"))
    return good.unionByName(bad).withColumn("lines_read", F.lit(load.rows + load.rejected).cast("long"))


def q_positional_pairing(spark, d):
    """G1: features and target of all lines stored as two tables without a key (in several files, by two loads)
    and paired again by stored position; the position is that of the line in the given table."""
    li = read(spark, d, "lineitem")
    lines = with_stored_position(li, "at")
    uid = unique_name("keyless")
    sides = [f"{uid}_x", f"{uid}_y"]
    half = li.count() // 2
    for mode, part in (("overwrite", F.col("at") < half), ("append", F.col("at") >= half)):
        # ranges of positions as files: the order of the files is the order of the lines
        rows = lines.where(part).repartitionByRange(5, "at").sortWithinPartitions("at").persist()
        x, y = prep.features_and_target(rows, [*LINE_KEY, *LINE_FEATURES], LINE_TARGET)
        prep.write_features_target(x, y, *sides, [], mode=mode, x_path=shared_dir(spark, "tables", sides[0]), y_path=shared_dir(spark, "tables", sides[1]))
        rows.unpersist()
    return pair_by_position(*map(spark.table, sides))


def q_profile_appended(spark, d):
    """The lines stored in three loads, profiled after each: only new loads are read, a load that is profiled
    again counts once, and the report of the stored moments is that of the whole table."""
    path = scratch_path(spark, "loads")
    li = read(spark, d, "lineitem").withColumn("load", F.pmod(F.col("l_orderkey"), F.lit(3)).cast("int"))
    store = MomentStore(spark, scratch_path(spark, "moments"), LINE_FEATURES, LINE_TARGET, LINE_PAIRS)
    read_loads = []
    for n in range(3):
        li.where(F.col("load") == n).write.mode("append").partitionBy("load").parquet(path)
        read_loads.append(store.add_new(spark.read.schema(li.schema).parquet(path), "load"))
    store.add(1, spark.read.schema(li.schema).parquet(path).where("load = 1"))
    out = store.report()
    return out.withColumn("value", F.when(F.col("statistic") == "corr", F.round("value", 8)).otherwise(F.round("value", 4))).withColumn(
        "each_load_once", F.lit(read_loads == [[0], [1], [2]]))


STORE_QUERIES = {
    "csv_rejects": q_csv_rejects,
    "positional_pairing": q_positional_pairing,
    "profile_appended": q_profile_appended,
}

_BAD = "(c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0)"
STORE_ORACLES = {
    "csv_rejects": f"""
SELECT CASE WHEN NOT {_BAD} THEN c_custkey END AS c_custkey, CASE WHEN NOT {_BAD} THEN c_name END AS c_name,
       CASE WHEN NOT {_BAD} THEN c_nationkey END AS c_nationkey, CASE WHEN NOT {_BAD} THEN c_acctbal END AS c_acctbal,
       CASE WHEN NOT {_BAD} THEN c_mktsegment END AS c_mktsegment, CASE WHEN {_BAD} THEN c_custkey END AS rejected_key,
       (SELECT count(*) FROM customer) AS lines_read FROM customer""",
    "positional_pairing": (f"SELECT {', '.join(LINE_KEY)}, {', '.join(LINE_FEATURES)}, {LINE_TARGET}, "
                           "row_number() OVER () - 1 AS position FROM lineitem"),
    "profile_appended": f"SELECT *, true AS each_load_once FROM ({_sql_profile()})",
}
