"""Catalog tables: three-part names, reads, writes and the load step.

Storage format defaults to parquet; ``fmt="delta"`` works where Delta is on the
classpath. Writes go through Spark's file commit protocol, so a lost executor only
re-runs its task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..session import storage_options
from .csv import read_csv, read_csv_marked

DEFAULT_CATALOG = "spark_catalog"
WRITE_MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


def _quote(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def table_name(catalog: str | None, schema: str | None, table: str) -> str:
    """Quoted ``catalog.schema.table`` (parts that are None are left out)."""
    return ".".join(_quote(p) for p in (catalog, schema, table) if p)


def ensure_schema(spark: SparkSession, catalog: str | None, schema: str,
                  location: str | None = None) -> None:
    """Create the database if it does not exist (optionally at a shared location)."""
    name = ".".join(_quote(p) for p in (catalog, schema) if p)
    loc = " LOCATION '{}'".format(location.replace("\\", "\\\\").replace("'", "\\'")) if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(df: DataFrame, name: str, *, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None, path: str | None = None) -> str:
    """Save ``df`` as a catalog table; ``path`` makes it an external table there."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, got {mode!r}")
    w = df.write.format(fmt).mode(mode).options(**storage_options(df.sparkSession, fmt))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def table_shape(spark: SparkSession, name: str) -> DataFrame:
    """One row: ``table, rows, columns`` of a stored table.

    Counting the written table (parquet footers) instead of the input plan avoids
    evaluating the input twice (once to count, once to write).
    """
    t = spark.table(name)
    return t.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), F.col("rows"), F.lit(len(t.columns)).alias("columns"))


def next_row_key(spark: SparkSession, name: str, key: str, mode: str) -> int:
    """First row key of a load: above all stored ones when appending to a table, else 0."""
    if mode != "append" or not spark.catalog.tableExists(name) or key not in spark.table(name).columns:
        return 0
    top = spark.table(name).agg(F.max(key).alias("top")).first()["top"]
    return 0 if top is None else int(top) + 1


def with_row_key(df: DataFrame, key: str, first: int = 0) -> DataFrame:
    """Add a row key, unique within the frame and from ``first`` upwards. It is only stable
    once written, so it is made at ingest and never recomputed."""
    return df.withColumn(key, F.monotonically_increasing_id() + F.lit(first).cast("long"))


@dataclass
class LoadResult:
    table: str
    rows: int
    columns: int


def load_csv_table(spark: SparkSession, path: str, table: str, *, header: bool = True,
                   infer_schema: bool = True, sep: str = ",", mode: str = "overwrite",
                   fmt: str = "parquet", schema=None, parse_mode: str = "PERMISSIVE",
                   add_key: str | None = None, table_path: str | None = None) -> LoadResult:
    """CSV -> managed (or external) table, then report its rows and columns.

    ``add_key`` adds a persisted row key, unique across appended loads, for sources that
    have no natural key. Loads into one table run one after another.
    """
    df = read_csv(spark, path, header=header, infer_schema=infer_schema, sep=sep,
                  schema=schema, parse_mode=parse_mode)
    if add_key:
        df = with_row_key(df, add_key, next_row_key(spark, table, add_key, mode))
    write_table(df, table, mode=mode, fmt=fmt, path=table_path)
    row = table_shape(spark, table).first()
    return LoadResult(table, int(row["rows"]), int(row["columns"]))


@dataclass
class CheckedLoad(LoadResult):
    rejects: str
    rejected: int


def _folder_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """An external Parquet table over a folder (made if missing)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def load_csv_checked(spark: SparkSession, path: str, table: str, rejects: str, schema: StructType | str, root: str, *,
                     header: bool = True, sep: str = ",", mode: str = "overwrite", line_col: str = "rejected_line") -> CheckedLoad:
    """CSV -> one table of the lines that fit the schema and one (``rejects``) of the lines that do not.

    The file is read once: lines are written to ``root``, partitioned by whether they fit, and the two tables are
    external tables over the two partitions' folders. Every line is in exactly one of them, so the two counts
    (from the Parquet footers) add up to the lines read. ``mode="append"`` adds to both.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', got {mode!r}")
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    kind = StructType([StructField(f.name, f.dataType, True) for f in kind.fields])
    part = "rejected"
    while part in {f.name.lower() for f in kind.fields}:
        part = "_" + part
    marked = read_csv_marked(spark, path, StructType(kind.fields), header=header, sep=sep, line_col=line_col)
    (marked.withColumn(part, F.col(line_col).isNotNull()).write.mode(mode).partitionBy(part).parquet(root.rstrip("/")))
    sides = ((table, "false", kind), (rejects, "true", StructType([StructField(line_col, StringType(), True)])))
    for name, value, columns in sides:
        if mode == "overwrite" or not spark.catalog.tableExists(name):
            _folder_table(spark, name, f"{root.rstrip('/')}/{part}={value}", columns)
        spark.catalog.refreshTable(name)
    good, bad = (spark.table(name).count() for name, _, _ in sides)
    return CheckedLoad(table, good, len(kind.fields), rejects, bad)
