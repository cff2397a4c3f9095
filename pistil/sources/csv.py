"""CSV ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

PARSE_MODES = ("PERMISSIVE", "FAILFAST", "DROPMALFORMED")


def read_csv(spark: SparkSession, path: str, *, header: bool = True,
             infer_schema: bool = True, sep: str = ",",
             schema: StructType | str | None = None,
             parse_mode: str = "PERMISSIVE") -> DataFrame:
    """Read CSV file(s) at ``path``.

    Pass ``schema`` at scale: inference is an extra full pass over the files before
    the first action. Short rows are padded with NULL and long rows cut in the default
    PERMISSIVE mode; FAILFAST raises, DROPMALFORMED removes them. Rows are only parsed
    (and so only dropped or rejected) when columns are read: a bare ``count()`` of
    the file counts every line.
    """
    mode = parse_mode.upper()
    if mode not in PARSE_MODES:
        raise ValueError(f"parse_mode must be one of {PARSE_MODES}, got {parse_mode!r}")
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def read_csv_marked(spark: SparkSession, path: str, schema: StructType | str, *, header: bool = True, sep: str = ",",
                    line_col: str = "rejected_line") -> DataFrame:
    """Every line of the CSV file(s): its columns, and in ``line_col`` the line itself where it does not fit the schema
    (a value of another type, too few or too many fields), else NULL. Blank lines are skipped."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if line_col.lower() in {f.name.lower() for f in kind.fields}:
        raise ValueError(f"column {line_col!r} is in the schema; choose another name for the rejected lines")
    return (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", line_col).schema(StructType([*kind.fields, StructField(line_col, StringType())])).csv(path))


def write_csv(df: DataFrame, path: str, *, header: bool = True, sep: str = ",",
              mode: str = "overwrite") -> str:
    """Write ``df`` as CSV part files under ``path`` (one per partition)."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)
    return path
