"""The corpus pipeline: language ID, near-duplicate removal, repeated strings, benchmark
decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept; its
result is written as Parquet to the shared folder and read again as the next one's ``docs``. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pistil.llm.common import collected, discard, table, written
from pistil.llm.decontam import drop_contaminated
from pistil.llm.langid import keep_identified
from pistil.llm.ngram_join import keep_first_of_group
from pistil.llm.packing import pack_stage
from pistil.llm.repeats import drop_repeats


_left: list[str] = []


def _apply(operator, spark: SparkSession, docs: DataFrame, sf_dir: str, last: bool = False) -> DataFrame:
    """One stage. Its ``docs`` is the stored result of the stage before, so the scratch files that
    earlier stages needed for their results go first (those that ``docs`` still reads, if any, stay).
    The last stage's files stay: its result is the caller's to read."""
    in_use = docs.inputFiles()
    for path in list(_left):
        if not any(path.rsplit("/", 1)[-1] in f for f in in_use):
            discard(spark, path)
            _left.remove(path)
    with collected() as paths:
        out = operator(spark, docs, sf_dir)
    if not last:
        _left.extend(paths)
    return out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents without a recognised language go."""
    return _apply(keep_identified, spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each near-duplicate group stays."""
    return _apply(keep_first_of_group, spark, docs, sf_dir)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: strings that an earlier document holds are cut out."""
    return _apply(drop_repeats, spark, docs, sf_dir)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents with benchmark passages go."""
    return _apply(drop_contaminated, spark, docs, sf_dir)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: packed sequences, one row per piece."""
    return _apply(pack_stage, spark, docs, sf_dir, last=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The stages learn models, follow links and cut byte strings: tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
