"""Hash-uniform: a reproducible per-row draw in [0, 1) keyed by row content.

``rand(seed)`` depends on how rows are laid out in partitions, so the same table
read with a different split size gives a different draw. A hash of the row key and
the seed does not: the same key always gets the same number, on any cluster, and the
same expression can be written in DuckDB for checking:

    Spark : conv(substr(md5(concat(KEY, '|SEED')), 1, 8), 16, 10) / 2^32
    DuckDB: ('0x' || substr(md5(KEY || '|SEED'), 1, 8))::bigint / 2^32

The draw is a narrow projection (no shuffle) and stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0
KEY_SEP = "|"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_string(*cols: str | Column) -> Column:
    """Row key as one string: a single column cast to string, or several joined by '|'.

    A NULL part counts as the empty string, so every row gets a draw (a NULL key
    would otherwise make the hash NULL and the row fall out of joins on it). Use
    integer or string columns; doubles print differently across engines.
    """
    if len(cols) == 1 and isinstance(cols[0], (list, tuple)):
        cols = tuple(cols[0])
    if not cols:
        raise ValueError("at least one key column is needed")
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit("")) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws(KEY_SEP, *parts)


def _tag(seed: int, salt: str | None) -> str:
    return f"{KEY_SEP}{salt}{KEY_SEP}{seed}" if salt else f"{KEY_SEP}{seed}"


def hash_hex(key: Column, seed: int, salt: str | None = None) -> Column:
    """md5 hex digest of ``key|[salt|]seed``; sorts rows in a seed-determined order."""
    return F.md5(F.concat(key, F.lit(_tag(seed, salt))))


def hash_uniform(key: Column, seed: int, salt: str | None = None) -> Column:
    """Uniform draw in [0, 1) from the first 32 bits of the md5 of ``key|[salt|]seed``."""
    top32 = F.conv(F.substring(hash_hex(key, seed, salt), 1, 8), 16, 10).cast("double")
    return top32 / F.lit(TWO_POW_32)


def keyed_uniform(key_cols: Sequence[str] | str, seed: int, salt: str | None = None) -> Column:
    cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return hash_uniform(key_string(*cols), seed, salt)


# DuckDB twins, used only by the oracle SQL in __spark_entry__.py and the tests.

def sql_key(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols]
    if len(parts) == 1:
        return parts[0]
    return "concat_ws('|', " + ", ".join(parts) + ")"


def sql_hash_hex(key_sql: str, seed: int, salt: str | None = None) -> str:
    return f"md5({key_sql} || '{_tag(seed, salt)}')"


def sql_hash_uniform(key_sql: str, seed: int, salt: str | None = None) -> str:
    return (f"(('0x' || substr({sql_hash_hex(key_sql, seed, salt)}, 1, 8))::BIGINT"
            f" / 4294967296.0::DOUBLE)")
