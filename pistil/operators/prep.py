"""Table preparation: drop the id, rename columns, shuffle, features/target.

All of these are projections except the shuffle (a sort) and the key join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import TWO_POW_32, hash_hex, key_string
from ..functions.naming import snake_case, snake_case_all
from ..session import partitions_for, storage_options


def _case_sensitive(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"


def _keys(key_cols: Sequence[str] | str | None) -> list[str]:
    if key_cols is None:
        return []
    return [key_cols] if isinstance(key_cols, str) else list(key_cols)


def has_column(df: DataFrame, name: str) -> bool:
    if _case_sensitive(df):
        return name in df.columns
    return name.lower() in {c.lower() for c in df.columns}


def drop_column(df: DataFrame, name: str, missing: str = "ignore") -> DataFrame:
    """Drop one column; a missing name is a no-op unless ``missing="error"``.

    Name matching follows ``spark.sql.caseSensitive`` (off by default, so ``id``
    drops ``Id``).
    """
    if missing not in ("ignore", "error"):
        raise ValueError("missing must be 'ignore' or 'error'")
    if missing == "error" and not has_column(df, name):
        raise ValueError(f"column {name!r} not found in {df.columns}")
    return df.drop(name)


def rename_snake_case(df: DataFrame) -> DataFrame:
    """Rename every column with the snake_case rule (schema-only, no data pass)."""
    return df.toDF(*snake_case_all(df.columns, _case_sensitive(df)))


def hash_ordered(df: DataFrame, key_cols: Sequence[str], seed: int = 42,
                 partitions: int | None = None, first: Sequence[str] = (),
                 skew_safe: bool = False, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Rows in seeded hash order: partition ``i`` holds hash range [i/n, (i+1)/n),
    sorted inside by ``(*first, md5 hex, key)``.

    A global ``orderBy`` would first run a sampling job over the whole input to
    find range bounds. The hash draw is uniform, so the bounds are known: each row's
    partition is ``floor(u * n)`` and one exchange (no sampling pass) yields the
    same global order when partitions are read in sequence. Partitions are evenly
    filled for unique keys.

    Copies of one key share one hash, so a key repeated across a large share of the
    rows would fill one partition. ``skew_safe=True`` is for such data: a sampled
    range sort with a per-row tiebreaker, which lets Spark cut a run of equal keys
    across partitions (the tiebreaker only orders copies of the same key, whose
    relative order is arbitrary anyway). ``partitions`` holds for both.

    ``part=(k, n)`` gives the k-th of n runs of the partitions, at their places among all of them (the
    others are empty), so that a large table can be written run by run with a smaller exchange each.
    Not with ``skew_safe`` and not before Spark 4.1 (see ``can_order_in_parts``).
    """
    keys = list(key_cols)
    n = int(partitions or partitions_for(df))
    hexcol = hash_hex(key_string(*keys), seed)
    tagged = df.withColumn("_ord_h", hexcol)
    if part[1] > 1 and not can_order_in_parts(df, skew_safe):
        raise ValueError("only the hash placement can be made in parts")
    if skew_safe:
        order = [*first, "_ord_h", *keys, "_ord_t"]
        return (tagged.withColumn("_ord_t", F.monotonically_increasing_id())
                      .repartitionByRange(n, *order).sortWithinPartitions(*order)
                      .drop("_ord_h", "_ord_t"))
    if not hasattr(tagged, "repartitionById"):  # Spark < 4.1: sampled range partitioning
        return tagged.orderBy(*first, "_ord_h", *keys).drop("_ord_h")
    top = F.conv(F.substring(hexcol, 1, 8), 16, 10).cast("double")
    pid = F.floor(top / F.lit(TWO_POW_32) * F.lit(n)).cast("int")
    placed = df if part[1] == 1 else df.where(F.floor(pid * F.lit(part[1]) / F.lit(n)) == part[0])
    # the hash is made again behind the exchange: it would be a third of the bytes sent
    return (placed.repartitionById(n, pid).withColumn("_ord_h", hexcol)
                  .sortWithinPartitions(*first, "_ord_h", *keys)
                  .drop("_ord_h"))


def can_order_in_parts(df: DataFrame, skew_safe: bool = False) -> bool:
    return hasattr(df, "repartitionById") and not skew_safe


def shuffle_rows(df: DataFrame, key_cols: Sequence[str] | str | None = None, seed: int = 42,
                 method: str = "hash", partitions: int | None = None,
                 skew_safe: bool = False) -> DataFrame:
    """Seeded random row order.

    ``method="hash"`` orders by md5(key|seed) then key: the same order for the same
    keys however the input is partitioned (see ``hash_ordered``: one exchange, no
    sampling pass). ``method="random"`` is ``orderBy(rand(seed))``, a sampled
    range-partition sort whose order changes when the input partitioning changes.
    """
    if method == "random":
        return df.orderBy(F.rand(seed))
    if method != "hash":
        raise ValueError("method must be 'hash' or 'random'")
    keys = _keys(key_cols)
    if not keys:
        raise ValueError("hash shuffle needs key_cols")
    return hash_ordered(df, keys, seed, partitions, skew_safe=skew_safe)


def with_hash_position(df: DataFrame, key_cols: Sequence[str] | str, seed: int = 42,
                       buckets: int | None = None, col: str = "position") -> DataFrame:
    """Add the 1-based position of each row in the seeded hash order.

    A plain ``row_number() over (order by ...)`` runs in a single task. Here the
    first 32 hash bits already give an even split into ``buckets`` ordered ranges,
    so rows are numbered inside their bucket (one window partition per bucket, in
    parallel) and shifted by the row count of all lower buckets. The offsets table
    has one row per bucket, a size fixed by ``buckets``, so broadcasting it is safe.
    Keys are expected to identify rows (the pipeline adds one at ingest when the
    source has none); copies of a key get consecutive positions in an arbitrary
    order and share one bucket.
    """
    keys = _keys(key_cols)
    nb = int(buckets or partitions_for(df))
    h = hash_hex(key_string(*keys), seed)
    top = F.conv(F.substring(F.col("_pos_h"), 1, 8), 16, 10).cast("double")
    base = (df.withColumn("_pos_h", h)
              .withColumn("_pos_b", F.floor(top / F.lit(TWO_POW_32) * F.lit(nb)).cast("int")))
    counts = base.groupBy("_pos_b").agg(F.count(F.lit(1)).alias("_pos_n"))
    before = Window.orderBy("_pos_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pos_b", F.coalesce(F.sum("_pos_n").over(before), F.lit(0)).alias("_pos_off"))
    within = Window.partitionBy("_pos_b").orderBy("_pos_h", *keys)
    # one partition per bucket (hash-dealt): the window is satisfied with this exchange, and
    # its size does not depend on spark.sql.shuffle.partitions
    return (base.repartition(nb, "_pos_b").join(F.broadcast(offsets), "_pos_b")
                .withColumn(col, F.col("_pos_off") + F.row_number().over(within))
                .drop("_pos_h", "_pos_b", "_pos_off"))


def check_id_is_no_key(id_column: str | None, key_cols: Sequence[str] | str | None) -> None:
    """The id column is dropped, so it cannot be a key too."""
    if id_column and id_column.lower() in {k.lower() for k in _keys(key_cols)}:
        raise ValueError(f"id column {id_column!r} is also a key column; keep it as the "
                         "key with id_column=None, or choose other key columns")


def process_table(df: DataFrame, id_column: str | None = "id",
                  key_cols: Sequence[str] | str | None = None, seed: int = 42,
                  shuffle: str | None = "hash", missing: str = "ignore") -> DataFrame:
    """Drop the id column, snake_case all names, then shuffle rows.

    ``key_cols`` are given by their names before renaming and are kept; the hash
    shuffle orders by them. The drop happens before the rename, by the raw name.
    """
    out = drop_column(df, id_column, missing) if id_column else df
    out = rename_snake_case(out)
    keys = [snake_case(k) for k in _keys(key_cols)]
    if shuffle is None:
        return out
    return shuffle_rows(out, keys or None, seed, method=shuffle)


def features_and_target(df: DataFrame, feature_cols: Sequence[str], target_col: str,
                        key_cols: Sequence[str] | str | None = None
                        ) -> tuple[DataFrame, DataFrame]:
    """Split a table into a features frame and a target frame, both carrying the key.

    Two projections of the same input; with a key the two can be re-paired by a join
    (positional pairing does not exist on distributed frames).
    """
    keys = _keys(key_cols)
    x = df.select(*keys, *feature_cols)
    y = df.select(*keys, target_col)
    return x, y


def key_faults(df: DataFrame, key_cols: Sequence[str] | str) -> DataFrame:
    """Keys that do not identify a row: those that repeat or hold a NULL, with their row count
    (column ``rows``)."""
    keys = _keys(key_cols)
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > 1) | null)


def join_features_target(x: DataFrame, y: DataFrame, key_cols: Sequence[str] | str,
                         check_counts: bool = False) -> DataFrame:
    """Re-pair features with targets on the key (inner join).

    The key must identify rows: the pipeline's persisted row key does; with keys of the
    data's own, repeated ones multiply and NULL ones pair with nothing. ``check_counts``
    finds such keys (one grouped count per side) and keys without a partner, and raises.
    When both sides are stored bucketed and sorted by the key (see
    ``write_features_target``), the sort-merge join needs no exchange. Other columns that
    both sides carry are taken from ``x``.
    """
    keys = _keys(key_cols)
    if not keys:
        raise ValueError("join_features_target needs key_cols")
    y = y.drop(*[c for c in y.columns if c in x.columns and c not in keys])
    joined = x.join(y, keys, "inner")
    if check_counts:
        for side, frame in (("features", x), ("target", y)):
            bad = key_faults(frame, keys).limit(3).collect()
            if bad:
                raise ValueError(f"{side} keys do not pair up (repeated or NULL): {[r.asDict() for r in bad]}")
        nx, ny, nj = x.count(), y.count(), joined.count()
        if not nx == ny == nj:
            raise ValueError(f"features/target do not pair up: x={nx}, y={ny}, joined={nj}")
    return joined


def write_features_target(x: DataFrame, y: DataFrame, x_table: str, y_table: str,
                          key_cols: Sequence[str] | str, buckets: int | None = None,
                          mode: str = "overwrite", fmt: str = "parquet",
                          x_path: str | None = None, y_path: str | None = None) -> None:
    """Write the ``_x``/``_y`` pair; with ``buckets`` both are bucketed and sorted by
    the key so a later join on it is shuffle-free."""
    keys = _keys(key_cols)
    for frame, name, path in ((x, x_table, x_path), (y, y_table, y_path)):
        w = frame.write.format(fmt).mode(mode)
        w = w.options(**storage_options(frame.sparkSession, fmt))
        if buckets and keys:
            w = w.bucketBy(buckets, *keys).sortBy(*keys)
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
