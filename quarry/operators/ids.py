"""Contiguous 0-based ids (the reference's "line number − 1"), distributed.

No single-partition window: rows are range-partitioned on the order key (with a
hash of the row's values, so that one hot key value still spreads over
partitions and a retried task deals its rows out as before), sorted inside each
partition, numbered locally with ``monotonically_increasing_id``
(partition index in the upper bits, position in the lower 33 bits), and shifted
by the prefix sum of the partition sizes. The numbered table is written
to the shared folder, so both passes see the same layout and a lost
executor cannot move rows between partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import default_parallelism, saved

_LOW33 = (1 << 33) - 1


def contiguous_id(df: DataFrame, order_cols: list[str], id_col: str = "id",
                  group_cols: list[str] | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = rank (0-based, no gaps) of each row in ``order_cols`` order.

    With ``group_cols`` the numbering restarts in every group (rank of a row
    inside its group), still without gathering a group into one task.
    """
    spark = df.sparkSession
    groups = list(group_cols or [])
    n = num_partitions or default_parallelism(spark)
    keys = groups + list(order_cols)
    tie = "_qid_tie"
    # equal rows share the hash, and so a partition: they are interchangeable
    ranged = saved(df.withColumn(tie, F.xxhash64(*df.columns))
                   .repartitionByRange(n, *keys, tie)
                   .sortWithinPartitions(*keys, tie)
                   .withColumn("_qid_mid", F.monotonically_increasing_id()), "contiguous-id")
    pid = F.shiftright("_qid_mid", 33)
    local = F.col("_qid_mid").bitwiseAND(F.lit(_LOW33))
    ranged = ranged.withColumn("_qid_pid", pid).withColumn("_qid_loc", local)

    counts = ranged.groupBy("_qid_pid", *groups).agg(
        F.count(F.lit(1)).alias("_qid_n"), F.min("_qid_loc").alias("_qid_first"))
    before = Window.orderBy("_qid_pid").rowsBetween(Window.unboundedPreceding, -1)
    if groups:
        before = Window.partitionBy(*groups).orderBy("_qid_pid").rowsBetween(
            Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_qid_off", F.coalesce(F.sum("_qid_n").over(before), F.lit(0)))
    if not groups:
        # One row per partition: bounded by the partition count, safe to broadcast.
        offsets = F.broadcast(offsets)
    r, o = ranged.alias("_r"), offsets.alias("_o")
    # null-safe on the group columns: a NULL group is a group too
    cond = [F.col("_r._qid_pid") == F.col("_o._qid_pid")] + [
        F.col(f"_r.{g}").eqNullSafe(F.col(f"_o.{g}")) for g in groups]
    out = r.join(o, cond).select("_r.*", "_o._qid_off", "_o._qid_first")
    ident = F.col("_qid_off") + F.col("_qid_loc") - F.col("_qid_first")
    return out.withColumn(id_col, ident.cast("long")).drop(
        tie, "_qid_mid", "_qid_pid", "_qid_loc", "_qid_off", "_qid_first")


def first_n_with_id(df: DataFrame, order_cols: list[str], n: int, id_col: str = "id") -> DataFrame:
    """First ``n`` rows in order with ids 0..n-1 (top-n feature: the window
    runs over at most ``n`` rows)."""
    top = df.orderBy(*order_cols).limit(n)
    return top.withColumn(id_col, F.row_number().over(Window.orderBy(*order_cols)) - 1)


def dense_index(df: DataFrame, col: str, index_col: str | None = None) -> DataFrame:
    """(value, index): distinct values of ``col`` numbered 0.. in value order
    (INT), e.g. to feed long or string ids to ALS."""
    index_col = index_col or f"{col}_index"
    keys = df.select(col).where(F.col(col).isNotNull()).distinct()
    return contiguous_id(keys, [col], index_col).withColumn(index_col, F.col(index_col).cast("int"))
