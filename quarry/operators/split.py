"""Seeded splits and seeded key samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.exprs import hash_bucket, seeded_order
from quarry.session import saved


def hash_split(df: DataFrame, key_cols: list[str], seed: int,
               train_percent: int = 80, reuse: bool = False) -> tuple[DataFrame, DataFrame]:
    """Seeded train/test split decided by a hash of the key columns.

    A row's side depends only on its key values and the seed: the same on any
    partitioning, any column order and any cluster size (``randomSplit``
    depends on all three). Both sides are narrow filters of one scan. With ``reuse`` the rows are
    written once with their bucket, for the several branches that read them.
    """
    b = hash_bucket(seed, *key_cols)
    if reuse:
        df, b = saved(df.withColumn("_bucket", b), "split"), F.col("_bucket")
        return df.where(b < train_percent).drop("_bucket"), df.where(b >= train_percent).drop("_bucket")
    return df.where(b < train_percent), df.where(b >= train_percent)


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's ``randomSplit`` (the reference's own split), kept for parity."""
    return df.randomSplit(weights, seed)


def split_check(parts: list[DataFrame], key_cols: list[str]) -> DataFrame:
    """One row: rows over all parts, and keys found in more than one part."""
    tagged = None
    for i, p in enumerate(parts):
        t = p.select(*key_cols).withColumn("_part", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t)
    per_key = tagged.groupBy(*key_cols).agg(
        F.count(F.lit(1)).alias("_rows"), F.countDistinct("_part").alias("_parts"))
    return per_key.agg(
        F.sum("_rows").cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_parts") > 1, 1).otherwise(0)), F.lit(0)).cast("long")
        .alias("n_shared_keys"))


def sample_keys(df: DataFrame, key_col: str, k: int, seed: int,
                ordinal_col: str = "ordinal") -> DataFrame:
    """``k`` distinct keys chosen reproducibly by ``seed``, with their draw order.

    Keys are ranked by ``md5('seed:key')`` (ties by key); a top-k, so only
    ``k`` rows per task reach the final single-partition step.
    """
    keys = df.select(key_col).where(F.col(key_col).isNotNull()).distinct()
    order = [seeded_order(seed, key_col), F.col(key_col)]
    top = keys.orderBy(*order).limit(k)
    return top.withColumn(ordinal_col, (F.row_number().over(Window.orderBy(*order)) - 1).cast("int"))
