"""Counting, distinct, top-k and intersection queries over one column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import is_nonempty


def nonempty(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` holds a value (not NULL, not '')."""
    return df.where(is_nonempty(df, col))


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """Number of rows (a header, if any, is never a row of a DataFrame)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def nonempty_count(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return row_count(nonempty(df.select(col), col), out)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-empty values in code-point order (Spark's binary collation)."""
    return nonempty(df.select(col), col).distinct().orderBy(col)


def _counts(df: DataFrame, col: str, count_col: str) -> DataFrame:
    # Partial aggregation before the shuffle: a hot value costs one row per
    # map task, not one row per occurrence.
    return nonempty(df.select(col), col).groupBy(col).agg(F.count(F.lit(1)).alias(count_col))


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """(value, count) for every non-empty value, ordered by value."""
    return _counts(df, col, count_col).orderBy(col)


def topk_counts(df: DataFrame, col: str, k: int = 10, count_col: str = "count") -> DataFrame:
    """The k most frequent values; ties on count go to the smaller value."""
    return _counts(df, col, count_col).orderBy(F.desc(count_col), F.asc(col)).limit(k)


def intersect_values(a: DataFrame, b: DataFrame, col: str, col_b: str | None = None) -> DataFrame:
    """Distinct non-empty values of ``a.col`` also present in ``b.col_b``, sorted.

    Both sides are de-duplicated first (partial aggregation map-side), so the
    semi join sees each value once per side however skewed the inputs are.
    Empties are removed before matching: a NULL never matches a NULL.
    """
    col_b = col_b or col
    left = nonempty(a.select(col), col).distinct()
    right = nonempty(b.select(F.col(col_b).alias(col)), col).distinct()
    return left.join(right, on=col, how="left_semi").orderBy(col)
