"""The reference's jobs over its own file formats, one function each.

Each takes file paths and parameters and returns a DataFrame (scalars as a
one-row DataFrame, CSV text as a ``line`` column); the caller collects.

| reference job                      | here                          |
| ---------------------------------- | ----------------------------- |
| count, parks                       | csv_row_count, csv_nonempty_count |
| uniq_parks, uniq_parks_counts      | csv_distinct_values, csv_value_counts |
| frequent_parks_count, intersection | csv_topk_counts, csv_intersection |
| basic_als_recommender              | ratings_als_rmse              |
| global_average(_recommender)       | ratings_global_mean, ratings_global_mean_rmse |
| means_and_interaction              | ratings_interaction           |
| als_with_bias_recommender          | ratings_als_bias_rmse         |
| data_frame                         | basket_file_table             |
| frequent_itemsets, association_rules, interests | basket_file_itemsets, basket_file_rules, basket_file_interest |
| data_preparation, distance2        | basket_file_membership, basket_file_distance |
| init_centroids, first_iter, kmeans | basket_file_init_centroids, basket_file_first_iter, basket_file_kmeans |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import sources as S
from quarry.functions.exprs import csv_line
from quarry.operators import cluster as M
from quarry.operators import itemsets as FI
from quarry.operators import recommend as R
from quarry.operators import tabular
from quarry.operators.ids import first_n_with_id
from quarry.operators.split import hash_split, random_split, sample_keys
from quarry.session import saved
from quarry.sources.dimensions import entity_dimension


def as_lines(df: DataFrame) -> DataFrame:
    """The CSV-line form of a result (the reference's string outputs)."""
    return df.select(csv_line(df).alias("line"))


# ------------------------------------------------------------ header CSV ---

def csv_row_count(spark: SparkSession, path: str) -> DataFrame:
    return tabular.row_count(S.read_header_csv(spark, path))


def csv_nonempty_count(spark: SparkSession, path: str, column: str) -> DataFrame:
    return tabular.nonempty_count(S.read_header_csv(spark, path), column)


def csv_distinct_values(spark: SparkSession, path: str, column: str) -> DataFrame:
    return tabular.distinct_values(S.read_header_csv(spark, path), column)


def csv_value_counts(spark: SparkSession, path: str, column: str) -> DataFrame:
    return tabular.value_counts(S.read_header_csv(spark, path), column)


def csv_topk_counts(spark: SparkSession, path: str, column: str, k: int = 10) -> DataFrame:
    return tabular.topk_counts(S.read_header_csv(spark, path), column, k)


def csv_intersection(spark: SparkSession, path1: str, path2: str, column: str) -> DataFrame:
    return tabular.intersect_values(S.read_header_csv(spark, path1),
                                    S.read_header_csv(spark, path2), column)


# --------------------------------------------------------------- ratings ---

RATING_FIELDS = [("userId", "bigint"), ("movieId", "bigint"), ("rating", "int"), ("timestamp", "bigint")]


def read_ratings(spark: SparkSession, path: str, mode: str = "fail") -> DataFrame:
    return S.read_delimited_records(spark, path, RATING_FIELDS, "::", mode)


def ratings_split(ratings: DataFrame, seed: int, method: str = "hash"):
    """80/20 train/test. ``"hash"`` (default) is independent of partitioning;
    ``"random"`` is Spark's ``randomSplit`` as the reference uses it."""
    r = ratings.select("userId", "movieId", "rating")
    if method == "random":
        train, test = random_split(r, [0.8, 0.2], seed)
        return train, test
    return hash_split(r, ["userId", "movieId"], seed, 80)


def _split_once(spark, path, seed, method):
    """The split of ratings that several branches of a plan read: the file is parsed once."""
    return ratings_split(saved(read_ratings(spark, path), "ratings"), seed, method)


def ratings_global_mean(spark, path, seed, method="hash"):
    train, _ = ratings_split(read_ratings(spark, path), seed, method)
    return R.global_mean(train)


def ratings_global_mean_rmse(spark, path, seed, method="hash"):
    train, test = _split_once(spark, path, seed, method)
    return R.global_mean_rmse(train, test)


def ratings_interaction(spark, path, seed, n=None, method="hash"):
    train, _ = _split_once(spark, path, seed, method)
    return R.bias_interaction(train, "userId", "movieId", "rating", n=n)


def ratings_als_rmse(spark, path, seed, method="hash", **als_params):
    train, test = _split_once(spark, path, seed, method)
    return R.als_rmse(train, test, "userId", "movieId", "rating", seed, **als_params)


def ratings_als_bias_rmse(spark, path, seed, method="hash", **als_params):
    train, test = _split_once(spark, path, seed, method)
    return R.als_bias_rmse(train, test, "userId", "movieId", "rating", seed, **als_params)


# --------------------------------------------------------------- baskets ---

def read_basket_file(spark: SparkSession, path: str) -> DataFrame:
    """(id, plant, items): contiguous 0-based line ids in file order.

    The lines stay where the scan reads them; only the splits' line counts move.
    """
    b = S.read_ragged_baskets(spark, path, key_col="plant", items_col="items", keep_line_order=True)
    return S.with_line_ids(b, "id").select("id", "plant", "items")


def basket_file_table(spark, path, n=None):
    if n is None:
        return read_basket_file(spark, path).orderBy("id")
    b = S.read_ragged_baskets(spark, path, key_col="plant", items_col="items", keep_line_order=True)
    return first_n_with_id(b, S.text.LINE_ORDER, n).select(F.col("id").cast("long"), "plant", "items").orderBy("id")


def _model(spark, path, s, c):
    baskets = S.read_ragged_baskets(spark, path, key_col="plant", items_col="items")
    return baskets, FI.fit_fpgrowth(baskets, "items", s, c)


def basket_file_itemsets(spark, path, n, s, c):
    return FI.frequent_itemsets(_model(spark, path, s, c)[1], n)


def basket_file_rules(spark, path, n, s, c):
    return FI.association_rules(_model(spark, path, s, c)[1], n)


def basket_file_interest(spark, path, n, s, c):
    baskets, model = _model(spark, path, s, c)
    return FI.rule_interest(model, baskets, n)


def basket_file_incidence(spark, path, entities: list[str] | None = None) -> DataFrame:
    """(entity = state, feature = plant) for the states of the dimension."""
    baskets = S.read_ragged_baskets(spark, path, key_col="plant", items_col="items")
    return M.incidence_from_baskets(baskets, "plant", "items", entity_dimension(spark, entities))


def basket_file_membership(spark, path, plant, state, entities=None):
    probe = spark.createDataFrame([(state, plant)], "entity string, feature string")
    return M.membership(probe, basket_file_incidence(spark, path, entities))


def basket_file_distance(spark, path, state1, state2, entities=None):
    pair = spark.createDataFrame([(state1, state2)], "a string, b string")
    return M.pair_distance(pair, basket_file_incidence(spark, path, entities), "a", "b")


def basket_file_init_centroids(spark, k, seed, entities=None):
    return sample_keys(entity_dimension(spark, entities), "entity", k, seed, "cluster")


def basket_file_first_iter(spark, path, k, seed, entities=None):
    dim = entity_dimension(spark, entities).select("entity")
    a = M.nearest_centroid(basket_file_incidence(spark, path, entities), k, seed, entities=dim)
    return M.cluster_members(a)


def basket_file_kmeans(spark, path, k, seed, max_iter=None, entities=None):
    """Cluster members of the converged k-means; a caller's ``max_iter`` shows in ``converged``."""
    dim = entity_dimension(spark, entities).select("entity")
    a = M.kmeans(basket_file_incidence(spark, path, entities), k, seed, max_iter, entities=dim)
    return M.cluster_members(a)
