"""Rating predictors: global mean, user/item bias, ALS, ALS on the bias residual.

Means are grouped aggregates joined back on their key (AQE turns the join into
a broadcast when the measured means table is small, and splits a hot
user/item partition otherwise). The global mean is a scalar subquery, so no
value travels through the driver and Catalyst sees one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.exprs import rmse_expr
from quarry.operators.als_steps import RatingBlocks, agree, iterated, scored, stepped
from quarry.operators.ids import dense_index
from quarry.session import saved


def global_mean(train: DataFrame, rating: str = "rating", out: str = "global_mean") -> DataFrame:
    return train.agg(F.avg(F.col(rating)).alias(out))


def group_means(train: DataFrame, key: str, rating: str = "rating",
                out: str = "mean") -> DataFrame:
    return train.groupBy(key).agg(F.avg(F.col(rating)).alias(out))


def with_bias_terms(df: DataFrame, train: DataFrame, user: str, item: str,
                    rating: str = "rating") -> DataFrame:
    """``df`` with training user mean, item mean and global mean.

    Inner joins: rows whose user or item has no training rating are dropped,
    as in the reference.
    """
    return _join_means(df, _means(train, user, item, rating), user, item)


def _means(train: DataFrame, user: str, item: str, rating: str):
    return (group_means(train, user, rating, "user_mean"), group_means(train, item, rating, "item_mean"),
            train.agg(F.avg(F.col(rating)).alias("global_mean")))


def _join_means(df: DataFrame, means, user: str, item: str) -> DataFrame:
    um, im, gm = means
    return df.join(im, item).join(um, user).withColumn("global_mean", gm.scalar())


def bias_interaction(train: DataFrame, user: str = "userId", item: str = "itemId",
                     rating: str = "rating", n: int | None = None,
                     ordered: bool = True) -> DataFrame:
    """Per training triple: user_mean, item_mean and the interaction
    ``rating − (user_mean + item_mean − global_mean)``; ordered by (user, item),
    the first ``n`` rows if ``n`` is given."""
    return _interaction(with_bias_terms(train, train, user, item, rating), user, item, rating, n, ordered)


def _interaction(t: DataFrame, user: str, item: str, rating: str, n: int | None = None,
                 ordered: bool = True) -> DataFrame:
    inter = F.col(rating) - (F.col("user_mean") + F.col("item_mean") - F.col("global_mean"))
    out = t.select(user, item, F.col(rating).cast("double").alias(rating), "user_mean",
                   "item_mean", inter.alias("user_item_interaction"))
    if ordered or n is not None:
        out = out.orderBy(user, item)
    return out.limit(n) if n is not None else out


def rmse(df: DataFrame, prediction: str, label: str, out: str = "rmse") -> DataFrame:
    return df.agg(rmse_expr(prediction, label).alias(out))


def global_mean_rmse(train: DataFrame, test: DataFrame, rating: str = "rating") -> DataFrame:
    """RMSE of predicting the training mean for every test row (all rows count)."""
    gm = train.agg(F.avg(F.col(rating))).scalar()
    return rmse(test.withColumn("_pred", gm), "_pred", rating)


def bias_predictions(train: DataFrame, test: DataFrame, user: str, item: str,
                     rating: str = "rating") -> DataFrame:
    t = with_bias_terms(test, train, user, item, rating)
    return t.withColumn("prediction",
                        F.col("user_mean") + F.col("item_mean") - F.col("global_mean"))


def bias_rmse(train: DataFrame, test: DataFrame, user: str = "userId", item: str = "itemId",
              rating: str = "rating") -> DataFrame:
    """RMSE of the bias model (the ALS+bias model with a zero residual)."""
    return rmse(bias_predictions(train, test, user, item, rating), "prediction", rating)


# ------------------------------------------------------------------- ALS ---

ALS_DEFAULTS = {"maxIter": 5, "rank": 70, "regParam": 0.01}


# Blocks of user and item factors of Spark's fit. Spark starts from user factors drawn block by block,
# so the model depends on the number of user blocks and never on the cluster. Every item block
# gets nearly all users' factors in each iteration, most of what a fit shuffles: hence fewer of them, which
# changes the order of sums only. Pass ``numUserBlocks`` / ``numItemBlocks`` for more parallelism.
ALS_BLOCKS, ALS_ITEM_BLOCKS = 10, 5


def _als(user: str, item: str, rating_col: str, seed: int, **params):
    from pyspark.ml.recommendation import ALS
    p = {**ALS_DEFAULTS, "numUserBlocks": ALS_BLOCKS, "numItemBlocks": ALS_ITEM_BLOCKS, **params}
    return ALS(userCol=user, itemCol=item, ratingCol=rating_col, coldStartStrategy="drop",
               seed=seed, **p)


_INT_TYPES = (T.IntegerType, T.ShortType, T.ByteType)


def _as_int_ids(train: DataFrame, test: DataFrame, user: str, item: str):
    """ALS needs INT ids. Long or string ids are numbered densely (distributed
    contiguous id over the training ids) and joined in; test rows whose id has
    no training row fall out of the inner join, the rows cold-start "drop"
    removes anyway. Returns (train, test, user column, item column)."""
    cols = {}
    for c in (user, item):
        if isinstance(train.schema[c].dataType, _INT_TYPES):
            cols[c] = c
            continue
        idx_col = f"_{c}_index"
        idx = dense_index(train, c, idx_col)
        train, test = train.join(idx, c), test.join(idx, c)
        cols[c] = idx_col
    return train, test, cols[user], cols[item]


def _start(train: DataFrame, user: str, item: str, rating: str, seed: int, **params) -> DataFrame:
    """The user factors that Spark's fit on ``train`` starts from, ``(id, features)``.

    They are drawn per user block in the order of the block's ids: the users alone, each with
    one rating, give the same ones as all ratings.
    """
    users = train.select(user).distinct().select(user, F.lit(0).alias(item), F.lit(1.0).alias(rating))
    return saved(_als(user, item, rating, seed, **{**params, "maxIter": 0}).fit(users).userFactors, "als-start")


def als_fit(train: DataFrame, user: str, item: str, rating: str, seed: int = 123, **params):
    """The ALS model of Spark's estimator on ``train`` with INT ids, a written table: ``(users, items, blocks, als)``.

    It starts from the factors that Spark draws and takes Spark's half-steps, as often as the estimator says, as block
    jobs (:mod:`quarry.operators.als_steps`); :func:`als_steps` compares the two fits. Variants of ALS
    other than the explicit one with plain least squares are fitted by Spark.
    """
    als = _als(user, item, rating, seed, **params)
    blocks = RatingBlocks(train, user, item, rating)
    if als.getImplicitPrefs() or als.getNonnegative() or als.getMaxIter() < 1:
        model = als.fit(train)
        return model.userFactors, model.itemFactors, blocks, als
    start = _start(train, user, item, rating, seed, **params)
    users, items = stepped(blocks, start, als.getRegParam(), als.getMaxIter())
    return users, items, blocks, als


def als_predictions(train: DataFrame, test: DataFrame, user: str = "userId",
                    item: str = "itemId", rating: str = "rating", seed: int = 123,
                    **params) -> DataFrame:
    """Test rows scored by ALS fitted on ``train``; unseen users/items dropped."""
    tr, te, u, i = _as_int_ids(train, test, user, item)
    tr = saved(tr.select(u, i, rating), "als-train")
    users, items, blocks, _ = als_fit(tr, u, i, rating, seed, **params)
    blocks.forget()
    return _scored(te, u, i, users, items)


def _scored(test: DataFrame, u: str, i: str, users: DataFrame, items: DataFrame) -> DataFrame:
    out = scored(test, u, i, users, items)
    return out.withColumn("prediction", F.col("prediction").cast("double"))


def als_rmse(train: DataFrame, test: DataFrame, user: str = "userId", item: str = "itemId",
             rating: str = "rating", seed: int = 123, **params) -> DataFrame:
    return rmse(als_predictions(train, test, user, item, rating, seed, **params),
                "prediction", rating)


def als_bias_predictions(train: DataFrame, test: DataFrame, user: str = "userId",
                         item: str = "itemId", rating: str = "rating", seed: int = 123,
                         **params) -> DataFrame:
    """ALS fitted on the user-item interaction; prediction rebuilt as
    ``ALS(i) + user_mean + item_mean − global_mean``."""
    # the means are computed once, for the fit and for the scoring
    means = [saved(m, "als-means") for m in _means(train, user, item, rating)]
    inter = _interaction(_join_means(train, means, user, item), user, item, rating, ordered=False)
    x = "user_item_interaction"
    inter = saved(inter.select(user, item, x), "als-train")
    inter, test_b, u, i = _as_int_ids(inter, _join_means(test, means, user, item), user, item)
    users, items, blocks, _ = als_fit(saved(inter.select(u, i, x), "als-train"), u, i, x, seed, **params)
    blocks.forget()
    out = _scored(test_b, u, i, users, items)
    rebuilt = F.col("prediction") + F.col("user_mean") + F.col("item_mean") - F.col("global_mean")
    return out.withColumn("prediction", rebuilt)


def als_bias_rmse(train: DataFrame, test: DataFrame, user: str = "userId",
                  item: str = "itemId", rating: str = "rating", seed: int = 123,
                  **params) -> DataFrame:
    return rmse(als_bias_predictions(train, test, user, item, rating, seed, **params),
                "prediction", rating)


def als_solved(train: DataFrame, user: str = "userId", item: str = "itemId", rating: str = "rating",
               seed: int = 123, tolerance: float = 1e-3, **params) -> DataFrame:
    """``(user, solved)``: whether the fitted user factors solve their equations.

    ALS ends with the users' step, so each user's factors solve the normal equations of the user's
    ratings with the fitted item factors, up to the factors' single precision. What is left of the
    equations is summed anew from the ratings, block by block (:mod:`quarry.operators.als_steps`).
    """
    tr, names, u, i = _numbered(train, user, item, rating)
    users, items, blocks, als = als_fit(tr, u, i, rating, seed, **params)
    same = blocks.solves(users, items, als.getRegParam(), tolerance)
    return names[u].join(same, F.col(u) == F.col("id")).select(user, F.col("agrees").alias("solved"))


def _numbered(train: DataFrame, user: str, item: str, rating: str):
    """The ratings with INT ids, written once; per id column the ids it stands for; and the two id columns."""
    tr, _, u, i = _as_int_ids(train, train.limit(0), user, item)
    tr = saved(tr.select(*dict.fromkeys([user, u, item, i, rating])), "als-train")
    names = {n: tr.select(*dict.fromkeys([c, n])).distinct() for c, n in ((user, u), (item, i))}
    return tr, names, u, i


def als_steps(train: DataFrame, user: str = "userId", item: str = "itemId", rating: str = "rating",
              seed: int = 123, tolerance: float = 2e-2, **params) -> DataFrame:
    """``(kind, id, rank, agrees)`` for every user and item: the whole fit, checked against half-steps of our own.

    The fit with no iterations returns the factors that the model starts from. From there both half-steps
    are taken as often as the fit iterates; the model's factors must come out, with its rank. A fit
    with another number of iterations, rank or regularisation, or with a wrong step on either side, does not agree.
    Both sides keep factors in single precision, whose rounding grows from step to step: hence the tolerance.
    """
    tr, names, u, i = _numbered(train, user, item, rating)
    als = _als(u, i, rating, seed, **params)
    model = als.fit(tr)
    start = _start(tr, u, i, rating, seed, **params)
    users, items = iterated(tr, u, i, rating, start, als.getRegParam(), als.getMaxIter())
    out = None
    for kind, name, n, found, wanted in (("user", user, u, model.userFactors, users),
                                         ("item", item, i, model.itemFactors, items)):
        side = names[n].join(agree(found, wanted, tolerance), F.col(n) == F.col("id")).select(
            F.lit(kind).alias("kind"), F.col(name).cast("long").alias("id"), "rank", "agrees")
        out = side if out is None else out.union(side)
    return out


def als_bias_solved(train: DataFrame, user: str = "userId", item: str = "itemId", rating: str = "rating",
                    seed: int = 123, **params) -> DataFrame:
    """:func:`als_solved` for the fit on the user-item interaction."""
    inter = saved(bias_interaction(train, user, item, rating, ordered=False), "als-train")
    return als_solved(inter, user, item, "user_item_interaction", seed, **params)


def als_bias_steps(train: DataFrame, user: str = "userId", item: str = "itemId", rating: str = "rating",
                   seed: int = 123, **params) -> DataFrame:
    """:func:`als_steps` for the fit on the user-item interaction."""
    inter = saved(bias_interaction(train, user, item, rating, ordered=False), "als-train")
    return als_steps(inter, user, item, "user_item_interaction", seed, **params)
