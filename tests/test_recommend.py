import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import recommend as R
from quarry.operators.split import hash_split, sample_keys, split_check

TRAIN = [(0, 0, 3), (0, 1, 1), (1, 0, 5), (1, 2, 2), (2, 1, 4), (2, 2, 4)]
# user 9 and item 9 never appear in training
TEST = [(0, 2, 2), (1, 1, 3), (9, 0, 1), (0, 9, 5)]
SCHEMA = "userId int, itemId int, rating int"


def frames(spark):
    return spark.createDataFrame(TRAIN, SCHEMA), spark.createDataFrame(TEST, SCHEMA)


def _means():
    gm = sum(r for *_, r in TRAIN) / len(TRAIN)
    um = {u: sum(r for uu, _, r in TRAIN if uu == u) / sum(1 for uu, _, _ in TRAIN if uu == u)
          for u, _, _ in TRAIN}
    im = {i: sum(r for _, ii, r in TRAIN if ii == i) / sum(1 for _, ii, _ in TRAIN if ii == i)
          for _, i, _ in TRAIN}
    return gm, um, im


def test_interaction_matches_formula(spark):
    train, _ = frames(spark)
    gm, um, im = _means()
    got = R.bias_interaction(train).collect()
    assert [(r.userId, r.itemId) for r in got] == sorted((u, i) for u, i, _ in TRAIN)
    for r in got:
        assert r.rating == float(dict(((u, i), x) for u, i, x in TRAIN)[(r.userId, r.itemId)])
        want = r.rating - (um[r.userId] + im[r.itemId] - gm)
        assert math.isclose(r.user_item_interaction, want, abs_tol=1e-12)
    assert len(R.bias_interaction(train, n=2).collect()) == 2


def test_global_mean_rmse_counts_unseen(spark):
    train, test = frames(spark)
    gm, _, _ = _means()
    want = math.sqrt(sum((gm - r) ** 2 for *_, r in TEST) / len(TEST))
    assert math.isclose(R.global_mean_rmse(train, test).first()["rmse"], want, rel_tol=1e-12)


def test_bias_rmse_drops_unseen(spark):
    train, test = frames(spark)
    gm, um, im = _means()
    seen = [(u, i, r) for u, i, r in TEST if u in um and i in im]
    want = math.sqrt(sum((um[u] + im[i] - gm - r) ** 2 for u, i, r in seen) / len(seen))
    assert math.isclose(R.bias_rmse(train, test).first()["rmse"], want, rel_tol=1e-12)


def test_als_runs_and_drops_cold_start(spark):
    train, test = frames(spark)
    preds = R.als_predictions(train, test, seed=1, rank=2, maxIter=3)
    assert preds.count() == 2
    assert math.isfinite(R.als_rmse(train, test, seed=1, rank=2, maxIter=3).first()["rmse"])
    assert math.isfinite(R.als_bias_rmse(train, test, seed=1, rank=2, maxIter=3).first()["rmse"])


def test_als_solves_its_equations(spark):
    train, _ = frames(spark)
    got = {r.userId: r.solved for r in R.als_solved(train, seed=1, rank=2, maxIter=3).collect()}
    assert got == {0: True, 1: True, 2: True}
    wrong = R.als_solved(train, seed=1, rank=2, maxIter=3, tolerance=1e-12).collect()
    assert not all(r.solved for r in wrong)  # the check can fail
    assert all(r.solved for r in R.als_bias_solved(train, seed=1, rank=2, maxIter=3).collect())


def test_als_scores_in_blocks_are_the_models(spark):
    """Scored block by block, also with a hot user dealt over all blocks: Spark's own predictions, bit for bit."""
    from quarry.operators.als_steps import scored
    train = made_ratings(spark).select((F.col("userId") - 3_000_000_000).cast("int").alias("userId"),
                                       F.substring("itemId", 6, 2).cast("int").alias("itemId"), "rating")
    model = R._als("userId", "itemId", "rating", 5, rank=6, maxIter=3).fit(train)
    rows = [(u, i, None if i == 3 else u / 7) for u in range(0, 70, 3) for i in range(30)] + [(3, 4, 5.0)] * 2
    test = spark.createDataFrame(rows, "userId int, itemId int, note double")
    want = sorted(map(repr, model.transform(test).collect()))
    for how in ({}, {"blocks": 3}, {"blocks": 4, "heavy": 20}):
        got = scored(test, "userId", "itemId", model.userFactors, model.itemFactors, **how).select(*test.columns, "prediction")
        assert sorted(map(repr, got.collect())) == want
    assert scored(test.limit(0), "userId", "itemId", model.userFactors, model.itemFactors).count() == 0
    with pytest.raises(Exception, match="must not be null"):
        no_id = spark.createDataFrame([(None, 1, 1.0)], test.schema)
        scored(no_id, "userId", "itemId", model.userFactors, model.itemFactors).collect()


def test_als_blocks_grow_with_the_ratings(spark):
    """What is sent to the blocks grows with their number: it follows the ratings, not the shuffle partitions."""
    from quarry.operators.als_steps import BLOCK_ROWS, dealt
    rows = spark.range(2000).selectExpr("cast(id % 500 as int) a", "cast(id as int) b")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        assert BLOCK_ROWS >= 1_000_000 and dealt(rows, "a", "b").select("block").distinct().count() <= 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert R._als("a", "b", "r", 1).getNumUserBlocks() == 10  # the start depends on it
    assert R._als("a", "b", "r", 1).getNumItemBlocks() == 5


def made_ratings(spark, users=60, items=25):
    """A made sample: ratings 1 to 5 from two hidden tastes, with string items and ids beyond INT."""
    rows = []
    for u in range(users):
        for i in range(items):
            if (u * 7 + i * 11) % 5 < 2:
                taste = 3 + 1.2 * math.cos(u * 0.7) * math.cos(i * 0.9) + 1.2 * math.sin(u * 0.3) * math.sin(i * 0.5)
                rows.append((3_000_000_000 + u, f"item-{i:02d}", int(min(5, max(1, round(taste))))))
    return spark.createDataFrame(rows, "userId long, itemId string, rating int")


def test_als_whole_fit_is_checked(spark):
    from quarry.operators.als_steps import RatingBlocks, agree, iterated
    train = made_ratings(spark).select("userId", F.substring("itemId", 6, 2).cast("long").alias("itemId"), "rating")
    got = R.als_steps(train, seed=5, rank=6, maxIter=3).collect()
    assert {(r["kind"], r["rank"], r["agrees"]) for r in got} == {("user", 6, True), ("item", 6, True)}
    assert len(got) == 85 and {r["id"] for r in got if r["kind"] == "user"} == {3_000_000_000 + u for u in range(60)}
    # what it would not let pass: another number of iterations, another regularisation, another rank
    tr, _, u, i = R._numbered(train, "userId", "itemId", "rating")
    fit = lambda **p: R._als(u, i, "rating", 5, **{"rank": 6, "maxIter": 3, **p}).fit(tr)
    start = fit(maxIter=0).userFactors
    users, items = iterated(tr, u, i, "rating", start, 0.01, 3)
    assert all(r["agrees"] for r in agree(fit().userFactors, users, 2e-2).collect())
    for wrong in (fit(maxIter=2), fit(regParam=0.02), fit(rank=5)):
        for found, wanted in ((wrong.userFactors, users), (wrong.itemFactors, items)):
            agreeing = [r["agrees"] for r in agree(found, wanted, 2e-2).collect()]
            assert sum(agreeing) < len(agreeing) / 2
    # a hot user is dealt over the blocks and gives the same factors
    few = RatingBlocks(tr, u, i, "rating", blocks=3, heavy=5)
    assert few.rows.where("heavy").count() > 0
    one = {r["id"]: r["features"] for r in RatingBlocks(tr, u, i, "rating", blocks=2).solved(items, 0.01).collect()}
    for r in few.solved(items, 0.01).collect():
        assert all(math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-9) for a, b in zip(r["features"], one[r["id"]]))


def test_als_fit_is_sparks_and_leaves_little_behind(spark):
    """The block jobs fit Spark's model, from Spark's start, which the users alone give; tables of passed steps are dropped."""
    import glob
    from quarry.session import checkpoint_dir
    train = made_ratings(spark).select((F.col("userId") - 3_000_000_000).cast("int").alias("userId"),
                                       F.substring("itemId", 6, 2).cast("int").alias("itemId"), "rating")
    train = train.union(train.limit(40)).localCheckpoint()  # rows that come twice count twice
    plain = lambda t: {r["id"]: list(r["features"]) for r in t.collect()}
    zero = R._als("userId", "itemId", "rating", 5, rank=6, maxIter=0).fit(train)
    assert plain(R._start(train, "userId", "itemId", "rating", 5, rank=6)) == plain(zero.userFactors)
    tables = lambda: {k: len(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/quarry-tables/{k}-*"))
                      for k in ("als-users", "als-items", "als-step")}
    before = tables()
    users, items, blocks, als = R.als_fit(train, "userId", "itemId", "rating", 5, rank=6, maxIter=3)
    assert als.getMaxIter() == 3 and {k: n - before[k] for k, n in tables().items()} == {"als-users": 1, "als-items": 1, "als-step": 0}
    model = R._als("userId", "itemId", "rating", 5, rank=6, maxIter=3).fit(train)
    for found, wanted in ((users, model.userFactors), (items, model.itemFactors)):
        found, wanted = plain(found), plain(wanted)
        assert found.keys() == wanted.keys()
        assert all(math.dist(found[k], v) <= 1e-3 * math.hypot(*v) for k, v in wanted.items())
    assert blocks.packed.count() == blocks.blocks  # a half-step moves few, large rows
    # the check sees the ratings: factors that do not solve the equations are found, and only they
    wrong = users.withColumn("features", F.when(F.col("id") == 7, F.transform("features", lambda x: x * 1.01)).otherwise(F.col("features")))
    assert {r["id"] for r in blocks.solves(wrong, items, 0.01, 1e-3).collect() if not r["agrees"]} == {7}
    assert {r["id"] for r in blocks.solves(users, items, 0.02, 1e-3).collect() if r["agrees"]} == set()
    with pytest.raises(Exception, match="must not be null"):
        R.als_fit(train.withColumn("rating", F.when(F.col("userId") != 4, F.col("rating"))), "userId", "itemId", "rating", 5, rank=2)


def test_als_hot_users_and_items_in_blocks(spark):
    """Ids with more ratings than a block should hold are dealt over all blocks on either side; the factors stay the same."""
    from quarry.operators.als_steps import RatingBlocks
    train = made_ratings(spark).select((F.col("userId") - 3_000_000_000).cast("int").alias("u"),
                                       F.substring("itemId", 6, 2).cast("int").alias("i"), "rating").localCheckpoint()
    start = R._start(train, "u", "i", "rating", 5, rank=5)
    plain = lambda t: {r["id"]: list(r["features"]) for r in t.collect()}
    one, hot = RatingBlocks(train, "u", "i", "rating", blocks=1), RatingBlocks(train, "u", "i", "rating", blocks=3, heavy=9)
    items = one.others(start, 0.01)
    want, got = plain(items), plain(hot.others(start, 0.01))
    assert one.hot == [] and hot.hot and hot.any_heavy and want.keys() == got.keys()
    assert all(math.isclose(a, b, rel_tol=1e-5, abs_tol=1e-7) for k in want for a, b in zip(want[k], got[k]))
    users = one.solved(items, 0.01)
    checked = hot.solves(users, items, 0.01, 1e-3).collect()
    assert all(r["agrees"] for r in checked) and len(checked) == 60
    assert not any(r["agrees"] for r in hot.solves(users, items, 0.05, 1e-3).collect())


def test_published_kind_of_values_on_a_made_sample(spark):
    """The quality values of the recommenders, on ratings with a known structure."""
    data = made_ratings(spark)
    train, test = hash_split(data, ["userId", "itemId"], 123)
    rows = [tuple(r) for r in train.collect()]
    mean = sum(r for *_, r in rows) / len(rows)
    assert math.isclose(R.global_mean(train).first()["global_mean"], mean, rel_tol=1e-12)
    held = [r[2] for r in test.collect()]
    want = math.sqrt(sum((mean - r) ** 2 for r in held) / len(held))
    assert math.isclose(R.global_mean_rmse(train, test).first()["rmse"], want, rel_tol=1e-12)
    bias = R.bias_rmse(train, test).first()["rmse"]
    als = R.als_rmse(train, test, seed=123, rank=4, maxIter=10, regParam=0.05).first()["rmse"]
    both = R.als_bias_rmse(train, test, seed=123, rank=4, maxIter=10, regParam=0.05).first()["rmse"]
    assert als < want and both < bias  # the hidden tastes are found


def test_order_free_sums(spark):
    from quarry.functions.exprs import exact_avg, exact_rmse, exact_sum
    rows = [(k % 5, (k * 0.1) ** 3 * (-1) ** k, k * 0.3, k / 7) for k in range(3000)] + [(1, None, 1.0, None)]
    df = spark.createDataFrame(rows, "g int, x double, a double, b double")
    seen = set()
    for parts in (1, 7, 40):
        d = df.repartition(parts, F.rand(parts))
        whole = d.agg(exact_sum(F.col("x"), 20), exact_avg(F.col("a")), exact_rmse("a", "b")).first()
        by = sorted(map(tuple, d.groupBy("g").agg(exact_avg(F.col("b"))).collect()))
        seen.add((tuple(whole), tuple(by)))
    assert len(seen) == 1  # the same bits
    (total, mean, error), _ = seen.pop()
    assert math.isclose(total, math.fsum(x for _, x, _, _ in rows if x is not None), abs_tol=3000 / 2 ** 20)
    assert math.isclose(mean, math.fsum(a for *_, a, _ in rows) / len(rows), rel_tol=1e-9)
    gaps = [(a - b) ** 2 for *_, a, b in rows if b is not None]
    assert math.isclose(error, math.sqrt(math.fsum(gaps) / len(gaps)), rel_tol=1e-9)
    with pytest.raises(Exception, match="exact_sum"):
        df.agg(exact_sum(F.lit(1e300))).collect()


def test_means_of_ids_beyond_int(spark):
    train = spark.createDataFrame([(3_000_000_005, 1, 4), (3_000_000_005, 2, 2)], "userId long, itemId long, rating int")
    assert R.global_mean(train).first()[0] == 3.0
    assert R.group_means(train, "userId").first()["userId"] == 3_000_000_005


def test_als_indexes_long_and_string_ids(spark):
    big = [(3_000_000_000 + u, f"item-{i}", r) for u, i, r in TRAIN]
    big_test = [(3_000_000_000 + u, f"item-{i}", r) for u, i, r in TEST]
    schema = "userId long, itemId string, rating int"
    train, test = spark.createDataFrame(big, schema), spark.createDataFrame(big_test, schema)
    preds = R.als_predictions(train, test, seed=1, rank=2, maxIter=3)
    assert preds.count() == 2
    assert math.isfinite(R.als_bias_rmse(train, test, seed=1, rank=2, maxIter=3).first()["rmse"])


def test_hash_split_disjoint_complete_partition_independent(spark):
    df = spark.range(2000).select((F.col("id") % 97).cast("int").alias("userId"),
                                  F.floor(F.col("id") / 97).cast("int").alias("itemId"),
                                  F.lit(1).alias("rating"))
    a_tr, a_te = hash_split(df.repartition(3), ["userId", "itemId"], 123)
    b_tr, b_te = hash_split(df.repartition(11).select("itemId", "rating", "userId"),
                            ["userId", "itemId"], 123)
    chk = split_check([a_tr, a_te], ["userId", "itemId"]).first()
    assert chk["n_rows"] == 2000 and chk["n_shared_keys"] == 0
    key = lambda d: sorted((r.userId, r.itemId) for r in d.collect())
    assert key(a_tr) == key(b_tr)
    assert 0.7 < a_tr.count() / 2000 < 0.9


def test_sample_keys_reproducible(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefghij"] * 3, "k string")
    a = [tuple(r) for r in sample_keys(df, "k", 4, 124).collect()]
    b = [tuple(r) for r in sample_keys(df.repartition(5), "k", 4, 124).collect()]
    assert a == b and [o for _, o in a] == [0, 1, 2, 3] and len({k for k, _ in a}) == 4
