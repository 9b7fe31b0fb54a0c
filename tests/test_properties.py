"""Algebraic properties on small random inputs (hypothesis, few examples)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import cluster as M
from quarry.operators import itemsets as FI
from quarry.operators import recommend as R

SLOW = settings(max_examples=4, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

pairs_st = st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from("uvwxyz")),
                    min_size=1, max_size=25)


@SLOW
@given(pairs_st)
def test_distance_symmetric_zero_on_self(spark, pairs):
    inc = spark.createDataFrame(sorted(set(pairs)), "entity string, feature string")
    ents = sorted({e for e, _ in pairs})
    asked = spark.createDataFrame([(a, b) for a in ents for b in ents], "a string, b string")
    d = {(r.a, r.b): r.d2 for r in M.pair_distance(asked, inc, "a", "b").collect()}
    for a in ents:
        assert d[(a, a)] == 0
        for b in ents:
            assert d[(a, b)] == d[(b, a)] >= 0


baskets_st = st.lists(st.lists(st.sampled_from("pqrst"), max_size=4), min_size=3, max_size=12)


@SLOW
@given(baskets_st)
def test_itemset_support_antitone(spark, baskets):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)],
                               "key int, items array<string>")
    model = FI.fit_fpgrowth(df, "items", 0.2, 0.5)
    freq = {tuple(r["items"]): r["freq"] for r in FI.frequent_itemsets(model).collect()}
    for items, f in freq.items():
        for drop in range(len(items)):
            sub = items[:drop] + items[drop + 1:]
            if sub:
                assert sub in freq and freq[sub] >= f


ratings_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4), st.integers(1, 5)),
                      min_size=2, max_size=20)


@SLOW
@given(ratings_st)
def test_interaction_sums(spark, rows):
    rows = [(u, i, r) for (u, i), r in {(u, i): r for u, i, r in rows}.items()]
    df = spark.createDataFrame(rows, "userId int, itemId int, rating int")
    got = R.bias_interaction(df).collect()
    # per user: Σ (rating - user_mean) = 0, so Σ interaction = Σ (global_mean - item_mean)
    by_user = {}
    for r in got:
        acc = by_user.setdefault(r.userId, [0.0, 0.0])
        acc[0] += r.user_item_interaction
        acc[1] += r.item_mean
    gm = sum(r for *_, r in rows) / len(rows)
    for u, (s_inter, s_item) in by_user.items():
        n = sum(1 for uu, _, _ in rows if uu == u)
        assert math.isclose(s_inter, n * gm - s_item, abs_tol=1e-9)
