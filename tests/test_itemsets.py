import math
from itertools import combinations

from quarry.operators import itemsets as FI

BASKETS = [["a", "b", "c"], ["a", "b"], ["a", "c", "a"], ["b", "c"], ["a", "b", "c", "d"],
           [], ["d"], ["a", "b", "d"]]


def brute(baskets, s):
    n = len(baskets)
    sets = [set(b) for b in baskets]
    items = sorted(set().union(*sets))
    need = math.ceil(s * n)
    out = {}
    for m in range(1, len(items) + 1):
        for combo in combinations(items, m):
            f = sum(1 for b in sets if set(combo) <= b)
            if f >= need:
                out[combo] = f
    return out, n


def test_itemsets_rules_interest_against_brute_force(spark):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(BASKETS)], "key int, items array<string>")
    model = FI.fit_fpgrowth(df, "items", 0.25, 0.5)
    want, n = brute(BASKETS, 0.25)
    got = {tuple(r["items"]): r["freq"] for r in FI.frequent_itemsets(model).collect()}
    assert got == want
    rules = {}
    for items, f in want.items():
        if len(items) < 2:
            continue
        for c in items:
            ante = tuple(x for x in items if x != c)
            conf = f / want[ante]
            if conf >= 0.5:
                rules[(ante, c)] = conf
    got_r = {(tuple(r["antecedent"]), r["consequent"][0]): r["confidence"]
             for r in FI.association_rules(model).collect()}
    assert got_r == rules
    inter = FI.rule_interest(model, df).collect()
    assert len(inter) == len(rules)
    for r in inter:
        c = r["consequent"][0]
        assert r["freq"] == want[(c,)]
        assert abs(r["interest"] - abs(r["confidence"] - want[(c,)] / n)) < 1e-15
    # ordering: antecedent size desc, then interest desc
    keys = [(-len(r["antecedent"]), -r["interest"]) for r in inter]
    assert keys == sorted(keys)


def test_baskets_from_pairs_dedupes(spark):
    pairs = spark.createDataFrame([(1, "x"), (1, "x"), (1, "a"), (2, None), (2, "b")],
                                  "b long, i string")
    got = {r["b"]: r["items"] for r in FI.baskets_from_pairs(pairs, "b", "i").collect()}
    assert got == {1: ["a", "x"], 2: ["b"]}
