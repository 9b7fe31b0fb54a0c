import hashlib
import random
from fractions import Fraction

from pyspark.sql import functions as F

from quarry.operators import cluster as M


def inc_df(spark, pairs):
    return spark.createDataFrame(pairs, "entity string, feature string")


def test_incidence_limited_to_dimension(spark):
    b = spark.createDataFrame([("p1", ["qc", "on", "pe", "qc"]), ("p2", ["on"]), ("p3", [])],
                              "plant string, states array<string>")
    dim = spark.createDataFrame([("qc",), ("on",), ("ab",)], "entity string")
    got = sorted(map(tuple, M.incidence_from_baskets(b, "plant", "states", dim).collect()))
    assert got == [("on", "p1"), ("on", "p2"), ("qc", "p1")]


def test_membership_missing_is_false(spark):
    inc = inc_df(spark, [("qc", "urtica"), ("hi", "zinnia")])
    probes = spark.createDataFrame([("qc", "urtica"), ("az", "urtica"), ("qc", "nothing")],
                                   "entity string, feature string")
    got = {(r.entity, r.feature): r.present for r in M.membership(probes, inc).collect()}
    assert got == {("qc", "urtica"): True, ("az", "urtica"): False, ("qc", "nothing"): False}


def random_incidence(seed, n_ent=30, n_feat=25, p=0.3):
    rng = random.Random(seed)
    pairs = [(f"e{e:02d}", f"f{f:02d}") for e in range(n_ent) for f in range(n_feat)
             if rng.random() < p]
    # two entities with identical vectors (centroid ties), one without overlap
    pairs += [("dup1", "f01"), ("dup1", "f02"), ("dup2", "f01"), ("dup2", "f02"), ("solo", "zz")]
    return pairs


def test_pair_distance_brute_force(spark):
    pairs = random_incidence(1)
    vec = {}
    for e, f in pairs:
        vec.setdefault(e, set()).add(f)
    vec["empty"] = set()
    ents = sorted(vec)
    asked = [(a, b) for a in ents[:6] for b in ents] + [("empty", "e00"), ("solo", "dup1")]
    df = spark.createDataFrame(asked, "a string, b string")
    got = {(r.a, r.b): r.d2 for r in M.pair_distance(df, inc_df(spark, pairs), "a", "b").collect()}
    for a, b in asked:
        assert got[(a, b)] == len(vec[a] ^ vec[b])
    assert got[("e00", "e00")] == 0


def _features_met(monkeypatch):
    """Collects, per call of ``pair_distance``, how many of its (feature, entity) rows meet and how many are walked."""
    found = []

    def seen(df, name, real=M.saved):
        out = real(df, name)
        if name == "pair-features":
            found.append({r["_met"]: r["n"] for r in out.groupBy("_met").agg(F.count(F.lit(1)).alias("n")).collect()})
        return out

    monkeypatch.setattr(M, "saved", seen)
    return found


def test_pair_distance_of_all_pairs_meets_per_feature(spark, monkeypatch):
    """Where all pairs are asked for, no row per pair and feature is shuffled: entities meet at their features."""
    found = _features_met(monkeypatch)
    sets = {e: {f for f in range(200) if (f * 7 + e * 13) % 5} for e in range(24)}
    inc = spark.createDataFrame([(e, f"f{f}") for e, s in sets.items() for f in s], "entity long, feature string")
    asked = spark.createDataFrame([(a, b) for a in sets for b in sets], "a long, b long")
    got = {(r.a, r.b): r.d2 for r in M.pair_distance(asked, inc, "a", "b").collect()}
    assert got == {(a, b): len(sets[a] ^ sets[b]) for a in sets for b in sets}
    assert found == [{True: sum(map(len, sets.values()))}]


def test_pair_distance_of_hot_features_and_repeated_rows(spark, monkeypatch):
    """Few pairs are asked for: a feature that all entities share is walked, and never meets in all pairs."""
    rows = [(e, "hot") for e in range(300)] + [(e, f"f{e % 7}") for e in range(300)] + [(5, None), (12, None), (5, "f5"), (None, "hot")]
    inc = spark.createDataFrame(rows, "entity long, feature string")
    asked = [(5, 12), (12, 5), (5, 6), (7, 7), (299, 1000), (None, 5)]
    found = _features_met(monkeypatch)
    out = M.pair_distance(spark.createDataFrame(asked, "a long, b long"), inc, "a", "b")
    got = {(r.a, r.b): r.d2 for r in out.collect()}
    assert found == [{False: 7}]  # "hot" of 5, 6, 12 and 299, "f5" of 5, 12 and 299
    # sizes count every row: 5 has 4, 12 has 3, 6, 7 and 299 have 2
    assert got == {(5, 12): 3, (12, 5): 3, (5, 6): 4, (7, 7): 0, (299, 1000): 2, (None, 5): 4}


def _md5_order(keys, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def _round2_half_up(x: Fraction) -> Fraction:
    return Fraction(int(x * 100 + Fraction(1, 2)), 100)


def brute_kmeans(pairs, entities, k, seed, max_iter):
    vec = {e: set() for e in entities}
    for e, f in pairs:
        vec[e].add(f)
    feats = sorted({f for _, f in pairs})
    cents = _md5_order(entities, seed)[:k]
    weights = [{f: Fraction(1 if f in vec[c] else 0) for f in feats} for c in cents]

    def assign():
        out = {}
        for e in entities:
            d = [sum((int(f in vec[e]) - w[f]) ** 2 for f in feats) for w in weights]
            best = min(range(k), key=lambda j: (d[j], j))
            out[e] = (best, d[best])
        return out

    cur = assign()
    for _ in range(max_iter):
        for j in range(k):
            members = [e for e in entities if cur[e][0] == j]
            if members:
                weights[j] = {f: _round2_half_up(Fraction(sum(f in vec[m] for m in members),
                                                          len(members))) for f in feats}
        nxt = assign()
        moved = any(nxt[e][0] != cur[e][0] for e in entities)
        cur = nxt
        if not moved:
            break
    return cur


def test_kmeans_matches_brute_force_and_partitioning(spark):
    pairs = random_incidence(7)
    entities = sorted({e for e, _ in pairs} | {"nofeat"})
    dim = spark.createDataFrame([(e,) for e in entities], "entity string")
    want = brute_kmeans(pairs, entities, 4, 11, 1000)
    for parts in (1, 7):
        inc = inc_df(spark, pairs).repartition(parts)
        res = M.kmeans(inc, 4, 11, entities=dim)
        assert all(r.converged for r in res.collect())
        got = {r.entity: (r.cluster, Fraction(r.d2_scaled, M.SCALE)) for r in res.collect()}
        assert got == want


def test_first_assignment_and_members(spark):
    pairs = random_incidence(3)
    entities = sorted({e for e, _ in pairs})
    want = brute_kmeans(pairs, entities, 3, 5, 0)
    a = M.nearest_centroid(inc_df(spark, pairs), 3, 5)
    got = {r.entity: (r.cluster, Fraction(r.d2_scaled, M.SCALE)) for r in a.collect()}
    assert got == want
    members = M.cluster_members(a).collect()
    for r in members:
        same = sorted(e for e, (c, _) in want.items() if c == r.cluster)
        assert same[r.member_rank] == r.entity


def test_kmeans_limit_shows_and_old_passes_are_deleted(spark):
    import os

    from quarry.session import checkpoint_dir
    pairs = random_incidence(7)
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "quarry-tables")

    def folders():
        return {f for f in (os.listdir(folder) if os.path.isdir(folder) else []) if f.startswith("kmeans-")}

    before = folders()
    out = M.kmeans(inc_df(spark, pairs), 4, 11, max_iter=1)
    assert not any(r.converged for r in out.collect())
    full = M.kmeans(inc_df(spark, pairs), 4, 11)
    assert all(r.converged for r in full.collect())
    # per run: the last assignment, the last weights and the sampled centroids
    assert len(folders() - before) <= 6


def test_argmin_has_no_size_cap(spark):
    """Centroids with norms far beyond what a packed 64-bit value could hold."""
    weights = spark.createDataFrame([(0, "a", 2_000_000_000), (1, "a", 1_999_999_999)], "cluster int, feature string, w long")
    counts = spark.createDataFrame([("x", 1), ("y", 1)], "entity string, n long")
    clusters = spark.createDataFrame([(0, "p"), (1, "q")], "cluster int, centroid string")
    inc = inc_df(spark, [("x", "a"), ("y", "b")])
    got = {r.entity: r.cluster for r in M.assign(inc, counts, clusters, weights.limit(2), 2).collect()}
    assert got == {"x": 1, "y": 1}


def test_kmeans_bounds_change_nothing_and_save_joins(spark, monkeypatch):
    rng = random.Random(21)
    pairs = random_incidence(21) + [(f"g{k:02d}", f"{k % 3}-{rng.randrange(12)}") for k in range(30) for _ in range(25)]
    pairs = sorted(set(pairs))
    entities = sorted({e for e, _ in pairs} | {"nofeat"})
    dim = spark.createDataFrame([(e,) for e in entities], "entity string")
    want = brute_kmeans(pairs, entities, 6, 3, 1000)
    passes = []
    for wide in (64, 0):  # sums as columns, sums as rows
        monkeypatch.setattr(M, "WIDE", wide)
        got = M.kmeans(inc_df(spark, pairs), 6, 3, entities=dim, passes=passes).collect()
        assert {r.entity: (r.cluster, Fraction(r.d2_scaled, M.SCALE)) for r in got} == want
    half = len(passes) // 2
    assert passes[:half] == passes[half:] and passes[-1][0] == 0
    assert passes[0][1] == len(entities) > passes[half - 1][1]  # later passes join fewer entities


def test_kmeans_edges(spark):
    empty = M.kmeans(inc_df(spark, []), 3, 1)
    assert empty.collect() == []
    few = M.kmeans(inc_df(spark, [("a", "x"), ("b", "y"), ("a", "x")]), 5, 1).collect()
    assert sorted((r.entity, r.d2_scaled, r.converged) for r in few) == [("a", 0, True), ("b", 0, True)]
    one = M.kmeans(inc_df(spark, [("a", "x"), ("b", "y"), ("c", "x")]), 1, 1).collect()
    assert {r.cluster for r in one} == {0} and all(r.converged for r in one)


def test_bit_blocks_give_the_same_distances_and_lookups(spark):
    from quarry.operators import bitmaps as B
    rng = random.Random(5)
    pairs = {(f"e{rng.randrange(9)}", f"f{rng.randrange(40_000)}") for _ in range(4000)}
    pairs |= {("hot", f"f{k}") for k in range(0, 40_000, 3)}
    inc = inc_df(spark, [*pairs, *list(pairs)[:9], (None, "f1"), ("e1", None)])
    bits = B.bit_incidence(inc)
    sets = {}
    for e, f in pairs:
        sets.setdefault(e, set()).add(f)
    assert {r["entity"]: r["n"] for r in B.bit_sizes(bits).collect()} == {e: len(s) for e, s in sets.items()}
    names = [*sorted(sets), "none", "nobody"]
    asked = [(a, b) for a in names for b in names]
    got = B.pair_distance_bits(spark.createDataFrame(asked + asked[:5], "left string, right string"), bits)
    want = {(a, b): len(sets.get(a, set()) ^ sets.get(b, set())) for a, b in asked}
    assert {(r["left"], r["right"]): r["d2"] for r in got.collect()} == want and got.count() == len(want)
    probes = [(rng.choice(names), f"f{rng.randrange(40_100)}", k) for k in range(500)] + [(None, "f1", 1), ("e1", None, 2)]
    found = B.membership_bits(spark.createDataFrame(probes, "entity string, feature string, k int"), bits).collect()
    assert len(found) == len(probes)
    assert all(r["present"] == (r["feature"] in sets.get(r["entity"], set())) for r in found)
    assert B.bit_incidence(inc_df(spark, [])).blocks.count() == 0
