"""Sparse binary incidence, squared distances and Lloyd k-means.

An entity (a state in the reference) is a 0/1 vector over features (plants).
Vectors stay a sparse long table ``incidence(entity, feature)``; nothing is
densified or sent to the driver.

k-means arithmetic is exact integer arithmetic: a centroid coordinate is the
member mean rounded half-up to 2 decimals, stored as a whole number of
hundredths ``w = (200·s + c) div (2·c)`` (s members with the feature, c
members), and distances are kept scaled by 10⁴:

    10⁴·d²(x, c) = 10⁴·n_x + Σ_f w_cf² − 200·Σ_{f∈x} w_cf

so the result does not depend on partitioning or summation order. Per pass the
cost is one join of the incidence with the centroid weights on ``feature``
(O(nnz·k) rows, partially aggregated before the shuffle); clusters an entity
shares no feature with are covered by one scalar (the smallest centroid
norm), never by an entity × centroid cross product.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry.operators.ids import contiguous_id
from quarry.operators.split import sample_keys
from quarry.session import forget, saved

SCALE = 10_000      # distances are reported as d2_scaled = 10⁴·d²
UNIT = 100          # weight of a 1 in hundredths


def incidence_from_baskets(baskets: DataFrame, key_col: str, items_col: str,
                           entities: DataFrame | None = None, entity_col: str = "entity",
                           feature_col: str = "feature") -> DataFrame:
    """Transpose baskets (key → items) into (entity = item, feature = key).

    With an ``entities`` dimension, items outside it are ignored (as the
    reference ignores items missing from its state list).
    """
    inc = (baskets.select(F.explode(items_col).alias(entity_col),
                          F.col(key_col).alias(feature_col))
           .where(F.col(entity_col).isNotNull()).distinct())
    if entities is not None:
        dim = entities.select(F.col(entity_col).cast(inc.schema[entity_col].dataType))
        inc = inc.join(dim, entity_col, "left_semi")
    return inc


def membership(probes: DataFrame, incidence: DataFrame, entity_col: str = "entity",
               feature_col: str = "feature", out: str = "present") -> DataFrame:
    """Every probe row with ``out`` = whether (entity, feature) is in the incidence.

    A missing entity or feature gives false (the reference fails instead).
    """
    flag = incidence.select(entity_col, feature_col).distinct().withColumn(out, F.lit(True))
    return (probes.join(flag, [entity_col, feature_col], "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(False))))


def feature_counts(incidence: DataFrame, entities: DataFrame | None = None,
                   entity_col: str = "entity", out: str = "n") -> DataFrame:
    """(entity, n features); entities of the dimension without features get 0."""
    n = incidence.groupBy(entity_col).agg(F.count(F.lit(1)).alias(out))
    if entities is None:
        return n
    dim = entities.select(entity_col).distinct()
    return dim.join(n, entity_col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def pair_distance(pairs: DataFrame, incidence: DataFrame, left: str = "left",
                  right: str = "right", entity_col: str = "entity",
                  feature_col: str = "feature") -> DataFrame:
    """Squared Euclidean distance of the 0/1 vectors of each requested pair:
    ``|A| + |B| − 2·|A ∩ B|``. ``incidence`` holds distinct (entity, feature)
    pairs, as ``incidence_from_baskets`` produces them.

    The overlap is counted per feature: the entities of a feature meet in a join of the incidence with itself,
    and only counts per pair leave the tasks. A feature whose entities would meet in more than
    twice as many pairs as are asked for is walked instead: each of its entities with each larger one that it is
    asked with, probed by a semi-join. Either way the work is O(Σ over pairs of min(|A|, |B|)),
    never all pairs of entities that share a feature. The pair list with its
    sizes is computed once; a pair and its mirror image are counted once, and a
    pair of one entity with itself not at all. AQE chooses the joins by size.
    """
    inc = incidence.select(entity_col, feature_col)
    sizes = saved(inc.groupBy(entity_col).agg(F.count(F.lit(1)).alias("_n")), "pair-sizes")
    z = F.lit(0)
    p = (pairs.select(left, right).distinct()
         .join(sizes.select(F.col(entity_col).alias(left), F.col("_n").alias("n_left")), left, "left")
         .join(sizes.select(F.col(entity_col).alias(right), F.col("_n").alias("n_right")), right, "left")
         .withColumn("n_left", F.coalesce("n_left", z))
         .withColumn("n_right", F.coalesce("n_right", z)))
    # the smaller entity first; of equal sizes the smaller key, so mirror images agree
    swap = ((F.col("n_left") > F.col("n_right"))
            | ((F.col("n_left") == F.col("n_right")) & (F.col(left) > F.col(right))))
    p = saved(p.withColumn("_small", F.when(swap, F.col(right)).otherwise(F.col(left)))
               .withColumn("_big", F.when(swap, F.col(left)).otherwise(F.col(right))), "pairs")
    asked = p.where("_small <> _big").select("_small", "_big").distinct()
    overlap = _overlaps(asked, inc.toDF("_e", "_f"))
    out = p.join(overlap, ["_small", "_big"], "left")
    shared = F.when(F.col("_small") == F.col("_big"), F.col("n_left")).otherwise(F.coalesce("overlap", z))
    d2 = F.col("n_left") + F.col("n_right") - 2 * shared
    return out.select(left, right, d2.cast("long").alias("d2"))


def _overlaps(asked: DataFrame, inc: DataFrame) -> DataFrame:
    """``(_small, _big, overlap)`` of the pairs ``asked`` in the incidence ``(_e, _f)``; pairs without one are left out.

    A repeated row of the smaller entity counts as often as it stands there, one of the larger entity once.
    """
    walks = asked.groupBy("_small").agg(F.count(F.lit(1)).alias("_walks")).withColumnRenamed("_small", "_e")
    paired = asked.select(F.explode(F.array("_small", "_big")).alias("_e")).distinct()
    held = inc.join(paired, "_e", "left_semi").where("_f is not null").join(walks, "_e", "left")
    held = saved(held.groupBy("_f", "_e").agg(
        F.count(F.lit(1)).alias("_m"), F.coalesce(F.max("_walks"), F.lit(0)).alias("_walks")), "pair-incidence")
    cost = held.groupBy("_f").agg(F.count(F.lit(1)).alias("_n"), F.sum("_walks").alias("_walked"))
    meets = held.join(cost.where("_n > 1 and _walked > 0").select(
        "_f", (F.col("_n") * (F.col("_n") - 1) <= 4 * F.col("_walked")).alias("_met")), "_f")
    meets = saved(meets.select("_f", "_e", "_m", "_met"), "pair-features")
    a, b = (meets.where("_met").select("_f", F.col("_e").alias(f"_{x}"), F.col("_m").alias(f"_m{x}")) for x in "ab")
    both = a.join(b, "_f").where("_a < _b")
    either = asked.select(F.least("_small", "_big").alias("_a"), F.greatest("_small", "_big").alias("_b"), "_small", "_big")
    both = both.join(either, ["_a", "_b"]).select(
        "_small", "_big", F.when(F.col("_small") == F.col("_a"), F.col("_ma")).otherwise(F.col("_mb")).alias("_m"))
    rest = meets.where("not _met").select("_f", "_e", "_m")
    walk = (asked.join(rest.withColumnRenamed("_e", "_small"), "_small")
            .join(rest.select("_f", F.col("_e").alias("_big")), ["_big", "_f"], "left_semi").select("_small", "_big", "_m"))
    return both.union(walk).groupBy("_small", "_big").agg(F.sum("_m").alias("overlap"))


# ---------------------------------------------------------------- k-means ---

def initial_centroids(incidence: DataFrame, entities: DataFrame, k: int, seed: int,
                      entity_col: str = "entity", feature_col: str = "feature"
                      ) -> tuple[DataFrame, DataFrame]:
    """k sampled entities; returns (clusters(cluster, centroid), weights(cluster, feature, w)).

    The k-row sample is computed once and broadcast (bounded by k)."""
    picked = saved(sample_keys(entities, entity_col, k, seed, "cluster"), "kmeans-picked")
    clusters = picked.select("cluster", F.col(entity_col).alias("centroid"))
    weights = (incidence.join(F.broadcast(picked), entity_col)
               .select("cluster", feature_col, F.lit(UNIT).cast("long").alias("w")))
    return clusters, weights


def assign(incidence: DataFrame, counts: DataFrame, clusters: DataFrame, weights: DataFrame,
           k: int, entity_col: str = "entity", feature_col: str = "feature") -> DataFrame:
    """Nearest centroid of every entity in ``counts`` → (entity, cluster, d2_scaled).

    Ties go to the smaller cluster ordinal (the earlier drawn centroid). The
    argmin is a plain ``min`` over the exact decimal ``score·k + ordinal`` (room
    for scores of 28 digits), so it runs as a hash aggregate with map-side
    partials: an entity with a large part of all rows costs k rows per task. The
    joins' sides are chosen by AQE from the sizes it measures.
    """
    norms = (clusters.select("cluster")
             .join(weights.groupBy("cluster").agg(F.sum(F.col("w") * F.col("w")).alias("s2")),
                   "cluster", "left")
             .select("cluster", F.coalesce("s2", F.lit(0)).cast("long").alias("s2")))

    def pack(score, cluster):
        return (score.cast("decimal(20,0)") * F.lit(k).cast("decimal(10,0)") + cluster).cast("decimal(38,0)")

    # Best centroid the entity shares no feature with: its score is the bare
    # norm, so it is the overall smallest (norm, ordinal) - if that centroid
    # does share a feature, its true score is strictly lower and already in
    # ``best``. One scalar over k rows, no entity × centroid product.
    fallback = norms.agg(F.min(pack(F.col("s2"), F.col("cluster")))).scalar()

    joined = incidence.join(weights.select(feature_col, "cluster", "w"), feature_col)
    dots = joined.groupBy(entity_col, "cluster").agg(F.sum("w").alias("dot"))
    scored = dots.join(F.broadcast(norms), "cluster").select(
        entity_col, pack(F.col("s2") - 2 * UNIT * F.col("dot"), F.col("cluster")).alias("p"))
    best = scored.groupBy(entity_col).agg(F.min("p").alias("best"))
    e = counts.join(best, entity_col, "left").withColumn("_choice", F.least(F.col("best"), fallback))
    e = e.withColumn("cluster", F.pmod("_choice", F.lit(k).cast("decimal(10,0)")))
    score = F.expr(f"(_choice - cluster) div {k}")
    return e.select(entity_col, F.col("cluster").cast("int").alias("cluster"),
                    (F.col("n") * SCALE + score).cast("long").alias("d2_scaled"))


def update_centroids(incidence: DataFrame, assignment: DataFrame, weights: DataFrame,
                     entity_col: str = "entity", feature_col: str = "feature") -> DataFrame:
    """Per (cluster, feature): share of members with the feature, rounded half
    up to 2 decimals, as hundredths. A cluster left without members keeps its
    previous weights."""
    sizes = assignment.groupBy("cluster").agg(F.count(F.lit(1)).alias("c"))
    members = assignment.select(entity_col, "cluster")
    have = (incidence.join(members, entity_col)
            .groupBy("cluster", feature_col).agg(F.count(F.lit(1)).alias("s")))
    w = F.expr(f"({2 * UNIT} * s + c) div (2 * c)")
    new = (have.join(F.broadcast(sizes), "cluster")
           .select("cluster", feature_col, w.cast("long").alias("w")).where(F.col("w") > 0))
    kept = weights.join(F.broadcast(sizes.select("cluster")), "cluster", "left_anti")
    return new.unionByName(kept)


def first_assignment(incidence: DataFrame, k: int, seed: int,
                     entities: DataFrame | None = None, entity_col: str = "entity",
                     feature_col: str = "feature"):
    """Start of Lloyd's algorithm: (incidence, counts, clusters, weights,
    assignment), each computed once. The incidence stays spread over (entity,
    feature), so an entity with a large part of the rows is split over tasks."""
    inc = saved(incidence.select(entity_col, feature_col).distinct(), "kmeans-incidence")
    counts = saved(feature_counts(inc, entities, entity_col), "kmeans-counts")
    clusters, weights = initial_centroids(inc, counts, k, seed, entity_col, feature_col)
    weights = saved(weights, "kmeans-weights")
    a = saved(assign(inc, counts, clusters, weights, k, entity_col, feature_col), "kmeans-assignment")
    return inc, counts, clusters, weights, a


def nearest_centroid(incidence: DataFrame, k: int, seed: int,
                     entities: DataFrame | None = None, entity_col: str = "entity",
                     feature_col: str = "feature") -> DataFrame:
    """One assignment pass from k sampled entities (the reference's first_iter):
    (entity, cluster, centroid, d2_scaled)."""
    _, _, clusters, _, a = first_assignment(incidence, k, seed, entities, entity_col,
                                            feature_col)
    return a.join(F.broadcast(clusters), "cluster").select(entity_col, "cluster", "centroid",
                                                           "d2_scaled")


def cluster_members(assignment: DataFrame, entity_col: str = "entity",
                    rank_col: str = "member_rank") -> DataFrame:
    """Members of each cluster in sorted order, as (cluster, …, entity, rank);
    the rank is computed without gathering a cluster into one task."""
    return contiguous_id(assignment, [entity_col], rank_col, group_cols=["cluster"])


# Bounds of the k-means passes are distances (not squared) in units of 1/1024 hundredth, rounded
# outwards to whole numbers, so that sums of bounds and drifts stay exact and safe.
_GRAIN = 1024


#: Up to so many clusters the sums of all of them are columns of one row per entity; beyond, rows per (entity, cluster).
WIDE = 64


# The passes' expressions are SQL text: they are rebuilt in every pass, and one text is one call to the JVM. Numbers that
# change from pass to pass stand in literal arrays, so the generated code is the same and compiled once.

def _numbers(values) -> str:
    return "array(" + ", ".join(f"{v}L" for v in values) + ")"


def _above_sql(squared: str) -> str:
    return f"cast(ceil(sqrt(cast({squared} AS double)) * {_GRAIN}) + 1 AS bigint)"


def _below_sql(squared: str) -> str:
    return f"cast(floor(sqrt(cast({squared} AS double)) * {_GRAIN}) - 1 AS bigint)"


_CANDIDATES = "array<struct<score:bigint,cluster:int>>"


def _candidate(score: str, cluster: str) -> str:
    return f"named_struct('score', cast({score} AS bigint), 'cluster', cast({cluster} AS int))"


def _two_nearest(held: DataFrame, joined: DataFrame, norms: list[int], entity_col: str) -> DataFrame:
    """``held`` with ``cands``: the smallest (score, cluster) among centroids that share a feature with the entity.

    ``joined(entity, _c, _w)`` are the weights that the entity's features meet. Up to ``WIDE`` clusters
    one aggregate gives all sums and carries the held row along: one shuffle of partially summed rows.
    """
    k, kept = len(norms), [c for c in held.columns if c != entity_col]
    if k <= WIDE:
        sums = ", ".join(f"sum(if(_c = {c}, _w, null))" for c in range(k))
        rows = held.unionByName(joined, allowMissingColumns=True).groupBy(entity_col).agg(
            *(F.expr(f"max({c}) AS {c}") for c in kept), F.expr(f"array({sums}) AS _dots"))
        at = _candidate(f"get({_numbers(norms)}, c) - {2 * UNIT} * dot", "c")
        return rows.withColumn("cands", F.expr(
            f"filter(transform(_dots, (dot, c) -> if(dot is null, null, {at})), x -> x is not null)")).drop("_dots")
    dots = joined.groupBy(entity_col, "_c").agg(F.expr("sum(_w) AS dot"))
    scored = dots.select(entity_col, F.expr(_candidate(f"get({_numbers(norms)}, _c) - {2 * UNIT} * dot", "_c") + " AS at"))
    order = Window.partitionBy(entity_col).orderBy("at")  # at most k rows an entity
    two = scored.withColumn("_r", F.row_number().over(order)).where("_r <= 2").groupBy(entity_col).agg(
        F.collect_list("at").alias("cands"))
    return held.join(two, entity_col, "left")


def kmeans(incidence: DataFrame, k: int, seed: int, max_iter: int | None = None,
           entities: DataFrame | None = None, entity_col: str = "entity",
           feature_col: str = "feature", return_weights: bool = False, passes: list | None = None):
    """Lloyd's k-means from k sampled entities until no entity changes cluster.

    Returns (entity, cluster, d2_scaled, converged). ``converged`` is true for
    every row, unless the caller's ``max_iter`` centroid updates were used up
    first, or the rounded centroids came back to an assignment they had before
    without standing still (then no further pass can change that).

    A pass joins only entities that may move with the centroids. Each entity carries an upper bound of the
    distance to its centroid and a lower bound of the distance to all others; a pass loosens them by how far
    the centroids moved, and while upper < lower no other centroid can be as near (ties included). Member
    counts per feature are kept, and only the features of entities that moved change them. Bounds
    are whole numbers rounded outwards, so the result is that of unpruned passes, value for value. A pass
    writes two tables and deletes those before it; what the loop must know (k norms, drifts and sizes, whether
    an entity moved) is observed while they are written. ``passes`` collects (entities that moved,
    entities that were joined) per pass.
    """
    inc = saved(incidence.select(entity_col, feature_col).distinct(), "kmeans-incidence")
    counts = saved(feature_counts(inc, entities, entity_col), "kmeans-counts")
    clusters, weights = initial_centroids(inc, counts, k, seed, entity_col, feature_col)
    k = clusters.count()  # fewer where there are fewer entities

    def written(df: DataFrame, name: str, totals: dict[str, str], sums: dict[str, str]):
        """The written table; ``totals`` over all its rows; ``sums`` of whole numbers, one list by cluster each."""
        seen = Observation()
        wide = {f"{n}{c}": f"sum(if(cluster = {c}, {x}, null))" for n, x in sums.items() for c in range(k)} if k <= WIDE else {}
        table = saved(df.observe(seen, F.count(F.lit(1)).alias("rows"),
                                 *(F.expr(f"{x} AS {n}") for n, x in {**totals, **wide}.items())), name)
        found = seen.get
        if wide:
            by = {n: [found[f"{n}{c}"] or 0 for c in range(k)] for n in sums}
        else:
            rows = {r["cluster"]: r for r in table.groupBy("cluster").agg(*(F.expr(f"sum({x}) AS {n}") for n, x in sums.items())).collect()}
            by = {n: [rows[c][n] or 0 if c in rows else 0 for c in range(k)] for n in sums}
        return table, found, by

    name = f"`{entity_col}`"
    unknown = "cast(null AS bigint)"

    def state_of(held: DataFrame, w: DataFrame, norms: list[int]):
        """``held(entity, n, was, upper, lower, fresh)`` with its cluster; only ``fresh`` entities are joined and get new bounds."""
        joined = inc.join(held.where("fresh").select(entity_col), entity_col).join(
            w.selectExpr(f"`{feature_col}`", "cluster AS _c", "w AS _w"), feature_col).select(entity_col, "_c", "_w")
        # a centroid that an entity shares no feature with scores its bare norm: the two smallest stand for all
        low = "array(" + ", ".join(_candidate(f"{v}L", str(c)) for v, c in sorted((v, c) for c, v in enumerate(norms))[:2]) + ")"
        near = _two_nearest(held, joined, norms, entity_col).selectExpr(
            "*", f"concat(coalesce(cands, cast(array() AS {_CANDIDATES})), {low}) AS _all")
        near = near.selectExpr("*", "array_min(_all) AS _near", "array_min(filter(_all, x -> x.cluster <> array_min(_all).cluster)) AS _next")
        out = near.selectExpr(
            name, "n", "if(fresh, _near.cluster, was) AS cluster", "was",
            f"if(fresh, {_above_sql(f'{SCALE} * n + _near.score')}, upper) AS upper",
            f"if(fresh, {_below_sql(f'{SCALE} * n + _next.score')}, lower) AS lower", "fresh")
        table, found, by = written(out, "kmeans-state", {
            "mark": f"bit_xor(xxhash64({name}, cluster))", "sum": f"sum(cast(xxhash64({name}, cluster) AS decimal(38,0)))",
            "moved": "count_if(cluster <> was)", "joined": "count_if(fresh)"}, {"size": "1L"})
        if passes is not None:
            passes.append((found["moved"], found["joined"]))
        return table, found["moved"], (found["mark"], found["sum"]), by["size"]

    if not k:
        weights = saved(weights, "kmeans-weights")
        out = counts.selectExpr(name, "cast(null AS int) AS cluster", f"{unknown} AS d2_scaled", "true AS converged")
        return (out, weights) if return_weights else out
    # cluster, feature, s members with the feature, weight w
    table, _, by = written(weights.select("cluster", feature_col, F.lit(0).cast("long").alias("s"), "w"), "kmeans-centroids",
                           {}, {"norm": "w * w"})
    state, _, mark, sizes = state_of(counts.selectExpr(
        name, "n", "-1 AS was", f"{unknown} AS upper", f"{unknown} AS lower", "true AS fresh"), table, by["norm"])
    seen, converged, done = {mark}, False, 0
    while not converged and (max_iter is None or done < max_iter):
        done += 1
        # centroids: member counts change by the features of entities that moved
        movers = state.where("cluster <> was").selectExpr(
            name, "inline(array(struct(cluster, 1L AS s), struct(was AS cluster, -1L AS s)))").where("cluster >= 0")
        change = inc.join(movers, entity_col).selectExpr("cluster", f"`{feature_col}`", "s", f"{unknown} AS w")
        new = table.select("cluster", feature_col, "s", "w").union(change).groupBy("cluster", feature_col).agg(
            F.expr("sum(s) AS s"), F.expr("coalesce(max(w), 0L) AS w0"))
        new = new.selectExpr("*", f"get({_numbers(sizes)}, cluster) AS c").selectExpr(
            "cluster", f"`{feature_col}`", "s", f"if(c = 0, w0, ({2 * UNIT} * s + c) div (2 * greatest(c, 1L))) AS w", "w0")
        new, _, by = written(new.where("s > 0 or w > 0 or w0 > 0"), "kmeans-centroids", {},
                             {"norm": "w * w", "gap": "(w - w0) * (w - w0)"})
        drift = [math.ceil(math.sqrt(g) * _GRAIN) + 1 if g else 0 for g in by["gap"]]
        top = sorted(((v, c) for c, v in enumerate(drift)), reverse=True)[:2]
        other = [next((v for v, o in top if o != c), 0) for c in range(k)]
        held = state.selectExpr(name, "n", "cluster AS was", f"upper + get({_numbers(drift)}, cluster) AS upper",
                                f"lower - get({_numbers(other)}, cluster) AS lower").selectExpr(
            "*", "coalesce(upper >= lower, false) AS fresh")
        nxt, moved, mark, sizes = state_of(held, new.where("w > 0"), by["norm"])
        forget(state, table)
        state, table, converged = nxt, new, not moved
        if not converged and mark in seen:
            break
        seen.add(mark)
    weights = table.where("w > 0").select("cluster", feature_col, "w")
    # exact distances, to each entity's own centroid only
    own = inc.join(state.select(entity_col, "cluster"), entity_col).join(weights, ["cluster", feature_col])
    dots = own.groupBy(entity_col).agg(F.sum("w").alias("dot"))
    out = state.join(dots, entity_col, "left").selectExpr(
        name, "cluster", f"{SCALE} * n + get({_numbers(by['norm'])}, cluster) - {2 * UNIT} * coalesce(dot, 0L) AS d2_scaled",
        f"{str(converged).lower()} AS converged")
    out = saved(out, "kmeans-result")
    forget(inc, counts, state)
    return (out, weights) if return_weights else out
