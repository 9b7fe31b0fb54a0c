"""Generators of the longer DuckDB oracle statements (itemsets, k-means).

These are test oracles only: plain SQL that recomputes, step by step, what the
Spark operators compute, so that the driver can compare the two.
"""

from __future__ import annotations


def itemsets_cte(basket: str = "basket", support: float = 0.1, max_size: int = 6) -> str:
    """CTEs ``nb`` (basket count) and ``fi`` (frequent itemsets as sorted lists).

    ``max_size`` must be no less than the largest basket: 6 part types, and an
    order has at most 7 lines.
    """
    parts = [f"nb AS (SELECT count(DISTINCT b) AS n FROM {basket})",
             "mc AS (SELECT ceil(CAST(" + repr(float(support)) + " AS DOUBLE) * n) AS m FROM nb)"]
    levels = []
    for m in range(1, max_size + 1):
        al = [f"t{j}" for j in range(m)]
        sel = ", ".join(f"{a}.i" for a in al)
        frm = f"{basket} t0" + "".join(
            f" JOIN {basket} t{j} ON t{j}.b = t0.b AND t{j}.i > t{j - 1}.i" for j in range(1, m))
        parts.append(
            f"s{m} AS (SELECT [{sel}] AS items, count(*) AS freq FROM {frm} "
            f"GROUP BY {sel} HAVING count(*) >= (SELECT m FROM mc))")
        levels.append(f"SELECT items, freq FROM s{m}")
    parts.append("fi AS (" + " UNION ALL ".join(levels) + ")")
    return ",\n".join(parts)


def rules_cte(confidence: float = 0.3) -> str:
    """CTE ``ru`` of single-consequent rules from ``fi``."""
    ante = "list_concat(c.items[1:c.pos - 1], c.items[c.pos + 1:])"
    return (
        "cand AS (SELECT items, freq, generate_subscripts(items, 1) AS pos FROM fi "
        "WHERE len(items) >= 2),\n"
        f"ru AS (SELECT {ante} AS antecedent, c.items[c.pos] AS consequent, "
        f"c.freq / a.freq AS confidence FROM cand c JOIN fi a ON a.items = {ante} "
        f"WHERE c.freq / a.freq >= CAST({float(confidence)!r} AS DOUBLE))")


# ---------------------------------------------------------------- k-means ---

def _kmeans_head(inc: str, k: int, seed: int) -> list[str]:
    return [
        f"E AS (SELECT entity, count(*) AS n FROM {inc} GROUP BY entity)",
        ("S AS (SELECT entity AS centroid, CAST(rn - 1 AS INTEGER) AS cluster FROM "
         f"(SELECT entity, row_number() OVER (ORDER BY md5('{seed}:' || CAST(entity AS VARCHAR)), entity)"
         f" AS rn FROM E) WHERE rn <= {k})"),
        "K AS (SELECT cluster FROM S)",
        f"W0 AS (SELECT S.cluster, I.feature, CAST(100 AS BIGINT) AS w FROM {inc} I JOIN S ON I.entity = S.centroid)",
    ]


def _assign(inc: str, w: str, a: str) -> list[str]:
    score = "E.n * 10000 + C.s2 - 200 * coalesce(D.dot, 0)"
    return [
        (f"C_{a} AS (SELECT K.cluster, CAST(coalesce(sum(W.w * W.w), 0) AS BIGINT) AS s2 "
         f"FROM K LEFT JOIN {w} W USING (cluster) GROUP BY K.cluster)"),
        (f"D_{a} AS (SELECT I.entity, W.cluster, sum(W.w) AS dot FROM {inc} I JOIN {w} W "
         "USING (feature) GROUP BY I.entity, W.cluster)"),
        (f"{a} AS (SELECT entity, cluster, d2_scaled FROM (SELECT E.entity, C.cluster, "
         f"CAST({score} AS BIGINT) AS d2_scaled, row_number() OVER (PARTITION BY E.entity "
         f"ORDER BY {score}, C.cluster) AS rk FROM E CROSS JOIN C_{a} C LEFT JOIN D_{a} D "
         "ON D.entity = E.entity AND D.cluster = C.cluster) WHERE rk = 1)"),
    ]


def _update(inc: str, a: str, w_prev: str, w: str) -> list[str]:
    val = "(200 * H.s + Z.c) // (2 * Z.c)"
    return [
        f"Z_{w} AS (SELECT cluster, count(*) AS c FROM {a} GROUP BY cluster)",
        (f"H_{w} AS (SELECT A.cluster, I.feature, count(*) AS s FROM {a} A JOIN {inc} I "
         "USING (entity) GROUP BY A.cluster, I.feature)"),
        (f"{w} AS (SELECT H.cluster, H.feature, CAST({val} AS BIGINT) AS w FROM H_{w} H "
         f"JOIN Z_{w} Z USING (cluster) WHERE {val} > 0 UNION ALL SELECT P.cluster, P.feature, P.w "
         f"FROM {w_prev} P WHERE P.cluster NOT IN (SELECT cluster FROM Z_{w}))"),
    ]


def kmeans_ctes(inc: str, k: int, seed: int, updates: int) -> tuple[list[str], str, str]:
    """CTEs for ``updates`` Lloyd passes; returns (ctes, final assignment, final weights)."""
    ctes = _kmeans_head(inc, k, seed)
    ctes += _assign(inc, "W0", "A0")
    for t in range(1, updates + 1):
        ctes += _update(inc, f"A{t - 1}", f"W{t - 1}", f"W{t}")
        ctes += _assign(inc, f"W{t}", f"A{t}")
    return ctes, f"A{updates}", f"W{updates}"
