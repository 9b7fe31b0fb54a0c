"""Derived inputs built from the driver's tables.

Each view is defined twice, once as a DataFrame (what the engine runs) and once
as DuckDB SQL (what the oracle runs); the two must stay identical in meaning.

* ``docs``     - documents with ``source`` blanked when ``doc_id % 3 = 0``
                 (the tree table: a name column that may be empty);
* ``ratings``  - (userId, itemId, rating 1..5) per customer × supplier pair;
* ``train``/``test`` - seeded 80/20 hash split of ``ratings``;
* ``basket``   - (b, i): distinct order × part type (market baskets);
* ``inc``      - (entity, feature): nation × part bought there;
* ``inc2``     - (entity, feature): customer × part brand;
* ``parts97``/``parts98`` - parts shipped in 1997 / 1998, as text that may be empty;
* ``seen_train``/``unseen_test`` - the split with every tenth user and item kept from training;
* ``brands`` - (b, i): distinct order × part brand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.split import hash_split
from quarry.sources.tables import load_table

SPLIT_SEED = 123
TRAIN_PERCENT = 80


def docs(spark: SparkSession, d: str) -> DataFrame:
    t = load_table(spark, d, "documents")
    blank = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("source"))
    return t.select("doc_id", blank.alias("source"))


def ratings(spark: SparkSession, d: str) -> DataFrame:
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    o = load_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy("o_custkey", "l_suppkey")
            .agg(((F.sum(F.col("l_quantity").cast("int")) % 5) + 1).cast("int").alias("rating"))
            .select(F.col("o_custkey").cast("long").alias("userId"),
                    F.col("l_suppkey").cast("long").alias("itemId"), "rating"))


def train_test(spark: SparkSession, d: str, reuse: bool = False) -> tuple[DataFrame, DataFrame]:
    """Seeded 80/20 split of ``ratings``. With ``reuse`` the ratings join and
    aggregation run once (written) for the several branches that read them."""
    return hash_split(ratings(spark, d), ["userId", "itemId"], SPLIT_SEED, TRAIN_PERCENT, reuse)


def basket_pairs(spark: SparkSession, d: str, item: str = "p_type") -> DataFrame:
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = load_table(spark, d, "part").select("p_partkey", item)
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("b"), F.col(item).alias("i")).distinct())


def inc(spark: SparkSession, d: str) -> DataFrame:
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = load_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = load_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    return j.select(F.col("c_nationkey").cast("long").alias("entity"),
                    F.col("l_partkey").cast("string").alias("feature")).distinct()


def inc2(spark: SparkSession, d: str) -> DataFrame:
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = load_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    p = load_table(spark, d, "part").select("p_partkey", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, F.col("l_partkey") == p.p_partkey)
    return j.select(F.col("o_custkey").cast("long").alias("entity"),
                    F.col("p_brand").alias("feature")).distinct()


def parts_shipped(spark: SparkSession, d: str, year: int) -> DataFrame:
    """(name): the part of every line shipped in a year, as text; empty for every seventh part."""
    li = load_table(spark, d, "lineitem").select("l_partkey", "l_shipdate")
    lo, hi = f"{year}-01-01", f"{year + 1}-01-01"
    name = F.when(F.col("l_partkey") % 7 == 0, F.lit("")).otherwise(F.col("l_partkey").cast("string"))
    return li.where((F.col("l_shipdate") >= F.lit(lo).cast("timestamp_ntz"))
                    & (F.col("l_shipdate") < F.lit(hi).cast("timestamp_ntz"))).select(name.alias("name"))


def unseen_split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The split of ``train_test`` with every tenth user and item moved to the test side whole."""
    train, test = train_test(spark, d, reuse=True)
    held = (F.col("userId") % 10 == 0) | (F.col("itemId") % 10 == 0)
    return train.where(~held), test.unionByName(train.where(held))


def some_nations(spark: SparkSession, d: str) -> DataFrame:
    """(entity): the nations of the dimension, those of region 0 left out."""
    n = load_table(spark, d, "nation").where("n_regionkey <> 0")
    return n.select(F.col("n_nationkey").cast("long").alias("entity"))


# DuckDB forms of the same views, used as CTEs by the oracle SQL.
SQL = {
    "docs": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS source FROM documents",
    "ratings": (
        "SELECT CAST(o_custkey AS BIGINT) AS userId, CAST(l_suppkey AS BIGINT) AS itemId, "
        "CAST((SUM(CAST(trunc(l_quantity) AS INTEGER)) % 5) + 1 AS INTEGER) AS rating "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey"),
    "train": (
        f"SELECT * FROM ratings WHERE ('0x' || substr(md5('{SPLIT_SEED}:' || userId || ':' || itemId), 1, 8))"
        f"::BIGINT % 100 < {TRAIN_PERCENT}"),
    "test": (
        f"SELECT * FROM ratings WHERE ('0x' || substr(md5('{SPLIT_SEED}:' || userId || ':' || itemId), 1, 8))"
        f"::BIGINT % 100 >= {TRAIN_PERCENT}"),
    "basket": ("SELECT DISTINCT l_orderkey AS b, p_type AS i FROM lineitem "
               "JOIN part ON l_partkey = p_partkey"),
    "inc": ("SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS entity, CAST(l_partkey AS VARCHAR) AS feature "
            "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"),
    "inc2": ("SELECT DISTINCT CAST(o_custkey AS BIGINT) AS entity, p_brand AS feature "
             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"),
    **{f"parts{y % 100}": (
        "SELECT CASE WHEN l_partkey % 7 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS name FROM lineitem "
        f"WHERE l_shipdate >= TIMESTAMP '{y}-01-01' AND l_shipdate < TIMESTAMP '{y + 1}-01-01'") for y in (1997, 1998)},
    "seen_train": "SELECT * FROM train WHERE userId % 10 <> 0 AND itemId % 10 <> 0",
    "unseen_test": ("SELECT * FROM test UNION ALL SELECT * FROM train WHERE userId % 10 = 0 OR itemId % 10 = 0"),
    "brands": "SELECT DISTINCT l_orderkey AS b, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey",
}

# Views each one depends on, in definition order.
_DEPS = {"train": ["ratings"], "test": ["ratings"], "seen_train": ["ratings", "train"],
         "unseen_test": ["ratings", "train", "test"]}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the named views (and their inputs)."""
    order: list[str] = []
    for n in names:
        for dep in _DEPS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def rating_records(spark: SparkSession, d: str) -> DataFrame:
    """Ratings with a day-resolution timestamp (seconds since 1970 of the
    pair's latest order day), the four fields of a ``::`` rating record."""
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    o = load_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    day = F.datediff(F.max("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return (j.groupBy("o_custkey", "l_suppkey")
            .agg(((F.sum(F.col("l_quantity").cast("int")) % 5) + 1).cast("int").alias("rating"),
                 (day.cast("long") * 86400).alias("timestamp"))
            .select(F.col("o_custkey").cast("long").alias("userId"),
                    F.col("l_suppkey").cast("long").alias("itemId"), "rating", "timestamp"))


def nation_pairs(spark: SparkSession, d: str) -> DataFrame:
    """(entity_a, entity_b): customer nation × supplier nation of every sale."""
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = load_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = load_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = load_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
         .join(s, F.col("l_suppkey") == s.s_suppkey))
    return j.select(F.col("c_nationkey").cast("long").alias("entity_a"),
                    F.col("s_nationkey").cast("long").alias("entity_b")).distinct()


def supplier_part_probes(spark: SparkSession, d: str) -> DataFrame:
    """(entity, feature): supplier nation × part of every sale."""
    li = load_table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    s = load_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .select(F.col("s_nationkey").cast("long").alias("entity"),
                    F.col("l_partkey").cast("string").alias("feature")).distinct())


SQL.update({
    "rating_records": (
        "SELECT CAST(o_custkey AS BIGINT) AS userId, CAST(l_suppkey AS BIGINT) AS itemId, "
        "CAST((SUM(CAST(trunc(l_quantity) AS INTEGER)) % 5) + 1 AS INTEGER) AS rating, "
        "CAST(datediff('day', DATE '1970-01-01', CAST(max(o_orderdate) AS DATE)) AS BIGINT) * 86400 "
        "AS timestamp FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        "GROUP BY o_custkey, l_suppkey"),
    "nation_pairs": (
        "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS entity_a, CAST(s_nationkey AS BIGINT) AS entity_b "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        "JOIN supplier ON l_suppkey = s_suppkey"),
    "probes": (
        "SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS entity, CAST(l_partkey AS VARCHAR) AS feature "
        "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"),
})
