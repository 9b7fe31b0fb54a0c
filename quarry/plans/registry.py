"""Registered queries on the driver's tables and their DuckDB oracles.

``QUERIES[key](spark, sf_dir) -> DataFrame`` runs the operator over whole
tables; ``ORACLE[key]`` is SQL over the same parquet tables (absent where an
iterative or model-fitting operator has no SQL form).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import tabular
from quarry.operators.ids import contiguous_id, first_n_with_id
from quarry.plans import views as V
from quarry.sources.tables import load_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# --------------------------------------------------------------- tabular ---

@register("row_count", "SELECT count(*) AS n FROM lineitem")
def q_row_count(spark, d):
    return tabular.row_count(load_table(spark, d, "lineitem"))


@register("nonempty_count", V.with_views(
    "SELECT count(*) AS n FROM docs WHERE source IS NOT NULL AND source <> ''", "docs"))
def q_nonempty_count(spark, d):
    return tabular.nonempty_count(V.docs(spark, d), "source")


@register("distinct_values", V.with_views(
    "SELECT DISTINCT source FROM docs WHERE source IS NOT NULL AND source <> '' ORDER BY source",
    "docs"))
def q_distinct_values(spark, d):
    return tabular.distinct_values(V.docs(spark, d), "source")


@register("value_counts", V.with_views(
    "SELECT source, count(*) AS count FROM docs WHERE source IS NOT NULL AND source <> '' "
    "GROUP BY source ORDER BY source", "docs"))
def q_value_counts(spark, d):
    return tabular.value_counts(V.docs(spark, d), "source")


@register("topk_counts",
          "SELECT p_name, count(*) AS count FROM part WHERE p_name IS NOT NULL AND p_name <> '' "
          "GROUP BY p_name ORDER BY count DESC, p_name ASC LIMIT 10")
def q_topk_counts(spark, d):
    return tabular.topk_counts(load_table(spark, d, "part"), "p_name", 10)


@register("intersect_values", V.with_views(
    "SELECT name FROM parts97 WHERE name <> '' INTERSECT SELECT name FROM parts98 WHERE name <> ''",
    "parts97", "parts98"))
def q_intersect_values(spark, d):
    return tabular.intersect_values(V.parts_shipped(spark, d, 1997),
                                    V.parts_shipped(spark, d, 1998), "name")


@register("contiguous_id",
          "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS id, o_orderkey, o_custkey FROM orders")
def q_contiguous_id(spark, d):
    o = load_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return contiguous_id(o, ["o_orderkey"]).select("id", "o_orderkey", "o_custkey")


# --------------------------------------------------------- sources, sinks ---

from quarry import sources as S  # noqa: E402
from quarry.functions.exprs import csv_line, exact_avg, exact_rmse, hash_bucket, joined, rmse_expr  # noqa: E402
from quarry.operators import bitmaps as B  # noqa: E402
from quarry.operators import cluster as M  # noqa: E402
from quarry.operators import dense as D  # noqa: E402
from quarry.operators import itemsets as FI  # noqa: E402
from quarry.operators import recommend as R  # noqa: E402
from quarry.operators import split as SP  # noqa: E402
from quarry.plans import oracle_sql as OS  # noqa: E402
from quarry.session import materialize, saved, scratch_path  # noqa: E402
from quarry.sources.dimensions import STATE_CODES, entity_dimension  # noqa: E402


@register("src_header_csv", "SELECT * FROM supplier")
def q_src_header_csv(spark, d):
    sup = load_table(spark, d, "supplier")
    path = scratch_path(spark, "supplier-csv")
    S.write_header_csv(sup, path)
    return S.read_header_csv(spark, path, schema=sup.schema)


@register("src_delimited_records", V.with_views("SELECT * FROM rating_records", "rating_records"))
def q_src_delimited_records(spark, d):
    path = scratch_path(spark, "ratings-records")
    S.write_delimited_records(V.rating_records(spark, d), path, "::")
    fields = [("userId", "bigint"), ("itemId", "bigint"), ("rating", "int"), ("timestamp", "bigint")]
    return S.read_delimited_records(spark, path, fields, "::", mode="fail")


# Rating records with damage by their ids: a rating that is no number, a user id beyond 64 bits, a missing field.
_DAMAGED = ("SELECT *, CASE WHEN userId % 11 = 0 THEN CAST(userId AS VARCHAR) || '::' || CAST(itemId AS VARCHAR) "
            "WHEN itemId % 13 = 0 THEN '99999999999999999999::' || CAST(itemId AS VARCHAR) || '::' || CAST(rating AS VARCHAR) "
            "|| '::' || CAST(timestamp AS VARCHAR) WHEN userId % 7 = 0 THEN CAST(userId AS VARCHAR) || '::' || "
            "CAST(itemId AS VARCHAR) || '::x::' || CAST(timestamp AS VARCHAR) END AS line, "
            "CASE WHEN userId % 11 = 0 THEN 'too few fields' WHEN itemId % 13 = 0 THEN 'out of range' "
            "WHEN userId % 7 = 0 THEN 'not a value' END AS reason, CASE WHEN userId % 11 = 0 THEN NULL "
            "WHEN itemId % 13 = 0 THEN 'userId' WHEN userId % 7 = 0 THEN 'rating' END AS field FROM rating_records")
_RECORD_FIELDS = [("userId", "bigint"), ("itemId", "bigint"), ("rating", "int"), ("timestamp", "bigint")]


def _parsed_damaged(spark, d):
    text = {n: F.col(n).cast("string") for n, _ in _RECORD_FIELDS}
    r = V.rating_records(spark, d)
    short, far, wrong = (F.col("userId") % 11 == 0, F.col("itemId") % 13 == 0, F.col("userId") % 7 == 0)
    line = (F.when(short, F.concat_ws("::", text["userId"], text["itemId"]))
            .when(far, F.concat_ws("::", F.lit("9" * 20), text["itemId"], text["rating"], text["timestamp"]))
            .when(wrong, F.concat_ws("::", text["userId"], text["itemId"], F.lit("x"), text["timestamp"]))
            .otherwise(F.concat_ws("::", *text.values())))
    path = scratch_path(spark, "damaged-records")
    r.select(line.alias("value")).write.text(path)
    return S.parse_delimited_records(spark, path, _RECORD_FIELDS)


@register("src_records_rejects", V.with_views(
    f"SELECT CASE WHEN reason IS NULL THEN userId END AS userId, CASE WHEN reason IS NULL THEN itemId END AS itemId, "
    "CASE WHEN reason IS NULL THEN rating END AS rating, CASE WHEN reason IS NULL THEN timestamp END AS timestamp, "
    f"line, reason, field FROM ({_DAMAGED})", "rating_records"))
def q_src_records_rejects(spark, d):
    parsed = _parsed_damaged(spark, d)
    return parsed.good.unionByName(parsed.rejects.drop("file"), allowMissingColumns=True)


@register("src_records_counts", V.with_views(
    f"SELECT coalesce(reason, 'good') AS outcome, count(*) AS observed, count(*) AS found FROM ({_DAMAGED}) "
    "GROUP BY reason", "rating_records"))
def q_src_records_counts(spark, d):
    parsed = _parsed_damaged(spark, d)
    found = parsed.good.select(F.lit("good").alias("outcome")).union(parsed.rejects.select("reason"))
    # four numbers, from the same job that wrote the rows
    seen = F.create_map(*(F.lit(x) for pair in parsed.counts.items() for x in pair))
    return found.groupBy("outcome").agg(F.count(F.lit(1)).alias("found")).select(
        "outcome", seen[F.col("outcome")].cast("long").alias("observed"), "found")


@register("src_line_ids", V.with_views(
    "SELECT CAST(row_number() OVER (ORDER BY b) - 1 AS BIGINT) AS id, CAST(b AS VARCHAR) AS key, items FROM "
    "(SELECT b, string_agg(i, ',' ORDER BY i) AS items FROM basket GROUP BY b)", "basket"))
def q_src_line_ids(spark, d):
    path = scratch_path(spark, "baskets-ordered")
    b = FI.baskets_from_pairs(V.basket_pairs(spark, d), "b", "i")
    S.write_ragged_baskets(b.orderBy("b"), "b", "items", path)  # the files' lines are in the order of b
    lines = S.read_ragged_baskets(spark, path, keep_line_order=True)
    return S.with_line_ids(lines, "id").select("id", "key", F.array_join("items", ",").alias("items"))


@register("src_ragged_baskets", V.with_views(
    "SELECT CAST(b AS VARCHAR) AS key, string_agg(i, ',' ORDER BY i) AS items FROM basket GROUP BY b",
    "basket"))
def q_src_ragged_baskets(spark, d):
    path = scratch_path(spark, "baskets-ragged")
    b = FI.baskets_from_pairs(V.basket_pairs(spark, d), "b", "i")
    S.write_ragged_baskets(b, "b", "items", path)
    back = S.read_ragged_baskets(spark, path)
    return back.select("key", F.array_join("items", ",").alias("items"))


@register("csv_lines", V.with_views(
    "SELECT source || ',' || CAST(count(*) AS VARCHAR) AS line FROM docs "
    "WHERE source IS NOT NULL AND source <> '' GROUP BY source", "docs"))
def q_csv_lines(spark, d):
    vc = tabular.value_counts(V.docs(spark, d), "source")
    return vc.select(csv_line(vc).alias("line"))


@register("csv_lines_typed", (
    "WITH q AS (SELECT l_orderkey AS k, chr(39) AS a, l_returnflag AS f, CAST(trunc(l_quantity) AS BIGINT) AS n FROM lineitem) "
    "SELECT '[' || k || ', ' || (k + 1) || ', None],[' || a || f || a || ', None, \"l' || a || 'eau\", ' "
    "|| a || 'a' || chr(92) || chr(92) || 'b' || chr(92) || 'n' || a || '],' "
    "|| n || '0000000000.0,' || CASE WHEN n % 10 = 0 THEN CASE n WHEN 0 THEN '0.0' ELSE '0.000' || (n // 10) END ELSE "
    "CASE WHEN n < 10 THEN n || 'e-05' ELSE '0.000' || n END END || ',' || CASE WHEN n = 0 THEN '0.0' WHEN n < 10 THEN n || 'e+20' "
    "WHEN n % 10 = 0 THEN (n // 10) || 'e+21' ELSE (n // 10) || '.' || (n % 10) || 'e+21' END "
    "|| ',[' || n || '.5, None],None,' || CASE WHEN n > 20 THEN 'True' ELSE 'False' END || ',[]' AS line FROM q"))
def q_csv_lines_typed(spark, d):
    r = load_table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("k"), "l_returnflag", F.floor("l_quantity").alias("n"))
    n = F.col("n").cast("double")
    rows = r.select(
        F.array("k", F.col("k") + 1, F.lit(None).cast("long")).alias("ints"),
        F.array("l_returnflag", F.lit(None).cast("string"), F.lit("l'eau"), F.lit("a\\b\n")).alias("texts"),
        (n * 1e10).alias("large"), (n / 1e5).alias("small"), F.concat(F.col("n").cast("string"), F.lit("e20")).cast("double").alias("huge"),
        F.array(n + 0.5, F.lit(None).cast("double")).alias("floats"),
        F.lit(None).cast("string").alias("nothing"), (F.col("n") > 20).alias("flag"),
        F.array().cast("array<string>").alias("none"))
    return rows.select(csv_line(rows).alias("line"))


@register("csv_lines_empty", "SELECT '' AS line FROM supplier WHERE s_suppkey < 0")
def q_csv_lines_empty(spark, d):
    none = load_table(spark, d, "supplier").where("s_suppkey < 0")
    return none.select(csv_line(none).alias("line"))


@register("src_header_csv_quoted", (
    "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN s_name || ', the \"first\"' WHEN 1 THEN 'line' || chr(10) || s_name "
    "WHEN 2 THEN '\"' ELSE s_name END AS s_name, s_acctbal FROM supplier"))
def q_src_header_csv_quoted(spark, d):
    s = load_table(spark, d, "supplier")
    k = F.col("s_suppkey") % 4
    name = (F.when(k == 0, F.concat("s_name", F.lit(', the "first"'))).when(k == 1, F.concat(F.lit("line\n"), F.col("s_name")))
            .when(k == 2, F.lit('"')).otherwise(F.col("s_name")))
    rows = s.select("s_suppkey", name.alias("s_name"), "s_acctbal")
    path = scratch_path(spark, "supplier-quoted")
    S.write_header_csv(rows, path)
    return S.read_header_csv(spark, path, schema=rows.schema, multi_line=True)


# Names of the order priorities, rows of this program.
_URGENCY = [("1-URGENT", "at once"), ("2-HIGH", "soon"), ("5-LOW", "some day")]


@register("local_rows", "SELECT label, count(*) AS n FROM orders JOIN (VALUES " + ", ".join(
    f"('{p}', '{n}')" for p, n in _URGENCY) + ") v(p, label) ON o_orderpriority = p GROUP BY label")
def q_local_rows(spark, d):
    labels = spark.createDataFrame(_URGENCY, "o_orderpriority string, label string")
    return load_table(spark, d, "orders").join(labels, "o_orderpriority").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("entity_positions", V.with_views(
    "WITH dim AS (SELECT unnest(range(" + str(len(STATE_CODES)) + ")) AS ordinal, unnest([" + ", ".join(f"'{c}'" for c in STATE_CODES)
    + "]) AS entity) SELECT dim.entity, dim.ordinal, count(*) AS n FROM inc JOIN dim ON dim.ordinal = inc.entity * 3 "
    "GROUP BY dim.entity, dim.ordinal", "inc"))
def q_entity_positions(spark, d):
    """Entities given by position in a literal list: nation k is the code at 3k; positions beyond the list fall out."""
    dim = entity_dimension(spark)
    coded = V.inc(spark, d).select((F.col("entity") * 3).alias("ordinal"), "feature").join(dim, "ordinal")
    baskets = FI.baskets_from_pairs(coded, "feature", "entity", "entities")
    inc = M.incidence_from_baskets(baskets, "feature", "entities", dim)
    return M.feature_counts(inc).join(dim, "entity").select("entity", F.col("ordinal").cast("long").alias("ordinal"), "n")


# ------------------------------------------------------- splits, sampling ---

@register("hash_split", V.with_views(
    "SELECT 'train' AS part, count(*) AS n, CAST(sum(rating) AS BIGINT) AS rating_sum FROM train "
    "UNION ALL SELECT 'test' AS part, count(*) AS n, CAST(sum(rating) AS BIGINT) AS rating_sum FROM test",
    "train", "test"))
def q_hash_split(spark, d):
    side = F.when(hash_bucket(V.SPLIT_SEED, "userId", "itemId") < V.TRAIN_PERCENT, "train").otherwise("test")
    return V.ratings(spark, d).groupBy(side.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").cast("long").alias("rating_sum"))


@register("random_split", V.with_views(
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_shared_keys, true AS share_fits FROM ratings", "ratings"))
def q_random_split(spark, d):
    parts = SP.random_split(saved(V.ratings(spark, d), "ratings"), [0.8, 0.2], V.SPLIT_SEED)
    check = SP.split_check(parts, ["userId", "itemId"])
    # the training share is binomial: within five deviations of 0.8
    n = parts[0].agg(F.count(F.lit(1))).scalar()
    fits = F.abs(n - 0.8 * F.col("n_rows")) <= 5 * F.sqrt(0.16 * F.col("n_rows"))
    return check.withColumn("share_fits", fits)


# ------------------------------------------------------------ recommender ---

@register("global_mean", V.with_views("SELECT avg(rating) AS global_mean FROM train", "train"))
def q_global_mean(spark, d):
    train, _ = V.train_test(spark, d)
    return R.global_mean(train)


@register("group_means", V.with_views(
    "SELECT 'user' AS kind, userId AS id, avg(rating) AS mean FROM train GROUP BY userId "
    "UNION ALL SELECT 'item' AS kind, itemId AS id, avg(rating) AS mean FROM train GROUP BY itemId",
    "train"))
def q_group_means(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    u = R.group_means(train, "userId").select(F.lit("user").alias("kind"),
                                              F.col("userId").alias("id"), "mean")
    i = R.group_means(train, "itemId").select(F.lit("item").alias("kind"),
                                              F.col("itemId").alias("id"), "mean")
    return u.unionByName(i)


_BIAS_CTES = (
    "WITH um AS (SELECT userId, avg(rating) AS user_mean FROM train GROUP BY userId), "
    "im AS (SELECT itemId, avg(rating) AS item_mean FROM train GROUP BY itemId), "
    "gm AS (SELECT avg(rating) AS g FROM train) ")


@register("bias_interaction", V.with_views(
    _BIAS_CTES + "SELECT t.userId, t.itemId, CAST(t.rating AS DOUBLE) AS rating, um.user_mean, "
    "im.item_mean, round(t.rating - (um.user_mean + im.item_mean - gm.g), 9) AS user_item_interaction "
    "FROM train t JOIN im USING (itemId) JOIN um USING (userId) CROSS JOIN gm "
    "ORDER BY t.userId, t.itemId", "train"))
def q_bias_interaction(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    out = R.bias_interaction(train, "userId", "itemId", "rating")
    return out.withColumn("user_item_interaction", F.round("user_item_interaction", 9))


@register("global_mean_rmse", V.with_views(
    "SELECT round(sqrt(avg(pow(rating - g, 2))), 6) AS rmse FROM test "
    "CROSS JOIN (SELECT avg(rating) AS g FROM train)", "train", "test"))
def q_global_mean_rmse(spark, d):
    train, test = V.train_test(spark, d, reuse=True)
    return R.global_mean_rmse(train, test).select(F.round("rmse", 6).alias("rmse"))


@register("bias_rmse", V.with_views(
    _BIAS_CTES + "SELECT round(sqrt(avg(pow(um.user_mean + im.item_mean - gm.g - t.rating, 2))), 6) "
    "AS rmse FROM test t JOIN im USING (itemId) JOIN um USING (userId) CROSS JOIN gm",
    "train", "test"))
def q_bias_rmse(spark, d):
    train, test = V.train_test(spark, d, reuse=True)
    return R.bias_rmse(train, test).select(F.round("rmse", 6).alias("rmse"))


@register("bias_interaction_first", V.with_views(
    _BIAS_CTES + "SELECT row_number() OVER (ORDER BY t.userId, t.itemId) - 1 AS rank, t.userId, t.itemId, "
    "round(t.rating - (um.user_mean + im.item_mean - gm.g), 9) AS user_item_interaction "
    "FROM train t JOIN im USING (itemId) JOIN um USING (userId) CROSS JOIN gm "
    "ORDER BY rank LIMIT 25", "train"))
def q_bias_interaction_first(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    out = R.bias_interaction(train, ordered=False).select(
        "userId", "itemId", F.round("user_item_interaction", 9).alias("user_item_interaction"))
    return first_n_with_id(out, ["userId", "itemId"], 25, "rank").withColumn("rank", F.col("rank").cast("long"))


@register("bias_rmse_unseen", V.with_views(
    _BIAS_CTES.replace("FROM train", "FROM seen_train") + "SELECT count(*) AS n, "
    "round(sqrt(avg(pow(um.user_mean + im.item_mean - gm.g - t.rating, 2))), 6) AS rmse "
    "FROM unseen_test t JOIN im USING (itemId) JOIN um USING (userId) CROSS JOIN gm",
    "seen_train", "unseen_test"))
def q_bias_rmse_unseen(spark, d):
    train, test = V.unseen_split(spark, d)
    scored = R.bias_predictions(train, test, "userId", "itemId")
    return scored.agg(F.count(F.lit(1)).alias("n"),
                      F.round(rmse_expr("prediction", "rating"), 6).alias("rmse"))


@register("rmse", "SELECT round(sqrt(avg(pow(l_tax * 100 - l_quantity, 2))), 6) AS rmse FROM lineitem")
def q_rmse(spark, d):
    li = load_table(spark, d, "lineitem")
    return R.rmse(li.withColumn("_pred", F.col("l_tax") * 100), "_pred", "l_quantity") \
        .select(F.round("rmse", 6).alias("rmse"))


_FIXED = "CAST(sum(CAST(floor(({0}) * 1099511627776.0) AS BIGINT)) AS DOUBLE) / 1099511627776.0 / count(*)"


# The same metrics without any rounding: order-free sums give the same bits in both engines and on any partitioning.
@register("global_mean_rmse_exact", V.with_views(
    "SELECT sqrt(" + _FIXED.format("(g - rating) * (g - rating)") + ") AS rmse FROM test "
    "CROSS JOIN (SELECT avg(rating) AS g FROM train)", "train", "test"))
def q_global_mean_rmse_exact(spark, d):
    train, test = V.train_test(spark, d, reuse=True)
    mean = train.agg(exact_avg(F.col("rating"))).scalar()
    return test.withColumn("g", mean).agg(exact_rmse("g", "rating").alias("rmse"))


_PREDICTED = "(um.user_mean + im.item_mean - gm.g - t.rating)"


@register("bias_rmse_exact", V.with_views(
    _BIAS_CTES + "SELECT sqrt(" + _FIXED.format(f"{_PREDICTED} * {_PREDICTED}") + ") AS rmse FROM test t "
    "JOIN im USING (itemId) JOIN um USING (userId) CROSS JOIN gm", "train", "test"))
def q_bias_rmse_exact(spark, d):
    train, test = V.train_test(spark, d, reuse=True)
    return R.bias_predictions(train, test, "userId", "itemId").agg(exact_rmse("prediction", "rating").alias("rmse"))


@register("bias_interaction_exact", V.with_views(
    _BIAS_CTES + ", i AS (SELECT t.userId, t.rating - (um.user_mean + im.item_mean - gm.g) AS x FROM train t "
    "JOIN im USING (itemId) JOIN um USING (userId) CROSS JOIN gm) "
    "SELECT userId, " + _FIXED.format("x") + " AS mean_interaction, sqrt(" + _FIXED.format("x * x") + ") AS size FROM i GROUP BY userId",
    "train"))
def q_bias_interaction_exact(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    x = F.col("user_item_interaction")
    return R.bias_interaction(train, ordered=False).groupBy("userId").agg(
        exact_avg(x).alias("mean_interaction"), F.sqrt(exact_avg(x * x)).alias("size"))


@register("als_rmse")
def q_als_rmse(spark, d):
    train, test = V.train_test(spark, d, reuse=True)
    return R.als_rmse(train, test, seed=V.SPLIT_SEED)


@register("als_bias_rmse")
def q_als_bias_rmse(spark, d):
    train, test = V.train_test(spark, d, reuse=True)
    return R.als_bias_rmse(train, test, seed=V.SPLIT_SEED)


@register("als_solved", V.with_views("SELECT DISTINCT userId, true AS solved FROM train", "train"))
def q_als_solved(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    return R.als_solved(train, seed=V.SPLIT_SEED)


@register("als_bias_solved", V.with_views("SELECT DISTINCT userId, true AS solved FROM train", "train"))
def q_als_bias_solved(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    return R.als_bias_solved(train, seed=V.SPLIT_SEED)


@register("als_coverage", V.with_views(
    "SELECT count(*) AS n FROM unseen_test WHERE userId IN (SELECT userId FROM seen_train) "
    "AND itemId IN (SELECT itemId FROM seen_train)", "seen_train", "unseen_test"))
def q_als_coverage(spark, d):
    train, test = V.unseen_split(spark, d)
    return tabular.row_count(R.als_predictions(train, test, seed=V.SPLIT_SEED))


_STEPS = ("SELECT 'user' AS kind, userId AS id, 70 AS rank, true AS agrees FROM (SELECT DISTINCT userId FROM train) "
          "UNION ALL SELECT 'item', itemId, 70, true FROM (SELECT DISTINCT itemId FROM train)")


@register("als_steps", V.with_views(_STEPS, "train"))
def q_als_steps(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    return R.als_steps(train, seed=V.SPLIT_SEED)


@register("als_bias_steps", V.with_views(_STEPS, "train"))
def q_als_bias_steps(spark, d):
    train, _ = V.train_test(spark, d, reuse=True)
    return R.als_bias_steps(train, seed=V.SPLIT_SEED)


# ------------------------------------------------------ frequent itemsets ---

SUPPORT, CONFIDENCE = 0.1, 0.3


def ranked(first: DataFrame, order: list) -> DataFrame:
    """The rows of a first-n result with their rank, so that a comparison sees which n rows came."""
    return first.withColumn("rank", (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))


def _model(spark, d, reuse: bool = False):
    baskets = FI.baskets_from_pairs(V.basket_pairs(spark, d), "b", "i")
    if reuse:  # read twice: by the fit and by the basket count N
        baskets = materialize(baskets)
    return baskets, FI.fit_fpgrowth(baskets, "items", SUPPORT, CONFIDENCE)


@register("baskets", V.with_views(
    "SELECT CAST(row_number() OVER (ORDER BY b) - 1 AS BIGINT) AS id, b AS key, items FROM "
    "(SELECT b, string_agg(i, ',' ORDER BY i) AS items FROM basket GROUP BY b)", "basket"))
def q_baskets(spark, d):
    b = FI.baskets_from_pairs(V.basket_pairs(spark, d), "b", "i").withColumnRenamed("b", "key")
    t = FI.basket_table(b, "key", "items")
    return t.select("id", "key", F.array_join("items", ",").alias("items"))


@register("frequent_itemsets", V.with_views(
    "WITH " + OS.itemsets_cte("basket", SUPPORT) +
    " SELECT array_to_string(items, ',') AS items, freq FROM fi", "basket"))
def q_frequent_itemsets(spark, d):
    _, model = _model(spark, d)
    f = FI.frequent_itemsets(model)
    return f.select(joined("items").alias("items"), "freq")


@register("frequent_itemsets_brands", V.with_views(
    "WITH " + OS.itemsets_cte("brands", 0.01, 7) +
    " SELECT array_to_string(items, ',') AS items, freq FROM fi", "brands"))
def q_frequent_itemsets_brands(spark, d):
    baskets = FI.baskets_from_pairs(V.basket_pairs(spark, d, "p_brand"), "b", "i")
    f = FI.frequent_itemsets(FI.fit_fpgrowth(baskets, "items", 0.01, CONFIDENCE))
    return f.select(joined("items").alias("items"), "freq")


@register("frequent_itemsets_first", V.with_views(
    "WITH " + OS.itemsets_cte("basket", SUPPORT) +
    " SELECT row_number() OVER (ORDER BY len(items) DESC, freq DESC, array_to_string(items, ',')) - 1 AS rank, "
    "array_to_string(items, ',') AS items, freq FROM fi ORDER BY rank LIMIT 12", "basket"))
def q_frequent_itemsets_first(spark, d):
    _, model = _model(spark, d)
    return ranked(FI.frequent_itemsets(model, 12).select(F.size("items").alias("size"), joined("items").alias("items"), "freq"),
                  [F.desc("size"), F.desc("freq"), F.asc("items")]).drop("size")


@register("association_rules_first", V.with_views(
    "WITH " + OS.itemsets_cte("basket", SUPPORT) + ",\n" + OS.rules_cte(CONFIDENCE) +
    " SELECT row_number() OVER (ORDER BY len(antecedent) DESC, confidence DESC, array_to_string(antecedent, ','), "
    "consequent) - 1 AS rank, array_to_string(antecedent, ',') AS antecedent, consequent, confidence "
    "FROM ru ORDER BY rank LIMIT 15", "basket"))
def q_association_rules_first(spark, d):
    _, model = _model(spark, d)
    first = FI.association_rules(model, 15).select(
        F.size("antecedent").alias("size"), joined("antecedent").alias("antecedent"),
        joined("consequent").alias("consequent"), "confidence")
    return ranked(first, [F.desc("size"), F.desc("confidence"), F.asc("antecedent"), F.asc("consequent")]).drop("size")


@register("association_rules", V.with_views(
    "WITH " + OS.itemsets_cte("basket", SUPPORT) + ",\n" + OS.rules_cte(CONFIDENCE) +
    " SELECT array_to_string(antecedent, ',') AS antecedent, consequent, confidence FROM ru",
    "basket"))
def q_association_rules(spark, d):
    _, model = _model(spark, d)
    r = FI.association_rules(model)
    return r.select(joined("antecedent").alias("antecedent"),
                    joined("consequent").alias("consequent"), "confidence")


@register("rule_interest", V.with_views(
    "WITH " + OS.itemsets_cte("basket", SUPPORT) + ",\n" + OS.rules_cte(CONFIDENCE) +
    " SELECT array_to_string(r.antecedent, ',') AS antecedent, r.consequent, r.confidence, "
    "r.consequent AS items, s.freq, abs(r.confidence - s.freq / (SELECT n FROM nb)) AS interest "
    "FROM ru r JOIN s1 s ON s.items = [r.consequent]", "basket"))
def q_rule_interest(spark, d):
    baskets, model = _model(spark, d, reuse=True)
    r = FI.rule_interest(model, baskets)
    return r.select(joined("antecedent").alias("antecedent"),
                    joined("consequent").alias("consequent"), "confidence",
                    joined("items").alias("items"), "freq", "interest")


# ------------------------------------------------- distance, clustering ---

@register("incidence", V.with_views(
    "SELECT entity, feature FROM inc WHERE entity IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)", "inc"))
def q_incidence(spark, d):
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = load_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = load_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    sales = (li.join(o, li.l_orderkey == o.o_orderkey)
             .join(c, F.col("o_custkey") == c.c_custkey)
             .select(F.col("l_partkey").cast("string").alias("plant"),
                     F.col("c_nationkey").cast("long").alias("state")))
    # part → nations that bought it: the reference's plant → states baskets.
    baskets = FI.baskets_from_pairs(sales, "plant", "state", "states")
    return M.incidence_from_baskets(baskets, "plant", "states", V.some_nations(spark, d))


_MEMBERSHIP = V.with_views(
    "SELECT p.entity, p.feature, EXISTS (SELECT 1 FROM inc i WHERE i.entity = p.entity "
    "AND i.feature = p.feature) AS present FROM probes p", "inc", "probes")


@register("membership_bits", _MEMBERSHIP)
def q_membership_bits(spark, d):
    return B.membership_bits(V.supplier_part_probes(spark, d), B.bit_incidence(V.inc(spark, d)))


@register("membership", _MEMBERSHIP)
def q_membership(spark, d):
    return M.membership(V.supplier_part_probes(spark, d), V.inc(spark, d))


_PAIR_DISTANCE = V.with_views(
    "WITH sz AS (SELECT entity, count(*) AS n FROM inc GROUP BY entity), "
    "ov AS (SELECT p.entity_a, p.entity_b, count(*) AS overlap FROM nation_pairs p "
    "JOIN inc a ON a.entity = p.entity_a JOIN inc b ON b.entity = p.entity_b AND b.feature = a.feature "
    "GROUP BY p.entity_a, p.entity_b) "
    "SELECT p.entity_a, p.entity_b, CAST(coalesce(l.n, 0) + coalesce(r.n, 0) - 2 * coalesce(ov.overlap, 0) "
    "AS BIGINT) AS d2 FROM nation_pairs p LEFT JOIN ov USING (entity_a, entity_b) "
    "LEFT JOIN sz l ON l.entity = p.entity_a LEFT JOIN sz r ON r.entity = p.entity_b",
    "inc", "nation_pairs")


@register("pair_distance_bits", _PAIR_DISTANCE)
def q_pair_distance_bits(spark, d):
    bits = B.bit_incidence(V.inc(spark, d))
    return B.pair_distance_bits(V.nation_pairs(spark, d), bits, "entity_a", "entity_b")


@register("pair_distance", _PAIR_DISTANCE)
def q_pair_distance(spark, d):
    inc = saved(V.inc(spark, d), "incidence")  # read by three branches
    return M.pair_distance(V.nation_pairs(spark, d), inc, "entity_a", "entity_b")


SAMPLE_K, SEED = 5, 123


@register("sample_keys", V.with_views(
    "SELECT entity, CAST(rn - 1 AS INTEGER) AS ordinal FROM (SELECT entity, row_number() OVER "
    f"(ORDER BY md5('{SEED}:' || CAST(entity AS VARCHAR)), entity) AS rn FROM "
    f"(SELECT DISTINCT entity FROM inc)) WHERE rn <= {SAMPLE_K}", "inc"))
def q_sample_keys(spark, d):
    return SP.sample_keys(V.inc(spark, d), "entity", SAMPLE_K, SEED)


def _km_sql(inc: str, k: int, updates: int, select: str) -> str:
    """Oracle: ``updates`` Lloyd passes as chained CTEs; ``{A}``/``{W}`` in
    ``select`` name the final assignment / weights."""
    ctes, a, w = OS.kmeans_ctes(inc, k, SEED, updates)
    body = select.format(A=a, W=w)
    return V.with_views("WITH " + ",\n".join(ctes) + "\n" + body, inc)


@register("nearest_centroid", _km_sql(
    "inc2", 5, 0, "SELECT A.entity, A.cluster, S.centroid, A.d2_scaled FROM {A} A JOIN S USING (cluster)"))
def q_nearest_centroid(spark, d):
    return M.nearest_centroid(V.inc2(spark, d), 5, SEED)


@register("cluster_members", _km_sql(
    "inc", 4, 0, "SELECT A.cluster, S.centroid, A.entity, CAST(row_number() OVER (PARTITION BY A.cluster "
    "ORDER BY A.entity) - 1 AS BIGINT) AS member_rank FROM {A} A JOIN S USING (cluster)"))
def q_cluster_members(spark, d):
    a = M.nearest_centroid(V.inc(spark, d), 4, SEED)
    return M.cluster_members(a).select("cluster", "centroid", "entity", "member_rank")


@register("centroid_update", _km_sql(
    "inc2", 5, 1, "SELECT cluster, feature, w FROM {W}"))
def q_centroid_update(spark, d):
    inc, _, _, w0, a0 = M.first_assignment(V.inc2(spark, d), 5, SEED)
    return M.update_centroids(inc, a0, w0)


# The query runs until no entity moves; the oracle makes more passes than that takes
# (further ones change nothing at a fixpoint).
KMEANS_K, ORACLE_PASSES = 5, 60


@register("kmeans", _km_sql(
    "inc2", KMEANS_K, ORACLE_PASSES, "SELECT entity, cluster, d2_scaled, true AS converged FROM {A}"))
def q_kmeans(spark, d):
    return M.kmeans(V.inc2(spark, d), KMEANS_K, SEED)


# -------------------------------------------------------- dense vectors ---

DENSE_K = 8


@register("kmeans_dense", "SELECT vec_id, true AS nearest, true AS centred FROM embeddings")
def q_kmeans_dense(spark, d):
    vectors = load_table(spark, d, "embeddings")
    return D.fixpoint_checks(D.kmeans_dense(vectors, DENSE_K, SEED, "vec_id", "embedding"), "vec_id")
