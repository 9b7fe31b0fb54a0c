"""Market baskets, frequent itemsets, association rules and rule interest.

Mining is Spark ML's parallel FP-Growth. Baskets are built with a distinct
before the grouping, so a basket's array is bounded by the item vocabulary
however many rows one basket key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import joined
from quarry.operators.ids import contiguous_id


def baskets_from_pairs(pairs: DataFrame, basket_col: str, item_col: str,
                       items_out: str = "items") -> DataFrame:
    """(basket, items): the distinct items of every basket, sorted."""
    distinct_pairs = (pairs.select(basket_col, item_col)
                      .where(F.col(item_col).isNotNull()).distinct())
    return distinct_pairs.groupBy(basket_col).agg(
        F.array_sort(F.collect_list(item_col)).alias(items_out))


def basket_table(baskets: DataFrame, key_col: str, items_col: str,
                 order_cols: list[str] | None = None, id_col: str = "id") -> DataFrame:
    """(id, key, items) with a contiguous 0-based id in ``order_cols`` order
    (file order for a ragged-basket file read with ``keep_line_order``)."""
    order = order_cols or [key_col]
    return contiguous_id(baskets, order, id_col).select(id_col, key_col, items_col)


def fit_fpgrowth(baskets: DataFrame, items_col: str = "items", min_support: float = 0.1,
                 min_confidence: float = 0.3):
    """FP-Growth model; duplicate and NULL items of a basket are removed first
    (Spark rejects duplicates). A basket without items still counts in N."""
    from pyspark.ml.fpm import FPGrowth
    items = F.coalesce(F.col(items_col), F.array().cast(baskets.schema[items_col].dataType))
    clean = baskets.select(
        F.array_distinct(F.filter(items, lambda x: x.isNotNull())).alias("items"))
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    return fp.fit(clean)


def frequent_itemsets(model, n: int | None = None) -> DataFrame:
    """(items sorted, freq) by size desc, freq desc, then items."""
    f = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    f = f.orderBy(F.size("items").desc(), F.col("freq").desc(), joined("items"))
    return f.limit(n) if n is not None else f


def association_rules(model, n: int | None = None) -> DataFrame:
    """(antecedent sorted, consequent, confidence) by antecedent size desc,
    confidence desc, then antecedent and consequent."""
    r = model.associationRules.select(F.array_sort("antecedent").alias("antecedent"),
                                      "consequent", "confidence")
    r = r.orderBy(F.size("antecedent").desc(), F.col("confidence").desc(),
                  joined("antecedent"), joined("consequent"))
    return r.limit(n) if n is not None else r


def rule_interest(model, baskets: DataFrame, n: int | None = None) -> DataFrame:
    """Rules with interest = |confidence − freq(consequent) / N|, N = number of
    baskets (empty ones included). Columns: antecedent, consequent, confidence,
    items, freq, interest; ordered by antecedent size desc, interest desc."""
    n_baskets = baskets.agg(F.count(F.lit(1))).scalar()
    rules = model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"), "consequent", "confidence",
        F.col("consequent").getItem(0).alias("_item"))
    singles = (model.freqItemsets.where(F.size("items") == 1)
               .select(F.col("items").getItem(0).alias("_item"), "items", "freq"))
    j = rules.join(singles, "_item")
    interest = F.abs(F.col("confidence") - F.col("freq") / n_baskets)
    out = j.select("antecedent", "consequent", "confidence", "items", "freq",
                   interest.alias("interest"))
    out = out.orderBy(F.size("antecedent").desc(), F.col("interest").desc(),
                      joined("antecedent"), joined("consequent"))
    return out.limit(n) if n is not None else out
