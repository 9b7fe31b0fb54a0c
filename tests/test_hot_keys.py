"""One key holds a third of all rows: results stay whole and exact."""

import math
from collections import Counter

from pyspark.sql import functions as F

from quarry.operators import cluster as M
from quarry.operators import recommend as R
from quarry.operators import tabular
from quarry.operators.ids import contiguous_id

N = 3000


def skewed(spark, parts=6):
    # key 0 on every third row, the rest spread over 1..99
    rows = [(0 if i % 3 == 0 else 1 + i % 99, i) for i in range(N)]
    return spark.createDataFrame(rows, "k int, v int").repartition(parts), rows


def test_counts_topk_intersect(spark):
    df, rows = skewed(spark)
    want = Counter(str(k) for k, _ in rows)
    s = df.select(F.col("k").cast("string").alias("k"))
    got = {r[0]: r[1] for r in tabular.value_counts(s, "k").collect()}
    assert got == dict(want)
    assert tabular.topk_counts(s, "k", 1).first()[1] == N // 3
    other = s.where(F.col("k").isin("0", "5"))
    assert [r[0] for r in tabular.intersect_values(s, other, "k").collect()] == ["0", "5"]


def test_group_ids_with_hot_group(spark):
    df, rows = skewed(spark)
    out = contiguous_id(df, ["v"], "rank", group_cols=["k"], num_partitions=7).collect()
    by_group = {}
    for k, v in rows:
        by_group.setdefault(k, []).append(v)
    for r in out:
        assert sorted(by_group[r.k])[r.rank] == r.v


def test_bias_with_hot_user_and_item(spark):
    rows = [(0 if i % 3 == 0 else i % 50, 7 if i % 3 == 1 else i % 40, 1 + i % 5)
            for i in range(N)]
    rows = list({(u, i): r for u, i, r in rows}.items())
    rows = [(u, i, r) for (u, i), r in rows]
    df = spark.createDataFrame(rows, "userId int, itemId int, rating int").repartition(5)
    gm = sum(r for *_, r in rows) / len(rows)
    um, im = {}, {}
    for u, i, r in rows:
        um.setdefault(u, []).append(r)
        im.setdefault(i, []).append(r)
    got = R.bias_interaction(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = r.rating - (sum(um[r.userId]) / len(um[r.userId])
                           + sum(im[r.itemId]) / len(im[r.itemId]) - gm)
        assert math.isclose(r.user_item_interaction, want, abs_tol=1e-9)


def test_kmeans_hot_entity_and_hot_feature(spark):
    # entity "big" has a third of all incidence rows; feature "f0" is everywhere
    pairs = [("big", f"f{j}") for j in range(200)]
    pairs += [(f"e{i}", f"f{(i * 7 + j) % 60}") for i in range(40) for j in range(10)]
    pairs += [(f"e{i}", "f0") for i in range(40)]
    pairs = sorted(set(pairs))
    inc = spark.createDataFrame(pairs, "entity string, feature string").repartition(4)
    a = M.kmeans(inc, 3, 5, max_iter=4)
    b = M.kmeans(inc.repartition(9), 3, 5, max_iter=4)
    ra = sorted(map(tuple, a.collect()))
    assert ra == sorted(map(tuple, b.collect()))
    assert len(ra) == 41
