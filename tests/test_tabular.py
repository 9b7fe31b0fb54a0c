from pyspark.sql import functions as F

from quarry.operators import tabular
from quarry.operators.ids import contiguous_id, first_n_with_id

NAMES = ["A, B", "É", "Z", "a", "", None, "Z", "a", "A, B", "É", "É", "b"]


def names_df(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "name string")


def test_counts(spark):
    df = names_df(spark)
    assert tabular.row_count(df).first()["n"] == len(NAMES)
    assert tabular.nonempty_count(df, "name").first()["n"] == 10


def test_distinct_code_point_order(spark):
    got = [r["name"] for r in tabular.distinct_values(names_df(spark), "name").collect()]
    # upper case before lower case, accented capital after 'z'
    assert got == ["A, B", "Z", "a", "b", "É"]


def test_value_counts_and_topk_ties(spark):
    df = names_df(spark)
    vc = [(r[0], r[1]) for r in tabular.value_counts(df, "name").collect()]
    assert vc == [("A, B", 2), ("Z", 2), ("a", 2), ("b", 1), ("É", 3)]
    top = [(r[0], r[1]) for r in tabular.topk_counts(df, "name", 3).collect()]
    # tie on 2 broken by name ascending
    assert top == [("É", 3), ("A, B", 2), ("Z", 2)]


def test_intersection_skips_empty_and_null(spark):
    a = spark.createDataFrame([("x",), ("",), (None,), ("y",), ("y",)], "name string")
    b = spark.createDataFrame([("y",), ("",), (None,), ("z",)], "name string")
    assert [r[0] for r in tabular.intersect_values(a, b, "name").collect()] == ["y"]


def test_contiguous_id_hot_key_many_partitions(spark):
    # one key holds a third of the rows; ids must still be 0..n-1 in key order
    rows = [(i % 7 if i % 3 else 3, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    out = contiguous_id(df, ["k"], "id", num_partitions=6).collect()
    ids = sorted(r["id"] for r in out)
    assert ids == list(range(3000))
    by_id = sorted(out, key=lambda r: r["id"])
    keys = [r["k"] for r in by_id]
    assert keys == sorted(keys)


def test_contiguous_id_within_groups(spark):
    rows = [(g, v) for g in ("a", "b", "c") for v in range(50 if g == "a" else 5)]
    df = spark.createDataFrame(rows, "g string, v int")
    out = contiguous_id(df, ["v"], "rank", group_cols=["g"], num_partitions=4).collect()
    for r in out:
        assert r["rank"] == r["v"]


def test_contiguous_id_null_group_and_order(spark):
    rows = [(None, 3), (None, 1), ("a", None), ("a", 2), (None, None)]
    df = spark.createDataFrame(rows, "g string, v int")
    out = contiguous_id(df, ["v"], "rank", group_cols=["g"], num_partitions=3).collect()
    got = sorted((r.g or "", r.rank, r.v if r.v is not None else -1) for r in out)
    assert got == [("", 0, -1), ("", 1, 1), ("", 2, 3), ("a", 0, -1), ("a", 1, 2)]


def test_first_n_with_id(spark):
    df = spark.createDataFrame([(i,) for i in range(20, 0, -1)], "v int")
    got = [(r["id"], r["v"]) for r in first_n_with_id(df, ["v"], 3).collect()]
    assert got == [(0, 1), (1, 2), (2, 3)]


def test_csv_line_matches_python(spark):
    from quarry.functions.exprs import csv_line
    floats = [0.0, -0.0, 1.5, 1e-5, 5e-4, 1e10, 1.25e15, 1e16, 1.5e300, -2.5e-7, 123456789.125, 1e7, 9999999.0, 0.001, 1 / 3,
              float("inf"), float("nan"), 1e22, 1e-300]
    rows = [([1, None], [1.5, f], ["a", None, "l'eau", 'q"', "b'\"", "c\\d", "e\nf"], f, True, None) for f in floats]
    rows.append(([], [], [], None, None, "x"))
    df = spark.createDataFrame(rows, "i array<long>, f array<double>, s array<string>, d double, b boolean, t string")
    got = [r[0] for r in df.select(csv_line(df)).collect()]
    assert got == [",".join(map(str, r)) for r in rows]


def test_csv_newline_in_quotes(spark, tmp_path):
    from quarry.sources.text import read_header_csv
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n2,z\n')
    got = read_header_csv(spark, str(tmp_path / "x.csv"), multi_line=True).collect()
    assert [tuple(r) for r in got] == [("1", "two\nlines"), ("2", "z")]


def test_contiguous_id_of_equal_rows(spark):
    from quarry.operators.ids import contiguous_id
    df = spark.createDataFrame([(k % 3, k % 2) for k in range(60)], "k int, v int").repartition(7)
    got = contiguous_id(df, ["k"], num_partitions=5).collect()
    assert sorted(r["id"] for r in got) == list(range(60))
    assert [r["k"] for r in sorted(got, key=lambda r: r["id"])] == sorted(k % 3 for k in range(60))
