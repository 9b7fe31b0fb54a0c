import pytest
from pyspark.sql import functions as F

from quarry import sources as S
from quarry.functions.exprs import csv_line
from quarry.operators import tabular
from quarry.operators.itemsets import basket_table


def test_header_csv_quoting_and_accents(spark, tmp_path):
    p = tmp_path / "trees.csv"
    p.write_text('Id,Nom_parc,Essence\n1,"Lafontaine, parc",frene\n2,,frene\n'
                 '3,Émile,frene\n4,"d\'Iberville ""nord""",frene\n', encoding="utf-8")
    df = S.read_header_csv(spark, str(p))
    assert tabular.row_count(df).first()["n"] == 4
    assert tabular.nonempty_count(df, "Nom_parc").first()["n"] == 3
    names = [r[0] for r in tabular.distinct_values(df, "Nom_parc").collect()]
    assert names == ["Lafontaine, parc", "d'Iberville \"nord\"", "Émile"]


def test_header_csv_with_byte_order_mark(spark, tmp_path):
    p = tmp_path / "bom.csv"
    p.write_bytes("\ufeffNom_parc,x\nA,1\n".encode("utf-8"))
    df = S.read_header_csv(spark, str(p))
    assert df.columns == ["Nom_parc", "x"]
    assert df.first()["Nom_parc"] == "A"


def test_delimited_records_fail_and_drop(spark, tmp_path):
    p = tmp_path / "r.txt"
    p.write_text("0::2::3::1424380312\n1::x::1::1424380312\n2::5\n", encoding="utf-8")
    fields = [("userId", "int"), ("itemId", "int"), ("rating", "int"), ("timestamp", "bigint")]
    good = S.read_delimited_records(spark, str(p), fields, mode="drop").collect()
    assert [tuple(r) for r in good] == [(0, 2, 3, 1424380312)]
    with pytest.raises(Exception):
        S.read_delimited_records(spark, str(p), fields, mode="fail").collect()


def test_ragged_baskets(spark, tmp_path):
    p = tmp_path / "plants.data"
    p.write_text("abelia,fl,nc\nlonely\nzinnia,qc,ab,qc\n", encoding="utf-8")
    b = S.read_ragged_baskets(spark, str(p), keep_line_order=True)
    t = basket_table(b, "key", "items", order_cols=S.text.LINE_ORDER).orderBy("id").collect()
    assert [(r["id"], r["key"], r["items"]) for r in t] == [
        (0, "abelia", ["fl", "nc"]), (1, "lonely", []), (2, "zinnia", ["qc", "ab", "qc"])]


def test_round_trip_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 5, 10), (3, 4, 1, 20)],
                               "userId int, itemId int, rating int, timestamp bigint")
    out = str(tmp_path / "rec")
    S.write_delimited_records(df, out)
    back = S.read_delimited_records(spark, out, [("userId", "int"), ("itemId", "int"),
                                                 ("rating", "int"), ("timestamp", "bigint")])
    assert sorted(map(tuple, back.collect())) == [(1, 2, 5, 10), (3, 4, 1, 20)]


def test_csv_line_python_str(spark):
    df = spark.createDataFrame(
        [(0, "abelia", ["fl", "nc"], True, 3.0), (1, None, [], False, None)],
        "id long, key string, items array<string>, flag boolean, x double")
    lines = [r[0] for r in df.select(csv_line(df)).collect()]
    assert lines == ["0,abelia,['fl', 'nc'],True,3.0", "1,None,[],False,None"]


def test_csv_lines_sink_and_empty_result(spark, tmp_path):
    from quarry.plans.file_jobs import as_lines
    df = spark.createDataFrame([("a", 2), ("b, c", 1)], "name string, n long")
    out = str(tmp_path / "lines")
    S.write_csv_lines(df, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a,2", "b, c,1"]
    empty = as_lines(df.where("n > 5"))  # an empty result is an empty frame, not an error
    assert empty.count() == 0 and empty.columns == ["line"]


FIELDS = [("userId", "bigint"), ("itemId", "bigint"), ("rating", "int"), ("timestamp", "bigint")]


def test_ids_beyond_int(spark, tmp_path):
    (tmp_path / "r.txt").write_text("3000000005::2::3::1424380312\n")
    assert S.read_delimited_records(spark, str(tmp_path / "r.txt"), FIELDS).first()["userId"] == 3_000_000_005


def test_rejected_records(spark, tmp_path):
    lines = ["0::2::3::1", "1::x::y::1", "2::5", "", "3::4::99999999999::1", "4::1::2::3::extra", "5::1::-7::9",
             "6::1:: 2 ::9", "7::1::2.5::9", "8::99999999999999999999999999::1::1", "::::::"]
    for k in range(2):
        (tmp_path / f"part{k}.txt").write_text("\n".join(lines) + "\n")
    parsed = S.parse_delimited_records(spark, str(tmp_path), FIELDS)
    assert sorted(map(tuple, parsed.good.collect())) == sorted(
        [(0, 2, 3, 1), (4, 1, 2, 3), (5, 1, -7, 9), (6, 1, 2, 9)] * 2)
    got = {(r["line"], r["reason"], r["field"]) for r in parsed.rejects.collect()}
    assert got == {("1::x::y::1", "not a value", "itemId"), ("2::5", "too few fields", None), ("", "too few fields", None),
                   ("3::4::99999999999::1", "out of range", "rating"), ("7::1::2.5::9", "not a value", "rating"),
                   ("8::99999999999999999999999999::1::1", "out of range", "itemId"), ("::::::", "not a value", "userId")}
    assert parsed.counts == {"good": 8, "too few fields": 4, "not a value": 6, "out of range": 4}
    assert {r[0].rsplit("/", 1)[1] for r in parsed.rejects.select("file").distinct().collect()} == {"part0.txt", "part1.txt"}
    dropped = S.read_delimited_records(spark, str(tmp_path), FIELDS, mode="drop")
    assert sorted(map(tuple, dropped.collect())) == sorted(map(tuple, parsed.good.collect()))


@pytest.mark.parametrize("split, broadcast", [(None, 10 ** 6), ("64", 10 ** 6), ("64", 0)])
def test_line_ids_without_moving_lines(spark, tmp_path, split, broadcast):
    lines = [f"key{k},{'x' * (k % 50)}" for k in range(700)]
    for part, (a, b) in enumerate([(0, 5), (5, 5), (5, 400), (400, 700)]):
        (tmp_path / f"part-{part}.txt").write_text("".join(f"{x}\n" for x in lines[a:b]))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        if split:
            for k in keys:
                spark.conf.set(k, split)
        read = S.read_ragged_baskets(spark, str(tmp_path), keep_line_order=True)
        got = S.with_line_ids(read, "id", broadcast_splits=broadcast)
        assert {r["id"]: r["key"] for r in got.collect()} == {k: f"key{k}" for k in range(700)}
        plan = got._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.splitlines() if "Exchange" in x and "items" in x and "Broadcast" not in x]
        assert broadcast == 0 or not moved
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_quoted_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a "b", c'), (2, "line\nbreak"), (3, '"'), (4, "")]
    df = spark.createDataFrame(rows, "id int, name string")
    S.write_header_csv(df, str(tmp_path / "q"))
    back = S.read_header_csv(spark, str(tmp_path / "q"), schema=df.schema, multi_line=True)
    assert sorted((r["id"], r["name"] or "") for r in back.collect()) == rows
