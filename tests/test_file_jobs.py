"""The file-based jobs on small hand-made files of the reference's formats."""

import os

import pytest

from quarry.operators.recommend import als_solved
from quarry.plans import file_jobs as J

TREES = ('Id,Nom_parc,Essence\n1,"Parc A, nord",frene\n2,,frene\n3,Zoo,frene\n'
         '4,"Parc A, nord",frene\n5,Élan,frene\n6,Zoo,frene\n7,Zoo,frene\n')
TREES2 = 'Id,Nom_parc\n1,Zoo\n2,\n3,Autre\n4,Élan\n'
PLANTS = ("abelia,fl,nc\nacer,qc,on,nb,ns\nbetula,qc,on,ak\ncarex,qc,on,pe\n"
          "lonely\nzinnia,fl,nc,ga\n")


def _lines(df):
    return [r.line for r in J.as_lines(df).collect()]


def test_tree_jobs(spark, tmp_path):
    p1, p2 = tmp_path / "t16.csv", tmp_path / "t15.csv"
    p1.write_text(TREES, encoding="utf-8")
    p2.write_text(TREES2, encoding="utf-8")
    assert J.csv_row_count(spark, str(p1)).first()[0] == 7
    assert J.csv_nonempty_count(spark, str(p1), "Nom_parc").first()[0] == 6
    assert _lines(J.csv_distinct_values(spark, str(p1), "Nom_parc")) == ["Parc A, nord", "Zoo", "Élan"]
    assert _lines(J.csv_value_counts(spark, str(p1), "Nom_parc")) == [
        "Parc A, nord,2", "Zoo,3", "Élan,1"]
    assert _lines(J.csv_topk_counts(spark, str(p1), "Nom_parc", 2)) == ["Zoo,3", "Parc A, nord,2"]
    assert _lines(J.csv_intersection(spark, str(p1), str(p2), "Nom_parc")) == ["Zoo", "Élan"]


def test_basket_jobs(spark, tmp_path):
    p = tmp_path / "plants.data"
    p.write_text(PLANTS, encoding="utf-8")
    assert _lines(J.basket_file_table(spark, str(p), 2)) == [
        "0,abelia,['fl', 'nc']", "1,acer,['qc', 'on', 'nb', 'ns']"]
    assert J.basket_file_membership(spark, str(p), "acer", "qc").first()["present"] is True
    assert J.basket_file_membership(spark, str(p), "acer", "az").first()["present"] is False
    # carex's "pe" is not an entity: qc and on share acer, betula, carex
    assert J.basket_file_distance(spark, str(p), "qc", "on").first()["d2"] == 0
    assert J.basket_file_distance(spark, str(p), "qc", "fl").first()["d2"] == 5
    top = J.basket_file_itemsets(spark, str(p), 1, 0.3, 0.5).first()
    assert sorted(top["items"]) == ["on", "qc"] and top["freq"] == 3
    assert J.basket_file_rules(spark, str(p), None, 0.3, 0.5).count() >= 2
    assert J.basket_file_interest(spark, str(p), 3, 0.3, 0.5).count() <= 3
    init = J.basket_file_init_centroids(spark, 3, 124).collect()
    assert [r.cluster for r in init] == [0, 1, 2]
    members = J.basket_file_kmeans(spark, str(p), 3, 123).collect()
    assert len(members) == 68 and all(r.converged for r in members)  # every state of the dimension is assigned
    first = J.basket_file_first_iter(spark, str(p), 3, 123).collect()
    assert len(first) == 68


def test_rating_jobs(spark, tmp_path):
    p = tmp_path / "ratings.txt"
    rows = [(u, i, (u * 7 + i * 3) % 5 + 1) for u in range(12) for i in range(15) if (u + i) % 3]
    p.write_text("".join(f"{u}::{i}::{r}::1424380312\n" for u, i, r in rows), encoding="utf-8")
    train, test = (x.collect() for x in J.ratings_split(J.read_ratings(spark, str(p)), 123))
    mean = sum(r.rating for r in train) / len(train)
    assert abs(J.ratings_global_mean(spark, str(p), 123).first()[0] - mean) < 1e-9
    rmse = (sum((r.rating - mean) ** 2 for r in test) / len(test)) ** 0.5
    assert abs(J.ratings_global_mean_rmse(spark, str(p), 123).first()[0] - rmse) < 1e-9
    first = J.ratings_interaction(spark, str(p), 123, n=5).collect()
    assert [(r.userId, r.movieId) for r in first] == sorted((r.userId, r.movieId) for r in train)[:5]
    fitted, _ = J.ratings_split(J.read_ratings(spark, str(p)), 123)
    assert all(r.solved for r in als_solved(fitted, "userId", "movieId", seed=123, rank=3, maxIter=2).collect())
    scores = [J.ratings_als_rmse(spark, str(p), 123, rank=3, maxIter=2).first()[0] for _ in range(2)]
    assert abs(scores[0] - scores[1]) < 1e-6 and scores[0] > 0
    assert J.ratings_als_bias_rmse(spark, str(p), 123, rank=3, maxIter=2, method="random").first()[0] > 0


RATINGS = os.environ.get("QUARRY_RATINGS", "")  # the published ratings sample, where there is one


@pytest.mark.skipif(not os.path.isfile(RATINGS), reason="published ratings sample not present")
def test_published_quality_values(spark):
    """Published results on the shipped ratings sample, with their tolerances."""
    mean = J.ratings_global_mean(spark, RATINGS, 123, method="random").first()[0]
    assert abs(mean - 1.77491694352) <= 0.01
    assert abs(J.ratings_global_mean_rmse(spark, RATINGS, 123, method="random").first()[0] - 1.16693421444) <= 0.01
    als = J.ratings_als_rmse(spark, RATINGS, 123, method="random").first()[0]
    assert min(abs(als - 1.62), abs(als - 1.56)) <= 0.03
    both = J.ratings_als_bias_rmse(spark, RATINGS, 123, method="random").first()[0]
    assert min(abs(both - 1.1210851900789454), abs(both - 1.0409172341247102)) <= 0.03
