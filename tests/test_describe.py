"""Degenerate inputs of the descriptive tables."""

import pytest

from raregrain.operators import describe as D
from raregrain.operators import unsupervised as U


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame([(i, 3.0, float(i), i % 2) for i in range(10)],
                                 "row_id long, same double, rising double, label int")


def test_rank_test_of_a_constant_column(flat):
    r = {x["feature"]: x for x in D.mann_whitney(flat, ["same", "rising"]).collect()}
    assert r["same"]["z"] == 0 and r["same"]["p_value"] == pytest.approx(1.0)
    assert r["rising"]["u_positive"] == 15.0 and r["rising"]["mean_difference"] == pytest.approx(1.0)


def test_histogram_of_a_constant_column(flat):
    assert [(r["bin"], r["n"]) for r in D.histogram(flat, "same").collect()] == [(0, 10)]
    assert D.histogram(flat, "rising", 5).count() == 5


def test_silhouette_of_equal_points(spark):
    d = spark.createDataFrame([(1, 1.0, 0), (2, 1.0, 0), (3, 1.0, 1), (4, 9.0, 2)], "row_id long, x double, cluster int")
    assert U.silhouette_rows(d, ["x"]).where("silhouette < -1 OR silhouette > 1").isEmpty()
    single = U.silhouette_rows(d, ["x"]).where("row_id = 4").first()
    assert single["silhouette"] == 0.0


def test_missingness(spark):
    d = spark.createDataFrame([("a", None), (None, None), ("b", 2.0), ("a", 1.0)], "t string, v double")
    got = {r["column_name"]: (r["kind"], r["missing_pct"], r["n_unique"]) for r in D.missingness(d).collect()}
    assert got == {"t": ("string", 25.0, 2), "v": ("double", 50.0, 2)}
