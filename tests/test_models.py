from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from raregrain.operators import inference as G
from raregrain.operators import interpret as I
from raregrain.operators import models as L
from raregrain.plans.model_plans import E6, scaled_sensory, sensory
from raregrain.sources import tables as T


@pytest.fixture(scope="module")
def data(spark, sf):
    return sensory(spark, sf, 3)


def test_attributions_equal_enumerated_shapley_values(spark, data):
    m = L.decision_tree(3, 5).fit(L.weigh_equally(data))
    nodes = {r["id"]: r for r in I.node_table(m, spark).collect()}

    def expect(x, known, i=0):
        n = nodes[i]
        if n["leftChild"] < 0:
            return n["stats"][1] / sum(n["stats"])
        lo, hi = n["leftChild"], n["rightChild"]
        if n["feature"] in known:
            return expect(x, known, lo if x[n["feature"]] <= n["threshold"] else hi)
        a, b = nodes[lo]["n_rows"], nodes[hi]["n_rows"]
        return (a * expect(x, known, lo) + b * expect(x, known, hi)) / (a + b)

    attr, base = I.tree_attributions(m, data, E6)
    got = {r["row_id"]: r["attributions"] for r in attr.collect()}
    rows = data.select("row_id", vector_to_array("features").alias("x")).limit(5).collect()
    for r in rows:
        for j in range(6):
            others = [k for k in range(6) if k != j]
            phi = sum(factorial(s) * factorial(5 - s) / factorial(6) * (expect(r["x"], {*c, j}) - expect(r["x"], set(c)))
                      for s in range(6) for c in combinations(others, s))
            assert got[r["row_id"]][j] == pytest.approx(phi, abs=1e-9)
    assert base == pytest.approx(expect(rows[0]["x"], set()))


def test_glm_matches_newton(spark, data):
    pdf = data.select("label", vector_to_array("features").alias("x")).toPandas()
    x = np.column_stack([np.stack(pdf["x"]), np.ones(len(pdf))])
    y, b = pdf["label"].to_numpy(float), np.zeros(7)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        h = (x * (p * (1 - p))[:, None]).T @ x
        b = b + np.linalg.solve(h, x.T @ (y - p))
    m = G.fit_glm(data)
    r = {t["term"]: t for t in G.coefficient_rows(m, E6, spark).collect()}
    assert [r[n]["coef"] for n in [*E6, "const"]] == pytest.approx(list(b), rel=1e-4)
    assert [r[n]["std_err"] for n in [*E6, "const"]] == pytest.approx(list(np.sqrt(np.diag(np.linalg.inv(h)))), rel=1e-4)
    lev = (p * (1 - p)) * np.einsum("ij,jk,ik->i", x, np.linalg.inv(h), x)
    d = G.diagnostics(m, data).toPandas()
    assert sorted(d["leverage"]) == pytest.approx(sorted(lev), rel=1e-3)


def test_oof_covers_each_row_once(spark, data):
    oof = L.oof_scores(L.plain_parts(data), L.logit("l2", 0.1, max_iter=10), [0, 1, 2])
    assert oof.count() == data.count() == oof.select("row_id").distinct().count()


def test_grid_first_best_wins(spark, data):
    same = [L.logit("l2", 0.1, max_iter=10), L.logit("l2", 0.1, max_iter=10)]
    best, table = L.grid_search(L.plain_parts(data), same, [0, 1, 2])
    assert best == 0 and table.count() == 2


def test_protocol_on_separable_rows(spark):
    d = spark.range(300).select(F.col("id").alias("row_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    d = d.withColumn("x", F.col("label") * 2 + (F.col("row_id") % 7) / 7.0).withColumn("fold", (F.col("row_id") % 3).cast("int"))
    from pyspark.ml.feature import VectorAssembler
    d = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    r = L.evaluate("logit", L.logit("l2", 0.01), L.plain_parts(d.where("row_id < 200")), d.where("row_id < 200"),
                   d.where("row_id >= 200"), [0, 1, 2], n_boot=10)
    assert r.metrics["auprc"] == pytest.approx(1.0) and 0 < r.threshold < 1
    table = L.comparison_table(spark, [r]).first()
    assert table["oof_auprc"] == pytest.approx(1.0) and table["auprc_ci_low"] is not None


def test_scaled_track_is_standard(spark, sf):
    r = scaled_sensory(spark, sf).agg(*[F.avg(c) for c in E6], *[F.stddev_pop(c) for c in E6]).first()
    assert list(r) == pytest.approx([0.0] * 6 + [1.0] * 6, abs=1e-9)
    assert T.EMBED_DIMS == E6


def test_penalty_follows_the_fitted_rows(spark, data):
    rows = L.weigh_balanced(data)
    half = L.weigh_balanced(data.where("row_id % 2 = 0"))
    for d in (rows, half):
        total = d.agg(F.sum(L.WEIGHT)).first()[0]
        want = L.logit("l2", 1.0 / (0.01 * total), max_iter=50).fit(d).coefficients
        assert list(L.PenalisedLogit("l2", 0.01, max_iter=50).fit(d).coefficients) == pytest.approx(list(want))


def test_elimination_of_a_fold_never_sees_its_held_out_rows(spark, data):
    other = data.withColumn("label", F.when(F.col("fold") == 0, 1 - F.col("label")).otherwise(F.col("label")))

    def chosen(d):
        return L.eliminate_features(E6, L.scaled_parts(d, E6), lambda f: L.logit(featuresCol=f, max_iter=20), [0, 1, 2],
                                    d, min_features=4)
    a, b = L.scaled_parts(data, E6)(0)[0], L.scaled_parts(other, E6)(0)[0]
    assert a.exceptAll(b).isEmpty()
    paths = [[k for k, _ in L.elimination_path(x, lambda f: L.logit(featuresCol=f, max_iter=20), 4, 1)] for x in (a, b)]
    assert paths[0] == paths[1]
    names, sizes, folds = chosen(data)
    assert [n for n, _ in sizes] == [6, 5, 4] and set(folds) == {0, 1, 2} and set(names) <= set(E6)


def test_elimination_is_a_classifier(spark, data):
    fit = L.eliminated(lambda f: L.logit(featuresCol=f, max_iter=10), min_features=5, k=2)
    oof = L.oof_scores(L.plain_parts(data), fit, [0, 1, 2])
    assert oof.count() == data.count()


def test_parts_are_scaled_by_their_fit_rows(spark, data):
    for f in (0, 2):
        fit_rows, held = L.scaled_parts(data, E6)(f)
        x = np.array([r[0] for r in fit_rows.select(vector_to_array("features")).collect()])
        assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(x.std(axis=0), 1, atol=1e-9)
        assert held.count() > 0


def test_early_stopping_takes_the_plain_loss_and_reports_the_cap(spark, data):
    def split(f):
        return data.where(F.col("fold") != f), data.where(F.col("fold") == f)
    n, best, capped = L.freeze_tree_count(split, [0, 1], cap=3, patience=2)
    model = L.boosted(3).fit(L.weigh_positives()(split(0)[0]))
    assert best[0] == L.stopped_iteration(list(model.evaluateEachIteration(L.weigh_equally(split(0)[1]))), 2)
    assert capped == [f for f, b in zip([0, 1], best) if b > 1]
    assert L.stopped_iteration([3, 2, 2.5, 2.4, 1], 2) == 2


def test_oversampling_needs_neighbours(spark):
    from raregrain.operators.resample import oversample
    d = spark.range(40).selectExpr("id AS row_id", "CAST(id < 3 AS int) AS label", "CAST(id AS double) AS x")
    with pytest.raises(ValueError):
        oversample(d, ["x"], [])


def test_empty_histogram_and_scatter(spark):
    from raregrain.operators.describe import histogram, scatter_cells
    d = spark.createDataFrame([], "row_id bigint, label int, x double, y double")
    assert histogram(d, "x").count() == 0 and scatter_cells(d, "x", "y").count() == 0
