import numpy as np
import pytest
from pyspark.sql import functions as F

from raregrain.operators import metrics as M
from raregrain.operators import models as L
from raregrain.operators import sampling as V


def frame(spark, y, p):
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))],
                                 "row_id long, label int, score double")


def average_precision(y, p):
    order = np.argsort(-p, kind="stable")
    total, tp, seen, ap = y.sum(), 0, 0, 0.0
    for s in np.unique(p)[::-1]:
        hit = y[p == s]
        tp, seen = tp + hit.sum(), seen + len(hit)
        ap += hit.sum() / total * tp / seen
    return ap if len(order) else 0.0


def test_separable_threshold(spark):
    c = M.curve(M.score_counts(frame(spark, [0, 0, 0, 0, 1, 1], [.1, .2, .3, .4, .8, .9])))
    r = M.best_threshold(c).first()
    assert 0.4 < r["threshold"] <= 0.8 and r["best_f"] == pytest.approx(1.0)


def test_metrics_of_random_scores(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 200), np.round(rng.random(200), 2)
    m = M.evaluate_scores(M.score_counts(frame(spark, y, p)), F.lit(0.5)).first().asDict()
    assert set(m) == set(M.METRICS) and all(0 <= v <= 1 for v in m.values())
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    assert m["roc_auc"] == pytest.approx(auc) and m["auprc"] == pytest.approx(average_precision(y, p))


def test_interval_holds_the_point(spark):
    rng = np.random.default_rng(2)
    y = (rng.random(300) < 0.1).astype(int)
    d = frame(spark, y, np.clip(y * 0.3 + rng.random(300) * 0.7, 0, 1))
    point = M.evaluate_scores(M.score_counts(d), F.lit(0.5)).first()
    for exact in (True, False):
        for r in M.bootstrap_ci(d, 0.5, 100, exact=exact).collect():
            assert r["lo"] <= point[r["metric"]] <= r["hi"]


def test_single_class_resamples_are_left_out(spark):
    d = frame(spark, [1] + [0] * 9, np.linspace(0, 1, 10))
    assert 0 < M.bootstrap_metrics(d, 0.5, 40).count() < 40


def test_leak_audit_never_lowers_f1(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 200)
    a, b = M.threshold_leak_audit(frame(spark, y, rng.random(200)), 0.9).orderBy("choice").collect()
    assert b["f1"] >= a["f1"] and a["auprc"] == b["auprc"]


def test_undefined_ratios_are_zero(spark):
    m = M.threshold_metrics(M.score_counts(frame(spark, [0, 1], [.1, .2])), F.lit(5.0)).first()
    assert m["precision"] == 0 and m["recall"] == 0 and m["f1"] == 0


def test_evaluator(spark):
    d = frame(spark, [0, 1, 0, 1], [.1, .4, .35, .8]).withColumnRenamed("score", "probability")
    e = M.AveragePrecisionEvaluator()
    assert e.evaluate(d) == pytest.approx(1.0) and e.isLargerBetter()


def test_split_properties(spark):
    d = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 12 == 0).cast("int").alias("label"))
    s = V.stratified_folds(V.stratified_holdout(d), 5)
    n = {r["label"]: r for r in s.groupBy("label").agg(F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    assert all(r["t"] == -(-r["n"] // 5) for r in n.values())
    sizes = [r["count"] for r in s.groupBy("label", "fold").count().collect()]
    assert len(sizes) == 10
    per = s.groupBy("label").agg(F.count_distinct("fold").alias("k")).collect()
    assert all(r["k"] == 5 for r in per)
    for lab in (0, 1):
        c = [r["count"] for r in s.where(F.col("label") == lab).groupBy("fold").count().collect()]
        assert max(c) - min(c) <= 1
    again = V.stratified_folds(V.stratified_holdout(d), 5)
    assert s.exceptAll(again).isEmpty()


def test_permutation_keeps_the_multiset(spark):
    d = spark.range(300).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("int").alias("fold"),
                                F.col("id").cast("double").alias("x"))
    p = V.permuted_donors(d, ["x"], 2)
    assert p.count() == 600
    assert p.groupBy("repeat").agg(F.count_distinct("donor_x").alias("n")).where("n <> 300").isEmpty()
    assert p.where("donor_x % 3 <> fold").isEmpty() and p.where("donor_x <> x").count() > 500


def test_early_stopping_rule():
    assert L.stopped_iteration([3, 2, 1, 2, 2, 2, 0], patience=3) == 3
    assert L.stopped_iteration([3, 2, 1, 2, 0], patience=3) == 5


def test_grids():
    assert len(L.TREE_GRID) == 16 and len(L.FOREST_GRID) == 8 and len(L.BOOST_GRID) == 24 and len(L.C_GRID) == 30
    assert L.C_GRID[0] == pytest.approx(1e-3) and L.C_GRID[-1] == pytest.approx(1e3)
    assert set(L.logit_variants(100.0)) == {"logit", "logit + elimination", "logit l2", "logit l1"}
