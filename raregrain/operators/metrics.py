"""Scores against labels: curves, thresholds, average precision, ROC AUC, bootstrap.

Everything starts from counts per distinct score, and the running counts over
the scores are bucketed, so neither the rows nor the scores pass through one
task.  ``by`` evaluates many models, folds or resamples in one job.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.ranking import running_sums
from .sampling import bootstrap_counts, poisson_counts

METRICS = ["precision", "recall", "f1", "balanced_accuracy", "roc_auc", "auprc"]
EPS = 1e-12


def score_counts(df: DataFrame, by: tuple | list = (), label: str = S.LABEL, score: str = "score",
                 weight: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score; ``weight`` is an integer row multiplicity."""
    w = F.col(weight) if weight else F.lit(1)
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, w).otherwise(0)).cast("long").alias("n1"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(w)).cast("long").alias("n0"))


def curve(counts: DataFrame, by: tuple | list = ()) -> DataFrame:
    """Running true and false positives by falling score, with the class totals P and N."""
    return running_sums(counts, "score", {"tp": "n1", "fp": "n0"}, list(by), descending=True,
                        totals={"P": "n1", "N": "n0"})


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where undefined."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def pr_points(c: DataFrame) -> DataFrame:
    return c.withColumns({"precision": F.col("tp") / (F.col("tp") + F.col("fp")),
                          "recall": _ratio(F.col("tp"), F.col("P"))})


def roc_points(c: DataFrame) -> DataFrame:
    return c.withColumns({"tpr": _ratio(F.col("tp"), F.col("P")), "fpr": _ratio(F.col("fp"), F.col("N"))})


def _average_precision() -> Column:
    return F.sum(_ratio(F.col("n1"), F.col("P")) * F.col("tp") / (F.col("tp") + F.col("fp")))


def _roc_auc() -> Column:
    below = F.col("N") - F.col("fp")
    pairs = F.col("P").cast("double") * F.col("N")
    return F.sum(F.when(pairs > 0, F.col("n1") * (below + F.col("n0") / 2.0) / pairs))


def _fbeta(beta: float) -> Column:
    p, r = F.col("tp") / (F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("P"))
    b2 = beta * beta
    return F.lit(1 + b2) * p * r / (F.lit(b2) * p + r + F.lit(EPS))


def average_precision(c: DataFrame, by: tuple | list = ()) -> DataFrame:
    """Step sum of recall gains times precision (not the trapezoid of the PR curve)."""
    return c.groupBy(*by).agg(_average_precision().alias("auprc"))


def roc_auc(c: DataFrame, by: tuple | list = ()) -> DataFrame:
    return c.groupBy(*by).agg(_roc_auc().alias("roc_auc"))


def best_threshold(c: DataFrame, by: tuple | list = (), beta: float = 1.0) -> DataFrame:
    """Score with the largest F-beta; on ties the lowest score."""
    best = c.groupBy(*by).agg(F.max(F.struct(_fbeta(beta).alias("f"), (-F.col("score")).alias("s"))).alias("b"))
    return best.select(*by, (-F.col("b.s")).alias("threshold"), F.col("b.f").alias("best_f"))


def confusion(counts: DataFrame, threshold: Column, by: tuple | list = ()) -> DataFrame:
    hit = F.col("score") >= threshold
    return counts.groupBy(*by).agg(
        F.sum(F.when(hit, F.col("n1")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("n0")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("n1"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("n0"))).alias("tn"))


def _threshold_columns() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "balanced_accuracy": (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2}


def threshold_metrics(counts: DataFrame, threshold: Column, by: tuple | list = ()) -> DataFrame:
    cm = confusion(counts, threshold, by)
    return cm.select(*by, *[c.alias(n) for n, c in _threshold_columns().items()])


def evaluate_scores(counts: DataFrame, threshold: Column, by: tuple | list = ()) -> DataFrame:
    """All six metrics per group in one aggregation over the curve.

    ``threshold`` may be a literal or a column of ``counts`` that is constant
    within a group.
    """
    by = list(by)
    hit = F.col("score") >= threshold
    agg = curve(counts, by).groupBy(*by).agg(
        F.sum(F.when(hit, F.col("n1")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("n0")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("n1"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("n0"))).alias("tn"),
        _roc_auc().alias("roc_auc"), _average_precision().alias("auprc"))
    return agg.select(*by, *[c.alias(n) for n, c in _threshold_columns().items()], "roc_auc", "auprc")


def bootstrap_metrics(df: DataFrame, threshold: float, n_boot: int, seed: int = S.SEED, exact: bool = True,
                      label: str = S.LABEL, score: str = "score", id_col: str = S.ROW_ID) -> DataFrame:
    """Metrics per resample; resamples with a single class are left out."""
    draw = bootstrap_counts if exact else poisson_counts
    drawn = draw(df.select(id_col, label, score), n_boot, seed, id_col)
    counts = score_counts(drawn, ["boot"], label, score, "times")
    m = evaluate_scores(counts, F.lit(float(threshold)), ["boot"])
    return m.where(F.col("roc_auc").isNotNull())


def bootstrap_ci(df: DataFrame, threshold: float, n_boot: int = 1000, alpha: float = 0.05, seed: int = S.SEED,
                 metrics: tuple = ("auprc", "f1", "roc_auc"), exact: bool = True, label: str = S.LABEL,
                 score: str = "score", id_col: str = S.ROW_ID) -> DataFrame:
    """Percentile interval per metric: (metric, lo, hi)."""
    draws = bootstrap_metrics(df, threshold, n_boot, seed, exact, label, score, id_col)
    long = draws.unpivot(["boot"], list(metrics), "metric", "value")
    # at most n_boot values per metric
    return long.groupBy("metric").agg(F.percentile("value", F.lit(alpha / 2)).alias("lo"),
                                      F.percentile("value", F.lit(1 - alpha / 2)).alias("hi"))


def fold_summary(fold_metrics: DataFrame, metrics: list[str], models: list[str]) -> DataFrame:
    """Mean and population sd over folds, one column pair per model."""
    long = fold_metrics.unpivot(["model", "fold"], metrics, "metric", "value")
    wide = long.groupBy("metric").pivot("model", models).agg(F.avg("value").alias("mean"),
                                                             F.stddev_pop("value").alias("std"))
    return wide


def comparison_pretty(table: DataFrame) -> DataFrame:
    """Printable comparison table; intervals are shown where they exist."""
    def with_ci(m):
        ci = F.format_string(" [%.2f, %.2f]", F.col(f"{m}_ci_low"), F.col(f"{m}_ci_high"))
        return F.concat(F.format_string("%.3f", F.col(m)),
                        F.when(F.col(f"{m}_ci_low").isNotNull(), ci).otherwise(""))
    return table.select("model", F.format_string("%.2f", F.col("threshold")).alias("threshold"),
                        F.format_string("%.3f", F.col("precision")).alias("precision"),
                        F.format_string("%.3f", F.col("recall")).alias("recall"),
                        with_ci("f1").alias("f1"), F.format_string("%.3f", F.col("roc_auc")).alias("roc_auc"),
                        with_ci("auprc").alias("auprc"),
                        F.format_string("%.3f", F.col("oof_auprc")).alias("oof_auprc"))


def threshold_leak_audit(test: DataFrame, honest_threshold: float, by_label: str = S.LABEL) -> DataFrame:
    """Same test scores under an honest threshold and one tuned on the test labels."""
    counts = score_counts(test, label=by_label)
    c = curve(counts)
    leaked = best_threshold(c).first()["threshold"]
    ap = average_precision(c).first()["auprc"]
    rows = []
    for name, t in (("out-of-fold threshold", honest_threshold), ("threshold tuned on test", leaked)):
        m = threshold_metrics(counts, F.lit(float(t)))
        rows.append(m.select(F.lit(name).alias("choice"), F.lit(float(t)).alias("threshold"), "precision",
                             "recall", "f1", F.lit(ap).alias("auprc")))
    return rows[0].unionByName(rows[1])


class AveragePrecisionEvaluator(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable,
                                DefaultParamsWritable):
    """Step-sum average precision of a probability (vector or number) column, for model search."""

    @keyword_only
    def __init__(self, *, labelCol: str = S.LABEL, predictionCol: str = "probability"):
        super().__init__()
        self._setDefault(labelCol=S.LABEL, predictionCol="probability")
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        p = self.getPredictionCol()
        vector = dataset.schema[p].dataType.typeName() != "double"
        score = vector_to_array(F.col(p))[1] if vector else F.col(p)
        d = dataset.select(F.col(self.getLabelCol()).alias(S.LABEL), score.alias("score"))
        counts = score_counts(d).persist()
        try:
            return float(average_precision(curve(counts)).first()["auprc"] or 0.0)
        finally:
            counts.unpersist()

    def isLargerBetter(self) -> bool:
        return True
