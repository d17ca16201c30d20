"""Classifier builders, grid search and the leakage-free evaluation protocol.

Fits are MLlib jobs over the rows; the driver only loops over folds and
parameter sets.  Scores of all folds or candidates are evaluated together.
"""

from __future__ import annotations

import statistics
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scratch import materialise
from . import metrics as M
from .bootstrap import bootstrap_intervals
from .features import Encoder, FoldFeatures
from .sampling import balanced_weights, imbalance_ratio, stratified_folds

WEIGHT = "weight"
C_GRID = [10 ** (-3 + 6 * i / 29) for i in range(30)]
# Boosted-tree settings; steps are larger and trees fewer than with a histogram booster.
BOOST = {"maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9",
         "minInstancesPerNode": 2}


# --------------------------------------------------------------------------- builders
def logit(penalty: str | None = None, reg: float = 0.0, max_iter: int = 5000, tol: float = 1e-9, **over):
    """Class-weighted logistic regression; ``penalty`` None, 'l2' or 'l1'."""
    return LogisticRegression(labelCol=S.LABEL, weightCol=WEIGHT, maxIter=max_iter, tol=tol,
                              regParam=reg if penalty else 0.0, elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=False, **over)


def reg_from_c(c: float, weight_sum: float) -> float:
    """MLlib penalty for an inverse strength C: 1 / (C * sum of weights)."""
    return 1.0 / (c * weight_sum)


class PenalisedLogit:
    """Logistic regression of inverse strength C; the penalty is 1 / (C * sum of the weights of the rows it is fitted on)."""

    def __init__(self, penalty: str, c: float, **over):
        self.penalty, self.c, self.over = penalty, c, over

    def fit(self, rows: DataFrame):
        total = rows.agg(F.sum(WEIGHT)).first()[0]
        return logit(self.penalty, reg_from_c(self.c, total), **self.over).fit(rows)


def boosted(trees: int = 50, seed: int = S.SEED, **over):
    return GBTClassifier(labelCol=S.LABEL, weightCol=WEIGHT, maxIter=trees, seed=seed, **{**BOOST, **over})


def decision_tree(max_depth: int | None = 5, min_leaf: int = 2, seed: int = S.SEED):
    return DecisionTreeClassifier(labelCol=S.LABEL, weightCol=WEIGHT, maxDepth=30 if max_depth is None else max_depth,
                                  minInstancesPerNode=min_leaf, seed=seed)


def random_forest(max_depth: int | None = None, features: str = "sqrt", trees: int = 300, min_leaf: int = 1,
                  seed: int = S.SEED):
    return RandomForestClassifier(labelCol=S.LABEL, weightCol=WEIGHT, numTrees=trees, seed=seed,
                                  maxDepth=30 if max_depth is None else max_depth, minInstancesPerNode=min_leaf,
                                  featureSubsetStrategy=features)


# Search grids (None = no depth limit).
TREE_GRID = [{"max_depth": d, "min_leaf": m} for d in (3, 5, 8, None) for m in (2, 4, 8, 16)]
FOREST_GRID = [{"max_depth": d, "features": f} for d in (3, 5, 7, None) for f in ("sqrt", "all")]
BOOST_GRID = [{"maxDepth": d, "stepSize": s, "trees": t, "positive": w}
              for d in (3, 6) for s in (0.02, 0.05) for t in (150, 300) for w in (0.5, 1.0, 2.0)]
SECOND_FOREST_GRID = [{"max_depth": d, "min_leaf": m} for d in (5, None) for m in (2, 5)]


def logit_variants(weight_sum: float | None = None, **over) -> dict[str, list]:
    """The four logistic variants: name -> candidates to search (one candidate = no search).

    The sum of weights is that of the rows a candidate is fitted on; ``weight_sum`` fixes it instead.
    """
    def grid(penalty):
        if weight_sum is not None:
            return [logit(penalty, reg_from_c(c, weight_sum), **over) for c in C_GRID]
        return [PenalisedLogit(penalty, c, **over) for c in C_GRID]
    return {"logit": [logit(**over)], "logit + elimination": [eliminated(lambda f: logit(featuresCol=f, **over))],
            "logit l2": grid("l2"), "logit l1": grid("l1")}


# --------------------------------------------------------------------------- weights
def weigh_balanced(df: DataFrame) -> DataFrame:
    return balanced_weights(df, out=WEIGHT)


def weigh_positives(factor: float = 1.0) -> Callable[[DataFrame], DataFrame]:
    """Positives weigh factor * n0/n1, negatives 1."""
    def apply(df):
        w = factor * imbalance_ratio(df)
        return df.withColumn(WEIGHT, F.when(F.col(S.LABEL) == 1, F.lit(w)).otherwise(F.lit(1.0)))
    return apply


def weigh_equally(df: DataFrame) -> DataFrame:
    return df.withColumn(WEIGHT, F.lit(1.0))


# --------------------------------------------------------------------------- scoring
def score(model, df: DataFrame, keep: tuple = (S.ROW_ID, S.LABEL, "fold")) -> DataFrame:
    """Positive-class probability per row."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("score"))


def _parallel(fn, items, threads: int = 4):
    with ThreadPool(max(1, min(threads, len(items)))) as pool:
        return pool.map(fn, items)


def oof_scores(parts: Callable[[int], tuple[DataFrame, DataFrame]], classifier, folds: list[int],
               weigh=weigh_balanced) -> DataFrame:
    """Out-of-fold scores: every row scored by the model that did not see its fold.

    ``parts(f)`` gives (fit rows, held-out rows) of a fold, both encoded by
    statistics of the fit rows.  ``classifier`` is an estimator, or a function
    of the fit rows and the fold that returns a fitted model.
    """
    def one(f):
        fit_rows, held = parts(f)
        model = classifier(fit_rows, f) if callable(classifier) else classifier.fit(weigh(fit_rows))
        return score(model, held)
    out = None
    for s in _parallel(one, folds):
        out = s if out is None else out.unionByName(s)
    return materialise(out)


def fold_parts(ff: FoldFeatures) -> Callable[[int], tuple[DataFrame, DataFrame]]:
    def parts(f):
        d = ff.encoded(f)
        return d.where(F.col("fold") != f), d.where(F.col("fold") == f)
    return parts


def plain_parts(df: DataFrame) -> Callable[[int], tuple[DataFrame, DataFrame]]:
    """Parts of a table whose features need no fitting."""
    return lambda f: (df.where(F.col("fold") != f), df.where(F.col("fold") == f))


def scaled_parts(df: DataFrame, cols: list[str]) -> Callable[[int], tuple[DataFrame, DataFrame]]:
    """Parts of a numeric table, scaled by the statistics of each fold's fit rows."""
    df = df.drop("features")

    def parts(f):
        fit_rows = df.where(F.col("fold") != f)
        scale = Encoder(cols, [], True).fit(fit_rows)
        return scale.transform(fit_rows), scale.transform(df.where(F.col("fold") == f))
    return parts


# --------------------------------------------------------------------------- search
def grid_search(parts, candidates: list, folds: list[int], weigh=weigh_balanced) -> tuple[int, DataFrame]:
    """(best index, table of mean average precision); the first best candidate wins.

    ``weigh`` is one weighting, or a list with one per candidate.
    ``parts`` belong to inner folds, encoded from inner training rows only.
    All candidates and folds are scored in one evaluation job.
    """
    jobs = [(i, f) for f in folds for i in range(len(candidates))]
    weighs = weigh if isinstance(weigh, list) else [weigh] * len(candidates)
    prepared = {f: (parts(f)[0].persist(), parts(f)[1]) for f in folds}

    def one(job):
        i, f = job
        model = candidates[i].fit(weighs[i](prepared[f][0]))
        return score(model, prepared[f][1]).withColumn("candidate", F.lit(i))
    out = None
    for s in _parallel(one, jobs):
        out = s if out is None else out.unionByName(s)
    by = ["candidate", "fold"]
    ap = M.average_precision(M.curve(materialise(M.score_counts(out, by)), by), by)
    table = materialise(ap.groupBy("candidate").agg(F.round(F.avg("auprc"), 12).alias("mean_auprc")))
    for rows, _ in prepared.values():
        rows.unpersist()
    best = table.agg(F.max(F.struct("mean_auprc", (-F.col("candidate")).alias("c"))).alias("b")).first()["b"]
    return -best["c"], table


def boosted_search(parts, folds: list[int], grid: list[dict] = BOOST_GRID) -> tuple[int, DataFrame]:
    """Grid over depth, step, number of trees and positive weight (a factor of n0/n1)."""
    models = [boosted(**{k: v for k, v in g.items() if k != "positive"}) for g in grid]
    return grid_search(parts, models, folds, [weigh_positives(g["positive"]) for g in grid])


def cross_validated(models: dict, parts, folds: list[int], threshold: float = 0.5, weigh=weigh_balanced) -> DataFrame:
    """Mean and population sd over folds of four metrics, one column pair per model."""
    out = None
    for name, est in models.items():
        s = oof_scores(parts, est, folds, weigh).withColumn("model", F.lit(name))
        out = s if out is None else out.unionByName(s)
    by = ["model", "fold"]
    m = M.evaluate_scores(M.score_counts(out, by), F.lit(threshold), by)
    return M.fold_summary(m, ["roc_auc", "auprc", "f1", "balanced_accuracy"], list(models))


def elimination_path(rows: DataFrame, make, min_features: int, step: int) -> list[tuple[list[int], PipelineModel]]:
    """(kept positions of the vector, fitted model) from all features down to ``min_features``.

    Every fit drops the ``step`` smallest |coefficients|; only ``rows`` are looked at. ``make(column)``
    builds the estimator on a vector column.
    """
    rows = weigh_balanced(rows).persist()
    size = rows.select(vector_to_array("features").alias("x")).select(F.size("x")).first()[0]
    kept, out = list(range(size)), []
    while True:
        cut = VectorSlicer(inputCol="features", outputCol="__kept", indices=kept)
        model = make("__kept").fit(cut.transform(rows))
        out.append((kept, PipelineModel(stages=[cut, model])))
        if len(kept) <= min_features:
            rows.unpersist()
            return out
        weight = [abs(c) for c in model.coefficients.toArray()]
        drop = set(sorted(range(len(kept)), key=lambda i: weight[i])[:min(step, len(kept) - min_features)])
        kept = [k for i, k in enumerate(kept) if i not in drop]


def eliminate_features(names: list[str], parts, make, folds: list[int], whole: DataFrame, min_features: int = 5,
                       step: int = 1):
    """Recursive elimination with the number of features chosen by held-out rows.

    In each fold the whole elimination runs on the fit rows alone and every size is scored on the held-out
    rows; the size with the best mean average precision wins (the larger one on ties), and
    an elimination on ``whole`` goes down to that size.
    Returns (selected names, rows (n_features, mean_auprc), features chosen in each fold at that size).
    """
    paths = dict(zip(folds, _parallel(lambda f: elimination_path(parts(f)[0], make, min_features, step), folds)))
    out = None
    for f in folds:
        held = parts(f)[1]
        for kept, model in paths[f]:
            s = score(model, held).withColumn("candidate", F.lit(len(kept)))
            out = s if out is None else out.unionByName(s)
    by = ["candidate", "fold"]
    ap = M.average_precision(M.curve(M.score_counts(out, by), by), by)
    sizes = [(r["candidate"], r["m"]) for r in ap.groupBy("candidate").agg(F.avg("auprc").alias("m")).collect()]
    best = max(sizes, key=lambda h: (h[1], h[0]))[0]
    final = next(kept for kept, _ in elimination_path(whole, make, min_features, step) if len(kept) == best)
    chosen = {f: [names[i] for i in next(k for k, _ in paths[f] if len(k) == best)] for f in folds}
    return [names[i] for i in final], sorted(sizes, reverse=True), chosen


def eliminated(make, min_features: int = 5, step: int = 1, k: int = S.N_FOLDS):
    """Elimination as one classifier: (fit rows, fold) -> model; the folds that choose the size lie inside the fit rows."""
    def fit(rows: DataFrame, _fold):
        inner = stratified_folds(rows.drop("fold"), k, S.INNER_SEED)
        size = rows.select(vector_to_array("features").alias("x")).select(F.size("x")).first()[0]
        names = [str(i) for i in range(size)]
        keep, _, _ = eliminate_features(names, plain_parts(inner), make, list(range(k)), rows, min_features, step)
        cut = VectorSlicer(inputCol="features", outputCol="__kept", indices=[int(i) for i in keep])
        return PipelineModel(stages=[cut, make("__kept").fit(cut.transform(weigh_balanced(rows)))])
    return fit


# --------------------------------------------------------------------------- early stopping
def stopped_iteration(losses: list[float], patience: int = 50) -> int:
    """1-based iteration of the lowest loss before ``patience`` rounds without improvement."""
    best, at = float("inf"), 0
    for i, v in enumerate(losses, 1):
        if v < best:
            best, at = v, i
        elif i - at >= patience:
            break
    return at


def freeze_tree_count(split_rows: Callable[[int], tuple[DataFrame, DataFrame]], folds: list[int], cap: int = 4000,
                      patience: int = 50, weigh=weigh_positives(), **params) -> tuple[int, list[int], list[int]]:
    """Number of trees = int(1.1 * median over folds of the early-stopped iteration).

    ``split_rows(f)`` gives (fit rows, stopping rows), both from the training
    part of fold f; one fit of ``cap`` trees serves every prefix. The loss of the stopping rows is not
    weighted. Also returns each fold's iteration and the folds whose loss was still falling at the cap.
    """
    def one(f):
        fit_rows, stop_rows = split_rows(f)
        model = boosted(cap, **params).fit(weigh(fit_rows))
        return stopped_iteration(list(model.evaluateEachIteration(weigh_equally(stop_rows))), patience)
    best = _parallel(one, folds)
    return int(statistics.median(best) * 1.1), best, [f for f, n in zip(folds, best) if n > cap - patience]


# --------------------------------------------------------------------------- protocol
@dataclass
class Result:
    name: str
    model: object
    threshold: float
    oof: DataFrame
    test: DataFrame
    oof_metrics: dict
    metrics: dict
    ci: dict = field(default_factory=dict)

    def row(self) -> tuple:
        ci = [self.ci.get(m, (None, None)) for m in ("auprc", "f1", "roc_auc")]
        return (self.name, self.threshold, *[self.metrics[m] for m in M.METRICS], *[v for pair in ci for v in pair],
                self.oof_metrics["auprc"], self.oof_metrics["roc_auc"])


RESULT_SCHEMA = ("model string, threshold double, precision double, recall double, f1 double, balanced_accuracy double, "
                 "roc_auc double, auprc double, auprc_ci_low double, auprc_ci_high double, f1_ci_low double, "
                 "f1_ci_high double, roc_auc_ci_low double, roc_auc_ci_high double, oof_auprc double, oof_roc_auc double")


def evaluate(name: str, classifier, parts, train: DataFrame, test: DataFrame, folds: list[int], *, beta: float = 1.0,
             n_boot: int = 1000, weigh=weigh_balanced) -> Result:
    """Out-of-fold scores -> threshold -> refit -> hold-out metrics -> bootstrap intervals.

    The test rows are used only after the threshold is fixed.
    """
    oof = oof_scores(parts, classifier, folds, weigh)
    model = classifier(train, -1) if callable(classifier) else classifier.fit(weigh(train))
    return judge(name, model, oof, materialise(score(model, test, (S.ROW_ID, S.LABEL))), beta=beta, n_boot=n_boot)


def judge(name: str, model, oof: DataFrame, scored: DataFrame, *, beta: float = 1.0, n_boot: int = 1000) -> Result:
    """Threshold from out-of-fold scores, metrics and intervals of the hold-out's scores."""
    counts = M.score_counts(oof)
    threshold = M.best_threshold(M.curve(counts), beta=beta).first()["threshold"]
    oof_m = M.evaluate_scores(counts, F.lit(threshold)).first().asDict()
    m = M.evaluate_scores(M.score_counts(scored), F.lit(threshold)).first().asDict()
    ci = {}
    if n_boot:
        ci = {r["metric"]: (r["lo"], r["hi"]) for r in bootstrap_intervals(scored, threshold, n_boot).collect()}
    return Result(name, model, threshold, oof, scored, oof_m, m, ci)


def evaluate_features(name: str, classifier, ff: FoldFeatures, k: int = S.N_FOLDS, **options) -> Result:
    """``evaluate`` on a ``FoldFeatures`` that holds folds 0..k-1, fit -1 and hold-out rows without a fold."""
    last = ff.encoded(-1)
    return evaluate(name, classifier, fold_parts(ff), last.where("fold IS NOT NULL"), last.where("fold IS NULL"),
                    list(range(k)), **options)


def comparison_table(spark, results: list[Result]) -> DataFrame:
    return spark.createDataFrame([r.row() for r in results], RESULT_SCHEMA)
