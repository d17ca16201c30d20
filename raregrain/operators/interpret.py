"""Split gain, additive tree attributions, permutation importance, combined ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scratch import scratch_path
from . import metrics as M
from .cleaning import raw_feature
from .features import FoldFeatures
from .sampling import permuted_donors


# --------------------------------------------------------------------------- trees as tables
def node_table(model, spark) -> DataFrame:
    """One row per tree node of a fitted ensemble (or single tree), from its saved form."""
    path = scratch_path(spark)
    model.write().overwrite().save(path)
    d = spark.read.parquet(f"{path}/data")
    if "nodeData" in d.columns:
        d = d.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        d = d.withColumn("tree", F.lit(0))
    return d.select("tree", "id", "prediction", F.col("impurityStats").alias("stats"), "gain", "leftChild", "rightChild",
                    F.col("rawCount").alias("n_rows"), F.col("split.featureIndex").alias("feature"),
                    F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"))


def split_importance(nodes: DataFrame, names: list[str]) -> DataFrame:
    """Mean gain per split and number of splits per feature, 0 for unused ones."""
    used = nodes.where("leftChild >= 0").groupBy("feature").agg(F.avg("gain").alias("gain"),
                                                               F.count(F.lit(1)).alias("n_splits"))
    spark = nodes.sparkSession
    feats = spark.createDataFrame(list(enumerate(names)), "feature int, name string")
    return (feats.join(used, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce("gain", F.lit(0.0)).alias("gain"),
        F.coalesce("n_splits", F.lit(0)).cast("long").alias("n_splits")).orderBy(F.desc("gain"), "feature"))


def impurity_importance(model, names: list[str], spark) -> DataFrame:
    v = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(x)) for n, x in zip(names, v)], "feature string, importance double")


# --------------------------------------------------------------------------- attributions
def tree_attributions(model, df: DataFrame, names: list[str], *, proba: bool = False,
                      keep: tuple = (S.ROW_ID,)) -> tuple[DataFrame, float]:
    """Exact path-dependent Shapley attributions: (keep columns + ``attributions`` array, base value).

    Boosted trees explain the raw sum of tree outputs; forests and single
    trees explain the positive probability.  Every leaf is a product game over
    the distinct features of its path, so its Shapley values need only the
    elementary sums of those few factors.  The model is a bounded constant of
    the tasks; rows stream through in batches.
    """
    spark = df.sparkSession
    rows = node_table(model, spark).collect()  # tree nodes only
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["id"]] = r
    weights = list(getattr(model, "treeWeights", [1.0] * len(trees)))
    forest = "GBT" not in type(model).__name__
    leaves = []  # (value, [(feature, cover ratio, [(threshold, goes_left), ...]), ...])
    base = 0.0
    for t, nodes in trees.items():
        scale = 1.0 / len(trees) if forest else weights[t]

        def walk(i, path, cover, nodes=nodes, scale=scale):
            n = nodes[i]
            if n["leftChild"] < 0:
                value = n["stats"][1] / sum(n["stats"]) if forest else n["prediction"]
                merged: dict[int, list] = {}
                for feat, thr, left, ratio in path:
                    m = merged.setdefault(feat, [1.0, []])
                    m[0] *= ratio
                    m[1].append((thr, left))
                leaves.append((value * scale, [(f, z, c) for f, (z, c) in merged.items()]))
                return value * scale * cover
            total = float(n["n_rows"])
            out = 0.0
            for child, left in ((n["leftChild"], True), (n["rightChild"], False)):
                ratio = nodes[child]["n_rows"] / total
                out += walk(child, [*path, (n["feature"], n["threshold"], left, ratio)], cover * ratio)
            return out
        base += walk(0, [], 1.0)
    p = len(names)

    def explain(batches):
        import math

        import numpy as np
        for pdf in batches:
            x = np.stack(pdf["xs"].to_numpy()) if len(pdf) else np.zeros((0, p))
            phi = np.zeros((len(pdf), p))
            for value, path in leaves:
                m = len(path)
                if not m:
                    continue
                ones = []
                for f, _, conds in path:
                    ok = np.ones(len(pdf), dtype=bool)
                    for thr, left in conds:
                        ok &= (x[:, f] <= thr) if left else (x[:, f] > thr)
                    ones.append(ok.astype(float))
                zs = [z for _, z, _ in path]
                w = [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)]
                for i in range(m):
                    # coefficient s of the product = sum over coalitions of size s of the others
                    poly = [np.ones(len(pdf))]
                    for j in range(m):
                        if j != i:
                            nxt = [np.zeros(len(pdf)) for _ in range(len(poly) + 1)]
                            for s, c in enumerate(poly):
                                nxt[s] = nxt[s] + c * zs[j]
                                nxt[s + 1] = nxt[s + 1] + c * ones[j]
                            poly = nxt
                    phi[:, path[i][0]] += value * (ones[i] - zs[i]) * sum(w[s] * poly[s] for s in range(m))
            out = pdf.drop(columns=["xs"])
            out["attributions"] = list(phi)
            yield out
    d = df.select(*keep, vector_to_array("features").alias("xs"))
    fields = ", ".join(f"`{c}` {t}" for c, t in d.dtypes if c != "xs")
    return d.mapInPandas(explain, f"{fields}, attributions array<double>"), base


def attribution_long(attr: DataFrame, names: list[str], keep: tuple = (S.ROW_ID,)) -> DataFrame:
    return attr.select(*keep, F.posexplode("attributions").alias("pos", "value")).select(
        *keep, F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1).alias("feature"), "value")


def mean_abs_attribution(attr: DataFrame, names: list[str]) -> DataFrame:
    return (attribution_long(attr, names, ()).groupBy("feature")
            .agg(F.avg(F.abs("value")).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature"))


# --------------------------------------------------------------------------- permutation importance
def permutation_drops(rows: DataFrame, names: list[str], score: Callable[[DataFrame], DataFrame],
                      repeats: int = 20, seed: int = S.SEED) -> DataFrame:
    """(fold, feature, drop): mean loss of average precision when a column is permuted inside a fold.

    ``rows`` holds held-out rows: row_id, label, fold and the array ``xs``;
    ``score`` adds a ``score`` column computed from ``xs``.  All columns and
    repeats are one job.
    """
    base = M.average_precision(M.curve(M.score_counts(score(rows), ["fold"]), ["fold"]), ["fold"])
    moved = permuted_donors(rows, ["xs"], repeats, seed)
    idx = F.array(*[F.lit(i) for i in range(len(names))])
    moved = moved.withColumn("j", F.explode(idx)).withColumn("xs", F.transform(
        "xs", lambda x, i: F.when(i == F.col("j"), F.get("donor_xs", F.col("j"))).otherwise(x))).drop("donor_xs")
    by = ["fold", "repeat", "j"]
    ap = M.average_precision(M.curve(M.score_counts(score(moved), by), by), by)
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1).alias("feature")
    return (ap.join(base.withColumnRenamed("auprc", "base"), "fold")
            .groupBy("fold", named).agg(F.avg(F.col("base") - F.col("auprc")).alias("drop")))


def fold_scorer(models: dict) -> Callable[[DataFrame], DataFrame]:
    """Scorer for ``permutation_drops`` that uses the model of each held-out fold."""
    def scorer(rows):
        out = None
        for f, m in models.items():
            v = rows.where(F.col("fold") == f).withColumn("features", array_to_vector("xs"))
            s = m.transform(v).withColumn("score", vector_to_array("probability")[1]).select(*rows.columns, "score")
            out = s if out is None else out.unionByName(s)
        return out
    return scorer


def encoded_importance(ff: FoldFeatures, fit: Callable, folds: list[int], repeats: int = 20, seed: int = S.SEED) -> DataFrame:
    """Out-of-fold permutation importance of every encoded column of a ``FoldFeatures``.

    Folds may keep different levels, so each fold runs over its own columns.
    ``fit`` maps the encoded training rows to a fitted classifier.
    """
    out = None
    for f in folds:
        d = ff.encoded(f)
        model = fit(d.where(F.col("fold") != f))
        rows = d.where(F.col("fold") == f).select(S.ROW_ID, S.LABEL, "fold", vector_to_array("features").alias("xs"))
        drops = permutation_drops(rows, ff.encoder(f).feature_names, fold_scorer({f: model}), repeats, seed)
        out = drops if out is None else out.unionByName(drops)
    return summarise_importance(out)


def summarise_importance(drops: DataFrame) -> DataFrame:
    """Mean, population sd and number of folds per feature, with its source variable."""
    return (drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"),
                                         F.count(F.lit(1)).alias("n_folds"))
            .withColumn("raw_feature", raw_feature(F.col("feature"))).orderBy(F.desc("importance_mean"), "feature"))


def raw_importance(summary: DataFrame) -> DataFrame:
    return summary.groupBy("raw_feature").agg(F.sum("importance_mean").alias("importance"))


def selected_columns(summary: DataFrame, cut: float = 0.005) -> list[str]:
    return [r["feature"] for r in summary.where(F.col("importance_mean") > cut).select("feature").collect()]


# --------------------------------------------------------------------------- combined ranking
def combined_ranking(logit: DataFrame, lasso: DataFrame, forest: DataFrame, permutation: DataFrame,
                     mean_diff: DataFrame) -> DataFrame:
    """Mean of four min-max scaled absolute scores; the mean difference is carried, not scored."""
    parts = ["logit_coef", "lasso_coef", "forest_importance", "permutation_importance"]
    t = (logit.select("feature", "logit_coef").join(lasso.select("feature", "lasso_coef"), "feature")
         .join(permutation.select("feature", "permutation_importance"), "feature")
         .join(forest.select("feature", "forest_importance"), "feature", "left")
         .join(mean_diff.select("feature", "mean_difference"), "feature", "left"))
    ext = t.agg(*[f(F.abs(c)).alias(f"{n}_{c}") for c in parts for n, f in (("lo", F.min), ("hi", F.max))]).first()
    scaled = [(F.abs(c) - ext[f"lo_{c}"]) / (ext[f"hi_{c}"] - ext[f"lo_{c}"] + 1e-12) for c in parts]
    return t.withColumn("overall_score", sum(scaled, F.lit(0.0)) / len(parts)).orderBy(F.desc("overall_score"), "feature")
