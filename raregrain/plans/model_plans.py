"""Supervised-model and interpretation queries.

Fitted models have no SQL form, so most oracles state the properties that
must hold (optimality, coverage, additivity) and the row counts they hold on.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.hashing import hash_sql
from ..functions.scratch import materialise
from ..operators import boosting as B
from ..operators import features as X
from ..operators import inference as G
from ..operators import interpret as I
from ..operators import metrics as M
from ..operators import models as L
from ..operators import resample as R
from ..operators import sampling as V
from ..operators.cleaning import model_matrix
from ..sources import tables as T
from . import sqltext as Q
from .base import clean_lots, query, rounded
from .feature_plans import fold_features
from .structure_plans import _flags, flags_sql

E6 = T.EMBED_DIMS
N_VEC = "SELECT count(*) FROM embeddings"
N_CLEAN = Q.lots() + "SELECT count(*) FROM clean"


def sensory(spark, sf, k: int = 5):
    """Second track: six numeric columns, label = first embedding class, folds, raw vector."""
    v = T.vectors(spark, sf).withColumn("label", (F.col("label") == 0).cast("int"))
    d = V.stratified_folds(materialise(v), k)
    return VectorAssembler(inputCols=E6, outputCol="features").transform(d)


def scaled_sensory(spark, sf):
    d = X.standardise(sensory(spark, sf).drop("features"), E6)
    return VectorAssembler(inputCols=E6, outputCol="features").transform(d)


def _gradient(model, df):
    """Weighted mean of (y - p) x per column, intercept last."""
    p = vector_to_array("probability")[1]
    d = model.transform(df).select((F.col(L.WEIGHT) * (F.col("label") - p)).alias("r"), F.col(L.WEIGHT).alias("w"),
                                   F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("xs"))
    total = d.agg(F.sum("w"), F.count(F.lit(1))).first()
    g = (d.select("r", F.posexplode("xs").alias("j", "x")).groupBy("j").agg(F.sum(F.col("r") * F.col("x")).alias("g"))
         .orderBy("j").collect())
    return [r["g"] / total[0] for r in g], total[1]


@query("logit_score_equations", flags_sql(["score_equations_zero", "all_levels_but_reference"], N_CLEAN))
def _(spark, sf):
    ff = fold_features(spark, sf, fits=(-1,), reference=T.REFERENCE_LEVELS)
    d = L.weigh_balanced(ff.encoded(-1)).persist()
    m = L.logit(max_iter=200).fit(d)
    g, n = _gradient(m, d)
    names = ff.encoder(-1).feature_names
    full = X.EncoderModel(**{**ff.encoder(-1).state(), "reference": {}}).feature_names
    return _flags(spark, n, score_equations_zero=max(map(abs, g)) < 1e-4,
                  all_levels_but_reference=len(full) - len(names) == len(T.REFERENCE_LEVELS))


@query("ridge_gradient", flags_sql(["gradient_is_penalty_slope", "intercept_not_penalised"], N_VEC))
def _(spark, sf):
    d = L.weigh_balanced(scaled_sensory(spark, sf))
    m = L.logit("l2", 0.05, max_iter=300).fit(d)
    g, n = _gradient(m, d)
    return _flags(spark, n, gradient_is_penalty_slope=all(abs(a - 0.05 * b) < 1e-5 for a, b in zip(g, m.coefficients)),
                  intercept_not_penalised=abs(g[-1]) < 1e-5)


@query("lasso_subgradient", flags_sql(["gradient_within_penalty", "active_at_the_bound", "some_zero"], N_VEC))
def _(spark, sf):
    d = L.weigh_balanced(scaled_sensory(spark, sf))
    reg = 0.04
    m = L.logit("l1", reg, max_iter=500).fit(d)
    g, n = _gradient(m, d)
    b = list(m.coefficients)
    m2 = L.logit("l1", 10.0, max_iter=100).fit(d)
    return _flags(spark, n, gradient_within_penalty=all(abs(x) <= reg + 1e-4 for x in g[:-1]),
                  active_at_the_bound=all(abs(x - reg * (1 if c > 0 else -1)) < 1e-3 for x, c in zip(g, b) if c),
                  some_zero=not any(m2.coefficients))


def _glm(spark, sf):
    ff = fold_features(spark, sf, fits=(-1,), reference=T.REFERENCE_LEVELS)
    d = materialise(L.weigh_balanced(ff.encoded(-1)))
    return ff.encoder(-1).feature_names, d, G.fit_glm(d, L.WEIGHT)


@query("glm_inference", flags_sql(["ci_holds_estimate", "z_is_ratio", "p_in_unit", "one_row_per_term"], N_CLEAN))
def _(spark, sf):
    names, d, m = _glm(spark, sf)
    r = G.coefficient_rows(m, names, spark).collect()
    return _flags(spark, m.summary.numInstances, ci_holds_estimate=all(x["lo"] <= x["coef"] <= x["hi"] for x in r),
                  z_is_ratio=all(abs(x["z"] - x["coef"] / x["std_err"]) < 1e-6 for x in r),
                  p_in_unit=all(0 <= x["p_value"] <= 1 for x in r), one_row_per_term=len(r) == len(names) + 1)


@query("glm_report")
def _(spark, sf):
    names, _, m = _glm(spark, sf)
    return rounded(G.coefficient_rows(m, names, spark))


@query("odds_ratios", flags_sql(["odds_ratio_is_exp", "no_intercept_row"], N_VEC))
def _(spark, sf):
    d = scaled_sensory(spark, sf)
    m = G.fit_glm(d)
    r = G.coefficient_rows(m, E6, spark).where("term <> 'const'").selectExpr("*", "exp(coef) AS e").collect()
    return _flags(spark, m.summary.numInstances, odds_ratio_is_exp=all(abs(x["odds_ratio"] - x["e"]) < 1e-12 for x in r),
                  no_intercept_row=sorted(x["term"] for x in r) == E6)


@query("leverage_sum", flags_sql(["leverage_sums_to_terms", "leverage_in_unit", "deviance_adds_up"], N_VEC))
def _(spark, sf):
    d = L.weigh_balanced(scaled_sensory(spark, sf))
    m = G.fit_glm(d, L.WEIGHT)
    r = G.diagnostics(m, d, L.WEIGHT).agg(F.sum("leverage").alias("h"), F.min("leverage").alias("lo"), F.max("leverage").alias("hi"),
                                          F.sum(F.pow("deviance_residual", 2)).alias("dev"), F.count(F.lit(1)).alias("n")).first()
    return _flags(spark, r["n"], leverage_sums_to_terms=abs(r["h"] - 7) < 1e-6, leverage_in_unit=r["lo"] >= 0 and r["hi"] <= 1,
                  deviance_adds_up=abs(r["dev"] - m.summary.deviance) < 1e-6 * r["dev"])


@query("cooks_topk", flags_sql(["five_largest", "positive"], N_VEC))
def _(spark, sf):
    d = scaled_sensory(spark, sf)
    diag = materialise(G.diagnostics(G.fit_glm(d), d))
    top = G.most_influential(diag, 5).collect()
    r = diag.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cooks") >= top[-1]["cooks"]).alias("above")).first()
    return _flags(spark, r["n"], five_largest=len(top) == 5 and r["above"] == 5, positive=all(x["cooks"] > 0 for x in top))


@query("residual_curve")
def _(spark, sf):
    from ..operators.describe import binned_curve
    d = scaled_sensory(spark, sf)
    diag = G.diagnostics(G.fit_glm(d), d, keep=("row_id", "label", "e1"))
    return rounded(binned_curve(materialise(diag), "e1", "deviance_residual"))


# --------------------------------------------------------------------------- protocol
def protocol_features(spark, sf, **options):
    """Hold-out rows without a fold, folds on the rest, one shared feature fit for all of them."""
    d = V.stratified_holdout(materialise(model_matrix(clean_lots(spark, sf))))
    folds = V.stratified_folds(d.where("NOT is_test"), seed=S.INNER_SEED)
    d = folds.unionByName(d.where("is_test").withColumn("fold", F.lit(None).cast("int"))).drop("is_test")
    return X.FoldFeatures(d, T.area_map(spark, sf), [-1, 0, 1, 2, 3, 4], **options)


def _split_sensory(spark, sf):
    d = V.stratified_holdout(sensory(spark, sf).drop("fold"), 0.25)
    train = V.stratified_folds(d.where("NOT is_test"), S.N_FOLDS, S.INNER_SEED)
    return train, d.where("is_test")


@query("protocol_invariants", flags_sql(["threshold_from_oof_scores", "test_rows_once", "interval_holds_metric",
                                         "honest_f1_not_above_tuned", "same_average_precision"],
                                        "SELECT sum(ceil(round(0.25::DOUBLE * n, 9)))::BIGINT FROM "
                                        "(SELECT count(*) AS n FROM embeddings GROUP BY label = 0)"))
def _(spark, sf):
    train, test = _split_sensory(spark, sf)
    r = L.evaluate("logit", L.logit("l2", 0.01), L.plain_parts(train), train, test, [0, 1, 2, 3, 4])
    hit = r.oof.where(F.col("score") == F.lit(r.threshold)).count()
    audit = {x["choice"]: x for x in M.threshold_leak_audit(r.test, r.threshold).collect()}
    a, b = audit["out-of-fold threshold"], audit["threshold tuned on test"]
    n = r.test.agg(F.count(F.lit(1)), F.count_distinct("row_id")).first()
    return _flags(spark, n[0], threshold_from_oof_scores=hit > 0, test_rows_once=n[0] == n[1],
                  interval_holds_metric=r.ci["auprc"][0] <= r.metrics["auprc"] <= r.ci["auprc"][1],
                  honest_f1_not_above_tuned=a["f1"] <= b["f1"] + 1e-12, same_average_precision=a["auprc"] == b["auprc"])


# --------------------------------------------------------------------------- search, trees
@query("grid_best", flags_sql(["best_is_maximum", "first_wins", "one_score_per_candidate"], N_VEC))
def _(spark, sf):
    d = sensory(spark, sf)
    grid = [L.decision_tree(**g) for g in [L.TREE_GRID[0], *L.TREE_GRID]]  # the first one twice: ties
    best, table = L.grid_search(L.plain_parts(d), grid, [0, 1, 2, 3, 4])
    ap = {r["candidate"]: r["mean_auprc"] for r in table.collect()}
    return _flags(spark, d.count(), best_is_maximum=ap[best] == max(ap.values()), first_wins=best != 1 and ap[0] == ap[1],
                  one_score_per_candidate=len(ap) == 17)


@query("boosted_grid", flags_sql(["one_score_per_candidate", "best_is_maximum"], N_VEC))
def _(spark, sf):
    d = sensory(spark, sf, 2)
    grid = [g for g in L.BOOST_GRID if g["maxDepth"] == 3 and g["stepSize"] == 0.05 and g["trees"] == 150]
    small = [{**g, "trees": 3} for g in grid]  # same weights and depth, fewer trees
    best, table = L.boosted_search(L.plain_parts(d), [0, 1], small)
    ap = {r["candidate"]: r["mean_auprc"] for r in table.collect()}
    return _flags(spark, d.count(), one_score_per_candidate=len(ap) == 3, best_is_maximum=ap[best] == max(ap.values()))


@query("second_track_cv")
def _(spark, sf):
    d = sensory(spark, sf)
    models = {"logit": L.PenalisedLogit("l2", 1.0, max_iter=100), "forest": L.random_forest(max_depth=5, trees=100, min_leaf=2)}
    return rounded(L.cross_validated(models, L.scaled_parts(d, E6), [0, 1, 2, 3, 4]))


@query("early_stop_count", flags_sql(["count_in_range", "count_from_median"], N_VEC))
def _(spark, sf):
    d = sensory(spark, sf, 2)

    def split(f):
        s = V.early_stopping_split(d, f)
        return s.where("NOT is_validation"), s.where("is_validation")
    n, best, _ = L.freeze_tree_count(split, [0, 1], cap=10, patience=5)
    return _flags(spark, d.count(), count_in_range=0 < n <= 11, count_from_median=n == int(sum(best) / 2 * 1.1))


_STEP = 0.125  # first splits are sought between multiples of this
_FIRST_SPLIT = f"""WITH v AS (SELECT vec_id AS row_id, (label = 0)::INT AS label, embedding FROM embeddings),
 vf AS (SELECT *, ((row_number() OVER (PARTITION BY label ORDER BY {hash_sql('row_id')}, row_id) - 1) * {S.N_FOLDS}
   // count(*) OVER (PARTITION BY label))::INT AS own FROM v),
 w AS (SELECT fold, count(*) FILTER (label = 0)::DOUBLE / count(*) FILTER (label = 1) AS w
   FROM vf, range(0, {S.N_FOLDS}) t(fold) WHERE own <> fold GROUP BY 1),
 cell AS (SELECT fold, j, floor(embedding[j]::DOUBLE / {_STEP}) * {_STEP} AS x, sum(label) AS n1, sum(1 - label) AS n0
   FROM vf, range(0, {S.N_FOLDS}) t(fold), range(1, len(embedding) + 1) u(j) WHERE own <> fold GROUP BY 1, 2, 3),
 c AS (SELECT *, sum(n1) OVER o AS l1, sum(n0) OVER o AS l0, sum(n1) OVER (PARTITION BY fold, j) AS t1,
   sum(n0) OVER (PARTITION BY fold, j) AS t0 FROM cell WINDOW o AS (PARTITION BY fold, j ORDER BY x)),
 s AS (SELECT fold, j, x, (l0 - w * l1) / 2 AS gl, (l0 + w * l1) / 4 AS hl, (t0 - l0 - w * (t1 - l1)) / 2 AS gr,
   (t0 - l0 + w * (t1 - l1)) / 4 AS hr FROM c JOIN w USING (fold)),
 g AS (SELECT *, gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1) AS gain FROM s
   WHERE hl >= 2 AND hr >= 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY round(gain, 9) DESC, j, x) AS nth FROM g)
SELECT fold::INT AS fold, j::INT AS component, x AS cut, round(gain, 3) AS gain, round(-gl / (hl + 1), 4) + 0 AS left_value,
  round(-gr / (hr + 1), 4) + 0 AS right_value FROM r WHERE nth = 1 AND gain > 1e-6"""


def whole_vectors(spark, sf):
    """All components of the vectors, the label of the second track, folds."""
    v = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").cast("long").alias("row_id"), (F.col("label") == 0).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("xs"))
    return V.stratified_folds(materialise(v)).withColumn("features", array_to_vector("xs"))


@query("boosted_first_split", _FIRST_SPLIT)
def _(spark, sf):
    d = whole_vectors(spark, sf).withColumn("features", array_to_vector(F.transform("xs", lambda x: F.floor(x / _STEP) * _STEP)))
    parts = {f: B.roles(d.where(F.col("fold") != f)) for f in range(S.N_FOLDS)}
    data = B.binned(parts)
    models = B.fit(data, [B.Boosted(f, 1.0, 1, 1, V.imbalance_ratio(parts[f][0][0]), rows=1.0, columns=1.0) for f in parts])
    rows = [(m.design, int(t.feature[0]) + 1, float(data.cuts[m.design][t.feature[0]][t.cut[0]]), round(float(t.gain[0]), 3),
             round(float(t.value[1]), 4) + 0.0, round(float(t.value[2]), 4) + 0.0)
            for m in models for t in m.grown if t.feature[0] >= 0]
    return spark.createDataFrame(rows, "fold int, component int, cut double, gain double, left_value double, right_value double")


@query("boosted_batch_score")
def _(spark, sf):
    d = sensory(spark, sf)
    m = L.boosted(10).fit(L.weigh_positives()(d.where("fold <> 0")))
    return rounded(L.score(m, d, ("row_id", "label", "fold")))


@query("engineered_boosted_score")
def _(spark, sf):
    ff = fold_features(spark, sf, fits=(0,), engineer=True, scale=False)
    d = ff.encoded(0)
    m = L.boosted(5).fit(L.weigh_positives()(d.where("fold <> 0")))
    return rounded(L.score(m, d.where("fold = 0"), ("row_id", "label", "fold")))


@query("forest_importance", flags_sql(["importances_sum_to_one", "one_per_feature"], N_VEC))
def _(spark, sf):
    d = sensory(spark, sf)
    m = L.random_forest(max_depth=5, trees=20, min_leaf=2).fit(L.weigh_balanced(d))
    v = [r["importance"] for r in I.impurity_importance(m, E6, spark).collect()]
    return _flags(spark, d.count(), importances_sum_to_one=abs(sum(v) - 1) < 1e-9, one_per_feature=len(v) == 6)


@query("reduced_forest")
def _(spark, sf):
    d = sensory(spark, sf, 2)
    parts = L.plain_parts(d)
    forest = L.random_forest(max_depth=5, trees=10)
    scorer = I.fold_scorer({f: forest.fit(L.weigh_balanced(parts(f)[0])) for f in (0, 1)})
    rows = d.select("row_id", "label", "fold", vector_to_array("features").alias("xs"))
    summary = materialise(I.summarise_importance(I.permutation_drops(rows, E6, scorer, repeats=2)))
    keep = I.selected_columns(summary, 0.0) or E6
    v = VectorAssembler(inputCols=keep, outputCol="features").transform(d.drop("features"))
    oof = L.oof_scores(L.plain_parts(v), forest, [0, 1])
    return rounded(M.evaluate_scores(M.score_counts(oof), F.lit(0.5)).withColumn("n_columns", F.lit(len(keep))))


@query("resample_leak_audit", flags_sql(["train_looks_better_than_test", "synthetic_rows_only_in_train"],
                                        "SELECT sum(ceil(round(0.25::DOUBLE * n, 9)))::BIGINT FROM "
                                        "(SELECT count(*) AS n FROM embeddings GROUP BY label = 0)"))
def _(spark, sf):
    train, test = _split_sensory(spark, sf)
    res = materialise(R.oversample(train, E6, []))
    va = VectorAssembler(inputCols=E6, outputCol="features")
    fitrows = va.transform(res)
    m = L.boosted(10).fit(L.weigh_equally(fitrows))
    a = M.score_counts(L.score(m, fitrows, ("row_id", "label")))
    t = M.best_threshold(M.curve(a)).first()["threshold"]
    scored = L.score(m, test, ("row_id", "label"))
    f1_train = M.threshold_metrics(a, F.lit(t)).first()["f1"]
    r = M.threshold_metrics(M.score_counts(scored), F.lit(t)).first()
    n = scored.agg(F.count(F.lit(1)), F.min("row_id")).first()
    return _flags(spark, n[0], train_looks_better_than_test=f1_train > r["f1"], synthetic_rows_only_in_train=n[1] >= 0)


@query("resampled_fold_scores")
def _(spark, sf):
    d = sensory(spark, sf, 2)

    def fit_resampled(rows, f):
        res = materialise(R.oversample(rows, E6, []))
        return L.boosted(5).fit(L.weigh_equally(VectorAssembler(inputCols=E6, outputCol="features").transform(res)))
    oof = L.oof_scores(L.plain_parts(d), fit_resampled, [0, 1])
    return rounded(oof)


# --------------------------------------------------------------------------- interpretation
@query("split_gain", flags_sql(["counts_match_inner_nodes", "all_features_listed"], N_VEC))
def _(spark, sf):
    d = sensory(spark, sf)
    m = L.boosted(8).fit(L.weigh_positives()(d))
    nodes = I.node_table(m, spark)
    imp = I.split_importance(nodes, E6).collect()
    inner = sum((t.numNodes - 1) // 2 for t in m.trees)
    return _flags(spark, d.count(), counts_match_inner_nodes=sum(r["n_splits"] for r in imp) == inner,
                  all_features_listed=sorted(r["feature"] for r in imp) == E6)


@query("gain_compare")
def _(spark, sf):
    from ..operators.lookups import outer_features
    d = sensory(spark, sf)
    va = VectorAssembler(inputCols=E6, outputCol="features")
    res = va.transform(materialise(R.oversample(d, E6, [])))
    a = I.split_importance(I.node_table(L.boosted(5).fit(L.weigh_positives()(d)), spark), E6)
    b = I.split_importance(I.node_table(L.boosted(5).fit(L.weigh_equally(res)), spark), E6)
    both = outer_features(a.select("feature", F.col("gain").alias("gain_plain")), b.select("feature", F.col("gain").alias("gain_resampled")))
    return rounded(both.orderBy(F.desc("gain_plain"), "feature"))


@query("attribution_additivity", flags_sql(["boosted_sums_to_raw_score", "forest_sums_to_probability"], N_VEC))
def _(spark, sf):
    d = sensory(spark, sf)
    gbt = L.boosted(6).fit(L.weigh_equally(d))
    a, base = I.tree_attributions(gbt, d, E6)
    total = F.aggregate("attributions", F.lit(base).cast("double"), lambda s, x: s + x)
    # MLlib's raw score is twice the sum of the trees
    raw = gbt.transform(d).select("row_id", (vector_to_array("rawPrediction")[1]).alias("raw"))
    g = a.withColumn("t", total).join(raw, "row_id").agg(F.max(F.abs(F.col("t") - F.col("raw"))).alias("e"), F.count(F.lit(1)).alias("n")).first()
    rf = L.random_forest(max_depth=4, trees=8).fit(L.weigh_equally(d))
    a2, base2 = I.tree_attributions(rf, d, E6)
    total2 = F.aggregate("attributions", F.lit(base2).cast("double"), lambda s, x: s + x)
    prob = rf.transform(d).select("row_id", vector_to_array("probability")[1].alias("p"))
    f = a2.withColumn("t", total2).join(prob, "row_id").agg(F.max(F.abs(F.col("t") - F.col("p")))).first()[0]
    return _flags(spark, g["n"], boosted_sums_to_raw_score=g["e"] < 1e-6, forest_sums_to_probability=f < 1e-6)


@query("mean_abs_attribution")
def _(spark, sf):
    d = sensory(spark, sf)
    m = L.boosted(6).fit(L.weigh_positives()(d))
    a, _ = I.tree_attributions(m, d, E6)
    return rounded(I.mean_abs_attribution(a, E6))


_LIN = [2.0, -1.0, 0.5, 3.0, 0.0, 1.0]
_LINEAR = " + ".join(f"{w}::DOUBLE * e{i + 1}" for i, w in enumerate(_LIN))
_PERM = f"""v2 AS (SELECT row_id, (label = 0)::INT AS label, e1, e2, e3, e4, e5, e6 FROM vec),
 vf AS (SELECT *, ((row_number() OVER (PARTITION BY label ORDER BY {hash_sql('row_id')}, row_id) - 1) * 3
   // count(*) OVER (PARTITION BY label))::INT AS fold FROM v2),
 p AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY {hash_sql('row_id')}, row_id) AS pos FROM vf),
 q AS (SELECT fold, r AS repeat, e1 AS d1, e2 AS d2, e3 AS d3, e4 AS d4, e5 AS d5, e6 AS d6, row_number() OVER (PARTITION BY fold, r
   ORDER BY {hash_sql('row_id', '(43 + r)')}, row_id) AS pos FROM vf, range(0, 3) t(r)),
 moved AS (""" + " UNION ALL ".join(
    "SELECT fold, repeat, 'e{j}' AS feature, label, round({s}, 9) AS score FROM p JOIN q USING (fold, pos)".format(
        j=j + 1, s=" + ".join(f"{w}::DOUBLE * {'d' if i == j else 'e'}{i + 1}" for i, w in enumerate(_LIN)))
    for j in range(6)) + f""" UNION ALL SELECT fold, -1, '', label, round({_LINEAR}, 9) FROM vf),
 g AS (SELECT fold, repeat, feature, score, sum(label)::DOUBLE AS n1, sum(1 - label)::DOUBLE AS n0 FROM moved GROUP BY 1, 2, 3, 4),
 c AS (SELECT *, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp, sum(n1) OVER (PARTITION BY fold, repeat, feature) AS p1 FROM g
   WINDOW w AS (PARTITION BY fold, repeat, feature ORDER BY score DESC)),
 ap AS (SELECT fold, repeat, feature, sum(n1 / p1 * tp / (tp + fp)) AS ap FROM c GROUP BY 1, 2, 3),
 dr AS (SELECT a.fold, a.feature, avg(b.ap - a.ap) AS d FROM ap a JOIN ap b ON b.fold = a.fold AND b.repeat = -1
   WHERE a.repeat >= 0 GROUP BY 1, 2),
 imp AS (SELECT feature, avg(d) AS importance_mean, stddev_pop(d) AS importance_std, count(*) AS n_folds FROM dr GROUP BY 1)"""


def _linear_importance(spark, sf):
    d = sensory(spark, sf, 3).select("row_id", "label", "fold", F.array(*E6).alias("xs"))

    def scorer(rows):
        s = sum([F.lit(w) * F.get("xs", F.lit(i)) for i, w in enumerate(_LIN)][1:], F.lit(_LIN[0]) * F.get("xs", F.lit(0)))
        return rows.withColumn("score", F.round(s, 9))
    return I.summarise_importance(I.permutation_drops(d, E6, scorer, repeats=3))


@query("permutation_importance", Q.vec(_PERM) + """SELECT feature, round(importance_mean, 6) + 0 AS importance_mean,
  round(importance_std, 6) + 0 AS importance_std, n_folds, feature AS raw_feature FROM imp""")
def _(spark, sf):
    return rounded(_linear_importance(spark, sf))


@query("importance_cut", Q.vec(_PERM) + "SELECT feature FROM imp WHERE importance_mean > 0.005")
def _(spark, sf):
    keep = I.selected_columns(materialise(_linear_importance(spark, sf)), 0.005)
    return spark.createDataFrame([(c,) for c in keep], "feature string")


@query("raw_feature_sum", Q.lots("""e AS (SELECT 'variety_' || variety AS f, moisture AS v FROM clean UNION ALL
   SELECT 'color_' || color, moisture FROM clean UNION ALL SELECT 'altitude', altitude FROM clean),
 s AS (SELECT f, avg(v) AS importance_mean FROM e GROUP BY 1)""") + """SELECT CASE WHEN f LIKE 'variety%' THEN 'variety'
  WHEN f LIKE 'color%' THEN 'color' ELSE f END AS raw_feature, round(sum(importance_mean), 6) AS importance FROM s GROUP BY 1""")
def _(spark, sf):
    d = clean_lots(spark, sf)
    e = (d.select(F.concat(F.lit("variety_"), "variety").alias("f"), F.col("moisture").alias("v"))
         .union(d.select(F.concat(F.lit("color_"), "color"), "moisture")).union(d.select(F.lit("altitude"), "altitude")))
    from ..operators.cleaning import raw_feature
    s = e.groupBy("f").agg(F.avg("v").alias("importance_mean")).withColumn("raw_feature", raw_feature(F.col("f")))
    return rounded(I.raw_importance(s))


_RANK = "rk AS (SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT 'e{i}' AS feature, avg(e{i}) FILTER (label = 1) AS logit_coef, stddev_pop(e{i}) AS lasso_coef,
    corr(e{i}, label) AS permutation_importance, max(e{i}) AS forest_importance,
    avg(e{i}) FILTER (label = 1) - avg(e{i}) FILTER (label = 0) AS mean_difference FROM v2""" for i in range(1, 7)) + "))"


@query("importance_rank", Q.vec("v2 AS (SELECT row_id, (label = 0)::INT AS label, e1, e2, e3, e4, e5, e6 FROM vec)", _RANK) +
       "SELECT feature, round(mean_difference, 6) AS mean_difference, round((" + " + ".join(
           f"(abs({c}) - min(abs({c})) OVER ()) / (max(abs({c})) OVER () - min(abs({c})) OVER () + 1e-12::DOUBLE)"
           for c in ("logit_coef", "lasso_coef", "forest_importance", "permutation_importance"))
       + ") / 4, 6) AS overall_score FROM rk")
def _(spark, sf):
    d = T.vectors(spark, sf).withColumn("label", (F.col("label") == 0).cast("int"))
    pos, neg = F.col("label") == 1, F.col("label") == 0
    row = d.agg(*[x.alias(f"{c}_{n}") for c in E6 for n, x in (
        ("logit_coef", F.avg(F.when(pos, F.col(c)))), ("lasso_coef", F.stddev_pop(c)), ("permutation_importance", F.corr(c, "label")),
        ("forest_importance", F.max(c)), ("mean_difference", F.avg(F.when(pos, F.col(c))) - F.avg(F.when(neg, F.col(c)))))])
    names = ["logit_coef", "lasso_coef", "permutation_importance", "forest_importance", "mean_difference"]
    t = row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}_{n}").alias(n) for n in names]) for c in E6])))
    t = materialise(t)
    return rounded(I.combined_ranking(t, t, t, t, t).select("feature", "mean_difference", "overall_score"))


@query("coefficient_table")
def _(spark, sf):
    from ..operators.lookups import side_by_side
    d = L.weigh_balanced(scaled_sensory(spark, sf)).persist()
    models = {"plain": L.logit(max_iter=50), "l2": L.logit("l2", 0.05, max_iter=50), "l1": L.logit("l1", 0.03, max_iter=50)}
    rows = [(n, f, float(c)) for n, est in models.items() for f, c in zip(E6, est.fit(d).coefficients) if c != 0]
    d.unpersist()
    return rounded(side_by_side(spark.createDataFrame(rows, "model string, feature string, coef double"), list(models)), 4)
