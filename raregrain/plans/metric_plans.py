"""Metric and evaluation-protocol queries on given scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import hash_sql, uniform_sql
from ..operators import metrics as M
from ..operators import sampling as V
from ..sources import tables as T
from . import sqltext as Q
from .base import query, rounded

_G = "g AS (SELECT score, sum(label)::BIGINT AS n1, sum(1 - label)::BIGINT AS n0 FROM sc GROUP BY 1)"
_C = """c AS (SELECT score, n1, n0, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp, sum(n1) OVER () AS p, sum(n0) OVER () AS n
  FROM g WINDOW w AS (ORDER BY score DESC))"""


def _counts(spark, sf):
    return M.score_counts(T.scored_events(spark, sf))


def _curve(spark, sf):
    return M.curve(_counts(spark, sf))


@query("running_curve", Q.scored(_G, _C) + "SELECT score, tp::BIGINT AS tp, fp::BIGINT AS fp FROM c")
def _(spark, sf):
    return _curve(spark, sf).select("score", "tp", "fp")


@query("confusion", Q.scored() + """SELECT count(*) FILTER (score >= 0.5 AND label = 1) AS tp,
  count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 1) AS fn,
  count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM sc""")
def _(spark, sf):
    return M.confusion(_counts(spark, sf), F.lit(0.5))


_AT = """count(*) FILTER (score >= t AND label = 1)::DOUBLE AS tp, count(*) FILTER (score >= t AND label = 0)::DOUBLE AS fp,
  count(*) FILTER (score < t AND label = 1)::DOUBLE AS fn, count(*) FILTER (score < t AND label = 0)::DOUBLE AS tn"""
_FOUR = """round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
  round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy"""


@query("threshold_metrics", Q.scored(f"m AS (SELECT {_AT} FROM sc, (SELECT 0.5 AS t))") + f"SELECT {_FOUR} FROM m")
def _(spark, sf):
    return rounded(M.threshold_metrics(_counts(spark, sf), F.lit(0.5)))


_AUC = """(SELECT (sum(rk) FILTER (label = 1) - any_value(n1) * (any_value(n1) + 1) / 2) / (any_value(n1) * any_value(n0))
  FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk,
    (sum(label) OVER ())::DOUBLE AS n1, (sum(1 - label) OVER ())::DOUBLE AS n0 FROM sc))"""
_AP = "(SELECT sum(n1 / p::DOUBLE * tp / (tp + fp)::DOUBLE) FROM c)"


@query("roc_auc", Q.scored() + f"SELECT round({_AUC}, 6) AS roc_auc")
def _(spark, sf):
    return rounded(M.roc_auc(_curve(spark, sf)))


@query("average_precision", Q.scored(_G, _C) + f"SELECT round({_AP}, 6) AS auprc")
def _(spark, sf):
    return rounded(M.average_precision(_curve(spark, sf)))


@query("all_metrics", Q.scored(_G, _C, f"m AS (SELECT {_AT} FROM sc, (SELECT 0.3 AS t))") +
       f"SELECT {_FOUR}, round({_AUC}, 6) AS roc_auc, round({_AP}, 6) AS auprc FROM m")
def _(spark, sf):
    return rounded(M.evaluate_scores(_counts(spark, sf), F.lit(0.3)))


@query("pr_points", Q.scored(_G, _C) + """SELECT score, round(tp / (tp + fp)::DOUBLE, 6) AS precision,
  round(tp / p::DOUBLE, 6) AS recall, round(p / (p + n)::DOUBLE, 6) AS baseline FROM c""")
def _(spark, sf):
    return rounded(M.pr_points(_curve(spark, sf)).select(
        "score", "precision", "recall", (F.col("P") / (F.col("P") + F.col("N"))).alias("baseline")))


@query("roc_points", Q.scored(_G, _C) + """SELECT score, round(tp / p::DOUBLE, 6) AS tpr, round(fp / n::DOUBLE, 6) AS fpr FROM c""")
def _(spark, sf):
    return rounded(M.roc_points(_curve(spark, sf)).select("score", "tpr", "fpr"))


def _best(beta: float) -> str:
    b2 = beta * beta
    return f"""best AS (SELECT score AS threshold, {1 + b2}::DOUBLE * (tp / (tp + fp)::DOUBLE) * (tp / p::DOUBLE) /
   ({b2}::DOUBLE * (tp / (tp + fp)::DOUBLE) + tp / p::DOUBLE + 1e-12::DOUBLE) AS f FROM c ORDER BY f DESC, score LIMIT 1)"""


@query("best_threshold", Q.scored(_G, _C, _best(1.0)) + "SELECT threshold, round(f, 6) AS best_f FROM best")
def _(spark, sf):
    return rounded(M.best_threshold(_curve(spark, sf)))


@query("best_threshold_beta2", Q.scored(_G, _C, _best(2.0)) + "SELECT threshold, round(f, 6) AS best_f FROM best")
def _(spark, sf):
    return rounded(M.best_threshold(_curve(spark, sf), beta=2.0))


def _boot_sql(draws: str, n_boot: int) -> str:
    return Q.scored(draws, """g AS (SELECT boot, score, sum(times * label)::DOUBLE AS n1, sum(times * (1 - label))::DOUBLE AS n0
   FROM drawn GROUP BY 1, 2),
 c AS (SELECT *, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp, sum(n1) OVER (PARTITION BY boot) AS p,
   sum(n0) OVER (PARTITION BY boot) AS n FROM g WINDOW w AS (PARTITION BY boot ORDER BY score DESC)),
 m AS (SELECT boot, sum(n1 / p * tp / (tp + fp)) AS auprc, sum(n1 * (n - fp + n0 / 2)) / any_value(p * n) AS roc_auc,
   2 * sum(n1) FILTER (score >= 0.2) / (2 * sum(n1) FILTER (score >= 0.2) + sum(n0) FILTER (score >= 0.2)
     + coalesce(sum(n1) FILTER (score < 0.2), 0)) AS f1 FROM c GROUP BY 1),
 l AS (UNPIVOT m ON auprc, f1, roc_auc INTO NAME metric VALUE v)""") + """
SELECT metric, round(quantile_cont(v, 0.025), 6) AS lo, round(quantile_cont(v, 0.975), 6) AS hi FROM l GROUP BY 1"""


_EXACT = f"""i AS (SELECT label, score, row_number() OVER (ORDER BY row_id) - 1 AS idx FROM sc),
 drawn AS (SELECT boot, label, score, 1 AS times FROM (SELECT b AS boot, {hash_sql('s', '(42 + b)')} % (SELECT count(*) FROM sc) AS idx
   FROM range(0, (SELECT count(*) FROM sc)) t(s), range(0, 20) u(b)) JOIN i USING (idx))"""
_POISSON = f"""drawn AS (SELECT boot, label, score, ({' + '.join(f'(u >= {c!r}::DOUBLE)::BIGINT' for c in V.POISSON_CDF)}) AS times
   FROM (SELECT label, score, b AS boot, {uniform_sql('row_id', '(42 + b)')} AS u FROM sc, range(0, 20) t(b)) WHERE u >= {V.POISSON_CDF[0]!r}::DOUBLE)"""


@query("bootstrap_ci", _boot_sql(_EXACT, 20))
def _(spark, sf):
    return rounded(M.bootstrap_ci(T.scored_events(spark, sf), 0.2, 20))


@query("bootstrap_ci_poisson", _boot_sql(_POISSON, 20))
def _(spark, sf):
    return rounded(M.bootstrap_ci(T.scored_events(spark, sf), 0.2, 20, exact=False))


# two "models": the score itself and its mirror image; folds by hash rank
_TWO = """two AS (SELECT 'plain' AS model, row_id, label, score FROM sc
   UNION ALL SELECT 'mirrored', row_id, label, round(5 - score, 2) FROM sc),
 mg AS (SELECT model, score, sum(label)::DOUBLE AS n1, sum(1 - label)::DOUBLE AS n0 FROM two GROUP BY 1, 2),
 mc AS (SELECT *, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp, sum(n1) OVER (PARTITION BY model) AS p,
   sum(n0) OVER (PARTITION BY model) AS n FROM mg WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
 mb AS (SELECT model, score AS t FROM (SELECT model, score, row_number() OVER (PARTITION BY model ORDER BY
     2.0::DOUBLE * (tp / (tp + fp)) * (tp / p) / (1.0::DOUBLE * (tp / (tp + fp)) + tp / p + 1e-12::DOUBLE) DESC, score) AS r FROM mc) WHERE r = 1),
 mm AS (SELECT model, any_value(t) AS threshold, sum(n1 / p * tp / (tp + fp)) AS auprc,
   sum(n1 * (n - fp + n0 / 2)) / any_value(p * n) AS roc_auc,
   coalesce(sum(n1) FILTER (score >= t), 0) AS tp_, coalesce(sum(n0) FILTER (score >= t), 0) AS fp_,
   coalesce(sum(n1) FILTER (score < t), 0) AS fn_, coalesce(sum(n0) FILTER (score < t), 0) AS tn_
   FROM mc JOIN mb USING (model) GROUP BY 1)"""


def _two(spark, sf):
    d = T.scored_events(spark, sf)
    return (d.withColumn("model", F.lit("plain")).unionByName(
        d.withColumn("score", F.round(5 - F.col("score"), 2)).withColumn("model", F.lit("mirrored"))))


@query("comparison_table", Q.scored(_TWO) + """SELECT model, threshold, round(coalesce(tp_ / nullif(tp_ + fp_, 0), 0), 6) AS precision,
  round(coalesce(tp_ / nullif(tp_ + fn_, 0), 0), 6) AS recall, round(coalesce(2 * tp_ / nullif(2 * tp_ + fp_ + fn_, 0), 0), 6) AS f1,
  round((tp_ / (tp_ + fn_) + tn_ / (tn_ + fp_)) / 2, 6) AS balanced_accuracy, round(roc_auc, 6) AS roc_auc,
  round(auprc, 6) AS auprc FROM mm""")
def _(spark, sf):
    counts = M.score_counts(_two(spark, sf), ["model"])
    best = M.best_threshold(M.curve(counts, ["model"]), ["model"]).select("model", "threshold")
    m = M.evaluate_scores(counts.join(best, "model"), F.col("threshold"), ["model"])
    return rounded(m.join(best, "model"))


@query("comparison_pretty", Q.scored(_TWO) + """SELECT model, printf('%.2f', threshold) AS threshold,
  printf('%.3f', tp_ / nullif(tp_ + fp_, 0)) AS precision, printf('%.3f', tp_ / (tp_ + fn_)) AS recall,
  printf('%.3f', 2 * tp_ / (2 * tp_ + fp_ + fn_)) || CASE model WHEN 'plain' THEN
    ' [' || printf('%.2f', roc_auc) || ', ' || printf('%.2f', roc_auc + 0.25::DOUBLE) || ']' ELSE '' END AS f1,
  printf('%.3f', roc_auc) AS roc_auc, printf('%.3f', auprc) AS auprc, printf('%.3f', auprc) AS oof_auprc FROM mm""")
def _(spark, sf):
    counts = M.score_counts(_two(spark, sf), ["model"])
    best = M.best_threshold(M.curve(counts, ["model"]), ["model"]).select("model", "threshold")
    m = M.evaluate_scores(counts.join(best, "model"), F.col("threshold"), ["model"]).join(best, "model")
    none = F.lit(None).cast("double")
    plain = F.col("model") == "plain"
    return M.comparison_pretty(m.withColumns({
        "oof_auprc": F.col("auprc"), "auprc_ci_low": none, "auprc_ci_high": none,
        "f1_ci_low": F.when(plain, F.col("roc_auc")), "f1_ci_high": F.when(plain, F.col("roc_auc") + 0.25)}))


@query("headline_models", Q.scored(_TWO) + "SELECT model, round(auprc, 6) AS auprc FROM mm WHERE model IN ('plain', 'absent')")
def _(spark, sf):
    c = M.curve(M.score_counts(_two(spark, sf), ["model"]), ["model"])
    return rounded(M.average_precision(c, ["model"]).where(F.col("model").isin("plain", "absent")))


_FOLDED = f"""ff AS (SELECT model, label, score, fold FROM two JOIN (SELECT row_id,
   (row_number() OVER (PARTITION BY label ORDER BY {hash_sql('row_id')}, row_id) - 1) * 5 // count(*) OVER (PARTITION BY label) AS fold
   FROM sc) USING (row_id)),
 fg AS (SELECT model, fold, score, sum(label)::DOUBLE AS n1, sum(1 - label)::DOUBLE AS n0 FROM ff GROUP BY 1, 2, 3),
 fc AS (SELECT *, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp, sum(n1) OVER (PARTITION BY model, fold) AS p,
   sum(n0) OVER (PARTITION BY model, fold) AS n FROM fg WINDOW w AS (PARTITION BY model, fold ORDER BY score DESC)),
 fm AS (SELECT model, fold, sum(n1 / p * tp / (tp + fp)) AS auprc, sum(n1 * (n - fp + n0 / 2)) / any_value(p * n) AS roc_auc,
   coalesce(sum(n1) FILTER (score >= 0.5), 0) AS a, coalesce(sum(n0) FILTER (score >= 0.5), 0) AS b,
   coalesce(sum(n1) FILTER (score < 0.5), 0) AS c, coalesce(sum(n0) FILTER (score < 0.5), 0) AS d FROM fc GROUP BY 1, 2),
 fl AS (SELECT model, 'auprc' AS metric, auprc AS v FROM fm UNION ALL SELECT model, 'roc_auc', roc_auc FROM fm
   UNION ALL SELECT model, 'f1', 2 * a / (2 * a + b + c) FROM fm
   UNION ALL SELECT model, 'balanced_accuracy', (a / (a + c) + d / (b + d)) / 2 FROM fm)"""


@query("fold_scores", Q.scored(_TWO, _FOLDED) + """SELECT metric,
  round(avg(v) FILTER (model = 'plain'), 6) AS plain_mean, round(stddev_pop(v) FILTER (model = 'plain'), 6) AS plain_std,
  round(avg(v) FILTER (model = 'mirrored'), 6) AS mirrored_mean, round(stddev_pop(v) FILTER (model = 'mirrored'), 6) AS mirrored_std
  FROM fl GROUP BY 1""")
def _(spark, sf):
    d = V.stratified_folds(_two(spark, sf).where("model = 'plain'").select("row_id", "label")).select("row_id", "fold")
    m = M.evaluate_scores(M.score_counts(_two(spark, sf).join(d, "row_id"), ["model", "fold"]), F.lit(0.5),
                          ["model", "fold"])
    return rounded(M.fold_summary(m, ["auprc", "roc_auc", "f1", "balanced_accuracy"], ["plain", "mirrored"]))


@query("leak_threshold_audit", Q.scored(_G, _C, _best(1.0), f"""th AS (SELECT 'out-of-fold threshold' AS choice, 0.25::DOUBLE AS t
   UNION ALL SELECT 'threshold tuned on test', threshold FROM best),
 m AS (SELECT choice, t, {_AT} FROM sc, th GROUP BY 1, 2)""") + f"""
SELECT choice, t AS threshold, precision, recall, f1, auprc FROM (SELECT choice, t, {_FOUR}, round({_AP}, 6) AS auprc FROM m)""")
def _(spark, sf):
    return rounded(M.threshold_leak_audit(T.scored_events(spark, sf), 0.25))


@query("union_result_rows", Q.scored(_TWO) + """SELECT model, round(auprc, 6) AS auprc, round(roc_auc, 6) AS roc_auc FROM mm""")
def _(spark, sf):
    parts = []
    for name in ("plain", "mirrored"):
        counts = M.score_counts(_two(spark, sf).where(F.col("model") == name))
        parts.append(M.evaluate_scores(counts, F.lit(0.5)).select(F.lit(name).alias("model"), "auprc", "roc_auc"))
    return rounded(parts[0].unionByName(parts[1]))

