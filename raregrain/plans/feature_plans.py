"""Learned-transform and sampling queries; statistics always come from folds 1-4 only."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.hashing import hash_sql, uniform_sql
from ..functions.scratch import materialise
from ..operators import features as X
from ..operators import sampling as V
from ..operators.cleaning import model_matrix
from ..sources import tables as T
from . import sqltext as Q
from .base import clean_lots, query, rounded


def folded(spark, sf):
    return V.stratified_folds(materialise(model_matrix(clean_lots(spark, sf))))


def train(df):
    return df.where("fold <> 0")


@query("eda_imputation", Q.lots("""s AS (SELECT country, subregion, avg(altitude) AS m FROM clean GROUP BY 1, 2),
  c AS (SELECT country, avg(altitude) AS m FROM clean GROUP BY 1)""") + """
SELECT row_id, round(coalesce(altitude, s.m, c.m, (SELECT median(altitude) FROM clean)), 8) AS altitude,
  round(coalesce(moisture, (SELECT median(moisture) FROM clean)), 8) AS moisture
FROM clean d LEFT JOIN s ON s.country = d.country AND s.subregion IS NOT DISTINCT FROM d.subregion
LEFT JOIN c ON c.country = d.country""")
def _(spark, sf):
    return rounded(X.impute_for_exploration(clean_lots(spark, sf)).select("row_id", "altitude", "moisture"), 8)


@query("group_means", Q.lots() + """SELECT country, subregion, round(avg(altitude), 8) AS mean_altitude FROM clean
  WHERE altitude IS NOT NULL GROUP BY 1, 2 UNION ALL
  SELECT country, '*', round(avg(altitude), 8) FROM clean WHERE altitude IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    d = clean_lots(spark, sf).where("altitude IS NOT NULL")
    a = d.groupBy("country", "subregion").agg(F.avg("altitude").alias("mean_altitude"))
    b = d.groupBy("country").agg(F.avg("altitude").alias("mean_altitude")).withColumn("subregion", F.lit("*"))
    return rounded(a.unionByName(b), 8)


@query("column_median", Q.lots() + """SELECT round(median(altitude), 6) AS altitude, round(median(moisture), 6) AS moisture,
  round(median(score), 6) AS score FROM clean""")
def _(spark, sf):
    from ..functions.ranking import exact_quantiles, melt
    long = melt(clean_lots(spark, sf), [], ["altitude", "moisture", "score"])
    m = exact_quantiles(long, "value", {"m": 0.5}, ["feature"])
    return rounded(m.agg(*[F.max(F.when(F.col("feature") == c, F.col("m"))).alias(c)
                           for c in ("altitude", "moisture", "score")]))


@query("fit_altitude_fold", Q.imputed() + "SELECT row_id, altitude FROM imp")
def _(spark, sf):
    d = folded(spark, sf)
    return X.GroupMeanImputer().fit(train(d)).transform(d).select("row_id", "altitude")


@query("fit_moisture_fold", Q.imputed() + "SELECT row_id, moisture, moisture_missing FROM imp")
def _(spark, sf):
    d = folded(spark, sf)
    return X.MedianFlagImputer().fit(train(d)).transform(d).select("row_id", "moisture", "moisture_missing")


@query("area_mapper", Q.imputed() + "SELECT row_id, macro_area FROM imp")
def _(spark, sf):
    d = X.AreaMapper(T.area_map(spark, sf)).transform(model_matrix(clean_lots(spark, sf)))
    assert "country" not in d.columns
    return d.select("row_id", "macro_area")


def fold_features(spark, sf, fits=(0,), **options):
    return X.FoldFeatures(folded(spark, sf), T.area_map(spark, sf), list(fits), **options)


def _prepared(spark, sf, engineer=False):
    """All rows, imputed by statistics of folds 1-4."""
    return fold_features(spark, sf, engineer=engineer, scale=False).imputed_for(0)


_ENG = """SELECT row_id, round(ln(1 + c1), 6) AS log_c1, round(ln(1 + c2), 6) AS log_c2, (c1 > 0)::INT AS has_c1,
  round(ln(1 + greatest(altitude / (moisture + 0.0001::DOUBLE), 0)), 6) AS log_altitude_moisture FROM imp"""


@query("engineer", Q.imputed() + _ENG)
def _(spark, sf):
    d = _prepared(spark, sf, engineer=True)
    return rounded(d.select("row_id", "log_c1", "log_c2", "has_c1", "log_altitude_moisture"))


@query("scale_population", Q.imputed("""st AS (SELECT avg(altitude) AS am, stddev_pop(altitude) AS asd,
   avg(moisture) AS mm, stddev_pop(moisture) AS msd, avg(c2) AS cm, stddev_pop(c2) AS csd FROM imp WHERE fold <> 0)""") + """
SELECT row_id, round((altitude - am) / asd, 6) + 0 AS altitude, round((moisture - mm) / msd, 6) + 0 AS moisture,
  round((c2 - cm) / csd, 6) + 0 AS c2 FROM imp, st""")
def _(spark, sf):
    d = _prepared(spark, sf)
    m = X.Encoder(["altitude", "moisture", "c2"], []).fit(train(d))
    return rounded(m.wide(d, ["row_id"]))


@query("rare_pool", Q.imputed(Q.LEVELS) + """SELECT level, count(*) AS n FROM pooled WHERE variable = 'variety' GROUP BY 1""")
def _(spark, sf):
    d = _prepared(spark, sf)
    m = X.Encoder([], ["variety"]).fit(train(d))
    w = m.wide(d, [])
    long = w.agg(*[F.sum(F.col(f"`{c}`")).cast("long").alias(c) for c in w.columns]).unpivot(
        [], [f"`{c}`" for c in w.columns], "name", "n")
    return long.select(F.regexp_replace("name", "^variety_", "").alias("level"), "n")


def _one_hot(spark, sf, reference=None):
    d = _prepared(spark, sf)
    m = X.Encoder([], S.CATEGORICAL, reference=reference).fit(train(d))
    w = m.wide(d, ["row_id"])
    return (w.unpivot(["row_id"], [f"`{c}`" for c in w.columns[1:]], "feature", "value")
            .where("value = 1").select("row_id", "feature"))


@query("one_hot", Q.imputed(Q.LEVELS) + """SELECT row_id, variable || '_' || level AS feature FROM pooled WHERE level IS NOT NULL""")
def _(spark, sf):
    return _one_hot(spark, sf)


@query("one_hot_reference", Q.imputed(Q.LEVELS) + """SELECT row_id, variable || '_' || level AS feature FROM pooled
  WHERE level IS NOT NULL AND NOT ((variable = 'macro_area' AND level = 'ASIA') OR (variable = 'color' AND level = 'o')
    OR (variable = 'processing' AND level = 'Urgent') OR (variable = 'variety' AND level = CASE WHEN EXISTS
      (SELECT 1 FROM lv WHERE variable = 'variety' AND level = 'Brand#11') THEN 'Brand#11' ELSE 'Rare' END))""")
def _(spark, sf):
    return _one_hot(spark, sf, T.REFERENCE_LEVELS)


_STATS = Q.imputed(Q.LEVELS, """num AS (
  SELECT row_id, fold, UNNEST(['moisture', 'c1', 'c2', 'altitude', 'moisture_missing']) AS feature,
     UNNEST([moisture, c1, c2, altitude, moisture_missing]::DOUBLE[]) AS x FROM imp),
 st AS (SELECT feature, avg(x) AS m, stddev_pop(x) AS s FROM num WHERE fold <> 0 GROUP BY 1),
 enc AS (SELECT row_id, feature, (x - m) / s AS value FROM num JOIN st USING (feature)
   UNION ALL SELECT row_id, variable || '_' || level, 1 FROM pooled WHERE level IS NOT NULL)""")


@query("encoded_long", _STATS + """SELECT row_id, feature, round(value, 6) + 0 AS value FROM enc WHERE round(value, 6) <> 0""")
def _(spark, sf):
    ff = fold_features(spark, sf)
    w = ff.encoder(0).wide(ff.imputed_for(0), ["row_id"])
    return rounded(w.unpivot(["row_id"], [f"`{c}`" for c in w.columns[1:]], "feature", "value")).where("value <> 0")


@query("feature_vector_sums", _STATS + """SELECT feature, round(sum(value), 4) + 0 AS total FROM enc GROUP BY 1""")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = folded(spark, sf)
    fitted = X.feature_pipeline(T.area_map(spark, sf)).fit(train(d))
    names = X.feature_names(fitted)
    v = X.to_matrix(fitted, d).select(F.posexplode(vector_to_array("features")).alias("pos", "value"))
    sums = v.groupBy("pos").agg(F.sum("value").alias("total"))
    return rounded(sums.select(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1).alias("feature"),
                               "total"), 4)


@query("select_columns", _STATS + """SELECT row_id, round(max(value) FILTER (feature = 'altitude'), 6) + 0 AS altitude,
  coalesce(max(value) FILTER (feature = 'variety_Rare'), 0) AS "variety_Rare" FROM enc GROUP BY 1""")
def _(spark, sf):
    ff = fold_features(spark, sf)
    m = ff.encoder(0).select(["variety_infrequent_sklearn", "altitude", "no_such_column"])
    return rounded(m.wide(ff.imputed_for(0), ["row_id"]))


# --------------------------------------------------------------------------- sampling
@query("portable_hash", f"SELECT o_orderkey AS row_id, {hash_sql('o_orderkey')} AS h FROM orders")
def _(spark, sf):
    from ..functions.hashing import portable_hash
    return T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"),
                                               portable_hash("o_orderkey", 42).alias("h"))


@query("stratified_holdout", Q.folds() + "SELECT row_id, label, is_test FROM fd")
def _(spark, sf):
    return V.stratified_holdout(clean_lots(spark, sf).select("row_id", "label"))


@query("stratified_folds", Q.folds() + "SELECT row_id, label, fold FROM fd")
def _(spark, sf):
    return V.stratified_folds(clean_lots(spark, sf).select("row_id", "label"))


@query("nested_es_split", Q.folds(f"""inner_rows AS (SELECT row_id, label, fold, row_number() OVER (PARTITION BY label
   ORDER BY {hash_sql('row_id', '123')}, row_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM fd WHERE fold <> 2)""") + """
SELECT row_id, label, fold, r <= ceil(round(0.2::DOUBLE * n, 9)) AS is_validation FROM inner_rows""")
def _(spark, sf):
    return V.early_stopping_split(V.stratified_folds(clean_lots(spark, sf).select("row_id", "label")), 2)


@query("dataset_summary", Q.folds() + """SELECT count(*) AS n_rows, sum(label)::BIGINT AS n_positive,
  count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test,
  count(*) FILTER (NOT is_test AND label = 1) AS positives_train, count(*) FILTER (is_test AND label = 1) AS positives_test
  FROM fd""")
def _(spark, sf):
    return V.split_summary(V.stratified_holdout(clean_lots(spark, sf).select("row_id", "label")))


@query("split_disjoint_semi", Q.folds() + """SELECT count(*) AS n_overlap FROM fd a
  WHERE NOT is_test AND EXISTS (SELECT 1 FROM fd b WHERE b.is_test AND b.row_id = a.row_id)""")
def _(spark, sf):
    from ..operators.lookups import overlap
    d = V.stratified_holdout(clean_lots(spark, sf).select("row_id", "label"))
    return overlap(d.where("NOT is_test"), d.where("is_test"), "row_id")


@query("balanced_weights", Q.lots() + """SELECT row_id, label, round(count(*) OVER () / (2.0::DOUBLE * count(*) OVER
  (PARTITION BY label)), 6) AS weight FROM clean""")
def _(spark, sf):
    return rounded(V.balanced_weights(clean_lots(spark, sf).select("row_id", "label")))


@query("bootstrap_counts", Q.scored(f"""i AS (SELECT row_id, label, score, row_number() OVER (ORDER BY row_id) - 1 AS idx,
    count(*) OVER () AS n FROM sc),
 d AS (SELECT b AS boot, {hash_sql('s', '(42 + b)')} % (SELECT count(*) FROM sc) AS idx
   FROM range(0, (SELECT count(*) FROM sc)) t(s), range(0, 5) u(b))""") + """
SELECT boot, row_id, count(*) AS times FROM d JOIN i USING (idx) GROUP BY 1, 2""")
def _(spark, sf):
    return V.bootstrap_counts(T.scored_events(spark, sf), 5).select("boot", "row_id", "times")


@query("poisson_bootstrap_counts", Q.scored(f"""d AS (SELECT row_id, b AS boot, {uniform_sql('row_id', '(42 + b)')} AS u
   FROM sc, range(0, 5) t(b)),
 w AS (SELECT boot, row_id, ({' + '.join(f'(u >= {c!r}::DOUBLE)::BIGINT' for c in V.POISSON_CDF)})::BIGINT AS times FROM d)""")
    + "SELECT boot, row_id, times FROM w WHERE times > 0")
def _(spark, sf):
    return V.poisson_counts(T.scored_events(spark, sf), 5).select("boot", "row_id", "times")


@query("permute_column", Q.folds(f"""p AS (SELECT fold, row_id, row_number() OVER (PARTITION BY fold ORDER BY
    {hash_sql('row_id')}, row_id) AS pos FROM fd),
 q AS (SELECT fold, r AS repeat, score, row_number() OVER (PARTITION BY fold, r ORDER BY
    {hash_sql('row_id', '(43 + r)')}, row_id) AS pos FROM fd, range(0, 3) t(r))""") + """
SELECT p.row_id, p.fold, q.repeat::INT AS repeat, q.score AS donor_score FROM p JOIN q USING (fold, pos)""")
def _(spark, sf):
    d = V.stratified_folds(clean_lots(spark, sf).select("row_id", "label", "score"))
    return V.permuted_donors(d, ["score"], 3).select("row_id", "fold", "repeat", "donor_score")
