"""Unsupervised, neighbour and resampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.hashing import hash_sql, uniform_sql
from ..functions.ranking import value_rank
from ..operators import features as X
from ..operators import linkage as K
from ..operators import resample as R
from ..operators import silhouettes as H
from ..operators import spatial as P
from ..operators import unsupervised as U
from ..operators.cleaning import band
from ..operators.describe import crosstab_rate
from ..sources import tables as T
from . import sqltext as Q
from .base import clean_lots, query, rounded
from .feature_plans import fold_features

XYZ = ["e1", "e2", "e3"]
EPS = 0.06
_D2 = "((a.e1 - b.e1) * (a.e1 - b.e1) + (a.e2 - b.e2) * (a.e2 - b.e2) + (a.e3 - b.e3) * (a.e3 - b.e3))"
_PAIRS = f"pr AS (SELECT a.row_id AS id, b.row_id AS other, {_D2} AS d2 FROM vec a, vec b)"


def tree(spark, sf, leaf_size=256):
    return P.build_tree(T.vectors(spark, sf), "row_id", P.Space(XYZ), leaf_size)


def whole_tree(spark, sf, leaf_size=1024):
    """A tree over all components; in so many dimensions boxes tell little apart, hence the large leaves."""
    v = T.table(spark, sf, "embeddings")
    dims = [f"e{i + 1}" for i in range(v.select(F.size("embedding")).first()[0])]
    wide = v.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(dims)])
    return P.build_tree(wide, "vec_id", P.Space(dims), leaf_size)


@query("knn_join", Q.vec(_PAIRS) + """SELECT id, rank::INT AS rank, other AS neighbour, round(sqrt(d2), 6) AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY sqrt(d2), other) AS rank FROM pr WHERE id <> other) WHERE rank <= 5""")
def _(spark, sf):
    return rounded(P.knn(tree(spark, sf), 5).drop("xs"))


@query("k_distance", Q.vec(_PAIRS) + """SELECT id, round(sqrt(d2), 6) AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, other) AS rank FROM pr) WHERE rank = 7""")
def _(spark, sf):
    return rounded(P.k_distance(tree(spark, sf), 7))


@query("k_distance_curve", Q.vec(_PAIRS, """kd AS (SELECT id, round(sqrt(d2), 9) AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, other) AS rank FROM pr) WHERE rank = 7)""") + """
SELECT row_number() OVER (ORDER BY dist, id) AS point, round(dist, 6) AS dist FROM kd""")
def _(spark, sf):
    kd = P.k_distance(tree(spark, sf), 7).withColumn("dist", F.round("dist", 9))
    return rounded(value_rank(kd, "dist", "id", out="point").select("point", "dist"))


@query("eps_neighbour_counts", Q.vec(_PAIRS) + f"SELECT id, count(*) AS n FROM pr WHERE d2 <= {EPS}::DOUBLE * {EPS}::DOUBLE GROUP BY 1")
def _(spark, sf):
    return P.radius_counts(P.radius_pairs(tree(spark, sf), EPS))


def _clusters(eps: float, min_samples: int) -> str:
    return f"""near AS (SELECT id, other FROM pr WHERE d2 <= {eps}::DOUBLE * {eps}::DOUBLE),
 core AS (SELECT id FROM near GROUP BY 1 HAVING count(*) >= {min_samples}),
 edge AS (SELECT n.id, n.other FROM near n JOIN core a ON a.id = n.id JOIN core b ON b.id = n.other),
 reach(id, other) AS (SELECT id, id FROM core UNION SELECT r.id, e.other FROM reach r JOIN edge e ON e.id = r.other),
 comp AS (SELECT id, min(other) AS first FROM reach GROUP BY 1),
 num AS (SELECT first, row_number() OVER (ORDER BY first) - 1 AS cluster FROM (SELECT DISTINCT first FROM comp)),
 anchor AS (SELECT n.id, min(c.first) AS first FROM near n JOIN comp c ON c.id = n.other GROUP BY 1),
 db AS (SELECT v.row_id AS id, v.label, k.id IS NOT NULL AS is_core,
   coalesce(num.cluster, -1) AS cluster FROM vec v LEFT JOIN core k ON k.id = v.row_id
   LEFT JOIN comp c ON c.id = v.row_id LEFT JOIN anchor a ON a.id = v.row_id
   LEFT JOIN num ON num.first = coalesce(c.first, a.first))"""


def _vec_rec(*ctes):
    return Q.vec(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


@query("density_clusters", _vec_rec(_PAIRS, _clusters(EPS, 7)) + "SELECT id, is_core, cluster FROM db")
def _(spark, sf):
    return P.density_clusters(tree(spark, sf), EPS, 7)


@query("density_sweep", " UNION ALL ".join("SELECT * FROM (" + _vec_rec(_PAIRS, _clusters(e, 7)) + f"""SELECT {e}::DOUBLE AS eps,
  count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters, count(*) FILTER (cluster = -1) AS n_noise FROM db)"""
                                       for e in (0.05, 0.08)))
def _(spark, sf):
    t = tree(spark, sf)
    parts = [U.cluster_summary(P.density_clusters(t, e, 7)).withColumn("eps", F.lit(e)) for e in (0.05, 0.08)]
    return parts[0].unionByName(parts[1])


@query("cluster_class_table", _vec_rec(_PAIRS, _clusters(EPS, 7)) + """SELECT cluster,
  count(*) FILTER (label <> 0) AS n_negative, count(*) FILTER (label = 0) AS n_positive,
  round(avg((label = 0)::INT), 6) AS positive_rate FROM db GROUP BY 1""")
def _(spark, sf):
    c = P.density_clusters(tree(spark, sf), EPS, 7).join(
        T.vectors(spark, sf).select(F.col("row_id").alias("id"), (F.col("label") == 0).cast("int").alias("label")), "id")
    return rounded(crosstab_rate(c, "cluster"))


@query("single_link_cut", _vec_rec(_PAIRS, _clusters(0.045, 1)) + "SELECT id, cluster FROM db")
def _(spark, sf):
    return P.single_link_cut(tree(spark, sf), 0.045)


@query("silhouette_fixed", Q.vec(_PAIRS, """m AS (SELECT id, v.label, w.label AS other_label, sum(d2) AS s, count(*) AS n FROM pr
   JOIN vec v ON v.row_id = id JOIN vec w ON w.row_id = other GROUP BY 1, 2, 3),
 ab AS (SELECT id, sum(s / (n - 1)) FILTER (label = other_label) AS a, min(s / n) FILTER (label <> other_label) AS b
   FROM m GROUP BY 1)""") + "SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab")
def _(spark, sf):
    return rounded(U.silhouette(T.vectors(spark, sf), XYZ, "label"))


@query("single_link_merges", """WITH RECURSIVE ix AS (SELECT row_number() OVER (ORDER BY vec_id) AS i, embedding::DOUBLE[] AS x FROM embeddings),
 dm AS (SELECT a.i, list(list_distance(a.x, b.x) ORDER BY b.i) AS d FROM ix a, ix b GROUP BY a.i),
 prim(k, best, height) AS (SELECT 0, list_transform(d, lambda v, j: CASE WHEN j = 1 THEN 'inf'::DOUBLE ELSE v END), NULL::DOUBLE
   FROM dm WHERE i = 1
  UNION ALL
  SELECT k + 1, list_transform(best, lambda v, j: CASE WHEN j = i OR v = 'inf'::DOUBLE THEN v + 'inf'::DOUBLE ELSE least(v, d[j]) END), list_min(best)
   FROM prim JOIN dm ON dm.i = list_position(best, list_min(best)) WHERE k + 1 < (SELECT count(*) FROM ix))
SELECT row_number() OVER (ORDER BY height) AS merge, round(height, 6) + 0.0 AS height FROM prim WHERE k > 0""")
def _(spark, sf):
    """The heights of all merges over the whole vectors; the SQL grows the spanning tree point by point."""
    # long lists decide most rounds without a search
    edges = K.spanning_tree(whole_tree(spark, sf), 32)
    return rounded(K.merges(edges).select("merge", "height"))


@query("knn_whole", """WITH pr AS (SELECT a.vec_id AS id, b.vec_id AS other, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
   FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)
SELECT id, rank::INT AS rank, other AS neighbour, round(d, 6) + 0.0 AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(d, 12), other) AS rank FROM pr) WHERE rank <= 5""")
def _(spark, sf):
    """The five nearest other rows by all components of the vectors."""
    return rounded(P.knn(whole_tree(spark, sf), 5, coordinates=False))


LOT_COLUMNS = ["altitude", "moisture", "c1", "c2", "latitude", "longitude"]
PROCESSING_CODES = {"Urgent": 1, "High": 2, "Medium": 3}

_STANDARDISED = Q.lots(
    "by_sub AS (SELECT country, subregion, avg(altitude) AS m FROM clean GROUP BY 1, 2)",
    "by_cty AS (SELECT country, avg(altitude) AS m FROM clean GROUP BY 1)",
    """filled AS (SELECT row_id, processing, c1, c2, latitude, longitude,
  coalesce(altitude, s.m, c.m, (SELECT median(altitude) FROM clean)) AS altitude,
  coalesce(moisture, (SELECT median(moisture) FROM clean)) AS moisture FROM clean d
  LEFT JOIN by_sub s ON s.country = d.country AND s.subregion IS NOT DISTINCT FROM d.subregion
  LEFT JOIN by_cty c ON c.country = d.country)""",
    "z AS (SELECT row_id, processing, " + ", ".join(
        f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in LOT_COLUMNS) + " FROM filled)")


def standardised_lots(spark, sf):
    """(row_id, processing, six standardised columns) of every lot, gaps filled."""
    d = X.impute_for_exploration(clean_lots(spark, sf, coordinates=True)).select("row_id", "processing", *LOT_COLUMNS)
    return X.standardise(d, LOT_COLUMNS)


@query("silhouette_euclidean", _STANDARDISED.rstrip() + """,
 k AS (SELECT row_id, CASE processing """ + " ".join(f"WHEN '{n}' THEN {i}" for n, i in PROCESSING_CODES.items()) + """ ELSE 0 END AS cluster,
   altitude, moisture, c1, c2, latitude, longitude FROM z),
 m AS (SELECT a.row_id, a.cluster, b.cluster AS other, count(*) AS n, sum(sqrt(""" + " + ".join(
    f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in LOT_COLUMNS) + """)) AS s FROM k a, k b GROUP BY ALL),
 ab AS (SELECT row_id, cluster, coalesce(sum(s / nullif(n - 1, 0)) FILTER (cluster = other), 0) AS a,
   min(s / n) FILTER (cluster <> other) AS b FROM m GROUP BY ALL)
SELECT cluster::BIGINT AS cluster, count(*) AS n, round(avg((b - a) / greatest(a, b)), 3) + 0.0 AS silhouette FROM ab GROUP BY 1""")
def _(spark, sf):
    """Mean silhouette of the processing classes in six standardised columns; a mean distance is off by 0.02 at most."""
    d = standardised_lots(spark, sf)
    code = F.coalesce(*[F.when(F.col("processing") == n, i) for n, i in PROCESSING_CODES.items()], F.lit(0))
    s = H.euclidean_silhouettes(d.withColumn("code", code), "row_id", LOT_COLUMNS, "code", tol=0.02)
    return rounded(s.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette")), 3)


# --------------------------------------------------------------------------- components and k-means
def _flags(spark, n, **flags):
    return spark.createDataFrame([(k, int(bool(v)), int(n)) for k, v in flags.items()],
                                 "property string, holds int, n_rows long")


def flags_sql(names: list[str], n: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS property, 1 AS holds, ({n}) AS n_rows" for k in names)


_N = "SELECT count(*) FROM embeddings"


@query("pca_invariants", flags_sql(["orthonormal", "ratios_sum_to_one", "ratios_fall", "score_variance_is_eigenvalue",
                                    "scores_uncorrelated"], _N))
def _(spark, sf):
    import numpy as np
    v = T.vectors(spark, sf)
    cols = T.EMBED_DIMS
    ratios, loads, scores = U.principal_components(v, cols)
    r = [x["ratio"] for x in ratios.orderBy("component").collect()]
    m = {(x["feature"], x["component"]): x["loading"] for x in loads.collect()}
    w = np.array([[m[(c, f"pc{j + 1}")] for j in range(6)] for c in cols])
    pcs = [f"pc{j + 1}" for j in range(6)]
    st = scores.agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(p).alias(p) for p in pcs],
                    *[F.corr(pcs[i], pcs[j]).alias(f"x{i}{j}") for i in range(6) for j in range(i)]).first()
    return _flags(spark, st["n"], orthonormal=np.allclose(w.T @ w, np.eye(6), atol=1e-8),
                  ratios_sum_to_one=abs(sum(r) - 1) < 1e-9, ratios_fall=all(a >= b for a, b in zip(r, r[1:])),
                  score_variance_is_eigenvalue=all(abs(st[p] - 6 * x) < 1e-6 for p, x in zip(pcs, r)),
                  scores_uncorrelated=all(abs(st[f"x{i}{j}"]) < 1e-6 for i in range(6) for j in range(i)))


@query("pca_cumulative", Q.vec() + """SELECT 6::BIGINT AS n_components, 1.0::DOUBLE AS cumulative, round(6 + 2 * (""" + " + ".join(
    f"corr(e{i}, e{j}) * corr(e{i}, e{j})" for i in range(2, 7) for j in range(1, i)) + """), 6) AS sum_of_squares FROM vec""")
def _(spark, sf):
    """The eigenvalues (six times the ratios) of a correlation matrix have its squared entries as their sum of squares."""
    ratios, _, _ = U.principal_components(T.vectors(spark, sf), T.EMBED_DIMS)
    return rounded(ratios.agg(F.count(F.lit(1)).alias("n_components"), F.max("cumulative").alias("cumulative"),
                              F.sum(F.pow(6 * F.col("ratio"), 2)).alias("sum_of_squares")))


@query("pca_loadings")
def _(spark, sf):
    _, loads, _ = U.principal_components(T.vectors(spark, sf), T.EMBED_DIMS)
    return loads.groupBy("feature").pivot("component").agg(F.bround(F.first("loading"), 3))


@query("band_projection", Q.vec("st AS (SELECT " + ", ".join(
    f"avg(e{i}) AS m{i}, stddev_pop(e{i}) AS s{i}" for i in range(1, 7)) + " FROM vec)") + """SELECT
  CASE WHEN e1 < -0.05 THEN 0 WHEN e1 < 0.05 THEN 1 ELSE 2 END AS band, count(*) AS n, round(sum(""" + " + ".join(
    f"((e{i} - m{i}) / s{i}) * ((e{i} - m{i}) / s{i})" for i in range(1, 7)) + """), 4) AS energy FROM vec, st GROUP BY 1""")
def _(spark, sf):
    """All components of a row have the squared length of its standardised columns: summed by band."""
    _, _, scores = U.principal_components(T.vectors(spark, sf), T.EMBED_DIMS, keep=("row_id", "e1"))
    length = sum([F.col(f"pc{i}") * F.col(f"pc{i}") for i in range(1, 7)], F.lit(0.0))
    return rounded(scores.select(band("e1", (-0.05, 0.05)).alias("band"), length.alias("d"))
                   .groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("energy")), 4)


@query("kmeans_nearest", flags_sql(["all_rows_at_nearest_centre", "centres_are_means", "cost_is_sum_of_squares"], _N))
def _(spark, sf):
    v = T.vectors(spark, sf).select("row_id", "label", *XYZ)
    model, rows = U.kmeans(v, XYZ, 4, n_init=2)
    centres = model.clusterCenters()
    d = [sum([(F.col(c) - float(m[i])) ** 2 for i, c in enumerate(XYZ)], F.lit(0.0)) for m in centres]
    own = F.coalesce(*[F.when(F.col("cluster") == j, x) for j, x in enumerate(d)])
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(own > F.least(*d) + 1e-9).alias("bad"), F.sum(own).alias("cost"),
                 *[F.avg(F.when(F.col("cluster") == j, F.col(c))).alias(f"m{j}{i}") for j in range(4)
                   for i, c in enumerate(XYZ)]).first()
    means = all(abs(r[f"m{j}{i}"] - centres[j][i]) < 1e-2 for j in range(4) for i in range(3))
    return _flags(spark, r["n"], all_rows_at_nearest_centre=r["bad"] == 0, centres_are_means=means,
                  cost_is_sum_of_squares=abs(r["cost"] - model.summary.trainingCost) < 1e-2)


@query("kmeans_silhouettes")
def _(spark, sf):
    return U.kmeans_silhouettes(T.vectors(spark, sf), T.EMBED_DIMS)


@query("bisecting_tree")
def _(spark, sf):
    return U.bisecting_tree(T.vectors(spark, sf), XYZ, [2, 4, 6])


# --------------------------------------------------------------------------- resampling
_NUM = ["moisture", "c1", "c2", "altitude", "moisture_missing"]
_MIN = Q.imputed("""mi AS (SELECT row_id, moisture::DOUBLE AS moisture, c1::DOUBLE AS c1, c2::DOUBLE AS c2,
    altitude, moisture_missing::DOUBLE AS moisture_missing, macro_area, color, processing, variety
  FROM imp WHERE fold <> 0 AND label = 1),
 pen AS (SELECT median(s) AS p FROM (SELECT UNNEST([stddev_pop(moisture), stddev_pop(c1), stddev_pop(c2),
    stddev_pop(altitude), stddev_pop(moisture_missing)]) AS s FROM mi)),
 dims AS (SELECT (SELECT count(*) FROM mi) AS n1, (SELECT count(*) FROM imp WHERE fold <> 0 AND label = 0) AS n0)""")


def _smote_sql(penalty: str) -> str:
    num = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _NUM)
    cat = " + ".join(f"(a.{c} <> b.{c})::INT" for c in S.CATEGORICAL)
    return _MIN.rstrip() + f""",
 nn AS (SELECT id, other, rank FROM (SELECT a.row_id AS id, b.row_id AS other, row_number() OVER (PARTITION BY a.row_id
    ORDER BY round(sqrt({num} + {penalty} * ({cat})), 9), b.row_id) AS rank FROM mi a, mi b WHERE a.row_id <> b.row_id) WHERE rank <= 5),
 ix AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS idx, * FROM mi),
 slots AS (SELECT s AS slot, {hash_sql('s', '42')} % (SELECT n1 FROM dims) AS idx, {hash_sql('s', '43')} % 5 + 1 AS rank,
    {uniform_sql('s', '44')} AS gap FROM range(0, (SELECT n0 - n1 FROM dims)) t(s))
"""


@query("smote_nc", _smote_sql("(SELECT p * p FROM pen)") + """SELECT slot, b.row_id AS base, n.other AS neighbour,
  round(b.altitude + gap * (o.altitude - b.altitude), 6) AS altitude, round(b.moisture + gap * (o.moisture - b.moisture), 6) AS moisture,
  (SELECT color FROM nn x JOIN mi y ON y.row_id = x.other WHERE x.id = b.row_id GROUP BY color ORDER BY count(*) DESC, color LIMIT 1) AS color,
  (SELECT variety FROM nn x JOIN mi y ON y.row_id = x.other WHERE x.id = b.row_id GROUP BY variety ORDER BY count(*) DESC, variety LIMIT 1) AS variety
FROM slots JOIN ix b USING (idx) JOIN nn n ON n.id = b.row_id AND n.rank = slots.rank JOIN mi o ON o.row_id = n.other""")
def _(spark, sf):
    train = fold_features(spark, sf, scale=False).imputed_for(0).where("fold <> 0")
    syn = R.synthetic_rows(train, _NUM, S.CATEGORICAL)
    return rounded(syn.select("slot", "base", "neighbour", "altitude", "moisture", "color", "variety"))


@query("smote_fractional_audit", _smote_sql("2") + """SELECT count(*) AS n_synthetic, count(*) FILTER (d > 0) AS n_fractional_rows,
  sum(2 * d)::BIGINT AS n_fractional_cells FROM (SELECT (b.macro_area <> o.macro_area)::INT + (b.color <> o.color)::INT
    + (b.processing <> o.processing)::INT + (b.variety <> o.variety)::INT AS d
  FROM slots JOIN ix b USING (idx) JOIN nn n ON n.id = b.row_id AND n.rank = slots.rank JOIN mi o ON o.row_id = n.other)""")
def _(spark, sf):
    train = fold_features(spark, sf, scale=False).imputed_for(0).where("fold <> 0")
    syn = R.synthetic_rows(train, _NUM, S.CATEGORICAL, penalty=2.0 ** 0.5)
    return R.fractional_audit(syn, S.CATEGORICAL)


@query("smote_numeric", _vec_rec("mi AS (SELECT * FROM vec WHERE label = 0)", f"""nn AS (SELECT id, other, rank FROM (
   SELECT a.row_id AS id, b.row_id AS other, row_number() OVER (PARTITION BY a.row_id ORDER BY sqrt({_D2}), b.row_id) AS rank
   FROM mi a, mi b WHERE a.row_id <> b.row_id) WHERE rank <= 5)""", "ix AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS idx, * FROM mi)",
    f"""slots AS (SELECT s AS slot, {hash_sql('s', '42')} % (SELECT count(*) FROM mi) AS idx, {hash_sql('s', '43')} % 5 + 1 AS rank,
    {uniform_sql('s', '44')} AS gap FROM range(0, (SELECT count(*) - 2 * (SELECT count(*) FROM mi) FROM vec)) t(s))""") + """
SELECT slot, b.row_id AS base, n.other AS neighbour, round(b.e1 + gap * (o.e1 - b.e1), 6) AS e1,
  round(b.e2 + gap * (o.e2 - b.e2), 6) AS e2, round(b.e3 + gap * (o.e3 - b.e3), 6) AS e3
FROM slots JOIN ix b USING (idx) JOIN nn n ON n.id = b.row_id AND n.rank = slots.rank JOIN mi o ON o.row_id = n.other""")
def _(spark, sf):
    v = T.vectors(spark, sf).withColumn("label", (F.col("label") == 0).cast("int"))
    return rounded(R.synthetic_rows(v, XYZ, []).drop("gap"))


@query("balanced_after_resampling", Q.folds() + """SELECT l AS label, (SELECT count(*) FROM fd WHERE fold <> 0 AND label = 0) AS n
  FROM (SELECT 0 AS l UNION ALL SELECT 1)""")
def _(spark, sf):
    train = fold_features(spark, sf, scale=False).imputed_for(0).where("fold <> 0")
    return R.oversample(train, _NUM, S.CATEGORICAL).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
