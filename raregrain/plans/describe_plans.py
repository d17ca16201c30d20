"""Descriptive-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import materialise
from ..operators import describe as D
from ..operators.cleaning import band
from ..sources import tables as T
from . import sqltext as Q
from .base import clean_lots, query, rounded

_COLS = {"altitude": "double", "moisture": "double", "subregion": "string", "variety": "string",
         "processing": "string", "c1": "long", "country": "string", "latitude": "double"}


@query("missingness", Q.lots() + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{k}' AS kind, round(avg(({c} IS NULL)::INT) * 100, 1) AS missing_pct,
  count(DISTINCT {c}) AS n_unique FROM clean""" for c, k in _COLS.items()))
def _(spark, sf):
    return D.missingness(clean_lots(spark, sf, coordinates=True).select(*_COLS))


@query("missing_counts", Q.lots("m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM clean" for c in _COLS) + ")")
    + "SELECT * FROM m WHERE n_missing > 0")
def _(spark, sf):
    return D.missing_counts(clean_lots(spark, sf, coordinates=True).select(*_COLS))


@query("class_balance", Q.lots() + """SELECT CASE label WHEN 1 THEN 'positive' ELSE 'negative' END AS class,
  count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percentage FROM clean GROUP BY label""")
def _(spark, sf):
    return D.class_balance(clean_lots(spark, sf))


_RATE = """count(*) AS n, sum(label)::BIGINT AS n_positive, round(avg(label), 6) AS positive_rate,
  round(avg(score), 4) AS mean_score"""


@query("rate_by_country", Q.lots() + f"SELECT country, {_RATE} FROM clean WHERE country IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return rounded(D.rate_by(clean_lots(spark, sf), "country"), mean_score=4)


@query("rate_by_min_n", Q.lots() + f"SELECT variety, {_RATE} FROM clean GROUP BY 1 HAVING count(*) >= 420")
def _(spark, sf):
    return rounded(D.rate_by(clean_lots(spark, sf), "variety", min_n=420), mean_score=4)


@query("rate_by_all", Q.lots() + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS level, {_RATE} FROM clean WHERE {c} IS NOT NULL GROUP BY 2"
    for c in ("processing", "color", "variety", "country")))
def _(spark, sf):
    return rounded(D.rate_by_all(clean_lots(spark, sf), ["processing", "color", "variety", "country"]), mean_score=4)


@query("document_label_rates", """SELECT lang, source, count(*) AS n, sum(quality)::BIGINT AS n_positive,
  round(avg(quality), 6) AS positive_rate, round(avg(n_chars), 4) AS mean_score
  FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""")
def _(spark, sf):
    d = (T.table(spark, sf, "documents").select("doc_id", "lang", "source", F.col("n_chars").alias("score"))
         .join(T.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id"))
    return rounded(d.groupBy("lang", "source").agg(*D._rates()), mean_score=4)


@query("topk_rates", Q.lots() + f"SELECT country, {_RATE} FROM clean GROUP BY 1 ORDER BY avg(label) DESC, country LIMIT 5")
def _(spark, sf):
    return rounded(D.rate_by(clean_lots(spark, sf), "country").limit(5), mean_score=4)


@query("crosstab_rate", Q.lots() + """SELECT band, count(*) FILTER (label = 0) AS n_negative,
  count(*) FILTER (label = 1) AS n_positive, round(avg(label), 6) AS positive_rate FROM (
  SELECT label, CASE WHEN altitude < 1200 THEN 0 WHEN altitude < 6000 THEN 1 ELSE 2 END AS band FROM clean) GROUP BY 1""")
def _(spark, sf):
    d = clean_lots(spark, sf).withColumn("band", band("altitude", T.BAND_EDGES))
    return rounded(D.crosstab_rate(d, "band"))


_NUM = ["altitude", "moisture", "c1", "c2"]
_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, label, {c}::DOUBLE AS value FROM clean WHERE {c} IS NOT NULL" for c in _NUM) + ")"


@query("class_medians", Q.lots(_LONG) + """SELECT feature, round(median(value) FILTER (label = 0), 6) AS median_negative,
  round(median(value) FILTER (label = 1), 6) AS median_positive,
  round(avg(value) FILTER (label = 1) - avg(value) FILTER (label = 0), 6) AS mean_difference FROM long GROUP BY 1""")
def _(spark, sf):
    return rounded(D.class_medians(clean_lots(spark, sf), _NUM))


@query("mann_whitney", Q.lots(_LONG, """r AS (
  SELECT feature, label, value, count(*) OVER (PARTITION BY feature, value) AS t,
    rank() OVER (PARTITION BY feature ORDER BY value) AS rk FROM long),
 s AS (SELECT feature, sum(label)::DOUBLE AS n1, sum(1 - label)::DOUBLE AS n0,
    sum(CASE WHEN label = 1 THEN rk + (t - 1) / 2.0::DOUBLE END) AS r1, sum((t * t - 1)::DOUBLE) AS ties
  FROM r GROUP BY 1)""") + """
SELECT feature, round(r1 - n1 * (n1 + 1) / 2, 4) AS u_positive,
  round(greatest((abs(r1 - n1 * (n1 + 1) / 2 - n1 * n0 / 2) - 0.5) /
   sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))), 0), 6) AS z FROM s""")
def _(spark, sf):
    return rounded(D.rank_test(clean_lots(spark, sf), _NUM), u_positive=4)


@query("mann_whitney_pvalues")
def _(spark, sf):
    return D.mann_whitney(clean_lots(spark, sf), _NUM)


@query("corr_matrix", Q.vec() + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, '{b}' AS other, round(corr({a}, {b}), 6) AS r FROM vec"
    for a in T.EMBED_DIMS for b in T.EMBED_DIMS))
def _(spark, sf):
    return rounded(D.correlation_long(T.vectors(spark, sf), T.EMBED_DIMS))


@query("describe_numeric", Q.lots(_LONG) + """SELECT feature, count(*) AS n, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS sd, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1,
  round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max
  FROM long GROUP BY 1""")
def _(spark, sf):
    return rounded(D.describe_numeric(clean_lots(spark, sf), _NUM))


@query("score_histogram", Q.lots("b AS (SELECT min(score) AS lo, (max(score) - min(score)) / 40 AS w FROM clean)") + """
SELECT least(floor((score - lo) / w), 39)::BIGINT AS bin, count(*) AS n FROM clean, b GROUP BY 1""")
def _(spark, sf):
    return D.histogram(clean_lots(spark, sf), "score", 40)


@query("share_above_cut", Q.lots() + """SELECT count(*) FILTER (score >= 460000) AS n_above,
  round(count(*) FILTER (score >= 460000) * 100.0::DOUBLE / count(*), 6) AS share_pct FROM clean""")
def _(spark, sf):
    return rounded(D.share_above(clean_lots(spark, sf), "score", T.SCORE_CUT))


@query("box_stats", Q.lots("""q AS (SELECT label, quantile_cont(altitude, 0.25) AS q1, median(altitude) AS m,
   quantile_cont(altitude, 0.75) AS q3 FROM clean WHERE altitude IS NOT NULL GROUP BY 1)""") + """
SELECT q.label, round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(altitude) FILTER (altitude BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(altitude) FILTER (altitude BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (NOT altitude BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM clean c JOIN q ON c.label = q.label WHERE altitude IS NOT NULL GROUP BY q.label""")
def _(spark, sf):
    return rounded(D.box_stats(clean_lots(spark, sf), "altitude", "label"))


_QCUT = """r AS (SELECT row_id, moisture AS x, score AS y, row_number() OVER (ORDER BY moisture, row_id) AS rk,
   count(*) OVER () AS n FROM clean WHERE moisture IS NOT NULL),
 qb AS (SELECT *, (greatest(ceil((rk - 1) * 8 / (n - 1)::DOUBLE), 1) - 1)::BIGINT AS bin FROM r)"""


@query("qcut_bins", Q.lots(_QCUT) + "SELECT row_id, bin FROM qb")
def _(spark, sf):
    d = clean_lots(spark, sf).where("moisture IS NOT NULL").select("row_id", "moisture")
    return D.equal_count_bins(d, "moisture").select("row_id", "bin")


@query("binned_curve", Q.lots(_QCUT) + """SELECT bin, round(avg(x), 6) AS mean_x, round(avg(y), 4) AS mean_y,
  count(*) AS n FROM qb GROUP BY 1""")
def _(spark, sf):
    d = clean_lots(spark, sf).where("moisture IS NOT NULL").select("row_id", "moisture", "score")
    return rounded(D.binned_curve(d, "moisture", "score"), mean_y=4)


def _scatter(x, y):
    return Q.lots(f"""d AS (SELECT {x} AS x, {y} AS y, label FROM clean WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
 b AS (SELECT min(x) AS x0, (max(x) - min(x)) / 20 AS xw, min(y) AS y0, (max(y) - min(y)) / 20 AS yw FROM d)""") + """
SELECT least(floor((x - x0) / xw), 19)::BIGINT AS cell_x, least(floor((y - y0) / yw), 19)::BIGINT AS cell_y, label,
  count(*) AS n FROM d, b GROUP BY 1, 2, 3"""


@query("scatter_altitude_score", _scatter("altitude", "score"))
def _(spark, sf):
    return D.scatter_cells(clean_lots(spark, sf), "altitude", "score")


@query("scatter_geography", _scatter("longitude", "latitude"))
def _(spark, sf):
    return D.scatter_cells(clean_lots(spark, sf, coordinates=True), "longitude", "latitude")


@query("average_rank", Q.scored() + """SELECT row_id, rank() OVER (ORDER BY score)
  + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS avg_rank FROM sc""")
def _(spark, sf):
    from ..functions.ranking import running_sums
    d = T.scored_events(spark, sf)
    per = running_sums(d.groupBy("score").agg(F.count(F.lit(1)).alias("n")), "score", {"cum": "n"})
    # Stored, so that its size is known: rows are not shuffled on a few hot scores where it is small.
    ranks = materialise(per.select("score", (F.col("cum") - F.col("n") + (F.col("n") + 1) / 2.0).alias("avg_rank")))
    return d.join(ranks, "score").select("row_id", "avg_rank")


@query("tie_broken_rank", Q.scored() + "SELECT row_id, row_number() OVER (ORDER BY score, row_id) AS rn FROM sc")
def _(spark, sf):
    from ..functions.ranking import value_rank
    return value_rank(T.scored_events(spark, sf), "score", "row_id").select("row_id", "rn")


@query("widest_effect_first", Q.lots("""w AS (SELECT variety AS feature,
    round(avg(moisture) FILTER (label = 1), 6) AS a, round(-avg(moisture) FILTER (label = 0), 6) AS b FROM clean GROUP BY 1)""") + """
SELECT feature, a, b FROM w ORDER BY greatest(abs(coalesce(a, 0)), abs(coalesce(b, 0))) DESC, feature LIMIT 10""")
def _(spark, sf):
    from ..operators.lookups import side_by_side
    d = clean_lots(spark, sf)
    a = d.where("label = 1").groupBy(F.col("variety").alias("feature")).agg(F.round(F.avg("moisture"), 6).alias("coef"))
    b = d.where("label = 0").groupBy(F.col("variety").alias("feature")).agg(F.round(-F.avg("moisture"), 6).alias("coef"))
    long = a.withColumn("model", F.lit("a")).unionByName(b.withColumn("model", F.lit("b")))
    return side_by_side(long, ["a", "b"]).limit(10)
