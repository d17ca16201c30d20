"""Cleaning, lookup-join and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import cleaning as C
from ..operators import lookups as L
from ..sources import tables as T
from . import sqltext as Q
from .base import RULES, clean_lots, query


@query("clean_lots", Q.lots() + """SELECT row_id, score, country, subregion, altitude, moisture, c1, c2, variety,
  processing, color, latitude, longitude, label FROM clean""")
def _(spark, sf):
    return clean_lots(spark, sf, coordinates=True)


@query("cleaning_audit", Q.lots("""f AS (SELECT score > 0 AS k1, country IS NOT NULL OR subregion IS NOT NULL AS k2,
    altitude IS NULL OR altitude BETWEEN -900 AND 9900 AS k3,
    coalesce(trim(processing), 'Unknown') <> '5-LOW' AS k4, moisture FROM raw_lots)""") + """
SELECT 0 AS step_no, 'raw' AS step, count(*) AS rows, 0::BIGINT AS recoded FROM f
UNION ALL SELECT 1, 'drop placeholder score', count(*) FILTER (k1), 0 FROM f
UNION ALL SELECT 2, 'drop rows without geography', count(*) FILTER (k1 AND k2), 0 FROM f
UNION ALL SELECT 3, 'drop implausible altitudes', count(*) FILTER (k1 AND k2 AND k3), 0 FROM f
UNION ALL SELECT 4, 'drop processing level', count(*) FILTER (k1 AND k2 AND k3 AND k4), 0 FROM f
UNION ALL SELECT 5, 'recode zero moisture', count(*) FILTER (k1 AND k2 AND k3 AND k4),
  count(*) FILTER (k1 AND k2 AND k3 AND k4 AND moisture = 0) FROM f""")
def _(spark, sf):
    return C.cleaning_audit(T.raw_lots(spark, sf), RULES)


@query("placeholder_filter", "SELECT row_id, score FROM (WITH " + Q.RAW + " SELECT * FROM raw_lots) WHERE score > 1000")
def _(spark, sf):
    return T.raw_lots(spark, sf).where(C.above("score", 1000)).select("row_id", "score")


@query("drop_admin_columns", "WITH " + Q.RAW + """ SELECT row_id, score, country, subregion, altitude, moisture, c1, c2,
  variety, processing, color FROM raw_lots""")
def _(spark, sf):
    return T.raw_lots(spark, sf).drop(*T.ADMIN)


@query("text_hygiene", "WITH " + Q.RAW + """ SELECT row_id, nullif(trim(processing), '') AS processing,
  nullif(trim(ico_number), '') AS ico_number, nullif(trim(owner), '') AS owner FROM raw_lots""")
def _(spark, sf):
    return C.text_hygiene(T.raw_lots(spark, sf).select("row_id", "processing", "ico_number", "owner"))


@query("drop_rows_without_geography", "WITH " + Q.RAW + """ SELECT row_id, country, subregion FROM (
  SELECT row_id, nullif(country, 'CHINA') AS country, subregion FROM raw_lots)
  WHERE country IS NOT NULL OR subregion IS NOT NULL""")
def _(spark, sf):
    d = T.raw_lots(spark, sf).select("row_id", F.nullif("country", F.lit("CHINA")).alias("country"), "subregion")
    return d.where(C.has_geography())


@query("label_harmonise", "WITH " + Q.RAW + """ SELECT row_id, CASE trim(processing) WHEN '1-URGENT' THEN 'Urgent'
  WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Other' ELSE trim(processing) END AS processing,
  CASE lower(color) WHEN 'p' THEN 'o' ELSE lower(color) END AS color FROM raw_lots""")
def _(spark, sf):
    d = C.text_hygiene(T.raw_lots(spark, sf).select("row_id", "processing", "color"))
    return d.withColumns({"processing": C.relabel(F.col("processing"), T.PROCESSING_LABELS),
                          "color": C.relabel(F.lower("color"), T.COLOR_MERGE)})


@query("constant_fill", "WITH " + Q.RAW + " SELECT row_id, coalesce(c1, 0) AS c1, coalesce(c2, 0) AS c2 FROM raw_lots")
def _(spark, sf):
    return T.raw_lots(spark, sf).select("row_id", "c1", "c2").transform(C.fill_constant, ["c1", "c2"])


@query("range_filter_keep_null", "WITH " + Q.RAW + """ SELECT row_id, altitude FROM raw_lots
  WHERE altitude IS NULL OR altitude BETWEEN -900 AND 9900""")
def _(spark, sf):
    return T.raw_lots(spark, sf).where(C.in_range_or_missing("altitude", *T.ALTITUDE_RANGE)).select("row_id", "altitude")


@query("unknown_level", "WITH " + Q.RAW + """ SELECT row_id, coalesce(processing, 'Unknown') AS processing,
  coalesce(color, 'Unknown') AS color, coalesce(variety, 'Unknown') AS variety FROM raw_lots""")
def _(spark, sf):
    cols = ["processing", "color", "variety"]
    return T.raw_lots(spark, sf).select("row_id", *cols).fillna(S.UNKNOWN, subset=cols)


@query("drop_level", "WITH " + Q.RAW + """, h AS (SELECT row_id, coalesce(trim(processing), 'Unknown') AS processing FROM raw_lots)
  SELECT * FROM h WHERE processing <> '5-LOW'""")
def _(spark, sf):
    d = T.raw_lots(spark, sf).select("row_id", F.trim("processing").alias("processing"))
    return d.where(C.not_level("processing", "5-LOW")).transform(C.fill_constant, ["processing"], S.UNKNOWN)


@query("sentinel_to_null", "WITH " + Q.RAW + """ SELECT row_id, nullif(moisture, 0) AS moisture,
  coalesce(moisture = 0, false)::INT AS recoded FROM raw_lots""")
def _(spark, sf):
    return T.raw_lots(spark, sf).select("row_id", C.zero_to_missing("moisture").alias("moisture"),
                                        F.coalesce(F.col("moisture") == 0, F.lit(False)).cast("int").alias("recoded"))


@query("target_flag", "SELECT o_orderkey AS row_id, (o_totalprice >= 460000)::INT AS label FROM orders")
def _(spark, sf):
    d = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("score"))
    return C.add_target(d, T.SCORE_CUT).select("row_id", "label")


@query("model_matrix", Q.lots() + """SELECT row_id, moisture, c1, c2, altitude, country, subregion, variety, processing,
  color, label FROM clean""")
def _(spark, sf):
    return C.model_matrix(clean_lots(spark, sf))


@query("numeric_block", Q.lots() + """SELECT row_id, moisture, c1, c2, altitude, longitude, abs(latitude) AS latitude_abs
  FROM clean WHERE moisture IS NOT NULL AND altitude IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL""")
def _(spark, sf):
    return C.numeric_block(clean_lots(spark, sf, coordinates=True))


@query("complete_rows", Q.lots() + """SELECT row_id, moisture, altitude, label FROM clean
  WHERE moisture IS NOT NULL AND altitude IS NOT NULL""")
def _(spark, sf):
    return C.complete_rows(clean_lots(spark, sf), ["moisture", "altitude"])


@query("altitude_band", Q.lots() + """SELECT row_id, CASE WHEN altitude < 1200 THEN 0 WHEN altitude < 6000 THEN 1 ELSE 2 END AS band,
  CASE WHEN altitude < 1200 THEN 'Low' WHEN altitude < 6000 THEN 'Medium' ELSE 'High' END AS band_name FROM clean""")
def _(spark, sf):
    d = clean_lots(spark, sf).select("row_id", C.band("altitude", T.BAND_EDGES).alias("band"))
    return d.withColumn("band_name", F.element_at(F.array(*[F.lit(n) for n in ("Low", "Medium", "High")]),
                                                  F.col("band") + 1))


# --------------------------------------------------------------------------- joins
@query("null_safe_lookup", Q.lots() + "SELECT row_id, country, subregion, latitude, longitude FROM clean")
def _(spark, sf):
    return clean_lots(spark, sf, coordinates=True).select("row_id", "country", "subregion", "latitude", "longitude")


@query("macro_area_map", Q.lots(Q.AREA) + """SELECT row_id, c.country, coalesce(macro_area, 'Unknown') AS macro_area
  FROM clean c LEFT JOIN area a ON c.country = a.country""")
def _(spark, sf):
    d = clean_lots(spark, sf).select("row_id", "country")
    return L.map_with_default(d, T.area_map(spark, sf), "country", "macro_area")


@query("resume_anti_join", Q.lots() + """SELECT DISTINCT country, coalesce(subregion, 'NaN') AS subregion,
    CASE WHEN subregion IS NULL THEN country ELSE subregion || ', ' || country END AS query
  FROM (SELECT nullif(country, 'CHINA') AS country, subregion FROM clean) c
  WHERE country IS NOT NULL AND NOT EXISTS (SELECT 1 FROM geo g WHERE g.latitude < 0 AND g.country = c.country
        AND coalesce(g.subregion, 'NaN') = coalesce(c.subregion, 'NaN'))""")
def _(spark, sf):
    wanted = clean_lots(spark, sf).select(F.when(F.col("country") != "CHINA", F.col("country")).otherwise(" nan ")
                                          .alias("country"), "subregion")
    return L.not_done_yet(wanted, T.geo_lookup(spark, sf).where("latitude < 0"))


@query("labelled_docs_semi", """SELECT d.doc_id, d.lang FROM documents d
  WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def _(spark, sf):
    return (T.table(spark, sf, "documents").select("doc_id", "lang")
            .join(T.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi"))


@query("unlabelled_docs_anti", """SELECT d.doc_id, d.lang FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def _(spark, sf):
    return (T.table(spark, sf, "documents").select("doc_id", "lang")
            .join(T.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti"))


_TERMS = """t AS (SELECT variety AS feature, label, moisture, altitude FROM clean),
 a AS (SELECT feature, round(avg(moisture) FILTER (label = 1), 6) AS gain FROM t GROUP BY 1),
 b AS (SELECT feature, round(avg(moisture), 6) AS gain_other FROM t WHERE altitude > 9000 GROUP BY 1)"""


def _terms(spark, sf):
    t = clean_lots(spark, sf).withColumnRenamed("variety", "feature")
    a = t.groupBy("feature").agg(F.round(F.avg(F.when(F.col("label") == 1, F.col("moisture"))), 6).alias("gain"))
    b = t.where("altitude > 9000").groupBy("feature").agg(F.round(F.avg("moisture"), 6).alias("gain_other"))
    return a, b


@query("feature_table_inner", Q.lots(_TERMS) + "SELECT feature, gain, gain_other FROM a JOIN b USING (feature)")
def _(spark, sf):
    a, b = _terms(spark, sf)
    return a.join(b, "feature")


@query("feature_table_outer", Q.lots(_TERMS) + """SELECT feature, coalesce(gain, 0) AS gain,
  coalesce(gain_other, 0) AS gain_other FROM a FULL JOIN b USING (feature)""")
def _(spark, sf):
    return L.outer_features(*_terms(spark, sf))


@query("feature_name_union", Q.lots(_TERMS) + "SELECT feature FROM a UNION SELECT feature FROM b")
def _(spark, sf):
    a, b = _terms(spark, sf)
    return a.select("feature").union(b.select("feature")).distinct()


@query("feature_name_intersect", Q.lots(_TERMS) + """SELECT feature FROM a WHERE feature LIKE '%#1%'
  INTERSECT SELECT feature FROM b""")
def _(spark, sf):
    a, b = _terms(spark, sf)
    return a.select("feature").where("feature LIKE '%#1%'").intersect(b.select("feature"))


@query("map_attach", Q.lots(_TERMS) + """SELECT row_id, variety, gain_other FROM clean LEFT JOIN b ON variety = feature""")
def _(spark, sf):
    _, b = _terms(spark, sf)
    return (clean_lots(spark, sf).select("row_id", "variety")
            .join(b.withColumnRenamed("feature", "variety"), "variety", "left"))


@query("coefficient_side_by_side", Q.lots("""long AS (
  SELECT variety AS feature, color AS model, round(avg(moisture), 6) AS coef FROM clean GROUP BY 1, 2)""") + """
SELECT feature, max(coef) FILTER (model = 'f') AS f, max(coef) FILTER (model = 'o') AS o FROM long GROUP BY 1""")
def _(spark, sf):
    long = (clean_lots(spark, sf).groupBy(F.col("variety").alias("feature"), F.col("color").alias("model"))
            .agg(F.round(F.avg("moisture"), 6).alias("coef")))
    return L.side_by_side(long, ["f", "o"])


@query("dedup_on_key", """SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    from ..sources.csv_source import first_per_key
    d = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return first_per_key(d, ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query("null_tokens", """SELECT event_id, CASE WHEN event_type IN ('error') THEN NULL ELSE event_type END AS event_type
  FROM events""")
def _(spark, sf):
    from ..sources.csv_source import null_tokens_to_null
    d = T.table(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "error", " NaN ")
                                            .otherwise(F.col("event_type")).alias("event_type"))
    return null_tokens_to_null(d)


@query("safe_numeric_cast", """SELECT vec_id, try_cast(CASE WHEN label = 3 THEN 'n/a' ELSE label::VARCHAR END AS DOUBLE) AS value
  FROM embeddings""")
def _(spark, sf):
    d = T.table(spark, sf, "embeddings").select(
        "vec_id", F.when(F.col("label") == 3, "n/a").otherwise(F.col("label").cast("string")).alias("t"))
    return d.select("vec_id", F.col("t").try_cast("double").alias("value"))


@query("clean_feature_names", Q.lots("""n AS (SELECT DISTINCT 'variety_' || CASE WHEN variety LIKE '%#5%'
   THEN 'infrequent_sklearn' ELSE variety END AS encoded FROM clean)""") + """
SELECT encoded, replace(encoded, 'infrequent_sklearn', 'Rare') AS feature,
  CASE WHEN encoded LIKE 'variety\\_%' ESCAPE '\\' THEN 'variety' ELSE encoded END AS raw_feature FROM n
UNION ALL SELECT 'moisture', 'moisture', 'moisture' """)
def _(spark, sf):
    n = clean_lots(spark, sf).select(F.concat(F.lit("variety_"), F.when(
        F.col("variety").contains("#5"), "infrequent_sklearn").otherwise(F.col("variety"))).alias("encoded")).distinct()
    n = n.union(spark.range(1).select(F.lit("moisture")))
    return n.select("encoded", C.clean_name(F.col("encoded")).alias("feature"),
                    C.raw_feature(F.col("encoded")).alias("raw_feature"))
