"""Shared SQL fragments of the oracle texts."""

from __future__ import annotations

GEO = """geo AS (
  SELECT n_name AS country, nullif(c_mktsegment, 'HOUSEHOLD') AS subregion,
         round(min(c_acctbal) / 20.0::DOUBLE + count(*) / 100.0::DOUBLE, 4) AS latitude,
         round(max(c_acctbal) / 60.0::DOUBLE, 4) AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""

RAW = """raw_lots AS (
  SELECT o_orderkey AS row_id, o_totalprice AS score, n_name AS country,
         nullif(c_mktsegment, 'HOUSEHOLD') AS subregion,
         CASE WHEN o_orderkey % 6 <> 0 THEN c_acctbal END AS altitude,
         moisture_raw AS moisture, c1, c2, p_brand AS variety,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN '  ' || o_orderpriority || ' ' END AS processing,
         o_orderstatus AS color, c_name AS owner, strftime(o_orderdate, '%Y-%m-%d') AS grading_date,
         '' AS ico_number
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT l_orderkey, min(l_discount) AS moisture_raw,
               count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS c1,
               count(*) FILTER (l_returnflag = 'A') AS c2, min(l_partkey) AS first_part
             FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
  LEFT JOIN part ON first_part = p_partkey)"""

HARMONISED = """harmonised AS (
  SELECT row_id, score, country, subregion, altitude, moisture, coalesce(c1, 0) AS c1, coalesce(c2, 0) AS c2,
         nullif(trim(variety), '') AS variety,
         CASE trim(processing) WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
              WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Other' ELSE nullif(trim(processing), '') END AS processing,
         CASE lower(trim(color)) WHEN 'p' THEN 'o' ELSE lower(trim(color)) END AS color
  FROM raw_lots WHERE score > 0 AND (country IS NOT NULL OR subregion IS NOT NULL))"""

CLEAN = """clean AS (
  SELECT h.row_id, h.score, h.country, h.subregion, h.altitude, nullif(h.moisture, 0) AS moisture, h.c1, h.c2,
         coalesce(h.variety, 'Unknown') AS variety, coalesce(h.processing, 'Unknown') AS processing,
         coalesce(h.color, 'Unknown') AS color, g.latitude, g.longitude,
         CASE WHEN h.score >= 460000 THEN 1 ELSE 0 END AS label
  FROM harmonised h LEFT JOIN geo g ON h.country IS NOT DISTINCT FROM g.country
       AND h.subregion IS NOT DISTINCT FROM g.subregion
  WHERE (h.altitude IS NULL OR h.altitude BETWEEN -900 AND 9900) AND coalesce(h.processing, 'Unknown') <> 'Other')"""

AREA = """area AS (
  SELECT n_name AS country, r_name AS macro_area FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'MIDDLE EAST')"""

SCORED = """sc AS (
  SELECT event_id AS row_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
         round(value, 0) / 100.0::DOUBLE AS score FROM events)"""

VECTORS = """vec AS (
  SELECT vec_id AS row_id, label, """ + ", ".join(
    f"embedding[{i}]::DOUBLE AS e{i}" for i in range(1, 7)) + " FROM embeddings)"


def lots(*ctes: str) -> str:
    """WITH clause up to the cleaned table, plus further CTEs."""
    return "WITH " + ",\n".join([GEO, RAW, HARMONISED, CLEAN, *ctes]) + "\n"


def scored(*ctes: str) -> str:
    return "WITH " + ",\n".join([SCORED, *ctes]) + "\n"


def vec(*ctes: str) -> str:
    return "WITH " + ",\n".join([VECTORS, *ctes]) + "\n"


def _strata(n_folds: int = 5) -> str:
    from ..functions.hashing import hash_sql
    return f"""fd AS (SELECT *, ((rn - 1) * {n_folds} // n_c)::INT AS fold, rn <= ceil(round(0.2::DOUBLE * n_c, 9)) AS is_test
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {hash_sql('row_id')}, row_id) AS rn,
          count(*) OVER (PARTITION BY label) AS n_c FROM clean))"""


FOLDS = _strata()

IMPUTED = """tr AS (SELECT * FROM fd WHERE fold <> 0),
 m_sub AS (SELECT country, subregion, avg(altitude) AS m FROM tr WHERE altitude IS NOT NULL GROUP BY 1, 2),
 m_cty AS (SELECT country, avg(altitude) AS m FROM tr WHERE altitude IS NOT NULL GROUP BY 1),
 m_all AS (SELECT median(altitude) AS alt, median(moisture) AS moist FROM tr),
 imp AS (SELECT fd.row_id, fd.label, fd.fold, fd.c1, fd.c2, fd.color, fd.processing, fd.variety,
   coalesce(macro_area, 'Unknown') AS macro_area,
   round_even(coalesce(fd.altitude, s.m, c.m, m_all.alt), 0) AS altitude,
   coalesce(fd.moisture, m_all.moist) AS moisture, (fd.moisture IS NULL)::INT AS moisture_missing
  FROM fd CROSS JOIN m_all
  LEFT JOIN m_sub s ON s.country IS NOT DISTINCT FROM fd.country AND s.subregion IS NOT DISTINCT FROM fd.subregion
  LEFT JOIN m_cty c ON c.country = fd.country LEFT JOIN area a ON a.country = fd.country)"""

LEVELS = """lv AS (SELECT * FROM (SELECT variable, level, count(*) AS n,
     row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, level DESC) AS r,
     count(*) OVER (PARTITION BY variable) AS n_levels
   FROM (SELECT 'macro_area' AS variable, macro_area AS level FROM imp WHERE fold <> 0
     UNION ALL SELECT 'color', color FROM imp WHERE fold <> 0
     UNION ALL SELECT 'processing', processing FROM imp WHERE fold <> 0
     UNION ALL SELECT 'variety', variety FROM imp WHERE fold <> 0) GROUP BY 1, 2)
   WHERE n_levels <= 10 OR r <= 9),
 cats AS (SELECT row_id, 'macro_area' AS variable, macro_area AS level FROM imp UNION ALL
   SELECT row_id, 'color', color FROM imp UNION ALL SELECT row_id, 'processing', processing FROM imp
   UNION ALL SELECT row_id, 'variety', variety FROM imp),
 pooled AS (SELECT c.row_id, c.variable, CASE WHEN lv.level IS NOT NULL THEN c.level
     WHEN (SELECT max(n_levels) FROM lv WHERE lv.variable = c.variable) > 10 THEN 'Rare' END AS level
   FROM cats c LEFT JOIN lv ON lv.variable = c.variable AND lv.level = c.level)"""


def folds(*ctes: str) -> str:
    return lots(FOLDS, *ctes)


def imputed(*ctes: str) -> str:
    return lots(AREA, FOLDS, IMPUTED, *ctes)
