"""Round trips through the file sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import scratch_path
from ..operators import describe as D
from ..sources import sinks
from ..sources import tables as T
from ..sources.csv_source import load_coordinates
from . import sqltext as Q
from .base import clean_lots, query, rounded

_SMALL = Q.lots() + "SELECT row_id, country, subregion, altitude, label FROM clean"


@query("csv_round_trip", _SMALL)
def _(spark, sf):
    d = clean_lots(spark, sf).select("row_id", "country", "subregion", "altitude", "label")
    path = scratch_path(spark)
    sinks.write_csv(d, path)
    return spark.read.schema(d.schema).option("header", True).csv(path)


@query("json_round_trip", _SMALL)
def _(spark, sf):
    d = clean_lots(spark, sf).select("row_id", "country", "subregion", "altitude", "label")
    path = scratch_path(spark)
    sinks.write_json(d, path)
    return spark.read.schema(d.schema).json(path)


@query("report_lines", Q.lots() + """SELECT printf('%-24s %12s %12s %12s %12s', 'country', 'n', 'n_positive',
  'positive_rate', 'mean_score') AS line
UNION ALL SELECT printf('%-24s %12d %12d %12.6f %12.6f', country, count(*), sum(label)::BIGINT,
  round(avg(label::DOUBLE), 6), round(avg(score), 6)) FROM clean WHERE country IS NOT NULL GROUP BY country""")
def _(spark, sf):
    path = scratch_path(spark)
    sinks.write_report(rounded(D.rate_by(clean_lots(spark, sf), "country")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("coordinates_csv", "WITH " + Q.GEO + " SELECT country, subregion, latitude, longitude FROM geo")
def _(spark, sf):
    g = T.geo_lookup(spark, sf)
    path = scratch_path(spark)
    messy = g.select(F.concat(F.lit(" "), "country").alias("country"), F.coalesce("subregion", F.lit("NaN")).alias("subregion"),
                     "latitude", "longitude")
    sinks.write_csv(messy.unionByName(messy), path)
    return load_coordinates(spark, path)
