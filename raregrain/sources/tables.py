"""The driver tables in the roles of the analytics library.

``raw_lots`` is one row per order with a score, geography, a numeric block
with missing values and sentinels, and text labels that still need cleaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCORE_CUT = 460000.0
ALTITUDE_RANGE = (-900.0, 9900.0)
BAND_EDGES = (1200.0, 6000.0)
PROCESSING_LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Other"}
COLOR_MERGE = {"p": "o"}
REFERENCE_LEVELS = {"macro_area": "ASIA", "color": "o", "processing": "Urgent", "variety": "Brand#11"}
ADMIN = ["owner", "grading_date", "ico_number", "mill"]  # ``mill`` is absent on purpose
EMBED_DIMS = [f"e{i}" for i in range(1, 7)]


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                 "l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its declared schema; nothing is inferred."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, subregion) -> coordinates; a missing subregion is a key of its own."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .groupBy("country", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("subregion"))
            .agg(F.round(F.min("c_acctbal") / 20.0 + F.count(F.lit(1)) / 100.0, 4).alias("latitude"),
                 F.round(F.max("c_acctbal") / 60.0, 4).alias("longitude")))


def raw_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    per_order = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_discount").alias("moisture_raw"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("c1"),
        F.count_if(F.col("l_returnflag") == "A").alias("c2"),
        F.min("l_partkey").alias("first_part")))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == n.n_nationkey)
            .join(r, F.col("n_regionkey") == r.r_regionkey)
            .join(per_order, F.col("o_orderkey") == per_order.l_orderkey, "left")
            .join(p, F.col("first_part") == p.p_partkey, "left")
            .select(F.col("o_orderkey").alias("row_id"),
                    F.col("o_totalprice").alias("score"),
                    F.col("n_name").alias("country"),
                    F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("subregion"),
                    F.when(F.col("o_orderkey") % 6 != 0, F.col("c_acctbal")).alias("altitude"),
                    F.col("moisture_raw").alias("moisture"),
                    "c1", "c2",
                    F.col("p_brand").alias("variety"),
                    F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED",
                           F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("processing"),
                    F.col("o_orderstatus").alias("color"),
                    F.col("c_name").alias("owner"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("grading_date"),
                    F.lit("").alias("ico_number")))


def area_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country -> macro_area; one area is left out so that the default is exercised."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey).where("r_name <> 'MIDDLE EAST'")
            .select(F.col("n_name").alias("country"), F.col("r_name").alias("macro_area")))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, label, score) pairs with many tied scores."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"), (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.round("value", 0) / 100.0).alias("score"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, label, e1..e6) from the first six embedding components."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"), "label",
                    *[F.col("embedding")[i].cast("double").alias(f"e{i + 1}") for i in range(6)])
