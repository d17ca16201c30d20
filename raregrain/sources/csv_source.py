"""CSV sources: the wide raw export and the geographic lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S


def null_tokens_to_null(df: DataFrame, tokens=tuple(S.NULL_TOKENS)) -> DataFrame:
    """Turn every missing-value spelling of a text column into NULL."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.trim(F.col(f"`{c}`")).isin(*tokens), F.col(f"`{c}`")) for c in text})


def load_raw(spark: SparkSession, path: str, headers: list[str]) -> DataFrame:
    """Read the wide CSV with a fixed all-text schema, then type it column by column.

    ``headers`` is the header line in file order.  Text is read first because
    a typed read would turn the token ``NaN`` into a NaN double.
    """
    text = T.StructType([T.StructField(S.snake(h), T.StringType()) for h in headers])
    df = spark.read.schema(text).option("header", True).option("enforceSchema", True).csv(path)
    df = null_tokens_to_null(df)
    typed = []
    for c in df.columns:
        t = S.raw_field(c)
        typed.append(F.col(c) if isinstance(t, T.StringType)
                     else F.col(c).try_cast("double").cast(t).alias(c))
    return df.select(*typed)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep one row per key, the first in ``order``; map-side combined."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return picked.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def load_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Read the (country, subregion) -> (latitude, longitude) lookup, unique on its key."""
    fields = T.StructType([T.StructField("country", T.StringType()), T.StructField("subregion", T.StringType()),
                           T.StructField("latitude", T.StringType()), T.StructField("longitude", T.StringType())])
    df = null_tokens_to_null(spark.read.schema(fields).option("header", True).csv(path))
    df = df.select(F.trim("country").alias("country"), F.trim("subregion").alias("subregion"),
                   F.col("latitude").try_cast("double").alias("latitude"),
                   F.col("longitude").try_cast("double").alias("longitude"))
    return first_per_key(df, ["country", "subregion"], ["latitude", "longitude"])
