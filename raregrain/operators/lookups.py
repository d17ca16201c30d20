"""Joins of the pipeline: dictionary lookups, result tables, resume and disjointness checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import UNKNOWN


def map_with_default(df: DataFrame, mapping: DataFrame, key: str, value: str,
                     default: str = UNKNOWN) -> DataFrame:
    """Left lookup; keys outside the map get the default."""
    return df.join(mapping.select(key, value), key, "left").fillna(default, subset=[value])


def not_done_yet(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Distinct (country, subregion) still to be processed; blank countries are skipped.

    Blank spellings of a subregion count as one missing key.
    """
    def norm(df):
        blank = ["nan", "none", ""]
        return df.select(
            F.when(~F.lower(F.trim("country")).isin(*blank), F.trim("country")).alias("country"),
            F.when(F.col("subregion").isNull() | F.lower(F.trim("subregion")).isin(*blank), "NaN")
            .otherwise(F.trim("subregion")).alias("subregion"))
    return (norm(wanted).where(F.col("country").isNotNull()).distinct()
            .join(norm(done).distinct(), ["country", "subregion"], "left_anti")
            .withColumn("query", F.when(F.col("subregion") == "NaN", F.col("country"))
                        .otherwise(F.concat_ws(", ", "subregion", "country"))))


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Number of keys of ``a`` that also occur in ``b`` (0 for a sound split)."""
    return a.join(b, key, "left_semi").agg(F.count(F.lit(1)).alias("n_overlap"))


def outer_features(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join on ``feature``; absent scores count as 0."""
    return left.join(right, "feature", "outer").fillna(0.0)


def side_by_side(long: DataFrame, models: list[str]) -> DataFrame:
    """Long (model, feature, coef) -> one column per model, widest effect first."""
    wide = long.groupBy("feature").pivot("model", models).agg(F.first("coef"))
    return (wide.withColumn("max_abs", F.greatest(*[F.abs(F.coalesce(F.col(f"`{m}`"), F.lit(0.0)))
                                                    for m in models], F.lit(0.0)))
            .orderBy(F.desc("max_abs"), "feature").drop("max_abs"))
