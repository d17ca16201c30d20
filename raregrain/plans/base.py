"""Registry of named queries and the shared inputs they start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from ..operators.cleaning import Rules, add_target, clean
from ..sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RULES = Rules(admin=tuple(T.ADMIN), labels=dict(T.PROCESSING_LABELS), color_merge=dict(T.COLOR_MERGE),
              fill_zero=("c1", "c2"), value_range=T.ALTITUDE_RANGE, score_cut=T.SCORE_CUT)


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its oracle text."""
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def clean_lots(spark: SparkSession, sf_dir: str, coordinates: bool = False) -> DataFrame:
    """Cleaned, labelled lots; the coordinate lookup joins only where it is asked for."""
    lookup = materialise(T.geo_lookup(spark, sf_dir)) if coordinates else None
    return add_target(clean(T.raw_lots(spark, sf_dir), lookup, RULES), RULES.score_cut)


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every DOUBLE column of a result; 0.0 is added so that -0.0 prints as 0.0."""
    cols = {}
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            cols[f.name] = F.round(F.col(f.name), special.get(f.name, digits)) + F.lit(0.0)
    return df.withColumns(cols) if cols else df
