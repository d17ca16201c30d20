"""Deterministic row-wise cleaning, its per-step audit, target and projections."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.ranking import attach


@dataclass(frozen=True)
class Rules:
    """What the cleaning steps need to know about a table."""

    admin: tuple = tuple(S.ADMIN)
    labels: dict = field(default_factory=lambda: dict(S.PROCESSING_LABELS))
    color_merge: dict = field(default_factory=lambda: dict(S.COLOR_MERGE))
    fill_zero: tuple = ("quakers",)
    value_range: tuple = S.ALTITUDE_RANGE
    score_cut: float = S.SCORE_CUT
    dropped_level: str = "Other"


def text_hygiene(df: DataFrame) -> DataFrame:
    """Trim every text column; empty text becomes NULL."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in text})


def relabel(col: Column, mapping: dict[str, str]) -> Column:
    """Value map; values outside the map pass through, NULL stays NULL."""
    out = col
    pairs = list(mapping.items())
    if pairs:
        case = F.when(col == pairs[0][0], pairs[0][1])
        for k, v in pairs[1:]:
            case = case.when(col == k, v)
        out = case.otherwise(col)
    return out


def in_range_or_missing(col: str, lo: float, hi: float) -> Column:
    return F.col(col).isNull() | F.col(col).between(lo, hi)


def zero_to_missing(col: str) -> Column:
    return F.nullif(F.col(col), F.lit(0).cast("double"))


def above(col: str, cut: float) -> Column:
    """Keep scores over the placeholder value."""
    return F.col(col) > cut


def has_geography() -> Column:
    return F.col("country").isNotNull() | F.col("subregion").isNotNull()


def not_level(col: str, level: str) -> Column:
    """Keep all levels but one; a missing level counts as ``Unknown``."""
    return F.coalesce(col, F.lit(S.UNKNOWN)) != level


def fill_constant(df: DataFrame, cols: tuple | list, value=0) -> DataFrame:
    """Missing values of the columns that exist become ``value``."""
    present = [c for c in cols if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def _prepared(raw: DataFrame, rules: Rules) -> DataFrame:
    """All value repairs that do not remove rows."""
    df = text_hygiene(raw.drop(*rules.admin))
    df = df.withColumns({
        "processing": relabel(F.col("processing"), rules.labels),
        "color": relabel(F.lower("color"), rules.color_merge),
    })
    return fill_constant(df, rules.fill_zero)


def _filters(rules: Rules) -> list[tuple[str, Column]]:
    """Row filters in order; ``Unknown`` is filled before the level is dropped."""
    return [
        ("drop placeholder score", above("score", 0)),
        ("drop rows without geography", has_geography()),
        ("drop implausible altitudes", in_range_or_missing("altitude", *rules.value_range)),
        ("drop processing level", not_level("processing", rules.dropped_level)),
    ]


def attach_coordinates(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left lookup on (country, subregion); a missing subregion matches a missing one."""
    return attach(df, lookup.select("country", "subregion", "latitude", "longitude"), S.GEO)


def clean(raw: DataFrame, lookup: DataFrame | None = None, rules: Rules = Rules()) -> DataFrame:
    """The whole cleaning chain as one lazy plan."""
    df = _prepared(raw, rules)
    for _, keep in _filters(rules):
        df = df.where(keep)
    if lookup is not None:
        df = attach_coordinates(df, lookup)
    df = df.fillna(S.UNKNOWN, subset=["processing", "color", "variety"])
    return df.withColumn("moisture", zero_to_missing("moisture"))


def cleaning_audit(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows left after each step and recoded sentinels, from a single pass."""
    df = _prepared(raw, rules)
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("s0")]
    names = ["raw"]
    for i, (name, keep) in enumerate(_filters(rules), 1):
        passed = passed & F.coalesce(keep, F.lit(False))
        counts.append(F.count_if(passed).alias(f"s{i}"))
        names.append(name)
    counts.append(F.count_if(passed & (F.col("moisture") == 0)).alias("recoded"))
    row = df.agg(*counts)
    last = f"s{len(names) - 1}"
    steps = [F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"s{i}").alias("rows"),
                      F.lit(0).cast("long").alias("recoded")) for i, n in enumerate(names)]
    steps.append(F.struct(F.lit(len(names)).alias("step_no"), F.lit("recode zero moisture").alias("step"),
                          F.col(last).alias("rows"), F.col("recoded")))
    return row.select(F.inline(F.array(*steps)))


def add_target(df: DataFrame, cut: float = S.SCORE_CUT, score: str = S.SCORE) -> DataFrame:
    return df.withColumn(S.LABEL, (F.col(score) >= float(cut)).cast("int"))


def model_matrix(df: DataFrame, cut: float = S.SCORE_CUT) -> DataFrame:
    """Key, predictors and label; the score and its components never pass."""
    if S.LABEL not in df.columns:
        df = add_target(df, cut)
    out = df.select(S.ROW_ID, *S.MODEL_INPUT, S.LABEL)
    leaking = set(out.columns) & {S.SCORE, *S.COMPONENTS}
    if leaking:
        raise ValueError(f"columns leak the target: {sorted(leaking)}")
    return out


def numeric_block(df: DataFrame) -> DataFrame:
    """The six numeric columns of the unsupervised work, complete rows only."""
    return df.select(S.ROW_ID, "moisture", "c1", "c2", "altitude", "longitude",
                     F.abs("latitude").alias("latitude_abs")).dropna(how="any")


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(S.ROW_ID, *cols, S.LABEL).dropna(how="any", subset=[*cols, S.LABEL])


def band(col: str, edges: tuple[float, float] = S.BAND_EDGES) -> Column:
    """0 / 1 / 2 by two edges; missing falls in the last band."""
    return F.when(F.col(col) < edges[0], 0).when(F.col(col) < edges[1], 1).otherwise(2)


def raw_feature(col: Column, categorical: list[str] = S.CATEGORICAL) -> Column:
    """Encoded column name -> source variable."""
    out = F.coalesce(*[F.when(col.startswith(c + "_"), F.lit(c)) for c in categorical], col)
    return out


def clean_name(col: Column) -> Column:
    return F.replace(col, F.lit("infrequent_sklearn"), F.lit(S.RARE))
