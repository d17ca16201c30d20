"""Synthetic minority rows by interpolation towards exact nearest neighbours."""

from __future__ import annotations

import statistics

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.hashing import portable_hash, portable_uniform
from ..functions.ranking import id_rank
from ..functions.scratch import materialise
from .sampling import class_totals
from .spatial import Space, build_tree, knn


def category_codes(df: DataFrame, cats: list[str]) -> DataFrame:
    """(variable, level, code): dense integer code per level in name order; one row per level."""
    levels = df.select(*cats).unpivot([], list(cats), "variable", "level").distinct()
    w = Window.partitionBy("variable").orderBy("level")
    return levels.withColumn("code", (F.row_number().over(w) - 1).cast("double"))


def _coded(df: DataFrame, codes: DataFrame, cats: list[str]) -> DataFrame:
    for c in cats:
        one = codes.where(F.col("variable") == c).select(F.col("level").alias(c), F.col("code").alias(f"k_{c}"))
        df = df.join(one, c)
    return df


def sd_penalty(minority: DataFrame, numeric: list[str]) -> float:
    """Median over the numeric columns of their population sd among the minority rows."""
    r = minority.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in numeric]).first()
    return float(statistics.median(r[c] for c in numeric))


def _slots(df: DataFrame, n_new: int, n_base: int, k: int, seed: int) -> DataFrame:
    """New row j: base index, neighbour rank (1-based) and gap, all from hashes of j."""
    return df.sparkSession.range(n_new).select(
        F.col("id").alias("slot"), (portable_hash(F.col("id"), seed) % n_base).alias("__idx"),
        (portable_hash(F.col("id"), seed + 1) % k + 1).cast("int").alias("rank"),
        portable_uniform(F.col("id"), seed + 2).alias("gap"))


def synthetic_rows(train: DataFrame, numeric: list[str], cats: list[str], *, k: int = 5, seed: int = S.SEED,
                   penalty: float | None = None, label: str = S.LABEL, id_col: str = S.ROW_ID,
                   n_new: int | None = None, leaf_size: int = 256) -> DataFrame:
    """Minority rows that balance the classes 1:1, with their ingredients.

    Columns: slot, base, neighbour, gap, the interpolated numeric columns,
    the neighbours' majority level per category (the smaller name on ties)
    and ``from_c`` / ``to_c``, the levels of base and neighbour.
    """
    minority = materialise(train.where(F.col(label) == 1).select(id_col, *[
        F.col(c).cast("double").alias(c) for c in numeric], *cats))
    n0, n1 = class_totals(train, label)
    n_new = max(n0 - n1, 0) if n_new is None else n_new
    codes = category_codes(minority, cats) if cats else None
    pts = _coded(minority, codes, cats) if cats else minority
    code_cols = [f"k_{c}" for c in cats]
    if penalty is None:
        penalty = sd_penalty(minority, numeric) if cats else 0.0
    space = Space(list(numeric), code_cols, penalty)
    if n1 <= k:
        raise ValueError(f"{n1} minority rows have no {k} neighbours each")
    near = materialise(knn(build_tree(pts, id_col, space, leaf_size), k))
    base = id_rank(pts, id_col, "__idx").withColumn("__idx", F.col("__idx") - 1)
    s = _slots(train, n_new, n1, k, seed).join(base, "__idx").drop("__idx")
    s = s.join(near.withColumnRenamed("id", id_col), [id_col, "rank"])
    out = s.select("slot", F.col(id_col).alias("base"), "neighbour", "gap",
                   *[(F.col(c) + F.col("gap") * (F.get("xs", F.lit(i)) - F.col(c))).alias(c)
                     for i, c in enumerate(numeric)],
                   *[F.col(c).alias(f"from_{c}") for c in cats],
                   *[F.get("xs", F.lit(len(numeric) + i)).alias(f"to_code_{c}") for i, c in enumerate(cats)])
    if cats:
        votes = near.select("id", F.posexplode(F.slice("xs", len(numeric) + 1, len(cats))).alias("cat", "code"))
        tally = votes.groupBy("id", "cat", "code").count()
        mode = (tally.groupBy("id", "cat").agg(F.max(F.struct("count", (-F.col("code")).alias("c"))).alias("m"))
                .groupBy(F.col("id").alias("base")).pivot("cat", list(range(len(cats))))
                .agg(F.first(-F.col("m.c"))))
        mode = mode.select("base", *[F.col(f"`{i}`").alias(f"mode_code_{c}") for i, c in enumerate(cats)])
        out = out.join(mode, "base")
        for c in cats:
            one = codes.where(F.col("variable") == c)
            for kind, name in (("mode_code_", c), ("to_code_", f"to_{c}")):
                out = out.join(one.select(F.col("code").alias(f"{kind}{c}"), F.col("level").alias(name)),
                               f"{kind}{c}").drop(f"{kind}{c}")
    return out


def oversample(train: DataFrame, numeric: list[str], cats: list[str], **options) -> DataFrame:
    """The training rows plus synthetic minority rows; ids of the latter are negative."""
    syn = synthetic_rows(train, numeric, cats, **options)
    cols = [*numeric, *cats]
    real = train.select(S.ROW_ID, S.LABEL, *[F.col(c).cast("double").alias(c) if c in numeric else F.col(c)
                                             for c in cols])
    new = syn.select((-F.col("slot") - 1).alias(S.ROW_ID), F.lit(1).alias(S.LABEL), *cols)
    return real.unionByName(new)


def fractional_audit(syn: DataFrame, cats: list[str]) -> DataFrame:
    """What plain interpolation does to 0/1 columns: rows and cells strictly between 0 and 1.

    A category on which base and neighbour differ leaves two fractional 0/1
    columns (the gap is never exactly 0 or 1 here).
    """
    diff = sum([(F.col(f"from_{c}") != F.col(f"to_{c}")).cast("int") for c in cats], F.lit(0))
    inside = (F.col("gap") > 0) & (F.col("gap") < 1)
    return syn.agg(F.count(F.lit(1)).alias("n_synthetic"), F.count_if((diff > 0) & inside).alias("n_fractional_rows"),
                   F.sum(F.when(inside, diff * 2).otherwise(0)).cast("long").alias("n_fractional_cells"))
