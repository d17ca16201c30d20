"""Exact stratified splits and folds, bootstrap draws, permutations, class weights.

Splits are cut points in hash order: only the rows of a few hash buckets are
sorted to find them, and the split of a row is then a plain expression of its
label and id, without moving the row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.hashing import MODULUS, portable_hash, portable_uniform
from ..functions.ranking import default_buckets, hash_rank, id_rank


def _rank_cuts(df: DataFrame, label: str, id_col: str, seed: int,
               fractions: list[float]) -> dict[object, list[tuple[int, int] | None]]:
    """(hash, id) of the row at rank ceil(f * n) of each class, for every fraction."""
    n_b = default_buckets(df)
    width = MODULUS // n_b + 1
    d = df.select(F.col(label).alias("y"), F.col(id_col).cast("long").alias("i"),
                  portable_hash(id_col, seed).alias("h")).withColumn("b", F.expr(f"h div {width}"))
    counts = d.groupBy("y", "b").count().collect()  # classes x buckets
    cuts: dict[object, list] = {}
    wanted = []
    for y in {r["y"] for r in counts}:
        per = sorted((r["b"], r["count"]) for r in counts if r["y"] == y)
        n = sum(c for _, c in per)
        cuts[y] = [None] * len(fractions)
        for j, f in enumerate(fractions):
            rank = math.ceil(round(f * n, 9))
            before = 0
            for b, c in per:
                if before < rank <= before + c:
                    wanted.append((y, b, rank - before, j))
                before += c
    if wanted:
        where = None
        for y, b in {(y, b) for y, b, _, _ in wanted}:
            t = (F.col("y") == y) & (F.col("b") == b)
            where = t if where is None else where | t
        ranked = d.where(where).withColumn(
            "r", F.row_number().over(Window.partitionBy("y", "b").orderBy("h", "i")))
        hits = None
        for y, b, r, _ in wanted:
            t = (F.col("y") == y) & (F.col("b") == b) & (F.col("r") == r)
            hits = t if hits is None else hits | t
        found = {(r["y"], r["b"], r["r"]): (r["h"], r["i"]) for r in ranked.where(hits).collect()}
        for y, b, r, j in wanted:
            cuts[y][j] = found[(y, b, r)]
    return cuts


def _within(cut: tuple[int, int] | None, h: Column, i: Column) -> Column:
    """Row is at or before the cut in (hash, id) order."""
    if cut is None:
        return F.lit(False)
    return (h < cut[0]) | ((h == cut[0]) & (i <= cut[1]))


def stratified_holdout(df: DataFrame, test_size: float = S.TEST_SIZE, seed: int = S.SEED,
                       label: str = S.LABEL, id_col: str = S.ROW_ID, out: str = "is_test") -> DataFrame:
    """Flag ceil(test_size * n) rows of every class as test."""
    cuts = _rank_cuts(df, label, id_col, seed, [test_size])
    h, i = F.col("__h"), F.col(id_col).cast("long")
    flag = F.lit(False)
    for y, (cut,) in cuts.items():
        flag = flag | ((F.col(label) == y) & _within(cut, h, i))
    return df.withColumn("__h", portable_hash(id_col, seed)).withColumn(out, flag).drop("__h")


def stratified_folds(df: DataFrame, k: int = S.N_FOLDS, seed: int = S.SEED, label: str = S.LABEL,
                     id_col: str = S.ROW_ID, out: str = "fold") -> DataFrame:
    """Fold of rank r (1-based, hash order, within class) = (r-1)*k div n_class."""
    cuts = _rank_cuts(df, label, id_col, seed, [f / k for f in range(1, k)])
    h, i = F.col("__h"), F.col(id_col).cast("long")
    fold = F.lit(0)
    for y, cs in cuts.items():
        for cut in cs:
            fold = fold + ((F.col(label) == y) & ~_within(cut, h, i)).cast("int")
    return df.withColumn("__h", portable_hash(id_col, seed)).withColumn(out, fold).drop("__h")


def early_stopping_split(df: DataFrame, held_out_fold: int, test_size: float = 0.2,
                         seed: int = S.INNER_SEED, label: str = S.LABEL, id_col: str = S.ROW_ID) -> DataFrame:
    """Rows of the other folds with a validation flag, stratified again inside them."""
    train = df.where(F.col("fold") != held_out_fold)
    return stratified_holdout(train, test_size, seed, label, id_col, out="is_validation")


def split_summary(df: DataFrame, label: str = S.LABEL, flag: str = "is_test") -> DataFrame:
    """One row: sizes and positives of the whole table and of both parts."""
    y = F.col(label).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(y).alias("n_positive"),
                  F.count_if(~F.col(flag)).alias("n_train"), F.count_if(F.col(flag)).alias("n_test"),
                  F.count_if(~F.col(flag) & (y == 1)).alias("positives_train"),
                  F.count_if(F.col(flag) & (y == 1)).alias("positives_test"))


def class_totals(df: DataFrame, label: str = S.LABEL) -> tuple[int, int]:
    r = df.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return int(r[0]), int(r[1])


def balanced_weights(df: DataFrame, label: str = S.LABEL, out: str = "weight") -> DataFrame:
    """n / (2 n_c) per row; the two class totals are scalars."""
    n0, n1 = class_totals(df, label)
    n = n0 + n1
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(n / (2.0 * max(n1, 1))))
                         .otherwise(F.lit(n / (2.0 * max(n0, 1)))))


def imbalance_ratio(df: DataFrame, label: str = S.LABEL) -> float:
    n0, n1 = class_totals(df, label)
    return n0 / max(n1, 1)


# --------------------------------------------------------------------------- bootstrap
def bootstrap_counts(df: DataFrame, n_boot: int, seed: int = S.SEED, id_col: str = S.ROW_ID) -> DataFrame:
    """Exact resampling with replacement: (boot, row, times drawn >= 1).

    Slot i of resample b draws the row with dense index hash(i; seed + b) mod n.
    Slots are generated in parallel and counted before they meet the rows.
    """
    indexed = id_rank(df, id_col, "__idx").withColumn("__idx", F.col("__idx") - 1)
    n = df.count()
    slots = df.sparkSession.range(n * n_boot).select(
        F.expr(f"id div {n}").alias("boot"), (F.col("id") % n).alias("slot"))
    draws = slots.select("boot", (portable_hash(F.col("slot"), F.col("boot") + seed) % n).alias("__idx"))
    times = draws.groupBy("boot", "__idx").agg(F.count(F.lit(1)).alias("times"))
    return times.join(indexed, "__idx").drop("__idx")


# Poisson(1) distribution function, P(X <= k) for k = 0, 1, ...
def _poisson_cdf(terms: int = 13) -> list[float]:
    out, p, total = [], math.exp(-1.0), 0.0
    for k in range(terms):
        p = p / k if k else p
        total += p
        out.append(total)
    return out


POISSON_CDF = _poisson_cdf()


def poisson_counts(df: DataFrame, n_boot: int, seed: int = S.SEED, id_col: str = S.ROW_ID) -> DataFrame:
    """Poisson(1) resampling: every row draws its own count, nothing is joined or shuffled."""
    d = df.withColumn("boot", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1)))).withColumn(
        "boot", F.col("boot").cast("long"))
    d = d.withColumn("__u", portable_uniform(id_col, F.col("boot") + seed)).where(F.col("__u") >= POISSON_CDF[0])
    times = sum([F.when(F.col("__u") >= F.lit(c), 1).otherwise(0) for c in POISSON_CDF], F.lit(0))
    return d.withColumn("times", times.cast("long")).drop("__u")


# --------------------------------------------------------------------------- permutation
def permuted_donors(df: DataFrame, cols: list[str], repeats: int, seed: int = S.SEED,
                    by: tuple | list = ("fold",), id_col: str = S.ROW_ID) -> DataFrame:
    """Every row once per repeat with the values of its permutation partner.

    Within ``by`` the row at position p (hash order of seed) takes the values
    of the row at position p in the hash order of seed + repeat + 1.  Adds
    ``repeat`` and one ``donor_<c>`` per column.
    """
    by = list(by)
    home = hash_rank(df.withColumn("__h", portable_hash(id_col, seed)), "__h", id_col, by, "__pos").drop("__h")
    copies = (df.select(*by, F.col(id_col).alias("__id"), *[F.col(c).alias(f"donor_{c}") for c in cols])
              .withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))))
    copies = copies.withColumn("__h", portable_hash("__id", F.col("repeat") + (seed + 1)))
    donors = hash_rank(copies, "__h", "__id", [*by, "repeat"], "__pos").drop("__h", "__id")
    return home.join(donors, [*by, "__pos"]).drop("__pos")
