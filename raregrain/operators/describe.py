"""Descriptive tables: missingness, balance, group rates, rank tests, figure data."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.ranking import attach, exact_quantiles, melt, running_sums, value_rank
from ..functions.scratch import materialise
from ..functions.special import two_sided_normal_p


def _kind(t: T.DataType) -> str:
    if isinstance(t, (T.FractionalType,)):
        return "double"
    return "long" if isinstance(t, T.IntegralType) else "string"


def missingness(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: kind, percentage missing (1 decimal), number of distinct values."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"m_{c}") for c in df.columns],
                 *[distinct(F.col(c)).alias(f"d_{c}") for c in df.columns])
    kinds = {f.name: _kind(f.dataType) for f in df.schema.fields}
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("kind"),
                 F.round(F.col(f"m_{c}") * 100, 1).alias("missing_pct"),
                 F.col(f"d_{c}").alias("n_unique")) for c in df.columns]))).orderBy(
        F.desc("missing_pct"), "column_name")


def missing_counts(df: DataFrame) -> DataFrame:
    """Columns that have missing values, with the number of them."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "column_name", "n_missing").where("n_missing > 0")


def class_balance(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    row = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    total = F.col("n0") + F.col("n1")
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("class"), F.col(n).alias("n"),
                 F.round(F.try_divide(F.col(n) * F.lit(100.0), total), 2).alias("percentage"))
        for n, name in (("n0", "negative"), ("n1", "positive"))]))).where("n > 0")


def _rates() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col(S.LABEL).cast("long")).alias("n_positive"),
            F.avg(F.col(S.LABEL).cast("double")).alias("positive_rate"),
            F.avg(S.SCORE).alias("mean_score")]


def rate_by(df: DataFrame, col: str, min_n: int = 1) -> DataFrame:
    """Support, positives, positive rate and mean score per level; missing levels dropped."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(*_rates()).where(F.col("n") >= min_n)
            .orderBy(F.desc("positive_rate"), col))


def rate_by_all(df: DataFrame, cols: list[str]) -> DataFrame:
    """``rate_by`` for several columns in one scan (grouping sets)."""
    sets = df.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols])
    bits = {c: 1 << (len(cols) - 1 - i) for i, c in enumerate(cols)}
    full = (1 << len(cols)) - 1
    out = sets.agg(F.grouping_id().alias("gid"), *_rates())
    which = F.coalesce(*[F.when(F.col("gid") == full - bits[c], F.lit(c)) for c in cols])
    level = F.coalesce(*[F.when(F.col("gid") == full - bits[c], F.col(c)) for c in cols])
    return (out.select(which.alias("variable"), level.alias("level"), "n", "n_positive",
                       "positive_rate", "mean_score").where("level IS NOT NULL"))


def crosstab_rate(df: DataFrame, col: str, label: str = S.LABEL) -> DataFrame:
    """Level x class counts and the positive rate per level."""
    return (df.groupBy(col).pivot(label, [0, 1]).count().fillna(0)
            .withColumnsRenamed({"0": "n_negative", "1": "n_positive"})
            .withColumn("positive_rate", F.col("n_positive") / (F.col("n_negative") + F.col("n_positive"))))


def class_medians(df: DataFrame, cols: list[str], label: str = S.LABEL) -> DataFrame:
    """Exact class medians and difference of class means per column."""
    long = melt(df, [label], cols).where("value IS NOT NULL")
    med = exact_quantiles(long, "value", {"m": 0.5}, ["feature", label])
    means = long.groupBy("feature", label).agg(F.avg("value").alias("mean"))
    both = med.join(means, ["feature", label])
    return both.groupBy("feature").agg(
        F.max(F.when(F.col(label) == 0, F.col("m"))).alias("median_negative"),
        F.max(F.when(F.col(label) == 1, F.col("m"))).alias("median_positive"),
        (F.max(F.when(F.col(label) == 1, F.col("mean")))
         - F.max(F.when(F.col(label) == 0, F.col("mean")))).alias("mean_difference"))


def rank_test(df: DataFrame, cols: list[str], label: str = S.LABEL) -> DataFrame:
    """Two-sided Mann-Whitney U per column: U of the positives, z with tie and continuity correction.

    Values are counted first, so tied values are one row and the running
    counts go over distinct values only.
    """
    long = melt(df, [label], cols).where("value IS NOT NULL")
    per_value = long.groupBy("feature", "value").agg(
        F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) == 0).alias("n0"))
    run = running_sums(per_value, "value", {"cum0": "n0"}, ["feature"])
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    t = n1 + n0
    stats = run.groupBy("feature").agg(
        F.sum("n1").cast("double").alias("N1"), F.sum("n0").cast("double").alias("N0"),
        F.sum(n1 * (F.col("cum0") - n0 / 2)).alias("u_positive"),
        F.sum(t * t * t - t).alias("ties"))
    n = F.col("N1") + F.col("N0")
    sd = F.sqrt(F.col("N1") * F.col("N0") / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    # a column with one single value has no spread and no evidence
    z = F.try_divide(F.abs(F.col("u_positive") - F.col("N1") * F.col("N0") / 2) - 0.5, sd)
    return stats.select("feature", "u_positive", F.greatest(z, F.lit(0.0)).alias("z"))


def mann_whitney(df: DataFrame, cols: list[str], label: str = S.LABEL) -> DataFrame:
    """Rank test with p-values, class medians and mean difference, smallest p first."""
    return (rank_test(df, cols, label).withColumn("p_value", two_sided_normal_p("z"))
            .join(class_medians(df, cols, label), "feature").orderBy("p_value", "feature"))


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(x).alias("feature"), F.lit(y).alias("other"), F.col(f"c{i}").alias("r"))
             for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))]
    cells += [F.struct(F.lit(c).alias("feature"), F.lit(c).alias("other"), F.lit(1.0).alias("r")) for c in cols]
    return row.select(F.inline(F.array(*cells)))


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample sd, min, exact quartiles, max per column."""
    long = melt(df, [], cols).where("value IS NOT NULL")
    basic = long.groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quart = exact_quantiles(long, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["feature"])
    return basic.join(quart, "feature")


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed. Zero-count bins are absent."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    width = (hi - lo) / bins or 1.0 if lo is not None else 1.0  # an empty column has no bins
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    return df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def share_above(df: DataFrame, col: str, cut: float) -> DataFrame:
    return df.agg(F.count_if(F.col(col) >= cut).alias("n_above"),
                  F.try_divide(F.count_if(F.col(col) >= cut) * F.lit(100.0), F.count(col)).alias("share_pct"))


def box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (outermost points inside the fences), outlier count."""
    d = df.select(by, F.col(col).cast("double").alias("value")).where("value IS NOT NULL")
    q = materialise(exact_quantiles(d, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by]))
    fences = q.withColumn("lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn(
        "hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    return attach(d, fences, [by]).groupBy(by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


def equal_count_bins(df: DataFrame, col: str, id_col: str = S.ROW_ID, bins: int = 8,
                     out: str = "bin") -> DataFrame:
    """Quantile bins of the tie-broken rank: bin = max(ceil((r-1)*bins/(n-1)), 1) - 1."""
    ranked = value_rank(df, col, id_col, out="__rank")
    n = df.count()
    pos = (F.col("__rank") - 1) * F.lit(bins) / F.lit(max(n - 1, 1))
    return ranked.withColumn(out, F.greatest(F.ceil(pos), F.lit(1)) - 1).drop("__rank")


def binned_curve(df: DataFrame, x: str, y: str, id_col: str = S.ROW_ID, bins: int = 8) -> DataFrame:
    """Mean of x and y per equal-count bin of x."""
    return (equal_count_bins(df, x, id_col, bins).groupBy("bin")
            .agg(F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"), F.count(F.lit(1)).alias("n")))


def scatter_cells(df: DataFrame, x: str, y: str, label: str = S.LABEL, bins: int = 20) -> DataFrame:
    """Scatter data per class, reduced to counts of an equal-width grid."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    x0, x1, y0, y1 = [v or 0.0 for v in d.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()]  # empty: no cells

    def cell(c, lo, hi):
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit((hi - lo) / bins or 1.0)), F.lit(bins - 1))
    return d.groupBy(cell(x, x0, x1).alias("cell_x"), cell(y, y0, y1).alias("cell_y"), label).agg(
        F.count(F.lit(1)).alias("n"))
