"""Ranks, running sums and exact quantiles that stay distributed.

A plain ``Window.orderBy`` over a whole table, or over a class that holds most
of it, sorts everything in one task.  The functions below cut the order into
buckets, run the window inside each bucket and add the totals of the earlier
buckets.  Only the (group, bucket) totals pass through a small window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hashing import MODULUS
from .scratch import stored

BUCKET = "__bucket"


def default_buckets(df: DataFrame) -> int:
    """One bucket per shuffle partition: the cluster setting sizes both."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def cut_points(df: DataFrame, value: str, n: int | None = None) -> list[float]:
    """At most n-1 increasing cut points that split ``value`` about evenly.

    They only balance the work: any cut points give the same exact result, so
    an approximate quantile is enough.  Read once and used as literals, so
    that every branch of a plan sees the same buckets.
    """
    n = n or default_buckets(df)
    probs = [i / n for i in range(1, n)]
    row = df.select(F.percentile_approx(F.col(value).cast("double"),
                                        F.array(*[F.lit(p) for p in probs]), 10000)).first()
    return sorted(set(row[0])) if row and row[0] else []


def with_buckets(df: DataFrame, value: str, cuts: list[float], out: str = BUCKET) -> DataFrame:
    """Order-preserving bucket number by binary search; missing values must be gone."""
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    key = f"{out}_key"
    b = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol=key, outputCol=out,
                   handleInvalid="error")
    return b.transform(df.withColumn(key, F.col(value).cast("double"))).drop(key)


def attach(df: DataFrame, side: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys with NULL matching NULL, keeping one copy of the keys.

    A grouped ``side`` has no size estimate; pass it through ``materialise``
    when ``df`` is large, so that the planner broadcasts it if it is small and
    never shuffles ``df`` on a few hot keys.
    """
    renamed = side.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                          *[c for c in side.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return df.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def running_sums(df: DataFrame, value: str, sums: dict[str, str], by: tuple | list = (),
                 descending: bool = False, buckets: int | None = None,
                 totals: dict[str, str] | None = None) -> DataFrame:
    """Add inclusive running sums of columns in the order of ``value``.

    ``df`` holds one row per (by, value), i.e. it was grouped before; ``by``
    is never missing.  ``sums`` maps new column -> summed column; ``totals``
    likewise adds the sum over the whole group, from the same bucket totals.
    """
    by, totals = list(by), totals or {}
    df = stored(df)  # read three times: for the cuts, the bucket totals and the rows
    d = with_buckets(df, value, cut_points(df, value, buckets))
    per = d.groupBy(*by, BUCKET).agg(*[F.sum(c).alias(f"__t_{c}") for c in dict.fromkeys(
        [*sums.values(), *totals.values()])])
    order_b = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    before = Window.partitionBy(*by).orderBy(order_b).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = per.select(
        *by, BUCKET, *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{o}") for o, c in sums.items()],
        *[F.sum(f"__t_{c}").over(whole).alias(o) for o, c in totals.items()])
    order_v = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*by, BUCKET).orderBy(order_v).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"__w_{o}": F.sum(c).over(inside) for o, c in sums.items()})
    d = d.join(offsets, [*by, BUCKET])
    d = d.withColumns({o: F.col(f"__w_{o}") + F.col(f"__o_{o}") for o in sums})
    return d.drop(BUCKET, *[f"__w_{o}" for o in sums], *[f"__o_{o}" for o in sums])


def hash_rank(df: DataFrame, hash_col: str, id_col: str, by: tuple | list = (), out: str = "rn",
              buckets: int | None = None) -> DataFrame:
    """Exact 1-based row number by (hash, id) within ``by``.

    The hash is uniform, so equal-width hash buckets are balanced whatever the
    share of a class is.
    """
    by = list(by)
    n = buckets or default_buckets(df)
    width = MODULUS // n + 1
    d = df.withColumn(BUCKET, F.expr(f"{hash_col} div {width}"))
    counts = d.groupBy(*by, BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*by, BUCKET).orderBy(hash_col, id_col)
    d = d.withColumn("__rn", F.row_number().over(inside))
    return (d.join(offsets, [*by, BUCKET])
            .withColumn(out, F.col("__rn") + F.col("__off")).drop(BUCKET, "__rn", "__off"))


def value_rank(df: DataFrame, value: str, id_col: str, by: tuple | list = (), out: str = "rn",
               buckets: int | None = None) -> DataFrame:
    """Exact 1-based row number by (value, id), safe for heavily repeated values.

    rank = rows with a smaller value + position among the rows of the same
    value, and the latter is again cut into id ranges.
    """
    by = list(by)
    id_b = "__idb"
    d = with_buckets(df, id_col, cut_points(df, id_col, buckets), id_b)
    per_cell = d.groupBy(*by, value, id_b).agg(F.count(F.lit(1)).alias("__n"))
    cells = Window.partitionBy(*by, value).orderBy(id_b).rowsBetween(Window.unboundedPreceding, -1)
    in_value = per_cell.withColumn("__off_id", F.coalesce(F.sum("__n").over(cells), F.lit(0)))
    per_value = per_cell.groupBy(*by, value).agg(F.sum("__n").alias("__nv"))
    ranked = running_sums(per_value, value, {"__cum": "__nv"}, by, buckets=buckets)
    offs = in_value.join(ranked, [*by, value]).select(
        *by, value, id_b, (F.col("__off_id") + F.col("__cum") - F.col("__nv")).alias("__off"))
    inside = Window.partitionBy(*by, value, id_b).orderBy(id_col)
    d = d.withColumn("__rn", F.row_number().over(inside))
    return (d.join(offs, [*by, value, id_b])
            .withColumn(out, F.col("__rn") + F.col("__off")).drop(id_b, "__rn", "__off"))


def id_rank(df: DataFrame, id_col: str, out: str = "rn", buckets: int | None = None) -> DataFrame:
    """Exact 1-based row number by a unique id."""
    d = with_buckets(df, id_col, cut_points(df, id_col, buckets))
    counts = d.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    d = d.withColumn("__rn", F.row_number().over(Window.partitionBy(BUCKET).orderBy(id_col)))
    return (d.join(offsets, BUCKET)
            .withColumn(out, F.col("__rn") + F.col("__off")).drop(BUCKET, "__rn", "__off"))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: tuple | list = (),
                    buckets: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact interpolated quantiles per group: {output column: probability}.

    ``weight`` names an integer multiplicity of the rows.

    ``percentile``/``median`` keep every distinct value of a group in one
    task; here equal values are counted first and the two order statistics
    around each position are picked from bucketed running counts.
    """
    by = list(by)
    times = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(times.alias("__c"))
    run = running_sums(counts, value, {"__cum": "__c"}, by, buckets=buckets, totals={"__total": "__c"})
    aggs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("__total") - 1)
        aggs += [F.min(F.when(F.col("__cum") > F.floor(pos), F.col(value))).alias(f"__lo_{name}"),
                 F.min(F.when(F.col("__cum") > F.ceil(pos), F.col(value))).alias(f"__hi_{name}")]
    agg = run.groupBy(*by).agg(F.max("__total").alias("__total"), *aggs)

    def interpolated(name: str, p: float) -> Column:
        pos = F.lit(float(p)) * (F.col("__total") - 1)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        return lo + (hi - lo) * (pos - F.floor(pos))

    return agg.select(*by, *[interpolated(n, p).alias(n) for n, p in probs.items()])


def melt(df: DataFrame, ids: list[str], cols: list[str], name: str = "feature",
         value: str = "value") -> DataFrame:
    """Wide to long with every value as DOUBLE."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ids, cols, name, value)


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact medians of some columns in one job (one row per column comes back)."""
    rows = exact_quantiles(melt(df, [], cols), "value", {"m": 0.5}, ["feature"]).collect()
    found = {r["feature"]: r["m"] for r in rows}
    return {c: found.get(c) for c in cols}
