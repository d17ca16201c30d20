"""Principal components, k-means with silhouettes, divisive clustering, cluster tables."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scratch import materialise
from .features import standardise


def principal_components(df: DataFrame, cols: list[str], k: int | None = None, keep: tuple = (S.ROW_ID, S.LABEL)):
    """(ratios, loadings, scores) of the standardised columns.

    ratios: (component, ratio, cumulative); loadings: (feature, component,
    loading); scores: keep columns + pc1..pck.  Signs are fixed so that the
    largest loading of a component is positive.
    """
    spark = df.sparkSession
    k = k or len(cols)
    own = [f"__s_{c}" for c in cols]
    src = df.select(*keep, *[F.col(c).alias(o) for c, o in zip(cols, own)])
    z = VectorAssembler(inputCols=own, outputCol="__z").transform(standardise(src, own))
    model = PCA(k=k, inputCol="__z", outputCol="__pc").fit(z)
    pc = model.pc.toArray()
    sign = [1.0 if abs(pc[:, j].max()) >= abs(pc[:, j].min()) else -1.0 for j in range(k)]
    ratios, total = [], 0.0
    for j in range(k):
        total += float(model.explainedVariance[j])
        ratios.append((f"pc{j + 1}", float(model.explainedVariance[j]), total))
    loads = [(c, f"pc{j + 1}", float(pc[i, j] * sign[j])) for i, c in enumerate(cols) for j in range(k)]
    arr = vector_to_array("__pc")
    scores = model.transform(z).withColumn("__a", arr).select(
        *keep, *[(F.col("__a")[j] * sign[j]).alias(f"pc{j + 1}") for j in range(k)])
    return (spark.createDataFrame(ratios, "component string, ratio double, cumulative double"),
            spark.createDataFrame(loads, "feature string, component string, loading double"), scores)


def kmeans(df: DataFrame, cols: list[str], k: int, seed: int = S.SEED, n_init: int = 10):
    """Best of ``n_init`` seeded runs by cost: (model, rows with ``cluster``)."""
    v = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    with ThreadPool(min(4, n_init)) as pool:  # the runs are jobs of their own
        models = pool.map(lambda i: KMeans(k=k, seed=seed + i, maxIter=100).fit(v), range(n_init))
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best, best.transform(v).withColumnRenamed("prediction", "cluster").drop("features")


def bisecting_tree(df: DataFrame, cols: list[str], ks: list[int], seed: int = S.SEED) -> DataFrame:
    """Within-cluster cost of the divisive tree cut at several sizes."""
    v = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    rows = []
    for k in ks:
        m = BisectingKMeans(k=k, seed=seed).fit(v)
        rows.append((k, len(m.clusterCenters()), float(m.summary.trainingCost)))
    return df.sparkSession.createDataFrame(rows, "k int, n_clusters int, cost double")


def silhouette_rows(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    """Per-row silhouette under squared Euclidean distance, in linear time.

    The mean squared distance of x to a cluster is |x|^2 - 2 x.m + q with the
    cluster's mean m and mean squared norm q, so no pair of rows is formed.
    A cluster of one row scores 0.
    """
    norm = sum([F.col(c) * F.col(c) for c in cols], F.lit(0.0))
    stats = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.avg(norm).alias("q"),
                                    *[F.avg(c).alias(f"m_{c}") for c in cols]).collect()  # one row per cluster

    def mean_sq(r):
        dot = sum([F.col(c) * F.lit(r[f"m_{c}"]) for c in cols], F.lit(0.0))
        return F.greatest(norm - 2 * dot + F.lit(r["q"]), F.lit(0.0))
    nothing = F.lit(None).cast("double")
    own = F.coalesce(*[F.when(F.col(cluster) == r[cluster], mean_sq(r) * (r["n"] / (r["n"] - 1.0))
                              if r["n"] > 1 else nothing) for r in stats], nothing)
    others = [F.when(F.col(cluster) != r[cluster], mean_sq(r)) for r in stats]
    other = F.least(*others) if len(others) > 1 else nothing
    d = df.withColumns({"__a": own, "__b": other})
    s = F.try_divide(F.col("__b") - F.col("__a"), F.greatest("__a", "__b"))
    return d.withColumn("silhouette", F.coalesce(s, F.lit(0.0))).drop("__a", "__b")


def silhouette(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    return silhouette_rows(df, cols, cluster).agg(F.avg("silhouette").alias("silhouette"))


def kmeans_silhouettes(df: DataFrame, cols: list[str], ks=range(2, 7), n_pcs: int = 3, n_init: int = 10) -> DataFrame:
    """(k, standardised, components): mean silhouettes on all columns and on the first components."""
    z = materialise(standardise(df.select(S.ROW_ID, S.LABEL, *cols), cols))
    _, _, scores = principal_components(df, cols)
    scores = materialise(scores)
    pcs = [f"pc{i + 1}" for i in range(n_pcs)]
    rows = []
    for k in ks:
        a = silhouette(kmeans(z, cols, k, n_init=n_init)[1], cols).first()[0]
        b = silhouette(kmeans(scores, pcs, k, n_init=n_init)[1], pcs).first()[0]
        rows.append((k, float(a), float(b)))
    return df.sparkSession.createDataFrame(rows, "k int, standardised double, components double")


def cluster_summary(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Number of clusters and of noise rows; noise (-1) is not a cluster."""
    return df.agg(F.count_distinct(F.when(F.col(cluster) != -1, F.col(cluster))).alias("n_clusters"),
                  F.count_if(F.col(cluster) == -1).alias("n_noise"))
