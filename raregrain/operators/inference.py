"""Binomial GLM with inference and per-row diagnostics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

Z95 = 1.959963984540054


def fit_glm(df: DataFrame, weight: str | None = None, max_iter: int = 100, tol: float = 1e-10):
    glm = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=S.LABEL, maxIter=max_iter, tol=tol)
    return (glm.setWeightCol(weight) if weight else glm).fit(df)


def coefficient_rows(model, names: list[str], spark) -> DataFrame:
    """(term, coef, std_err, z, p_value, lo, hi, odds_ratio); the intercept is ``const``."""
    s = model.summary
    coef = [*model.coefficients.toArray(), model.intercept]
    rows = [(n, float(c), float(e), float(z), float(p), float(c - Z95 * e), float(c + Z95 * e))
            for n, c, e, z, p in zip([*names, "const"], coef, s.coefficientStandardErrors, s.tValues, s.pValues)]
    d = spark.createDataFrame(rows, "term string, coef double, std_err double, z double, p_value double, lo double, hi double")
    return d.withColumn("odds_ratio", F.exp("coef")).withColumn("diverged", F.abs("coef") > 10)


def fit_statistics(model, spark) -> DataFrame:
    s = model.summary
    return spark.createDataFrame([(float(s.deviance), float(s.nullDeviance), float(s.aic), int(s.numInstances),
                                   int(s.degreesOfFreedom))],
                                 "deviance double, null_deviance double, aic double, n_rows long, df_resid long")


def _gram(df: DataFrame, p: int):
    """Weighted Gram matrix of (xs, w): partial sums per batch, added per cell."""
    import numpy as np

    def partial(batches):
        import numpy as np
        import pandas as pd
        g = None
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["xs"].to_numpy())
                part = (x * pdf["w"].to_numpy()[:, None]).T @ x
                g = part if g is None else g + part
        if g is not None:
            yield pd.DataFrame({"cell": np.arange(g.size), "v": g.ravel()})
    cells = df.select("xs", "w").mapInPandas(partial, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    out = np.zeros(p * p)
    for r in cells.collect():  # p * p numbers
        out[r["cell"]] = r["v"]
    return out.reshape(p, p)


def diagnostics(model, df: DataFrame, weight: str | None = None, keep: tuple = (S.ROW_ID, S.LABEL)) -> DataFrame:
    """Per row: fitted mean, deviance and Pearson residuals, leverage, standardised residual, Cook's distance."""
    import numpy as np
    w = F.col(weight) if weight else F.lit(1.0)
    d = model.transform(df).select(*keep, F.col("prediction").alias("mu"), w.alias("__w0"), F.concat(
        F.array(F.lit(1.0)), vector_to_array("features")).alias("xs"))
    y, mu = F.col(S.LABEL).cast("double"), F.col("mu")
    d = d.withColumn("w", F.col("__w0") * mu * (1 - mu))
    p = len(model.coefficients) + 1
    inverse = np.linalg.pinv(_gram(d, p))

    def hat(xs, w):
        import numpy as np
        import pandas as pd
        if not len(xs):
            return pd.Series([], dtype=float)
        x = np.stack(xs.to_numpy())
        return pd.Series(np.einsum("ij,jk,ik->i", x, inverse, x) * w.to_numpy())
    import pandas as pd
    hat.__annotations__ = {"xs": pd.Series, "w": pd.Series, "return": pd.Series}
    d = d.withColumn("leverage", F.pandas_udf(hat, T.DoubleType())("xs", "w"))
    loglik = F.when(y == 1, F.log(mu)).otherwise(F.log1p(-mu))
    pearson = (y - mu) / F.sqrt(mu * (1 - mu)) * F.sqrt("__w0")
    return d.select(*keep, "mu", "w", (F.signum(y - mu) * F.sqrt(-2 * F.col("__w0") * loglik)).alias("deviance_residual"),
                    pearson.alias("pearson_residual"), "leverage").withColumns({
                        "std_residual": F.col("pearson_residual") / F.sqrt(1 - F.col("leverage")),
                        "cooks": F.pow("pearson_residual", 2) * F.col("leverage")
                        / (p * F.pow(1 - F.col("leverage"), 2))})


def most_influential(diag: DataFrame, k: int = 5) -> DataFrame:
    return diag.orderBy(F.desc("cooks"), S.ROW_ID).limit(k)
