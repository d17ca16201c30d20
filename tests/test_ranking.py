"""Distributed ranks and quantiles against pandas, with a value that holds a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from raregrain.functions import ranking as R
from raregrain.functions.hashing import MODULUS, portable_hash, portable_uniform


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(0)
    v = np.round(rng.exponential(5.0, 3000), 2)
    v[:1000] = 1.25
    pdf = pd.DataFrame({"id": rng.permutation(3000), "g": rng.integers(0, 3, 3000).astype(int), "v": v})
    pdf.loc[pdf.index % 3 == 0, "g"] = 0
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("buckets", [1, 4, 37])
def test_value_rank(skewed, buckets):
    pdf, df = skewed
    got = R.value_rank(df, "v", "id", ["g"], buckets=buckets).select("id", "rn").toPandas().set_index("id")["rn"]
    want = pdf.sort_values(["g", "v", "id"]).assign(rn=lambda d: d.groupby("g").cumcount() + 1).set_index("id")["rn"]
    assert (got.sort_index() == want.sort_index()).all()


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(skewed, descending):
    pdf, df = skewed
    per = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = R.running_sums(per, "v", {"c": "n"}, ["g"], descending, 16).toPandas()
    want = (pdf.groupby(["g", "v"]).size().rename("n").reset_index().sort_values("v", ascending=not descending)
            .assign(c=lambda d: d.groupby("g")["n"].cumsum()))
    m = got.merge(want, on=["g", "v"], suffixes=("", "_w"))
    assert len(m) == len(want) and (m["c"] == m["c_w"]).all()


def test_exact_quantiles(skewed):
    pdf, df = skewed
    got = R.exact_quantiles(df, "v", {"a": 0.1, "m": 0.5, "z": 0.975}, ["g"]).toPandas().set_index("g")
    want = pdf.groupby("g")["v"].quantile([0.1, 0.5, 0.975]).unstack()
    assert np.allclose(got.loc[want.index, ["a", "m", "z"]], want)
    assert R.exact_medians(df, ["v"])["v"] == pytest.approx(pdf["v"].median())


def test_hash_and_id_rank(skewed):
    pdf, df = skewed
    d = df.withColumn("h", portable_hash("id", 7))
    got = R.hash_rank(d, "h", "id", ["g"], buckets=11).toPandas()
    want = got.sort_values(["g", "h", "id"]).groupby("g").cumcount() + 1
    assert (got["rn"] == want.reindex(got.index)).all()
    ids = R.id_rank(df, "id", buckets=9).toPandas()
    assert (ids["rn"] == ids["id"] + 1).all()


def test_hash_is_one_to_one(spark):
    d = spark.range(20000).select(portable_hash("id", 3).alias("h"))
    assert d.distinct().count() == 20000
    assert d.where((F.col("h") < 0) | (F.col("h") >= MODULUS)).isEmpty()
    assert spark.range(1, 2).select(portable_hash(F.lit(10 ** 17), 3)).first()[0] >= 0


def test_hash_of_large_ids_and_seeds(spark):
    ids = spark.range(0, 3000).select((F.col("id") * (2 ** 31 - 1) + 2 ** 33).alias("id"))
    both = ids.select(portable_hash("id", 1).alias("a"), portable_hash("id", 2).alias("b"))
    assert both.select("a").distinct().count() == 3000  # ids that differ by 2**31 - 1 do not share a hash
    assert both.join(both.select(F.col("b").alias("a2")), F.col("a") == F.col("a2")).isEmpty()
    assert abs(both.stat.corr("a", "b")) < 0.06  # seeds do not shift the order
    n = 2 ** 33
    draws = spark.range(4000).select((portable_hash("id", 5) % n).alias("i"))
    assert draws.where(F.col("i") > 2 ** 31).count() > 2800  # indexes above 2**31 are drawn
    u = spark.range(4000).select(portable_uniform("id").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= u[0] and u[1] < 1 and abs(u[2] - 0.5) < 0.03


def test_resamples_share_no_draws(spark):
    from raregrain.operators.sampling import bootstrap_counts, poisson_counts
    df = spark.range(500).select(F.col("id").alias("row_id"))
    for draw in (bootstrap_counts, poisson_counts):
        counts = draw(df, 8).toPandas().pivot_table(index="row_id", columns="boot", values="times").fillna(0)
        assert np.abs(np.corrcoef(counts.T) - np.eye(8)).max() < 0.25


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40))
def test_median_of_any_list(spark, xs):
    d = spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], "v double")
    known = [x for x in xs if x is not None]
    got = R.exact_medians(d, ["v"])["v"]
    assert got == (pytest.approx(float(np.median(known))) if known else None)
