"""The histogram booster against a plain recursive one in float arithmetic."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from raregrain.operators import boosting as B


def table(spark, n=240, width=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).round(3)
    x[:, 1] = rng.integers(0, 2, n)
    y = (x[:, 0] + 0.8 * x[:, 1] * x[:, 2] + rng.normal(size=n) > 1).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(n)], "row_id bigint, label int, x array<double>")
    return x, y, df.withColumn("features", array_to_vector("x")).drop("x")


def plain(x, y, watch, trees, depth, rate, positive, least):
    """Every distinct value is a cut; no draws."""
    n = len(x)
    raw, losses, gains = np.zeros(n), [], np.zeros(x.shape[1])
    w = np.where(y == 1, positive, 1.0)

    def grow(rows, z, left):
        p = 1 / (1 + np.exp(-z[rows]))
        g, h = w[rows] * (p - y[rows]), w[rows] * p * (1 - p)
        best = (1e-6, None, None)
        for f in range(x.shape[1]) if left else ():
            for c in np.unique(x[rows, f]):
                a = x[rows, f] <= c
                if h[a].sum() < least or h[~a].sum() < least:
                    continue
                gain = (g[a].sum() ** 2 / (h[a].sum() + 1) + g[~a].sum() ** 2 / (h[~a].sum() + 1)
                        - g.sum() ** 2 / (h.sum() + 1))
                if gain > best[0] + 1e-9:
                    best = (gain, f, c)
        if best[1] is None:
            v = -rate * g.sum() / (h.sum() + 1)
            return lambda q: np.full(len(q), v)
        _, f, c = best
        gains[f] += best[0]
        a = x[rows, f] <= c
        one, two = grow(rows[a], z, left - 1), grow(rows[~a], z, left - 1)
        return lambda q: np.where(q[:, f] <= c, one(q), two(q))
    for _ in range(trees):
        raw = raw + grow(np.flatnonzero(~watch), raw.copy(), depth)(x)
        losses.append(float(np.mean(np.logaddexp(0, raw[watch]) - y[watch] * raw[watch])))
    return 1 / (1 + np.exp(-raw)), losses, gains


@pytest.mark.parametrize("depth,rate,every,parts", [(3, 0.3, 40, 1), (2, 0.5, 3, 5)])
def test_equals_a_plain_booster(spark, monkeypatch, depth, rate, every, parts):
    monkeypatch.setattr(B, "EVERY", every)
    x, y, df = table(spark)
    watch = F.col("row_id") % 5 == 0
    df = df.repartition(parts)
    data = B.binned({0: B.roles(df.where(~watch), df.where(watch))})
    m, = B.fit(data, [B.Boosted(0, rate, depth, 8, positive=2.5, rows=1.0, columns=1.0)])
    want, losses, gains = plain(x, y, np.arange(len(x)) % 5 == 0, 8, depth, rate, 2.5, 2.0)
    assert np.allclose(m.losses, losses, atol=1e-5) and m.best == 1 + int(np.argmin(losses))
    got = {r["row_id"]: r["score"] for r in B.scores(data, [m], [8]).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-5)
    m.best = 8
    assert np.allclose([c * g for _, c, g in B.column_gains(m, list("abcd"))], gains, rtol=1e-4, atol=1e-5)


@pytest.mark.parametrize("direct", [0, 1 << 22])
def test_models_together_equal_models_alone_and_any_dealing(spark, monkeypatch, direct):
    monkeypatch.setattr(B, "_DIRECT", direct)
    _, _, df = table(spark, 200)
    parts = {f: B.roles(df.where(F.col("row_id") % 3 != f), None, df.where(F.col("row_id") % 3 == f)) for f in (0, 1)}

    def settings():
        return [B.Boosted(0, 0.2, 3, 6), B.Boosted(1, 0.2, 2, 4, positive=3.0), B.Boosted(0, 0.4, 1, 9, positive=0.5)]
    together = B.binned(parts)
    a = B.fit(together, settings())
    for i, m in enumerate(settings()):
        alone = B.binned({m.design: [(d.repartition(7), r) for d, r in parts[m.design]]})
        b, = B.fit(alone, [m])
        assert len(b.grown) == m.trees == b.best
        for s, t in zip(a[i].grown, b.grown):
            assert (s.feature == t.feature).all() and (s.cut == t.cut).all() and (s.value == t.value).all()


def test_stops_after_patience_and_keeps_the_best(spark):
    _, _, df = table(spark, 120, seed=3)
    watch = F.col("row_id") % 4 == 0
    data = B.binned({0: B.roles(df.where(~watch), df.where(watch))})
    m, = B.fit(data, [B.Boosted(0, 0.8, 3, 200, patience=5)])
    assert m.best == 1 + int(np.argmin(m.losses)) and len(m.losses) == len(m.grown) == m.best + 5 < 200


def test_cuts_are_all_values_where_few_else_quantiles(spark):
    df = spark.createDataFrame([(i, 0, [float(i == 7), float(i % 200), float(i)]) for i in range(2000)],
                               "row_id bigint, label int, x array<double>").withColumn("features", array_to_vector("x"))
    one, few, many = B.binned({4: B.roles(df)}).cuts[4]
    assert one.tolist() == [0.0, 1.0] and few.tolist() == list(range(200))
    assert len(many) == B.BINS - 1 and np.diff(many).max() <= 12


def test_draws_rows_and_columns_by_hash():
    keys = np.arange(20_000, dtype=np.int64) * 7919
    a, b = B._drawn(keys, 0, 0.9), B._drawn(keys, 1, 0.9)
    assert abs(a.mean() - 0.9) < 0.01 and abs((a & b).mean() - 0.81) < 0.015
    assert B._drawn(keys, 0, 1.0).all()
    assert len(B.drawn_columns(10, 3, 0.9)) == 9 and len(B.drawn_columns(1, 0, 0.5)) == 1


def test_no_rows_missing_values_and_constant_labels(spark):
    kind = "row_id bigint, label int, x array<double>"
    none = spark.createDataFrame([], kind).withColumn("features", array_to_vector("x"))
    rows = [(i, 0, [math.nan if i % 3 == 0 else float(i), 1.0]) for i in range(40)]
    some = spark.createDataFrame(rows, kind).withColumn("features", array_to_vector("x"))
    data = B.binned({0: B.roles(some, some), 1: B.roles(none, some)})
    one, two = B.fit(data, [B.Boosted(0, 0.5, 2, 3), B.Boosted(1, 0.5, 2, 3)])
    assert one.losses[0] > one.losses[-1] and all((t.feature[0] == -1) for t in two.grown)
    assert {r["score"] for r in B.scores(data, [two]).collect() if r["fold"] == 1} == {0.5}
    assert B.scores(B.binned({0: B.roles(none)}), []).count() == 0
