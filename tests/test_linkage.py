"""The merge tree of single linkage against all pairs."""

import numpy as np
import pandas as pd
import pytest

from raregrain.operators import linkage as K
from raregrain.operators import spatial as P


def prim(x):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    inside, best, out = np.zeros(len(x), bool), d[0].copy(), []
    inside[0] = True
    for _ in range(len(x) - 1):
        j = np.where(inside, np.inf, best).argmin()
        out.append(best[j])
        inside[j], best = True, np.minimum(best, d[j])
    return np.sort(out)


def build(spark, x, leaf_size=8):
    df = spark.createDataFrame(pd.DataFrame({"row": np.arange(len(x)), "x": x[:, 0], "y": x[:, 1]}))
    return P.build_tree(df, "row", P.Space(["x", "y"]), leaf_size)


@pytest.fixture(scope="module")
def cloud():
    """Two far clumps, a third of the rows at one spot, and a grid full of equal distances."""
    rng = np.random.default_rng(3)
    grid = np.array([(i, j) for i in range(4) for j in range(4)]) * 0.5 + 20
    return np.concatenate([rng.normal(0, .2, (30, 2)), rng.normal(9, 1, (30, 2)), np.full((38, 2), 4.0), grid])


@pytest.mark.parametrize("k", [1, 5])
def test_heights_equal_all_pairs(spark, cloud, k):
    edges = K.spanning_tree(build(spark, cloud), k)
    got = K.merges(edges).toPandas().sort_values("merge")
    assert list(got["merge"]) == list(range(1, len(cloud)))
    assert np.allclose(got["height"], prim(cloud), atol=1e-12)
    ends = got[["a", "b"]].to_numpy()
    assert np.allclose(np.sqrt(((cloud[ends[:, 0]] - cloud[ends[:, 1]]) ** 2).sum(1)), got["height"])


def test_cuts_equal_the_components_at_a_height(spark, cloud):
    tree = build(spark, cloud)
    edges = K.spanning_tree(tree)
    d = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(-1))
    for height in (0.0, 0.5, 3.0):
        name = np.arange(len(cloud))
        for _ in range(len(cloud)):
            low = np.where(d <= height + 1e-12, name[None], len(cloud)).min(1)
            if (low == name).all():
                break
            name = low
        got = K.cut(tree, edges, height + 1e-12).toPandas().sort_values("id")
        assert list(got["cluster"]) == list(name)


def test_one_point_has_no_merges(spark):
    assert K.spanning_tree(build(spark, np.zeros((1, 2)))).count() == 0
    copies = K.spanning_tree(build(spark, np.zeros((4, 2)))).toPandas()
    assert sorted(zip(copies["a"], copies["b"], copies["dist"])) == [(0, 1, 0.0), (0, 2, 0.0), (0, 3, 0.0)]


def test_a_search_leaves_out_the_largest_component_and_finds_the_edges_of_the_others(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (40, 2)), rng.normal(12, 1, (9, 2)), [[30.0, 0.0]]])
    tree = build(spark, x)
    name = np.repeat([0, 40, 49], [40, 9, 1])
    comp = spark.createDataFrame([(i, int(c)) for i, c in enumerate(name)], "pid long, comp long")
    none = spark.createDataFrame([], "pid long, other long, dist double, comp long, to long, a long, b long")
    seen = comp.select("pid", K.F.lit(0.0).alias("seen"))
    got = {r["comp"]: (r["dist"], r["a"], r["b"], r["to"]) for r in K._searched(tree, comp, none, seen).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert got.keys() == {40, 49}
    for c, (dist, a, b, to) in got.items():
        away = np.where((name == c)[:, None] & (name != c)[None], d, np.inf)
        i, j = np.unravel_index(away.argmin(), away.shape)
        assert np.isclose(dist, away.min()) and {a, b} == {i, j} and to == name[j]
