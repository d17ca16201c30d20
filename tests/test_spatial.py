"""Neighbour search against brute force, with a third of the rows at one spot."""

import numpy as np
import pandas as pd
import pytest

from raregrain.operators import resample as R
from raregrain.operators import spatial as P


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    x = np.round(np.concatenate([rng.normal(0, .05, (60, 2)), rng.normal(1, .3, (60, 2)), np.full((60, 2), 0.5)]), 3)
    ids = rng.permutation(180)
    df = spark.createDataFrame(pd.DataFrame({"row_id": ids, "a": x[:, 0], "b": x[:, 1], "label": (ids % 4 == 0).astype(int)}))
    order = np.argsort(ids)
    return df, x[order]


@pytest.fixture(scope="module")
def tree(cloud):
    return P.build_tree(cloud[0], "row_id", P.Space(["a", "b"]), leaf_size=8)


def squared(x):
    return ((x[:, None] - x[None]) ** 2).sum(-1)


def test_tree_covers_every_point_once(tree):
    leaves = tree.nodes.where("is_leaf").toPandas()
    assert leaves["n_points"].max() <= 8 and leaves["weight"].sum() == 180
    assert tree.rows.count() == 180


def test_nearest_neighbours(cloud, tree):
    d = np.sqrt(squared(cloud[1]))
    got = P.knn(tree, 5).toPandas()
    assert len(got) == 900
    for i, g in got.groupby("id"):
        want = sorted((round(d[i, j], 9), j) for j in range(180) if j != i)[:5]
        g = g.sort_values("rank")
        assert [round(v, 9) for v in g["dist"]] == pytest.approx([w[0] for w in want])
        ties = {w[0] for w in want}
        if len(ties) == 5:
            assert list(g["neighbour"]) == [w[1] for w in want]


def test_copies_have_each_other(cloud, tree):
    hot = [i for i, v in enumerate(cloud[1]) if tuple(v) == (0.5, 0.5)]
    got = P.knn(tree, 3).toPandas()
    for i in hot:
        assert list(got[got["id"] == i].sort_values("rank")["neighbour"]) == [j for j in hot if j != i][:3]


def test_k_distance_counts_the_row_itself(cloud, tree):
    d = np.sort(np.sqrt(squared(cloud[1])), axis=1)[:, 6]
    got = P.k_distance(tree, 7).toPandas().sort_values("id")["dist"]
    assert np.allclose(got, d)


@pytest.mark.parametrize("eps,minimum", [(0.06, 7), (0.2, 4), (0.03, 1)])
def test_density_clusters(cloud, tree, eps, minimum):
    near = squared(cloud[1]) <= eps * eps
    core = near.sum(1) >= minimum
    label, comp = -np.ones(180, dtype=int), {}
    for i in range(180):
        if core[i] and i not in comp:
            n, todo = len(set(comp.values())), [i]
            while todo:
                v = todo.pop()
                if v not in comp:
                    comp[v] = n
                    todo += [j for j in range(180) if near[v, j] and core[j] and j not in comp]
    for i in range(180):
        if i in comp:
            label[i] = comp[i]
        elif (near[i] & core).any():
            label[i] = min(comp[j] for j in range(180) if near[i, j] and core[j])
    got = P.density_clusters(tree, eps, minimum).toPandas().sort_values("id")
    assert (got["is_core"].to_numpy() == core).all()
    assert (got["cluster"].to_numpy() == label).all()
    counts = P.radius_counts(P.radius_pairs(tree, eps)).toPandas().sort_values("id")["n"]
    assert (counts.to_numpy() == near.sum(1)).all()


def test_synthetic_rows(spark, cloud):
    df = cloud[0].selectExpr("*", "cast(row_id % 3 as string) AS kind")
    syn = R.synthetic_rows(df, ["a", "b"], ["kind"], leaf_size=8).toPandas()
    assert len(syn) == 135 - 45
    base = df.toPandas().set_index("row_id")
    assert base.loc[syn["base"], "label"].all() and base.loc[syn["neighbour"], "label"].all()
    lo = np.minimum(base.loc[syn["base"], "a"].to_numpy(), base.loc[syn["neighbour"], "a"].to_numpy()) - 1e-9
    hi = np.maximum(base.loc[syn["base"], "a"].to_numpy(), base.loc[syn["neighbour"], "a"].to_numpy()) + 1e-9
    assert ((syn["a"] >= lo) & (syn["a"] <= hi)).all()
    both = R.oversample(df, ["a", "b"], ["kind"]).groupBy("label").count().collect()
    assert {r["count"] for r in both} == {135}


def test_mixed_distance_neighbours(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"row_id": range(120), "a": np.round(rng.normal(size=120), 3), "k": rng.integers(0, 3, 120).astype(float)})
    t = P.build_tree(spark.createDataFrame(pdf), "row_id", P.Space(["a"], ["k"], 0.7), leaf_size=6)
    d = (pdf["a"].to_numpy()[:, None] - pdf["a"].to_numpy()) ** 2 + 0.49 * (pdf["k"].to_numpy()[:, None] != pdf["k"].to_numpy())
    want = np.sqrt(np.sort(d, axis=1)[:, 1:5])
    got = P.knn(t, 4).toPandas().sort_values(["id", "rank"])["dist"].to_numpy().reshape(120, 4)
    assert np.allclose(got, want)


def test_long_chain_is_one_component(spark):
    e = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    c = P.connected_components(e, spark.range(210).selectExpr("id AS v")).toPandas()
    assert (c[c["v"] <= 200]["comp"] == 0).all() and (c[c["v"] > 200]["comp"] == c[c["v"] > 200]["v"]).all()


def test_neighbours_meet_in_tasks_and_pairs_are_not_exchanged(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 4)) + 1e6  # a far origin costs no digits
    x[70:] = x[3]
    df = spark.createDataFrame(pd.DataFrame({"row": np.arange(90), **{f"x{i}": x[:, i] for i in range(4)}}))
    near = P.nearest(P.build_tree(df, "row", P.Space([f"x{i}" for i in range(4)]), 8), 5, False)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and "Window" not in plan and "xs" not in near.schema.simpleString()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    got = {r["pid"]: [n["id"] for n in r["neighbours"]] for r in near.collect()}
    assert got == {i: list(np.lexsort((np.arange(90), d[i]))[:5]) for i in range(70)}
