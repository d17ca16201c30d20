import hashlib
import random

import numpy as np
import pytest

from raregrain.functions.scratch import materialise
from raregrain.llm import exact
from raregrain.llm.exact import cells, drop_duplicates, exact_duplicates, maybe_repeated, repeated_filter

from .fixtures import CLASHES, awkward_rows, documents, fold


def digest(text):
    return hashlib.sha256(fold(text or "").encode()).hexdigest()


def brute(rows):
    best = {}
    for i, t in rows:
        best[digest(t)] = max(best.get(digest(t), -1), -1 if i is None else i)
    return {k: None if v < 0 else v for k, v in best.items()}


@pytest.mark.parametrize("bits_per_row", [16, 1])  # the second: a filter full of false positives
def test_equals_brute_force(spark, bits_per_row):
    rng = random.Random(0)
    rows = [(i, f"Text {rng.randrange(150)}") for i in range(400)]
    df = documents(spark, rows).selectExpr("doc_id", "sha2(lower(text), 256) AS sha")
    got = {r.doc_id: r for r in exact_duplicates(df, "sha", bits_per_row=bits_per_row).collect()}
    best, size = brute(rows), {}
    for _, t in rows:
        size[digest(t)] = size.get(digest(t), 0) + 1
    assert len(got) == 400
    for i, t in rows:
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (best[digest(t)], size[digest(t)],
                                                                   best[digest(t)] == i)


def test_awkward_rows_keep_one_of_each_text(spark):
    rows = awkward_rows()
    df = documents(spark, rows, clashes=True)
    out = drop_duplicates(df)
    assert out.columns == df.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(digest(t) for _, t in kept) == sorted(brute(rows))
    assert {digest(t): i for i, t in kept} == brute(rows)
    assert all(r[c] == "x" for r in out.collect() for c in CLASHES)


def test_empty_table(spark):
    assert drop_duplicates(documents(spark, [])).count() == 0


def test_only_maybe_repeated_rows_pass_the_filter(spark):
    df = spark.range(5000).selectExpr("xxhash64(id % 4900) AS h")
    bits = 1 << 17
    test = maybe_repeated(spark, repeated_filter(df, bits), bits)
    hit = df.select(test("h").alias("m"), "h").where("m")
    assert hit.select("h").distinct().count() >= 100  # no repeated hash is missed
    assert hit.count() < 260  # and few others pass


def test_filter_is_bounded():
    assert exact.MAX_BITS // 8 <= 1 << 24
    at = cells(np.arange(100, dtype=np.uint64), 1024)
    assert at.shape == (exact.HASHES, 100) and at.max() < 1024


def test_no_task_asks_the_filter_twice(spark, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df)
        return materialise(df)
    monkeypatch.setattr(exact, "materialise", noted)
    docs = materialise(documents(spark, [(i, f"Text {i % 7}") for i in range(40)]))
    plans.append(drop_duplicates(docs))
    steps = [df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") for df in plans]
    assert steps[0] == 1 and max(steps) == 1, steps
