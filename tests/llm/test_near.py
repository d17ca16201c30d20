import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from raregrain.functions.scratch import materialise
from raregrain.llm import common
from raregrain.llm import dartminhash as dm
from raregrain.llm.words import shingles, word_hashes

from .fixtures import awkward_rows, documents, fold, prose, words


def bag(text):
    ws = words(fold(text or ""))
    return Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) > 4 else Counter([tuple(ws)] if ws else [])


def similarity(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute(rows):
    bags = {i: bag(t) for i, t in rows if i is not None}
    label = {i: i for i in bags}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in bags:
        for j in bags:
            if i < j and bags[i] and similarity(bags[i], bags[j]) >= dm.SIMILARITY:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return {i: root(i) for i in bags}


def edited(rng, text, n):
    ws = text.split()
    for _ in range(n):
        ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
    return " ".join(ws)


def family(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = prose(rng, rng.randrange(40, 400))
        out += [base] * rng.randrange(1, 4)
        out += [edited(rng, base, rng.randrange(0, 5)) for _ in range(rng.randrange(0, 6))]
    rng.shuffle(out)
    return list(enumerate(out))


def classes(df):
    return {r.doc_id: r.class_id for r in dm.near_duplicate_classes(df).collect()}


def test_equals_brute_force(spark):
    rows = family(4, 30)
    assert classes(materialise(documents(spark, rows).repartition(5))) == brute(rows)


def test_chain_whose_ends_differ_is_one_class(spark, monkeypatch):
    monkeypatch.setattr(dm, "BLOCK", 3)
    rng = random.Random(2)
    chain = [prose(rng, 300)]
    for _ in range(14):
        chain.append(edited(rng, chain[-1], 5))
    rows = list(enumerate(chain))
    rng.shuffle(rows)
    assert classes(documents(spark, rows)) == brute(rows)


def test_awkward_rows(spark):
    rows = awkward_rows()
    out = dm.near_duplicate_classes(documents(spark, rows, clashes=True)).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r.class_id for r in out if r.doc_id is not None}
    assert got == brute(rows)
    assert all(r.class_id is None for r in out if r.doc_id is None)


def test_empty_table(spark):
    assert dm.near_duplicate_classes(documents(spark, [])).count() == 0


def test_joining_links_join_what_similar_pairs_join(monkeypatch):
    monkeypatch.setattr(dm, "COLUMNS", 50)
    rng = random.Random(6)
    base = prose(rng, 120)
    texts = [edited(rng, base, rng.randrange(6)) for _ in range(40)] + [prose(rng, 30) + " a b c d e f" * 4]
    bodies = []
    for t in texts:
        values, counts = np.unique(shingles(*word_hashes(pa.array([t]), fold=True), dm.WIDTH)[0], return_counts=True)
        bodies.append(np.stack([values, counts.astype(np.uint64)]).tobytes())
    rows = [(i, i, b) for i, b in enumerate(bodies)]
    found = dm.joining_links(rows, rows, dm.SIMILARITY)
    label = {i: i for i in range(len(texts))}
    for a, b in found:
        assert similarity(bag(texts[a]), bag(texts[b])) >= dm.SIMILARITY
        old, new = label[b], label[a]
        label = {k: new if v == old else v for k, v in label.items()}
    want = brute(list(enumerate(texts)))
    assert {frozenset(k for k in label if label[k] == v) for v in label.values()} == {
        frozenset(k for k in want if want[k] == v) for v in want.values()}


def test_signatures_estimate_the_weighted_similarity():
    rng = random.Random(7)
    a = prose(rng, 300, 10**6)
    pairs = [(a, edited(rng, a, 10)), (a + " " + a, a), ("x y z", "x y z"), (a, prose(rng, 200))]
    k = 2000
    for x, y in pairs:
        hashes, first = word_hashes(pa.array([x, y]), fold=True)
        s = dm.dart_signatures(*shingles(hashes, first, dm.WIDTH), 2, k)
        assert (s != 0).all()
        assert abs((s[0] == s[1]).mean() - similarity(bag(x), bag(y))) < 0.05


def test_signature_of_a_text_does_not_depend_on_its_neighbours():
    rng = random.Random(8)
    texts = [prose(rng, n) for n in (3, 30, 300)]
    k = dm.BANDS * dm.ROWS
    together = dm.dart_signatures(*shingles(*word_hashes(pa.array(texts)), dm.WIDTH), 3, k)
    alone = [dm.dart_signatures(*shingles(*word_hashes(pa.array([t])), dm.WIDTH), 1, k)[0] for t in texts]
    assert (together == np.stack(alone)).all()


def test_components_of_a_long_path_and_a_star(spark):
    n = 400
    path = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1001, 1400).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b"))
    got = {r.id: r.component for r in dm.components(path.union(star)).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), **dict.fromkeys(range(1000, 1400), 1000)}


def test_splits_cut_anew_between_the_scans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "SPLIT_ROWS", 150)
    rows = family(12, 150)
    path = f"{tmp_path}/rows.parquet"
    documents(spark, rows).coalesce(1).write.option("parquet.block.size", 4096).parquet(path)
    scan = dm.exchange

    def moved(*args):
        folder = scan(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        return folder
    monkeypatch.setattr(dm, "exchange", moved)
    try:
        assert classes(spark.read.parquet(path)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
