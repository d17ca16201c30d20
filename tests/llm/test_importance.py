import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from raregrain.llm import importance
from raregrain.llm.importance import bucket_counts, features, importance_draw, importance_resample, in_order

from .fixtures import CLASHES, awkward_rows, documents, fold, prose

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest):
    words = WORDS.findall(fold(text or ""))
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, items, longest=2, buckets=10_000, least=20, share=25, seed=7):
    """{row number: (n_features, weight, score, rank)} straight from the definition."""
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in grams(x, longest)) for texts in ([x for _, x in rows], items))
    s_all, t_all = float(sum(s.values())), float(sum(t.values()))
    out = []
    for i, x in rows:
        got = grams(x, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
                for b in map(bucket, got)]
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        out.append([i, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (_, x) in zip(out, rows) if len(grams(x, 1)) >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[:share * len(able) // 100], 1):
        r[4] = rank
    return out


def corpus(n=300):
    rng = random.Random(3)
    return [(i, prose(rng, rng.choice([0, 5, 19, 20, 21, 60]), 80)) for i in range(n)], [prose(rng, 30, 20) for _ in range(9)]


@pytest.mark.parametrize("longest,share", [(2, 25), (1, 100), (3, 10)])
def test_equals_brute_force(spark, longest, share):
    rows, items = corpus()
    target = spark.createDataFrame([(t,) for t in [*items, None, ""]], "text string")
    got = importance_draw(documents(spark, rows), target, longest=longest, share=share).collect()
    assert (sorted([r.doc_id, r.n_features, r.weight, r.score, r["rank"]] for r in got)
            == sorted(brute(rows, items, longest, share=share)))


def test_awkward_rows_with_clashing_columns(spark):
    rows, items = awkward_rows(), ["w1 w2 w3 one", "é ü ñ"]
    df = documents(spark, rows, clashes=True).selectExpr("*", "1 AS weight", "2 AS place", "3 AS n_features")
    target = spark.createDataFrame([(t,) for t in items], "text string")
    got = importance_draw(df, target).collect()

    def order(rs):
        return sorted(map(tuple, rs), key=repr)
    # Rows that share id and score may take each other's rank.
    assert order((r.doc_id, r.n_features, r.weight, r.score) for r in got) == order(r[:4] for r in brute(rows, items))
    assert sorted(r["rank"] for r in got if r["rank"]) == sorted(r[4] for r in brute(rows, items) if r[4])
    kept = importance_resample(df, target)
    assert kept.columns == df.columns
    assert all(r[c] == "x" for r in kept.collect() for c in CLASHES)


def test_resample_keeps_whole_drawn_documents(spark):
    rows, items = corpus()
    target = spark.createDataFrame([(t,) for t in items], "text string")
    got = importance_resample(documents(spark, rows), target)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(
        (i, dict(rows)[i]) for i, *_, rank in brute(rows, items) if rank)


def test_empty_tables(spark):
    none, target = documents(spark, []), spark.createDataFrame([("a b",)], "text string")
    assert importance_draw(none, target).count() == 0
    assert importance_resample(none, target).count() == 0
    short = documents(spark, [(1, "a b"), (2, None)])
    got = importance_draw(short, target.limit(0)).collect()
    assert [(r.n_features, r["rank"]) for r in sorted(got)] == [(3, None), (0, None)]
    assert importance_resample(short, target).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 1 << 17])
def test_features_do_not_depend_on_blocks(monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK", block)
    texts = ["a b c", "", "A--B", "d", "é日 x\x00y z", "q"]
    want = Counter((n, zlib.crc32(g.encode()), i) for i, t in enumerate(texts) for n in (1, 2, 3)
                   for g in grams(t, 3) if g.count(" ") == n - 1)
    got = Counter((n, int(c), int(o)) for n, crc, own in features([t.encode() for t in texts], 3)
                  for c, o in zip(crc, own))
    assert got == want


def test_counts_cover_every_text(spark):
    rows, _ = corpus(50)
    counts = bucket_counts(documents(spark, rows).repartition(7), buckets=64)
    want = Counter(zlib.crc32(g.encode()) % 64 for _, t in rows for g in grams(t, 2))
    assert counts.tolist() == [want[b] for b in range(64)]


def test_places_are_exact_where_one_key_holds_most_rows(spark):
    df = spark.range(5000).selectExpr("id", "IF(id % 3 = 0, 7, id) AS v")
    got = in_order(df, [df.v.desc(), df.id.asc()], "place").collect()
    want = sorted(((r.id, 7 if r.id % 3 == 0 else r.id) for r in got), key=lambda r: (-r[1], r[0]))
    assert [(r.id, r.v) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 5001))
