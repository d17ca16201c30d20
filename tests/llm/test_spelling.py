import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from raregrain.llm import spelling
from raregrain.llm.spelling import drop_one, follow, near_words, op12_spelling_variants, pivots, variants, word_counts

from .fixtures import awkward_rows, documents, fold

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    """By definition: one code point replaced, or one deleted from the longer word."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs of a small table."""
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def vocabulary(rng, letters, n, lengths):
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(n)}
    for w in list(words):
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:],
                                  w[:i] + rng.choice(letters) + w[i + 1:]]))
    return words


@pytest.mark.parametrize("letters,lengths,least", [
    ("ab", [6, 7, 8, 9], 6), ("abcdefghijklmnopqrstuvwxyzéñ", [6, 7, 12], 6), ("a", list(range(4, 40)), 4),
    ("abc", [4, 5, 6], 4), ("aé\U0001F600", [6, 7, 8], 6)])
def test_equals_brute_force(spark, letters, lengths, least):
    rng = random.Random(len(letters))
    counts = {w: rng.choice([5, 6, 30, 31, 200, 1500]) for w in vocabulary(rng, letters, 220, lengths) if len(w) >= least}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(df, min_length=least).collect()}
    assert got == brute(counts)


def test_near_pairs_come_once_in_each_direction(spark):
    df = spark.createDataFrame([("banana", 5), ("bananas", 9), ("banane", 7), ("cabana", 5)], "word string, n long")
    got = sorted((r.word, r.n, r.near, r.near_n) for r in near_words(df).collect())
    assert got == [("banana", 5, "bananas", 9), ("banana", 5, "banane", 7), ("bananas", 9, "banana", 5),
                   ("banane", 7, "banana", 5)]


def test_pivots_are_disjoint_and_least():
    rng = random.Random(1)
    for _ in range(300):
        places = rng.sample(range(8), 5)
        grams = [(p, rng.randrange(20)) for p in places]
        cost = dict(grams)
        best = min(cost[a] + cost[b] for a, b in combinations(sorted(places), 2) if b - a >= 2)
        a, b = pivots(grams)
        assert b - a >= 2 and cost[a] + cost[b] == best


def naive_words(rows, least=6, modulus=199):
    seen = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                seen[run] += 1
    return seen


@pytest.mark.parametrize("flush", [1 << 18, 3])
def test_counts_equal_the_definition(spark, monkeypatch, flush):
    monkeypatch.setattr(spelling, "FLUSH", flush)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["Straße", "naïveté", "résumés", "abcdefg", "ÉCOLES", "x1y", "z" * 40, "short"])
                         + rng.choice(["", ",", "'s", "É"]) for _ in range(60))) for i in range(80)] + awkward_rows()
    df = documents(spark, rows, clashes=True).selectExpr("*", "'q' AS word", "1 AS n").repartition(3)
    got = {r.word: r.n for r in word_counts(df, edit=lambda runs, doc: drop_one(runs, doc, 7)).collect()}
    assert got == naive_words(rows, modulus=7)


def test_chains_end_at_the_last_form(spark):
    df = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r.word: r.root for r in follow(df).collect()} == {f"w{i}": "w9" for i in range(9)}


def test_repeated_words_add_up_and_empty_tables(spark):
    df = spark.createDataFrame([("banana", 5), ("banana", 6), ("short", 99)], "word string, n long")
    assert [tuple(r) for r in variants(df).collect()] == [("banana", None, "banana", 11, 0, None)]
    assert variants(df.limit(0)).count() == 0
    assert word_counts(documents(spark, [])).count() == 0
    assert word_counts(documents(spark, [(1, None), (2, "")])).count() == 0


def test_words_too_short_for_two_pivots_are_refused(spark):
    with pytest.raises(ValueError, match="at least 4"):
        near_words(spark.createDataFrame([("abc", 5)], "word string, n long"), min_length=3)


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts = {w: n for w, n in naive_words(rows).items() if n >= 5}
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in op12_spelling_variants(spark, sf).collect()}
    assert got == brute(counts)
