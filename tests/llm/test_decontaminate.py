import random
import re

import pytest

from raregrain.llm.decontaminate import contamination, op13_decontamination

from .fixtures import CLASHES, awkward_rows, documents, fold, prose

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(fold(text or ""))


def brute(text, items, width):
    """(n_words, hit places, item ids) by comparing every window with every place."""
    ws, hit, ids = words(text), set(), set()
    for i, t in items:
        item = words(t)
        n = min(width, len(item))
        for win in ({tuple(item[k:k + n]) for k in range(len(item) - n + 1)} if n else ()):
            for at in range(len(ws) - n + 1):
                if tuple(ws[at:at + n]) == win:
                    hit |= set(range(at, at + n))
                    if i is not None:
                        ids.add(i)
    return len(ws), hit, ids


def check(got, items, width=10):
    for r in got:
        n, hit, ids = brute(r.text, items, width)
        assert (r.n_words, r.n_hit, set(r["items"]), len(r["items"])) == (n, len(hit), ids, len(ids)), r.doc_id
        assert [p for s in r.spans for p in range(s["first"], s["last"] + 1)] == sorted(hit)
        assert all(b["first"] > a["last"] + 1 for a, b in zip(r.spans, r.spans[1:]))


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("width", [10, 4, 1])
def test_equals_brute_force(spark, width):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.choice([1, 2, 3, 5, 9, 10, 11, 30]), 300)) for i in range(40)]
    items += [(40, items[7][1]), (41, None), (42, " .,; "), (43, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (None, items[3][1])]
    rows = []
    for i in range(150):
        parts = [prose(rng, rng.randrange(40), 300) for _ in range(3)]
        cut = rng.choice(items)[1] or ""
        k = rng.randrange(3)
        parts.insert(1, cut if k == 0 else " ".join(cut.split()[k:]) if k == 1 else cut.upper().replace(" ", " - "))
        rows.append((i, ". ".join(parts)))
    rows += [(900, "w1 " * 25), (901, items[5][1]), (902, "X" + items[5][1])]
    got = contamination(documents(spark, rows).repartition(5), bench(spark, items), width=width).collect()
    assert len(got) == len(rows)
    check(got, items, width)
    assert any(r.n_hit for r in got) and any(not r.n_hit for r in got if r.n_words) or width == 1


def test_one_changed_word_leaves_the_rest_of_the_windows(spark):
    item = " ".join(f"q{i}" for i in range(25))
    rows = [(1, item.replace("q12", "other")), (2, item), (3, " ".join(item.split()[:9])), (4, " ".join(item.split()[3:13]))]
    got = {r.doc_id: r for r in contamination(documents(spark, rows), bench(spark, [(7, item)])).collect()}
    assert [got[i].n_hit for i in (1, 2, 3, 4)] == [24, 25, 0, 10]
    assert [tuple(s) for s in got[1].spans] == [(0, 11), (13, 24)]


def test_awkward_rows_with_clashing_columns(spark):
    rows = awkward_rows()
    items = [(1, rows[8][1][200:900]), (2, "one"), (3, "é ü ñ 日本語"), (4, rows[5][1])]
    df = documents(spark, rows, clashes=True).selectExpr("*", "1 AS file", "2 AS `row`", "3 AS n_hit", "4 AS words")
    out = contamination(df, bench(spark, items).selectExpr("*", "1 AS wid", "2 AS win"))
    got = out.collect()
    assert len(got) == len(rows)
    check(got, items)
    assert out.columns == [c for c in df.columns if c not in ("n_hit", "n_words")] + ["n_words", "n_hit", "spans", "items"]
    assert all(r[c] == "x" for r in got for c in CLASHES if c != "n_words")


def test_empty_tables(spark):
    items = [(1, "a b c")]
    assert contamination(documents(spark, []), bench(spark, items)).count() == 0
    for none in (bench(spark, items).limit(0), bench(spark, [(1, None), (2, "...")])):
        got = contamination(documents(spark, [(1, "a b c"), (2, None)]), none).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"], r.spans) for r in got) == [(1, 3, 0, [], []), (2, 0, 0, [], [])]


def test_items_that_share_a_passage_are_all_listed(spark):
    head = " ".join(f"h{i}" for i in range(12))
    items = [(i, f"{head} tail{i}") for i in range(300)]
    rows = [(i, f"start {head} end") for i in range(50)]
    got = contamination(documents(spark, rows), bench(spark, items)).collect()
    assert all((r.n_hit, len(r["items"])) == (12, 300) for r in got)


def test_no_python_worker_in_the_plan(spark, sf):
    plan = op13_decontamination(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
