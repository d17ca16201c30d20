import random

import pytest

from raregrain.functions.scratch import materialise
from raregrain.llm import common, splits, substrings
from raregrain.llm.substrings import COVER, PERIOD, WINDOW, dedup_substrings

from .fixtures import CLASHES, awkward_rows, documents, prose, words


def brute(rows, width=WINDOW):
    """Kept words of each row; a null id is larger than all others."""
    first = {}
    order = [(float("inf") if i is None else i, words(t)) for i, t in rows]
    for i, ws in order:
        for k in range(len(ws) - width + 1):
            w = tuple(ws[k:k + width])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, ws in order:
        gone = [False] * len(ws)
        for k in range(len(ws) - width + 1):
            if first[tuple(ws[k:k + width])] < i:
                gone[k:k + width] = [True] * width
        out.append((len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def check(df, rows, **more):
    got = dedup_substrings(df, **more).collect()
    want = sorted((str(i), *w) for (i, _), w in zip(rows, brute(rows, more.get("width", WINDOW))))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == want
    return got


def passages(seed, n=120):
    rng = random.Random(seed)
    shared = [prose(rng, rng.randrange(11, 40)) for _ in range(8)]
    return [(i, " ".join(x for _ in range(3) for x in (prose(rng, rng.randrange(0, 20)), rng.choice(shared), "\n")))
            for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_brute_force_over_several_splits(spark, parts):
    rows = passages(parts)
    check(materialise(documents(spark, rows).repartition(parts)), rows)


def test_other_window_and_cover(spark):
    rows = passages(3, 60)
    check(documents(spark, rows), rows, width=15, period=13, cover=(0, 1, 3, 9))


def test_a_match_of_exactly_one_window_is_found_at_every_alignment(spark):
    rng = random.Random(9)
    same = prose(rng, WINDOW, 10**6)
    rows = [(a * PERIOD + b, f"{prose(rng, a, 10**6)} {same} {prose(rng, b, 10**6)}")
            for a in range(PERIOD) for b in range(PERIOD)]
    got = check(documents(spark, rows), rows)
    assert sum(r.n_removed for r in got) == WINDOW * (len(rows) - 1)


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = check(documents(spark, rows, clashes=True), rows)
    assert all(r[c] == "x" for r in got for c in CLASHES if c not in ("kept_text", "n_words", "n_removed"))


def test_repeats_inside_a_document_stay(spark):
    rng = random.Random(1)
    p = prose(rng, 30)
    check(documents(spark, [(1, f"{p} {p}"), (2, "other")]), [(1, f"{p} {p}"), (2, "other")])


def test_empty_table_and_bad_cover(spark):
    assert dedup_substrings(documents(spark, [])).count() == 0
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
    with pytest.raises(ValueError):
        dedup_substrings(documents(spark, []), cover=(0, 1))


def test_splits_cut_anew_between_the_scans(spark, tmp_path, monkeypatch):
    """Spark sizes its input splits by the cores that are there, so each scan may cut a file elsewhere."""
    monkeypatch.setattr(common, "SPLIT_ROWS", 150)  # keys that span tasks
    rows = passages(5, 2000)
    path = f"{tmp_path}/rows.parquet"
    documents(spark, rows).coalesce(1).write.option("parquet.block.size", 4096).parquet(path)
    scan = splits.exchange
    widths = iter(["20k", "7k"])

    def moved(*args):
        folder = scan(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(widths))
        return folder
    monkeypatch.setattr(substrings, "exchange", moved)
    try:
        check(spark.read.parquet(path), rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_split_that_no_scan_met_is_an_error(spark):
    folder = splits.exchange(spark.createDataFrame([(0, 5, b"")], splits.MESSAGE), lambda part, rows: iter(rows), b"".join)
    assert splits.load(folder, 5, 1) is None
    with pytest.raises(RuntimeError):
        splits.load(folder, 6, 1)
