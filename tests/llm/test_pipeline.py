import os
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from raregrain.functions.scratch import materialise
from raregrain.llm.langid import held_out
from raregrain.llm.packing import byte_path, pack_documents
from raregrain.llm.tokens import encoder
from tests.parity import compare, connect

from . import test_exact, test_near, test_substrings
from .fixtures import documents, prose


def corpus(seed=3):
    rng = random.Random(seed)
    shared = prose(rng, 40, 10**5)
    out = []
    for _ in range(25):
        base = prose(rng, rng.randrange(60, 200), 10**5)
        out += [base, base.upper()] if rng.random() < 0.3 else [base]
        if rng.random() < 0.4:
            out.append(test_near.edited(rng, base, 2))
        if rng.random() < 0.4:
            out.append(f"{prose(rng, 50, 10**5)} {shared}\n{prose(rng, 30, 10**5)}")
    out += ["123 456", None, "", "!!!"]
    return [(i, t) for i, t in enumerate(out)]


def stage(spark, name, rows):
    out = dict(cp.STAGES)[name](spark, materialise(documents(spark, rows)), "")
    assert out.columns == cp.COLUMNS
    return sorted((r.doc_id, r.text) for r in out.collect())


def test_language_stage_rejects_what_has_no_language_and_keeps_the_rest(spark):
    rows = corpus()
    assert stage(spark, "language_id", rows) == [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]


def test_exact_stage(spark):
    rows = [r for r in corpus() if r[1]]
    best = test_exact.brute(rows)
    assert stage(spark, "exact_dedup", rows) == [(i, t) for i, t in rows if best[test_exact.digest(t)] == i]


def test_near_stage_keeps_one_of_each_class(spark):
    rows = [r for r in corpus() if r[1]]
    label = test_near.brute(rows)
    assert stage(spark, "near_dedup", rows) == [(i, t) for i, t in rows if label[i] == i]


def test_substring_stage_cuts_passages_and_leaves_other_texts_as_they_are(spark):
    rows = [r for r in corpus() if r[1]]
    want = [(i, kept if gone else t) for (i, t), (n, gone, kept) in zip(rows, test_substrings.brute(rows))
            if gone == 0 or gone < n]
    assert stage(spark, "substring_dedup", rows) == want


def test_run_packs_what_the_stages_leave(spark, tmp_path):
    rows = corpus()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    rows = [(i, t) for i, t in rows if test_exact.brute(rows)[test_exact.digest(t)] == i]
    rows = [(i, t) for i, t in rows if test_near.brute(rows)[i] == i]
    rows = [(i, kept if gone else t) for (i, t), (n, gone, kept) in zip(rows, test_substrings.brute(rows))
            if gone == 0 or gone < n]
    out = cp.run(spark, str(tmp_path)).collect()
    assert sorted({r.doc_id for r in out}) == [i for i, _ in rows]
    from . import test_packing
    test_packing.check(out, rows, cp.byte_path(), 2048)


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_query_equals_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_language_accuracy_on_held_out_documents(spark, sf):
    out = entry.queries()["op4_language_id"](spark, sf)
    docs = spark.read.parquet(os.path.join(sf, "documents.parquet")).select("doc_id", "lang")
    held = out.where(held_out()).join(docs, "doc_id")
    assert out.count() == docs.count()
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()


def test_packing_in_the_pipeline_remembers_little_and_gives_the_same(spark, monkeypatch):
    tool = encoder(byte_path(), cp.REMEMBERED)
    for at in range(0, 300_000, 20_000):
        tool.encode([" ".join(f"w{i}" for i in range(at, at + 20_000))])
    held = sum(len(m.young) + len(m.old) for m in (tool.plain, tool.spaced))
    encoder(byte_path())
    assert held <= 2 * cp.REMEMBERED + 100
    rows = corpus()
    docs = materialise(documents(spark, rows))
    monkeypatch.setattr(cp, "REMEMBERED", 50)
    found = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert (sorted(cp.pack(spark, docs, "").select(*found).collect(), key=str)
            == sorted(pack_documents(docs, byte_path()).select(*found).collect(), key=str))
