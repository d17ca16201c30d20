import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from raregrain.functions.scratch import materialise
from raregrain.llm import tokenfiles as tf
from raregrain.llm.common import shared_uri

from .fixtures import awkward_rows, documents, prose


@pytest.mark.parametrize("bits,top", [(1, 1 << 16), (2, 1 << 32)])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_code_round_trip(bits, top, n):
    rng = np.random.default_rng(n)
    x = (rng.integers(0, top, n) >> rng.integers(0, 24, n)).astype(np.uint32)
    code = tf.Code(bits)
    control, data = code.encode(x)
    assert (code.decode(control, data, n) == x).all()
    assert len(control) == -(-n * bits // 8)
    assert bits == 2 or len(data) == (x < 256).sum() + 2 * (x >= 256).sum()


@pytest.mark.parametrize("bits,top", [(1, 1 << 16), (2, 1 << 32)])
def test_runs_coded_together_are_those_coded_alone(bits, top):
    rng = np.random.default_rng(bits)
    sizes = np.array([1, 8, 0, 3, 700, 9, 16, 1])
    x = (rng.integers(0, top, sizes.sum()) >> rng.integers(0, 24, sizes.sum())).astype(np.uint32)
    code, cuts = tf.Code(bits), np.cumsum(sizes)[:-1]
    assert code.encode_many(x, sizes) == [code.encode(part) for part in np.split(x, cuts)]
    assert code.encode_many(x[:0], sizes[:0]) == []
    control, data = map(b"".join, zip(*code.encode_many(x, sizes)))
    assert np.array_equal(code.decode_many(control, data, sizes), x)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(tf, "SHARD_IDS", 2000)
    monkeypatch.setattr(tf, "BLOCK", 100)


def written(spark, rows, parts=3):
    folder = shared_uri(spark)
    shards = tf.write_token_files(materialise(documents(spark, rows, clashes=True).repartition(parts)), folder,
                                  tf.word_path())
    return folder, shards, tf.read_token_files(folder, shards).collect()


def ids_of(text):
    tool = Tokenizer.from_file(tf.word_path())
    return [*tool.encode(text or "", add_special_tokens=False).ids, tf.END]


def test_files_hold_all_documents_in_order(spark, small):
    rng = random.Random(3)
    rows = [(7 * i, prose(rng, rng.randrange(0, 200))) for i in range(150)]
    folder, shards, out = written(spark, rows)
    assert shards.count() > 3
    got, at = {r.doc_id: r for r in out}, 0
    for d, t in sorted(rows):
        ids = ids_of(t)
        assert (got[d].start, got[d].n_tokens) == (at, len(ids))
        assert np.frombuffer(got[d].ids, "<u4").tolist() == ids
        at += len(ids)
    fs, root = tf.shared_fs(folder)
    with fs.open_input_stream(f"{root}/ranks.bin") as f:
        ranks = np.frombuffer(f.read(), "<u4")
    assert ranks[0] == np.bincount(np.concatenate([np.frombuffer(r.ids, "<u4") for r in out])).argmax()


def test_awkward_rows(spark, small):
    rows = awkward_rows()
    _, _, out = written(spark, rows)
    want = sorted((i is not None, i or 0, ids_of(t)) for i, t in rows)
    got = sorted(out, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i if known else None for known, i, _ in want]
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in out) == want
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])][:-1].tolist()


def test_empty_table(spark):
    assert written(spark, [], 1)[2] == []


def test_a_broken_file_is_refused(spark, small):
    folder, shards, _ = written(spark, [(1, "a b c")], 1)
    fs, root = tf.shared_fs(folder)
    with fs.open_output_stream(f"{root}/shard-00000000.ids") as f:
        f.write(b"0" * 200)
    with pytest.raises(Exception, match="no token-id file"):
        tf.read_token_files(folder, shards).collect()


def test_a_reader_decodes_parts_of_documents_and_many_documents(spark, small, monkeypatch):
    rng = random.Random(5)
    rows = [(i, prose(rng, 400 if i == 3 else rng.randrange(0, 60))) for i in range(40)]
    folder, shards, out = written(spark, rows)
    monkeypatch.setattr(tf, "READ", 150)
    assert sorted(tf.read_token_files(folder, shards).collect()) == sorted(out)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out} == {i: ids_of(t) for i, t in rows}


def test_an_end_id_beyond_two_bytes_stays_whole(spark):
    folder = shared_uri(spark)
    shards = tf.write_token_files(materialise(documents(spark, [(1, "a b")])), folder, tf.word_path(), end=70_000)
    assert np.frombuffer(tf.read_token_files(folder, shards).first().ids, "<u4").tolist() == [*ids_of("a b")[:-1], 70_000]
