import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from raregrain.functions.scratch import materialise
from raregrain.llm import simhash as sh
from raregrain.llm.words import mix, owners, word_hashes

from .fixtures import awkward_rows, documents, prose


def rows_of(n, seed=3):
    rng = random.Random(seed)
    return [(10 * i, prose(rng, rng.randrange(0, 60)) + "é" * rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 6])
def test_edited_text_takes_the_start_of_the_next_document(spark, parts):
    rows = rows_of(300, parts)
    random.Random(parts).shuffle(rows)
    got = {r.doc_id: r for r in sh.fingerprint_documents(
        materialise(documents(spark, rows).repartition(parts))).collect()}
    order = sorted(rows, reverse=True)
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)]
        n = len(t)
        edited = t[:n - n // 2] + after[1][:n // 2]
        o = got[d]
        assert (o.n_chars, o.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        prints = sh.text_fingerprints([t, edited, after[1]])
        assert o.lanes == prints[0].view(np.int64).tolist()
        assert o.edited_lanes == prints[1].view(np.int64).tolist()
        apart = [bin(int(a)).count("1") for a in prints[0] ^ prints[2]]
        assert o.near_next == pytest.approx(1 - sum(apart) / sh.BITS)


def test_votes_equal_a_plain_sum_of_signs():
    rng = random.Random(0)
    hashes, first = word_hashes(pa.array([prose(rng, n, 30) for n in (0, 1, 7, 300, 3000)]), fold=True)
    votes = np.zeros((5, sh.BITS))
    times = Counter(zip(sh.terms(hashes, first).tolist(), np.repeat(owners(first), 2).tolist()))
    for (t, own), n in times.items():
        lanes = np.array([mix(np.array([t], np.uint64) + np.uint64(i + 1))[0] for i in range(sh.LANES)], np.uint64)
        votes[own] += n.bit_length() * (2.0 * np.unpackbits(lanes.view(np.uint8)) - 1)
    assert (np.packbits(votes > 0, axis=1).view(np.uint64) == sh.fingerprints(hashes, first)).all()


def test_half_an_edit_is_nearer_than_another_text():
    rng = random.Random(1)
    a, b = prose(rng, 300, 5000), prose(rng, 300, 5000)
    p = sh.text_fingerprints([a, a[:len(a) // 2] + b[:len(a) // 2], b, a])
    near = sh.likeness(p[[0, 0, 0]], p[[1, 2, 3]])
    assert near[0] > near[1] + 0.08 and near[2] == 1.0


def lanes_of(x):
    return [int(v) for v in np.frombuffer(x.to_bytes(sh.BITS // 8, "little"), np.int64)]


@pytest.mark.parametrize("table,candidates", [(1 << 17, 1 << 18), (16, 7)])
def test_within_radius_equals_brute_force(spark, monkeypatch, table, candidates):
    monkeypatch.setattr(sh, "_TABLE", table)
    monkeypatch.setattr(sh, "_CANDIDATES", candidates)
    rng = random.Random(4)
    base = [rng.getrandbits(sh.BITS) for _ in range(12)]
    prints = [x ^ sum(1 << b for b in rng.sample(range(sh.BITS), rng.randrange(40))) for x in base for _ in range(15)]
    prints += prints[:30] + [0] * 40
    df = materialise(spark.createDataFrame([(i, lanes_of(x)) for i, x in enumerate(prints)], "id bigint, lanes array<bigint>"))
    for radius in (0, 7, 20, sh.RADIUS):
        got = {r.id: r.n_near for r in sh.within_radius(df, df.where("id % 3 = 0"), radius).collect()}
        assert got == {i: sum((x ^ y).bit_count() <= radius for y in prints) - 1
                       for i, x in enumerate(prints) if i % 3 == 0}
    with pytest.raises(ValueError):
        sh.within_radius(df, df, sh.RADIUS + 1)


def test_tables_are_complete_where_every_block_differs():
    rng = random.Random(8)
    x = rng.getrandbits(sh.BITS)
    spread = [x]
    for k in range(sh.BLOCKS):  # one bit in each block, then a second one in all but one
        spread.append(spread[-1] ^ 1 << 16 * k + rng.randrange(8))
    for k in range(sh.BLOCKS - 1):
        spread.append(spread[-1] ^ 1 << 16 * k + 8 + rng.randrange(8))
    prints = np.array([lanes_of(v) for v in spread], np.int64).view(np.uint64)
    got = sh.BlockTables(prints, np.ones(len(prints), np.int64)).counts(prints[:1])
    assert len(prints) == sh.RADIUS + 1 == got[0]


def test_edited_texts_of_shingle_similarity_0_8_are_near(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for k in range(60):  # every id is a multiple of 50: asked for
        ws = prose(rng, 250, 5000).split()
        rows.append((100 * k, " ".join(ws)))
        for at in rng.sample(range(5, 245), 1 + k % 5):
            ws[at] = "other"
        rows.append((100 * k + 50, " ".join(ws)))

    def bag(text):
        ws = ["^"] * 4 + text.split()
        return Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    bags = [(d, bag(t)) for d, t in rows]
    alike = {d: sum(sum((a & b).values()) >= 0.8 * sum((a | b).values()) for e, b in bags if e != d) for d, a in bags}
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_near for r in sh.op2_simhash(spark, str(tmp_path)).collect()}
    assert 90 <= sum(alike.values()) and all(n <= 1 for n in got.values() if n is not None)
    assert sum(min(got[d], n) for d, n in alike.items()) >= 0.97 * sum(alike.values())


def test_awkward_rows(spark):
    rows = awkward_rows()
    out = sh.fingerprint_documents(documents(spark, rows, clashes=True)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    empty = {r.doc_id: r.lanes for r in out if r.doc_id in (1, 2, 3)}
    assert all(x == [0] * sh.LANES for x in empty.values())
    same = [r for r in out if r.doc_id == 6]
    assert same[0].lanes == same[1].lanes


def test_single_document_follows_itself_and_empty_table(spark):
    one = sh.fingerprint_documents(documents(spark, [(7, "abcdef")])).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0
    assert sh.fingerprint_documents(documents(spark, [])).count() == 0


def test_text_form(spark):
    df = spark.createDataFrame([([-1, 0, 1, 255],)], "lanes array<bigint>")
    assert df.select(sh.as_text(F.col("lanes"))).first()[0] == "f" * 16 + "0" * 31 + "1" + "0" * 14 + "ff"
