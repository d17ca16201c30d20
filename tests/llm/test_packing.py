import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from raregrain.functions.scratch import materialise
from raregrain.llm import packing as pk
from raregrain.llm.tokenfiles import word_path
from raregrain.llm.tokens import ChunkEncoder, chunk_kind

from .fixtures import awkward_rows, documents, prose


def uses(plan, capacity):
    out = np.zeros(capacity + 1, int)
    for combo, times in plan:
        assert times > 0 and sum(combo) <= capacity
        for n in combo:
            out[n] += times
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_no_worse_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    counts = np.r_[0, rng.integers(0, [1, 3, 20, 50][seed % 4] + 1, 64)] * (rng.random(65) < [1, .3][seed % 2])
    plan = pk.plan(counts.astype(int), 64)
    assert (uses(plan, 64) == counts).all()
    bins = []  # best fit, item by item, longest first
    for n in np.repeat(np.arange(65), counts.astype(int))[::-1].tolist():
        at = max((i for i, b in enumerate(bins) if b + n <= 64), key=lambda i: bins[i], default=None)
        if at is None:
            bins.append(n)
        else:
            bins[at] += n
    least = -(-int((counts * np.arange(65)).sum()) // 64)
    assert least <= sum(n for _, n in plan) <= len(bins)


def test_exact_complements_fill_every_gap():
    counts = np.zeros(101, int)
    counts[[60, 40, 70, 20, 10, 50]] = [5, 5, 3, 3, 3, 4]
    assert all(sum(c) == 100 for c, _ in pk.plan_with(counts, 100, 3))


def test_optimal_on_small_inputs_by_search():
    rng = random.Random(4)

    def best(items, cap):
        def fits(k):
            bins = [0] * k

            def go(i):
                if i == len(items):
                    return True
                for b in range(k):
                    if bins[b] + items[i] <= cap and bins[b] not in bins[:b]:
                        bins[b] += items[i]
                        if go(i + 1):
                            return True
                        bins[b] -= items[i]
                return False
            return go(0)
        return next(k for k in range(len(items) + 1) if fits(k))
    off = 0
    for _ in range(40):
        items = sorted((rng.randrange(1, 21) for _ in range(9)), reverse=True)
        plan = pk.plan(np.bincount(items, minlength=21), 20)
        off += sum(n for _, n in plan) - best(items, 20)
    assert off <= 2


def test_cut():
    assert pk.cut(5, 4) == [(0, 1), (1, 4)] and pk.cut(8, 4) == [(0, 4), (4, 4)] and pk.cut(3, 4) == [(0, 3)]


def check(out, rows, path, capacity):
    tool = Tokenizer.from_file(path)
    want = sorted((str(i), *[tuple(tool.encode(t or "", add_special_tokens=False).ids + [pk.END])]) for i, t in rows)
    lengths = {}
    for r in out:
        lengths.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in lengths.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    by = {}
    for i, ids in want:
        for k, (s, n) in enumerate(pk.cut(len(ids), capacity)):
            row = (i, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))
            by[row] = by.get(row, 0) + 1
    got = {}
    for r in out:
        row = (str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
        got[row] = got.get(row, 0) + 1
    assert got == by
    return len(lengths), -(-sum(r.length for r in out) // capacity)


@pytest.mark.parametrize("parts", [1, 5])
def test_documents_are_whole_and_sequences_gapless(spark, parts):
    rng = random.Random(parts)
    rows = [(i, prose(rng, rng.randrange(0, 120))) for i in range(200)] + awkward_rows()
    df = materialise(documents(spark, rows, clashes=True).repartition(parts))
    used, least = check(pk.pack_documents(df, pk.byte_path(), capacity=128).collect(), rows, pk.byte_path(), 128)
    assert used <= least + 2


def test_empty_table(spark):
    assert pk.pack_documents(documents(spark, []), pk.byte_path()).count() == 0


ODD = ["", " ", "  a  b ", "a <|endoftext|> b<|endoftext|>c", "a\n b", "x \ny\t z", "it's don't 's", " lead", "trail ",
       "a\x1cb \x1c c", "　a b", "é ́x", "İΣΣ", "日本語 テスト", "a\n\n\nb", "don't'll",
       "a  b", "\x1c\x1f", "½ ² ١٢٣", "a b", "a   b"]


@pytest.mark.parametrize("path,kind", [(pk.byte_path(), "space"), (word_path(), "white")])
def test_remembered_chunks_equal_whole_texts(path, kind):
    rng = random.Random(1)
    texts = ODD + ["Wörter. Über, İstanbul! ΣΑΣ. ΑΣ é. é. ñandú?! Ña;: ª º. ǅ ﬁn. 日本. ʰa. a.b a.. .a ...", "𘶀. Ᲊa"]
    texts += ["".join(rng.choice("ab 'st\n\t  é<|>\x1c .1") for _ in range(rng.randint(0, 30))) for _ in range(800)]
    tool, whole = ChunkEncoder(path), Tokenizer.from_file(path)
    assert tool.kind == kind
    tool.plain.limit = tool.spaced.limit = 50  # generations change all the time
    for at in range(0, len(texts), 20):
        part = texts[at:at + 20]
        want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(part, add_special_tokens=False)]
        assert tool.encode(part) == want


def test_unknown_tokenizers_are_not_cut():
    assert chunk_kind({"pre_tokenizer": {"type": "Metaspace"}, "normalizer": None}) == "whole"
