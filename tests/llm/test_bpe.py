import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from raregrain.llm import bpe
from raregrain.llm.packing import byte_path
from raregrain.llm.tokenfiles import word_path

from .fixtures import awkward_rows, documents, prose

RULES = bpe.rules_of(word_path())
TOOL = Tokenizer.from_file(word_path())


def ids_of(text):
    return TOOL.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text_equals_the_library(text):
    assert bpe.encode(RULES, text) == ids_of(text)
    assert [i for c in bpe.white_chunks(text) for i in bpe.encode_chunk(RULES, c)] == ids_of(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'stre é́Σ12<|endoftext>!\nᅡ", max_size=60),
       st.lists(st.integers(1, 7), min_size=1, max_size=20))
def test_pieces_of_any_size_give_the_same_ids(text, steps):
    stream, out, at = bpe.StreamEncoder(RULES), [], 0
    while at < len(text):
        n = steps[at % len(steps)]
        out += stream.feed(text[at:at + n])
        at += n
    assert out + list(stream.finish()) == ids_of(text)


@pytest.mark.parametrize("seed", range(4))
def test_long_words_need_constant_memory(seed):
    rng = random.Random(seed)
    word = "".join(rng.choice(["etaoinshrdlu", "ab", "the", "a"][seed]) for _ in range(20_000))
    stream, out, most = bpe.StreamEncoder(RULES), [], 0
    for at in range(0, len(word), 500):
        out += stream.feed(word[at:at + 500])
        most = max(most, len(stream.raw) + len(stream.held) + len(stream.text) + len(stream.word.buffer))
    assert out + list(stream.finish()) == ids_of(word)
    assert most < 2 * (RULES.lookahead + RULES.longest) + 100


def test_lookahead_follows_chains_of_rising_rank():
    size = len
    assert bpe.sufficient_lookahead([("a", "b")], size) == 1
    assert bpe.sufficient_lookahead([("b", "c"), ("a", "b")], size) == 2  # c decides whether a meets b
    assert bpe.sufficient_lookahead([("a", "b"), ("b", "c")], size) == 1  # ranks fall: c comes too late for a
    assert bpe.sufficient_lookahead([("c", "d"), ("b", "c"), ("a", "b")], size) == 3


def test_decoder_equals_the_library():
    for text in ["Hello, wörld!", "", "日本 é <|endoftext|>x", "a b"]:
        ids = ids_of(text)
        stream = bpe.StreamDecoder(RULES)
        assert "".join(stream.feed(ids)) + stream.finish() == bpe.decode(RULES, ids)
        assert bpe.decode(RULES, ids) == TOOL.decode(ids, skip_special_tokens=False)


def test_byte_decoder_waits_for_whole_characters():
    tool = Tokenizer.from_file(byte_path())
    rules = object.__new__(bpe.Rules)
    rules.token = {i: t for t, i in tool.get_vocab().items()}
    rules.bytes_mode, rules.byte_of = True, {s: b for b, s in enumerate(bpe.byte_symbols())}
    for text in ["日本語 é", "plain", "🙂🙃"]:
        stream = bpe.StreamDecoder(rules)
        parts = list(stream.feed(tool.encode(text).ids))
        assert "".join(parts) + stream.finish() == text and "�" not in "".join(parts)


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Rules(byte_path())


def test_documents(spark):
    rng = random.Random(1)
    rows = awkward_rows() + [(100 + i, prose(rng, 50)) for i in range(20)] + [(200, "z" * 3000 + " " + "é" * 300)]
    df = documents(spark, rows, clashes=True)
    out = bpe.encode_documents(df, word_path()).collect()
    want = sorted((str(i), ids_of(t), TOOL.decode(ids_of(t), skip_special_tokens=False)) for i, t in rows)
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in out) == want
    assert all(r.kept == "x" for r in out)
    assert bpe.encode_documents(documents(spark, []), word_path()).count() == 0


def test_a_word_is_encoded_once_whatever_closes_it(monkeypatch):
    tool = bpe.Codec(RULES)
    seen, word = [], type(tool.rules).word
    monkeypatch.setattr(type(tool.rules), "word", lambda self, raw: seen.append(raw) or word(self, raw))
    texts = ["Zwörtchen zwörtchen, ZWÖRTCHEN!!! zwörtchen.***", "İx, ΣΑΣ. ǅa) it's, a1. x" + "y" * 80 + ".",
             "zwo\u0308rtchen; x=\u0338. a\u0301. ﬁn! <unk>. [x]. 한글, \u1112\u1161\u11ab. !!! % ."]
    got = list(tool.run(texts))
    assert seen.count("zwörtchen".encode()) == 2  # once more in the text that is not composed
    for text, cs in zip(texts, got):
        ids = [int(i) for numbers, _ in cs for i in numbers.split(" ")]
        assert ids == ids_of(text)
        assert " ".join([d for _, d in cs]) == TOOL.decode(ids, skip_special_tokens=False)
