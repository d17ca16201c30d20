"""BPE encoding as a streaming transducer, decoding as a state machine.

Whether a symbol merges with what follows can depend on symbols further right,
but only through a chain of merges each of which blocks or makes the next one,
and ranks rise along that chain. ``sufficient_lookahead`` follows these chains
through the merge list once and gives the number of symbols behind a token
that can matter. The transducer holds a buffer of a few times that many symbols; tokens
that end before the lookahead are final and leave it. Normalising and splitting
stream as well, so a text without a single space needs no more memory than a short one.

Words that come again and again are remembered with the transducer's answer, in a bounded memory; a word
with closing punctuation, or in capitals, takes the answer of the word alone.

Handled tokenizer files: BPE models without byte fallback; normaliser none, or
a sequence of NFC, ``\\s+`` to one space and lower case; byte-level symbols behind the
word split of ``word_bpe_49k.json``. Any other file is refused.

Defined cases: a null text is empty and has no ids; its decoded text is
empty; repeated rows get equal answers; an empty table gives no rows; an input
column with the name of an output column is replaced.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import bounded_batches, query, table, worker_memory
from .tokenfiles import word_path
from .tokens import CLOSING, MEMORY, WHITE, ChunkMemory, byte_symbols, white_chunks

_IDS = 1 << 24  # more than any vocabulary has
SHORT = 64  # chunks up to this length are remembered
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the split of the tokenizer file


def char_classes(splitter) -> tuple[str, str, str]:
    """Bodies of three character classes: letters, numbers, and what Python's character tables do not know.

    The library's Unicode tables may be newer than Python's, so it is asked about the
    unassigned code points itself: ranges that hold neither letter nor number are not halved.
    """
    kinds: dict[str, list[list[int]]] = {"L": [], "N": [], "Cn": []}

    def add(kind: str, a: int, b: int) -> None:
        if kinds[kind] and kinds[kind][-1][1] == a - 1:
            kinds[kind][-1][1] = b
        else:
            kinds[kind].append([a, b])

    def ask(a: int, b: int) -> None:
        if len(splitter.pre_tokenize_str("!" + "".join(map(chr, range(a, b + 1))))) == 1:
            return  # neither letters nor numbers
        if a < b:
            ask(a, (a + b) // 2)
            ask((a + b) // 2 + 1, b)
        else:
            add("L" if len(splitter.pre_tokenize_str("a" + chr(a))) == 1 else "N", a, a)
    start = None
    for c in range(0x110001):
        kind = unicodedata.category(chr(c)) if c < 0x110000 else "end"
        if kind == "Cn" and start is None:
            start = c
        elif kind != "Cn" and start is not None:
            add("Cn", start, c - 1)
            ask(start, c - 1)
            start = None
        if kind[0] in "LN":
            add(kind[0], c, c)
    return tuple("".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in kinds[k]) for k in ("L", "N", "Cn"))


def sufficient_lookahead(merges: list[tuple[str, str]], length) -> int:
    """Symbols behind a token that can decide whether it stays as it is.

    ``behind[t]``: how far right of t the merges looked at so far reach when t is their left part;
    ``inside[t]``: how far right of t the merges reach that compete with t's own last merge.
    A merge can only be blocked by an earlier one, so one pass in the order of ranks follows every chain.
    """
    behind: dict[str, int] = {}
    inside: dict[str, int] = {}
    most = 0
    for a, b in merges:
        reach_b = max(behind.get(b, 0), inside.get(b, 0))
        whole = a + b
        inside[whole] = max(inside.get(whole, 0), reach_b)
        behind[a] = max(behind.get(a, 0), length(b) + reach_b)
        most = max(most, behind[a], inside[whole])
    return most


class Rules:
    """Merges as ids, the lookahead, and the decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if (model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges")
                or steps != ["NFC", "Replace", "Lowercase"]
                or [s.get("type") for s in split] != ["Split", "ByteLevel"]
                or split[0]["pattern"] != {"Regex": WORDS} or split[1]["use_regex"] or split[1]["add_prefix_space"]):
            raise ValueError(f"{path}: not a tokenizer file that the transducer handles")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # rank and merged id of a pair as one number, so that the least number is the least rank
        self.ranked = {(self.vocab[a], self.vocab[b]): i * _IDS + self.vocab[a + b] for i, (a, b) in enumerate(pairs)}
        self.none = len(pairs) * _IDS
        self.lookahead = sufficient_lookahead(pairs, self.symbols_of)
        self.longest = max(map(self.symbols_of, self.vocab))
        symbols = byte_symbols()
        self.inner = [self.vocab[s] for s in symbols]
        self.final = [self.vocab[s + self.suffix] for s in symbols]
        self.size = {i: self.symbols_of(t) for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.bytes_mode = (spec["decoder"] or {}).get("type") == "ByteLevel"
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        tool = Tokenizer.from_file(path)
        letter, number, new = char_classes(tool.pre_tokenizer)
        other = f"[^{WHITE}{letter}{number}]"
        self.normaliser, self.new = tool.normalizer, re.compile(f"[{new}]")
        self.split = re.compile(rf"(?P<short>'s|'t|'re|'ve|'m|'ll|'d)|(?P<letters>[{letter}])|(?P<number>[{number}])"
                                rf"|(?P<other>{other})")
        self.runs = {"letters": re.compile(f"[{letter}]*"), "other": re.compile(f"{other}*")}

    def normalised(self, text: str) -> str:
        """NFC in lower case; white space may stay as it is, for the split drops it."""
        if self.new.search(text):
            return self.normaliser.normalize_str(text)
        return lowered(unicodedata.normalize("NFC", text))

    def symbols_of(self, token: str) -> int:
        return len(token) - len(self.suffix) if self.suffix and token.endswith(self.suffix) else len(token)

    def merged(self, ids: list[int]) -> list[int]:
        """All merges of a run of symbols, the lowest rank first, left to right."""
        get, none = self.ranked.get, self.none
        ranks = list(map(get, zip(ids, ids[1:]), repeat(none)))
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at, new = ranks.index(best), best % _IDS
            while at >= 0:
                ids[at:at + 2] = [new]
                del ranks[at]
                if at:
                    ranks[at - 1] = get((ids[at - 1], new), none)
                if at < len(ranks):
                    ranks[at] = get((new, ids[at + 1]), none)
                at = next((i for i in range(at, len(ranks)) if ranks[i] == best), -1) if best in ranks else -1
        return ids

    def word(self, raw: bytes) -> list[int]:
        """What the transducer gives for a word that its buffer holds whole."""
        inner = self.inner
        ids = [inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        return self.merged(ids) if len(ids) > 1 else ids


class WordTransducer:
    """Symbols of one word in, final token ids out."""

    def __init__(self, rules: Rules):
        self.rules, self.buffer = rules, []
        self.limit = 2 * rules.lookahead + 2 * rules.longest + 1

    def feed(self, raw: bytes) -> Iterator[int]:
        """The last byte is held back: only ``finish`` knows that it ends the word."""
        inner = self.rules.inner
        for b in raw:
            self.buffer.append(b)
            if len(self.buffer) > self.limit:
                room = len(self.buffer) - self.rules.lookahead - 1
                done = 0
                for t in self.rules.merged([inner[x] for x in self.buffer[:-1]]):
                    if done + self.rules.size[t] > room:
                        break
                    done += self.rules.size[t]
                    yield t
                del self.buffer[:done]

    def finish(self) -> list[int]:
        if not self.buffer:
            return []
        inner, last = self.rules.inner, self.buffer[-1]
        ids = self.rules.merged([*[inner[x] for x in self.buffer[:-1]], self.rules.final[last]])
        self.buffer = []
        return ids


class StreamEncoder:
    """Text in pieces of any size in, token ids out as soon as they are final; constant memory."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.raw = ""  # not yet searched for special tokens
        self.held = ""  # not yet normalised: the next character might combine with it
        self.text = ""  # normalised, not yet split into words
        self.word: WordTransducer | None = None
        self.run = None  # pattern of the run of characters that the open word goes on with
        self.special = re.compile("|".join(map(re.escape, rules.special)) or r"(?!)")
        self.margin = max(map(len, rules.special), default=1) - 1

    def feed(self, piece: str) -> Iterator[int]:
        self.raw += piece
        yield from self._raw(False)

    def finish(self) -> Iterator[int]:
        yield from self._raw(True)
        yield from self._normalise("", True)

    def _raw(self, last: bool) -> Iterator[int]:
        while True:
            found = self.special.search(self.raw)
            if found:
                yield from self._normalise(self.raw[:found.start()], True)
                self.raw = self.raw[found.end():]
                yield self.rules.special[found.group()]
                continue
            cut = len(self.raw) if last else max(0, len(self.raw) - self.margin)
            yield from self._normalise(self.raw[:cut], False)
            self.raw = self.raw[cut:]
            return

    def _normalise(self, more: str, last: bool) -> Iterator[int]:
        self.held += more
        cut = len(self.held)
        if not last:
            cut = max(0, cut - 1)
            while cut and joins(self.held[cut]):
                cut -= 1
        done, self.held = self.held[:cut], self.held[cut:]
        self.text += self.rules.normalised(done)
        yield from self._split(last)

    def _split(self, last: bool) -> Iterator[int]:
        at, text = 0, self.text
        while True:
            if self.word is not None:
                end = self.run.match(text, at).end()
                yield from self.word.feed(text[at:end].encode())
                at = end
                if at == len(text) and not last:
                    break
                yield from self.word.finish()
                self.word = None
            if at == len(text) or (len(text) - at < 3 and not last):
                break  # a contraction is at most three characters
            found = self.rules.split.match(text, at)
            if not found:
                at += 1  # white space
                continue
            kind = found.lastgroup
            self.word = WordTransducer(self.rules)
            if kind in self.rules.runs:
                self.run = self.rules.runs[kind]
            else:  # complete as it stands
                yield from self.word.feed(found.group().encode())
                yield from self.word.finish()
                self.word, at = None, found.end()
        self.text = text[at:]


def joins(c: str) -> bool:
    """Whether a character may combine with the one before it in NFC."""
    return unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn") or "\u1160" <= c <= "\u11ff"


def lowered(text: str) -> str:
    """Each character on its own: no final-sigma rule."""
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


def encode(rules: Rules, text: str) -> list[int]:
    stream = StreamEncoder(rules)
    return [*stream.feed(text), *stream.finish()]


def encode_chunk(rules: Rules, chunk: str) -> list[int]:
    """``encode`` of a chunk without white space that every buffer of the stream holds whole."""
    if len(chunk) > SHORT or any(s in chunk for s in rules.special):
        return encode(rules, chunk)
    text, out, at = chunk.lower() if chunk.isascii() else rules.normalised(chunk), [], 0
    while at < len(text):
        found = rules.split.match(text, at)
        if not found:
            at += 1
            continue
        run = rules.runs.get(found.lastgroup)
        end = run.match(text, at).end() if run else found.end()
        out += rules.word(text[at:end].encode())
        at = end
    return out


class StreamDecoder:
    """Token ids in, text out: bytes of unfinished characters wait in the UTF-8 state.

    Files without a decoder give their tokens, one space between them.
    """

    def __init__(self, rules: Rules):
        self.rules, self.begun = rules, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> Iterator[str]:
        for i in ids:
            token = self.rules.token[i]
            if not self.rules.bytes_mode:
                yield f" {token}" if self.begun else token
                self.begun = True
            elif all(c in self.rules.byte_of for c in token):
                yield self.utf8.decode(bytes(self.rules.byte_of[c] for c in token))
            else:
                yield self.utf8.decode(b"", False) + token

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


def decode(rules: Rules, ids: Iterable[int]) -> str:
    if not rules.bytes_mode:
        return " ".join([rules.token[i] for i in ids])
    stream = StreamDecoder(rules)
    return "".join(stream.feed(ids)) + stream.finish()


_RULES: dict[str, Rules] = worker_memory("bpe rules")


def rules_of(path: str) -> Rules:
    """The worker's rules of a tokenizer file."""
    if path not in _RULES:
        _RULES[path] = Rules(path)
    return _RULES[path]


class Codec:
    """Ids and decoded text of whole texts; short chunks between white space are remembered.

    A chunk stands alone because the splitter drops white space, and, where
    tokens are decoded with one space between them, so does its decoded text.
    """

    def __init__(self, rules: Rules):
        if rules.bytes_mode:
            raise ValueError("decoded chunks of a byte-level decoder do not stand alone")
        self.rules, self.memory = rules, ChunkMemory(self._make)
        self.words = ChunkMemory(self._words, MEMORY // 2)
        self.tails: dict[str, tuple[str, str]] = {}
        self.cuts = not any(s.rstrip(CLOSING).isalpha() for s in rules.special)

    def _said(self, ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), decode(self.rules, ids)

    def _words(self, words: list[str]) -> list[tuple[str, str]]:
        return [self._said(self.rules.word(w.encode())) for w in words]

    def _cut(self, chunk: str) -> tuple[str | None, str]:
        """(normalised letters, closing punctuation), which the splitter parts as well; None for any other chunk."""
        core = chunk.rstrip(CLOSING)
        if not core.isalpha() or len(chunk) > SHORT or not self.cuts:
            return None, ""
        word = core.lower() if core.isascii() else self.rules.normalised(core)
        return (word, chunk[len(core):]) if word.isalpha() else (None, "")

    def _tail(self, tail: str) -> tuple[str, str]:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {}
            number, said = self._said(encode_chunk(self.rules, tail))
            self.tails[tail] = f" {number}", f" {said}"
        return self.tails[tail]

    def _make(self, chunks: list[str]) -> list[tuple[str, str]]:
        cut = [self._cut(c) for c in chunks]
        known = self.words.prepare({w for w, _ in cut if w is not None})
        out = []
        for c, (word, tail) in zip(chunks, cut):
            if word is None:
                out.append(self._said(encode_chunk(self.rules, c)))
            elif tail:
                (number, said), (more, closing) = known[word], self._tail(tail)
                out.append((number + more, said + closing))
            else:
                out.append(known[word])
        return out

    def run(self, texts: list[str]) -> Iterator[list[tuple[str, str]]]:
        """(decimal ids, decoded text) of each chunk that has ids, of each text."""
        cut = [white_chunks(t) for t in texts]
        every = set().union(*cut)
        long = {c for c in every if len(c) > SHORT}
        known = self.memory.prepare(every - long)
        for cs in cut:
            found = (map(known.__getitem__, cs) if long.isdisjoint(cs)
                     else [self._make([c])[0] if c in long else known[c] for c in cs])
            yield [x for x in found if x[0]]


_CODECS: dict[str, Codec] = worker_memory("bpe codecs")


def codec(path: str) -> Codec:
    """The worker's codec of a tokenizer file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(rules_of(path))
    return _CODECS[path]


def _scan(docs: DataFrame, path: str, text: str, outputs: list[T.StructField], row) -> DataFrame:
    """``docs`` and what ``row`` makes of the chunks of each text."""
    bounded_batches(docs.sparkSession)
    names = [f.name for f in outputs]
    own = [c for c in docs.columns if c not in names]
    chosen = docs.select(*[docs[f"`{c}`"] for c in own])
    place = own.index(text)
    kinds = [pa.list_(pa.int32()) if isinstance(f.dataType, T.ArrayType)
             else pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in outputs]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                rows = [row(cs) for cs in tool.run([t or "" for t in b.column(place).to_pylist()])]
                yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                                                 names=[*own, *names])
    return chosen.mapInArrow(scan, T.StructType([*chosen.schema.fields, *outputs]))


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (array<int>) and decoded (their text as the tokenizer file decodes them)."""
    return _scan(docs, path, text, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                    T.StructField("decoded", T.StringType())],
                 lambda cs: ([int(i) for ids, _ in cs for i in ids.split(" ")], " ".join([d for _, d in cs])))


def _digests(cs: list[tuple[str, str]]) -> tuple[int, str, str]:
    ids = " ".join([i for i, _ in cs])
    return (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(" ".join([d for _, d in cs]).encode()).hexdigest())


@query("op6_bpe_round_trip")
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digests of the ids of every document, and of the text they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = _scan(docs, word_path(), "text", [T.StructField("n_tokens", T.LongType()),
                                            T.StructField("ids_sha256", T.StringType()),
                                            T.StructField("decoded_sha256", T.StringType())], _digests)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
