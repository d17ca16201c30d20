"""Token ids by the tokenizers library, with a bounded memory of the chunks a worker has met.

Some tokenizers work on independent chunks of a text, so a chunk's ids can be
remembered. Which chunks are independent is read from the tokenizer's file:

* white: the normaliser makes white space a single space and the splitter drops
  it; every white-space separated chunk stands alone;
* space: byte-level splitting without a normaliser; a space between two
  characters that are not white space always starts a piece.

With any other tokenizer a whole text is one chunk and nothing is remembered.

Most new chunks are a word of letters with closing punctuation. Such a word is one piece of its own for
both splitters, so it goes straight to the library's merge model, without the
normaliser and splitter in front of it.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

from .common import worker_memory

MEMORY = 400_000  # chunks of one generation; a worker remembers two
# White_Space of Unicode: what the tokenizers library takes as \s. (Python's also has 0x1c-0x1f.)
WHITE = "\t-\r \x85\xa0  -     　"
CLOSING = ".,;:!?*#&%$)\""  # one piece behind a word for both splitters; no apostrophe, no part of a special token
_WHITE = re.compile(f"[{WHITE}]+")
_BORDER = re.compile(r"(?<=\S)(?= \S)")
_ENCODERS: dict[tuple[str, str], "ChunkEncoder"] = worker_memory("tokens")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the rest from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(kept) else chr(next(spare)) for b in range(256)]


def chunk_kind(spec: dict) -> str:
    """white, space or whole, from the tokenizer's file."""
    splitter, normaliser = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"])
           for t in spec.get("added_tokens", [])):
        return "whole"
    if normaliser is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get(
            "add_prefix_space"):
        return "space"
    steps = (normaliser or {}).get("normalizers", [])
    replaced = any(s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps)
    known = all(s["type"] in ("NFC", "Replace", "Lowercase") for s in steps)
    parts = splitter.get("pretokenizers", [])
    dropped = bool(parts) and parts[0]["type"] == "Split" and parts[0]["behavior"] == "Removed" and parts[0][
        "invert"] and parts[0]["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    return "white" if replaced and known and dropped else "whole"


def white_chunks(text: str) -> list[str]:
    """The chunks between white space."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [c for c in _WHITE.split(text) if c]
    return text.split()


class ChunkMemory:
    """chunk -> value, in two generations: when the young one is full it becomes the old one."""

    def __init__(self, make, limit: int = MEMORY):
        self.make, self.limit, self.young, self.old = make, limit, {}, {}

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def prepare(self, chunks: set[str]) -> dict:
        """A dictionary that has all the chunks; ``make`` is called with those not remembered."""
        young = self.young
        missing = chunks.difference(young)
        if len(young) + len(missing) > self.limit:
            self.old, self.young = young, {}
            young, missing = self.young, chunks
        if missing:
            old, new = self.old, []
            for c in missing:
                if c in old:
                    young[c] = old[c]
                else:
                    new.append(c)
            young.update(zip(new, self.make(new)))
        return young


class ChunkEncoder:
    """texts -> token ids as little-endian unsigned 32-bit bytes (16-bit with ``code`` H), no special tokens added."""

    def __init__(self, path: str, code: str = "I"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            self.kind = chunk_kind(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.symbols = dict(enumerate(byte_symbols()))
        self.code, self.tails = code, {"": b""}
        self.plain = ChunkMemory(self._chunks)
        self.spaced = ChunkMemory(self._after_space)

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _word(self, chunk: str, before: str) -> bytes | None:
        """Ids of letters with closing punctuation; None for any other chunk. ``before`` is "" or a space."""
        core = chunk.rstrip(CLOSING)
        if not core.isalpha():
            return None
        tail = chunk[len(core):]
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {"": b""}
            self.tails[tail] = self.ids([tail])[0]
        if tail:
            memory = self.spaced if before else self.plain
            known = memory.young.get(core) or memory.old.get(core)
            if known:
                return known + self.tails[tail]
        if self.kind == "white":
            low = core.lower()
            if not core.isascii() and ("Σ" in core or not low.isalpha() or not unicodedata.is_normalized("NFC", core)):
                return None
            core = low
        if before or not core.isascii():
            core = (before + core).encode().decode("latin-1").translate(self.symbols)
        return array(self.code, [t.id for t in self.model.tokenize(core)]).tobytes() + self.tails[tail]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if self.kind == "whole":
            return self.ids(chunks)
        out = [self._word(c, "") for c in chunks]
        rest = iter(self.ids([c for c, x in zip(chunks, out) if x is None]))
        return [next(rest) if x is None else x for x in out]

    def _after_space(self, words: list[str]) -> list[bytes | None]:
        """None for a word that does not stand alone behind a space."""
        out = [self._word(w, " ") for w in words]
        alone = [x is None and w and not (w[0].isspace() or w[-1].isspace()) for w, x in zip(words, out)]
        rest = iter(self.ids([f" {w}" for w, ok in zip(words, alone) if ok]))
        return [next(rest) if ok else x for ok, x in zip(alone, out)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.kind == "white":
            chunks = [white_chunks(t) for t in texts]
            known = self.plain.prepare(set().union(*chunks)).__getitem__
            return [b"".join(map(known, cs)) for cs in chunks]
        if self.kind == "space":
            words = [t.split(" ") for t in texts]
            heads = [w.pop(0) for w in words]
            spaced = self.spaced.prepare(set().union(*words)).__getitem__
            found = [list(map(spaced, ws)) for ws in words]
            odd = [None in f or (h[-1:].isspace() and bool(f)) for h, f in zip(heads, found)]
            cut = [[x for x in _BORDER.split(t) if x] if o else [h] if h else [] for t, h, o in zip(texts, heads, odd)]
            plain = self.plain.prepare(set().union(*cut)).__getitem__
            return [b"".join([*map(plain, cs), *([] if o else f)]) for cs, f, o in zip(cut, found, odd)]
        return self.ids(texts)


def encoder(path: str, memory: int = MEMORY, code: str = "I") -> ChunkEncoder:
    """The worker's encoder of a tokenizer file; it remembers ``memory`` chunks a generation."""
    if (path, code) not in _ENCODERS:
        _ENCODERS[path, code] = ChunkEncoder(path, code)
    tool = _ENCODERS[path, code]
    tool.plain.limit = tool.spaced.limit = memory
    return tool
