"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for each piece of a fixed public vocabulary.
A word may be cut into pieces in many ways; the forward algorithm adds up the
probabilities of all of them, so no single segmentation is chosen. A text's
score for a language is the sum of the logarithms over its words. The probabilities are
fitted with expectation maximisation: the forward and backward sums say how often
each piece is expected in the training words.

The fit reads a bounded sample: about ``SAMPLE`` documents of each language, drawn by a
hash of the id; everything else covers every row and whole texts. Words
are runs of letters of a white-space separated chunk, in lower case; runs over
``LONGEST`` letters are scored in consecutive parts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text if no row is labelled; ties go to the alphabetically first language; a null id counts as
the empty text in its remainder; repeated rows get equal answers; an empty table
gives no rows; an input column with the name of an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import materialise
from .common import begin, bounded_batches, query, table, worker_memory

SAMPLE = 3000
ROUNDS = 3
LONGEST = 32
CACHE = 300_000  # words a worker remembers; then it starts anew
UNKNOWN = 1e-9  # probability of a character that no piece covers
SMOOTHING = 0.1  # added to each expected count
UNDECIDED = "und"
OUTPUTS = ("lang_pred", "score")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """The pieces as sorted hashes by length, for looking up all substrings of many words at once."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = sorted({model.id_to_piece(i).lower() for i in range(model.get_piece_size())
                         if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))})
        self.size = len(pieces)
        by_length: dict[int, list[tuple[int, int]]] = {}
        for i, p in enumerate(pieces):
            h = 0
            for c in p:
                h = ((h + ord(c) + 1) * int(_MULTIPLIER)) & (2**64 - 1)
            by_length.setdefault(len(p), []).append((h, i))
        self.tables = {}
        for n, found in by_length.items():
            if n <= LONGEST + 1:
                found.sort()
                self.tables[n] = (np.array([h for h, _ in found], np.uint64), np.array([i for _, i in found]))

    def edges(self, codes: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each start column, (length, rows, pieces) of the substrings that are pieces; codes is 0 behind a word."""
        n = codes.shape[1]
        out = []
        for i in range(n):
            found, h = [], np.zeros(len(codes), np.uint64)
            rows = np.flatnonzero(codes[:, i])
            for m in range(1, n - i + 1):
                rows = rows[codes[rows, i + m - 1] != 0]
                if not len(rows):
                    break
                h[rows] = (h[rows] + codes[rows, i + m - 1] + np.uint64(1)) * _MULTIPLIER
                if m in self.tables:
                    keys, ids = self.tables[m]
                    spot = np.minimum(np.searchsorted(keys, h[rows]), len(keys) - 1)
                    ok = keys[spot] == h[rows]
                    if ok.any():
                        found.append((m, rows[ok], ids[spot[ok]]))
                if m >= max(self.tables):
                    break
            out.append(found)
        return out


_LOADED: dict[str, Vocabulary] = worker_memory("language")


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def spell(words: list[str]) -> np.ndarray:
    """Code points with the word mark in front; 0 behind the end."""
    width = max(map(len, words)) + 1
    flat = np.frombuffer("".join(("▁" + w).ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), width).astype(np.uint64)


def forward(edges, shape: tuple[int, int], probs: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(positions + 1, words, languages): summed probability of all segmentations of each prefix."""
    rows, n = shape
    alpha = np.zeros((n + 1, rows, probs.shape[1]))
    alpha[0] = 1.0
    for i in range(n):
        live = codes[:, i] != 0
        alpha[i + 1][live] += alpha[i][live] * UNKNOWN
        for m, at, piece in edges[i]:
            alpha[i + m][at] += alpha[i][at] * probs[piece]
    return alpha


def word_scores(words: list[str], voc: Vocabulary, probs: np.ndarray) -> np.ndarray:
    """(words, languages) logarithms of the summed probabilities."""
    out = np.zeros((len(words), probs.shape[1]))
    order = np.argsort([len(w) for w in words], kind="stable")
    for part in np.array_split(order, max(1, len(order) // 2000)):
        if not len(part):
            continue
        codes = spell([words[i] for i in part])
        alpha = forward(voc.edges(codes), codes.shape, probs, codes)
        ends = (codes != 0).sum(axis=1)
        out[part] = np.log(alpha[ends, np.arange(len(part))])
    return out


def letters(chunk: str) -> list[str]:
    """The letters of a chunk, in parts that the forward sums can hold."""
    word = chunk if chunk.isalpha() else "".join(filter(str.isalpha, chunk))
    return [word[i:i + LONGEST] for i in range(0, len(word), LONGEST)]


def expected_counts(words: list[str], counts: np.ndarray, voc: Vocabulary, probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the given words of one language."""
    total = np.zeros(voc.size)
    order = np.argsort([len(w) for w in words], kind="stable")
    for part in np.array_split(order, max(1, len(order) // 2000)):
        codes = spell([words[i] for i in part])
        n = codes.shape[1]
        edges = voc.edges(codes)
        alpha = forward(edges, codes.shape, probs[:, None], codes)[:, :, 0]
        ends = (codes != 0).sum(axis=1)
        beta = np.zeros((n + 1, len(part)))
        beta[ends, np.arange(len(part))] = 1.0
        for i in range(n - 1, -1, -1):
            live = codes[:, i] != 0
            beta[i][live] += beta[i + 1][live] * UNKNOWN
            for m, at, piece in edges[i]:
                beta[i][at] += probs[piece] * beta[i + m][at]
        weight = counts[part] / np.maximum(beta[0], 1e-300)
        for i in range(n):
            for m, at, piece in edges[i]:
                np.add.at(total, piece, alpha[i][at] * probs[piece] * beta[i + m][at] * weight[at])
    return total


def fit(docs: DataFrame, path: str, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
        sample: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities by language) from about ``sample`` labelled documents of each language."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r["g"]: r["n"] for r in labelled.groupBy(F.col(lang).alias("g")).agg(F.count(F.lit(1)).alias("n"))
             .collect()}  # one row a language
    names = sorted(sizes)
    voc = vocabulary(path)
    if not names:
        return [], np.zeros((voc.size, 0))
    share = F.create_map(*[F.lit(x) for g in names for x in (g, min(1.0, sample / sizes[g]))])
    drawn = labelled.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("langid")), F.lit(1 << 30))
                           < F.element_at(share, F.col(lang)) * F.lit(float(1 << 30)))
    words = materialise(drawn.select(F.col(lang).alias("g"), F.explode(F.split(F.lower(text), r"\s+")).alias("w"))
                        .groupBy("g", "w").agg(F.count(F.lit(1)).alias("n")))
    kind = T.StructType([T.StructField("g", T.StringType()), T.StructField("piece", T.IntegerType()),
                         T.StructField("n", T.DoubleType())])
    probs = np.full((voc.size, len(names)), 1.0 / voc.size)
    for _ in range(rounds):
        now = docs.sparkSession.sparkContext.broadcast(probs)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            begin("language")
            own = vocabulary(path)
            sums = np.zeros((own.size, len(names)))
            for b in batches:
                by: dict[str, dict[str, int]] = {}
                for g, w, n in zip(*(c.to_pylist() for c in b.columns)):
                    for part in letters(w):
                        here = by.setdefault(g, {})
                        here[part] = here.get(part, 0) + n
                for g, found in by.items():
                    j = names.index(g)
                    sums[:, j] += expected_counts(list(found), np.array(list(found.values()), float), own,
                                                  now.value[:, j])
            for j, g in enumerate(names):
                at = np.flatnonzero(sums[:, j] > 1e-6)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array(at, pa.int32()),
                                                      pa.array(sums[at, j])], names=kind.names)
        found = np.full((voc.size, len(names)), SMOOTHING)
        for r in words.mapInArrow(expect, kind).groupBy("g", "piece").agg(F.sum("n").alias("n")).collect():
            found[r["piece"], names.index(r["g"])] += round(r["n"], 6)  # pieces x languages at most
        probs = found / found.sum(axis=0)
    return names, probs


def predict(docs: DataFrame, path: str, names: list[str], probs: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the share of the best language in the summed likelihood."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(probs)
    own = [c for c in docs.columns if c not in OUTPUTS]
    place = own.index(text)
    out = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in own]).schema.fields,
                        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language")
        voc, p = vocabulary(path), shared.value
        row: dict[str, int] = {}
        table_ = np.zeros((1024, len(names)))

        def learn(missing: list[str]) -> None:
            nonlocal table_
            if len(row) + len(missing) > CACHE:
                row.clear()
            parts = [letters(w) for w in missing]
            flat = [x for ps in parts for x in ps]
            scores = word_scores(flat, voc, p) if flat else np.zeros((0, len(names)))
            edge = np.r_[0, np.cumsum([len(ps) for ps in parts])]
            total = np.r_[np.zeros((1, len(names))), np.cumsum(scores, axis=0)]
            base = len(row)
            if base + len(missing) > len(table_):
                table_ = np.concatenate([table_[:base], np.zeros((2 * len(missing) + base, len(names)))])
            table_[base:base + len(missing)] = total[edge[1:]] - total[edge[:-1]]
            row.update(zip(missing, range(base, base + len(missing))))

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                split = [(t or "").lower().split() for t in b.column(place).to_pylist()]
                best, score = [], []
                missing = {w for ws in split for w in ws if w not in row}
                if missing:
                    if len(row) + len(missing) > CACHE:
                        row.clear()
                        missing = {w for ws in split for w in ws}
                    learn(sorted(missing))
                for ws in split:
                    if not names or not any(map(str.isalpha, "".join(ws))):
                        best.append(UNDECIDED)
                        score.append(0.0)
                        continue
                    sums = table_[[row[w] for w in ws]].sum(axis=0)
                    share = np.exp(sums - sums.max())
                    best.append(names[int(sums.argmax())])
                    score.append(float(share.max() / share.sum()))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best, pa.string()), pa.array(score)],
                                                 names=[*own, *OUTPUTS])
    return docs.select(*[F.col(f"`{c}`") for c in own]).mapInArrow(scan, out)


def held_out(id_col: str = "doc_id") -> "F.Column":
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    names, probs = fit(docs.where(~held_out()), piece_path())
    out = predict(docs.select("doc_id", "text"), piece_path(), names, probs)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
