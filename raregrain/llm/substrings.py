"""Substring dedup with difference-cover anchors.

A word is removed where a window of 13 words covers it whose word sequence also
starts in a document with a smaller id. Shuffling the hash of each window would
cost more than the text. So the first scan hashes windows of 7 words only at
positions whose remainder modulo 7 lies in the difference cover {0, 1, 3}: any two
positions have a common shift below 7 that takes both into the cover, so
two equal windows of 13 words share an anchor of 7 words inside them. Anchors that
are seen once rule their windows out. The second scan extends around the
repeated anchors: it hashes the full windows that hold one. Their smallest
document goes back to each split, and the third scan removes the words.

Anchors are compared by 32 bits and their hash range (a chance hit costs a
window hashed for nothing); whole windows by 64 bits. Texts are never shuffled, and a
passage that many documents share is one entry for each split in a task.

Defined cases: a null text has no words; a null id counts as larger than any
other; repeated rows (equal ids) never remove words of each other; texts shorter
than a window are kept; an empty table gives no rows; an input column with
the name of an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import begin, bounded_batches, fresh, from_files, partitions, query, split_key, table
from .splits import MESSAGE, by_part, by_split, exchange, load, pack, seen, unpack
from .words import hash_spans, owners, small_batches, utf8, windows, word_hashes, word_spans

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
LAST = np.iinfo(np.int64).max
OUTPUTS = ("kept_text", "n_words", "n_removed")


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(LAST)).to_numpy(zero_copy_only=False)


def _fits(first: np.ndarray, own: np.ndarray, width: int) -> np.ndarray:
    """Whether a window of ``width`` words starts at each word, inside its text."""
    return np.arange(len(own)) + width <= first[own + 1]


def _anchors(hashes: np.ndarray, first: np.ndarray, own: np.ndarray, width: int, period: int,
             cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the windows at cover positions, in texts that hold a whole window."""
    size = width - period + 1
    at = np.flatnonzero(np.isin((np.arange(len(own)) - first[own]) % period, cover) & _fits(first, own, size)
                        & (np.diff(first)[own] >= width))
    return at, windows(hashes, size)[at]


def _coded(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Hash range and low 32 bits as one key, in the order of the ranges."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)) << np.uint64(32) | (
        hashes & np.uint64(0xFFFFFFFF))


def _repeated_anchors(docs: DataFrame, width: int, period: int, cover: tuple[int, ...]) -> str:
    parts = partitions(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("substrings")
        for split, rows in by_split(batches, 0):
            yield seen(split)
            found = []
            for b in small_batches(rows, 1):
                hashes, first = word_hashes(b.column(1))
                found.append(_coded(_anchors(hashes, first, owners(first), width, period, cover)[1], parts))
            keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
            bounds = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
            for p in range(parts):
                a, e = bounds[p], bounds[p + 1]
                if e > a:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p], pa.int32()), pa.array([split], pa.int64()),
                         pa.array([pack(keys[a:e].astype(np.uint32), np.packbits(n[a:e] > 1))], pa.binary())],
                        names=["part", "split", "body"])

    def answer(part: int, rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        read = [(split, *unpack(body, 2)) for split, body in rows]
        codes, n = np.unique(np.concatenate([c for _, c, _ in read]), return_counts=True)
        several = n > 1
        for _, c, bits in read:
            several[np.searchsorted(codes, c[np.unpackbits(bits, count=len(c)).astype(bool)])] = True
        for split, c, _ in read:
            hit = c[several[np.searchsorted(codes, c)]]
            if len(hit):
                yield split, pack(hit.astype(np.uint64) | np.uint64(part) << np.uint64(32))

    return exchange(docs.select("split", "id", "text").mapInArrow(scan, MESSAGE), answer,
                    lambda bodies: pack(np.unique(np.concatenate([unpack(b, 1)[0] for b in bodies]))))


def _earlier_windows(docs: DataFrame, anchors: str, width: int, period: int, cover: tuple[int, ...]) -> str:
    """For each split: windows that start in a smaller document, and the id above which they do."""
    parts = partitions(docs.sparkSession)
    reach = period - 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, rows in by_split(batches, 0):
            known = load(anchors, split, 1)
            if known is None:
                yield seen(split)
                continue
            known, found = known[0], []
            for b in small_batches(rows, 1):
                hashes, first = word_hashes(b.column(1))
                own = owners(first)
                at, value = _anchors(hashes, first, own, width, period, cover)
                if not len(at):
                    continue
                key = _coded(value, parts)
                spot = np.minimum(np.searchsorted(known, key), len(known) - 1)
                at = at[known[spot] == key]
                near = np.zeros(len(own) + 1, np.int64)
                np.add.at(near, np.maximum(at - reach, first[own[at]]), 1)
                np.add.at(near, at + 1, -1)
                start = np.flatnonzero((np.cumsum(near)[:-1] > 0) & _fits(first, own, width))
                if len(start):
                    found.append(np.stack([windows(hashes, width)[start],
                                           _ids(b.column(0))[own[start]].view(np.uint64)]))
            if not found:
                yield seen(split)
                continue
            value, ids = np.concatenate(found, axis=1)
            ids = ids.view(np.int64)
            order = np.lexsort((ids, value))
            value, ids = value[order], ids[order]
            head = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
            most = ids[np.r_[head[1:] - 1, len(ids) - 1]]
            yield from by_part(split, value[head], parts, ids[head], most > ids[head])

    def answer(part: int, rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        read = [(split, *unpack(body, 3)) for split, body in rows]
        value, ids = np.concatenate([r[1] for r in read]), np.concatenate([r[2] for r in read])
        order = np.lexsort((ids, value))
        value, ids = value[order], ids[order]
        head = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        value, ids = value[head], ids[head]
        for split, v, own, several in read:
            least = ids[np.searchsorted(value, v)]
            removed = (least < own) | several
            if removed.any():
                yield split, pack(v[removed], least[removed])

    def join(bodies: list[bytes]) -> bytes:
        read = [unpack(b, 2) for b in bodies]
        value, at = np.unique(np.concatenate([r[0] for r in read]), return_index=True)
        return pack(value, np.concatenate([r[1] for r in read])[at])

    return exchange(docs.select("split", "id", "text").mapInArrow(scan, MESSAGE), answer, join)


def _kept(column: pa.Array, ids: np.ndarray, rule: tuple[np.ndarray, np.ndarray] | None,
          width: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(kept words joined by one space, words, removed words) of each text."""
    data, offsets = utf8(column)
    data = np.insert(data, offsets[1:], 0x20)  # each text ends in a separator of its own
    offsets = offsets + np.arange(len(offsets))
    starts, ends, first = word_spans(data, offsets)
    gone = np.zeros(len(starts), bool)
    if rule is not None and len(starts) >= width:
        own = owners(first)
        win = windows(hash_spans(data, starts, ends, False), width)
        spot = np.minimum(np.searchsorted(rule[0], win), len(rule[0]) - 1)
        at = np.flatnonzero((rule[0][spot] == win) & (rule[1][spot] < ids[own[:len(win)]])
                            & _fits(first, own, width)[:len(win)])
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + width, -1)
        gone = np.cumsum(cover)[:-1] > 0
    stay = np.zeros(len(data) + 1, np.int8)
    stay[starts[~gone]] += 1
    stay[ends[~gone] + 1] -= 1
    stay = np.cumsum(stay[:-1], dtype=np.int8) > 0
    data[ends] = 0x20
    before = np.r_[0, np.cumsum(stay)][offsets]
    sizes = np.maximum(np.diff(before) - 1, 0)  # without the separator behind the last word
    drop = before[1:][np.diff(before) > 0] - 1
    body = np.delete(data[stay], drop)
    out = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)),
                                           pa.py_buffer(body))
    n = np.diff(first)
    removed = np.diff(np.r_[0, np.cumsum(gone)][first])
    return out, n, removed


def dedup_substrings(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = WINDOW,
                     period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """``docs`` with kept_text, n_words and n_removed."""
    if {(a - b) % period for a in cover for b in cover} != set(range(period)) or period > width:
        raise ValueError(f"{cover} is no difference cover modulo {period} below {width}")
    bounded_batches(docs.sparkSession)
    docs = from_files(docs)
    # The key is made beside _metadata, in the scan's own projection, before any other column.
    tagged = docs.select(split_key().alias("split"), F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    anchors = _repeated_anchors(tagged, width, period, cover)
    earlier = _earlier_windows(tagged, anchors, width, period, cover)

    own = [c for c in docs.columns if c not in OUTPUTS]
    split, ident, body = fresh(docs, "split"), fresh(docs, "id"), fresh(docs, "body")
    wide = docs.select(split_key().alias(split), F.col(id_col).cast("long").alias(ident), F.col(text).alias(body),
                       *[F.col(f"`{c}`") for c in own])
    out = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in own]).schema.fields,
                        T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in by_split(batches, 0):
            rule = load(earlier, at, 2)
            if rule is not None:
                order = np.argsort(rule[0])
                rule = rule[0][order], rule[1][order]
            for b in small_batches(rows, 1):
                kept, n, removed = _kept(b.column(1), _ids(b.column(0)), rule, width)
                columns = [b.column(i + 2) for i in range(len(own))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, kept.cast(pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())],
                    names=[*own, *OUTPUTS])
    return wide.mapInArrow(scan, out)


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that a smaller document has in a window of 13."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
