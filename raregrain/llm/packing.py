"""Best-fit packing of token pieces by exact-complement hashing.

Documents are cut into pieces of at most ``capacity`` tokens and the pieces fill
sequences of that size. Pieces of equal length are interchangeable, so the plan
is made on the histogram of lengths (``capacity`` counts, whatever the input):
longest first, the gap behind a piece is looked up among the sums of one, two
or three available lengths; an exact combination is used as often as its
counts allow. What finds no exact partner is placed best fit, longest first,
on bins grouped by their gap. The plan is a short table of length, range of ranks, sequence and
offset; a piece finds its place by its rank among the pieces of its length.
Ranks come from per-task counters and sums over tasks: no window over a length, however common.

Defined cases: a null text is empty, its document is the end id alone; a null id
and repeated rows are documents of their own; pieces of equal length are
interchangeable; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import materialise
from .common import begin, bounded_batches, give_back, query, table
from .tokens import MEMORY, encoder

CAPACITY = 2048
END = 0
_SHIFT = 44  # ranks below 2**44, lengths above


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than the capacity."""
    head = length % capacity or min(length, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, length, capacity)]


def pieces(docs: DataFrame, path: str, text: str, id_col: str, capacity: int, end: int,
           memory: int = MEMORY) -> DataFrame:
    """One row per piece, with its task and its rank among the pieces of its length in that task."""
    kind = T.StructType([T.StructField(n, T.LongType()) for n in (
        "doc_id", "start", "length", "ids_crc32", "nth")] + [T.StructField("piece", T.IntegerType()),
                                                            T.StructField("task", T.IntegerType())])
    tail = np.array([end], "<u4").tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("tokens")
        tool, task = encoder(path, memory), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                rows = []
                for doc, ids in zip(b.column(0).to_pylist(),
                                    tool.encode([t or "" for t in b.column(1).to_pylist()])):
                    ids = memoryview(ids + tail)
                    for i, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), seen[n], i, task))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 5 + [pa.int32()] * 2)],
                    names=kind.names)
        if memory < MEMORY:  # the worker may stay idle for long
            tool.plain.forget()
            tool.spaced.forget()
            give_back()
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, kind)


def _partners(left: np.ndarray, gap: int, most: int) -> tuple[int, ...] | None:
    """Up to ``most`` (1 to 3) available lengths that sum to the gap, the longest first."""
    if gap <= 0:
        return () if gap == 0 else None
    if left[gap] and most > 0:
        return (gap,)
    pair = _pair(left, gap, gap - 1) if most > 1 else None
    if pair or most < 3:
        return pair
    for a in np.flatnonzero(left[1:gap - 1])[::-1] + 1:
        if 3 * a < gap:
            break
        left[a] -= 1
        rest = _pair(left, gap - int(a), int(a))
        left[a] += 1
        if rest:
            return (int(a), *rest)
    return None


def _pair(left: np.ndarray, total: int, most: int) -> tuple[int, int] | None:
    """Two available lengths of the given sum, the longer one at most ``most``."""
    low = (total + 1) // 2
    high = min(most, total - 1)
    if high < low:
        return None
    a = np.arange(high, low - 1, -1)
    ok = (left[a] > 0) & (left[total - a] > np.where(a == total - a, 1, 0))
    at = int(ok.argmax())
    return (int(a[at]), int(total - a[at])) if ok[at] else None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) for the histogram ``counts`` of piece lengths.

    Short lengths spent on exact triples may be missed by long pieces later, so
    the plan is made with up to three, two, one and no exact partner, and the one with the
    fewest sequences is taken.
    """
    least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    best: list[tuple[tuple[int, ...], int]] | None = None
    for most in (3, 2, 1, 0):
        now = plan_with(counts, capacity, most)
        if best is None or sum(n for _, n in now) < sum(n for _, n in best):
            best = now
        if sum(n for _, n in best) == least:
            break
    return best


def plan_with(counts: np.ndarray, capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan with up to ``most`` exact partners behind a piece, then best fit."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    for a in range(capacity, 0, -1):
        while left[a]:
            left[a] -= 1
            found = _partners(left, capacity - a, most)
            left[a] += 1
            if found is None:
                break
            combo = (a, *found)
            need = {n: combo.count(n) for n in combo}
            times = min(int(left[n]) // k for n, k in need.items())
            for n, k in need.items():
                left[n] -= k * times
            out.append((combo, times))
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for a in range(capacity, 0, -1):
        n = int(left[a])
        while n:
            gap = min((g for g in bins if g >= a), default=None)
            if gap is None:
                fill = min(n, capacity // a)
                times = n // fill
                bins.setdefault(capacity - fill * a, []).append(((a,) * fill, times))
                n -= fill * times
                continue
            combo, there = bins[gap].pop()
            times = min(n, there)
            if there > times:
                bins[gap].append((combo, there - times))
            if not bins[gap]:
                del bins[gap]
            bins.setdefault(gap - a, []).append(((*combo, a), times))
            n -= times
    return out + [x for g in sorted(bins) for x in bins[g]]


def places(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """(length and first rank as one key, first sequence, offset), sorted by the key."""
    used = [0] * (capacity + 1)
    rows, base = [], 0
    for combo, times in patterns:
        for n, offset in zip(combo, accumulate((0, *combo))):
            rows.append((n << _SHIFT | used[n], base, offset))
            used[n] += times
        base += times
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(3))


def pack_documents(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id",
                   capacity: int = CAPACITY, end: int = END, memory: int = MEMORY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece.

    With less than the usual ``memory`` (chunks that a worker remembers) the result stays, the work takes longer.
    """
    bounded_batches(docs.sparkSession)
    found = materialise(pieces(docs, path, text, id_col, capacity, end, memory))
    by_task = found.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = materialise(by_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    counts = np.zeros(capacity + 1, np.int64)
    for r in shift.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    shared = docs.sparkSession.sparkContext.broadcast(places(plan(counts, capacity), capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, base, offset = shared.value
        want = (length.to_numpy(np.int64) << _SHIFT) | rank.to_numpy(np.int64)
        at = np.searchsorted(keys, want, "right") - 1
        return pd.DataFrame({"sequence_id": base[at] + (want - keys[at]), "offset": offset[at]})

    ranked = found.join(shift.select("task", "length", "before"), ["task", "length"])
    return (ranked.withColumn("place", place(F.col("length"), F.col("nth") + F.col("before")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"))


def byte_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), byte_path())
