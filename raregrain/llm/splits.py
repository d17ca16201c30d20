"""Second visits: what was found out about the rows of a split waits for the next scan of that split.

A split is a stretch of rows of one file (``common.split_key``); a task may have a part of one, or several.

The rows themselves are never shuffled. A first scan sends small arrays, by hash
range, to the tasks that compare them; these answer each split with what its
next scan needs, and the answer of a split lands in one file of the shared
folder, named by the split. Any task, also a retried one, can read it.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import give_back, partitions, shared_fs, shared_uri, write_atomically

MESSAGE = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("split", T.LongType()),
                        T.StructField("body", T.BinaryType())])
_ARROW = pa.schema([("part", pa.int32()), ("split", pa.int64()), ("body", pa.binary())])


def pack(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a)
    return out.getvalue()


def unpack(body: bytes, n: int) -> list[np.ndarray]:
    read = io.BytesIO(body)
    return [np.load(read) for _ in range(n)]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The hash range a 64-bit hash belongs to."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def message(part: int, split: int, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([split], pa.int64()), pa.array([body], pa.binary())], schema=_ARROW)


def seen(split: int) -> pa.RecordBatch:
    """Says that a scan met the split, whether it has more to send or not."""
    return message(0, split, b"")


def by_part(split: int, hashes: np.ndarray, parts: int, *more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One message for each hash range, of sorted hashes and what belongs to them."""
    yield seen(split)
    bounds = np.searchsorted(part_of(hashes, parts), np.arange(parts + 1))
    for p in range(parts):
        a, b = bounds[p], bounds[p + 1]
        if b > a:
            yield message(p, split, pack(hashes[a:b], *(m[a:b] for m in more)))


def runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of one key after the other; the input is sorted by the key."""
    now, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[key] != now:
                if rows:
                    yield now, rows
                now, rows = row[key], []
            rows.append(row)
    if rows:
        yield now, rows
    give_back()


def by_split(batches: Iterator[pa.RecordBatch], split: int) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Rows of one split after the other, without that column."""
    pending: list[pa.RecordBatch] = []

    def cut() -> Iterator[tuple[int, pa.RecordBatch]]:
        for b in batches:
            ids = b.column(split).to_numpy(zero_copy_only=False)
            rest = [i for i in range(b.num_columns) if i != split]
            b = b.select(rest)
            edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, e in zip(edges, edges[1:]):
                if e > a:
                    yield int(ids[a]), b.slice(a, e - a)
    pieces = cut()
    pending = next(pieces, None)

    def same(now: int) -> Iterator[pa.RecordBatch]:
        nonlocal pending
        while pending is not None and pending[0] == now:
            piece, pending = pending[1], next(pieces, None)
            yield piece
    while pending is not None:
        now = pending[0]
        group = same(now)
        yield now, group
        for _ in group:  # what the caller left
            pass
    give_back()


def exchange(messages: DataFrame, answer: Callable[[int, list[tuple[int, bytes]]], Iterator[tuple[int, bytes]]],
             join: Callable[[list[bytes]], bytes]) -> str:
    """Send messages to their hash range, answer each split, and store each split's joined answers; the folder's URI.

    A split may send several messages to a range, from several tasks. One that is only ``seen`` gets an empty file.
    """
    spark = messages.sparkSession
    parts = partitions(spark)
    folder = shared_uri(spark)
    fs, root = shared_fs(folder)
    fs.create_dir(root)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in runs(batches, 0):
            for split in {r[1] for r in rows if not r[2]}:
                yield seen(split)
            sent = [(r[1], r[2]) for r in rows if r[2]]
            for split, body in answer(part, sent) if sent else ():
                yield message(part, split, body)

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, path = shared_fs(folder)
        for split, rows in runs(batches, 1):
            bodies = [r[2] for r in rows if r[2]]
            write_atomically(here, f"{path}/{split}", [join(bodies)] if bodies else [])
            yield message(0, split, b"")

    back = (messages.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(answered, MESSAGE))
    (back.repartition(parts, "split").sortWithinPartitions("split", "part").mapInArrow(stored, MESSAGE).count())
    return folder


def load(folder: str, split: int, n: int) -> list[np.ndarray] | None:
    """The arrays stored for a split, or None where nothing was found in it; an error if no scan met it before."""
    fs, root = shared_fs(folder)
    info = fs.get_file_info(f"{root}/{split}")
    if info.type == pafs.FileType.NotFound:
        raise RuntimeError(f"split {split} was not there in the scan before: its file has changed")
    if not info.size:
        return None
    with fs.open_input_stream(info.path) as f:
        return unpack(f.read(), n)
