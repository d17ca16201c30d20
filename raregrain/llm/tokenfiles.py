"""Token-id files: frequency-ranked ids in a byte-aligned code, control bytes apart from data bytes.

Ids are replaced by their rank in the corpus' id frequencies, so common ids take
one byte. The byte length of each rank is kept apart from its bytes: one bit where the
vocabulary fits two bytes, else two bits. A reader turns a control byte into eight (or four)
lengths with one table lookup and gathers all ids of a block at once.

A folder holds ``ranks.bin`` (the id of each rank) and shards, each a range of
ids of documents in ascending order:

    magic, width of a control field (u32), blocks: [ids u32, data bytes u32, control, data] ...,
    index: document id, null flag, ids and blocks of each document; footer: place of the
    index (u64), documents (u64), magic

Blocks hold at most ``BLOCK`` ids, so neither the longest text nor a shard is ever whole in
a task's memory when written. Shards are written under a private name and
moved, so a retried task leaves a whole file.

Defined cases: a null text is empty, its document is the end id alone; a null
id sorts first; equal ids keep both documents, in the order of the input's tasks; an
empty table gives a folder without shards and no rows; extra columns are ignored.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import materialise, scratch_path
from .common import bounded_batches, ordered_cuts, query, shared_fs, shared_uri, table, write_atomically
from .tokens import encoder

MAGIC = b"RANKIDS1"
BLOCK = 1 << 16
SHARD_IDS = 1 << 23
READ = 1 << 18  # ids that a reader decodes together
END = 1
_HEAD, _BLOCK, _FOOT = "<8sI", "<II", "<QQ8s"


class Code:
    """The byte-aligned code: ``bits`` control bits say how many bytes a rank takes."""

    def __init__(self, bits: int):
        self.bits, self.most = bits, 1 << bits
        self.fields = 8 // bits
        every = np.arange(256)
        # table[c] = byte lengths that control byte c stands for, lowest field first
        self.table = np.stack([(every >> (bits * i) & (self.most - 1)) + 1 for i in range(self.fields)],
                              axis=1).astype(np.int64)

    def encode(self, ranks: np.ndarray) -> tuple[bytes, bytes]:
        """(control bytes, data bytes)."""
        size = np.ones(len(ranks), np.int64)
        for b in range(1, self.most):
            size += ranks >= np.uint64(1 << 8 * b)
        raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :self.most]
        data = raw[np.arange(self.most) < size[:, None]]
        fields = np.zeros(-(-len(ranks) // self.fields) * self.fields, np.uint8)
        fields[:len(ranks)] = size - 1
        control = np.zeros(len(fields) // self.fields, np.uint8)
        for i in range(self.fields):
            control |= fields[i::self.fields] << np.uint8(self.bits * i)
        return control.tobytes(), data.tobytes()

    def encode_many(self, ranks: np.ndarray, sizes: np.ndarray) -> list[tuple[bytes, bytes]]:
        """``encode`` of consecutive runs of ``ranks`` of the given sizes, in one go."""
        wide = np.ones(len(ranks), np.uint8)
        for b in range(1, self.most):
            wide += ranks >= np.uint64(1 << 8 * b)
        raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :self.most]
        data = raw[np.arange(self.most, dtype=np.uint8) < wide[:, None]].tobytes()
        ends = np.cumsum(sizes)
        bytes_at = np.r_[0, np.cumsum(wide, dtype=np.int64)][np.r_[0, ends]].tolist()
        held = -(-sizes // self.fields)  # control bytes of a run; its fields start on a byte
        first = np.r_[0, np.cumsum(held)]
        fields = np.zeros(int(first[-1]) * self.fields, np.uint8)
        fields[np.arange(len(ranks)) + np.repeat(first[:-1] * self.fields - (ends - sizes), sizes)] = wide - 1
        control = np.zeros(int(first[-1]), np.uint8)
        for i in range(self.fields):
            control |= fields[i::self.fields] << np.uint8(self.bits * i)
        control, first = control.tobytes(), first.tolist()
        return [(control[a:b], data[c:d]) for a, b, c, d in zip(first, first[1:], bytes_at, bytes_at[1:])]

    def decode(self, control: bytes, data: bytes, n: int) -> np.ndarray:
        return self.decode_many(control, data, np.array([n], np.int64))

    def decode_many(self, control: bytes, data: bytes, sizes: np.ndarray) -> np.ndarray:
        """``decode`` of consecutive runs of the given sizes, in one go."""
        ends = np.cumsum(sizes)
        held = -(-sizes // self.fields)  # control bytes of a run
        ahead = (np.cumsum(held) - held) * self.fields - (ends - sizes)  # fields left over in the runs before
        fields = np.arange(int(sizes.sum())) + np.repeat(ahead, sizes)
        size = self.table[np.frombuffer(control, np.uint8)].ravel()[fields]
        at = np.cumsum(size) - size
        raw = np.frombuffer(data, np.uint8)
        out = raw[at].astype(np.uint32)
        for b in range(1, self.most):
            more = np.flatnonzero(size > b)
            out[more] |= raw[at[more] + b].astype(np.uint32) << np.uint32(8 * b)
        return out


def _encoded(docs: DataFrame, path: str, text: str, id_col: str, end: int) -> DataFrame:
    """(row, doc_id, n, ids): ids as little-endian bytes of the least whole width, stored once."""
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                         T.StructField("ids", T.BinaryType())])
    narrow = max(encoder(path).tokenizer.get_vocab_size(), end + 1) <= 1 << 16
    tail = np.array([end], "<u2" if narrow else "<u4").tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, code="H" if narrow else "I")
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                ids = [x + tail for x in tool.encode([t or "" for t in b.column(1).to_pylist()])]
                n = [len(x) // (2 if narrow else 4) for x in ids]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                                                 names=kind.names)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, kind)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    place = scratch_path(docs.sparkSession)
    rows.write.option("compression", "zstd").parquet(place)
    return docs.sparkSession.read.schema(rows.schema).parquet(place)


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def _frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs: summed in each task, then over tasks; ``size`` numbers reach the driver."""
    kind = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            found = [_ids(raw, n) for n, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            if found:
                total += np.bincount(np.concatenate(found), minlength=size)[:size]
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=kind.names)
    out = np.zeros(size, np.int64)
    for r in rows.select("n", "ids").mapInArrow(scan, kind).groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def write_token_files(docs: DataFrame, folder: str, path: str, text: str = "text", id_col: str = "doc_id",
                      end: int = END) -> DataFrame:
    """Write the ids of all documents under ``folder``; (shard, docs, ids) of each file written."""
    spark = docs.sparkSession
    bounded_batches(spark)
    fs, root = shared_fs(folder)
    fs.create_dir(root)
    rows = _encoded(docs, path, text, id_col, end)
    size = max(encoder(path).tokenizer.get_vocab_size(), end + 1)
    seen = _frequencies(rows, size)
    by_rank = np.lexsort((np.arange(size), -seen)).astype("<u4")
    write_atomically(fs, f"{root}/ranks.bin", [by_rank.tobytes()])
    rank = np.empty(size, np.uint32)
    rank[by_rank] = np.arange(size)
    bits = 1 if size <= 1 << 16 else 2
    shared = spark.sparkContext.broadcast(rank)
    shards = max(1, int(seen.sum()) // SHARD_IDS)
    cuts = spark.sparkContext.broadcast(np.array(ordered_cuts(rows, "doc_id", shards), np.int64))

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        at = np.zeros(len(ids), np.int32)
        at[known] = np.searchsorted(cuts.value, ids[known].to_numpy(np.int64), "right")
        return pd.Series(at)

    kind = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                         T.StructField("row", T.LongType()), T.StructField("block", T.IntegerType()),
                         T.StructField("ids", T.LongType()), T.StructField("body", T.BinaryType())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, to_rank = Code(bits), shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                rows = list(zip(*(c.to_pylist() for c in whole.slice(at, 128).columns)))
                ranks = to_rank[np.concatenate([_ids(raw, n) for *_, n, raw in rows])]
                parts = [(shard, doc, row, i // BLOCK, min(BLOCK, n - i)) for shard, doc, row, n, _ in rows
                         for i in range(0, n, BLOCK)]
                coded = code.encode_many(ranks, np.array([p[4] for p in parts], np.int64))
                out = [(*p, struct.pack(_BLOCK, p[4], len(data)) + control + data)
                       for p, (control, data) in zip(parts, coded)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int32(),
                                                                pa.int64(), pa.binary()))], names=kind.names)

    done = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("docs", T.LongType()),
                         T.StructField("ids", T.LongType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, place = shared_fs(folder)
        rows_ = ((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))))
        pending = next(rows_, None)
        while pending is not None:
            shard, index = pending[0], []

            def body() -> Iterator[bytes]:
                nonlocal pending
                yield struct.pack(_HEAD, MAGIC, bits)
                at, last = struct.calcsize(_HEAD), None
                while pending is not None and pending[0] == shard:
                    _, doc, row, _, n, raw = pending
                    if row == last:
                        index[-1][2] += n
                        index[-1][3] += 1
                    else:
                        index.append([doc or 0, doc is None, n, 1])
                    last = row
                    at += len(raw)
                    yield raw
                    pending = next(rows_, None)
                for i, t in enumerate(("<i8", "<i8", "<i8", "<i8")):
                    yield np.array([x[i] for x in index], t).tobytes()
                yield struct.pack(_FOOT, at, len(index), MAGIC)
            write_atomically(here, f"{place}/shard-{shard:08d}.ids", body())
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([len(index)], pa.int64()),
                 pa.array([sum(x[2] for x in index)], pa.int64())], names=done.names)

    dealt = (rows.select(shard_of("doc_id").alias("shard"), "doc_id", "row", "n", "ids").mapInArrow(blocks, kind)
             .repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "row", "block"))
    return materialise(dealt.mapInArrow(write, done))


def read_token_files(folder: str, shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids as little-endian 32-bit bytes."""
    spark = shards.sparkSession
    files = sorted((r["shard"], r["ids"]) for r in shards.collect())  # two numbers a file
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                         T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    first = np.r_[0, np.cumsum([n for _, n in files])].astype(np.int64)
    todo = spark.createDataFrame([(s, int(f)) for (s, _), f in zip(files, first)], "shard int, first long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_fs(folder)
        with fs.open_input_stream(f"{root}/ranks.bin") as f:
            to_id = np.frombuffer(f.read(), "<u4")
        for b in batches:
            for shard, start in zip(*(c.to_pylist() for c in b.columns)):
                with fs.open_input_file(f"{root}/shard-{shard:08d}.ids") as f:
                    f.seek(f.size() - struct.calcsize(_FOOT))
                    at, n, magic = struct.unpack(_FOOT, f.read(struct.calcsize(_FOOT)))
                    if magic != MAGIC:
                        raise ValueError(f"shard {shard} of {folder} is no token-id file")
                    f.seek(at)
                    doc, null, ids, blocks = (np.frombuffer(f.read(8 * n), "<i8").tolist() for _ in range(4))
                    f.seek(0)
                    head, bits = struct.unpack(_HEAD, f.read(struct.calcsize(_HEAD)))
                    if head != MAGIC:
                        raise ValueError(f"shard {shard} of {folder} is no token-id file")
                    code, buffered = Code(bits), io.BufferedReader(f, 1 << 20)
                    out, held, ready, waiting, runs = [], 0, [], 0, []

                    def decoded() -> None:
                        nonlocal waiting, runs
                        if runs:
                            n_, control, data = zip(*runs)
                            ready.append(to_id[code.decode_many(b"".join(control), b"".join(data),
                                                                np.array(n_, np.int64))].tobytes())
                        waiting, runs = 0, []

                    def rows() -> pa.RecordBatch:
                        decoded()
                        every, ends = b"".join(ready), np.cumsum([4 * r[2] for r in out]).tolist()
                        cut = [every[x:y] for x, y in zip([0, *ends], ends)]
                        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                            [*zip(*out), cut], (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=kind.names)
                    for d, gone, count, parts in zip(doc, null, ids, blocks):
                        for _ in range(parts):
                            k, size = struct.unpack(_BLOCK, buffered.read(struct.calcsize(_BLOCK)))
                            body = buffered.read(-(-k // code.fields) + size)
                            runs.append((k, body[:-size] if size else body, body[len(body) - size:]))
                            waiting += k
                            if waiting >= READ:
                                decoded()
                        out.append((None if gone else d, start, count))
                        start += count
                        held += count
                        if held >= READ:
                            yield rows()
                            out, held, ready = [], 0, []
                    if out:
                        yield rows()
    return todo.repartition(max(1, len(files)), "shard").mapInArrow(read, kind)


def word_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token-id files, read back."""
    folder = shared_uri(spark)
    shards = write_token_files(table(spark, sf_dir, "documents"), folder, word_path())
    back = read_token_files(folder, shards)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
