"""SimHash fingerprints, and the searches for all fingerprints within a Hamming radius.

Terms are words and pairs of a word with the one before it (a mark stands for it at the start),
weighted by the bit length of the number of times they occur in the text (1, 2, 2, 3 for one to four): each
term adds its hash, as a vector of signs times the weight, to the votes, and the fingerprint has a one where the sum is positive. Words are
runs of bytes other than space and 0x09-0x0D, A-Z folded.

``within_radius``: a fingerprint is cut into ``BLOCKS`` blocks. Two fingerprints fewer than
2 * ``BLOCKS`` bits apart differ by at most one bit in some block. So a table for each block, with
that block permuted to the front as its key, holds every match under one of the keys that the
query's block reaches with at most one flipped bit; the whole fingerprint is compared there, and
a pair counts in the first block that finds it. The distinct fingerprints stay where they are: each
task builds the tables of its own, at most ``_TABLE`` at a time, and the distinct queries, which wait
in files of the shared folder, probe them. Candidates and pairs never become rows, only counts do.

``RADIUS`` is the largest that the tables are complete for. Measured on sf0.01 against the exact Jaccard
similarity of five-word shingles: it holds all 98 pairs of 0.8 or more and all 190 texts edited down to 0.8; the other 60
pairs that it holds have 0.57 or more. Contexts of two, three or five words alone lie too far for tables (up to 40, 46 and
52 bits), words alone bring texts of the same vocabulary near.

The edited text needs the next document, in descending id: documents are dealt out
in ranges of ids that end at ids in the table, and the last document of a range is
copied to the next, so each range is read once, in order, by one task.

Defined cases: a null text is empty; a text without a word has the fingerprint of zeros; a null id
sorts behind all others; documents with equal ids are ordered by their text;
the next document of a single one is itself; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import materialise
from .common import (bounded_batches, fresh, ordered_cuts, partitions, query, shared_fs, shared_uri, table,
                     write_atomically)
from .splits import pack, unpack
from .words import mix, owners, small_batches, word_hashes

LANES = 4  # 64-bit words of a fingerprint
BITS = 64 * LANES
BLOCKS = 16
RADIUS = 2 * BLOCKS - 1
_WIDTHS = (1, 2)  # words of a term
LOWEST = np.iinfo(np.int64).min
_TERMS = 1 << 15  # terms that vote at once
_TABLE = 1 << 17  # fingerprints in the tables at once
_CANDIDATES = 1 << 18  # compared at once
_SALTS = 16  # parts of the queries with one fingerprint
_FILE = 1 << 16  # queries of a file
# _SPREAD[b]: the bits of a byte, one in each byte of a 64-bit word, so that eight counters add up at once.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64).ravel()


def terms(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The terms that end at each word, one of each width, word after word."""
    nth = np.arange(len(hashes)) - first[owners(first)]
    out = np.empty((len(hashes), len(_WIDTHS)), np.uint64)
    total = np.zeros(len(hashes), np.uint64)
    for j in range(max(_WIDTHS)):
        before = np.full(len(hashes), np.uint64(j + 1))
        before[j:] = np.where(nth[j:] >= j, hashes[:max(0, len(hashes) - j)], np.uint64(j + 1))
        total += before * np.uint64(0x9E3779B97F4A7C15 * (2 * j + 1) & (2**64 - 1))
        if j + 1 in _WIDTHS:
            out[:, _WIDTHS.index(j + 1)] = mix(total + np.uint64(j))
    return out.ravel()


def weighted(term: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct term of a text, as many times as it weighs."""
    order = np.lexsort((term, text))
    term, text = term[order], text[order]
    heads = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (text[1:] != text[:-1])][:len(term)])
    weight = np.frexp(np.diff(np.r_[heads, len(term)]))[1]  # the bit length
    return np.repeat(term[heads], weight), np.repeat(text[heads], weight)


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, LANES) fingerprints of texts given by their word hashes."""
    n = len(first) - 1
    votes = np.zeros((n, BITS), np.int64)
    term, text = weighted(terms(hashes, first), owners(first * len(_WIDTHS)))
    first = np.searchsorted(text, np.arange(n + 1))
    for at in range(0, len(term), _TERMS):
        t, own = term[at:at + _TERMS], text[at:at + _TERMS]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        # at most 255 rows are added up in one-byte counters
        parts = np.unique(np.concatenate([heads, np.arange(0, len(t), 255)]))
        signs = np.stack([mix(t + np.uint64(i + 1)) for i in range(LANES)], axis=1).view(np.uint8)
        sums = np.add.reduceat(_SPREAD[signs], parts, axis=0).view(np.uint8).reshape(len(parts), BITS)
        firsts = np.searchsorted(parts, heads)
        votes[own[heads]] += np.add.reduceat(sums.astype(np.int64), firsts, axis=0)
    ones = 2 * votes > np.diff(first)[:, None]
    return np.packbits(ones, axis=1).view(np.uint64).reshape(n, LANES)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of each pair of rows."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def text_fingerprints(texts: list[str]) -> np.ndarray:
    return fingerprints(*word_hashes(pa.array(texts, pa.string()), fold=True))


def fingerprint_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness; lanes as array<long>."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(LOWEST))).alias("key"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(LOWEST))).alias("key"))
    cuts = np.array(ordered_cuts(ids, "key", 4 * partitions(spark)), np.int64)
    top = ids.agg(F.max("key")).first()[0]

    dealt = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("key", T.LongType()),
                          T.StructField("doc_id", T.LongType()), T.StructField("own", T.BooleanType()),
                          T.StructField("body", T.BinaryType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for b in small_batches(iter([whole]), 2):
                out = []
                for key, doc, text_ in zip(*(c.to_pylist() for c in b.columns)):
                    at = int(np.searchsorted(cuts, key))
                    body = pack.compress((text_ or "").encode())
                    out.append((at, key, doc, True, body))
                    if at < len(cuts) and cuts[at] == key:  # the largest of its range: the next one of the range above
                        out.append((at + 1, key, doc, False, body))
                    if key == top:  # the next one of the smallest
                        out.append((0, None, doc, False, body))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], names=dealt.names)

    kind = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("lanes", T.ArrayType(T.LongType())),
        T.StructField("edited_lanes", T.ArrayType(T.LongType())), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = zstandard.ZstdDecompressor()

        def emit(group: list[tuple[int, bool, str]], follower: tuple[int, bool, str] | None) -> pa.RecordBatch | None:
            """Rows of one range, in order, with the row behind them."""
            line = group + ([follower] if follower else [])
            pairs = [(a, b) for a, b in zip(line, line[1:]) if a[1]]
            if not pairs:
                return None
            texts = [r[2] for r in line]
            edited = [a[2][:len(a[2]) - len(a[2]) // 2] + b[2][:len(a[2]) // 2] for a, b in pairs]
            prints, changed = text_fingerprints(texts), text_fingerprints(edited)
            here = np.array([i for i, r in enumerate(line[:-1]) if r[1]])

            def lists(x: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * LANES, pa.int32()),
                                                pa.array(x.ravel().view(np.int64)))
            return pa.RecordBatch.from_arrays(
                [pa.array([a[0] for a, _ in pairs], pa.int64()), pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                 pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                 lists(prints[here]), lists(changed), pa.array(likeness(prints[here], changed)),
                 pa.array(likeness(prints[here], prints[here + 1]))], names=kind.names)

        now, group, size = None, [], 0
        for b in batches:
            for bucket, doc, own, body in zip(*(c.to_pylist() for c in b.columns)):
                row = (doc, own, read.decompress(body).decode())
                if bucket != now:
                    if group and (out := emit(group, None)):
                        yield out
                    now, group, size = bucket, [], 0
                if size > 1 << 21:
                    if out := emit(group, row):
                        yield out
                    group, size = [], 0
                group.append(row)
                size += len(row[2])
        if group and (out := emit(group, None)):
            yield out

    order = [F.col("bucket"), F.col("key").desc_nulls_last(), F.col("own").desc(), F.col("tie")]
    ranged = (rows.mapInArrow(deal, dealt).withColumn("tie", F.xxhash64("body"))
              .repartition(partitions(spark), "bucket").sortWithinPartitions(*order))
    return ranged.select("bucket", "doc_id", "own", "body").mapInArrow(compare, kind)


class BlockTables:
    """One table for each block: the fingerprints in the order of that block, and where each of its values starts."""

    width = BITS // BLOCKS
    flips = np.r_[0, 1 << np.arange(width)]  # a key and its neighbours one bit apart

    def __init__(self, prints: np.ndarray, sizes: np.ndarray):
        keys = prints.view(np.uint16).reshape(-1, BLOCKS)
        self.tables = []
        for j in range(BLOCKS):
            order = np.argsort(keys[:, j], kind="stable")
            starts = np.r_[0, np.cumsum(np.bincount(keys[:, j], minlength=1 << self.width))]
            self.tables.append((prints[order], sizes[order], starts))

    def counts(self, asked: np.ndarray, radius: int = RADIUS) -> np.ndarray:
        """For each query, the summed sizes of the fingerprints at most ``radius`` bits apart."""
        if not 0 <= radius < 2 * BLOCKS:
            raise ValueError(f"{BLOCKS} blocks with one flipped bit find a radius of {2 * BLOCKS - 1} at most")
        out = np.zeros(len(asked), np.int64)
        keys = asked.view(np.uint16).reshape(-1, BLOCKS)
        for j, (prints, sizes, starts) in enumerate(self.tables):
            probes = keys[:, j, None].astype(np.int64) ^ self.flips
            lo, n = starts[probes], starts[probes + 1] - starts[probes]
            ends = np.cumsum(n.sum(axis=1))
            at = 0
            while at < len(asked):  # a query meets a fingerprint once in a table, so one alone is bounded too
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + _CANDIDATES, "right")))
                many = n[at:to].ravel()
                place = np.arange(many.sum()) + np.repeat(lo[at:to].ravel() - (np.cumsum(many) - many), many)
                who = np.repeat(np.arange(at, to), n[at:to].sum(axis=1))
                near = np.bitwise_count(asked[who] ^ prints[place]).sum(axis=1, dtype=np.int64) <= radius
                who, place = who[near], place[near]
                split = (asked[who] ^ prints[place]).view(np.uint16).reshape(-1, BLOCKS)
                new = ~(np.bitwise_count(split[:, :j]) <= 1).any(axis=1)
                out += np.bincount(who[new], sizes[place[new]], len(asked)).astype(np.int64)
                at = to
        return out


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``queries`` with n_near: how many rows of ``prints`` lie within the radius of their lanes, one row apart.

    Both have a column ``lanes``; queries are rows of ``prints``.
    """
    if not 0 <= radius < 2 * BLOCKS:
        raise ValueError(f"{BLOCKS} blocks with one flipped bit find a radius of {2 * BLOCKS - 1} at most")
    spark = prints.sparkSession
    folder = shared_uri(spark)
    fs, root = shared_fs(folder)
    fs.create_dir(root)

    def lanes_of(b: pa.RecordBatch) -> np.ndarray:
        return b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, LANES)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, path = shared_fs(folder)
        rows = [lanes_of(b) for b in batches if b.num_rows]
        every = np.concatenate(rows) if rows else np.zeros((0, LANES), np.uint64)
        for at in range(0, len(every), _FILE):
            found = every[at:at + _FILE]
            name = hashlib.sha256(found.tobytes()).hexdigest()  # a task that runs again lists the names that count
            write_atomically(here, f"{path}/{name}", [pack(found)])
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    def search(rows: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        tables = BlockTables(*(np.concatenate(x) for x in zip(*rows)))
        here, path = shared_fs(folder)
        for name in names:
            with here.open_input_stream(f"{path}/{name}") as f:
                asked, = unpack(f.read(), 1)
            for at in range(0, len(asked), 1 << 12):
                part = np.ascontiguousarray(asked[at:at + (1 << 12)])
                n = tables.counts(part, radius)
                hit = np.flatnonzero(n)
                if len(hit):
                    flat = part[hit].ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array(np.arange(len(hit) + 1) * LANES, pa.int32()), pa.array(flat)),
                         pa.array(n[hit], pa.int64())], names=["lanes", "size"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            rows.append((lanes_of(b), b.column(1).to_numpy(zero_copy_only=False)))
            held += b.num_rows
            if held >= _TABLE:
                yield from search(rows)
                rows, held = [], 0
        if rows:
            yield from search(rows)

    names = [r[0] for r in queries.select("lanes").distinct().mapInArrow(store, "name string").collect()]
    every = prints.groupBy("lanes").agg(F.count(F.lit(1)).alias("size"))
    found = (every.mapInArrow(compare, "lanes array<bigint>, size bigint")
             .groupBy("lanes").agg(F.sum("size").alias("size")))
    salt, there, size = (fresh(queries, n) for n in ("salt", "lanes", "size"))
    parts = found.select(F.col("lanes").alias(there), F.col("size").alias(size),
                         F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("__part"))
    salted = queries.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"))
    return (salted.join(parts, (F.col("lanes") == F.col(there)) & (F.col(salt) == F.col("__part")), "left")
            .withColumn("n_near", F.coalesce(F.col(size), F.lit(1)) - 1).select(*queries.columns, "n_near"))


def as_text(lanes: Column) -> Column:
    """A fingerprint as hexadecimal digits."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts; n_near, the others within RADIUS, where 50 divides the id."""
    prints = materialise(fingerprint_documents(table(spark, sf_dir, "documents").select("doc_id", "text")))
    asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    searched = within_radius(prints.select("lanes"), prints.where(asked))
    others = prints.where(~asked).withColumn("n_near", F.lit(None).cast("long"))
    return (others.unionByName(searched)
            .select("doc_id", "n_chars", "edited_sha256", as_text(F.col("lanes")).alias("fingerprint"),
                    as_text(F.col("edited_lanes")).alias("edited_fingerprint"), "near_edited", "near_next", "n_near"))
