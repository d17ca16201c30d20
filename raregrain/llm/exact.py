"""Exact dedup by two passes over a Bloom filter.

Pass one throws every hash into a filter and marks the cells that are hit a
second time. A row can be repeated only if all its cells are marked, so pass
two lets all other rows go straight through: they are never shuffled. Only the
possibly repeated rows meet by their hash. False positives of the filter cost a
shuffled row, never a wrong answer.

The filter is a bit array of ``bits_per_row`` bits a row, rounded up to a power of two and
at most ``MAX_BITS`` (16 MiB broadcast): over that more rows
shuffle, and the result stays the same.

Defined cases: a null text equals an empty one; rows without an id are ordinary
rows and lose ties; of rows that share id and text one stays; an empty
table gives no rows; extra columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import materialise
from .common import begin, fresh, give_back, partitions, query, table

MAX_BITS = 1 << 27
HASHES = 4
SEGMENT = 1 << 16  # bits of one segment of the filter, the unit that is shuffled and merged
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    """HASHES cells of each 64-bit hash, by double hashing: shape (HASHES, n)."""
    h = hashes.astype(np.uint64, copy=False)
    step = ((h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(HASHES)])


def _hit(once: np.ndarray, twice: np.ndarray, at: np.ndarray) -> None:
    """Mark cells; ``at`` may name a cell several times, but one hash names it once at most."""
    got, n = np.unique(at, return_counts=True)
    twice[got[(n > 1) | once[got]]] = True
    once[got] = True


def repeated_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the cells that are hit twice or more; ``hashes`` has one long column.

    Each task fills an array of its own and sends its segments packed; tasks that
    own a segment range merge the packed segments one by one in constant memory.
    """
    segments = max(1, bits // SEGMENT)
    width = bits // segments
    kind = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("once", T.BinaryType()),
                         T.StructField("twice", T.BinaryType())])
    schema = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("exact")
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        seen = False
        for b in batches:
            if b.num_rows:
                seen = True
                at = cells(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)
                at.sort(axis=0)  # cells that one hash names twice count once
                fold = np.concatenate([at[:1].ravel()] + [at[i][at[i] != at[i - 1]] for i in range(1, HASHES)])
                _hit(once, twice, fold)
        if not seen:
            return
        give_back()
        for s in range(segments):
            part = slice(s * width, (s + 1) * width)
            if once[part].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([np.packbits(once[part]).tobytes()], pa.binary()),
                     pa.array([np.packbits(twice[part]).tobytes()], pa.binary())], schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([once.tobytes()], pa.binary()),
                                               pa.array([twice.tobytes()], pa.binary())], schema=schema)
        for b in batches:
            for s, o, t in zip(*(c.to_pylist() for c in b.columns)):
                o, t = np.frombuffer(o, np.uint8), np.frombuffer(t, np.uint8)
                if s != now:
                    if now is not None and twice.any():
                        yield out()
                    now, once, twice = s, o.copy(), t.copy()
                else:
                    twice |= t | (once & o)
                    once |= o
        if now is not None and twice.any():
            yield out()

    spark = hashes.sparkSession
    merged = (hashes.mapInArrow(fill, kind).repartition(min(partitions(spark), segments), "segment")
              .sortWithinPartitions("segment").mapInArrow(merge, kind).select("segment", "twice"))
    packed = np.zeros(bits // 8, np.uint8)
    for r in merged.collect():  # bits / 8 bytes at most
        packed[r["segment"] * width // 8:(r["segment"] + 1) * width // 8] = np.frombuffer(r["twice"], np.uint8)
    return packed


def maybe_repeated(spark: SparkSession, packed: np.ndarray, bits: int):
    """A column function: hash -> whether all cells of the hash are hit twice."""
    shared = spark.sparkContext.broadcast(packed)

    @F.pandas_udf(T.BooleanType())
    def test(h: pd.Series) -> pd.Series:
        at = cells(h.to_numpy().view(np.uint64), bits)
        hit = (shared.value[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1
        return pd.Series(hit.all(axis=0))
    return test


def exact_duplicates(rows: DataFrame, key: str, id_col: str = "doc_id", bits_per_row: int = 16) -> DataFrame:
    """``rows`` with keep_id, group_size and kept: of rows with equal ``key`` the largest id stays.

    The key is a digest. ``rows`` is visited three times, so hand over something
    cheap to read again.
    """
    spark = rows.sparkSession
    n = rows.count()
    bits = min(MAX_BITS, max(1024, 1 << (max(1, n * bits_per_row) - 1).bit_length()))
    h, rid, flag = fresh(rows, "hash"), fresh(rows, "row"), fresh(rows, "maybe")
    hashed = rows.withColumn(h, F.xxhash64(key))
    test = maybe_repeated(spark, repeated_filter(hashed.select(h), bits), bits)
    flagged = hashed.withColumn(flag, test(F.col(h)))
    single = (flagged.where(~F.col(flag))
              .withColumns({"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}))
    # Without the flag's column: beside the filter it would be a second Python step in each task, with a worker of its own.
    meet = materialise(flagged.where(F.col(flag)).drop(h, flag).withColumn(rid, F.monotonically_increasing_id()))
    top, same = fresh(rows, "top"), fresh(rows, "key")
    # Stored, so that the join deals out both sides itself and can split the rows of a hot group over tasks.
    groups = materialise(meet.groupBy(F.col(key).alias(same))
                         .agg(F.max(F.struct(F.col(id_col).alias("id"), F.col(rid).alias("row"))).alias(top),
                              F.count(F.lit(1)).alias("group_size")))
    several = (meet.join(groups, F.col(key) == F.col(same))
               .withColumns({"keep_id": F.col(top)["id"], "kept": F.col(top)["row"] == F.col(rid)}))
    columns = [*[F.col(f"`{c}`") for c in rows.columns], "keep_id", "group_size", "kept"]
    return single.select(*columns).unionByName(several.select(*columns))


def drop_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents that stay, with their own columns."""
    key = fresh(docs, "sha")
    shown = docs.withColumn(key, F.sha2(normalised(F.col(text)), 256))
    plain = {c: fresh(shown, f"own_{c}") for c in docs.columns if c.lower() in ("keep_id", "group_size", "kept")}
    shown = shown.withColumnsRenamed(plain)
    out = exact_duplicates(shown, key, plain.get(id_col, id_col)).where("kept")
    return out.select(*[F.col(f"`{plain.get(c, c)}`").alias(c) for c in docs.columns])


ORACLE = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query("op1_exact_dedup", ORACLE)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: which document of its group of equal texts stays."""
    docs = table(spark, sf_dir, "documents")
    digests = materialise(docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256")))
    return (exact_duplicates(digests, "text_sha256")
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
