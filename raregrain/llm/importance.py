"""Importance resampling towards a target: draw the documents whose hashed n-grams look like the target's.

Every run of 1 to ``longest`` words falls into one of ``buckets`` buckets. A bucket's gain is the logarithm of its
share in the target over its share in the documents; a document's weight is the mean gain of its features, and a
draw without replacement takes the highest weights after adding Gumbel noise that depends on the id alone.

A batch's texts are joined with a separator byte between them, so one pass of a regular expression finds the words
of all of them. ``searchsorted`` of the words' places in the texts' offsets tells whose they are, and masks the
n-grams that would cross from one text into the next before everything is counted by ``bincount``. The CRC of an
n-gram goes on from the CRC of its first n - 1 words, so no n-gram is ever put together. The words are handled
``BLOCK`` at a time and the last ones are carried over: memory does not grow with a text's words.

The documents are read twice: for the bucket counts, of which each task sends one set, and for the weights. Texts
are never shuffled. The gains are one number a bucket, a bound on what is collected and sent to tasks. Ranks come
from a range-partitioned sort of (score, id) and the row counts of its parts.

Defined cases: a null text has no words and weight 0; a missing id counts as an empty one for the noise and comes
last among ties; rows with one id get the same noise; rows that share score and id are in any order; an empty table
or one without long enough texts draws nothing; extra columns stay, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate, islice, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import materialise
from .common import bounded_batches, crc32_sql, fresh, partitions, query, table
from .words import small_batches

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # on UTF-8 after lower-casing A-Z
SEPARATOR = b"\x00"  # no byte of a word
BLOCK = 1 << 17  # words handled at once
BUCKETS, LONGEST, LEAST_WORDS, SHARE, SEED = 10_000, 2, 20, 25, 7


def features(texts: list[bytes], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in the n-gram, CRCs of the n-grams, their texts), block by block."""
    joined = SEPARATOR.join(texts).lower()  # bytes: A-Z only
    begins = np.fromiter(accumulate((len(t) + 1 for t in texts[:-1]), initial=0), np.int64, len(texts))
    found = WORD.finditer(joined)
    # The last longest - 1 words so far: their texts, and the CRCs of the n-grams that end with them.
    owner_before = np.full(longest - 1, -1, np.int64)
    before = [[0] * (longest - 1) for _ in range(longest - 1)]
    while block := list(islice(found, BLOCK)):
        words = [m.group() for m in block]
        starts = np.fromiter((m.start() for m in block), np.int64, len(block))
        own = np.searchsorted(begins, starts, "right") - 1
        owner = np.concatenate([owner_before, own])
        at = len(owner_before)
        crc = list(map(crc32, words))
        yield 1, np.array(crc, np.uint32), own
        for n in range(2, longest + 1):
            # The n-gram that ends with a word goes on from the one of n - 1 words that ends with the word before.
            shorter = before[n - 2][-1:] + crc[:-1]
            before[n - 2] = (before[n - 2] + crc)[-(longest - 1):]
            crc = list(map(crc32, words, map(crc32, repeat(b" "), shorter)))
            whole = owner[at - n + 1:len(owner) - n + 1] == own
            yield n, np.array(crc, np.uint32)[whole], own[whole]
        owner_before = owner[len(owner) - at:]


def _utf8(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    bounded_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in small_batches(batches, "text"):
            for _, crc, _ in features(_utf8(b.column(0)), longest):
                total += np.bincount(crc % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = texts.select(F.col(text).alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket")
    for r in sums.agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's smoothed share in the target over that in the source, floored."""
    s_all, t_all, size = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, names: tuple[str, str, str], text: str = "text",
            longest: int = LONGEST) -> DataFrame:
    """``docs`` with their numbers of words and features and their weight, under the given names."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(gain)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, text):
            value = shared.value
            n_words, n_all, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for n, crc, own in features(_utf8(b.column(text)), longest):
                of = value[crc % len(value)]
                count = np.bincount(own, minlength=b.num_rows)
                n_all += count
                n_words += count if n == 1 else 0
                total += np.bincount(own, of, b.num_rows).astype(np.int64)  # whole numbers, exact below 2**53
            mean = total // np.maximum(n_all, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, (n_words, n_all, mean))],
                                             names=[*b.schema.names, *names])
    kind = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in names]])
    return docs.mapInArrow(scan, kind)


def gumbel(id_col: Column, seed: int) -> Column:
    """1000 times Gumbel noise, floored, from the first 32 bits of the SHA-256 of "seed:id"."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def in_order(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """The rows with their exact place (1, 2, 3 ...) in the given order; no task holds more than its part."""
    spark = df.sparkSession
    part = F.shiftright(F.col(out), 33)  # the upper bits of monotonically_increasing_id
    kept = materialise(df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                       .withColumn(out, F.monotonically_increasing_id()))
    sizes = {r["part"]: r["n"] for r in kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = list(accumulate((sizes.get(p, 0) for p in range(max(sizes, default=0))), initial=0))  # a number a part
    low = F.col(out).bitwiseAND(F.lit((1 << 33) - 1))
    return kept.withColumn(out, F.element_at(F.lit(before).cast("array<bigint>"), part.cast("int") + 1) + low + 1)


def importance_draw(docs: DataFrame, target: DataFrame, text: str = "text", id_col: str = "doc_id",
                    target_text: str = "text", share: int = SHARE, least_words: int = LEAST_WORDS,
                    longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; a rank only for the drawn ones.

    Of the documents with at least ``least_words`` words the ``share`` per cent with the highest score are drawn.
    """
    value = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    rows = materialise(
        weighed(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), value,
                ("n_words", "n_features", "weight"), "text", longest)
        .select("doc_id", "n_words", "n_features", "weight",
                (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score")))
    able = F.col("n_words") >= least_words
    drawn = share * rows.where(able).count() // 100
    placed = in_order(rows, [(~able).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "place")
    return placed.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(able & (F.col("place") <= drawn), F.col("place")).alias("rank"))


def importance_resample(docs: DataFrame, target: DataFrame, text: str = "text", id_col: str = "doc_id",
                        **options) -> DataFrame:
    """The drawn documents with their own columns: those up to the last drawn (score, id); ids are unique here."""
    spare = [fresh(docs, c) for c in ("words", "features", "weight")]
    target_text, longest = options.get("target_text", "text"), options.get("longest", LONGEST)
    buckets = options.get("buckets", BUCKETS)
    drawn = importance_draw(docs, target, text, id_col, **options).where("rank IS NOT NULL")
    last = drawn.orderBy(F.desc("rank")).limit(1).select("score", "doc_id").first()
    if last is None:
        return docs.limit(0)
    value = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    out = weighed(docs, value, tuple(spare), text, longest)
    score = F.col(spare[2]) + gumbel(F.col(id_col), options.get("seed", SEED))
    tie = F.lit(True) if last["doc_id"] is None else F.col(id_col) <= F.lit(last["doc_id"])
    stays = (F.col(spare[0]) >= options.get("least_words", LEAST_WORDS)) & (
        (score > last["score"]) | ((score == last["score"]) & tie))
    return out.where(stays).drop(*spare)


ORACLE = f"""
WITH crc AS (SELECT {crc32_sql.table} AS tab),
src AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM src),
f AS (SELECT kind, id, unnest(words || list_transform(range(1, len(words)),
      lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM w),
u AS (SELECT feature, {crc32_sql("feature", "tab")} % {BUCKETS} AS bucket FROM (SELECT DISTINCT feature FROM f), crc),
c AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
      FROM f JOIN u USING (feature) GROUP BY bucket),
z AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM c),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS}) / ((s + 1)::DOUBLE * (t_all + {BUCKETS}))))
      ::BIGINT AS gain FROM c, z),
p AS (SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS total FROM f JOIN u USING (feature) JOIN g USING (bucket)
      WHERE kind = 'd' GROUP BY id),
d AS (SELECT id AS doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
      CASE WHEN n_features IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features
      END::BIGINT AS weight, ('0x' || substr(sha256('{SEED}:' || id), 1, 8))::BIGINT AS h
      FROM w LEFT JOIN p USING (id) WHERE kind = 'd'),
e AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
      count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS able FROM e)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {LEAST_WORDS} AND place <= {SHARE} * able // 100 THEN place END AS rank FROM r
"""


@query("op11_importance_resampling", ORACLE)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark texts, its score and its rank in the draw."""
    return (importance_draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))
