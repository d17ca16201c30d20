"""Spelling variants of words by pivotal grams.

Two words are near if they differ by one inserted, deleted or replaced code point. All bigrams are ordered by rarity
over the distinct words. A word's prefix is its 3 rarest bigrams; one edit touches at most 2 of them, and dynamic
programming chooses the 2 disjoint ones (pivots) with the least total count, of which one edit touches at most one.
If the last gram of a word's prefix is no later in the order than that of a near word, a pivot that stays is in the
near word's prefix. So the pivots look up the prefixes of other words.

Position limits make the look-up selective. Left of the edit both words have the same places counted from the start,
right of it from the end. Either the edit is behind the left pivot, then the words agree up to that pivot and also in
the first or the second half of what follows; or it is not, then they agree from the right pivot to the end and in
one half of what comes before. The keys of the index are these agreements, with both lengths: a bucket holds words
that share more than half their letters. Every pair that meets is verified by its edit distance inside the join, and
no pair is cut off.

Words are counted in each task (``FLUSH`` words at most at a time) before they are shuffled; keys are 64-bit hashes
of text; rarity is one count for each of ``CLASSES`` classes of bigrams, a bound on what is sent to tasks. A root is
found by pointer doubling: counts grow at least ``ratio`` times from a word to its form, so chains are short.

Defined cases: a null text has no words; a missing id counts as an empty one where runs are edited; a word repeated
in the input of ``variants`` counts with the sum of its numbers; words shorter than ``min_length`` are no words;
empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..functions.scratch import materialise
from .common import bounded_batches, crc32_sql, query, table

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO, DROP = 6, 5, 5, 199
GRAM = 2  # code points of a gram
PREFIX = GRAM + 1  # grams of which one edit leaves one at least
FLUSH = 1 << 18  # words a task counts before it sends them on
CLASSES = 1 << 16


def drop_one(runs: list[str], doc_id: int | None, modulus: int = DROP) -> list[str]:
    """The runs, of which those with a CRC of "id:run" that ``modulus`` divides lose one code point."""
    head = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    crc = np.fromiter(map(crc32, map(str.encode, runs), repeat(head)), np.int64, len(runs))
    for i in np.flatnonzero(crc % modulus == 0).tolist():
        run, at = runs[i], int(crc[i]) % len(runs[i])
        runs[i] = run[:at] + run[at + 1:]
    return runs


def word_counts(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_length: int = MIN_LENGTH,
                edit: Callable[[list[str], int | None], list[str]] | None = None) -> DataFrame:
    """(word, n): runs of letters in lower case (A-Z only) with at least ``min_length`` code points.

    ``edit`` may change the runs of a document; it makes none longer.
    """
    bounded_batches(docs.sparkSession)
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")  # a shorter run holds no such match

    def out(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                          names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for doc, body in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist()):
                found = runs.findall(body.lower().decode()) if body else []  # bytes.lower: A-Z only
                seen.update(edit(found, doc) if edit and found else found)
                if len(seen) > FLUSH:
                    yield out(seen)
                    seen = Counter()
        yield out(seen)
    each = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    return each.where(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))


def pivots(grams: list[tuple[int, int]], width: int = GRAM, count: int = 2) -> list[int]:
    """Positions of ``count`` disjoint grams of (position, cost) with the least total cost, by dynamic programming."""
    grams = sorted(grams)
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] * (len(grams) + 1)]
    for _ in range(count):
        row: list[tuple[int, list[int]] | None] = [None]
        for i, (at, cost) in enumerate(grams):
            free = next((j for j in range(i, 0, -1) if grams[j - 1][0] + width <= at), 0)  # grams that end before this
            before = best[-1][free]
            take = before and (before[0] + cost, [*before[1], at])
            row.append(min((x for x in (row[-1], take) if x), default=None))
        best.append(row)
    return best[-1][-1][1]


def _agreements(word: str, at: int, length: int) -> tuple[str, str] | tuple[()]:
    """What a word and a pivot's word of ``length`` share if they agree up to the pivot and in one half of the rest."""
    end, rest = at + GRAM, length - at - GRAM
    if rest < 0:
        return ()
    half = rest // 2
    return f"{at}<{word[:end + half]}", f"{at}>{word[:end]}|{word[len(word) - (rest - half):]}"


def _keys(word: str, left: list[int], right: list[int], lengths: list[tuple[int, int]]) -> list[int]:
    """Keys for grams at places ``left`` (all before them stays) and ``right`` (all behind them stays).

    ``lengths``: of the pivot's word and of the other word.
    """
    mirror, out = word[::-1], []
    for length, other in lengths:
        for side, w, places in (("L", word, left), ("R", mirror, [len(word) - GRAM - p for p in right])):
            for p in places:
                for k in _agreements(w, p, length):
                    out.append(xxh64_intdigest(f"{side}{length},{other},{k}") - (1 << 63))
    return out


def signature(word: str, counts: list[int]) -> tuple[str, list[int], list[int]]:
    """(the last prefix gram in the order, keys of the pivots, keys of the prefix)."""
    grams = [word[i:i + GRAM] for i in range(len(word) - GRAM + 1)]
    cost = {g: counts[crc32(g.encode()) % CLASSES] for g in set(grams)}
    order = sorted(range(len(grams)), key=lambda i: (cost[grams[i]], grams[i], i))
    last = grams[order[PREFIX - 1]]
    two = pivots([(i, cost[grams[i]]) for i in order[:PREFIX]])
    # An edit makes at most GRAM new grams, so a gram that is among a word's first PREFIX copies is among these.
    index = [i for i in order[:2 * PREFIX + GRAM] if (cost[grams[i]], grams[i]) <= (cost[last], last)]
    n = len(word)
    return (f"{cost[last]:020d}{last}", _keys(word, two[:1], two[-1:], [(n, n + d) for d in (-1, 0, 1)]),
            _keys(word, index, index, [(n + d, n) for d in (-1, 0, 1)]))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of near words; ``words`` has (word, n), each word once."""
    if min_length < PREFIX + 1:
        raise ValueError(f"two disjoint bigrams in every prefix need at least {PREFIX + 1} code points")
    spark = words.sparkSession
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - GRAM + 1),
                                 lambda i: F.crc32(F.substring(F.col("word"), i, F.lit(GRAM))) % CLASSES))
    counts = [0] * CLASSES
    for r in words.select(gram.alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect():  # CLASSES rows
        counts[r["c"]] = r["n"]
    shared = spark.sparkContext.broadcast(counts)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        for b in batches:
            got = [signature(w, now) for w in b.column(0).to_pylist()]
            last, probe, index = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(last, pa.string()), pa.array(probe, pa.list_(pa.int64())),
                 pa.array(index, pa.list_(pa.int64()))], names=["word", "n", "last", "probe", "index"])

    signed = materialise(words.select("word", "n").mapInArrow(
        sign, "word string, n long, last string, probe array<long>, index array<long>"))
    a = signed.select(F.explode(F.array_distinct("probe")).alias("key"), F.col("word").alias("a"), F.col("n").alias("an"),
                      F.col("last").alias("al"))
    b = signed.select(F.explode(F.array_distinct("index")).alias("key"), F.col("word").alias("b"), F.col("n").alias("bn"),
                      F.col("last").alias("bl"))
    met = a.join(b, (a.key == b.key) & (F.col("al") <= F.col("bl")) & (F.levenshtein("a", "b", 1) == 1))
    one, two = F.struct(F.col("a").alias("word"), F.col("an").alias("n")), F.struct(F.col("b").alias("word"), F.col("bn").alias("n"))
    pair = met.select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y")).distinct()
    both = F.explode(F.array(F.struct(F.col("x").alias("p"), F.col("y").alias("q")),
                             F.struct(F.col("y").alias("p"), F.col("x").alias("q"))))
    return pair.select(both.alias("d")).select(F.col("d.p.word").alias("word"), F.col("d.p.n").alias("n"),
                                               F.col("d.q.word").alias("near"), F.col("d.q.n").alias("near_n"))


def follow(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form of each chain, by pointer doubling; chains have no cycles."""
    now = materialise(links.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("via"), F.col("root").alias("to"))
        later = materialise(now.join(step, now.root == step.via, "left")
                            .select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")))
        now = later.select("word", "root")
        if later.where("moved").limit(1).count() == 0:
            return now


def variants(words: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n)."""
    words = materialise(words.where(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n")))
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near"))
    near = (near_words(words, min_length).groupBy(F.col("word").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    joined = words.join(near, F.col("word") == F.col("w"), "left")
    found = F.when(-F.col("best.least") >= ratio * F.col("n"), F.col("best"))
    known = materialise(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                      found["near"].alias("form"), (-found["least"]).alias("form_n")))
    roots = follow(known.where("form IS NOT NULL")).withColumnRenamed("word", "w")
    return (known.join(roots, F.col("word") == F.col("w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


ORACLE = f"""
WITH RECURSIVE crc AS (SELECT {crc32_sql.table} AS tab),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
u AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
h AS (SELECT run, n, {crc32_sql("doc_id || ':' || run", "tab")} AS h FROM u, crc),
e AS (SELECT n, CASE WHEN h % {DROP} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
      ELSE run END AS word FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= {MIN_LENGTH} GROUP BY word
      HAVING sum(n) >= {MIN_COUNT}),
d AS (SELECT word, pos, left(word, pos) || substr(word, pos + 2) AS less
      FROM (SELECT word, unnest(range(length(word))) AS pos FROM v)),
p AS (SELECT DISTINCT a.word AS word, b.word AS near FROM d a JOIN d b ON a.pos = b.pos AND a.less = b.less
      AND length(a.word) = length(b.word) AND a.word <> b.word
      UNION SELECT DISTINCT d.word, less FROM d JOIN v w ON w.word = d.less
      UNION SELECT DISTINCT less, d.word FROM d JOIN v w ON w.word = d.less),
g AS (SELECT p.word, count(*) AS n_near, min({{'least': -m.n, 'near': p.near}}) AS best FROM p
      JOIN v m ON m.word = p.near GROUP BY p.word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.least >= {RATIO} * v.n THEN best.near END AS form,
      CASE WHEN -best.least >= {RATIO} * v.n THEN -best.least END AS form_n FROM v LEFT JOIN g USING (word)),
t AS (SELECT word, word AS root, form AS next FROM f
      UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON f.word = t.next)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t ON f.word = t.word WHERE t.next IS NULL
"""


@query("op12_spelling_variants", ORACLE)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word that occurs often enough, with its form, the root of its chain and its number of near words."""
    words = word_counts(table(spark, sf_dir, "documents"), edit=drop_one).where(F.col("n") >= MIN_COUNT)
    return variants(words)
