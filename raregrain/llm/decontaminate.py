"""Benchmark decontamination as a prefix-filtered set join, in Spark expressions only.

An item is cut into windows of ``width`` words (a shorter item is one window), a window into shingles of ``SHINGLE``
words. A text contains a window only if it contains all of the window's shingles, so a prefix of one shingle is
enough to find every candidate: the rarest one, by its count over all documents. The prefix shingles meet the
documents' shingles by hash; the place of the shingle in the window gives the place where the window must start, and
what would start before the text or end after it is dropped. What is left is compared word by word with the text.

How it is dealt out: the documents' shingles leave the scan as (row, place, hash) and only those of the benchmark
stay; each is kept once for the counts and for the candidates. Spark broadcasts the benchmark's tables where their
stored size allows and else joins by sorted hashes, whose hot values adaptive execution splits. Rows are known by
file and row number, so repeated or missing ids do no harm. Texts are read again for the documents that have
candidates. Window and item lists meet as relations; only one document's own hits are ever put into one row.

Defined cases: a null or empty text has no words and no hits; an item without words has no window; an item without
an id marks words but is not listed; items with equal windows are all listed; repeated rows count on their own;
empty tables give no rows or no hits; extra columns stay, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import fresh, from_files, query, table
from .exact import normalised

WIDTH = 10  # words of a window
SHINGLE = 3  # words of a shingle; a window of fewer words is its own shingle
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words, after lower-casing A-Z
RAW_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before lower-casing


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(normalised(text), BREAK), "")


def _starts(n: Column, width: Column | int) -> Column:
    """0 ... n - width, or nothing."""
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))


def _shingles(rows: DataFrame, words: str, width: int) -> DataFrame:
    """The other columns with the place ``pos`` and the hash ``h`` of every run of ``width`` words.

    The runs are zipped from shifted slices, so that the hash is compiled code over exploded rows.
    """
    shifted = [F.slice(words, k + 1, F.size(words)).alias(f"w{k}") for k in range(width)]
    rest = [c for c in rows.columns if c != words]
    return (rows.where(F.size(words) >= width)
            .select(*rest, (F.size(words) - width).alias("last"), F.posexplode(F.arrays_zip(*shifted)).alias("pos", "z"))
            .where(F.col("pos") <= F.col("last"))
            .select(*rest, "pos", F.xxhash64(*[F.col(f"z.w{k}") for k in range(width)]).alias("h")))


def item_windows(items: DataFrame, text: str, item_id: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, win) and which items have them (wid, item)."""
    words = F.col("words")
    size = F.least(F.size(words), F.lit(width))
    each = (items.select(F.col(item_id).alias("item"), words_of(F.col(text)).alias("words")).where(F.size(words) > 0)
            .select("item", F.explode(F.transform(_starts(F.size(words), size),
                                                  lambda i: F.slice(words, i + 1, size))).alias("win")).distinct())
    each = materialise(each)
    windows = materialise(each.select("win").distinct().withColumn("wid", F.monotonically_increasing_id()))
    return windows, materialise(each.join(windows, "win").select("wid", "item"))


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` (first and last word of each run of hit words) and ``items``.

    ``items`` are the ids of the items that have a window in the text, each once. Columns of ``docs`` with these
    names are replaced.
    """
    docs = from_files(docs)
    windows, members = item_windows(items, item_text, item_id, width)
    sized = windows.withColumn("n_win", F.size("win")).withColumn("w", F.least("n_win", F.lit(SHINGLE)))
    of_window = materialise(reduce(DataFrame.unionByName, [
        _shingles(sized.where(F.col("w") == w), "win", w) for w in range(1, SHINGLE + 1)]).withColumnRenamed("pos", "offset"))
    known = materialise(of_window.select("h").distinct())
    key = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    parsed = docs.select(*key, words_of(F.col(text)).alias("words"))
    widths = [r["w"] for r in of_window.select("w").distinct().collect()] or [SHINGLE]  # SHINGLE numbers at most
    numbered = parsed.withColumn("n_words", F.size("words"))
    found = reduce(DataFrame.unionByName, [_shingles(numbered, "words", w).join(known, "h") for w in sorted(widths)])
    found = materialise(found)  # occurrences of the benchmark's shingles

    # Order the shingles of a window by rarity over all documents; the first is its necessary prefix.
    counts = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    prefix = materialise(of_window.join(counts, "h").groupBy("wid", "n_win")
                         .agg(F.min(F.struct("n", "h", "offset")).alias("first"))
                         .select("wid", "n_win", F.col("first")["h"].alias("h"), F.col("first")["offset"].alias("offset")))
    start = F.col("pos") - F.col("offset")
    possible = (found.join(prefix, "h").where((start >= 0) & (start + F.col("n_win") <= F.col("n_words")))
                .select("file", "row", start.alias("start"), "wid"))
    # The words of a window go with its candidates; a document's candidates are about as long as its text.
    per_row = materialise(possible.join(windows, "wid").groupBy("file", "row")
                          .agg(F.collect_list(F.struct("start", "wid", "win")).alias("may")))
    sure = F.filter("may", lambda c: F.slice(F.col("words"), c["start"] + 1, F.size(c["win"])) == c["win"])
    places = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "sure", lambda c: F.sequence(c["start"], c["start"] + F.size(c["win"]) - 1)))))
    at = F.col("places")
    firsts = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
    lasts = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) != p + 1))
    hits = materialise(parsed.join(per_row, ["file", "row"]).withColumn("sure", sure).where(F.size("sure") > 0)
                       .select("file", "row", places.alias("places"),
                               F.array_distinct(F.transform("sure", lambda c: c["wid"])).alias("wids"))
                       .select("file", "row", "wids", F.size(at).alias("n_hit"),
                               F.arrays_zip(firsts.alias("first"), lasts.alias("last")).alias("spans")))
    listed = (hits.select("file", "row", F.explode("wids").alias("wid")).join(members, "wid")
              .groupBy("file", "row").agg(F.collect_set("item").alias("items")))
    hits = materialise(hits.drop("wids").join(listed, ["file", "row"], "left"))

    new = ["n_words", "n_hit", "spans", "items"]
    own = [c for c in docs.columns if c.lower() not in new]
    f, r = fresh(docs, "file"), fresh(docs, "row")
    count = fresh(docs, "n_words")
    rows = docs.select(*[F.col(f"`{c}`") for c in own], key[0].alias(f), key[1].alias(r),
                       F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), RAW_BREAK), "")).cast("long").alias(count))
    some = hits.select(F.col("file").alias(f), F.col("row").alias(r), *[F.col(c).alias(fresh(docs, c)) for c in new[1:]])
    spans, listed = fresh(docs, "spans"), fresh(docs, "items")
    return rows.join(some, [f, r], "left").select(
        *[F.col(f"`{c}`") for c in own], F.col(count).alias("n_words"),
        F.coalesce(fresh(docs, "n_hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(spans, F.array().cast(some.schema[spans].dataType)).alias("spans"),
        F.coalesce(listed, F.array().cast(some.schema[listed].dataType)).alias("items"))


ORACLE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
j AS (SELECT item_id, words, least(len(words), {WIDTH}) AS n, unnest(range(1, len(words) - least(len(words), {WIDTH}) + 2))
      AS pos FROM i WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(words[pos:pos + n - 1], ' ') AS w FROM j),
p AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM win)
      WHERE len(words) >= n),
q AS (SELECT doc_id, n, pos, array_to_string(words[pos:pos + n - 1], ' ') AS w FROM p),
o AS (SELECT doc_id, item_id, n, pos FROM q JOIN win USING (n, w)),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) FROM o) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)
"""


@query("op13_decontamination", ORACLE)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: how many of its words stand in windows of benchmark items, and whose."""
    out = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
