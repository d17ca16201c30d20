"""MinHash near-dedup with DartMinHash signatures.

A text is the weighted set of its five-word shingles (weight: how often it
occurs). Each unit of weight of a shingle throws darts at hashed, increasing
ranks; only darts below a limit shared by the whole text, about
``ln k + 4`` for each coordinate, are ever made, so a text costs its words plus
its darts, not words times coordinates. Every dart belongs to a hashed
coordinate; the earliest dart of a coordinate is its signature there.
Two texts agree in a coordinate with the probability of their weighted Jaccard
similarity.

Bands of the signature propose pairs, which are checked against the
exact similarity of the shingles. Texts with the same words are one class and
compared once. In a bucket every member meets two of them, the smallest and one drawn by a hash
of member and band, so it meets another one in every band. Where a bucket is then still in
several components, the members outside its largest one meet all others as blocks of matrices inside
tasks: only links that join components become rows. A bucket of thousands of near copies so costs two
rows a member, and no link that joins two components is lost.

Defined cases: words are runs of bytes other than space and 0x09-0x0D, A-Z folded; a text
with 1 to 4 words is one shingle; a null or empty text and a null id
form a class of their own row; repeated rows are copies; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import materialise
from .common import begin, bounded_batches, give_back, from_files, partitions, query, split_key, table
from .splits import MESSAGE, by_split, exchange, load, message, pack, runs, seen, unpack
from .words import mix, shingles, small_batches, word_hashes

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5  # a pair at 0.8 shares no band with a chance of 5e-5
BLOCK = 256  # members of a family that meet at once
COLUMNS = 1 << 13  # units of weight compared at once
SEED = np.uint64(0x5851F42D4C957F2D)


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def _ranked(values: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Each shingle made distinct from the equal ones before it in its text: one unit of weight each."""
    key = mix(values ^ (texts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    same = np.r_[False, key[order][1:] == key[order][:-1]]
    at = np.arange(len(key))
    start = np.maximum.accumulate(np.where(same, 0, at))
    nth = np.empty(len(key), np.uint64)
    nth[order] = (at - start).astype(np.uint64)
    return mix(values + nth * SEED)


def dart_signatures(values: np.ndarray, texts: np.ndarray, n: int, k: int) -> np.ndarray:
    """(n, k) dart ids; the row of a text without shingles is zero."""
    out = np.zeros((n, k), np.uint64)
    weight = np.bincount(texts, minlength=n)
    unit = _ranked(values, texts)
    limit = np.zeros(n)
    np.divide(k * (np.log(k) + 4.0), weight, out=limit, where=weight > 0)
    todo = np.flatnonzero(weight > 0)
    while len(todo):
        wanted = np.zeros(n, bool)
        wanted[todo] = True
        pick = wanted[texts]
        dart, text = unit[pick], texts[pick]
        rank = np.zeros(len(dart))
        ids, where, ranks = [], [], []
        while len(dart):
            dart = mix(dart + SEED)
            rank = rank - np.log(_uniform(dart))
            near = rank <= limit[text]
            dart, text, rank = dart[near], text[near], rank[near]
            if len(dart):
                ids.append(dart)
                where.append(text * k + (mix(dart ^ SEED) % np.uint64(k)).astype(np.int64))
                ranks.append(rank)
        full = np.zeros(n * k, np.uint64)
        if ids:
            ids, where, ranks = np.concatenate(ids), np.concatenate(where), np.concatenate(ranks)
            order = np.lexsort((ids, ranks, where))
            where, ids = where[order], ids[order]
            head = np.r_[True, where[1:] != where[:-1]]
            full[where[head]] = ids[head]
        full = full.reshape(n, k)
        done = (full[todo] != 0).all(axis=1)
        out[todo[done]] = full[todo[done]]
        todo = todo[~done]
        limit[todo] *= 2.0  # later darts only: what was earliest stays earliest
    return out


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(signatures), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(signatures), np.uint64(b + 1))
        for r in range(rows):
            h = mix(h * SEED + signatures[:, b * rows + r])
        out[:, b] = h
    return out


def _fingerprints(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(split, id, n_shingles, same, bands): ``same`` is a digest of the words; null without words."""
    kind = T.StructType([T.StructField("split", T.LongType()), T.StructField("id", T.LongType()),
                         T.StructField("same", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("near")
        for b in small_batches(batches, 2, 1 << 19):
            hashes, first = word_hashes(b.column(2), fold=True)
            raw = hashes.tobytes()
            same = [hashlib.blake2b(raw[8 * a:8 * e], digest_size=16).digest() if e > a else None
                    for a, e in zip(first[:-1].tolist(), first[1:].tolist())]
            got = band_hashes(dart_signatures(*shingles(hashes, first, WIDTH), b.num_rows, bands * rows), bands, rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * bands, pa.int32()),
                                             pa.array(got.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same, pa.binary()), lists],
                                             names=kind.names)
        give_back()
    return docs.select("split", "id", "text").mapInArrow(scan, kind)


def _shingle_sets(docs: DataFrame, wanted: DataFrame, prints: DataFrame) -> DataFrame:
    """(id, body) of the wanted (split, id): sorted distinct shingles and their counts, read from the texts in place.

    ``prints`` has the splits of all rows.
    """
    spark = docs.sparkSession
    listed = T.StructType([T.StructField("split", T.LongType()), T.StructField("id", T.LongType())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, rows in by_split(batches, 0):
            yield message(0, split, pack(np.concatenate(
                [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64) for b in rows])))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for split in b.column(0).to_pylist():
                yield seen(split)

    ids = wanted.select("split", "id").to(listed).repartition(partitions(spark), "split")
    every = prints.select("split").distinct().mapInArrow(met, MESSAGE)
    folder = exchange(ids.sortWithinPartitions("split").mapInArrow(gather, MESSAGE).union(every),
                      lambda part, rows: iter(rows), lambda bodies: pack(np.concatenate(
                          [unpack(x, 1)[0] for x in bodies])))
    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("body", T.BinaryType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("near")
        for split, rows in by_split(batches, 0):
            found = load(folder, split, 1)
            if found is None:
                continue
            for b in rows:
                here = b.column(0).to_numpy(zero_copy_only=False)
                b = b.filter(pa.array(np.isin(here, found[0])))
                for part in small_batches(iter([b]), 1, 1 << 19):
                    values, texts = shingles(*word_hashes(part.column(1), fold=True), WIDTH)
                    order = np.lexsort((values, texts))
                    values, bounds = values[order], np.searchsorted(texts[order], np.arange(part.num_rows + 1))
                    bodies = [np.stack([x.astype(np.uint64) for x in
                                        np.unique(values[a:e], return_counts=True)]).tobytes()
                              for a, e in zip(bounds, bounds[1:])]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bodies, pa.binary())],
                                                     names=kind.names)
    return docs.where("id IS NOT NULL").select("split", "id", "text").mapInArrow(scan, kind)


def weighted_jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64).reshape(2, -1), np.frombuffer(b, np.uint64).reshape(2, -1)
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(x[1][i], y[1][j]).sum())
    return both / max(1, int(x[1].sum() + y[1].sum()) - both)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity is high enough."""
    kind = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [weighted_jaccard(x, y) >= similarity for x, y in zip(b.column(2).to_pylist(),
                                                                      b.column(3).to_pylist())]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    left = sets.select(F.col("id").alias("a"), F.col("body").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("body").alias("y"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(test, kind))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every linked id; the component is its smallest id.

    Each round every id points to its smallest neighbour, pointers are followed to their ends by
    doubling, and the links are contracted to the ends; at most half of the ids are left, and stars vanish at once.
    """
    edges = materialise(_pairs(links, "a", "b").distinct())
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        ends = materialise(both.groupBy(F.col("a").alias("id"))
                           .agg(F.min(F.least("a", "b")).alias("parent")))
        while True:
            up = ends.select(F.col("id").alias("parent"), F.col("parent").alias("further"))
            moved = materialise(ends.join(up, "parent").select(
                "id", F.col("further").alias("parent"), (F.col("further") < F.col("parent")).alias("moved")))
            ends = moved.select("id", "parent")
            if not moved.where("moved").limit(1).count():
                break
        if labels is None:
            labels = ends.withColumnRenamed("parent", "component")
        else:
            labels = materialise(labels.join(ends.withColumnRenamed("id", "component"), "component", "left")
                                 .select("id", F.coalesce("parent", "component").alias("component")))
        left = ends.withColumnsRenamed({"id": "a", "parent": "x"})
        right = ends.withColumnsRenamed({"id": "b", "parent": "y"})
        edges = materialise(_pairs(edges.join(left, "a").join(right, "b"), "x", "y").distinct())
        if not edges.limit(1).count():
            return labels


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _units(body: bytes) -> np.ndarray:
    """A weighted set as one distinct hash for each unit of weight."""
    values, counts = np.frombuffer(body, np.uint64).reshape(2, -1)
    counts = counts.astype(np.int64)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix(np.repeat(values, counts) + nth.astype(np.uint64) * SEED)


def _common(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """(xs, ys) sizes of the intersections, by matrix products over some thousand units at a time."""
    units = np.intersect1d(np.concatenate(xs), np.concatenate(ys))
    out = np.zeros((len(xs), len(ys)), np.float64)
    for at in range(0, len(units), COLUMNS):
        part = units[at:at + COLUMNS]

        def rows(sets: list[np.ndarray]) -> np.ndarray:
            m = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                spot = np.minimum(np.searchsorted(part, s), len(part) - 1)
                m[i, spot[part[spot] == s]] = 1.0
            return m
        out += rows(xs) @ rows(ys).T
    return out


def joining_links(xs: list[tuple], ys: list[tuple], similarity: float) -> list[tuple[int, int]]:
    """Similar pairs of (id, component, body) that join components: as many as the components need, no more."""
    a, b = [_units(r[2]) for r in xs], [_units(r[2]) for r in ys]
    both = _common(a, b)
    total = np.array([len(u) for u in a])[:, None] + np.array([len(u) for u in b])[None, :] - both
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.setdefault(c, c) != c:
            root[c] = c = root[root[c]]
        return c
    out = []
    for i, j in np.argwhere(both >= similarity * np.maximum(total, 1)).tolist():
        p, q = find(xs[i][1]), find(ys[j][1])
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((min(xs[i][0], ys[j][0]), max(xs[i][0], ys[j][0])))
    return out


def _open_links(shared: DataFrame, comp: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between components that meet in a bucket, found without a row for each pair.

    Buckets that share members form a family; its members outside the largest component of some bucket
    meet all its members, block by block, as matrices inside a task.
    """
    spark = shared.sparkSession
    known = (shared.where("size > 2").select("band", "h", "rep", "least")
             .join(comp, F.col("rep") == F.col("id"), "left")
             .select("band", "h", "rep", "least", F.coalesce("component", "rep").alias("component")))
    parted = known.groupBy("band", "h", "component").agg(F.count(F.lit(1)).alias("n"))
    main = materialise(parted.groupBy("band", "h").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("band", "h", "main"))
    opened = materialise(known.join(main, ["band", "h"]))
    family = components(_pairs(opened, "rep", "least")).withColumnsRenamed({"id": "rep", "component": "family"})
    members = materialise(opened.groupBy("rep").agg(
        F.any_value("component").alias("component"), F.bool_or(F.col("component") != F.col("main")).alias("outside"))
        .join(family, "rep"))
    wide = materialise(members.groupBy("family").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks")))
    placed = materialise(members.join(wide, "family")
                         .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
                         .join(sets.withColumnRenamed("id", "rep"), "rep"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = placed.where("outside").select("family", F.col("block").alias("bx"), every.alias("by"),
                                          F.lit(0).alias("side"), "rep", "component", "body")
    right = placed.select("family", every.alias("bx"), F.col("block").alias("by"), F.lit(1).alias("side"),
                          "rep", "component", "body")
    kind = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, 0):
            xs, ys = [r[2:] for r in rows if r[1] == 0], [r[2:] for r in rows if r[1] == 1]
            found = joining_links(xs, ys, similarity) if xs and ys else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=kind.names)
    key = F.struct("family", "bx", "by")
    return (left.union(right).repartition(partitions(spark), "family", "bx", "by")
            .sortWithinPartitions("family", "bx", "by", "side")
            .select(F.to_json(key).alias("key"), "side", "rep", "component", "body").mapInArrow(meet, kind))


def near_duplicate_classes(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                           similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id_col, class_id, rep_id): class_id is the smallest id of the connected near copies.

    ``rep_id`` is the smallest id with the same words.
    """
    bounded_batches(docs.sparkSession)
    docs = from_files(docs)
    tagged = docs.select(split_key().alias("split"), F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    prints = materialise(_fingerprints(tagged, bands, rows))
    known = prints.where("same IS NOT NULL AND id IS NOT NULL")
    reps = materialise(known.groupBy("same").agg(
        F.min(F.struct("id", "split")).alias("r"), F.any_value("bands").alias("bands"))
        .select("same", F.col("r.id").alias("rep"), F.col("r.split").alias("split"), "bands"))

    places = reps.select("rep", "split", F.posexplode("bands").alias("band", "h"))
    # Stored, so that joins with the rows of a bucket can split a hot one over tasks.
    first = materialise(places.groupBy("band", "h").agg(
        F.min("rep").alias("least"), F.min_by("rep", F.xxhash64("rep", "band")).alias("drawn"),
        F.count(F.lit(1)).alias("size")).where("size > 1"))
    shared = materialise(places.join(first, ["band", "h"]).select("band", "h", "rep", "split", "least", "drawn", "size"))
    sets = materialise(_shingle_sets(tagged, shared.select("split", F.col("rep").alias("id")).distinct(), prints))
    met = _pairs(shared, "rep", "least").union(_pairs(shared, "rep", "drawn")).distinct()
    links = materialise(_verified(met, sets, similarity))
    comp = components(links)

    found = materialise(_open_links(shared, comp, sets, similarity))
    if found.limit(1).count():
        comp = components(links.union(found))

    labelled = (reps.select("same", F.col("rep").alias("rep_id"))
                .join(comp.select(F.col("id").alias("rep_id"), "component"), "rep_id", "left")
                .select("same", "rep_id", F.coalesce("component", "rep_id").alias("class_id")))
    placed = known.select("same", F.col("id").alias(id_col)).join(labelled, "same")
    alone = prints.where("same IS NULL OR id IS NULL").select(
        F.col("id").alias(id_col), F.col("id").alias("class_id"), F.col("id").alias("rep_id"))
    return placed.select(id_col, "class_id", "rep_id").unionByName(alone)


@query("op7_minhash_near_dedup")
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class of near copies and the copy that stands for its text."""
    return near_duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
