"""Second-order boosted trees of many folds and settings, grown together from histograms.

A *design* is one set of encoded rows with a role each: fitted on, watched for early stopping, or only scored. Columns are cut
into at most ``BINS`` bins: at each value of the design's fit rows where those are few, else at their quantiles. Every design has any number of models. One
level of the current tree of all models is one job: each task adds the gradients and curvatures of its rows by open node,
column and bin, the sums meet by model, and the driver picks the splits from them. What it receives is
models x nodes x columns x bins and does not grow with the rows; where the sums of all tasks together are at most ``_DIRECT``
numbers, they come without the exchange. The loss of the watched rows comes with the
first level of the next tree, so a model that stops early never grows its later trees.

A row's raw scores are stored with it and brought up to date every ``EVERY`` trees; the trees in between are applied where
the row is read. Gradients are summed as integers, so a fit does not depend on how the rows are dealt out.

The loss is the weighted log loss: a positive weighs ``positive``, a negative 1; the watched loss has no weights. A leaf is
-rate * G / (H + 1), a split needs a curvature of ``least`` on both sides. Rows and columns of a tree are drawn by hash
of the row id and the tree's number. A missing or not-a-number value sorts behind all others. Without fit rows there is no split.
"""

from __future__ import annotations

import statistics
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scratch import materialise

FIT, WATCH, SCORE = 1, 2, 0
BINS = 256
EVERY = 40
ROWS = 2048  # rows of a block
PENALTY = 1.0
LEAST_GAIN = 1e-6
_DIRECT = 1 << 22
_UNIT = 24  # bits behind the point of summed gradients


@dataclass
class Tree:
    """A heap: node i has the children 2i + 1 (bin at most ``cut``) and 2i + 2; ``feature`` -1 is a leaf."""

    depth: int
    feature: np.ndarray = field(default=None, repr=False)
    cut: np.ndarray = field(default=None, repr=False)
    value: np.ndarray = field(default=None, repr=False)
    gain: np.ndarray = field(default=None, repr=False)

    def __post_init__(self):
        size = (2 << self.depth) - 1
        self.feature, self.cut = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.value, self.gain = np.zeros(size), np.zeros(size)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node each row has come to."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            f = self.feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (bins[rows, np.maximum(f, 0)] > self.cut[at]), at)
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins)]


@dataclass
class Boosted:
    """Settings of a model and, after ``fit``, its trees, the watched loss after each, and the best number of trees."""

    design: int
    rate: float = 0.01
    depth: int = 3
    trees: int = 100
    positive: float = 1.0
    patience: int | None = None
    rows: float = 0.9
    columns: float = 0.9
    least: float = 2.0
    grown: list[Tree] = field(default_factory=list, repr=False)
    losses: list[float] = field(default_factory=list, repr=False)
    best: int = 0


@dataclass
class Binned:
    """Stored rows with their bins, and the cuts of each design's columns."""

    rows: DataFrame
    cuts: dict[int, list[np.ndarray]]


def roles(fit_rows: DataFrame, watched: DataFrame | None = None, scored: DataFrame | None = None) -> list:
    """The parts of a design."""
    return [(df, role) for df, role in ((fit_rows, FIT), (watched, WATCH), (scored, SCORE)) if df is not None]


def binned(parts: dict[int, list[tuple[DataFrame, int]]]) -> Binned:
    """{design: ``roles(...)``} of frames with row id, label and a ``features`` vector -> rows with bins."""
    out = None
    for design, own in parts.items():
        for rows, role in own:
            one = rows.select(F.lit(design).alias("design"), F.lit(role).alias("role"), F.col(S.ROW_ID).cast("long").alias("id"),
                              F.col(S.LABEL).cast("int").alias("y"), vector_to_array("features").alias("x"))
            out = one if out is None else out.unionByName(one)
    out = materialise(out)
    probs = [i / (BINS - 1) for i in range(BINS - 1)]
    long = (out.where(F.col("role") == FIT).select("design", F.posexplode("x").alias("j", "v"))
            .where("v IS NOT NULL AND NOT isnan(v)"))
    found = long.groupBy("design", "j").agg(F.percentile_approx("v", F.lit(probs), 20 * BINS).alias("c"),
                                            F.approx_count_distinct("v", 0.02).alias("n")).collect()
    few = [10**6 * r["design"] + r["j"] for r in found if r["n"] <= 1.2 * BINS]
    values: dict[tuple[int, int], list[float]] = {}
    if few:
        for r in long.where((10**6 * F.col("design") + F.col("j")).isin(few)).distinct().collect():
            values.setdefault((r["design"], r["j"]), []).append(r["v"])
    widths = {r[0]: r[1] for r in out.groupBy("design").agg(F.max(F.size("x"))).collect()}
    cuts = {d: [np.zeros(0)] * w for d, w in widths.items()}
    for r in found:
        own = values.get((r["design"], r["j"]), [])
        cuts[r["design"]][r["j"]] = np.unique(np.array(own if 0 < len(own) < BINS else r["c"]))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for design, part in _by_design(b):
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                bins = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts[design])], axis=1).astype(np.uint8)
                body = pa.array([r.tobytes() for r in bins], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in ("design", "role", "id", "y")), body],
                                                 names=["design", "role", "id", "y", "bins"])
    kind = "design int, role int, id bigint, y int, bins binary"
    return Binned(materialise(out.mapInArrow(cut_up, kind).withColumn("key", F.xxhash64("id"))), cuts)


def _by_design(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    of = b.column("design").to_numpy(zero_copy_only=False)
    for design in np.unique(of):
        own = b.filter(pa.array(of == design))
        for at in range(0, own.num_rows, ROWS):
            yield int(design), own.slice(at, ROWS)


def _mix(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(keys: np.ndarray, number: int, share: float) -> np.ndarray:
    """Which keys the tree of this number takes."""
    seed = np.uint64((number + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return (_mix(keys.view(np.uint64) + seed) >> np.uint64(11)) < share * 2.0**53


def drawn_columns(count: int, number: int, share: float) -> np.ndarray:
    """The columns that the tree of this number may use."""
    order = np.argsort(_mix(np.arange(count, dtype=np.uint64) + np.uint64((number + 7) * 0xD1B54A32D192ED03 & (2**64 - 1))))
    return np.sort(order[:max(1, int(share * count))])


def _content(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(bins, labels, roles, keys) of the rows."""
    bins = np.frombuffer(b"".join(part.column("bins").to_pylist()), np.uint8).reshape(part.num_rows, -1)
    return (bins, *(part.column(n).to_numpy(zero_copy_only=False) for n in ("y", "role", "key")))


def _raw(part: pa.RecordBatch, bins: np.ndarray, pending: list[list[Tree]]) -> np.ndarray:
    """(rows, models) raw scores: the stored ones and the trees since."""
    raw = np.zeros((part.num_rows, len(pending)))
    if "raw" in part.schema.names:
        raw += part.column("raw").flatten().to_numpy(zero_copy_only=False).reshape(raw.shape)
    for m, trees in enumerate(pending):
        for t in trees:
            raw[:, m] += t.predict(bins)
    return raw


def _level(rows: DataFrame, live: list[tuple[int, int, Boosted]], pending: dict, growing: dict, level: int,
           number: int, unit: int, tasks: int, widths: dict[int, int]) -> dict[int, np.ndarray]:
    """{model: sums}: the loss of the watched rows and their number, then (nodes, columns, bins, 2) gradients and curvatures.

    ``live``: (model, its place in the design, the model). All numbers are integers of 2**-unit.
    """
    settings = [(i, at, m.design, m.positive, m.rows) for i, at, m in live]
    shared = rows.sparkSession.sparkContext.broadcast((settings, pending, growing))
    scale = float(1 << unit)
    kind = "model int, body binary"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, before, trees = shared.value
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            for design, part in _by_design(b):
                own = [s for s in models if s[2] == design]
                if not own:
                    continue
                bins, y, role, key = _content(part)
                raw = _raw(part, bins, before[design])
                width, first = bins.shape[1], (1 << level) - 1
                for i, at, _, positive, share in own:
                    if i not in acc:
                        acc[i] = np.zeros(2 + (1 << level) * width * BINS * 2, np.int64)
                    z = raw[:, at]
                    if level == 0:
                        seen = role == WATCH
                        loss = np.logaddexp(0, z[seen]) - y[seen] * z[seen]
                        acc[i][:2] += np.rint(loss * scale).astype(np.int64).sum(), seen.sum()
                    node = trees[i].nodes(bins) - first
                    use = np.flatnonzero((role == FIT) & (node >= 0) & _drawn(key, number, share))
                    p = 1 / (1 + np.exp(-np.clip(z[use], -700, 700)))
                    w = np.where(y[use] == 1, positive, 1.0)
                    cell = ((node[use, None] * width + np.arange(width)) * BINS + bins[use]).ravel()
                    for k, v in enumerate((w * (p - y[use]), w * p * (1 - p))):
                        got = np.bincount(cell, np.repeat(np.rint(v * scale), width), (1 << level) * width * BINS)
                        acc[i][2 + k::2] += got.astype(np.int64)
        if acc:
            yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int32()), pa.array([a.tobytes() for a in acc.values()],
                                                                                        pa.binary())], names=["model", "body"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            for i, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = np.frombuffer(body, np.int64)
                acc[i] = acc[i] + got if i in acc else got
        if acc:
            yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int32()), pa.array([a.tobytes() for a in acc.values()],
                                                                                        pa.binary())], names=["model", "body"])
    designs = sorted({m.design for _, _, m in live})
    found = rows.where(F.col("design").isin(designs)).mapInArrow(scan, kind)
    if tasks * sum((1 << level) * widths[m.design] * BINS * 2 for _, _, m in live) > _DIRECT:
        found = found.repartition(min(len(live), 64), "model").mapInArrow(add, kind)
    out: dict[int, np.ndarray] = {}
    for r in found.collect():
        got = np.frombuffer(r["body"], np.int64)
        out[r["model"]] = out[r["model"]] + got if r["model"] in out else got
    shared.unpersist()
    return out


def _split(tree: Tree, level: int, cells: np.ndarray, columns: np.ndarray, m: Boosted, unit: int) -> bool:
    """Split the open nodes of a level at the largest gain; the first column and lowest cut win ties. True: some split."""
    nodes = 1 << level
    sums = cells.reshape(nodes, -1, BINS, 2).astype(float) / (1 << unit)
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:, :]
    right = total - left

    def worth(s):
        return s[..., 0] ** 2 / (s[..., 1] + PENALTY)
    gain = worth(left) + worth(right) - worth(total)
    gain[(left[..., 1] < m.least) | (right[..., 1] < m.least)] = -np.inf
    barred = np.setdiff1d(np.arange(gain.shape[1]), columns)
    gain[:, barred] = -np.inf
    best = gain.reshape(nodes, -1).argmax(axis=1)
    some = False
    for n in range(nodes):
        f, c = divmod(int(best[n]), BINS)
        at, top = nodes - 1 + n, gain[n, f, c]
        if level == 0:
            tree.value[0] = -m.rate * total[0, 0, 0, 0] / (total[0, 0, 0, 1] + PENALTY)
        if top > LEAST_GAIN:
            some = True
            tree.feature[at], tree.cut[at], tree.gain[at] = f, c, top
            for child, s in ((2 * at + 1, left[n, f, c]), (2 * at + 2, right[n, f, c])):
                tree.value[child] = -m.rate * s[0] / (s[1] + PENALTY)
    return some


def fit(data: Binned, models: list[Boosted]) -> list[Boosted]:
    """Grow all models; a model with ``patience`` stops when the watched loss has not fallen for so many trees."""
    for m in models:
        m.grown, m.losses, m.best = [], [], 0
    places = {d: [i for i, m in enumerate(models) if m.design == d] for d in sorted({m.design for m in models})}
    pending = {d: [[] for _ in own] for d, own in places.items()}
    rows, number = data.rows, 0
    count = rows.where(F.col("role") == FIT).groupBy("design").count().agg(F.max("count")).first()[0] or 0
    heaviest = max([1.0, *(m.positive for m in models)])
    unit = min(_UNIT, 61 - int(np.ceil(np.log2(max(2.0, 16 * count * heaviest)))))  # sums stay below 2**62
    widths, tasks = {d: len(c) for d, c in data.cuts.items()}, rows.rdd.getNumPartitions()
    live = [(i, own.index(i), models[i]) for own in places.values() for i in own]
    while live:
        growing = {i: Tree(m.depth) for i, _, m in live}
        open_ = live
        for level in range(max(m.depth for _, _, m in live)):
            open_ = [(i, at, m) for i, at, m in open_ if level < m.depth]
            got = _level(rows, open_, pending, growing, level, number, unit, tasks, widths) if open_ else {}
            if level == 0:
                for i, _, m in live:
                    if number and i in got and got[i][1]:
                        m.losses.append(got[i][0] / got[i][1] / (1 << unit))
                        if m.losses[-1] < m.losses[m.best - 1] or m.best == 0:
                            m.best = number
                stay = [(i, at, m) for i, at, m in live if number < m.trees
                        and not (m.patience and m.losses and number - m.best >= m.patience)]
                open_ = [x for x in open_ if x in stay]
                live = stay
            open_ = [(i, at, m) for i, at, m in open_ if i in got
                     and _split(growing[i], level, got[i][2:], drawn_columns(len(data.cuts[m.design]), number, m.columns), m, unit)]
        for i, at, m in live:
            m.grown.append(growing[i])
            pending[m.design][at].append(growing[i])
        number += 1
        if live and number % EVERY == 0:
            rows = _updated(rows, pending)
            tasks = rows.rdd.getNumPartitions()
            pending = {d: [[] for _ in own] for d, own in places.items()}
    for m in models:
        m.best = m.best if m.losses else len(m.grown)
    return models


def frozen_count(data: Binned, positive: dict[int, float], cap: int = 4000, patience: int = 50,
                 **settings) -> tuple[int, list[int], list[int]]:
    """Number of trees = int(1.1 * median over the designs of the early-stopped tree).

    ``positive``: the weight of a positive in each design. Also returns each design's tree and the
    designs whose watched loss was still falling at the cap.
    """
    models = fit(data, [Boosted(d, trees=cap, positive=w, patience=patience, **settings) for d, w in positive.items()])
    best = [m.best for m in models]
    return int(statistics.median(best) * 1.1), best, [m.design for m in models if m.best > cap - patience]


def _updated(rows: DataFrame, pending: dict) -> DataFrame:
    """The rows with their raw scores brought up to date."""
    shared = rows.sparkSession.sparkContext.broadcast(pending)
    names = ["design", "role", "id", "y", "bins", "key"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for design, part in _by_design(b):
                if design not in shared.value:
                    continue
                raw = _raw(part, _content(part)[0], shared.value[design])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * raw.shape[1], pa.int32()), pa.array(raw.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), lists], names=[*names, "raw"])
    return materialise(rows.mapInArrow(apply, "design int, role int, id bigint, y int, bins binary, key bigint, raw array<double>"))


def scores(data: Binned, models: list[Boosted], counts: list[int] | None = None) -> DataFrame:
    """(model, fold, row id, label, role, score): probabilities of every row of a model's design after each number of trees.

    Without ``counts`` a model takes its best number; with them there is a column n_trees too.
    """
    shared = data.rows.sparkSession.sparkContext.broadcast([(m.design, m.grown, counts or [m.best]) for m in models])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for design, part in _by_design(b):
                bins, y, role, _ = _content(part)
                n = len(bins)
                for i, (of, trees, wanted) in enumerate(shared.value):
                    if of != design:
                        continue
                    raw = np.zeros(n)
                    for k in range(max(wanted) + 1):
                        if k in wanted:
                            cols = [np.full(n, i, np.int32), np.full(n, design, np.int32), part.column("id"), part.column("y"),
                                    part.column("role"), np.full(n, k, np.int32), 1 / (1 + np.exp(-np.clip(raw, -700, 700)))]
                            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols],
                                                             names=["model", "fold", S.ROW_ID, S.LABEL, "role", "n_trees", "score"])
                        if k < min(len(trees), max(wanted)):
                            raw = raw + trees[k].predict(bins)
    kind = f"model int, fold int, {S.ROW_ID} bigint, {S.LABEL} int, role int, n_trees int, score double"
    return data.rows.mapInArrow(apply, kind)


def column_gains(m: Boosted, names: list[str]) -> list[tuple[str, int, float]]:
    """(column, number of splits, mean gain) of the best number of trees; a column without a split has 0."""
    total, count = np.zeros(len(names)), np.zeros(len(names), int)
    for t in m.grown[:m.best]:
        used = t.feature >= 0
        np.add.at(total, t.feature[used], t.gain[used])
        np.add.at(count, t.feature[used], 1)
    return [(n, int(c), float(g / c) if c else 0.0) for n, c, g in zip(names, count, total)]
