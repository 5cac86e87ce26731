"""Histogram boosting of regression trees as Spark jobs (the fitting side of M2-M5).

MLlib's tree learner samples, sorts and bins all features anew for every tree, and its boosting
has one loss and no patience.  Here features are cut into bins once: a written table holds blocks
of rows, one byte a feature, feature by feature; they are held in memory, and on disk beyond it,
while passes go over them.  A tree level is one job: tasks add up weights and
pseudo-residuals of training rows by (node, feature, bin), ``TOGETHER`` features at a time (weights at
the root, the same for all trees, once), the sums meet by ``CHUNK``
features, and the best cut of each node among them comes back - a few numbers whatever the number of rows.  The model so far is applied to the bins in
the same pass, so a round leaves no table and no longer plan behind, a lost executor costs its
tasks, and the losses of a round come with the first level of the next.  Of many rows most features
are ruled out by a job before (``_screen``): two features are added up at once and only rows of the lighter of
two siblings, the other is what is left of their parent.  Such sums round otherwise, so every feature
that comes near the best gain of a node is added up by the pass itself, which alone decides: the
trees are those of passes over all features.  The fitted trees become
an MLlib ``GBTRegressionModel``, which scores, saves and loads in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cellhealth.session import drop_stage, held_conf, write_stage

#: Rows that the cuts of a feature are taken from at most (a draw by key), and rows of a block.
SAMPLE_ROWS, BLOCK_ROWS = 10_000, 4096
#: Rows that are binned at once: their doubles fit a core's cache.
BIN_ROWS = 512
#: Rows of a partition beyond which more partitions are made.
PARTITION_ROWS = 1 << 16
#: Features whose sums meet in one group, and tasks that share the groups of a pass.
CHUNK, GROUP_TASKS = 64, 8
#: Features of a block that are added up at once, and bytes of decisions held while a model is applied:
#: what a core's cache holds.
TOGETHER, HELD_BYTES = 12, 1 << 22
#: Training rows from which on features are ruled out first: below, a job more costs more than it saves.
SCREEN_ROWS = 500_000
#: Share of a node's sums that a gain may be off the best and still count as near it: far above what the order of
#: additions changes.  Bins of a feature up to which two features are added up at once, and rows added up at once.
NEAR, PAIR_BINS, SCREEN_BLOCK = 1e-7, 64, 1 << 15


@dataclass(eq=False)
class Tree:
    """Nodes as in a heap: 1 is the root, 2 i and 2 i + 1 the children of i; feature -1: a leaf."""
    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)
    total: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 << self.depth
        self.feature, self.cut = np.full(n, -1), np.zeros(n, np.int64)
        self.weight, self.total, self.gain = np.zeros(n), np.zeros(n), np.zeros(n)

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row (a column of ``bins``) after so many levels."""
        at, rows = np.ones(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(levels):
            f = self.feature[at]
            inner = f >= 0
            right = bins[np.maximum(f, 0), rows] > self.cut[at]
            at = np.where(inner, 2 * at + right, at)
        return at

    def split(self, node: int, feature: int, cut: int, gain: float, left: tuple[float, float]) -> None:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain / self.weight[node]
        for child, (w, s) in ((2 * node, left), (2 * node + 1, (self.weight[node] - left[0], self.total[node] - left[1]))):
            self.weight[child], self.total[child] = w, s


@dataclass
class Binned:
    """Rows of a fit, binned, written and held: blocks of (is_val, the columns, one byte a feature; all
    rows of a feature lie together)."""
    frame: DataFrame
    cuts: list[np.ndarray]
    columns: list[str]
    features: str
    n_train: int = 0

    def __post_init__(self):
        self.frame.persist(StorageLevel.MEMORY_AND_DISK)

    def drop(self) -> None:
        self.frame.unpersist()
        drop_stage(self.frame)


def _cuts(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds between neighbouring values: all of them, or those at even shares of the rows."""
    own, counts = np.unique(values, return_counts=True)
    mids = own[:-1] + (own[1:] - own[:-1]) / 2
    if len(mids) < max_bins:
        return mids
    at = np.searchsorted(np.cumsum(counts), np.arange(1, max_bins) * len(values) / max_bins)
    return mids[np.unique(np.minimum(at, len(mids) - 1))]


def bin_rows(train_val: DataFrame, columns: Sequence[str], keys: Sequence[str], max_bins: int,
             partitions: int, features: str = "features", validation: str = "is_val") -> Binned:
    """Cut points from training rows, then every row's bins beside its ``columns``, written once.

    Rows are dealt and ordered by their keys, so that a fit depends on neither files nor cores.
    """
    columns = list(columns)
    rows = train_val.select(*keys, F.col(validation).cast("boolean").alias("_val"),
                            *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)],
                            vector_to_array(features).alias("_x"))
    n = {r["_val"]: r["n"] for r in rows.groupBy("_val").agg(F.count("*").alias("n")).collect()}
    share = min(1.0, SAMPLE_ROWS / max(1, n.get(False, 0)))
    drawn = rows.filter(~F.col("_val")).filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))

    def columns_of(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("_x"), batch.num_rows)
                yield pa.RecordBatch.from_pydict({"f": np.arange(x.shape[1], dtype=np.int32),
                                                  "values": [x[:, f].tobytes() for f in range(x.shape[1])]})

    def cut(table: pa.Table) -> pa.Table:
        values = np.concatenate([np.frombuffer(v, np.float64) for v in table.column("values").to_pylist()])
        return pa.table({"f": table.column("f").slice(0, 1), "cuts": [_cuts(values, max_bins)]})

    got = drawn.select("_x").mapInArrow(columns_of, "f int, values binary").groupBy("f").applyInArrow(
        cut, "f int, cuts array<double>").collect()
    cuts = [np.array(r["cuts"]) for r in sorted(got, key=lambda r: r["f"])]

    def binned(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BIN_ROWS):
                part = batch.slice(at, BIN_ROWS)
                x = _matrix(part.column("_x"), part.num_rows)
                bins = np.empty(x.shape[::-1], np.uint8)
                for f, c in enumerate(cuts):
                    bins[f] = np.searchsorted(c, x[:, f], side="left")
                own = [r.tobytes() for r in np.ascontiguousarray(bins.T)]
                yield pa.RecordBatch.from_arrays([*map(part.column, kept.names), pa.array(own, pa.binary())],
                                                 names=[*kept.names, "_bins"])

    def blocks(batches):
        held, size = [], 0

        def block():
            own = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            out = {"val": np.asarray(own.column("_val"))} | {
                c: np.asarray(own.column(f"_{c}"), np.float64) for c in (f"c{i}" for i in range(len(columns)))}
            bins = np.frombuffer(b"".join(own.column("_bins").to_pylist()), np.uint8).reshape(own.num_rows, -1)
            return pa.RecordBatch.from_pydict({k: [v.tobytes()] for k, v in out.items()} | {"bins": [bins.T.tobytes()]})

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                if size and size + part.num_rows > BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if size:
            yield block()

    tasks = max(partitions, -(-sum(n.values()) // PARTITION_ROWS))
    # Rows are binned where they lie: a byte a feature is moved and sorted, not a double.
    kept = rows.drop("_x").schema
    small = rows.mapInArrow(binned, StructType([*kept.fields, StructField("_bins", BinaryType())]))
    dealt = small.repartition(tasks, *keys).sortWithinPartitions(*keys)
    schema = "val binary, " + "".join(f"c{i} binary, " for i in range(len(columns))) + "bins binary"
    held = dealt.mapInArrow(blocks, schema).withColumn("part", F.spark_partition_id())
    return Binned(write_stage(held, "bins"), cuts, columns, features, n.get(False, 0))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(n, -1)


@dataclass(eq=False)
class Fit:
    """One model in the making: what it learns, from which features, and its trees so far."""
    label: str
    weight: str | None = None
    delta: float | None = None              # of the Huber loss; None: squared
    chosen: Sequence[int] | None = None     # the features it may use; None: all
    trees: list[Tree] = field(default_factory=list)
    losses: list[tuple[float, float, float, float]] = field(default_factory=list)
    root: np.ndarray | None = None          # weights of all rows by feature and bin, once added up
    base: np.ndarray | None = None          # rows (and weights) of the root as the screen adds them up
    sums: dict[int, np.ndarray] = field(default_factory=dict)   # what the screen knows of a level's nodes


def predict(trees: Sequence[Tree], bins: np.ndarray, step: float) -> np.ndarray:
    """The model so far on binned rows: the first tree in full, each further by ``step``.

    All decisions of some trees are taken for all rows, then the ones on each row's path are picked.
    """
    n = bins.shape[1]
    if not trees:
        return np.zeros(n)
    depth, out = trees[0].depth, np.empty((n, len(trees)))
    inner = np.arange(1, 1 << depth)
    some = max(1, HELD_BYTES // max(1, n << depth))
    for first in range(0, len(trees), some):
        own = trees[first:first + some]
        # Node by node, of all these trees: what holds at an early leaf holds at all places below it.
        feature = np.stack([t.feature for t in own])
        value = np.stack([t.total / np.where(t.weight > 0, t.weight, 1.0) for t in own])
        for i in inner:
            leaf = feature[:, i] < 0
            for child in (2 * i, 2 * i + 1):
                value[leaf, child], feature[leaf, child] = value[leaf, i], -1
        cut = np.stack([t.cut for t in own]).clip(0, 255).astype(np.uint8)
        at, sides = np.zeros((len(own), n), np.min_scalar_type(1 << depth)), []
        for level in range(depth):
            right = [bins[np.maximum(feature[:, i], 0)] > cut[:, i, None] for i in range(1 << level, 2 << level)]
            for side in sides:
                half = len(right) // 2
                right = [a ^ (side & (a ^ b)) for a, b in zip(right[:half], right[half:], strict=True)]
            sides.append(right[0])
            at = 2 * at + right[0]
        for i in range(len(own)):
            out[:, first + i] = value[i, 1 << depth:][at[i]] * (step if first + i else 1.0)
    return out.sum(axis=1)


def _sums(bins: np.ndarray, node: np.ndarray, n_nodes: int, width: int, weight: np.ndarray | None,
          target: np.ndarray, both: bool = True) -> np.ndarray:
    """(2, nodes, features, bins): weights (None: rows) and targets of a block added up, without
    ``both`` (1, ...): targets; rows at node ``n_nodes`` have no part in them."""
    dims, n = bins.shape
    kinds = [weight, target] if both else [target]
    size, out = (n_nodes + 1) * width, np.empty((len(kinds), n_nodes, dims, width))
    base = np.arange(TOGETHER)[:, None] * size + node * width
    where = np.empty((TOGETHER, n), np.intp)
    twice = [w if w is None else np.tile(w, TOGETHER) for w in kinds]
    for f in range(0, dims, TOGETHER):
        k = min(TOGETHER, dims - f)
        np.add(base[:k], bins[f:f + k], out=where[:k])
        at = where[:k].ravel()
        for i, w in enumerate(twice):
            got = np.bincount(at, None if w is None else w[:k * n], k * size).reshape(k, n_nodes + 1, width)
            out[i, :, f:f + k] = got[:, :n_nodes].transpose(1, 0, 2)
    return out


def _target(y: np.ndarray, pred: np.ndarray, first: bool, delta: float | None) -> np.ndarray:
    """What the next tree is fitted on: the label, later the negative gradient of the loss."""
    return y if first else y - pred if delta is None else np.clip(y - pred, -delta, delta)


def _loss(e: np.ndarray, delta: float | None) -> np.ndarray:
    a = np.abs(e)
    return e * e if delta is None else np.where(a <= delta, 0.5 * e * e, delta * (a - 0.5 * delta))


def _drawn(seed: int, n_trees: int, part: int, n: int, rate: float) -> np.ndarray:
    """Which rows of a block a tree is fitted on."""
    return np.random.default_rng([seed, n_trees, part, n]).random(n) < rate


def _codes(bins: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Bins of two features as one number (one feature, if it has many bins), and how many there may be."""
    if width > PAIR_BINS:
        return bins, width
    if len(bins) % 2:
        bins = np.concatenate([bins, np.zeros_like(bins[:1])])
    return bins[::2] * np.uint16(width) + bins[1::2], width * width


def _code_sums(codes: np.ndarray, slot: np.ndarray, n_slots: int, span: int, kinds: list[np.ndarray | None]) -> np.ndarray:
    """(kinds, codes, slots * span): each of ``kinds`` (None: rows) added up by slot and code."""
    out, at = np.empty((len(kinds), len(codes), n_slots * span)), np.empty(len(slot), np.intp)
    base = slot * np.intp(span)
    for p, own in enumerate(codes):
        np.add(base, own, out=at)
        for k, w in enumerate(kinds):
            out[k, p] = np.bincount(at, w, n_slots * span)
    return out


def _by_feature(sums: np.ndarray, n_slots: int, dims: int, width: int) -> np.ndarray:
    """(kinds, slots, features, bins) of ``_code_sums``."""
    kinds, n_codes = sums.shape[:2]
    if width > PAIR_BINS:
        return sums.reshape(kinds, dims, n_slots, width).swapaxes(1, 2)
    pairs = sums.reshape(kinds, n_codes, n_slots, width, width)
    both = np.stack([pairs.sum(axis=4), pairs.sum(axis=3)], axis=2)
    return both.reshape(kinds, 2 * n_codes, n_slots, width)[:, :dims].swapaxes(1, 2)


def _near(known: dict[int, np.ndarray], cuts: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """Those of ``chosen`` (in its order) with a gain near the best of any node; ``known``: by node, (rows,
    weights if rows have them, targets) by feature and bin."""
    width = max(len(c) for c in cuts) + 1
    real = np.arange(width) < np.array([len(cuts[f]) for f in chosen])[:, None]
    near = np.zeros(len(chosen), bool)
    for sums in known.values():
        if not np.isfinite(sums).all():
            return chosen
        n, w, s = sums[0][chosen], sums[-2][chosen], sums[-1][chosen]
        nl, wl, sl = n.cumsum(axis=1), w.cumsum(axis=1), s.cumsum(axis=1)
        n, w, s = (x.sum(axis=1, keepdims=True) for x in (n, w, s))
        fine = (nl > 0) & (n - nl > 0) & real
        with np.errstate(invalid="ignore", divide="ignore"):
            least = s ** 2 / w
            gain = np.where(fine, sl ** 2 / wl + (s - sl) ** 2 / (w - wl) - least, -np.inf)
        if not fine.any():
            near[0] = True
        elif np.isfinite(gain[fine]).all():
            gain = gain.max(axis=1)
            near |= gain >= gain.max() - NEAR * (abs(gain.max()) + least.max())
        else:       # rows without weight
            return chosen
    return chosen[near]


def _screen(rows: Binned, fits: list[tuple[Fit, Tree]], level: int, step: float, rate: float, seed: int
            ) -> list[np.ndarray]:
    """For each fit, the features that may hold the best cut of a node of this level, found by one job.

    What comes back is the sums of lighter siblings by feature and bin, whatever the number of rows.
    """
    cuts, width = rows.cuts, max((len(c) for c in rows.cuts), default=0) + 1
    dims, at_column = len(cuts), {c: f"c{i}" for i, c in enumerate(rows.columns)}
    own, light = [], []
    for fit, tree in fits:
        parents = [p for p in range((1 << level) >> 1, 1 << level) if p and tree.feature[p] >= 0]
        nodes = [2 * p + int(tree.weight[2 * p + 1] < tree.weight[2 * p]) for p in parents] if level else [1]
        slot = np.full(2 << tree.depth, -1)
        slot[nodes] = np.arange(len(nodes))
        light.append(nodes)
        own.append((at_column[fit.label], at_column.get(fit.weight), fit.delta, [t for t in fit.trees if t is not tree],
                    tree, slot, len(nodes), level > 0 or rate < 1.0 or fit.base is None))
    together = level == 0 and rate >= 1.0       # all fits have all rows in one node

    def sums(batches):
        hist, span = [None] * len(own), width
        groups = [list(range(len(own)))] if together else [[m] for m in range(len(own))]
        held = [[] for _ in groups]

        def add_up(g):
            if not held[g]:
                return
            codes, slot, kinds = zip(*held[g], strict=True)
            kinds = [None if k[0] is None else np.concatenate(k) for k in zip(*kinds, strict=True)]
            n_slots = max(own[m][6] for m in groups[g])
            got = _code_sums(np.concatenate(codes, axis=1), np.concatenate(slot), n_slots, span, kinds)
            held[g], first = [], 0
            for m in groups[g]:
                n = 1 if not own[m][7] else 2 if own[m][1] is None else 3
                part, first = _by_feature(got[first:first + n], n_slots, dims, width), first + n
                hist[m] = part if hist[m] is None else hist[m] + part

        for batch in batches:
            for r in batch.to_pylist():
                val = np.frombuffer(r["val"], np.bool_)
                bins = np.frombuffer(r["bins"], np.uint8).reshape(dims, len(val))
                codes, span = _codes(bins, width)
                train, mine = np.flatnonzero(~val), None
                for m, (label, weight, delta, trees, growing, slots, _, whole) in enumerate(own):
                    y = np.frombuffer(r[label], np.float64)
                    w = None if weight is None else np.frombuffer(r[weight], np.float64)
                    target = _target(y, predict(trees, bins, step), not trees, delta)
                    target = target if w is None else target * w
                    if together:
                        use, slot = train, None
                    else:
                        slot = slots[growing.nodes(bins, level)]
                        here = (slot >= 0) & ~val
                        use = np.flatnonzero(here if rate >= 1.0 else
                                             here & _drawn(seed, len(trees), r["part"], len(y), rate))
                    kinds = ([None] + ([] if w is None else [w[use]]) if whole else []) + [target[use]]
                    if not together:
                        held[m].append((codes.take(use, axis=1), slot[use], kinds))
                        if sum(len(h[1]) for h in held[m]) >= SCREEN_BLOCK:
                            add_up(m)
                    elif mine is None:
                        mine = (codes.take(use, axis=1), np.zeros(len(use), np.intp), kinds)
                    else:
                        mine[2].extend(kinds)
                if mine is not None:
                    held[0].append(mine)
                    if sum(len(h[1]) for h in held[0]) >= SCREEN_BLOCK:
                        add_up(0)
        for g in range(len(groups)):
            add_up(g)
        out = [(m, f, np.ascontiguousarray(h[:, :, f:f + CHUNK]).tobytes())
               for m, h in enumerate(hist) if h is not None for f in range(0, dims, CHUNK)]
        if out:
            yield pa.RecordBatch.from_pydict({"m": pa.array([o[0] for o in out], pa.int32()),
                                              "f": pa.array([o[1] for o in out], pa.int32()), "sums": [o[2] for o in out]})

    def total(table: pa.Table) -> pa.Table:
        added = sum(np.frombuffer(s, np.float64) for s in table.column("sums").to_pylist())
        return pa.table({"m": table.column("m").slice(0, 1), "f": table.column("f").slice(0, 1), "sums": [added.tobytes()]})

    # The order of additions is free here: few tasks, so few sums to move.
    few = rows.frame.coalesce(2 * rows.frame.sparkSession.sparkContext.defaultParallelism)
    with held_conf(rows.frame.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):
        got = few.mapInArrow(sums, "m int, f int, sums binary").repartition(GROUP_TASKS, "m", "f").groupBy(
            "m", "f").applyInArrow(total, "m int, f int, sums binary").collect()
    found = [[] for _ in own]
    for r in sorted(got, key=lambda r: r["f"]):
        found[r["m"]].append(np.frombuffer(r["sums"], np.float64).reshape(
            -1, own[r["m"]][6], min(CHUNK, dims - r["f"]), width))
    near = []
    for (fit, _), nodes, parts, (*_, whole) in zip(fits, light, found, own, strict=True):
        chosen = np.arange(dims) if fit.chosen is None else np.asarray(fit.chosen)
        if not parts:                           # no training rows
            near.append(chosen)
            continue
        parts = np.concatenate(parts, axis=2)
        if level == 0:
            if not whole:
                parts = np.concatenate([fit.base, parts])
            elif rate >= 1.0:
                fit.base = parts[:-1]
            fit.sums = {1: parts[:, 0]}
        else:
            lighter = {node: parts[:, i] for i, node in enumerate(nodes)}
            fit.sums = lighter | {node ^ 1: fit.sums[node // 2] - x for node, x in lighter.items()}
        near.append(_near(fit.sums, cuts, chosen))
    return near


def _pass(rows: Binned, fits: list[tuple[Fit, Tree]], level: int, step: float, rate: float, seed: int,
          only: list[np.ndarray] | None = None) -> list[tuple[dict, np.ndarray]]:
    """One job for one level of the trees that all ``fits`` grow; ``only``: by the features that each may cut.

    For each: {node: (feature, cut, gain, left weight, left sum, weight, sum)}, and loss sums of the
    model so far, (rows, w * loss, squared error) of training and of validation rows (level 0).
    """
    cuts, width = rows.cuts, max((len(c) for c in rows.cuts), default=0) + 1
    dims, n_nodes = len(cuts), 1 << level
    at_column = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    chosen = [None if f.chosen is None else np.asarray(f.chosen) for f, _ in fits] if only is None else only
    own = [(at_column[f.label], at_column.get(f.weight), f.delta, [t for t in f.trees if t is not tree], tree, mine,
            f.root if level == 0 and rate >= 1.0 and only is None else None)
           for (f, tree), mine in zip(fits, chosen, strict=True)]

    def sums(batches):
        hist, losses, part = [None] * len(own), np.zeros((len(own), 2, 3)), None
        for batch in batches:
            for r in batch.to_pylist():
                val = np.frombuffer(r["val"], np.bool_)
                bins = np.frombuffer(r["bins"], np.uint8).reshape(dims, len(val))
                part = r["part"] if part is None else part
                train = np.flatnonzero(~val)
                some = bins if len(train) == len(val) or only is not None else bins.take(train, axis=1)
                for m, (label, weight, delta, trees, growing, chosen, root) in enumerate(own):
                    y = np.frombuffer(r[label], np.float64)
                    w = np.ones(len(y)) if weight is None else np.where(val, 1.0, np.frombuffer(r[weight], np.float64))
                    if level == 0:
                        pred = predict(trees, bins, step)
                        e = y - pred
                        for k, side in enumerate((~val, val)):
                            losses[m, k] += side.sum(), (w * _loss(e, delta))[side].sum(), (e * e)[side].sum()
                        pred = pred[train]
                    else:
                        pred = predict(trees, some, step)
                    at = growing.nodes(some, level) - n_nodes
                    mine = some if chosen is None else some[chosen]
                    if len(at) > len(train):
                        at, mine, pred = at[train], mine.take(train, axis=1), pred if level == 0 else pred[train]
                    use = (at >= 0) & (at < n_nodes)  # a leaf above this level has no part in it
                    if rate < 1.0:
                        use &= _drawn(seed, len(trees), r["part"], len(y), rate)[train]
                    w = w[train]
                    target = np.where(use, _target(y[train], pred, not trees, delta) * w, 0.0)
                    got = _sums(mine, np.where(use, at, n_nodes), n_nodes, width,
                                None if weight is None else w, target, root is None)
                    hist[m] = got if hist[m] is None else hist[m] + got
        if part is None:
            return
        out = [(m, -1, losses[m].tobytes()) for m in range(len(own))]
        out += [(m, f, np.ascontiguousarray(h[:, :, f:f + CHUNK]).tobytes())
                for m, h in enumerate(hist) for f in range(0, h.shape[2], CHUNK)]
        yield pa.RecordBatch.from_pydict({"m": pa.array([o[0] for o in out], pa.int32()),
                                          "f": pa.array([o[1] for o in out], pa.int32()),
                                          "part": pa.array([part] * len(out), pa.int32()), "sums": [o[2] for o in out]})

    def best(table: pa.Table) -> pa.Table:
        """Of each node the best cut among CHUNK features (equal gains: the first)."""
        m, first = table.column("m")[0].as_py(), table.column("f")[0].as_py()
        parts = sorted(zip(table.column("part").to_pylist(), table.column("sums").to_pylist(), strict=True))
        total = sum(np.frombuffer(s, np.float64) for _, s in parts)
        if first < 0:
            return pa.table(_cells([(m, -1, -1, i, 0.0, float(v), 0.0, 0.0, 0.0) for i, v in enumerate(total)], None))
        *_, chosen, root = own[m]
        chosen = (np.arange(dims) if chosen is None else chosen)[first:first + CHUNK]
        hist = total.reshape(1 + (root is None), n_nodes, len(chosen), width)
        if root is not None:
            hist = np.concatenate([root[None, None, first:first + CHUNK], hist])
        (wl, sl), (w, s) = hist.cumsum(axis=3), hist.sum(axis=3)[:, :, :, None]
        real = np.arange(width) < np.array([len(cuts[f]) for f in chosen])[:, None]
        fine = (wl > 0) & (w - wl > 0) & real
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = np.where(fine, sl ** 2 / wl + (s - sl) ** 2 / (w - wl) - s ** 2 / w, -1.0).reshape(n_nodes, -1)
        out = []
        for node, k in enumerate(gain.argmax(axis=1)):
            f, cut = divmod(int(k), width)
            out.append((m, int(chosen[f]), cut, node, float(gain[node, k]), float(wl[node, f, cut]),
                        float(sl[node, f, cut]), float(w[node, f, 0]), float(s[node, f, 0])))
        return pa.table(_cells(out, hist[0].tobytes() if level == 0 and root is None and rate >= 1.0 and only is None
                               else None, first))

    partial = rows.frame.mapInArrow(sums, "m int, f int, part int, sums binary")
    # A batch is one block: blocks are large.
    with held_conf(rows.frame.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):
        got = partial.repartition(GROUP_TASKS, "m", "f").groupBy("m", "f").applyInArrow(
            best, "m int, f int, cut int, node int, gain double, wl double, sl double, w double, s double, "
                  "first int, root binary").collect()
    losses, found, roots = np.zeros((len(own), 6)), [{} for _ in own], [[] for _ in own]
    for r in sorted(got, key=lambda r: (r["first"], r["f"])):
        if r["root"] is not None:
            roots[r["m"]].append(np.frombuffer(r["root"], np.float64).reshape(-1, width))
        if r["f"] < 0:
            losses[r["m"], r["node"]] = r["wl"]
        elif r["node"] not in found[r["m"]] or r["gain"] > found[r["m"]][r["node"]][2]:  # equal: the first feature
            found[r["m"]][r["node"]] = (r["f"], r["cut"], r["gain"], r["wl"], r["sl"], r["w"], r["s"])
    for (fit, _), own_roots in zip(fits, roots, strict=True):
        if own_roots:
            fit.root = np.concatenate(own_roots)
    return [(f, x.reshape(2, 3)) for f, x in zip(found, losses, strict=True)]


def _cells(rows: list[tuple], root: bytes | None, first: int = -1) -> dict:
    names = ("m", "f", "cut", "node", "gain", "wl", "sl", "w", "s")
    kinds = [pa.int32()] * 4 + [pa.float64()] * 5
    cells = {n: pa.array(c, k) for n, c, k in zip(names, zip(*rows, strict=True), kinds, strict=True)}
    return cells | {"first": pa.array([first] * len(rows), pa.int32()),
                    "root": pa.array([root] + [None] * (len(rows) - 1), pa.binary())}


def losses_of(sums: np.ndarray) -> tuple[float, float, float, float]:
    """(loss, val_loss, rmse, val_rmse); a side without rows gives nan."""
    with np.errstate(invalid="ignore", divide="ignore"):
        loss, rmse = sums[:, 1] / sums[:, 0], np.sqrt(sums[:, 2] / sums[:, 0])
    return float(loss[0]), float(loss[1]), float(rmse[0]), float(rmse[1])


def boost(rows: Binned, fits: Sequence[Fit], depth: int, step: float, ended: Callable[[Fit], bool],
          rate: float = 1.0, seed: int = 42) -> None:
    """Grow the trees of all ``fits`` side by side, one job a level for all of them.

    ``ended`` is asked before each round of a fit, when the losses of its trees so far are
    known; True leaves the tree of that round, and all after it, unfitted.
    """
    active, screened = list(fits), rows.n_train >= SCREEN_ROWS
    while active:
        growing = [(f, Tree(depth)) for f in active]
        for level in range(max(1, depth)):
            # The tree that grows is no part of the model yet.
            only = _screen(rows, growing, level, step, rate, seed) if screened and depth else None
            got, deeper = _pass(rows, growing, level, step, rate, seed, only), []
            for (fit, tree), (found, sums) in zip(growing, got, strict=True):
                if level == 0:
                    if fit.trees:
                        fit.losses.append(losses_of(sums))
                    if ended(fit):
                        active.remove(fit)
                        continue
                    fit.trees.append(tree)
                    if 0 in found:
                        tree.weight[1], tree.total[1] = found[0][5:]
                cut = [(node, *x) for node, x in found.items() if depth and x[2] > 1e-12 * abs(x[5]) > 0]
                for node, f, at, gain, wl, sl, _, _ in cut:  # a gain within rounding of none splits nothing
                    tree.split(node + (1 << level), f, at, gain, (wl, sl))
                if cut:
                    deeper.append((fit, tree))
            growing = deeper
            if not growing:
                break


def to_model(trees: Sequence[Tree], cuts: Sequence[np.ndarray], step: float, features: str,
             chosen: Sequence[int] | None = None) -> GBTRegressionModel:
    """The MLlib model of fitted trees: the first in full, each further by ``step``.

    ``chosen``: its vectors hold these features only, in this order.
    """
    place = {f: i for i, f in enumerate(range(len(cuts)) if chosen is None else chosen)}
    sc = SparkContext._active_spark_context
    ml, gateway = sc._jvm.org.apache.spark.ml, sc._gateway

    def node(tree: Tree, i: int):
        w, s = float(tree.weight[i]), float(tree.total[i])
        stats = gateway.new_array(sc._jvm.double, 3)
        stats[0], stats[1], stats[2] = w, s, s * s / w if w > 0 else 0.0
        spread = sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(round(w)))
        mean = s / w if w > 0 else 0.0
        if tree.feature[i] < 0:
            return ml.tree.LeafNode(mean, 0.0, spread)
        f = int(tree.feature[i])
        cut = ml.tree.ContinuousSplit(place[f], float(cuts[f][tree.cut[i]]))
        return ml.tree.InternalNode(mean, 0.0, float(tree.gain[i]), node(tree, 2 * i), node(tree, 2 * i + 1), cut, spread)

    array = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(sc._jvm.double, len(trees))
    for i, tree in enumerate(trees):
        array[i] = ml.regression.DecisionTreeRegressionModel(f"tree_{i}", node(tree, 1), len(place))
        weights[i] = float(step) if i else 1.0
    own = GBTRegressionModel()
    uid = "GBTRegressionModel_" + own.uid.rpartition("_")[2]
    model = GBTRegressionModel(ml.regression.GBTRegressionModel(uid, array, weights, len(place)))
    model._resetUid(uid)
    model._set(featuresCol=features, predictionCol="prediction", stepSize=float(step))
    model._transfer_params_to_java()
    return model
