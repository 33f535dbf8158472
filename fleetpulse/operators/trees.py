"""Forests and boosted trees for Spark ML, grown level by level from histograms of binned inputs.

Settings, thresholds, gains, leaves and pruning are those of Spark ML's classifiers, and what is fitted is
one of its models. Rows are kept as one byte per input and histograms are counted by numpy, many rows a
step; a level of all trees that grow together is one job over the rows. Only histograms leave a task.

Two things are not Spark ML's: a forest's bootstrap counts and input subsets are drawn by chunk, tree and
node, so they are other draws of the same distributions, and of gains that agree to nine places the first
input and the least threshold count, where Spark ML takes the one that rounding favours.
"""

import json
import math
import os
import sys
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from fleetpulse.session import settle, shared_folder

# Tasks get the functions themselves: a worker needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that are handled at once, chunks of them in a partition, joint bins of inputs counted together, rounds between checkpoints.
CHUNK_ROWS = 1 << 17
PART_CHUNKS = 32
JOINT_BINS = 1024
CHECKPOINT_ROUNDS = 20
DRIVER_PARTS = 64  # partitions whose histograms the driver adds up by itself
SAME_GAIN = 1e-9  # relative
PURE = float(np.finfo(float).eps)
NO_GAIN = 1e-12  # relative: rounding alone

#: A node of a growing tree; nodes are numbered from 1, and those below node n are 2n and 2n + 1.
Splits = dict[int, tuple[int, int]]


def fit(estimator: RandomForestClassifier | GBTClassifier, df: DataFrame):
    """The model that ``estimator`` describes, fitted to ``df`` (features, label 0 or 1, weight by label).

    ``df`` is read three times; after that its binned form, stored in the shared folder, is read.
    """
    forest = isinstance(estimator, RandomForestClassifier)
    classes = {r.label: (r.n, r.weight) for r in df.groupBy("label").agg(F.count("*").alias("n"), F.first("weight").alias("weight")).collect()}
    samples = sum(n for n, _ in classes.values())
    if not samples:
        raise ValueError("no rows to train on")
    weights = tuple(float(classes.get(c, (0, 0.0))[1]) for c in (0, 1))
    bins = min(estimator.getMaxBins(), samples)
    weight = sum(n * w for n, w in classes.values())
    edges = thresholds(df, samples, weight, bins, estimator.getSeed())
    cores = df.sparkSession.sparkContext.defaultParallelism
    binned = settle(binned_rows(df, edges, min(CHUNK_ROWS, math.ceil(samples / cores / 2))), "binned")
    chunks = dealt_chunks(binned, cores).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        grow = grown_forest if forest else boosted_trees
        trees = grow(estimator, chunks, edges, weights)
    finally:
        chunks.unpersist()
    return stored_model(estimator, df.sparkSession, trees, edges)


def thresholds(df: DataFrame, samples: int, weight: float, bins: int, seed: int) -> list[np.ndarray]:
    """The thresholds of every input between its bins, from the sample of rows that Spark ML takes."""
    share = max(bins * bins, 10_000) / samples
    spark, sample = df.sparkSession, df.select("features", "weight")
    if share < 1:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        rows = sample._jdf.javaRDD().sample(False, share, draw)
        sample = DataFrame(spark._jsparkSession.createDataFrame(rows, sample._jdf.schema()), spark)
    rows = sample.select(vector_to_array("features").alias("x"), "weight").collect()
    x, w = np.array([r.x for r in rows]), np.array([r.weight for r in rows])
    expected = min(share, 1.0) * weight
    return [input_thresholds(x[:, k], w, expected, bins - 1) for k in range(x.shape[1])]


def input_thresholds(x: np.ndarray, w: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` thresholds that cut one input into shares of even weight.

    Zeros are taken to be what the others lack to the ``expected`` weight, as Spark ML does.
    """
    some = x != 0
    values, place = np.unique(x[some], return_inverse=True)
    held = np.bincount(place, w[some], len(values))
    if len(values) and expected - held.sum() > PURE * some.sum() * 100:
        at = np.searchsorted(values, 0.0)
        values, held = np.insert(values, at, 0.0), np.insert(held, at, expected - held.sum())
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = target = expected / (most + 1)
    cuts, upto = [], held[0]
    for k in range(1, len(values)):
        before, upto = upto, upto + held[k]
        if abs(before - target) < abs(upto - target):
            cuts.append(middle[k - 1])
            target += stride
    return np.array(cuts)


def binned_rows(df: DataFrame, edges: list[np.ndarray], least: int) -> DataFrame:
    """``df`` as chunks of ``least`` rows or more: (chunk, rows, cells), cells being a byte 2 * bin + label by input and row."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []
        schema = pa.schema([("chunk", pa.int64()), ("rows", pa.int32()), ("cells", pa.binary())])

        def chunk() -> pa.RecordBatch:
            cells = np.concatenate(held, axis=1)
            return pa.RecordBatch.from_pylist([{"chunk": (part << 32) + number, "rows": cells.shape[1], "cells": cells.tobytes()}], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            held.append(np.stack([2 * np.searchsorted(e, x[:, k]).astype(np.uint8) + label for k, e in enumerate(edges)]))
            if sum(h.shape[1] for h in held) >= least:
                yield chunk()
                number, held = number + 1, []
        if held:
            yield chunk()

    return df.select(vector_to_array("features").alias("x"), "label").mapInArrow(packed, "chunk long, rows int, cells binary")


def dealt_chunks(binned: DataFrame, cores: int) -> RDD:
    """The chunks, dealt evenly: as many to each of ``cores`` partitions, or to more where each would hold over ``PART_CHUNKS``."""
    places = {r.chunk: k for k, r in enumerate(binned.select("chunk").orderBy("chunk").collect())}
    parts = min(len(places), max(cores, math.ceil(len(places) / PART_CHUNKS)))
    return binned.rdd.map(lambda r: (r.chunk, (r.rows, r.cells))).partitionBy(parts, lambda c: places[c]).map(lambda r: (r[0], *r[1]))


def rows_of_nodes(goes_right: Callable, rows: np.ndarray, splits: Splits, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of the ``wanted`` nodes that have any, in their order."""
    wanted, above = set(wanted), set()
    for node in wanted:
        while node and node not in above:
            above.add(node)
            node >>= 1
    todo = [(1, rows)]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node in wanted:
            yield node, rows
            continue
        right = goes_right(node, rows)
        if 2 * node + 1 in above:
            todo.append((2 * node + 1, rows[right]))
        if 2 * node in above:
            todo.append((2 * node, rows[~right]))


class Tree:
    """What is known of a growing tree: splits, nodes to split, and each node's statistics."""

    def __init__(self) -> None:
        self.splits: Splits = {}
        self.open = [1]
        self.found: dict[int, dict] = {}

    def split(self, node: int, at: tuple[int, int, float], left: dict, right: dict, depth: int) -> list[int]:
        """Split ``node`` (input, bin, gain) and return the nodes below it that may be split."""
        self.splits[node] = at[:2]
        self.found[node]["gain"] = at[2]
        self.found |= {2 * node: left, 2 * node + 1: right}
        return [2 * node, 2 * node + 1] if node.bit_length() < depth else []


def best_splits(gain: np.ndarray, valid: np.ndarray, size: np.ndarray) -> list[tuple[int, int, float] | None]:
    """For every node the place of its input, the bin and the gain of its best split, if any gains more than rounding of ``size``."""
    out = []
    gain = np.where(valid, gain, -1.0)
    for g, i in zip(gain, size, strict=True):
        best = g.max(initial=-1.0)
        if best <= NO_GAIN * i:
            out.append(None)
            continue
        place = int(np.argmax(g >= best * (1 - SAME_GAIN)))
        out.append((*divmod(place, g.shape[1]), float(g.flat[place])))
    return out


# A forest: all trees grow together.

#: Counts of a bootstrap sample, Poisson with mean 1, by 16 random bits.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)])
BOOTSTRAP = np.minimum(np.searchsorted(_POISSON, (np.arange(1 << 16) + 0.5) / (1 << 16)), 8).astype(np.uint8)


def gini(stats: np.ndarray) -> np.ndarray:
    """Impurity of class weights along the last axis; 0 without any."""
    total = stats.sum(-1, keepdims=True)
    return np.where(total[..., 0] > 0, 1 - ((stats / np.where(total > 0, total, 1)) ** 2).sum(-1), 0.0)


def node_inputs(seed: int, tree: int, node: int, inputs: int, some: int) -> list[int]:
    """The inputs that a node of a forest may split by."""
    return np.random.default_rng((seed % 2**64, tree, node)).choice(inputs, some, replace=False).tolist()


def forest_histograms(growing: list[tuple[Splits, dict[int, list[int]]]], inputs: int, width: int, seed: int, bootstrap: bool) -> Callable:
    """Per tree, its rows counted by open node, input and cell, over the chunks of a partition."""

    def counted(chunks: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        held = {t: np.zeros((len(o), len(next(iter(o.values()))), width)) for t, (_, o) in enumerate(growing) if o}
        for number, rows, data in chunks:
            cells = np.frombuffer(data, np.uint8).reshape(inputs, rows)
            for t, total in held.items():
                splits, open_ = growing[t]
                counts = np.ones(rows, np.uint8)
                if bootstrap:
                    counts = BOOTSTRAP.take(np.random.default_rng((seed % 2**64, number, t)).integers(0, 1 << 16, rows, np.uint16))
                place = {node: k for k, node in enumerate(open_)}

                def goes_right(node: int, r: np.ndarray) -> np.ndarray:
                    k, b = splits[node]
                    return cells[k].take(r) > 2 * b + 1

                for node, r in rows_of_nodes(goes_right, np.flatnonzero(counts), splits, open_):
                    times = counts.take(r).astype(float)
                    for i, k in enumerate(open_[node]):
                        total[place[node], i] += np.bincount(cells[k].take(r), times, width)
        yield from held.items()

    return counted


def forest_splits(open_: dict[int, list[int]], counts: np.ndarray, weights: tuple[float, float], cuts: list[int]) -> list[tuple]:
    """(node, its statistics, split, left and right statistics) of every open node of a tree."""
    raw = counts.reshape(*counts.shape[:2], -1, 2)
    stats = raw * np.array(weights)
    left, whole = stats.cumsum(2), stats.sum(2, keepdims=True)
    left_n, whole_n = raw.sum(-1).cumsum(2), raw.sum((-1, 2))[..., None]
    right = whole - left
    impurity, share = gini(whole[:, 0, 0]), left.sum(-1) / np.maximum(whole.sum(-1), PURE)
    gain = impurity[:, None, None] - share * gini(left) - (1 - share) * gini(right)
    bins = np.arange(gain.shape[2])
    valid = (left_n > 0) & (left_n < whole_n) & (bins < np.array([[cuts[k] for k in ks] for ks in open_.values()])[..., None])
    out = []
    for k, (node, best) in enumerate(zip(open_, best_splits(gain, valid, impurity), strict=True)):

        def found(s: np.ndarray, n: float) -> dict:
            return {"stats": s.tolist(), "raw": int(n), "impurity": float(gini(s)), "prediction": float(np.argmax(s))}

        me = found(whole[k, 0, 0], whole_n[k, 0, 0])
        if best is None:
            out.append((node, me, None, None, None))
            continue
        i, b, g = best
        below = found(left[k, i, b], left_n[k, i, b]), found(right[k, i, b], whole_n[k, i, 0] - left_n[k, i, b])
        out.append((node, me, (open_[node][i], b, g), *below))
    return out


def grown_forest(estimator: RandomForestClassifier, chunks: RDD, edges: list[np.ndarray], weights: tuple[float, float]) -> list[tuple[Tree, float]]:
    """The trees of a forest, each with weight 1."""
    number, depth, seed, inputs = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed(), len(edges)
    # Spark ML's choice by itself: all inputs for one tree, else the root of their number.
    some = inputs if number == 1 else math.ceil(math.sqrt(inputs))
    bootstrap, cuts = estimator.getBootstrap(), [len(e) for e in edges]
    width = 2 * (max(cuts) + 1)
    trees = [Tree() for _ in range(number)]
    parts = min(number, chunks.ctx.defaultParallelism)
    while any(t.open for t in trees):
        growing = [(t.splits, {n: node_inputs(seed, k, n, inputs, some) for n in t.open}) for k, t in enumerate(trees)]
        counted = chunks.mapPartitions(forest_histograms(growing, inputs, width, seed, bootstrap)).reduceByKey(np.add, parts)

        def split(item: tuple[int, np.ndarray], growing=growing) -> tuple[int, list[tuple]]:
            return item[0], forest_splits(growing[item[0]][1], item[1], weights, cuts)

        done = counted.map(split).collect()
        for k, nodes in done:
            tree = trees[k]
            tree.open = []
            for node, me, at, left, right in nodes:
                tree.found[node] = me
                if at:
                    below = tree.split(node, at, left, right, depth)
                    tree.open += [n for n in below if tree.found[n]["impurity"] >= PURE]
    return [(t, 1.0) for t in trees]


# Boosted trees: one after the other.


def joint_inputs(cuts: list[int]) -> list[list[int]]:
    """Inputs in groups that have at most ``JOINT_BINS`` bins together; those with no threshold have no group."""
    groups: list[tuple[int, list[int]]] = []
    for k in sorted((k for k, c in enumerate(cuts) if c), key=lambda k: -cuts[k]):
        for g, (size, members) in enumerate(groups):
            if size * (cuts[k] + 1) <= JOINT_BINS:
                groups[g] = size * (cuts[k] + 1), [*members, k]
                break
        else:
            groups.append((cuts[k] + 1, [k]))
    return [members for _, members in groups]


class Joint:
    """Rows held as one number per group of inputs: the bins of its inputs, and the label in the last bit."""

    def __init__(self, cuts: list[int], weights: tuple[float, float]) -> None:
        self.cuts, self.weights, self.groups = cuts, weights, joint_inputs(cuts)
        self.shapes = [tuple(cuts[k] + 1 for k in g) + (2,) for g in self.groups]
        self.place = {k: (g, i) for g, members in enumerate(self.groups) for i, k in enumerate(members)}
        self.width = max(cuts, default=0) + 1

    def packed(self, chunk: tuple) -> tuple:
        """The state of a chunk: numbers, labels, margins, weighted targets, and nothing of a tree before."""
        _, rows, data = chunk
        cells = np.frombuffer(data, np.uint8).reshape(len(self.cuts), rows)
        label = cells[0] & 1
        keys = np.empty((len(self.groups), rows), np.uint16)
        for g, members in enumerate(self.groups):
            key = np.zeros(rows, np.uint16)
            for k in members:
                key = key * np.uint16(self.cuts[k] + 1) + (cells[k] >> 1)
            keys[g] = 2 * key + label
        return keys, label, None, self.targets(label, None), 0.0

    def right_of(self, splits: Splits, keys: np.ndarray) -> Callable:
        """Whether rows of a node go to its right, looked up by their group's number."""
        tables = {}
        for node, (k, b) in splits.items():
            g, i = self.place[k]
            shape = [1] * len(self.shapes[g])
            shape[i] = -1
            above = (np.arange(self.cuts[k] + 1) > b).reshape(shape)
            tables[node] = g, np.broadcast_to(above, self.shapes[g]).ravel()

        def goes_right(node: int, rows: np.ndarray) -> np.ndarray:
            g, table = tables[node]
            return table.take(keys[g].take(rows))

        return goes_right

    def targets(self, label: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
        """What the next tree is to learn of every row, times its weight."""
        y = 2.0 * label - 1.0
        if margin is not None:
            y = 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
        return np.array(self.weights).take(label) * y

    def marginal(self, held: list[np.ndarray]) -> np.ndarray:
        """Totals by node, kind (rows, targets) and joint bin of each group as totals by node, input and bin."""
        out = np.zeros((len(held[0]) if held else 1, len(self.cuts), self.width, 3))
        for members, shape, totals in zip(self.groups, self.shapes, held, strict=True):
            joint = totals.reshape(len(totals), 2, *shape)
            joint = np.concatenate([joint[:, 0], joint[:, 1].sum(-1, keepdims=True)], axis=-1)
            for i, k in enumerate(members):
                out[:, k, : self.cuts[k] + 1] = joint.sum(tuple(a + 1 for a in range(len(members)) if a != i))
        return out


def boosted_histograms(joint: Joint, splits: Splits, built: list[int]) -> Callable:
    """Over a partition: rows of label 0 and 1 and weighted targets by node to be built, input and bin; and the weighted
    squared targets that the tree before had by leaf.
    """

    def counted(states: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray | float]]:
        sizes = [math.prod(s) for s in joint.shapes]
        totals, places = [np.zeros((len(built), 2, s)) for s in sizes], {n: k for k, n in enumerate(built)}
        whole, before = np.zeros((len(built), 3)), 0.0
        for keys, label, _, targets, squares in states:
            before = before + squares
            for node, r in rows_of_nodes(joint.right_of(splits, keys), np.arange(len(label)), splits, built):
                every, k = len(r) == len(label), places[node]
                w, ones = targets if every else targets.take(r), np.count_nonzero(label if every else label.take(r))
                whole[k] += len(r) - ones, ones, w.sum()
                for g, total in enumerate(totals):
                    key = (keys[g] if every else keys[g].take(r)).astype(np.intp)
                    total[k, 0] += np.bincount(key, minlength=sizes[g])
                    total[k, 1] += np.bincount(key, w, sizes[g])
        yield joint.marginal(totals), whole, before

    return counted


def moved_margins(joint: Joint, tree: Tree, weight: float, leaves: list[int]) -> Callable:
    """The state of rows after a tree: margins, what is left to learn, and the weighted squared targets the tree had by leaf."""
    values, splits = {n: weight * tree.found[n]["prediction"] for n in leaves}, tree.splits

    def moved(state: tuple) -> tuple:
        keys, label, margin, targets, _ = state
        out, squares = np.zeros(len(label)) if margin is None else margin.copy(), np.zeros(len(leaves))
        squared = targets * targets / np.array([w or 1.0 for w in joint.weights]).take(label)
        for node, r in rows_of_nodes(joint.right_of(splits, keys), np.arange(len(label)), splits, values):
            out[r] += values[node]
            squares[leaves.index(node)] = squared.take(r).sum()
        return keys, label, out, joint.targets(label, out), squares

    return moved


def added(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def boosted_splits(joint: Joint, totals: np.ndarray, whole: np.ndarray) -> list[tuple]:
    """(its statistics, split, left and right statistics) of every open node."""
    weights = np.array(joint.weights)
    left = totals.cumsum(2)
    right = whole[:, None, None] - left
    left_w, right_w, all_w = (a[..., :2] @ weights for a in (left, right, whole))

    def part(s: np.ndarray, w: np.ndarray) -> np.ndarray:
        return s * s / np.where(w > 0, w, 1)

    safe = np.where(all_w > 0, all_w, 1)
    squared_mean = (whole[:, 2] / safe) ** 2
    gain = (part(left[..., 2], left_w) + part(right[..., 2], right_w)) / safe[:, None, None] - squared_mean[:, None, None]
    valid = (left[..., :2].sum(-1) > 0) & (right[..., :2].sum(-1) > 0) & (np.arange(joint.width) < np.array(joint.cuts)[:, None])

    def found(t: np.ndarray, w: float) -> dict:
        return {"stats": [float(w), float(t[2])], "raw": int(t[0] + t[1]), "prediction": float(t[2] / w) if w > 0 else 0.0}

    out = []
    for n, best in enumerate(best_splits(gain, valid, squared_mean)):
        me = found(whole[n], all_w[n])
        if best is None:
            out.append((me, None, None, None))
            continue
        k, b, _ = best
        out.append((me, best, found(left[n, k, b], left_w[n, k, b]), found(right[n, k, b], right_w[n, k, b])))
    return out


def boosted_tree(states: RDD, joint: Joint, depth: int) -> tuple[Tree, np.ndarray | float]:
    """The next tree of boosting, and the weighted squared targets of the one before by leaf.

    Of two nodes below one, the rows of the smaller are counted; the other has what is left.
    """
    tree, held, before = Tree(), {}, None
    few = states.getNumPartitions() <= DRIVER_PARTS
    while tree.open:
        built = [1] if tree.open == [1] else [min(n, n + 1, key=lambda m: tree.found[m]["raw"]) for n in tree.open[::2]]
        counted = states.mapPartitions(boosted_histograms(joint, tree.splits, built))
        totals, whole, squares = counted.treeReduce(added, 1 if few else 2)
        before = squares if before is None else before
        level = {n: (t, w) for n, t, w in zip(built, totals, whole, strict=True)}
        for n in built[: len(tree.open) - len(built)]:
            other, rest = (above - own for above, own in zip(held[n >> 1], level[n], strict=True))
            other[..., 2][other[..., :2].sum(-1) == 0] = 0.0
            level[n ^ 1] = other, rest
        held, below = level, []
        found = boosted_splits(joint, *(np.stack([level[n][k] for n in tree.open]) for k in (0, 1)))
        for n, (me, at, left, right) in zip(tree.open, found, strict=True):
            tree.found[n] = me
            if at:
                below += tree.split(n, at, left, right, depth)
        tree.open = below
    return tree, before


def boosted_trees(estimator: GBTClassifier, chunks: RDD, edges: list[np.ndarray], weights: tuple[float, float]) -> list[tuple[Tree, float]]:
    """The trees of boosting with the logistic loss: the first learns the labels, the others what is left of them.

    The rows' margins are kept with them and moved after every tree; every few trees they are checkpointed.
    """
    joint, rounds, depth = Joint([len(e) for e in edges], weights), estimator.getMaxIter(), estimator.getMaxDepth()
    states = chunks.map(joint.packed).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[tuple[Tree, float]] = []
    old, kept, leaves = None, None, []

    def spread(squares: np.ndarray) -> None:
        """Give the last tree's nodes their squared targets, from the leaves up, and their impurity."""
        found = trees[-1][0].found
        total = dict(zip(leaves, squares.tolist(), strict=True))
        for n in sorted(found, reverse=True):
            if n not in total:
                total[n] = total[2 * n] + total[2 * n + 1]
            w, s = found[n]["stats"]
            found[n]["stats"] = [w, s, total[n]]
            found[n]["impurity"] = max((total[n] - s * s / w) / w, 0.0) if w > 0 else 0.0

    try:
        for m in range(rounds):
            if m and m % CHECKPOINT_ROUNDS == 0:
                states.checkpoint()
            tree, before = boosted_tree(states, joint, depth)
            if m:
                spread(before)
                old.unpersist()
            if m and m % CHECKPOINT_ROUNDS == 0:
                _forget(chunks.ctx, kept)
                kept = states.getCheckpointFile()
            weight = estimator.getStepSize() if m else 1.0
            trees.append((tree, weight))
            leaves = sorted(n for n in tree.found if n not in tree.splits)
            old = states
            states = states.map(moved_margins(joint, tree, weight, leaves)).persist(StorageLevel.MEMORY_AND_DISK)
        spread(states.map(lambda s: s[4]).reduce(np.add))
    finally:
        for rdd in (old, states):
            if rdd is not None:
                rdd.unpersist()
        _forget(chunks.ctx, kept)
    return trees


def _forget(context, path: str | None) -> None:
    """Delete a checkpoint that no later one needs."""
    if path:
        held = context._jvm.org.apache.hadoop.fs.Path(path)
        held.getFileSystem(context._jsc.hadoopConfiguration()).delete(held, True)


# Storage.


def stored_nodes(tree: Tree, edges: list[np.ndarray]) -> list[tuple]:
    """The rows of a tree as Spark ML stores it, numbered from the root down; two leaves that say the same are one."""
    rows: list[list] = []

    def leaf(node: int) -> bool:
        if node not in tree.splits:
            return True
        below = 2 * node, 2 * node + 1
        return all(leaf(n) for n in below) and len({tree.found[n]["prediction"] for n in below}) == 1

    def add(node: int) -> int:
        place, known = len(rows), tree.found[node]
        rows.append([place, known["prediction"], known["impurity"], known["stats"], known["raw"], -1.0, -1, -1, (-1, [], -1)])
        if not leaf(node):
            k, b = tree.splits[node]
            rows[place][5:] = known["gain"], add(2 * node), add(2 * node + 1), (k, [float(edges[k][b])], -1)
        return place

    add(1)
    return [tuple(r) for r in rows]


_NODE = (
    "struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int,"
    " rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def stored_model(estimator, spark, trees: list[tuple[Tree, float]], edges: list[np.ndarray]):
    """The trees as a model of Spark ML, by way of its stored form."""
    forest = isinstance(estimator, RandomForestClassifier)
    kind, single = (RandomForestClassificationModel, "classification.DecisionTreeClassificationModel") if forest else (GBTClassificationModel, "regression.DecisionTreeRegressionModel")
    path = os.path.join(shared_folder(spark), f"fitted-{uuid.uuid4().hex}")

    def description(name: str, uid: str, some: list[str] | None = None, **more) -> str:
        def values(held) -> dict:
            return {p.name: estimator.getOrDefault(p) if held == "set" else estimator._defaultParamMap[p] for p in estimator.params
                    if (estimator.isSet(p) if held == "set" else estimator.hasDefault(p)) and (some is None or p.name in some)}

        text = {"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                "paramMap": values("set"), "defaultParamMap": values("default"), **more}
        return json.dumps(text)

    counts = {"numFeatures": len(edges)} | ({"numClasses": 2} if forest else {}) | {"numTrees": len(trees)}
    about = description(f"classification.{kind.__name__}", estimator.uid, **counts)
    of_tree = ["cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
               "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed", "weightCol"]
    lines = [(k, description(single, f"{estimator.uid}_{k}", of_tree), weight) for k, (_, weight) in enumerate(trees)]
    nodes = [(k, node) for k, (tree, _) in enumerate(trees) for node in stored_nodes(tree, edges)]
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(lines, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, f"treeID int, nodeData {_NODE}").write.parquet(f"{path}/data")
    return kind.load(path)
