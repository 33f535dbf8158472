"""Tree ensembles as tables: nodes as rows, scores from them in column expressions, quality after every round."""

import math
import os
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from fleetpulse.operators.learning import DEPTH
from fleetpulse.session import settle, shared_folder

# Tasks get the functions themselves: a worker needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Scores of a round that one task orders, rows whose scores are computed at once, rows that set the slices.
SLICE_ROWS = 1_000_000
BATCH_ROWS = 1 << 15
SLICE_SAMPLE = 10_000

#: A node is a leaf if its ``input`` is -1. ``node`` counts from 0 in each tree; the root is node 0.
NODES = "tree int, node int, input int, threshold double, left int, right int, value double, weight double"
LEAF = -1


def ensemble_nodes(model: PipelineModel) -> DataFrame:
    """The nodes of a fitted forest or boosted ensemble, read from its stored form.

    ``value`` of a leaf is its share of positives for a forest, its margin for boosted trees;
    ``weight`` is that of the tree. Inputs are places in the scaled feature vector.
    """
    fitted = model.stages[-1]
    spark = SparkSession.active()
    path = os.path.join(shared_folder(spark), f"ensemble-{uuid.uuid4().hex}")
    fitted.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    held = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    stats = F.col("impurityStats")
    forest = "Forest" in type(fitted).__name__
    value = F.try_divide(F.get(stats, F.lit(1)), F.get(stats, F.lit(0)) + F.get(stats, F.lit(1))) if forest else F.col("prediction")
    return held.join(weights, "tree").select(
        "tree", F.col("id").alias("node"), F.when(F.col("leftChild") < 0, LEAF).otherwise(F.col("split.featureIndex")).alias("input"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        value.alias("value"), "weight",
    )


def tree_values(nodes: DataFrame, features: Column, depth: int = DEPTH) -> Column:
    """The weighted value that each tree gives to an array of inputs, in the order of the trees.

    The table becomes arrays inside the expression; an ensemble has at most
    trees * 2**(depth + 1) nodes, whatever it was trained on. A row goes down all
    trees at once, one level a step.
    """
    arrays, start = _flat(nodes)
    held = {n: _constant("double" if n in ("threshold", "value") else "int", values) for n, values in arrays.items()}
    roots = _constant("int", start)

    def down(node: Column, _: Column) -> Column:
        at = F.get(held["input"], node)
        goes_left = F.get(features, at) <= F.get(held["threshold"], node)
        return F.when(at == LEAF, node).when(goes_left, F.get(held["left"], node)).otherwise(F.get(held["right"], node))

    steps = _constant("int", list(range(depth)))
    return F.transform(roots, lambda root: F.get(held["value"], F.aggregate(steps, root, down)))


def _flat(nodes: DataFrame) -> tuple[dict[str, list], list[int]]:
    """The nodes of all trees as arrays, and the places of the roots in them."""
    rows = nodes.orderBy("tree", "node").collect()
    start, first = {}, 0
    for r in rows:
        start.setdefault(r.tree, first)
        first += 1
    base = [start[r.tree] for r in rows]
    arrays = {
        "input": [r.input for r in rows],
        "threshold": [r.threshold if r.input != LEAF else 0.0 for r in rows],
        "left": [b + r.left for b, r in zip(base, rows, strict=True)],
        "right": [b + r.right for b, r in zip(base, rows, strict=True)],
        "value": [(r.value or 0.0) * r.weight if r.input == LEAF else 0.0 for r in rows],
    }
    return arrays, sorted(start.values())


def _constant(kind: str, values: list) -> Column:
    """An array constant; its text is read once, when the plan is made."""
    text = ",".join(repr(v) for v in values)
    return F.from_json(F.lit(f"[{text}]"), f"array<{kind}>")


def forest_score(values: Column) -> Column:
    """Mean vote of the trees."""
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.size(values)


def boosted_score(values: Column) -> Column:
    """Probability of the summed margin of boosted trees."""
    return 1 / (1 + F.exp(-2 * F.aggregate(values, F.lit(0.0), lambda total, v: total + v)))


def scaled_inputs(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``inputs``: the scaled feature vector as an array."""
    scaled = PipelineModel(model.stages[:-1]).transform(df)
    return scaled.select(*df.columns, vector_to_array("features").alias("inputs"))


def score_from_table(nodes: DataFrame, df: DataFrame, score, depth: int = DEPTH) -> DataFrame:
    """``df`` (with ``inputs``) and its ``probability`` by the ensemble in ``nodes``."""
    return df.withColumn("probability", score(tree_values(nodes, F.col("inputs"), depth)))


def _margins(arrays: dict[str, list], roots: list[int], depth: int) -> Callable[[np.ndarray], Iterator[np.ndarray]]:
    """From inputs, one row each, the rows' margins after every round. An absent input, as NaN, goes right."""
    held = {n: np.array(v) for n, v in arrays.items()}

    def margins(x: np.ndarray) -> Iterator[np.ndarray]:
        flat, first = x.ravel(), np.arange(len(x)) * x.shape[1]
        total = np.zeros(len(x))
        for root in roots:
            node = np.full(len(x), root)
            for _ in range(depth):
                at = held["input"].take(node)
                left = flat.take(first + np.maximum(at, 0)) <= held["threshold"].take(node)
                node = np.where(at == LEAF, node, np.where(left, held["left"].take(node), held["right"].take(node)))
            total = total + held["value"].take(node)
            yield total

    return margins


def _collapsed(score: np.ndarray, positives: np.ndarray, negatives: np.ndarray) -> tuple[np.ndarray, ...]:
    """Positives and negatives of every distinct score, in their order."""
    values, place = np.unique(score, return_inverse=True)
    return values, *(np.bincount(place, c, len(values)) for c in (positives, negatives))


_HISTOGRAM = pa.schema([("round", pa.int32()), ("slice", pa.int32()), ("held", pa.binary())])
_SLICE = pa.schema([("round", pa.int32()), ("slice", pa.int32()), ("positives", pa.float64()), ("negatives", pa.float64()), ("area", pa.float64())])


def _histograms(margins: Callable, edges: list[np.ndarray]) -> Callable:
    """Batches of (label, inputs...) as histograms of their scores by round and slice."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                label, *inputs = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
                x = np.stack(inputs, axis=1) if inputs else np.zeros((len(label), 1))
                lines = []
                for k, total in enumerate(margins(x)):
                    some = ~np.isnan(total)
                    held = np.stack(_collapsed(total[some], label[some] == 1, label[some] == 0))
                    cuts = [0, *np.searchsorted(held[0], edges[k], "right"), held.shape[1]]
                    for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if b > a:
                            lines.append({"round": k + 1, "slice": s, "held": held[:, a:b].tobytes()})
                yield pa.RecordBatch.from_pylist(lines, _HISTOGRAM)

    return counted


def _slice_area(table: pa.Table) -> pa.Table:
    """Positives and negatives of a slice of a round, and its pairs of either that are in order, ties counted half."""
    held = np.concatenate([np.frombuffer(b).reshape(3, -1) for b in table["held"].to_pylist()], axis=1)
    _, positives, negatives = _collapsed(*held)
    below = negatives.cumsum() - negatives / 2
    line = {"round": table["round"][0].as_py(), "slice": table["slice"][0].as_py(), "positives": positives.sum(), "negatives": negatives.sum(), "area": positives @ below}
    return pa.Table.from_pylist([line], _SLICE)


def auc_by_round(nodes: DataFrame, df: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Exact ROC AUC of ``df`` (label, inputs) after each round of boosting: (round, roc_auc), rounds from 1.

    A row's margins after every round are the running sums of its trees' values. Each task counts
    its rows by round and margin; the counts of a round meet in slices of some ``SLICE_ROWS`` margins, cut at quantiles
    of a sample, which decides how they are dealt and nothing else. Only slice totals are ordered in
    one place. A single class gives NULL.
    """
    arrays, roots = _flat(nodes)
    margins = _margins(arrays, roots, depth)
    rows = df.select("label", *[F.get("inputs", F.lit(k)).cast("double").alias(f"input_{k}") for k in range(max(arrays["input"], default=LEAF) + 1)])
    number = rows.count()
    slices = math.ceil(number / SLICE_ROWS)
    edges = [np.empty(0)] * len(roots)
    if slices > 1:
        sample = rows.drop("label").sample(min(1.0, SLICE_SAMPLE / number), seed=1).collect()
        x = np.array([[math.nan if v is None else v for v in r] or [0.0] for r in sample], float)
        if len(x):
            edges = [np.unique(np.quantile(t[~np.isnan(t)], np.arange(1, slices) / slices)) if not np.isnan(t).all() else np.empty(0) for t in margins(x)]
    counted = rows.mapInArrow(_histograms(margins, edges), "round int, slice int, held binary")
    areas = counted.groupBy("round", "slice").applyInArrow(_slice_area, "round int, slice int, positives double, negatives double, area double")
    ahead = W.partitionBy("round").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    areas = areas.withColumn("area", F.col("area") + F.col("positives") * F.coalesce(F.sum("negatives").over(ahead), F.lit(0.0)))
    auc = F.try_divide(F.sum("area"), F.sum("positives") * F.sum("negatives")).alias("roc_auc")
    return settle(areas.groupBy("round").agg(auc), "auc-by-round").orderBy("round")
