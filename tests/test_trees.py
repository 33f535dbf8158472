"""Trees grown from histograms against Spark ML's own, and the work that training queries leave out."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W, functions as F

import __spark_entry__ as registry
from fleetpulse.operators import ensembles, learning, trees


def rows(spark, n, seed=0, weight=3.7):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4))
    x[:, 2] = np.floor(3 * x[:, 2])
    x[:, 3] = 5.0
    y = (x[:, 0] * x[:, 1] + 0.3 * x[:, 2] + 0.5 * r.normal(size=n) > 0.6).astype(int)
    lines = [(*map(float, v), int(k), weight if k else 1.0) for v, k in zip(x, y)]
    df = spark.createDataFrame(lines, "a double, b double, c double, same double, label int, weight double").repartition(3, "a")
    return VectorAssembler(inputCols=["a", "b", "c", "same"], outputCol="features").transform(df).cache()


def scores(model, df):
    return {r.a: r.p for r in model.transform(df).select("a", vector_to_array("probability")[1].alias("p")).collect()}


def same_model(estimator, df):
    ours, theirs = trees.fit(estimator, df), estimator.fit(df)
    assert type(ours) is type(theirs)
    assert scores(ours, df) == pytest.approx(scores(theirs, df), abs=1e-9)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
    assert ours.treeWeights == theirs.treeWeights
    for mine, other in zip(ours.trees, theirs.trees):
        a, b = (list(m._call_java("rootNode").impurityStats().stats()) for m in (mine, other))
        assert a == pytest.approx(b) or abs(a[1]) < 1e-6 > abs(b[1]) and a[::2] == pytest.approx(b[::2])


# With 13,000 rows thresholds come from a sample.
@pytest.mark.parametrize("n", [900, 13_000])
def test_forest_of_the_rows_themselves(spark, n):
    same_model(RandomForestClassifier(numTrees=1, bootstrap=False, maxDepth=4, seed=42, weightCol="weight"), rows(spark, n))


def test_boosted_trees(spark, monkeypatch):
    monkeypatch.setattr(trees, "CHUNK_ROWS", 1000)
    monkeypatch.setattr(trees, "CHECKPOINT_ROUNDS", 2)
    same_model(GBTClassifier(maxIter=5, maxDepth=3, stepSize=0.1, seed=42, weightCol="weight"), rows(spark, 13_000))


def test_forest_draws_as_spark_does(spark):
    df = rows(spark, 4000)
    estimator = RandomForestClassifier(numTrees=60, maxDepth=5, seed=42, weightCol="weight")
    ours, theirs = trees.fit(estimator, df), estimator.fit(df)
    p, q = scores(ours, df), scores(theirs, df)
    assert np.corrcoef([p[k] for k in p], [q[k] for k in p])[0, 1] > 0.98
    assert scores(trees.fit(estimator, df), df) == p
    counts = trees.BOOTSTRAP
    assert counts.mean() == pytest.approx(1, abs=1e-3) and counts.var() == pytest.approx(1, abs=1e-3)


@pytest.mark.parametrize("kind", [GBTClassifier, RandomForestClassifier])
def test_odd_rows(spark, kind):
    df, estimator = rows(spark, 30), kind(weightCol="weight")
    estimator.set(estimator.maxIter if kind is GBTClassifier else estimator.numTrees, 2)
    for few in (df.where("label = 0"), df.limit(1), df.withColumn("features", F.first("features").over(W.partitionBy()))):
        assert all(0 <= p <= 1 for p in scores(trees.fit(estimator, few.cache()), df).values())
    with pytest.raises(ValueError):
        trees.fit(estimator, df.limit(0))


def test_thresholds_of_few_and_many_values():
    ones = np.ones(6)
    assert trees.input_thresholds(np.array([1.0, 1, 2, 2, 4, 4]), ones, 6.0, 31).tolist() == [1.5, 3.0]
    assert trees.input_thresholds(np.array([0.0, 0, 2, 2, 4, 4]), ones, 6.0, 31).tolist() == [1.0, 3.0]
    assert trees.input_thresholds(np.zeros(6), ones, 6.0, 31).tolist() == []
    assert trees.input_thresholds(np.arange(1.0, 101), np.ones(100), 100.0, 3).tolist() == [25.5, 50.5, 75.5]


def test_chunks_are_dealt_evenly(spark):
    df = spark.range(0, 21, 1, 2).select(F.col("id").alias("chunk"), F.lit(1).alias("rows"), F.lit(b"x").alias("cells"))
    dealt = trees.dealt_chunks(df, 4)
    assert sorted(dealt.glom().map(len).collect()) == [5, 5, 5, 6]
    assert sorted(c for c, _, _ in dealt.collect()) == list(range(21))


def test_training_grows_trees_from_histograms(spark, monkeypatch):
    def slow(*_):
        raise AssertionError("a pass over the rows for every tree and row")

    monkeypatch.setattr(RandomForestClassifier, "_fit", slow)
    monkeypatch.setattr(GBTClassifier, "_fit", slow)
    df = rows(spark, 300)
    for kind in ("forest", "boosted"):
        model = learning.train(df.select("a", "b", "label"), kind, ["a", "b"], rounds=2)
        assert learning.predict(model, df.select("a", "b", "label")).count() == 300


def test_two_horizons_train_on_a_stored_matrix(spark, small, monkeypatch):
    def train(df, kind):
        raise AssertionError(df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(learning, "train", train)
    with pytest.raises(AssertionError) as seen:
        registry.queries()["W14_two_horizons"](spark, small)
    assert "md5" not in str(seen.value) and "FileScan parquet" in str(seen.value)


@pytest.mark.parametrize("slice_rows", [1_000_000, 70])
def test_auc_by_round_in_slices(spark, monkeypatch, slice_rows):
    """Ties, absent inputs and labels, over one and over many slices."""
    monkeypatch.setattr(ensembles, "SLICE_ROWS", slice_rows)
    r = np.random.default_rng(3)
    lines = [(int(v > 0.6) if k % 50 else None, [float(round(v, 2)) if k % 7 else None, float(r.integers(0, 3))]) for k, v in enumerate(r.random(500))]
    df = spark.createDataFrame(lines, "label int, inputs array<double>")
    nodes = spark.createDataFrame(
        [(t, *n) for t in range(3) for n in [(0, t % 2, 0.5 + t, 1, 2, 0.0, 1.0), (1, -1, None, -1, -1, -0.5, 1.0), (2, -1, None, -1, -1, 0.25 * (t + 1), 1.0)]],
        ensembles.NODES,
    )
    got = [x.roc_auc for x in ensembles.auc_by_round(nodes, df, 1).collect()]
    total = np.zeros(500)
    for t in range(3):
        x = [v[t % 2] for _, v in lines]
        total = total + [-0.5 if v is not None and v <= 0.5 + t else 0.25 * (t + 1) for v in x]
        pos, neg = ([s for (y, _), s in zip(lines, total) if y == k] for k in (1, 0))
        assert got[t] == pytest.approx(np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]), abs=1e-12)
    plan = df.where("label > 5")
    assert ensembles.auc_by_round(nodes, plan, 1).count() == 0
