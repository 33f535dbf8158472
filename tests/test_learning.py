import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import features, learning, scoring
from fleetpulse.plans import training
from fleetpulse.schema import FEATURE_COLUMNS
from fleetpulse.sources import tables


@pytest.fixture(scope="module")
def training_set(spark, small):
    return features.training_set(tables.smart_daily(spark, small)).cache()


@pytest.fixture(scope="module")
def matrix(training_set):
    return learning.with_split(features.training_matrix(training_set)).cache()


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y]
    neg = [s for y, s in zip(labels, scores) if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_auc_equals_all_pairs(spark):
    rng = np.random.default_rng(2)
    labels = (rng.random(900) < 0.2).astype(int)
    scores = (rng.random(900) + 0.3 * labels).round(2)
    scores[::3] = 0.4
    df = spark.createDataFrame(list(zip(labels.tolist(), scores.tolist())), "label int, probability double")
    assert learning.roc_auc(df).first()[0] == pytest.approx(brute_auc(labels, scores), abs=1e-12)


def test_auc_leaves_out_null_and_nan_scores(spark):
    rows = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.6), (1, None), (0, None), (1, float("nan")), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, probability double")
    assert learning.roc_auc(df).first()[0] == 0.75


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4)], "label int, probability double")
    assert learning.roc_auc(df).first()[0] is None


def test_metrics(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 2 + [(0, 0)] * 4 + [(1, 0)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    assert learning.confusion(df).first()[:] == (3, 2, 4, 1)
    assert learning.classification_metrics(df).first()[:] == pytest.approx((0.7, 0.6, 0.75, 2 / 3))
    nothing = learning.classification_metrics(df.where("prediction = 0 and label = 0")).first()
    assert nothing[:] == (1.0, 0.0, 0.0, 0.0)


def test_split_keeps_drives_together(matrix):
    per_drive = matrix.groupBy("serial_number").agg(F.countDistinct("split").alias("n"))
    assert per_drive.where("n > 1").count() == 0
    share = {r.split: r["count"] / matrix.count() for r in matrix.groupBy("split").count().collect()}
    assert share["train"] == pytest.approx(0.72, abs=0.08) and share["test"] == pytest.approx(0.2, abs=0.08)


def test_split_by_row_keeps_class_shares(spark):
    df = spark.range(20000).selectExpr(
        "concat('S', id % 50) as serial_number", "date_add(date'2020-01-01', cast(id as int)) as date", "cast(id % 10 = 0 as int) as label"
    )
    rows = learning.with_split(df, by="row").groupBy("label").pivot("split").count().collect()
    for r in rows:
        total = r.train + r.test + r.validation
        assert r.test / total == pytest.approx(0.2, abs=0.02)
        assert r.validation / total == pytest.approx(0.08, abs=0.015)


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 3, "label int")
    assert {r.label: r.weight for r in learning.class_weights(df).collect()} == pytest.approx({0: 12 / 18, 1: 2.0})
    assert learning.positive_weight(df).first()[0] == 3.0


def test_train_compare_store(spark, training_set, tmp_path):
    comparison = training.run_training(training_set, str(tmp_path), rounds=3)
    rows = {r.model: r for r in comparison.collect()}
    assert set(rows) == {"boosted", "forest", "logistic"}
    assert all(0.5 < r.roc_auc <= 1 for r in rows.values())
    best = learning.best_model(comparison).first().model
    stored = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "training_results")).collect()]
    assert {s["best_model"] for s in stored} == {best} and len(stored) == 3

    model, info = learning.load_bundle(spark, str(tmp_path / best))
    assert info["model_type"] == best and info["feature_names"] == FEATURE_COLUMNS
    assert info["metrics"]["roc_auc"] == pytest.approx(rows[best].roc_auc)
    described = learning.model_info(model, info).collect()
    assert len(described) == 10 and described[0].importance >= described[9].importance
    batch = training_set.limit(5)
    scored = scoring.score_batch(batch, scoring.model_scorer(model))
    assert scored.where("failure_probability between 0 and 1").count() == 5


def test_unknown_kind():
    with pytest.raises(ValueError):
        learning.classifier("svm", 10)
