"""Training run: split, fit the three classifiers, compare, store."""

import os
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from fleetpulse.operators import features, learning
from fleetpulse.schema import FEATURE_COLUMNS
from fleetpulse.session import settle


def compare_models(
    training: DataFrame, target: str = "will_fail_30d", by: str = "drive", rounds: int = learning.ROUNDS,
    kinds: list[str] = learning.KINDS,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Test metrics of every classifier, one row each, and the fitted pipelines."""
    matrix = settle(learning.with_split(features.training_matrix(training, target), by), "matrix")
    train = matrix.where(F.col("split") == "train")
    models, rows = {}, []
    for kind in kinds:
        models[kind] = learning.train(train, kind, rounds=rounds)
        held_out = matrix.where(F.col("split") != "train")
        scored = settle(
            learning.predict(models[kind], held_out).select("split", "label", "prediction", "probability"),
            f"scored-{kind}",
        )
        validation = learning.roc_auc(scored.where(F.col("split") == "validation")).scalar()
        rows.append(
            learning.evaluate(scored.where(F.col("split") == "test"))
            .withColumn("validation_auc", validation)
            .select(F.lit(kind).alias("model"), "*")
        )
    return reduce(DataFrame.unionByName, rows), models


def run_training(training: DataFrame, path: str, rounds: int = learning.ROUNDS) -> DataFrame:
    """Compare the classifiers and store models, metrics and the best one's name."""
    comparison, models = compare_models(training, rounds=rounds)
    comparison = settle(comparison, "comparison")
    for kind, model in models.items():
        metrics = comparison.where(F.col("model") == kind).drop("model")
        learning.save_bundle(model, os.path.join(path, kind), kind, metrics, FEATURE_COLUMNS)
    best = learning.best_model(comparison).select("model").scalar()
    results = comparison.select(
        "*", best.alias("best_model"), F.current_timestamp().alias("timestamp")
    )
    results.write.mode("overwrite").json(os.path.join(path, "training_results"))
    return comparison
