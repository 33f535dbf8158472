"""Registered training queries train as long as the library does by default."""

import pytest

import __spark_entry__ as registry
from fleetpulse.operators import learning


class Seen(Exception):
    pass


@pytest.mark.parametrize("name", ["M12_feature_importance", "M13_model_comparison", "M14_model_info", "W14_two_horizons"])
def test_registered_training_has_all_rounds(spark, small, monkeypatch, name):
    def classifier(kind, samples, rounds=learning.ROUNDS, seed=learning.SEED):
        raise Seen(rounds)

    monkeypatch.setattr(learning, "classifier", classifier)
    with pytest.raises(Seen) as seen:
        registry.queries()[name](spark, small)
    assert seen.value.args == (200,)


def test_auc_by_round_trains_one_model(spark, small, monkeypatch):
    def all_models(*_):
        raise AssertionError("trained for nothing")

    def train(df, kind):
        raise Seen(kind)

    monkeypatch.setattr(registry.training, "compare_models", all_models)
    monkeypatch.setattr(learning, "train", train)
    with pytest.raises(Seen) as seen:
        registry.queries()["M4_auc_by_round"](spark, small)
    assert seen.value.args == ("boosted",)


def test_training_partitions_are_bounded(spark, monkeypatch):
    assert learning.training_parts("forest", 10_000_000, 32, 200) == 49
    assert learning.training_parts("boosted", 10_000_000, 32, 200) == 20

    def weighted(df, kind):
        raise Seen(df.rdd.getNumPartitions())

    monkeypatch.setattr(learning, "PART_BYTES", 10_000)
    monkeypatch.setattr(learning, "weighted", weighted)
    df = spark.range(1000).selectExpr("cast(id as double) as a", "cast(id % 2 as int) as label")
    with pytest.raises(Seen) as seen:
        learning.train(df.coalesce(2), "forest", ["a"], rounds=21)
    assert seen.value.args == (10,)
