import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import survival
from frames import day, snapshots

LIVES = "model string, lifetime_days int, failed int"


def lives(spark, rows):
    return spark.createDataFrame(rows, LIVES)


def test_lifetime_counts_both_ends(spark):
    rows = [{"date": day(n), "serial_number": "A", "failure": int(n == 9)} for n in (0, 9)]
    rows.append({"date": day(3), "serial_number": "B"})
    got = {r.serial_number: (r.lifetime_days, r.failed) for r in survival.lifetimes(snapshots(spark, rows)).collect()}
    assert got == {"A": (10, 1), "B": (1, 0)}


def test_kaplan_meier_by_hand(spark):
    # At risk 6, 5, 3: survival 5/6, then one censored at the same time as a failure.
    rows = [("a", 2, 1), ("a", 4, 1), ("a", 4, 0), ("a", 6, 1), ("a", 7, 0), ("a", 9, 0)]
    curve = survival.kaplan_meier(survival.lifetime_histogram(lives(spark, rows))).orderBy("t").collect()
    assert [(r.t, r.at_risk, r.failures) for r in curve] == [(2, 6, 1), (4, 5, 1), (6, 3, 1)]
    assert [r.survival for r in curve] == pytest.approx([5 / 6, 2 / 3, 4 / 9])


def test_everything_fails_in_the_last_step(spark):
    rows = [("a", 2, 1), ("a", 4, 1), ("a", 4, 1)]
    curve = survival.kaplan_meier(survival.lifetime_histogram(lives(spark, rows)))
    assert [r.survival for r in curve.orderBy("t").collect()] == pytest.approx([2 / 3, 0.0])
    assert survival.median_survival(curve).first().median_days == 4


def test_no_failures_no_fit(spark):
    rows = [("a", 5, 0), ("a", 8, 0), ("b", 5, 1), ("b", 9, 0)]
    histogram = survival.lifetime_histogram(lives(spark, rows), ["model"])
    got = {r.model: r["shape"] for r in survival.weibull_fit(histogram, ["model"]).collect()}
    assert got["a"] is None and got["b"] is not None
    everyone = survival.kaplan_meier(survival.lifetime_histogram(lives(spark, rows[:2])))
    assert survival.survival_at(everyone, [30]).first().survival == 1.0


def _log_likelihood(t, failed, shape, scale):
    z = (t / scale) ** shape
    return np.sum(failed * (np.log(shape / scale) + (shape - 1) * np.log(t / scale))) - z.sum()


@pytest.mark.parametrize("shape,scale", [(0.7, 2000.0), (2.5, 1200.0)])
def test_weibull_is_the_maximum(spark, shape, scale):
    rng = np.random.default_rng(8)
    # Whole days: a long scale keeps the rounding from bending the shape.
    t = np.ceil(rng.weibull(shape, 3000) * scale).astype(int)
    cut = rng.integers(1, 3000, 3000)
    failed = (t <= cut).astype(int)
    t = np.minimum(t, cut)
    df = lives(spark, [("m", int(a), int(b)) for a, b in zip(t, failed)])
    fit = survival.weibull_fit(survival.lifetime_histogram(df)).first()
    assert fit["shape"] == pytest.approx(shape, rel=0.08)
    best = _log_likelihood(t, failed, fit["shape"], fit["scale"])
    for a, b in ((1.001, 1), (0.999, 1), (1, 1.001), (1, 0.999)):
        assert best > _log_likelihood(t, failed, fit["shape"] * a, fit["scale"] * b)


def test_weibull_on_its_bound_is_the_best_there(spark):
    rng = np.random.default_rng(9)
    t = rng.integers(1, 2000, 4000)
    failed = (rng.random(4000) < 0.05).astype(int)
    df = lives(spark, [("m", int(a), int(b)) for a, b in zip(t, failed)])
    fit = survival.weibull_fit(survival.lifetime_histogram(df), scale_bounds=(1.0, 5000.0)).first()
    assert fit["scale"] == 5000.0
    best = _log_likelihood(t, failed, fit["shape"], 5000.0)
    assert best > max(_log_likelihood(t, failed, fit["shape"] * a, 5000.0) for a in (0.999, 1.001))


def test_identical_rates_are_not_significant(spark):
    rows = [(m, 5, f) for m in "ab" for f in (1, 0, 0, 0)]
    row = survival.compare_failure_rates(lives(spark, rows), "a", "b").first()
    assert (row.chi2_statistic, row.p_value, row.significant) == (0.0, 1.0, False)
    skewed = [("a", 5, 1)] * 60 + [("a", 5, 0)] * 40 + [("b", 5, 1)] * 20 + [("b", 5, 0)] * 80
    row = survival.compare_failure_rates(lives(spark, skewed), "a", "b").first()
    assert row.chi2_statistic == pytest.approx(31.6875) and row.significant


def test_alert_value(spark):
    row = spark.range(1).select(survival.alert_value(F.lit(7.0), F.lit(20.0)).alias("v")).first()
    assert row.v == 37600.0
