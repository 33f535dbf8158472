"""Values computed by independent code beforehand (FIXTURES.md, section 4)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from fleetpulse.operators import degradation, fleet, survival
from fleetpulse.sources import tables


@pytest.fixture(scope="module")
def lives(spark, medium):
    return survival.lifetimes(tables.smart_surv(spark, medium)).cache()


def test_sizes(spark, medium):
    assert tables.smart_raw(spark, medium).count() == 60000
    assert tables.smart_daily(spark, medium).count() == 59657
    assert tables.smart_surv(spark, medium).count() == 59657
    assert tables.engine(spark, medium).count() == 10000


def test_failure_rates(spark, medium):
    rows = fleet.failure_by_model(tables.smart_daily(spark, medium)).collect()
    assert [(r.model, r.total_drives, r.failures, r.failure_rate_pct) for r in rows] == [
        ("PROMO", 331, 84, 25.3776),
        ("LARGE", 340, 84, 24.7059),
        ("SMALL", 322, 77, 23.9130),
        ("ECONOMY", 311, 68, 21.8650),
        ("MEDIUM", 353, 73, 20.6799),
        ("STANDARD", 343, 66, 19.2420),
    ]


def test_annualized_rates(spark, medium):
    rows = fleet.annualized_failure_rate(tables.smart_surv(spark, medium)).collect()
    assert {r.model: (r.annualized_failure_rate, r.afr_pct) for r in rows} == {
        "ECONOMY": (19.7475, 6.3459),
        "LARGE": (21.7122, 6.3835),
        "MEDIUM": (18.1894, 5.1497),
        "PROMO": (22.5937, 6.8214),
        "SMALL": (23.4525, 7.2829),
        "STANDARD": (19.5592, 5.6975),
    }


def test_weibull_bounds(lives):
    histogram = survival.lifetime_histogram(lives)
    free = survival.weibull_fit(histogram, scale_bounds=(1.0, 1e9)).first()
    assert free["shape"] == pytest.approx(1.696029, abs=1e-6)
    assert free["scale"] == pytest.approx(3360.734, abs=1e-3)
    bound = survival.weibull_summary(survival.weibull_fit(histogram, scale_bounds=(1.0, 2000.0))).first()
    assert bound["scale"] == 2000.0
    assert bound["shape"] == pytest.approx(2.182037, abs=1e-6)
    assert bound["mttf"] == pytest.approx(1771.215986, abs=1e-5)
    assert bound["b10"] == pytest.approx(713.075735, abs=1e-5)
    assert bound["b50"] == pytest.approx(1690.761390, abs=1e-5)
    assert bound["regime"] == "WEAR-OUT FAILURES"


def test_published_weibull_metrics(spark):
    fit = spark.createDataFrame([(339423, 3378, 2.1023, 2107.17)], "drives long, failures long, shape double, scale double")
    row = survival.weibull_summary(fit).first()
    assert round(row["mttf"], 1) == 1866.3
    assert round(row["b10"], 1) == 722.5
    assert round(row["b50"]) == 1770
    assert row["censored"] == 336045
    assert row["regime"] == "WEAR-OUT FAILURES"


def test_kaplan_meier(lives):
    curve = survival.kaplan_meier(survival.lifetime_histogram(lives))
    last = curve.orderBy(F.desc("t")).first()
    assert last["t"] == 2476 and last["survival"] == pytest.approx(0.118321, abs=1e-6)
    assert survival.median_survival(curve).first()[0] == 2286
    assert survival.survival_at(curve, [365]).first()["survival"] == pytest.approx(0.965022, abs=1e-6)
    nearest = survival.survival_at(curve, [365], lookup="next").first()
    assert nearest["survival"] == pytest.approx(0.963880, abs=1e-6)


def test_chi_square(lives):
    row = survival.compare_failure_rates(lives, "LARGE", "STANDARD").first()
    assert row["chi2_statistic"] == pytest.approx(1.234871, abs=1e-6)
    assert row["p_value"] == pytest.approx(0.266462, abs=1e-6)
    assert row["significant"] is False


def test_degradation(spark, medium):
    rul = degradation.remaining_life(tables.engine(spark, medium))
    target = degradation.target_summary(rul).first()
    assert (target["mean"], target["median"], target["max"]) == (33.3624, 33.0, 85)
    assert target["std"] == pytest.approx(20.148063, abs=1e-6)
    found = {r.sensor: r.correlation for r in degradation.target_correlations(rul, degradation.sensor_columns(rul)).collect()}
    assert found["sensor_1"] is None
    assert found["sensor_2"] == pytest.approx(0.002693, abs=1e-6)
    assert found["sensor_4"] == pytest.approx(-0.912047, abs=1e-6)
    assert found["sensor_7"] == pytest.approx(0.912172, abs=1e-6)
    cv = {r.sensor: r.cv for r in degradation.sensor_profile(rul).collect()}
    assert cv["sensor_1"] == pytest.approx(0, abs=1e-9)
    assert cv["sensor_2"] == pytest.approx(0.989355, abs=1e-6)
    assert cv["sensor_7"] == pytest.approx(0.003686, abs=1e-6)
