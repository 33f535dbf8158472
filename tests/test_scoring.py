import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import scoring
from fleetpulse.schema import FEATURE_COLUMNS, SCORING_REQUEST


def requests(spark, *rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in SCORING_REQUEST) for r in rows], SCORING_REQUEST)


def scored(spark, probabilities):
    df = spark.createDataFrame([(f"S{i}", p) for i, p in enumerate(probabilities)], "serial_number string, probability double")
    return scoring.decide(df, F.lit("2025-01-01").cast("timestamp"))


def test_request_without_window_statistics(spark):
    given = {
        "serial_number": "T-77", "capacity_tb": 6.5, "age_days": 41, "power_on_hours": 977,
        "smart_5_raw": 3.0, "smart_197_raw": 21.0, "smart_194_raw": 52.0, "smart_9_raw": 0.0,
    }
    row = scoring.impute(requests(spark, given)).first()
    assert row.smart_9_raw == 977.0 and row.power_on_hours == 977.0
    assert (row.smart_5_raw_mean_7d, row.smart_5_raw_max_7d, row.smart_5_raw_mean_30d) == (3.0, 3.0, 3.0)
    assert (row.smart_5_raw_std_7d, row.smart_5_raw_delta_7d) == (0.0, 0.0)
    assert (row.temp_mean_7d, row.temp_max_7d, row.smart_197_raw_mean_7d) == (52.0, 52.0, 21.0)
    assert None not in row and len(row) == 33


def test_given_window_statistics_win(spark):
    given = {"serial_number": "A", "smart_5_raw": 9.0, "smart_5_raw_mean_7d": 0.0, "smart_5_raw_std_7d": 2.0}
    row = scoring.impute(requests(spark, given)).first()
    assert (row.smart_5_raw_mean_7d, row.smart_5_raw_std_7d, row.smart_5_raw_max_7d) == (0.0, 2.0, 9.0)


def test_align(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0)], "serial_number string, b double, extra double")
    assert scoring.align(df, ["a", "b"]).first().asDict() == {"serial_number": "A", "a": 0.0, "b": 1.0}


def test_decisions_on_the_edges(spark):
    got = scored(spark, [0.7, 0.5, 0.3, 0.1, 0.1234, 0.49999]).orderBy("serial_number").collect()
    assert [r.risk_level for r in got] == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "LOW", "MEDIUM"]
    assert [r.will_fail_30d for r in got] == [True, True, False, False, False, False]
    assert (got[4].failure_probability, got[4].confidence) == (0.1234, 0.7532)
    # Rounded for display, but the tier and the decision look at the exact value.
    assert (got[5].failure_probability, got[5].confidence) == (0.5, 0.0)


def test_summary(spark):
    row = scoring.batch_summary(scored(spark, [0.9, 0.29996, 0.2])).first()
    assert row.total_drives == 3 and row.drives_at_risk == 2
    assert row.avg_failure_probability == pytest.approx(0.4667) and row.max_failure_probability == 0.9


def test_empty_batch(spark):
    row = scoring.batch_summary(scored(spark, [0.5]).limit(0)).first()
    assert (row.total_drives, row.avg_failure_probability, row.drives_at_risk) == (0, None, 0)


def test_display(spark):
    got = scoring.display(scored(spark, [0.05, 0.1, 0.4, 0.6, 0.7])).orderBy("serial_number").collect()
    assert [r.colour for r in got] == ["green", "green", "yellow", "orange", "red"]
    assert [r.gauge_step for r in got] == [10, 30, 50, 70, 100]


def test_batch_has_no_shuffle(spark):
    scorer = scoring.logistic_scorer({"smart_5_raw": 0.1}, -1.0)
    df = scoring.score_batch(requests(spark, {"serial_number": "A"}), scorer)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.columns[0] == "serial_number" and df.first().failure_probability == 0.2689
    assert len(FEATURE_COLUMNS) == 32
