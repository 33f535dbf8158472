import numpy as np
import pandas as pd
import pytest

from fleetpulse.operators import features
from fleetpulse.schema import FEATURE_COLUMNS, MONTH_ATTRIBUTES, TRAINING_COLUMNS, WINDOW_ATTRIBUTES
from frames import START, day, snapshots


def series(spark, days=45, drives=3):
    rng = np.random.default_rng(1)
    rows = []
    for s in range(drives):
        for n in range(days):
            if n % 11 == 5:
                continue
            row = {"date": day(n), "serial_number": f"S{s}", "model": f"M{n}"}
            for a in set(WINDOW_ATTRIBUTES) | {"smart_194_raw", "smart_9_raw"}:
                row[a] = None if rng.random() < 0.1 else int(rng.integers(0, 1000))
            rows.append(row)
    return rows


def test_rolling_features_equal_pandas(spark):
    rows = series(spark)
    got = features.rolling_features(snapshots(spark, rows)).toPandas().sort_values(["serial_number", "date"])
    for serial, one in pd.DataFrame(rows).groupby("serial_number"):
        mine = got[got.serial_number == serial].reset_index(drop=True)
        one = one.sort_values("date").reset_index(drop=True)
        for a in WINDOW_ATTRIBUTES:
            x = one[a].astype(float).fillna(0)
            week = x.rolling(7, min_periods=1)
            np.testing.assert_allclose(mine[f"{a}_mean_7d"], week.mean())
            np.testing.assert_allclose(mine[f"{a}_std_7d"], week.std().fillna(0), atol=1e-7)
            np.testing.assert_allclose(mine[f"{a}_max_7d"], week.max())
            np.testing.assert_allclose(mine[f"{a}_delta_7d"], x.diff(7).fillna(0))
        for a in MONTH_ATTRIBUTES:
            x = one[a].astype(float).fillna(0)
            np.testing.assert_allclose(mine[f"{a}_mean_30d"], x.rolling(30, min_periods=1).mean())
        assert set(mine.model) == {"M0"}
        assert mine.age_days.tolist() == [(d - START).days for d in one.date]


def test_frames_in_days(spark):
    rows = [{"date": day(n), "serial_number": "A", "smart_5_raw": v} for n, v in ((0, 10), (7, 30), (8, 50))]
    got = features.rolling_features(snapshots(spark, rows), by="days").orderBy("date").collect()
    assert [r.smart_5_raw_mean_7d for r in got] == [10.0, 30.0, 40.0]
    assert [r.smart_5_raw_delta_7d for r in got] == [0.0, 20.0, 0.0]
    with pytest.raises(ValueError):
        features.rolling_features(snapshots(spark, rows), by="weeks")


def test_single_row_drives_are_left_out(spark):
    rows = [{"date": day(0), "serial_number": "A"}, {"date": day(0), "serial_number": "B"}, {"date": day(1), "serial_number": "B"}]
    assert {r.serial_number for r in features.rolling_features(snapshots(spark, rows)).collect()} == {"B"}


def test_capacity_comes_from_the_first_row(spark):
    rows = [
        {"date": day(0), "serial_number": "A", "capacity_bytes": None},
        {"date": day(1), "serial_number": "A"},
        {"date": day(0), "serial_number": "B"},
        {"date": day(1), "serial_number": "B", "capacity_bytes": None},
    ]
    got = {r.serial_number: r.capacity_tb for r in features.rolling_features(snapshots(spark, rows)).collect()}
    assert got == {"A": 0.0, "B": 4.0}


def test_labels_around_failures(spark):
    rows = [{"date": day(n), "serial_number": "A", "failure": int(n in (40, 70))} for n in (0, 9, 10, 39, 40, 70, 71)]
    rows += [{"date": day(n), "serial_number": "B"} for n in (0, 1)]
    df = snapshots(spark, rows)
    got = features.training_set(df, 10).orderBy("serial_number", "date").collect()
    mine = [r for r in got if r.serial_number == "A"]
    assert len(mine) == 7
    assert [r.days_to_failure for r in mine] == [70, 61, 60, 31, 30, 0, -1]
    assert [r.will_fail_30d for r in mine] == [False, False, False, False, True, True, False]
    assert [r.will_fail_60d for r in mine] == [False, False, True, True, True, True, False]
    assert {r.failed for r in mine} == {1}
    other = [r for r in got if r.serial_number == "B"]
    assert {(r.days_to_failure, r.will_fail_30d, r.failed) for r in other} == {(-1, False, 0)}
    first = features.training_set(df, 10, pick="min").where("serial_number = 'A'").orderBy("date").first()
    assert first.days_to_failure == 40


def test_training_set_shape(spark, small):
    from fleetpulse.sources import tables

    df = features.training_set(tables.smart_daily(spark, small), 20)
    assert df.columns == TRAINING_COLUMNS and len(df.columns) == 39 and len(FEATURE_COLUMNS) == 32
    assert df.select("serial_number").distinct().count() == 44 + 20
    matrix = features.training_matrix(df)
    assert matrix.dropna().count() == df.count()


@pytest.mark.parametrize("by", ["rows", "days"])
def test_latest_features_equal_the_last_rows_of_all(spark, by):
    rows = series(spark, days=60) + series(spark, days=9, drives=5)[-8:] + [{"date": day(3), "serial_number": "alone"}]
    df = snapshots(spark, rows)
    latest = features.latest_features(df, by)
    whole = features.rolling_features(df, by).toPandas().sort_values(["serial_number", "date"])
    want = whole.groupby("serial_number").tail(1).reset_index(drop=True)
    got = latest.toPandas().sort_values("serial_number").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    assert "alone" not in set(got.serial_number)


def test_latest_features_window_over_the_tail_only(spark):
    latest = features.latest_features(snapshots(spark, series(spark)))
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("smart_5_raw_mean_30d") < plan.index("WindowGroupLimit")
