import pytest

from fleetpulse.operators import degradation
from fleetpulse.schema import SENSOR_READINGS
from fleetpulse.sources import run_to_failure


@pytest.fixture
def readings(spark, tmp_path):
    lines = []
    for engine, last in ((1, 3), (2, 5)):
        for cycle in range(1, last + 1):
            sensors = [518.67] + [cycle * 1.5 + s for s in range(20)]
            lines.append("  ".join(str(v) for v in [engine, cycle, 0.1, 0.2, 100.0, *sensors]) + " ")
    (tmp_path / "train.txt").write_text("\n".join(lines) + "\n\n")
    return run_to_failure.read_series(spark, str(tmp_path / "train.txt"))


def test_whitespace_series(readings):
    assert readings.schema.simpleString() == SENSOR_READINGS.simpleString()
    assert degradation.shape(readings).first()[:] == (8, 2, 26)
    row = readings.where("engine_id = 2 and cycle = 5").first()
    assert (row.op_setting_3, row.sensor_1, row.sensor_2, row.sensor_21) == (100.0, 518.67, 7.5, 26.5)


def test_targets_file(spark, tmp_path):
    (tmp_path / "rul.txt").write_text("112 \n98\n")
    assert sorted(r.RUL for r in run_to_failure.read_targets(spark, str(tmp_path / "rul.txt")).collect()) == [98, 112]


def test_remaining_life(readings):
    got = {(r.engine_id, r.cycle): r.RUL for r in degradation.remaining_life(readings).collect()}
    assert got[1, 1] == 2 and got[1, 3] == 0 and got[2, 1] == 4 and len(got) == 8
    engines, rows = degradation.engine_tables(readings, "FD001")
    assert {tuple(r) for r in engines.collect()} == {(1, 3, "FD001"), (2, 5, "FD001")}
    assert "rul" in rows.columns


def test_useful_sensors(readings):
    kept = degradation.useful_sensors(readings)
    assert len(kept) == 15 and "sensor_6" in kept and "sensor_1" not in kept


def test_constant_sensor(readings):
    rul = degradation.remaining_life(readings)
    got = {r.sensor: r.correlation for r in degradation.target_correlations(rul, ["sensor_1", "sensor_2"]).collect()}
    assert got["sensor_1"] is None and got["sensor_2"] < 0
    profile = {r.sensor: r for r in degradation.sensor_profile(readings).collect()}
    assert profile["sensor_1"].variation == "LOW" and profile["sensor_2"].variation == "HIGH"
    assert len(degradation.most_varying(degradation.sensor_profile(readings)).collect()) == 10


def test_histogram_closes_its_last_bin(spark):
    df = spark.range(0, 101).selectExpr("cast(id as int) as RUL")
    got = degradation.equal_width_histogram(df, bins=50).orderBy("bin").collect()
    assert len(got) == 50 and got[0].observations == 2 and got[49].observations == 3
    assert got[49].high_edge == 100.0
    flat = degradation.equal_width_histogram(spark.range(3).selectExpr("7 as RUL"), bins=4).orderBy("bin").collect()
    assert [r.observations for r in flat] == [3, 0, 0, 0]


def test_paths_of_chosen_engines(readings):
    rul = degradation.remaining_life(readings)
    got = degradation.degradation_paths(rul, [2], ["sensor_2", "sensor_3"])
    assert got.count() == 10 and {r.engine_id for r in got.collect()} == {2}
