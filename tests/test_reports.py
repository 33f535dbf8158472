import pytest

from fleetpulse.operators import fleet, quality
from fleetpulse.plans import reports
from frames import day, snapshots


def test_empty_table(spark):
    row = fleet.overview(snapshots(spark, [])).first()
    assert (row.total_records, row.unique_drives, row.failure_rate_pct) == (0, 0, None)
    assert fleet.failure_by_model(snapshots(spark, [])).count() == 0


def test_watchlist_puts_unknown_counts_first(spark):
    df = snapshots(
        spark,
        [
            {"date": day(0), "serial_number": "A", "smart_5_raw": 500},
            {"date": day(0), "serial_number": "B", "smart_5_raw": None, "smart_187_raw": 1},
            {"date": day(0), "serial_number": "C", "smart_5_raw": None, "smart_187_raw": None},
            {"date": day(0), "serial_number": "D", "smart_5_raw": 100},
            {"date": day(0), "serial_number": "E", "smart_5_raw": 900, "failure": 1},
        ],
    )
    assert [r.serial_number for r in fleet.watchlist(df).collect()] == ["B", "A"]


def test_annualized_rate_without_whole_days(spark):
    rows = [{"date": day(0), "serial_number": s, "failure": 1} for s in "ABC"]
    rows.append({"date": day(1), "serial_number": "A", "failure": 0})
    row = fleet.annualized_failure_rate(snapshots(spark, rows), min_drives=1).first()
    assert row.annualized_failure_rate is None and row.afr_pct == 109500.0


def test_unknown_failure_counts_as_healthy(spark):
    rows = [
        {"date": day(0), "serial_number": "A", "failure": None, "smart_5_raw": 4},
        {"date": day(0), "serial_number": "B", "failure": 1, "smart_5_raw": 10},
    ]
    df = snapshots(spark, rows)
    got = {r.status: r.avg_reallocated_sectors for r in fleet.indicator_means(df).collect()}
    assert got == {"Healthy": 4.0, "Failed": 10.0}
    assert fleet.divergence(df).first().reallocated_sectors_ratio == 2.5


def test_registry_keeps_the_latest_model(spark):
    rows = [
        {"date": day(0), "serial_number": "A", "model": "old", "failure": 1},
        {"date": day(3), "serial_number": "A", "model": "new", "capacity_bytes": None},
    ]
    row = fleet.drive_registry(snapshots(spark, rows)).first()
    assert (row.model, row.capacity_bytes, row.total_days, row.failed) == ("new", None, 2, True)
    assert (row.first_seen, row.last_seen, row.failure_date) == (day(0), day(3), day(0))


def test_audit_of_clean_data(spark):
    rows = [{"date": day(i), "serial_number": s} for i in range(4) for s in "AB"]
    report = quality.report(snapshots(spark, rows)).collect()
    assert {r.status for r in report} == {"PASS"}
    assert {r.check for r in report} == {
        "statistics", "duplicates", "missing", "outliers", "types", "continuity", "volume", "labels",
    }


def test_audit_findings(spark):
    rows = [{"date": day(i), "serial_number": s} for i in (0, 1, 4) for s in "AB"]
    rows += [
        {"date": day(4), "serial_number": "A", "smart_194_raw": 101, "failure": 1},
        {"date": day(5), "serial_number": "A", "smart_5_raw": None, "failure": 1},
    ]
    found = {(r.check, r.subject): (r.value, r.status) for r in quality.report(snapshots(spark, rows)).collect()}
    assert found["duplicates", "date, serial_number"] == (1.0, "WARN")
    assert found["missing", "smart_5_raw"] == (12.5, "WARN")
    assert found["outliers", "smart_194_raw"] == (1.0, "WARN")
    assert found["continuity", "missing_days"] == (2.0, "INFO")
    assert found["labels", "multi_fail_drives"] == (1.0, "INFO")
    assert found["labels", "1"] == (2.0, "PASS")


def test_type_mismatch(spark):
    df = snapshots(spark, [{"date": day(0), "serial_number": "A"}]).selectExpr(
        "cast(date as string) as date", "serial_number", "failure"
    )
    got = {r.column_name: r.status for r in quality.type_conformance(df).collect()}
    assert got == {"date": "WARN", "serial_number": "PASS", "failure": "PASS"}
    described = quality.describe_columns(df).collect()
    assert [(r.ordinal_position, r.column_name, r.data_type) for r in described] == [
        (1, "date", "string"), (2, "serial_number", "string"), (3, "failure", "int"),
    ]


def test_report_packs(spark, small):
    from fleetpulse.sources import tables

    pack = reports.fleet_report(tables.smart_daily(spark, small), min_drives=10)
    assert pack["overview"].count() == 1 and pack["models"].count() == 6
    study = reports.reliability_study(tables.smart_surv(spark, small), min_drives=10)
    assert study["weibull"].first()["shape"] == pytest.approx(1.664706, abs=1e-6)
    assert study["models"].count() == 5 and study["survival"].count() == 5
    assert study["reliability"].count() == 4
