from datetime import date

import pytest

from fleetpulse.operators import features
from fleetpulse.plans.load import load_drops, load_new_drops
from fleetpulse.schema import RAW_ATTRIBUTES, SNAPSHOT
from fleetpulse.sources import csv_drops, snapshot_store
from frames import day, snapshots

HEADER = "date,serial_number,model,capacity_bytes,failure,smart_5_normalized,smart_5_raw,smart_9_raw"


@pytest.fixture
def raw(tmp_path):
    """Two quarters of drops with different headers, and every kind of bad row."""
    root = tmp_path / "raw"
    (root / "q1" / "deep").mkdir(parents=True)
    (root / "q2").mkdir()
    (root / "q1" / "2025-01-01.csv").write_text(
        HEADER + "\n"
        "2025-01-01,A,M1,4000,0,100,7,12.9\n"
        "2025-01-01,B,,n/a,,100,-3.7,\n"
        "2025-01-01,A,M1,4000,0,100,8,13\n"
        "2025-01-01,A,M1,4000,0,100,8,13\n"
        "not a day,C,M1,4000,0,100,0,0\n"
        "2025-01-01,,M1,4000,0,100,0,0\n"
        "2025-01-01,D\n"
    )
    (root / "q1" / "deep" / "2025-01-02.csv").write_text(HEADER + "\n2025-01-02,A,M1,4000,1,100,9,1e3\n")
    (root / "q2" / "2025-04-01.csv").write_text(
        "date,serial_number,capacity_bytes,failure,smart_242_raw,smart_9_raw\n2025-04-01,E,4000,0,9007199254740993,5\n"
    )
    (root / "q2" / "notes.txt").write_text("no drop\n")
    (root / "q3").mkdir()
    (root / "q3" / "2025-07-01.csv").write_text("\n")
    return str(root)


def test_discovery(spark, raw):
    names = [r.path.rsplit("/", 1)[1] for r in csv_drops.find_csv_files(spark, raw).collect()]
    assert sorted(names) == ["2025-01-01.csv", "2025-01-02.csv", "2025-04-01.csv", "2025-07-01.csv"]


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("no drop")
    with pytest.raises(FileNotFoundError):
        csv_drops.read_drops(spark, str(tmp_path))


@pytest.mark.parametrize("per", ["file", "directory"])
def test_normalization(spark, raw, per):
    parsed = csv_drops.read_drops(spark, raw, per)
    rows = csv_drops.accepted(parsed).orderBy("date", "serial_number", "smart_5_raw").collect()
    assert [(r.serial_number, r.smart_5_raw, r.smart_9_raw) for r in rows] == [
        ("A", 7, 12), ("A", 8, 13), ("A", 8, 13), ("B", -3, None), ("D", None, None), ("A", 9, 1000), ("E", None, 5),
    ]
    b, e = rows[3], rows[6]
    assert (b.capacity_bytes, b.failure, b.model) == (None, 0, None)
    assert (e.model, e.smart_242_raw, e.smart_188_raw) == ("", 9007199254740993, None)
    reasons = {r.reject_reason for r in csv_drops.rejected(parsed).collect()}
    assert reasons == {"unreadable date", "no serial number"}


def test_load_and_reload(spark, raw, tmp_path):
    table, refused = str(tmp_path / "table"), str(tmp_path / "refused")
    audit = load_drops(spark, raw, table, refused)
    totals = csv_drops.audit_totals(audit).first()
    assert (totals.files, totals.successful_files, totals.total_rows) == (3, 3, 7)
    stored = snapshot_store.read_snapshots(spark, table)
    assert sorted(stored.select("serial_number").toPandas().serial_number) == ["A", "A", "B", "D", "E"]
    out = {(r.reject_reason, r.smart_5_raw): r.copies for r in spark.read.parquet(refused).collect()}
    assert out == {("unreadable date", 0): 1, ("no serial number", 0): 1, ("repeated key", 8): 2}

    again = load_drops(spark, raw, table, refused)
    assert csv_drops.audit_totals(again).first().total_rows == 7
    assert snapshot_store.read_snapshots(spark, table).count() == 5
    known = spark.read.parquet(refused).where("reject_reason = 'key already stored'")
    assert known.count() == 5


def test_quarters_are_pruned(spark, tmp_path):
    rows = [{"date": d, "serial_number": "A"} for d in (date(2025, 3, 31), date(2025, 4, 1), date(2025, 12, 31))]
    snapshot_store.append_snapshots(snapshots(spark, rows), str(tmp_path / "t"))
    names = sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir())
    assert names == ["quarter=2025q1", "quarter=2025q2", "quarter=2025q4"]
    df = snapshot_store.read_snapshots(spark, str(tmp_path / "t"), date(2025, 4, 1), date(2025, 9, 30))
    assert [r.date for r in df.collect()] == [date(2025, 4, 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarter" in plan


def test_sql_over_the_table(spark, tmp_path):
    rows = [{"date": day(n), "serial_number": s, "failure": int(n == 2)} for n in range(3) for s in "AB"]
    snapshot_store.append_snapshots(snapshots(spark, rows), str(tmp_path / "t"))
    snapshot_store.register_view(spark, str(tmp_path / "t"))
    row = spark.sql(
        "SELECT COUNT(*) AS n, COUNT(DISTINCT serial_number) AS drives, SUM(failure) AS failures FROM smart_daily"
    ).first()
    assert tuple(row) == (6, 2, 2)


def test_null_marker_round_trip(spark, tmp_path):
    nothing = dict.fromkeys(RAW_ATTRIBUTES)
    rows = [{"date": day(3), "serial_number": "TEST999", "model": "TestModel4", "capacity_bytes": 4000000, **nothing,
             "smart_9_raw": 200, "smart_194_raw": 40}]
    path = str(tmp_path / "exchange")
    snapshot_store.write_exchange(snapshots(spark, rows), path)
    assert "\\N" in spark.read.text(path).first().value
    back = snapshot_store.read_exchange(spark, path)
    assert back.count() == 1 and back.schema.fieldNames() == SNAPSHOT.fieldNames()
    assert back.first()[:] == snapshots(spark, rows).first()[:]


def test_new_files_are_taken_once(spark, tmp_path):
    raw = tmp_path / "drops"
    raw.mkdir()
    header = HEADER.split(",")
    where = [str(tmp_path / n) for n in ("table", "refused", "state")]
    (raw / "2025-01-01.csv").write_text(HEADER + "\n2025-01-01,A,M,1,0,1,2,3\nbad,B,M,1,0,1,2,3\n")
    load_new_drops(spark, str(raw), *where, header)
    (raw / "2025-04-02.csv").write_text(HEADER + "\n2025-04-02,A,M,1,1,1,2,x\n2025-01-01,A,M,1,0,1,9,9\n")
    load_new_drops(spark, str(raw), *where, header)
    load_new_drops(spark, str(raw), *where, header)
    rows = snapshot_store.read_snapshots(spark, where[0]).orderBy("date").collect()
    assert [(r.quarter, r.failure, r.smart_9_raw) for r in rows] == [("2025q1", 0, 3), ("2025q2", 1, None)]
    refused = {(r.reject_reason, r.smart_9_raw) for r in spark.read.parquet(where[1]).collect()}
    assert refused == {("unreadable date", 3), ("key already stored", 9)}


def test_thousands_of_files_with_three_headers(spark, tmp_path):
    """All headers in one job: nothing runs per file on the driver."""
    raw = tmp_path / "many"
    raw.mkdir()
    heads = ["date,serial_number,model,failure,smart_9_raw", "serial_number,date,smart_9_raw", 'smart_9_raw,"date",serial_number,failure,extra,model']
    lines = ["2025-01-01,S{0},M,1,{0}", "S{0},2025-01-01,{0}", '{0},2025-01-01,"S{0}",0,"a, b",N']
    for k in range(5000):
        (raw / f"{k}.csv").write_text(f"{heads[k % 3]}\n{lines[k % 3].format(k)}\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many", "many")
    rows = csv_drops.accepted(csv_drops.read_drops(spark, str(raw))).collect()
    jobs = len(tracker.getJobIdsForGroup("many"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 12
    assert sorted(r.smart_9_raw for r in rows) == list(range(5000))
    for r in rows:
        k = r.smart_9_raw
        assert r.serial_number == f"S{k}" and (r.model, r.failure) == [("M", 1), ("", 0), ("N", 0)][k % 3]


def test_stream_of_mixed_good_and_bad_files(spark, tmp_path):
    raw = tmp_path / "drops"
    raw.mkdir()
    (raw / "a.csv").write_text(HEADER + "\n2025-01-01,A,M,1,0,1,2,3\n" + HEADER + "\n2025-01-02,A,M,1,0,1,2")
    (raw / "b.csv").write_text("serial_number,smart_9_raw,date\nB,9,2025-01-01\nB,7,2025-0")  # torn
    (raw / "c.csv").write_text("day,drive\n2025-01-01,C\n2025-01-02,C\n")
    (raw / "d.csv").write_text("")
    (raw / "e.csv").write_text("\n \n")
    where = [str(tmp_path / n) for n in ("table", "refused", "state")]
    load_new_drops(spark, str(raw), *where, files_per_batch=2)
    rows = snapshot_store.read_snapshots(spark, where[0]).orderBy("serial_number", "date").collect()
    assert [(r.serial_number, str(r.date), r.smart_9_raw) for r in rows] == [("A", "2025-01-01", 3), ("A", "2025-01-02", None), ("B", "2025-01-01", 9)]
    refused = sorted(r.reject_reason for r in spark.read.parquet(where[1]).collect())
    assert refused == ["foreign header", "foreign header", "unreadable date"]
    blank = [r.source_file.rsplit("/", 1)[1] for r in csv_drops.blank_files(spark, str(raw)).collect()]
    assert blank == ["e.csv"]


def test_a_repeated_load_changes_neither_side(spark, tmp_path):
    raw = tmp_path / "drops"
    raw.mkdir()
    head = "date,serial_number,smart_5_raw\n"
    (raw / "a.csv").write_text(head + "2025-01-01,A,5\n2025-04-01,B,5\n2025-01-01,A,6\nbad,C,1\n")
    more = tmp_path / "more"
    more.mkdir()
    (more / "b.csv").write_text(head + "2025-01-01,A,4\n2025-04-01,B,9\n2025-07-01,D,1\n")
    table, refused = str(tmp_path / "table"), str(tmp_path / "refused")

    def state():
        rows = sorted(map(tuple, snapshot_store.read_snapshots(spark, table).select("date", "serial_number", "smart_5_raw").collect()))
        out = spark.read.parquet(refused).select("serial_number", "smart_5_raw", "copies", "reject_reason").collect()
        return rows, sorted(map(tuple, out))

    load_drops(spark, str(raw), table, refused, batch="one")
    first = state()
    load_drops(spark, str(raw), table, refused, batch="one")
    assert state() == first
    load_drops(spark, str(more), table, refused, batch="two")
    both = state()
    assert [r[1:] for r in both[0]] == [("A", 4), ("B", 5), ("D", 1)]
    assert both[1] == [("A", 5, 1, "repeated key"), ("A", 6, 1, "repeated key"), ("B", 9, 1, "key already stored"), ("C", 1, 1, "unreadable date")]
    for batch, path in (("two", more), ("two", more)):
        load_drops(spark, str(path), table, refused, batch=batch)
        assert state() == both


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_of_a_loaded_table_need_no_shuffle(spark, raw, tmp_path):
    table = str(tmp_path / "table")
    load_drops(spark, raw, table, str(tmp_path / "refused"), buckets=4)
    df = features.rolling_features(snapshot_store.read_snapshots(spark, table))
    assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
    assert df.count() == 2


def test_sql_date_range_reads_its_quarters_only(spark, tmp_path):
    rows = [{"date": date(2025, m, 15), "serial_number": s} for m in range(1, 13) for s in "AB"]
    store = snapshot_store.BucketedStore(spark, str(tmp_path / "t"), 3)
    store.write(snapshots(spark, rows), "one")
    snapshot_store.register_view(spark, str(tmp_path / "t"), "by_quarter")
    df = spark.sql("SELECT date, serial_number FROM by_quarter WHERE date BETWEEN DATE '2025-05-01' AND DATE '2025-06-30'")
    assert sorted(map(tuple, df.collect())) == [(date(2025, m, 15), s) for m in (5, 6) for s in "AB"]
    assert "dynamicpruningexpression(quarter" in plan(df)
    nodes = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in nodes
    assert spark.sql("SELECT COUNT(*) AS n FROM by_quarter").first().n == 24
