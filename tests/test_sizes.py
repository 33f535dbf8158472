"""What one task holds stays bounded as the tables grow, and rows are deduplicated in one shuffle."""

import datetime

from pyspark.sql import functions as F

import __spark_entry__ as registry
from fleetpulse.operators import keys
from fleetpulse.schema import SNAPSHOT
from fleetpulse.sources import snapshot_store, tables

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


def lines_and_parts(spark, folder):
    at = datetime.datetime(1995, 3, 4)
    rows = [(k, p, 1, k % 7 + 1, 41.0 + k % 10, 7.5, "R", "F", at) for k, p in enumerate([1, 1, 2, None, 9, 3, 2, 1] * 5)]
    rows += [(1, 2, 1, 1, 50.0, 7.5, "R", "F", None), (1, None, 1, 1, 50.0, 7.5, "R", "F", None)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(1, "A", 5), (2, "B", 17), (2, "C", 3), (3, None, None), (None, "D", 1), (4, "E", 2)]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def test_buckets_grow_with_the_input(spark, tmp_path):
    held = tmp_path / "lineitem.parquet"
    with open(held, "wb") as f:
        f.truncate(4 << 30)  # a sparse file: only its length counts
    assert tables.bucket_count(spark, str(held)) == 256


def test_given_table_is_stored_in_as_many_buckets(spark, small, monkeypatch):
    monkeypatch.setattr(tables, "bucket_count", lambda *_: 11)
    assert snapshot_store.BucketedStore(spark, registry._stored_daily(spark, small)).buckets == 11


def test_first_rows_within_drives(spark):
    day = datetime.date(2001, 1, 1)
    rows = [(day, "a", 2), (day, "a", 1), (day, "b", 5), (day, "b", 5), (None, "a", 1), (None, "a", 1), (day, None, 3), (day, None, 3)]
    rows += [(day + datetime.timedelta(d), "c", c) for d in range(4) for c in range(30)]
    df = spark.createDataFrame(rows, "date date, serial_number string, x int")
    repeated = keys.few_repeated_keys(df, ["date", "serial_number"])
    expected = sorted(keys.one_row_per_key(df, ["date", "serial_number"], ["x"], repeated).collect(), key=str)
    busy = keys.busy_keys(df, "serial_number", 100)
    assert [r.serial_number for r in busy.collect()] == ["c"]
    for listed in (busy, busy.limit(0)):
        found = keys.one_row_per_key_within(df, "serial_number", ["date", "serial_number"], ["x"], 3, listed)
        assert sorted(found.collect(), key=str) == expected
        assert found.rdd.getNumPartitions() == 3


def test_serials_of_parts(spark):
    parts = spark.createDataFrame([(7,), (99_999_999,), (100_000_000,), (-5,)], "k long")
    found = parts.select(tables.serial_number(F.col("k")).alias("s"), F.format_string("SN%08d", "k").alias("t")).collect()
    assert [r.s for r in found] == [r.t for r in found]


def test_buckets_hold_half_a_million_readings_at_most(spark, small, monkeypatch):
    rows = tables.read_table(spark, small, "lineitem").count()
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 100)
    assert tables.reading_buckets(spark, small) == -(-rows // 100)


def test_readings_by_drive_are_the_readings(spark, tmp_path):
    folder = lines_and_parts(spark, tmp_path)
    found = tables.smart_raw_by_drive(spark, folder, 6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 6), REPARTITION_BY_NUM") == plan.count("Exchange") == 2 and "ShuffledHashJoin" in plan
    assert sorted(found.collect(), key=str) == sorted(tables.smart_raw(spark, folder).collect(), key=str)


def test_lines_of_busy_parts_are_not_dealt_by_drive(spark, tmp_path, monkeypatch):
    folder = lines_and_parts(spark, tmp_path)
    plain = sorted(tables.smart_daily(spark, folder).collect(), key=str)
    whole = tables.busy_keys

    def dealt(*_):
        raise AssertionError("dealt by drive")

    monkeypatch.setattr(tables, "_stored", {})
    monkeypatch.setattr(tables, "busy_keys", lambda df, column: whole(df, column, 8))
    monkeypatch.setattr(tables, "smart_raw_by_drive", dealt)
    assert sorted(tables.smart_daily(spark, folder).collect(), key=str) == plain


def test_a_task_writes_one_bucket_of_a_table_bucketed_alike(spark, tmp_path):
    day = datetime.date(2001, 1, 1)
    rows = [(day, f"SN{k}", *[None] * 13) for k in range(200)]
    store = snapshot_store.BucketedStore(spark, str(tmp_path / "first"), 9)
    store.write(spark.createDataFrame(rows, SNAPSHOT), "a")
    again = snapshot_store.BucketedStore(spark, str(tmp_path / "second"), 9)
    dealt = again.dealt(spark.table(store.name), "b")
    assert dealt.rdd.getNumPartitions() == 9
    places = dealt.select(F.spark_partition_id().alias("p"), F.pmod(F.hash("serial_number"), F.lit(9)).alias("b"))
    assert places.where("p != b").isEmpty()
    again.write(spark.table(store.name), "b")
    files = again.rows().select(F.input_file_name().alias("f")).distinct()
    assert files.count() == 9 and again.rows().count() == 200
