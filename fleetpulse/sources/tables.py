"""Snapshot and sensor frames derived from the star-schema and event tables.

The fleet tables are views over ``lineitem``, ``part`` and ``events``: one line
item is one reading of the device its part stands for, one event is one cycle.
"""

import math
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from fleetpulse.functions.ordered import row_numbers
from fleetpulse.operators.keys import busy_keys, one_row_per_key, one_row_per_key_within
from fleetpulse.schema import SNAPSHOT, SNAPSHOT_KEY
from fleetpulse.session import shared_folder

BYTES_PER_BUCKET = 16 * 1024 * 1024  # of Parquet: about a million readings, some 250 MB in a sort
ROWS_PER_BUCKET = 500_000  # of readings, whatever their files' compression: some 200 MB in the store's two sorts
MAX_BUCKETS = 20_000  # keeps the number of shuffle blocks in hand at load
TIE_BREAK = ["l_orderkey", "l_linenumber", "l_suppkey", "smart_9_raw"]

_stored: dict[tuple[str, str, str], str] = {}
_lock = threading.Lock()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def serial_number(part_key: Column) -> Column:
    """The drive that a part stands for: SN and eight digits, or more."""
    number = part_key.cast("long")
    digits = F.concat(F.lit("SN"), F.lpad(number.cast("string"), 8, "0"))
    return F.when(number.between(0, 99_999_999), digits).otherwise(F.format_string("SN%08d", number))


def smart_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as they arrive, with repeated (date, serial_number) keys."""
    item = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    return item.join(part, item.l_partkey == part.p_partkey).select(*_reading(serial_number(F.col("l_partkey")), _capacity()))


def smart_raw_by_drive(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    """``smart_raw`` in ``buckets`` partitions by drive: lines are shuffled once, as they are, and meet their parts there.

    However many parts there are, a partition holds only its own.
    """
    lines = read_table(spark, sf_dir, "lineitem").where(F.col("l_partkey").isNotNull()).select(
        serial_number(F.col("l_partkey")).alias("serial_number"), "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
        "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    parts = read_table(spark, sf_dir, "part").where(F.col("p_partkey").isNotNull()).select(
        serial_number(F.col("p_partkey")).alias("_drive"), "p_type", "p_size"
    )
    # What is computed above the shuffles keeps their number of partitions for the join.
    lines = lines.repartition(buckets, "serial_number").withColumn("l_shipdate", F.to_date("l_shipdate"))
    parts = parts.repartition(buckets, "_drive").withColumn("_capacity", _capacity())
    joined = lines.join(parts.hint("shuffle_hash"), lines.serial_number == parts._drive)
    return joined.select(*_reading(F.col("serial_number"), F.col("_capacity")))


def _capacity() -> Column:
    return F.when(F.col("p_size") % 17 != 0, F.col("p_size").cast("long") * 400_000_000_000)


def _reading(serial: Column, capacity: Column) -> list[Column | str]:
    """The columns of a reading, from a line item joined with its part."""
    quantity = F.col("l_quantity").cast("long")
    returned = F.col("l_returnflag") == "R"
    return [
        F.to_date("l_shipdate").alias("date"),
        serial.alias("serial_number"),
        F.col("p_type").alias("model"),
        capacity.alias("capacity_bytes"),
        F.when(
            returned & (F.col("l_linestatus") == "F") & (F.col("l_quantity") >= 47) & (F.col("l_linenumber") >= 4), 1
        ).otherwise(0).alias("failure"),
        F.when(F.col("l_linenumber") == 7, F.lit(None))
        .when(F.col("l_quantity") >= 45, (quantity - 44) * 40)
        .otherwise(0).cast("long").alias("smart_5_raw"),
        F.floor("l_extendedprice").cast("long").alias("smart_9_raw"),
        F.when(quantity % 10 == 0, F.lit(None))
        .when(F.col("l_quantity") >= 48, quantity - 47)
        .otherwise(0).cast("long").alias("smart_187_raw"),
        (F.col("l_linenumber").cast("long") - 1).alias("smart_188_raw"),
        F.when((F.col("l_quantity") == 50) & (F.col("l_linenumber") == 1), 120)
        .otherwise(20 + quantity % 30).cast("long").alias("smart_194_raw"),
        F.when(returned & (F.col("l_quantity") >= 40), (quantity - 39) * 8)
        .otherwise(0).cast("long").alias("smart_197_raw"),
        F.when(returned & (F.col("l_quantity") >= 45), quantity - 44)
        .otherwise(0).cast("long").alias("smart_198_raw"),
        (F.col("l_suppkey") % 5).alias("smart_199_raw"),
        (quantity * 1_000_000).alias("smart_241_raw"),
        (quantity * 2_000_000).alias("smart_242_raw"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
    ]


def smart_daily_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``smart_raw`` with one row per (date, serial_number), not yet stored."""
    return one_row_per_key(smart_raw(spark, sf_dir), SNAPSHOT_KEY, TIE_BREAK).select(*SNAPSHOT.fieldNames())


def bucket_count(spark: SparkSession, path: str, bytes_per_bucket: int = BYTES_PER_BUCKET) -> int:
    """Buckets for a table derived from ``path``: one per core, more as its files grow."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    size = files.agg(F.sum("length")).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    return min(max(cores, math.ceil(size / bytes_per_bucket)), MAX_BUCKETS)


def reading_buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets for the readings: by the bytes of their files, and at most half a million rows each."""
    rows = read_table(spark, sf_dir, "lineitem").count()  # kept in the files' footers
    buckets = max(bucket_count(spark, os.path.join(sf_dir, "lineitem.parquet")), math.ceil(rows / ROWS_PER_BUCKET))
    return min(buckets, MAX_BUCKETS)


def smart_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table: loaded once per session, then scanned by every query.

    Stored in the shared folder as Parquet, bucketed and sorted by drive, so that
    per-drive groupings, joins and windows read it without a shuffle. The key is
    unique, which bounds a drive's rows by the number of days.
    """
    def store(name: str, path: str) -> None:
        buckets = reading_buckets(spark, sf_dir)
        parts = busy_keys(read_table(spark, sf_dir, "lineitem").select("l_partkey"), "l_partkey")
        # The many lines of a busy part must not meet in one task before their copies are gone.
        readings = smart_raw_by_drive(spark, sf_dir, buckets) if parts.isEmpty() else smart_raw(spark, sf_dir)
        busy = parts.select(serial_number(F.col("l_partkey")).alias("serial_number"))
        (
            one_row_per_key_within(readings, "serial_number", SNAPSHOT_KEY, TIE_BREAK, buckets, busy)
            .select(*SNAPSHOT.fieldNames())
            .write.bucketBy(buckets, "serial_number")
            .sortBy("serial_number", "date")
            .option("path", path)
            .saveAsTable(name)
        )

    return spark.table(_stored_once(spark, sf_dir, "smart_daily", store))


def _stored_once(
    spark: SparkSession, sf_dir: str, table: str, store: Callable[[str, str], None]
) -> str:
    """Name of the session's stored copy of ``table``, written at its first use."""
    slot = (spark.conf.get("spark.app.id"), os.path.abspath(sf_dir), table)
    with _lock:
        if slot not in _stored:
            name = f"{table}_{uuid.uuid4().hex}"
            store(name, os.path.join(shared_folder(spark), name))
            _stored[slot] = name
    return _stored[slot]


def smart_surv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survival input: all rows of ``smart_daily``, each drive's dates drawn together by a factor of its own.

    The factor, 1/97 to 1 by the drive's number, spreads the lifetimes; no row is dropped.
    """
    number = F.substring("serial_number", 3, 18).cast("long")
    origin = F.lit("1992-01-01").cast("date")
    days = F.date_diff("date", origin).cast("long") * (1 + number % 97)
    return smart_daily(spark, sf_dir).withColumn("date", F.date_add(origin, F.floor(days / 97).cast("int")))


def engine_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-to-failure series: the n-th event of a user is cycle n of an engine."""
    # One slice per minute: even a user with a third of all events is spread over the
    # minutes the table covers, and has at most one offset per minute.
    events = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    numbered = row_numbers(
        events, "user_id", ["ts", "event_id"], F.date_trunc("minute", "ts"), "cycle"
    )
    # Ids and cycles stay long: a very long series has more cycles than an int holds.
    cycle = F.col("cycle")
    return numbered.select(
        F.col("user_id").alias("engine_id"),
        "cycle",
        F.col("value").alias("sensor_2"),
        (F.col("event_id") % 100 + F.lit(0.5)).alias("sensor_3"),
        F.lit(518.67).alias("sensor_1"),
        (F.lit(600.0) + F.lit(0.25) * cycle + F.col("value") / F.lit(1000.0)).alias("sensor_4"),
        (F.lit(550.0) - F.lit(0.10) * cycle).alias("sensor_7"),
    )


def engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run-to-failure series, stored once per session."""
    def store(name: str, path: str) -> None:
        engine_plan(spark, sf_dir).write.option("path", path).saveAsTable(name)

    return spark.table(_stored_once(spark, sf_dir, "engine", store))
