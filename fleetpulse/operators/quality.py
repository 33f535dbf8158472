"""Data-quality audit of daily snapshots. Every check is a frame; ``report`` joins them up."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetpulse.functions.numeric import round_half_up
from fleetpulse.operators.fleet import drive_rollup, overview, overview_of_rollup
from fleetpulse.schema import SNAPSHOT_KEY
from fleetpulse.session import settle

# Audited columns, allowed ranges and expected types.
MISSING_COLUMNS = [
    "serial_number", "model", "capacity_bytes", "smart_5_raw", "smart_9_raw", "smart_187_raw",
    "smart_194_raw", "smart_197_raw", "smart_198_raw",
]
VALID_RANGES = {
    "smart_5_raw": (0, 100000),
    "smart_9_raw": (0, 200000),
    "smart_187_raw": (0, 100000),
    "smart_194_raw": (0, 100),
    "smart_197_raw": (0, 100000),
    "smart_198_raw": (0, 100000),
}
EXPECTED_TYPES = {
    "date": ["date"],
    "serial_number": ["string"],
    "model": ["string"],
    "capacity_bytes": ["bigint"],
    "failure": ["smallint", "int"],
    "smart_5_raw": ["bigint"],
    "smart_9_raw": ["bigint"],
}


def basic_statistics(df: DataFrame) -> DataFrame:
    return overview(df, places=None, with_dates=True).drop("total_failures")


def duplicate_keys(df: DataFrame, keys: list[str] = SNAPSHOT_KEY) -> DataFrame:
    """Number of keys that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return repeated.agg(F.count("*").alias("duplicate_count")).withColumn(
        "status", F.when(F.col("duplicate_count") == 0, "PASS").otherwise("WARN")
    )


def _missing_counts(columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns]


def _missing_line(column: str) -> Column:
    share = F.try_divide(F.lit(100.0) * F.col(f"{column}_null"), F.col("_total").cast("double"))
    return F.struct(
        F.lit(column).alias("column_name"),
        F.col(f"{column}_null").alias("null_count"),
        round_half_up(share, 2).alias("null_pct"),
        F.when(share < 1, "PASS").when(share < 10, "INFO").otherwise("WARN").alias("status"),
    )


def _range_counts(ranges: dict[str, tuple[int, int]]) -> list[Column]:
    return [
        aggregate
        for c, (low, high) in ranges.items()
        for aggregate in (
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(f"{c}_out"),
        )
    ]


def _range_line(column: str) -> Column:
    return F.struct(
        F.lit(column).alias("column_name"),
        F.col(f"{column}_min").alias("min_val"),
        F.col(f"{column}_max").alias("max_val"),
        F.col(f"{column}_out").alias("outliers"),
        F.when(F.col(f"{column}_out") == 0, "PASS").otherwise("WARN").alias("status"),
    )


def missing_values(df: DataFrame, columns: list[str] = MISSING_COLUMNS) -> DataFrame:
    """NULL count and share per column, from one pass."""
    counts = df.agg(F.count("*").alias("_total"), *_missing_counts(columns))
    return counts.select(F.inline(F.array(*[_missing_line(c) for c in columns])))


def outliers(df: DataFrame, ranges: dict[str, tuple[int, int]] = VALID_RANGES) -> DataFrame:
    """Minimum, maximum and readings out of range per column, from one pass."""
    return df.agg(*_range_counts(ranges)).select(F.inline(F.array(*[_range_line(c) for c in ranges])))


def type_conformance(df: DataFrame, expected: dict[str, list[str]] = EXPECTED_TYPES) -> DataFrame:
    """Actual against expected type of every expected column that is present."""
    actual = dict(df.dtypes)
    rows = [
        (c, actual[c], "PASS" if actual[c] in allowed else "WARN")
        for c, allowed in expected.items()
        if c in actual
    ]
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("column_name", "data_type", "status")]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def describe_columns(df: DataFrame) -> DataFrame:
    """Name, type, position and nullability of every column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal_position int, column_name string, data_type string, is_nullable boolean"
    )


def catalog_tables(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """Tables and views of the current schema and of the session, by the session's catalog."""
    listed = spark.sql(f"SHOW TABLES LIKE '{pattern}'")
    return listed.select(F.col("tableName").alias("table_name"), F.col("isTemporary").alias("is_temporary"))


def catalog_columns(spark: SparkSession, names: list[str]) -> DataFrame:
    """``describe_columns`` of the named tables and views, with their names; no row of them is read."""
    parts = [describe_columns(spark.table(n)).select(F.lit(n).alias("table_name"), "*") for n in names]
    return reduce(DataFrame.unionByName, parts)


def daily_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(
        F.count("*").alias("record_count"), F.countDistinct("serial_number").alias("drive_count")
    )


def _row_count(df: DataFrame) -> Column:
    """Rows of a frame, or of the frame a rollup with a ``records`` column stands for."""
    return F.sum("records") if "records" in df.columns else F.count("*")


def missing_days(df: DataFrame) -> DataFrame:
    """Calendar days between the first and last snapshot that have no row."""
    days = df.select("date").distinct()
    spine = days.agg(F.min("date").alias("low"), F.max("date").alias("high")).select(
        F.explode(F.sequence("low", "high")).alias("date")
    )
    return spine.join(days, "date", "left_anti")


def continuity(df: DataFrame) -> DataFrame:
    """Expected, actual and missing days in one row."""
    return (
        df.select("date")
        .distinct()
        .agg(
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            (F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("expected_days"),
            F.count("date").alias("actual_days"),
        )
        .withColumn("missing_days", F.col("expected_days") - F.col("actual_days"))
        .withColumn("status", F.when(F.col("missing_days") == 0, "PASS").otherwise("INFO"))
    )


def anomalous_days(df: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Days whose row count is more than ``deviations`` sample deviations from the mean."""
    counts = df.groupBy("date").agg(_row_count(df).alias("record_count"))
    mean = counts.agg(F.avg("record_count")).scalar()
    deviation = counts.agg(F.stddev_samp("record_count")).scalar()
    return counts.where(F.abs(F.col("record_count") - mean) > F.lit(deviations) * deviation)


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("failure").agg(_row_count(df).alias("records")).orderBy("failure")


def multi_failure_drives(df: DataFrame) -> DataFrame:
    """Number of drives with more than one failure row."""
    return (
        df.groupBy("serial_number")
        .agg(F.sum("failure").alias("_failures"))
        .where("_failures > 1")
        .agg(F.count("*").alias("multi_fail_drives"))
        .withColumn("status", F.when(F.col("multi_fail_drives") == 0, "PASS").otherwise("INFO"))
    )


def drives_with_several_models(df: DataFrame) -> DataFrame:
    """Serial numbers reported under more than one model."""
    return (
        df.groupBy("serial_number")
        .agg(F.countDistinct("model").alias("models"))
        .where(F.col("models") > 1)
    )


def report(df: DataFrame) -> DataFrame:
    """All findings in long form: check, subject, value, status.

    Four passes over the snapshots: one for all columns, one per drive, one per
    day and label, one for the keys. The rollups are stored and feed several checks.
    """
    by_drive = settle(drive_rollup(df), "audit-drives")
    by_day = settle(df.groupBy("date", "failure").agg(F.count("*").alias("records")), "audit-days")

    def entry(check: str, subject: Column, value: Column, status: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            subject.alias("subject"),
            value.cast("double").alias("value"),
            status.alias("status"),
        )

    def lines(frame: DataFrame, *entries: Column) -> DataFrame:
        return frame.select(F.inline(F.array(*entries)))

    state, passed = F.col("status"), F.lit("PASS")
    size = overview_of_rollup(by_drive, None)
    profile = df.agg(
        F.count("*").alias("_total"), *_missing_counts(MISSING_COLUMNS), *_range_counts(VALID_RANGES)
    )
    missing = [
        entry("missing", F.lit(c), _missing_line(c)["null_pct"], _missing_line(c)["status"])
        for c in MISSING_COLUMNS
    ]
    ranges = [
        entry("outliers", F.lit(c), _range_line(c)["outliers"], _range_line(c)["status"])
        for c in VALID_RANGES
    ]
    unusual = anomalous_days(by_day).agg(F.count("*").alias("n"))
    per_drive = by_drive.withColumnRenamed("failures", "failure")
    parts = [
        lines(
            size,
            *[
                entry("statistics", F.lit(c), F.col(c), passed)
                for c in ("total_records", "unique_drives", "unique_models")
            ],
        ),
        lines(
            continuity(by_day),
            entry("statistics", F.lit("unique_dates"), F.col("actual_days"), passed),
            entry("continuity", F.lit("missing_days"), F.col("missing_days"), state),
        ),
        lines(duplicate_keys(df), entry("duplicates", F.lit("date, serial_number"), F.col("duplicate_count"), state)),
        lines(profile, *missing, *ranges),
        lines(
            type_conformance(df),
            entry("types", F.col("column_name"), F.when(state == "PASS", 0).otherwise(1), state),
        ),
        lines(
            unusual,
            entry("volume", F.lit("anomalous_days"), F.col("n"), F.when(F.col("n") == 0, "PASS").otherwise("INFO")),
        ),
        lines(
            label_distribution(by_day),
            entry("labels", F.coalesce(F.col("failure").cast("string"), F.lit("NULL")), F.col("records"), passed),
        ),
        lines(
            multi_failure_drives(per_drive),
            entry("labels", F.lit("multi_fail_drives"), F.col("multi_fail_drives"), state),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
