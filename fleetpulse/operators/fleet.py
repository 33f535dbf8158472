"""Fleet and failure-rate reports over daily snapshots.

Distinct drives are counted on a (model, serial_number) rollup or by Spark's own
two-stage distinct, so a hot model, day or band is spread over its drives first.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetpulse.functions.bands import CAPACITY_EDGES, capacity_band, status, weekday_number
from fleetpulse.functions.numeric import rate, round_half_up

# Report name of each indicator.
INDICATORS = {
    "smart_5_raw": "reallocated_sectors",
    "smart_9_raw": "power_on_hours",
    "smart_187_raw": "uncorrectable_errors",
    "smart_194_raw": "temperature",
    "smart_197_raw": "pending_sectors",
    "smart_198_raw": "offline_uncorrectable",
}


def drive_rollup(df: DataFrame) -> DataFrame:
    """One row per (model, serial_number); the other reports shrink to this first."""
    return df.groupBy("model", "serial_number").agg(
        F.count("*").alias("records"),
        F.sum("failure").alias("failures"),
        F.max("failure").alias("failed"),
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
    )


def overview(df: DataFrame, places: int | None = 4, with_dates: bool = False) -> DataFrame:
    """Size of the fleet in one row: records, drives, models, failures, rate, date range."""
    report = overview_of_rollup(drive_rollup(df), places)
    if with_dates:
        report = report.withColumn("unique_dates", df.agg(F.countDistinct("date")).scalar())
    return report


def overview_of_rollup(rollup: DataFrame, places: int | None = 4) -> DataFrame:
    out = [
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.countDistinct("serial_number").alias("unique_drives"),
        F.countDistinct("model").alias("unique_models"),
        F.sum("failures").alias("total_failures"),
        F.min("first_seen").alias("first_date"),
        F.max("last_seen").alias("last_date"),
    ]
    if places is not None:
        out.append(rate(F.sum("failures"), F.sum("records"), 100.0, places).alias("failure_rate_pct"))
    return rollup.agg(*out)


def monthly(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.trunc("date", "month").alias("month"))
        .agg(
            F.count("*").alias("records"),
            F.countDistinct("serial_number").alias("active_drives"),
            F.sum("failure").alias("failures"),
        )
        .orderBy("month")
    )


def failure_by_model(
    df: DataFrame, min_drives: int = 100, limit: int = 20, places: int = 4
) -> DataFrame:
    """Failure rate per model with at least ``min_drives`` drives, worst first."""
    return (
        drive_rollup(df)
        .groupBy("model")
        .agg(F.count("serial_number").alias("total_drives"), F.sum("failures").alias("failures"))
        .where(F.col("total_drives") >= min_drives)
        .withColumn("failure_rate_pct", rate(F.col("failures"), F.col("total_drives"), 100.0, places))
        .orderBy(F.desc("failure_rate_pct"), "model")
        .limit(limit)
    )


def failures_by_weekday(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(
            weekday_number(F.col("date")).alias("day_of_week"),
            F.date_format("date", "EEEE").alias("day_name"),
        )
        .agg(F.sum("failure").alias("failures"))
        .orderBy("day_of_week")
    )


def indicator_means(df: DataFrame, places: int | None = 2) -> DataFrame:
    """Mean of every indicator over failure rows and over all other rows."""
    means = []
    for column, name in INDICATORS.items():
        mean = F.avg(column)
        means.append((mean if places is None else round_half_up(mean, places)).alias(f"avg_{name}"))
    return df.groupBy(status(F.col("failure")).alias("status")).agg(*means)


def divergence(df: DataFrame) -> DataFrame:
    """How many times higher an indicator is on failure rows; healthy means count as 1 at least."""
    ratios = []
    for column in ("smart_5_raw", "smart_197_raw", "smart_187_raw"):
        failed = F.avg(F.when(F.col("failure") == 1, F.col(column)))
        healthy = F.avg(F.when(status(F.col("failure")) == "Healthy", F.col(column)))
        ratios.append((failed / F.greatest(healthy, F.lit(1.0))).alias(f"{INDICATORS[column]}_ratio"))
    return df.agg(*ratios)


def annualized_failure_rate(df: DataFrame, min_drives: int = 100, limit: int = 20) -> DataFrame:
    """Failures per model set against observed days.

    ``annualized_failure_rate`` divides by the integer mean of observed days, as the
    report has always done; ``afr_pct`` is the percentage per drive-year.
    """
    days = F.datediff("last_seen", "first_seen")
    total_days, drives, failures = F.col("_days"), F.col("total_drives"), F.col("failures")
    return (
        drive_rollup(df)
        .groupBy("model")
        .agg(
            F.count("*").alias("total_drives"),
            F.sum("failed").alias("failures"),
            F.sum(days).alias("_days"),
        )
        .where((drives >= min_drives) & (total_days > 0))
        .select(
            "model",
            "total_drives",
            "failures",
            round_half_up(total_days / drives, 1).alias("avg_observation_days"),
            rate(failures, F.expr("_days div total_drives"), 365.0, 4).alias("annualized_failure_rate"),
            rate(failures, total_days, 36500.0, 4).alias("afr_pct"),
        )
        .orderBy(F.desc_nulls_last("annualized_failure_rate"), "model")
        .limit(limit)
    )


def failures_by_capacity(
    df: DataFrame, bands: str = "wide", skip_unknown: bool = False, order: str = "label",
    with_rate: bool = True,
) -> DataFrame:
    """Drives and failures per capacity band, ordered by label or by capacity."""
    known = df.where(F.col("capacity_bytes").isNotNull()) if skip_unknown else df
    out = known.groupBy(
        capacity_band(F.col("capacity_bytes"), CAPACITY_EDGES[bands]).alias("capacity_range")
    ).agg(
        F.countDistinct("serial_number").alias("drives"),
        F.sum("failure").alias("failures"),
        F.min("capacity_bytes").alias("_smallest"),
    )
    if with_rate:
        out = out.withColumn("failure_rate_pct", rate(F.col("failures"), F.col("drives")))
    return out.orderBy("capacity_range" if order == "label" else "_smallest").drop("_smallest")


def daily(df: DataFrame, with_rate: bool = True) -> DataFrame:
    """Active drives and failures per day, with failures per 100,000 drives."""
    out = df.groupBy("date").agg(
        F.countDistinct("serial_number").alias("active_drives"),
        F.sum("failure").alias("daily_failures"),
    )
    if with_rate:
        out = out.withColumn(
            "failures_per_100k", rate(F.col("daily_failures"), F.col("active_drives"), 100000.0)
        )
    return out.orderBy("date")


def failure_trend(df: DataFrame, days: int = 7) -> DataFrame:
    """Moving average of the fleet's daily failures.

    The window has no partition key: its input is one row per calendar day.
    """
    w = W.orderBy("date").rowsBetween(1 - days, 0)
    return (
        df.groupBy("date")
        .agg(F.sum("failure").alias("failures"))
        .select("date", "failures", round_half_up(F.avg("failures").over(w), 2).alias(f"rolling_{days}d_avg"))
        .orderBy("date")
    )


def recent_failures(df: DataFrame, limit: int = 50) -> DataFrame:
    return (
        df.where(F.col("failure") == 1)
        .select(
            "serial_number",
            "model",
            F.col("date").alias("failure_date"),
            *[
                F.col(c).alias(INDICATORS[c])
                for c in ("smart_5_raw", "smart_187_raw", "smart_197_raw", "smart_198_raw", "smart_194_raw")
            ],
        )
        .orderBy(F.desc("failure_date"), "serial_number")
        .limit(limit)
    )


def elevated() -> Column:
    """Any of the three leading indicators above its threshold."""
    return (F.col("smart_5_raw") > 100) | (F.col("smart_187_raw") > 0) | (F.col("smart_197_raw") > 0)


def watchlist(df: DataFrame, limit: int | None = 100) -> DataFrame:
    """Healthy rows with an elevated indicator, highest reallocated count first, unknown before that."""
    out = df.where((F.col("failure") == 0) & elevated()).select(
        "serial_number",
        "model",
        "date",
        *[F.col(c).alias(INDICATORS[c]) for c in ("smart_5_raw", "smart_187_raw", "smart_197_raw")],
    )
    if limit is None:
        return out
    return out.orderBy(F.desc_nulls_first("reallocated_sectors"), "serial_number", "date").limit(limit)


def pending_sector_alerts(df: DataFrame, threshold: int = 100) -> DataFrame:
    """Rows whose pending sectors call for backup and replacement."""
    return df.where(F.col("smart_197_raw") > threshold).select(
        "serial_number", "model", "date", F.col("smart_197_raw").alias("pending_sectors")
    )


def drive_registry(df: DataFrame) -> DataFrame:
    """One row per drive: latest model and capacity, observed range, failure."""
    latest = F.max_by(F.struct("model", "capacity_bytes"), F.struct("date", "model", "capacity_bytes"))
    return (
        df.groupBy("serial_number")
        .agg(
            latest.alias("_latest"),
            F.min("date").alias("first_seen"),
            F.max("date").alias("last_seen"),
            F.count("*").cast("int").alias("total_days"),
            F.coalesce(F.max(F.col("failure") == 1), F.lit(False)).alias("failed"),
            F.max(F.when(F.col("failure") == 1, F.col("date"))).alias("failure_date"),
        )
        .select(
            "serial_number",
            F.col("_latest.model").alias("model"),
            F.col("_latest.capacity_bytes").alias("capacity_bytes"),
            "first_seen",
            "last_seen",
            "total_days",
            "failed",
            "failure_date",
            F.current_timestamp().alias("created_at"),
        )
    )


def largest_models(drives: DataFrame, limit: int = 5, min_drives: int = 100) -> DataFrame:
    """The models with most drives; those below ``min_drives`` are left out of the top."""
    return (
        drives.groupBy("model")
        .agg(F.count("*").alias("drives"))
        .orderBy(F.desc("drives"), "model")
        .limit(limit)
        .where(F.col("drives") >= min_drives)
    )
