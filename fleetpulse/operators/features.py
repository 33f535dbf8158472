"""Per-drive rolling features and failure-horizon labels.

All windows share one partitioning (drive) and one order (date), so Spark plans a
single exchange and a single sort for the whole feature set, and none on a table
bucketed by drive. (date, serial_number) is a key, so a drive has at most one row
per day.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetpulse.functions.bands import TB
from fleetpulse.functions.numeric import zero_if_not_finite
from fleetpulse.operators.keys import failure_dates, sample_keys
from fleetpulse.schema import (
    FEATURE_COLUMNS, MODEL_ATTRIBUTES, MONTH_ATTRIBUTES, TRAINING_COLUMNS, WINDOW_ATTRIBUTES,
)


def _frame(length: int, by: str):
    if by == "rows":
        return W.partitionBy("serial_number").orderBy("date").rowsBetween(1 - length, 0)
    if by == "days":
        return W.partitionBy("serial_number").orderBy(F.unix_date("date")).rangeBetween(1 - length, 0)
    raise ValueError(f"by must be 'rows' or 'days', not {by!r}")


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("double")


def rolling_features(df: DataFrame, by: str = "rows", trend: bool = False) -> DataFrame:
    """Ids and model inputs per drive and date.

    Frames count rows by default, as many as 7 or 30 readings; ``by='days'`` counts
    calendar days instead. Drives with a single row are left out. ``trend`` adds the
    slope of reallocated sectors per day over the 30-row frame.
    """
    ordered = W.partitionBy("serial_number").orderBy("date")
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    week, month = _frame(7, by), _frame(30, by)

    columns = {"model": F.first("model").over(whole)}
    columns |= {a: F.col(a) for a in MODEL_ATTRIBUTES}
    for a in WINDOW_ATTRIBUTES:
        x = _filled(a)
        columns[f"{a}_mean_7d"] = F.avg(x).over(week)
        columns[f"{a}_std_7d"] = F.coalesce(F.stddev_samp(x).over(week), F.lit(0.0))
        columns[f"{a}_max_7d"] = F.max(x).over(week)
        if by == "rows":
            before = F.lag(x, 7).over(ordered)
        else:
            day = W.partitionBy("serial_number").orderBy(F.unix_date("date"))
            before = F.max(x).over(day.rangeBetween(-7, -7))
        columns[f"{a}_delta_7d"] = F.coalesce(x - before, F.lit(0.0))
    for a in MONTH_ATTRIBUTES:
        columns[f"{a}_mean_30d"] = F.avg(_filled(a)).over(month)
    temperature = _filled("smart_194_raw")
    columns["temp_mean_7d"] = F.avg(temperature).over(week)
    columns["temp_max_7d"] = F.max(temperature).over(week)
    columns["power_on_hours"] = F.coalesce("smart_9_raw", F.lit(0))
    columns["age_days"] = F.datediff("date", F.first("date").over(whole))
    capacity = F.first("capacity_bytes").over(whole)
    columns["capacity_tb"] = F.when(capacity > 0, capacity / F.lit(float(TB))).otherwise(F.lit(0.0))
    if trend:
        day = F.unix_date("date").cast("double")
        columns["smart_5_trend_30d"] = F.regr_slope(_filled("smart_5_raw"), day).over(month)

    kept = [c for c in df.columns if c not in columns]
    return (
        df.select(*kept, *[c.alias(name) for name, c in columns.items()], F.count("*").over(whole).alias("_rows"))
        .where("_rows >= 2")
        .drop("_rows")
    )


def latest_features(df: DataFrame, by: str = "rows") -> DataFrame:
    """Model inputs at every drive's last date, in the shape of scoring requests.

    The frames look back 30 readings at most, so only a drive's last 30 rows reach them
    (Spark limits them per map task); what depends on its first row comes from an aggregate.
    """
    newest = W.partitionBy("serial_number").orderBy(F.desc("date"))
    tail = df.withColumn("_back", F.row_number().over(newest)).where("_back <= 30")
    latest = rolling_features(tail, by).where("_back = 1").drop("_back")
    first = F.min_by(F.struct("date", "model", "capacity_bytes"), "date").alias("_first")
    first = df.groupBy("serial_number").agg(first)
    capacity = F.col("_first.capacity_bytes")
    of_first = {
        "model": F.col("_first.model"),
        "age_days": F.datediff("date", "_first.date"),
        "capacity_tb": F.when(capacity > 0, capacity / F.lit(float(TB))).otherwise(F.lit(0.0)),
    }
    return latest.join(first, "serial_number").select(*[of_first.get(c, F.col(c)).alias(c) for c in latest.columns])


def add_labels(df: DataFrame) -> DataFrame:
    """Labels from ``failure_date``; drives without one are healthy.

    Rows after the failure date keep their negative distance and False labels.
    """
    days = F.datediff("failure_date", "date")
    return df.select(
        "*",
        F.coalesce(days, F.lit(-1)).alias("days_to_failure"),
        F.coalesce(days.between(0, 30), F.lit(False)).alias("will_fail_30d"),
        F.coalesce(days.between(0, 60), F.lit(False)).alias("will_fail_60d"),
        F.col("failure_date").isNotNull().cast("int").alias("failed"),
    )


def training_drives(
    df: DataFrame, n_healthy: int | None = 3000, seed: int = 42, pick: str = "max"
) -> DataFrame:
    """Serial and failure date of every failed drive, and of a sample of healthy ones.

    ``n_healthy=None`` takes all healthy drives. Both lists are grouped map-side first;
    the failed one reads failure rows only.
    """
    choose = {"max": F.max, "min": F.min}[pick]
    drives = df.groupBy("serial_number").agg(
        choose(F.when(F.col("failure") == 1, F.col("date"))).alias("failure_date")
    )
    if n_healthy is None:
        return drives
    healthy = sample_keys(drives.where(F.col("failure_date").isNull()), n_healthy, seed)
    return failure_dates(df, pick).unionByName(healthy, allowMissingColumns=True)


def training_set(
    df: DataFrame, n_healthy: int | None = 3000, seed: int = 42, pick: str = "max", by: str = "rows"
) -> DataFrame:
    """The labelled training set: 3 ids, 32 model inputs, 4 labels."""
    drives = training_drives(df, n_healthy, seed, pick)
    rows = df.join(drives, "serial_number")
    return add_labels(rolling_features(rows, by)).select(*TRAINING_COLUMNS)


def training_matrix(df: DataFrame, target: str = "will_fail_30d") -> DataFrame:
    """Model inputs without NULL or infinite values, and an integer label."""
    ids = [c for c in ("date", "serial_number") if c in df.columns]
    return df.select(
        *ids,
        *[zero_if_not_finite(F.col(c)).alias(c) for c in FEATURE_COLUMNS],
        F.col(target).cast("int").alias("label"),
    )


def class_distribution(df: DataFrame, label: str = "will_fail_30d") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("samples"))


def feature_table(df: DataFrame, pick: str = "max") -> DataFrame:
    """The narrower stored feature table: one row per drive and date, labels included."""
    rows = df.join(training_drives(df, None, pick=pick), "serial_number")
    built = add_labels(rolling_features(rows, trend=True))
    names = {
        f"smart_5_raw_{s}": f"smart_5_{s}" for s in ("mean_7d", "std_7d", "max_7d", "delta_7d")
    }
    for a in ("187", "197", "198"):
        names |= {f"smart_{a}_raw_{s}": f"smart_{a}_{s}" for s in ("mean_7d", "delta_7d")}
    names["smart_5_raw_mean_30d"] = "smart_5_mean_30d"
    names["smart_5_trend_30d"] = "smart_5_trend_30d"
    names |= {f"smart_{a}_raw_mean_30d": f"smart_{a}_mean_30d" for a in ("187", "197")}
    names |= {"power_on_hours": "power_on_hours", "temp_mean_7d": "temperature_mean"}
    return built.select(
        "serial_number",
        F.col("date").alias("feature_date"),
        *[F.col(old).alias(new) for old, new in names.items()],
        "age_days",
        "days_to_failure",
        "will_fail_30d",
        "will_fail_60d",
    )
