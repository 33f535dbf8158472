"""Remaining useful life and sensor profiles of run-to-failure series."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleetpulse.functions.ordered import exact_percentiles
from fleetpulse.schema import CONSTANT_SENSORS


def sensor_columns(df: DataFrame) -> list[str]:
    return sorted((c for c in df.columns if c.startswith("sensor_")), key=lambda c: int(c[7:]))


def useful_sensors(df: DataFrame, constant: list[str] = CONSTANT_SENSORS) -> list[str]:
    """Sensor columns without the known constant ones."""
    return [c for c in sensor_columns(df) if c not in constant]


def life_spans(df: DataFrame) -> DataFrame:
    """Longest cycle of every engine."""
    return df.groupBy("engine_id").agg(F.max("cycle").alias("max_cycle"))


def remaining_life(df: DataFrame) -> DataFrame:
    """Add ``RUL``: cycles left until the engine's last one.

    A map-side maximum joined back to its rows, without a window. The join has one more key
    than the maximum's grouping, so where the maxima are too many to broadcast it does not
    run in the grouping's tasks, and the adaptive skew split reaches an engine with very
    many rows.
    """
    own = F.xxhash64("engine_id").alias("_own")
    spans = life_spans(df).select("engine_id", own, "max_cycle")
    return (
        df.select("*", own)
        .join(spans, ["engine_id", "_own"])
        .withColumn("RUL", F.col("max_cycle") - F.col("cycle"))
        .select(*df.columns, "RUL")
    )


def shape(df: DataFrame) -> DataFrame:
    """Rows, engines and columns."""
    return df.agg(
        F.count("*").alias("rows"),
        F.countDistinct("engine_id").alias("engines"),
        F.lit(len(df.columns)).alias("columns"),
    )


def life_statistics(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of engine lives."""
    return describe(life_spans(df), "max_cycle")


def describe(df: DataFrame, value: str) -> DataFrame:
    """Summary of one column in one row, quartiles exact."""
    moments = df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_percentiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return _side_by_side(moments, quartiles)


def target_summary(df: DataFrame, value: str = "RUL") -> DataFrame:
    """Minimum, maximum, mean, sample deviation and median of the target."""
    return describe(df, value).select("min", "max", "mean", "std", F.col("p50").alias("median"))


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames as one."""
    whole = F.struct(*right.columns).alias("_right")
    return left.withColumn("_right", right.select(whole).scalar()).select(*left.columns, "_right.*")


def _per_sensor(df: DataFrame, sensors: list[str], measures: dict[str, object]) -> DataFrame:
    """Aggregate every sensor in one pass; one row per sensor."""
    wide = df.agg(*[make(s).alias(f"{s}_{name}") for s in sensors for name, make in measures.items()])
    lines = [
        F.struct(F.lit(s).alias("sensor"), *[F.col(f"{s}_{name}").alias(name) for name in measures])
        for s in sensors
    ]
    return wide.select(F.inline(F.array(*lines)))


def sensor_profile(df: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Mean, deviation, extremes and coefficient of variation of every sensor."""
    profile = _per_sensor(
        df,
        sensor_columns(df),
        {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
    )
    cv = F.try_divide("std", "mean")
    return profile.withColumn("cv", cv).withColumn(
        "variation", F.when(cv > threshold, "HIGH").when(cv <= threshold, "LOW")
    )


def most_varying(profile: DataFrame, limit: int = 10) -> DataFrame:
    return profile.where(F.col("variation") == "HIGH").orderBy(F.desc("cv"), "sensor").limit(limit)


def target_correlations(df: DataFrame, sensors: list[str] | None = None, target: str = "RUL") -> DataFrame:
    """Pearson correlation of every useful sensor with the target, lowest first.

    A sensor that never changes has none (NULL).
    """
    sensors = useful_sensors(df) if sensors is None else sensors

    def correlation(sensor: str) -> Column:
        spread = F.stddev_pop(sensor) * F.stddev_pop(target)
        return F.when(F.min(sensor) != F.max(sensor), F.try_divide(F.covar_pop(sensor, target), spread))

    return _per_sensor(df, sensors, {"correlation": correlation}).orderBy(
        F.asc_nulls_last("correlation"), "sensor"
    )


def extremes(correlations: DataFrame, lowest: int = 7, highest: int = 3) -> DataFrame:
    """The most negative and the most positive correlations."""
    known = correlations.where(F.col("correlation").isNotNull())
    parts = [
        known.orderBy("correlation", "sensor").limit(lowest).withColumn("side", F.lit("lowest")),
        known.orderBy(F.desc("correlation"), "sensor").limit(highest).withColumn("side", F.lit("highest")),
    ]
    return reduce(DataFrame.unionByName, parts)


def equal_width_histogram(df: DataFrame, value: str = "RUL", bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equal-width bins, the last one closed; empty bins count 0."""
    limits = df.agg(F.struct(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high")))
    span = limits.scalar()
    width = (F.col("_span.high") - F.col("_span.low")) / bins
    bin_of = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_span.low")) / width), F.lit(bins - 1)))
    counts = (
        df.where(F.col(value).isNotNull())
        .select(value, span.alias("_span"))
        .groupBy(F.coalesce(bin_of, F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("observations"))
    )
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = every_bin.withColumn("_span", span)
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("_span.low") + F.col("bin") * width).alias("low_edge"),
        (F.col("_span.low") + (F.col("bin") + 1) * width).alias("high_edge"),
        F.coalesce("observations", F.lit(0)).alias("observations"),
    )


def degradation_paths(
    df: DataFrame, engines: list[int] = (1, 50, 100), sensors: list[str] | None = None
) -> DataFrame:
    """Sensor readings against remaining life for chosen engines, in long form."""
    sensors = useful_sensors(df) if sensors is None else sensors
    return df.where(F.col("engine_id").isin(list(engines))).unpivot(
        ["engine_id", "cycle", "RUL"], sensors, "sensor", "value"
    )


def engine_tables(df: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame]:
    """The stored shape of a series: one row per engine, and the readings with their target."""
    engines = life_spans(df).withColumn("dataset", F.lit(dataset))
    readings = remaining_life(df).withColumnRenamed("RUL", "rul")
    return engines, readings
