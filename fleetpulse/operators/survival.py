"""Survival and reliability statistics over drive lifetimes.

Lifetimes are whole days, so a grouped histogram (t, n, d) holds the full sample in
at most one row per day and model. It is built with map-side combine; the estimators
then work on the histogram, all models in parallel.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetpulse.functions.bands import failure_regime
from fleetpulse.functions.numeric import chi_square_tail, gamma

# The box the Weibull parameters are fitted in.
SHAPE_BOUNDS = (0.1, 10.0)
SCALE_BOUNDS = (1.0, 10000.0)
BISECTIONS = 60


def lifetimes(df: DataFrame) -> DataFrame:
    """Observed lifetime of every (serial_number, model), both end days included."""
    return (
        df.groupBy("serial_number", "model")
        .agg(
            F.min("date").alias("first_seen"),
            F.max("date").alias("last_seen"),
            F.max("failure").alias("failed"),
        )
        .withColumn("lifetime_days", F.datediff("last_seen", "first_seen") + 1)
        .select("serial_number", "model", "first_seen", "last_seen", "lifetime_days", "failed")
    )


def lifetime_histogram(lives: DataFrame, by: list[str] = ()) -> DataFrame:
    """Drives ``n`` and failures ``d`` per lifetime ``t``."""
    return (
        lives.where(F.col("lifetime_days") > 0)
        .groupBy(*by, F.col("lifetime_days").alias("t"))
        .agg(F.count("*").alias("n"), F.sum("failed").alias("d"))
    )


def _bisect(too_far, bounds: tuple[float, float]) -> Column:
    """Root in ``bounds`` of a function that ``too_far`` reports to lie left of a point."""

    def halve(at: Column, _):
        middle = (at["low"] + at["high"]) / 2
        return F.when(
            too_far(middle), F.struct(at["low"].alias("low"), middle.alias("high"))
        ).otherwise(F.struct(middle.alias("low"), at["high"].alias("high")))

    start = F.struct(F.lit(bounds[0]).alias("low"), F.lit(bounds[1]).alias("high"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(BISECTIONS)), start, halve, lambda at: (at["low"] + at["high"]) / 2
    )


def weibull_fit(
    histogram: DataFrame,
    by: list[str] = (),
    scale_bounds: tuple[float, float] = SCALE_BOUNDS,
    shape_bounds: tuple[float, float] = SHAPE_BOUNDS,
) -> DataFrame:
    """Censored Weibull maximum likelihood per group: ``shape`` and ``scale`` inside their box.

    The scale that maximises the likelihood for a given shape is known in closed form,
    which leaves one increasing score in the shape, solved by bisection. Where that
    scale leaves its bounds it is fixed there and the shape is solved again. Groups
    without a failure have no fit (NULL).
    """
    point = F.struct(
        F.col("t").cast("double").alias("t"), F.col("n").cast("double").alias("n"), F.col("d").cast("double").alias("d")
    )
    if by:
        # The histogram is small: keep Spark from fitting all groups in one task.
        cores = histogram.sparkSession.sparkContext.defaultParallelism
        histogram = histogram.repartition(cores, *by)
    # One array element per distinct day count, however many drives there are.
    samples = histogram.groupBy(*by).agg(
        F.sum("n").alias("drives"),
        F.sum("d").alias("failures"),
        F.max("t").cast("double").alias("_longest"),
        F.sum(F.col("d") * F.ln("t")).alias("_log_failed"),
        F.sort_array(F.collect_list(point)).alias("_points"),
    )
    scaled = F.transform(
        "_points",
        lambda p: F.struct(
            (p["t"] / F.col("_longest")).alias("x"),
            p["n"].alias("n"),
            (p["n"] * F.ln(p["t"] / F.col("_longest"))).alias("nlx"),
        ),
    )
    samples = samples.withColumn("_scaled", scaled)
    failures = F.col("failures").cast("double")
    mean_log = F.col("_log_failed") / failures - F.ln("_longest")

    def mass(shape: Column) -> Column:
        return F.aggregate(
            "_scaled", F.lit(0.0), lambda total, p: total + p["n"] * F.pow(p["x"], shape)
        )

    def log_mass(shape: Column) -> Column:
        return F.aggregate(
            "_scaled", F.lit(0.0), lambda total, p: total + p["nlx"] * F.pow(p["x"], shape)
        )

    def profile_positive(shape: Column) -> Column:
        return log_mass(shape) / mass(shape) - F.lit(1.0) / shape - mean_log > 0

    has_failures = F.col("failures") > 0
    fitted = samples.withColumn("_shape", F.when(has_failures, _bisect(profile_positive, shape_bounds)))
    free_scale = F.col("_longest") * F.pow(
        mass(F.col("_shape")) / failures, F.lit(1.0) / F.col("_shape")
    )
    fitted = fitted.withColumn("_free", free_scale).withColumn(
        "scale", F.least(F.greatest("_free", F.lit(scale_bounds[0])), F.lit(scale_bounds[1]))
    )
    # Score in the shape with the scale fixed; decreasing.
    ratio_to_scale = F.ln(F.col("_longest") / F.col("scale"))

    def fixed_scale_negative(shape: Column) -> Column:
        growth = F.pow(F.col("_longest") / F.col("scale"), shape)
        hazard = log_mass(shape) + mass(shape) * ratio_to_scale
        logs = F.col("_log_failed") - failures * F.ln("scale")
        return failures / shape + logs - growth * hazard < 0

    bound = F.col("_free") != F.col("scale")
    return fitted.select(
        *by,
        "drives",
        "failures",
        F.when(has_failures & bound, _bisect(fixed_scale_negative, shape_bounds))
        .otherwise(F.col("_shape"))
        .alias("shape"),
        "scale",
    )


def reliability(t: Column, shape: Column, scale: Column) -> Column:
    return F.exp(-F.pow(t / scale, shape))


def hazard_rate(t: Column, shape: Column, scale: Column) -> Column:
    return (shape / scale) * F.pow(t / scale, shape - 1)


def mean_life(shape: Column, scale: Column) -> Column:
    return scale * gamma(F.lit(1.0) + F.lit(1.0) / shape)


def b_life(percentile: float, shape: Column, scale: Column) -> Column:
    """Age by which ``percentile`` percent have failed."""
    share = F.lit(1.0) - F.lit(float(percentile)) / 100
    return scale * F.pow(-F.ln(share), F.lit(1.0) / shape)


def weibull_summary(fits: DataFrame) -> DataFrame:
    """Mean life, B10, B50 and the failure regime of every fit."""
    shape, scale = F.col("shape"), F.col("scale")
    return fits.select(
        "*",
        (F.col("drives") - F.col("failures")).alias("censored"),
        mean_life(shape, scale).alias("mttf"),
        b_life(10, shape, scale).alias("b10"),
        b_life(50, shape, scale).alias("b50"),
        failure_regime(shape).alias("regime"),
    )


def at_horizons(fits: DataFrame, horizons: list[int] = (30, 90, 180, 365)) -> DataFrame:
    """Reliability and hazard of every fit at each horizon in days."""
    days = F.explode(F.array(*[F.lit(h) for h in horizons]))
    shape, scale, t = F.col("shape"), F.col("scale"), F.col("horizon").cast("double")
    return fits.withColumn("horizon", days).select(
        *[c for c in fits.columns],
        "horizon",
        reliability(t, shape, scale).alias("reliability"),
        hazard_rate(t, shape, scale).alias("hazard"),
    )


def kaplan_meier(histogram: DataFrame, by: list[str] = ()) -> DataFrame:
    """Product-limit survival after every failure time, with drives at risk."""
    groups = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    still_there = groups.orderBy("t").rowsBetween(0, W.unboundedFollowing)
    so_far = groups.orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    step = F.lit(1.0) - F.col("d") / F.col("at_risk")
    return (
        histogram.withColumn("at_risk", F.sum("n").over(still_there))
        .where(F.col("d") > 0)
        .select(
            *by, "t", "at_risk", F.col("d").alias("failures"), F.product(step).over(so_far).alias("survival")
        )
    )


def median_survival(curve: DataFrame, by: list[str] = ()) -> DataFrame:
    """First time with survival at or below one half; NULL while it is not reached."""
    reached = F.min(F.when(F.col("survival") <= 0.5, F.col("t")))
    return curve.groupBy(*by).agg(reached.alias("median_days"))


def survival_at(
    curve: DataFrame, horizons: list[int] = (30, 60, 90, 180, 270), lookup: str = "step", by: list[str] = ()
) -> DataFrame:
    """Survival at each horizon.

    ``step`` reads the curve as the step function it is (1 before the first failure);
    ``next`` takes the first failure time at or after the horizon, and has no value
    beyond the last one.
    """
    columns = []
    for h in horizons:
        if lookup == "step":
            value = F.coalesce(F.max_by("survival", F.when(F.col("t") <= h, F.col("t"))), F.lit(1.0))
        elif lookup == "next":
            value = F.min_by("survival", F.when(F.col("t") >= h, F.col("t")))
        else:
            raise ValueError(f"lookup must be 'step' or 'next', not {lookup!r}")
        columns.append(value.alias(str(h)))
    wide = curve.groupBy(*by).agg(*columns)
    long = wide.unpivot(list(by), [str(h) for h in horizons], "horizon", "survival")
    return long.withColumn("horizon", F.col("horizon").cast("int"))


def failure_counts(lives: DataFrame) -> DataFrame:
    """Drives, failed and censored."""
    return lives.agg(
        F.count("*").alias("drives"),
        F.sum("failed").alias("failed_drives"),
        F.sum(1 - F.col("failed")).alias("censored_drives"),
    )


def compare_failure_rates(lives: DataFrame, first: str, second: str) -> DataFrame:
    """Chi-square test (with Yates' correction) that two models fail at the same rate."""

    def count(model: str, failed: int) -> Column:
        return F.count_if((F.col("model") == model) & (F.col("failed") == failed)).cast("double")

    table = lives.where(F.col("model").isin(first, second)).agg(
        count(first, 1).alias("a"),
        count(first, 0).alias("b"),
        count(second, 1).alias("c"),
        count(second, 0).alias("d"),
    )
    return _tested(table.withColumns({"model_1": F.lit(first), "model_2": F.lit(second)}))


def _tested(tables: DataFrame) -> DataFrame:
    """The test of each row's 2x2 table: a and b failed and surviving of ``model_1``, c and d of ``model_2``."""
    a, b, c, d = (F.col(x) for x in "abcd")
    total = a + b + c + d
    gap = F.greatest(F.abs(a * d - b * c) - total / 2, F.lit(0.0))
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    chi2 = F.try_divide(total * gap * gap, margins)
    return (
        tables.select(
            "model_1",
            a.cast("long").alias("failed_1"),
            b.cast("long").alias("surviving_1"),
            "model_2",
            c.cast("long").alias("failed_2"),
            d.cast("long").alias("surviving_2"),
            chi2.alias("chi2_statistic"),
        )
        .withColumn("p_value", chi_square_tail(F.col("chi2_statistic")))
        .withColumn("significant", F.col("p_value") < 0.05)
    )


def compare_all_models(lives: DataFrame, min_drives: int = 100, most: int = 1000) -> DataFrame:
    """``compare_failure_rates`` of every two models with at least ``min_drives`` drives, the lesser name first.

    The counts per model become one sorted list, and each model is paired with those behind
    it. More than ``most`` models raise a ValueError: their pairs would be too many to read.
    Drives without a model are left out.
    """
    failed = F.count_if(F.col("failed") == 1).cast("double")
    counts = (
        lives.where(F.col("model").isNotNull())
        .groupBy("model")
        .agg(failed.alias("x"), F.count_if(F.col("failed") == 0).cast("double").alias("y"), F.count("*").alias("n"))
        .where(F.col("n") >= min_drives)
    )
    found = counts.limit(most + 1).count()
    if found > most:
        raise ValueError(f"over {most} models have {min_drives} drives: raise min_drives")
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("model", "x", "y"))).alias("all"))
    first = listed.select("all", F.posexplode("all").alias("place", "one"))
    pairs = first.select("one", F.explode(F.slice("all", F.col("place") + 2, F.size("all"))).alias("two"))
    return _tested(
        pairs.select(
            F.col("one.model").alias("model_1"), F.col("one.x").alias("a"), F.col("one.y").alias("b"),
            F.col("two.model").alias("model_2"), F.col("two.x").alias("c"), F.col("two.y").alias("d"),
        )
    )


def alert_value(
    caught: Column, false_alarms: Column, failure_cost: float = 7000, inspection_cost: float = 500,
    replacement_cost: float = 200,
) -> Column:
    """Net saving of acting on alerts."""
    return caught * failure_cost - false_alarms * inspection_cost - caught * replacement_cost
