"""Order-dependent computations that never put one long series into one task."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetpulse.session import settle


def row_numbers(
    df: DataFrame, key: str, order: list[str], slice_of: Column, name: str
) -> DataFrame:
    """Row number per ``key`` in ``order``, computed slice by slice.

    ``slice_of`` must not decrease along ``order``. A long series is numbered in
    as many tasks as it has slices: the rows are ranked inside (key, slice), and
    the slice sizes, counted map-side, give the offset of each slice.
    """
    sliced = df.withColumn("_slice", slice_of)
    ahead = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(key, "_slice")
        .agg(F.count("*").alias("_size"))
        .select(key, "_slice", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_offset"))
    )
    inside = W.partitionBy(key, "_slice").orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, [key, "_slice"])
        .withColumn(name, F.col("_rank") + F.col("_offset"))
        .drop("_slice", "_rank", "_offset")
    )


def running_totals(
    histogram: DataFrame, value: str, totals: list[str], slices: int = 256
) -> DataFrame:
    """Add ``<total>_upto`` columns: inclusive running sums along ``value``.

    ``histogram`` has one row per value; values that are NULL or NaN have no place in the
    order and are left out. Its quantiles (at most ``slices`` numbers) cut it into even
    slices, each summed in its own task; only the slice totals, again at most ``slices``
    rows, are ordered in one place.
    """
    histogram = settle(histogram.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))), "histogram")
    probabilities = [i / slices for i in range(1, slices)]
    edges = sorted(set(histogram.approxQuantile(value, probabilities, 0.5 / slices)))
    if not edges:
        sliced = histogram.withColumn("_slice", F.lit(0.0))
    else:
        splits = [float("-inf"), *edges, float("inf")]
        sliced = Bucketizer(splits=splits, inputCol=value, outputCol="_slice").transform(histogram)
    ahead = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(t).alias(t) for t in totals])
        .select("_slice", *[F.coalesce(F.sum(t).over(ahead), F.lit(0)).alias(f"_{t}") for t in totals])
    )
    upto = W.partitionBy("_slice").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .select(
            *histogram.columns,
            *[(F.sum(t).over(upto) + F.col(f"_{t}")).alias(f"{t}_upto") for t in totals],
        )
    )


def places_below(edges: Column, value: Column, most: int) -> Column:
    """How many of at most ``most`` ascending ``edges`` are below ``value``, by halving."""
    steps = [1 << k for k in reversed(range(most.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.get(edges, at + step - 1) < value, at + step).otherwise(at),
    )


def grouped_running_totals(
    histogram: DataFrame, by: str, value: str, totals: list[str], slices: int = 256
) -> DataFrame:
    """``running_totals`` of every ``by`` apart, all in the same jobs.

    ``histogram`` has one row per (by, value). Each group is cut into even slices by its own
    quantiles; only slice totals, at most ``slices`` for a group, are ordered in one place.
    """
    histogram = settle(histogram.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))), "histograms")
    shares = [i / slices for i in range(1, slices)]
    held = histogram.groupBy(F.col(by).alias("_by")).agg(F.array_distinct(F.percentile_approx(value, shares, 10 * slices)).alias("_edges"))
    place = places_below(F.col("_edges"), F.col(value), slices)
    sliced = histogram.join(held, F.col(by) == F.col("_by")).withColumn("_slice", place).drop("_by", "_edges")
    ahead = W.partitionBy(by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(by, "_slice")
        .agg(*[F.sum(t).alias(t) for t in totals])
        .select(by, "_slice", *[F.coalesce(F.sum(t).over(ahead), F.lit(0)).alias(f"_{t}") for t in totals])
    )
    upto = W.partitionBy(by, "_slice").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    return sliced.join(offsets, [by, "_slice"]).select(
        *histogram.columns, *[(F.sum(t).over(upto) + F.col(f"_{t}")).alias(f"{t}_upto") for t in totals]
    )


def exact_percentiles(df: DataFrame, value: str, probabilities: dict[str, float]) -> DataFrame:
    """One row of linearly interpolated percentiles, exact at any number of distinct values."""
    histogram = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("_value"))
        .agg(F.count("*").alias("_n"))
    )
    ranked = running_totals(histogram, "_value", ["_n"])
    first, last = F.col("_n_upto") - F.col("_n"), F.col("_n_upto") - 1
    total = ranked.agg(F.sum("_n").alias("total")).scalar()

    def value_at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position <= last), F.col("_value")))

    ranked = ranked.withColumn("_total", total)
    out = []
    for name, p in probabilities.items():
        position = F.lit(p) * (F.col("_total") - 1)
        low = value_at(F.floor(position))
        high = value_at(F.ceil(position))
        share = F.max(position - F.floor(position))
        out.append((low + (high - low) * share).alias(name))
    return ranked.agg(*out)
