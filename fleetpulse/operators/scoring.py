"""Imputation of scoring requests, batch scoring with risk tiers, summaries."""

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from fleetpulse.functions.bands import gauge_step, recommendation, risk_level, tier_colour
from fleetpulse.schema import FEATURE_COLUMNS, MODEL_ATTRIBUTES, SCORING_REQUEST

Scorer = Callable[[DataFrame], DataFrame]


def as_requests(df: DataFrame) -> DataFrame:
    """Bring a frame to the request schema; absent fields become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCORING_REQUEST
        ]
    )


def impute(requests: DataFrame) -> DataFrame:
    """The 32 model inputs of every request, without NULLs.

    Missing window means and maxima fall back to the raw reading, deviations and
    deltas to 0. Power-on hours and SMART 9 stand in for each other, and there a 0
    counts as missing.
    """
    zero = F.lit(0.0)

    def or_zero(*names: str) -> Column:
        return F.coalesce(*[F.col(n).cast("double") for n in names], zero)

    def first_non_zero(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.col(n).cast("double"), zero) for n in names], zero)

    inputs = {}
    for name in FEATURE_COLUMNS:
        raw = name.rsplit("_", 2)[0]
        if name == "smart_9_raw":
            inputs[name] = first_non_zero("smart_9_raw", "power_on_hours")
        elif name == "power_on_hours":
            inputs[name] = first_non_zero("power_on_hours", "smart_9_raw")
        elif name.startswith("temp_"):
            inputs[name] = or_zero(name, "smart_194_raw")
        elif raw in MODEL_ATTRIBUTES and name.split("_")[-2] in ("mean", "max"):
            inputs[name] = or_zero(name, raw)
        else:
            inputs[name] = or_zero(name)
    return requests.select("serial_number", *[c.alias(name) for name, c in inputs.items()])


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns`` next to the serial number: extra ones dropped, absent ones 0."""
    return df.select(
        "serial_number",
        *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in columns],
    )


def logistic_scorer(weights: dict[str, float], intercept: float) -> Scorer:
    """A scorer with given coefficients on unscaled inputs."""

    def score(df: DataFrame) -> DataFrame:
        z = F.lit(intercept)
        for name, weight in weights.items():
            z = z + F.lit(weight) * F.col(name)
        return df.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))

    return score


def model_scorer(model: PipelineModel) -> Scorer:
    """A scorer backed by a fitted pipeline."""

    def score(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("probability", vector_to_array("probability")[1])

    return score


def decide(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Tier, decision, confidence and advice from ``probability``; tiers use it unrounded."""
    p = F.col("probability")
    return df.select(
        "serial_number",
        F.round(p, 4).alias("failure_probability"),
        risk_level(p).alias("risk_level"),
        (p >= 0.5).alias("will_fail_30d"),
        F.round(F.abs(p - 0.5) * 2, 4).alias("confidence"),
        recommendation(p).alias("recommendation"),
        (F.current_timestamp() if at is None else at).alias("timestamp"),
    )


def score_batch(requests: DataFrame, scorer: Scorer, at: Column | None = None) -> DataFrame:
    """Score any number of drives in one pass, without a shuffle."""
    inputs = align(impute(as_requests(requests)), FEATURE_COLUMNS)
    return decide(scorer(inputs), at)


def batch_summary(scored: DataFrame) -> DataFrame:
    """Totals of a scored batch from the rounded probabilities; one row for an empty batch too."""
    p = F.col("failure_probability")
    return scored.agg(
        F.count("*").alias("total_drives"),
        F.round(F.avg(p), 4).alias("avg_failure_probability"),
        F.round(F.max(p), 4).alias("max_failure_probability"),
        F.count_if(p >= 0.3).alias("drives_at_risk"),
    )


def risk_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_level").agg(F.count("*").alias("drives"))


def display(scored: DataFrame) -> DataFrame:
    """Colour of the tier and gauge step of every scored drive."""
    return scored.select(
        "serial_number",
        "failure_probability",
        "risk_level",
        tier_colour(F.col("risk_level")).alias("colour"),
        gauge_step(F.col("failure_probability")).alias("gauge_step"),
    )


def prediction_rows(
    scored_30d: DataFrame, scored_60d: DataFrame | None, date: Column, version: str
) -> DataFrame:
    """Rows of the stored prediction table, from one scored batch per horizon."""
    out = scored_30d.select(
        "serial_number", F.col("failure_probability").alias("failure_prob_30d"), "risk_level"
    )
    if scored_60d is None:
        out = out.withColumn("failure_prob_60d", F.lit(None).cast("double"))
    else:
        longer = scored_60d.select("serial_number", F.col("failure_probability").alias("failure_prob_60d"))
        out = out.join(longer, "serial_number", "left")
    return out.select(
        "serial_number",
        date.alias("prediction_date"),
        F.lit(version).alias("model_version"),
        "failure_prob_30d",
        "failure_prob_60d",
        F.col("risk_level").alias("risk_category"),
        F.current_timestamp().alias("created_at"),
    )
