"""Report packs: several frames from one set of snapshots."""

from pyspark.sql import DataFrame

from fleetpulse.operators import fleet, survival


def fleet_report(df: DataFrame, top_models: int = 10, min_drives: int = 100) -> dict[str, DataFrame]:
    """The four parts of the standing fleet report."""
    return {
        "overview": fleet.overview(df, places=6),
        "models": fleet.failure_by_model(df, min_drives, top_models),
        "indicators": fleet.indicator_means(df),
        "capacity": fleet.failures_by_capacity(df, "fine", skip_unknown=True, order="capacity"),
    }


def reliability_study(
    df: DataFrame, top_models: int = 5, min_drives: int = 100, by_lookup: str = "step"
) -> dict[str, DataFrame]:
    """Weibull fits of the fleet and its largest models, and the survival curve."""
    lives = survival.lifetimes(df)
    largest = fleet.largest_models(lives, top_models, min_drives).select("model")
    per_model = survival.lifetime_histogram(lives.join(largest, "model", "left_semi"), ["model"])
    everything = survival.lifetime_histogram(lives)
    fit = survival.weibull_fit(everything)
    curve = survival.kaplan_meier(everything)
    return {
        "weibull": survival.weibull_summary(fit),
        "reliability": survival.at_horizons(fit),
        "models": survival.weibull_summary(survival.weibull_fit(per_model, ["model"])),
        "curve": curve,
        "survival": survival.survival_at(curve, lookup=by_lookup),
        "median": survival.median_survival(curve),
    }
