"""Conditional expressions that put a value into a named band."""

from pyspark.sql import Column, functions as F

TB = 1_000_000_000_000

# Upper-exclusive capacity edges in decimal terabytes.
CAPACITY_EDGES = {
    "wide": [2, 4, 8, 12],
    "fine": [2, 4, 8, 12, 16],
    "coarse": [4, 8, 12, 16],
}

# Lowest probability of each tier, its name and what to do.
RISK_TIERS = [
    (0.7, "CRITICAL", "Immediate replacement recommended"),
    (0.5, "HIGH", "Schedule replacement within 7 days"),
    (0.3, "MEDIUM", "Monitor closely, plan replacement within 30 days"),
    (0.1, "LOW", "Continue monitoring, routine maintenance"),
]
LOWEST_TIER = ("HEALTHY", "No action required")

# Display colour of a tier, and the gauge steps in percent.
TIER_COLOURS = {"CRITICAL": "red", "HIGH": "orange", "MEDIUM": "yellow"}
OTHER_TIERS_COLOUR = "green"
GAUGE_STEPS = [10, 30, 50, 70, 100]


def capacity_band(capacity: Column, edges: list[int]) -> Column:
    """Label a byte count by edges in TB. NULL falls into the open top band."""
    band = F.when(capacity < edges[0] * TB, f"< {edges[0]}TB")
    for low, high in zip(edges, edges[1:]):
        band = band.when(capacity < high * TB, f"{low}-{high}TB")
    return band.otherwise(f"{edges[-1]}TB+")


def status(failure: Column) -> Column:
    """Failed or Healthy; an unknown flag counts as Healthy."""
    return F.when(failure == 1, "Failed").otherwise("Healthy")


def risk_level(probability: Column) -> Column:
    return _tier(probability, 1, LOWEST_TIER[0])


def recommendation(probability: Column) -> Column:
    return _tier(probability, 2, LOWEST_TIER[1])


def _tier(probability: Column, field: int, default: str) -> Column:
    out = F
    for tier in RISK_TIERS:
        out = out.when(probability >= tier[0], F.lit(tier[field]))
    return out.otherwise(F.lit(default))


def tier_colour(level: Column) -> Column:
    out = F
    for tier, colour in TIER_COLOURS.items():
        out = out.when(level == tier, colour)
    return out.otherwise(OTHER_TIERS_COLOUR)


def gauge_step(probability: Column) -> Column:
    """Upper end, in percent, of the gauge step a probability lies in."""
    out = F
    for step in GAUGE_STEPS[:-1]:
        out = out.when(probability * 100 < step, step)
    return out.otherwise(GAUGE_STEPS[-1])


def failure_regime(shape: Column) -> Column:
    """Reading of a Weibull shape: falling, constant or rising hazard."""
    return (
        F.when(shape < 1, "INFANT MORTALITY")
        .when(shape == 1, "RANDOM FAILURES")
        .when(shape > 1, "WEAR-OUT FAILURES")
    )


def weekday_number(date: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(date) - 1
