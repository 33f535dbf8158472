"""Rounding, rates and the special functions Spark has no built-in for."""

import math

from pyspark.sql import Column, functions as F

# The nine-term Lanczos approximation with g = 7.
LANCZOS_G = 7.0
LANCZOS = [
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
    1.5056327351493116e-7,
]


def round_half_up(value: Column, places: int) -> Column:
    """Round half away from zero on the decimal value, as SQL ``numeric`` does; DOUBLE out."""
    return F.round(value.cast("decimal(28,10)"), places).cast("double")


def rate(part: Column, whole: Column, per: float = 100.0, places: int = 4) -> Column:
    """``per * part / whole`` rounded; NULL where ``whole`` is zero."""
    return round_half_up(F.try_divide(F.lit(per) * part, whole.cast("double")), places)


def gamma(z: Column) -> Column:
    """Gamma function for z > 0.5 (Lanczos)."""
    x = z - F.lit(1.0)
    total = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        total = total + F.lit(c) / (x + F.lit(float(i)))
    t = x + F.lit(LANCZOS_G + 0.5)
    return F.lit(math.sqrt(2 * math.pi)) * F.pow(t, x + F.lit(0.5)) * F.exp(-t) * total


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0.

    Power series below 2.5, continued fraction from there on, so that tiny tails
    keep their relative precision.
    """
    terms = F.sequence(F.lit(1), F.lit(60))
    series = F.aggregate(
        terms,
        F.struct(x.alias("term"), x.alias("total")),
        lambda acc, n: F.struct(
            (acc["term"] * 2 * x * x / (2 * n + 1)).alias("term"),
            (acc["total"] + acc["term"] * 2 * x * x / (2 * n + 1)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    small = F.lit(1.0) - F.lit(2 / math.sqrt(math.pi)) * F.exp(-x * x) * series
    fraction = F.aggregate(
        F.reverse(terms), F.lit(0.0), lambda acc, n: (n / F.lit(2.0)) / (x + acc)
    )
    large = F.exp(-x * x) / (F.lit(math.sqrt(math.pi)) * (x + fraction))
    return F.when(x < 2.5, small).otherwise(large)


def chi_square_tail(statistic: Column) -> Column:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    return erfc(F.sqrt(statistic / 2))


def zero_if_not_finite(value: Column) -> Column:
    """NULL and infinite readings become 0."""
    v = value.cast("double")
    return F.when(F.abs(v) == F.lit(float("inf")), F.lit(0.0)).otherwise(
        F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0))
    )
