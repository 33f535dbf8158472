import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.functions import bands, numeric, ordered


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_gamma(spark):
    xs = [0.6, 1.0, 1.1, 1.5, 2.0, 5.5, 11.0]
    got = [r[0] for r in column(spark, xs).select(numeric.gamma(F.col("x"))).collect()]
    assert got == pytest.approx([math.gamma(x) for x in xs], rel=1e-13)


def test_erfc(spark):
    xs = [0.0, 0.1, 1.0, 2.4999, 2.5, 3.0, 5.0, 9.0]
    got = [r[0] for r in column(spark, xs).select(numeric.erfc(F.col("x"))).collect()]
    assert got == pytest.approx([math.erfc(x) for x in xs], rel=1e-10)


def test_half_up(spark):
    xs = [1.005, 2.675, -1.005, 0.125]
    got = [r[0] for r in column(spark, xs).select(numeric.round_half_up(F.col("x"), 2)).collect()]
    assert got == [1.01, 2.68, -1.01, 0.13]


def test_rate_of_nothing_is_null(spark):
    assert column(spark, [0.0]).select(numeric.rate(F.lit(3), F.col("x"))).first()[0] is None


def test_not_finite(spark):
    xs = [None, float("nan"), float("inf"), float("-inf"), -2.5]
    got = [r[0] for r in column(spark, xs).select(numeric.zero_if_not_finite(F.col("x"))).collect()]
    assert got == [0, 0, 0, 0, -2.5]


def test_tier_edges(spark):
    xs = [0.0999, 0.1, 0.3, 0.5, 0.7, 1.0]
    got = [r[0] for r in column(spark, xs).select(bands.risk_level(F.col("x"))).collect()]
    assert got == ["HEALTHY", "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL"]


def test_unknown_capacity_is_in_the_top_band(spark):
    sizes = [None, 0, 2 * 10**12 - 1, 2 * 10**12, 12 * 10**12]
    got = column(spark, sizes, "long").select(bands.capacity_band(F.col("x"), bands.CAPACITY_EDGES["wide"])).collect()
    assert [r[0] for r in got] == ["12TB+", "< 2TB", "< 2TB", "2-4TB", "12TB+"]


def test_regimes(spark):
    got = [r[0] for r in column(spark, [0.5, 1.0, 2.0, None]).select(bands.failure_regime(F.col("x"))).collect()]
    assert got == ["INFANT MORTALITY", "RANDOM FAILURES", "WEAR-OUT FAILURES", None]


def test_running_totals_in_slices(spark):
    rng = np.random.default_rng(5)
    values = np.unique(rng.normal(size=5000).round(4))
    counts = rng.integers(0, 9, size=len(values))
    df = spark.createDataFrame(list(zip(values.tolist(), counts.tolist())), "v double, n long")
    rows = ordered.running_totals(df, "v", ["n"], slices=16).orderBy("v").collect()
    assert [r.n_upto for r in rows] == np.cumsum(counts).tolist()


@pytest.mark.parametrize("size", [1, 2, 7, 4001])
def test_percentiles_in_slices(spark, size):
    values = np.random.default_rng(size).gamma(2.0, size=size).round(2)
    # One value holds a third of all rows.
    values[: size // 3] = 1.25
    df = column(spark, values.tolist())
    row = ordered.exact_percentiles(df, "x", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}).first()
    assert list(row) == pytest.approx(np.quantile(values, [0, 0.25, 0.5, 0.9, 1.0]).tolist(), abs=1e-12)


def test_row_numbers_of_a_hot_key(spark):
    rng = np.random.default_rng(11)
    rows = [(1 if i % 3 else int(i % 50), int(rng.integers(0, 500)), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, at long, id long")
    got = ordered.row_numbers(df, "k", ["at", "id"], F.floor(F.col("at") / 10), "n").collect()
    by_key = {}
    for k, at, i in rows:
        by_key.setdefault(k, []).append((at, i))
    want = {(k, i): n for k, v in by_key.items() for n, (_, i) in enumerate(sorted(v), start=1)}
    assert {(r.k, r.id): r.n for r in got} == want


@pytest.mark.parametrize("n", [0, 1, 2, 3, 255, 256])
def test_places_below(spark, n):
    edges = [k * 0.5 for k in range(n)]
    df = spark.createDataFrame([(edges, v / 4) for v in range(-2, 2 * n + 3)], "edges array<double>, v double")
    slow = F.size(F.filter("edges", lambda e: e < F.col("v")))
    assert df.where(ordered.places_below(F.col("edges"), F.col("v"), 256) != slow).isEmpty()
