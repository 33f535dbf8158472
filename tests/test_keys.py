from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fleetpulse.operators import keys

ROWS = "day int, drive string, a int, b int"


def frame(spark):
    """Repeated keys, whole copies, and one key with a third of the rows."""
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 20)), f"d{rng.integers(0, 30)}", int(rng.integers(0, 4)), int(rng.integers(0, 3))) for _ in range(800)]
    rows += [(1, "hot", int(i % 7), int(i % 2)) for i in range(400)]
    return spark.createDataFrame(rows, ROWS), rows


def expected(rows):
    first = {}
    for r in sorted(rows):
        first.setdefault(r[:2], r)
    left = Counter(rows)
    left.subtract(first.values())
    return set(first.values()), +left


def test_first_rows_and_surplus(spark):
    df, rows = frame(spark)
    kept, left = expected(rows)
    for repeated in (None, keys.few_repeated_keys(df, ["day", "drive"])):
        got = keys.one_row_per_key(df, ["day", "drive"], ["a", "b"], repeated).collect()
        assert len(got) == len(kept) and {tuple(r) for r in got} == kept
        surplus = keys.surplus_rows(df, ["day", "drive"], ["a", "b"], repeated).collect()
        assert {tuple(r)[:4]: r.copies for r in surplus} == dict(left)


def test_sample_is_repeatable_and_seeded(spark):
    df = spark.range(500).select(F.concat(F.lit("S"), F.col("id")).alias("serial_number"))
    one = [r[0] for r in keys.sample_keys(df, 50).collect()]
    again = [r[0] for r in keys.sample_keys(df.repartition(7), 50).collect()]
    other = [r[0] for r in keys.sample_keys(df, 50, seed=7).collect()]
    assert one == again and len(set(one)) == 50 and set(one) != set(other)
