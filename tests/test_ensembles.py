"""Exact splits and gains, ensembles as tables, quality by round."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import ensembles, learning
from frames import day


def matrix(spark, n, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        a, b = float(r.integers(0, 40)), float(r.normal())
        rows.append((f"S{k % (n // 6)}", day(k // (n // 6)), a, b, 3.0, int(r.random() < (0.7 if a > 30 else 0.1))))
    return spark.createDataFrame(rows, "serial_number string, date date, a double, b double, same double, label int")


def expected_split(units, test=0.2, validation=0.1):
    out = {}
    for c in {u[1] for u in units}:
        own = sorted((hashlib.md5(f"42:{key}".encode()).hexdigest(), key) for key, label in units if label == c)
        n_test = math.floor(len(own) * test + 0.5)
        n_validation = math.floor((len(own) - n_test) * validation + 0.5)
        out |= {key: "test" if i < n_test else "validation" if i < n_test + n_validation else "train" for i, (_, key) in enumerate(own)}
    return out


def test_stratified_rows(spark):
    df = matrix(spark, 600)
    got = {f"{r.serial_number}:{r.date}": r.split for r in learning.with_stratified_split(df, by="row").collect()}
    assert got == expected_split([(f"{r.serial_number}:{r.date}", r.label) for r in df.collect()])


def test_stratified_drives(spark):
    df = matrix(spark, 600)
    labels = {}
    for r in df.collect():
        labels[r.serial_number] = max(labels.get(r.serial_number, 0), r.label)
    rows = learning.with_stratified_split(df).collect()
    assert len(rows) == 600
    assert {r.serial_number: r.split for r in rows} == expected_split(list(labels.items()))


def test_digests_with_equal_beginnings(spark):
    texts = [f"{'0' * 12}{k:04x}" for k in range(300)] + ["f" * 16] * 2
    df = spark.createDataFrame([(t, 1) for t in texts], "digest string, class int")
    found = learning.smallest_digests(df, "class", "digest", {1: [1, 37, 300, 302], 2: [5]})
    assert found == {(1, k): sorted(texts)[k - 1] for k in (1, 37, 300, 302)}


def test_split_of_few_and_of_none(spark):
    one = matrix(spark, 6).limit(1)
    assert learning.with_stratified_split(one, by="row").first().split == "train"
    assert learning.with_stratified_split(one.limit(0), by="row").count() == 0


def test_gains_equal_brute_force(spark):
    df = matrix(spark, 500)
    rows = df.collect()

    def gini(labels):
        n = len(labels)
        return 1 - sum((c / n) ** 2 for c in Counter(labels).values())

    want = {}
    for name in ("a", "b"):
        best = (-1.0, 0.0)
        for cut in sorted({r[name] for r in rows})[:-1]:
            left, right = [r.label for r in rows if r[name] <= cut], [r.label for r in rows if r[name] > cut]
            gain = gini([r.label for r in rows]) - len(left) / 500 * gini(left) - len(right) / 500 * gini(right)
            best = max(best, (round(gain, 12), -cut))
        want[name] = best
    got = learning.split_gains(df, ["a", "b", "same"]).collect()
    assert [r.place for r in got] == [1, 2]
    assert {r.feature: (pytest.approx(r.gain, abs=1e-11), -r.threshold) for r in got} == want


@pytest.fixture(scope="module")
def fitted(spark):
    df = matrix(spark, 900).cache()
    return df, {kind: learning.train(df, kind, ["a", "b", "same"], rounds=12) for kind in ("forest", "boosted")}


@pytest.mark.parametrize("kind, score", [("forest", ensembles.forest_score), ("boosted", ensembles.boosted_score)])
def test_table_scores_equal_the_model(spark, fitted, kind, score):
    df, models = fitted
    nodes = ensembles.ensemble_nodes(models[kind])
    assert nodes.select("tree").distinct().count() == 12
    scored = ensembles.score_from_table(nodes, ensembles.scaled_inputs(models[kind], df), score)
    got = {(r.serial_number, r.date): r.probability for r in scored.collect()}
    want = {(r.serial_number, r.date): r.probability for r in learning.predict(models[kind], df).collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_auc_by_round_equals_all_pairs(spark, fitted):
    df, models = fitted
    nodes = ensembles.ensemble_nodes(models["boosted"])
    sample = df.where("date < '2025-01-04'")
    inputs = ensembles.scaled_inputs(models["boosted"], sample)
    got = [r.roc_auc for r in ensembles.auc_by_round(nodes, inputs).collect()]
    rows = inputs.select("label", ensembles.tree_values(nodes, F.col("inputs")).alias("v")).collect()
    for k in (1, 5, 12):
        sums = [(r.label, np.cumsum(r.v)[k - 1]) for r in rows]
        pos, neg = [s for y, s in sums if y], [s for y, s in sums if not y]
        assert got[k - 1] == pytest.approx(np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]), abs=1e-12)
    last = learning.roc_auc(learning.predict(models["boosted"], sample)).first()[0]
    assert got[-1] == pytest.approx(last, abs=1e-9) and len(got) == 12
