"""The epsilon grid order join against all pairs, with many tiles."""

import math

import numpy as np
import pytest

from fleetpulse.llm import embedding_dedup
from fleetpulse.session import settle


def clustered(seed=4, clusters=60, each=40, dims=24, spread=0.02):
    """Tight groups around random directions, some copies, and loose vectors between."""
    r = np.random.default_rng(seed)
    centers = r.normal(size=(clusters, dims))
    rows = (centers / np.linalg.norm(centers, axis=1)[:, None])[:, None, :] + spread * r.normal(size=(clusters, each, dims))
    rows = np.concatenate([rows.reshape(-1, dims), r.normal(size=(150, dims))])
    return np.concatenate([rows, rows[:30]])


def all_pairs(x, least=0.95):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = unit @ unit.T >= least
    np.fill_diagonal(hit, False)
    component = np.arange(len(x))
    while True:
        low = np.minimum(component, np.where(hit, component[None, :], len(x)).min(axis=1))
        if (low == component).all():
            return hit.sum(axis=1), component
        component = low


def frame(spark, x):
    return spark.createDataFrame([(k, row) for k, row in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(5)


@pytest.mark.parametrize("tile_rows, spread", [(32, 0.02), (50, 0.055), (4096, 0.055)])
def test_links_equal_all_pairs(spark, tile_rows, spread):
    x = clustered(spread=spread)
    n_links, component = all_pairs(x)
    assert (n_links > 0).sum() > 1000
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(frame(spark, x), tile_rows=tile_rows).collect()}
    assert got == {k: (int(n_links[k]), int(component[k]), int(component[k]) == k) for k in range(len(x))}


def test_most_tile_pairs_of_clustered_vectors_are_skipped(spark):
    x = clustered(clusters=60, each=80)
    eps = math.sqrt(0.1) + embedding_dedup.SLACK
    units = frame(spark, x).selectExpr("vec_id as id", "embedding").mapInArrow(embedding_dedup._units, "id long, dim int, unit binary")
    classes = settle(units.selectExpr("*", "1L as weight"), "classes")
    _, boxes = embedding_dedup.sorted_tiles(classes, eps, 64)
    n = boxes.count()
    near = embedding_dedup._near_tiles(boxes, eps, 8).count()
    assert n > 40 and near <= 0.2 * n * (n + 1) / 2


def test_given_vectors_equal_all_pairs(spark, small):
    """No two of the given vectors are linked by themselves; with copies turned a little there are."""
    given = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").limit(300).collect()
    x = np.array([r.embedding for r in given], np.float64)
    r = np.random.default_rng(1)
    turned = x[:80] + 0.25 * np.linalg.norm(x[:80], axis=1)[:, None] * r.normal(size=(80, x.shape[1])) / math.sqrt(x.shape[1])
    x = np.concatenate([x, turned])
    n_links, component = all_pairs(x)
    assert (n_links > 0).sum() > 100
    got = {q.vec_id: (q.n_links, q.component_id) for q in embedding_dedup.near_vectors(frame(spark, x), tile_rows=16).collect()}
    assert got == {k: (int(n_links[k]), int(component[k])) for k in range(len(x))}
