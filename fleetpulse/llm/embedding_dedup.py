"""Embedding near-dedup: an epsilon grid order join over leading principal dimensions."""

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fleetpulse.llm.components import connected_components
from fleetpulse.session import settle

LEADING, TILE_ROWS, LEAF_ROWS, FANOUT = 8, 4096, 256, 8
# A tile that is half full ends where a cell of so many first dimensions ends.
CUT_AT = 4
# Distances are compared in projection with this much slack for rounding.
SLACK = 1e-6


def _unit(rows: list) -> tuple[list[int], np.ndarray]:
    """Places and unit vectors, in double precision, of the rows that have a direction."""
    places, vectors = [], []
    for k, row in enumerate(rows):
        if row is None or not len(row) or any(x is None for x in row):
            continue
        v = np.asarray(row, np.float64)
        top = np.abs(v).max()
        if np.isfinite(v).all() and top > 0:
            v = v / top
            places.append(k)
            vectors.append(v / np.linalg.norm(v))
    return places, vectors


def _units(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dim, unit): a unit vector as packed doubles; other rows are left out."""
    for batch in stream:
        ids, dims, out = [], [], []
        places, vectors = _unit(batch["embedding"].to_pylist())
        for k, v in zip(places, vectors, strict=True):
            if batch["id"][k].is_valid:
                ids.append(batch["id"][k].as_py())
                dims.append(len(v))
                out.append(v.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["id", "dim", "unit"])


def _moments(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and length of vector: the sums of all products of two components."""
    sums: dict[int, np.ndarray] = {}
    for batch in stream:
        by_dim: dict[int, list[bytes]] = {}
        for dim, unit in zip(batch["dim"].to_pylist(), batch["unit"].to_pylist(), strict=True):
            by_dim.setdefault(dim, []).append(unit)
        for dim, units in by_dim.items():
            x = np.frombuffer(b"".join(units)).reshape(-1, dim)
            held = np.hstack([x, np.ones((len(x), 1))])
            sums[dim] = sums.get(dim, 0) + held.T @ held
    for dim, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * total.size, pa.int32()), pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["dim", "cell", "value"]
        )


def principal_directions(units: DataFrame, leading: int) -> dict[int, np.ndarray]:
    """By length of vector, its ``leading`` directions of most variance; what is collected does not grow with rows."""
    sums = units.select("dim", "unit").mapInArrow(_moments, "dim int, cell int, value double")
    totals: dict[int, dict[int, float]] = {}
    for row in sums.groupBy("dim", "cell").agg(F.sum("value").alias("value")).collect():
        totals.setdefault(row.dim, {})[row.cell] = row.value
    out = {}
    for dim, cells in totals.items():
        m = np.array([cells[k] for k in range((dim + 1) ** 2)]).reshape(dim + 1, dim + 1)
        mean = m[-1, :-1] / m[-1, -1]
        _, vectors = np.linalg.eigh(m[:-1, :-1] / m[-1, -1] - np.outer(mean, mean))
        out[dim] = vectors[:, ::-1][:, :leading]
    return out


def _projected(directions: dict[int, np.ndarray], leading: int):
    """Adds ``p``: the leading coordinates, and the length of what they leave of the vector.

    Two remainders are at least as far apart as their lengths differ, so distances of ``p``
    are never longer than those of the vectors.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = np.zeros((batch.num_rows, leading + 1))
            for k, (dim, unit) in enumerate(zip(batch["dim"].to_pylist(), batch["unit"].to_pylist(), strict=True)):
                d = directions[dim]
                rows[k, : d.shape[1]] = own = np.frombuffer(unit) @ d
                rows[k, -1] = math.sqrt(max(0.0, 1 - own @ own))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(rows), pa.list_(pa.float64()))], names=[*batch.schema.names, "p"])

    return batches


def _ball(units: np.ndarray) -> tuple[np.ndarray, float]:
    """The mean of vectors, and how far the furthest lies from it."""
    center = units.mean(axis=0)
    return center, float(np.sqrt(((units - center) ** 2).sum(axis=1).max()))


def _tiles(tile_rows: int, eps: float):
    """Cuts each sorted partition into tiles with their vectors, the box of their ``p`` and the ball around the vectors.

    A tile ends when it is full; when it is half full and a cell of the first dimensions
    ends; and when it has an eighth of its rows, all of them near its mean so far, and the
    next vector is not: a tight group is a tile of its own.
    """

    def tile(dim, rows, turn):
        ids, weights, units, ps = zip(*rows, strict=True)
        p, packed = np.array(ps), b"".join(units)
        center, radius = _ball(np.frombuffer(packed).reshape(len(ids), -1))
        values = turn, dim, ids, weights, packed, p.tobytes(), p.min(axis=0), p.max(axis=0), center, radius
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TILE.types, strict=True)], schema=_TILE)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last, turn = None, 0
        total, loose = np.zeros(0), False
        for batch in stream:
            columns = (batch[c].to_pylist() for c in ("dim", "cells", "id", "weight", "unit", "p"))
            for dim, cells, *row in zip(*columns, strict=True):
                vector = np.frombuffer(row[2])
                ends = bool(held) and dim != last[0]
                far = False
                if held and not ends and not loose:
                    away = vector - total / len(held)
                    far = away @ away > eps * eps
                    ends = far and 8 * len(held) >= tile_rows
                ends = ends or len(held) == tile_rows or (2 * len(held) >= tile_rows and cells != last[1])
                if ends:
                    yield tile(last[0], held, turn)
                    held, turn = [], turn + 1
                total = total + vector if held else vector
                loose = bool(held) and (loose or far)
                last = dim, cells
                held.append(tuple(row))
        if held:
            yield tile(last[0], held, turn)

    return batches


_TILE = pa.schema(
    [("turn", pa.int64()), ("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64())), ("units", pa.binary()), ("ps", pa.binary())]
    + [("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("center", pa.list_(pa.float64())), ("radius", pa.float64())]
)
_TILE_DDL = (
    "turn long, dim int, ids array<long>, weights array<long>, units binary, ps binary, low array<double>, high array<double>, "
    "center array<double>, radius double"
)


def _gap(low_a, high_a, low_b, high_b) -> float:
    """The least distance of two boxes."""
    apart = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float(np.sqrt((apart * apart).sum()))


def _join_tiles(least: float, eps: float, leaf_rows: int):
    """Per pair of tiles: (id, n, root), the linked weight of each linked vector and the least id of its local component."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for k in range(batch.num_rows):
                row = {name: batch[name][k].as_py() for name in batch.schema.names}
                a, b = ((np.array(row[f"ids{s}"]), np.array(row[f"weights{s}"]), np.frombuffer(row[f"units{s}"]).reshape(-1, row["dim"]), np.frombuffer(row[f"ps{s}"]).reshape(len(row[f"ids{s}"]), -1)) for s in ("_a", "_b"))
                yield _linked(a, b, row["a"] == row["b"], least, eps, leaf_rows)

    return batches


def _linked(a, b, same: bool, least: float, eps: float, leaf_rows: int) -> pa.RecordBatch:
    n_a, n_b = np.zeros(len(a[0]), np.int64), np.zeros(len(b[0]), np.int64)
    # labels of the local components: an edge's ends take the least label until none changes
    root_a, root_b = a[0].copy(), (a[0] if same else b[0]).copy()
    if same:
        root_b = root_a
    edges: list[tuple[np.ndarray, np.ndarray]] = []

    @lru_cache(maxsize=None)
    def bounds(left: bool, start: int, end: int):
        side = a if left else b
        p = side[3][start:end]
        return p.min(axis=0), p.max(axis=0), *_ball(side[2][start:end])

    def join(i0, i1, j0, j1):
        low_a, high_a, center_a, radius_a = bounds(True, i0, i1)
        low_b, high_b, center_b, radius_b = bounds(False, j0, j1)
        if _gap(low_a, high_a, low_b, high_b) > eps or np.linalg.norm(center_a - center_b) - radius_a - radius_b > eps + SLACK:
            return
        if max(i1 - i0, j1 - j0) > leaf_rows:
            if i1 - i0 >= j1 - j0:
                mid = (i0 + i1) // 2
                parts = [(i0, mid, j0, j1), (mid, i1, j0, j1)]
                if same and (i0, i1) == (j0, j1):
                    parts = [(i0, mid, i0, mid), (i0, mid, mid, i1), (mid, i1, mid, i1)]
            else:
                mid = (j0 + j1) // 2
                parts = [(i0, i1, j0, mid), (i0, i1, mid, j1)]
            for part in parts:
                join(*part)
            return
        hit = a[2][i0:i1] @ b[2][j0:j1].T >= least
        diagonal = same and i0 == j0
        if diagonal:
            np.fill_diagonal(hit, False)
        if not hit.any():
            return
        n_a[i0:i1] += hit @ b[1][j0:j1]
        if not diagonal:
            (n_a if same else n_b)[j0:j1] += a[1][i0:i1] @ hit
        edges.append(_thinned(hit, i0, j0))

    join(0, len(a[0]), 0, len(b[0]))
    changed = bool(edges)
    if edges:
        left, right = np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges])
    while changed:
        low = np.minimum(root_a[left], root_b[right])
        changed = bool((root_a[left] != low).any() or (root_b[right] != low).any())
        np.minimum.at(root_a, left, low)
        np.minimum.at(root_b, right, low)
    out_a, out_b = n_a > 0, n_b > 0
    ids = np.concatenate([a[0][out_a], b[0][out_b]])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(np.concatenate([n_a[out_a], n_b[out_b]])), pa.array(np.concatenate([root_a[out_a], root_b[out_b]]))], names=["id", "n", "root"]
    )


def _thinned(hit: np.ndarray, i0: int, j0: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the bipartite links of a leaf, found breadth first."""
    rows_left, cols_left = hit.any(axis=1), hit.any(axis=0)
    i_out, j_out = [], []
    while rows_left.any():
        front = np.array([int(rows_left.argmax())])
        rows_left[front] = False
        while len(front):
            new = hit[front] & cols_left
            cols = np.flatnonzero(new.any(axis=0))
            i_out.append(front[new[:, cols].argmax(axis=0)])
            j_out.append(cols)
            cols_left[cols] = False
            new = hit[:, cols] & rows_left[:, None]
            front = np.flatnonzero(new.any(axis=1)) if len(cols) else cols
            if len(front):
                i_out.append(front)
                j_out.append(cols[new[front].argmax(axis=1)])
                rows_left[front] = False
    return np.concatenate(i_out) + i0, np.concatenate(j_out) + j0


def _near_tiles(boxes: DataFrame, eps: float, fanout: int) -> DataFrame:
    """Pairs (a, b) of tiles, a <= b, whose boxes and balls are at most ``eps`` apart.

    Goes down a tree of sequence intervals: the pairs of a level are the children of near
    pairs of the level above, so distant intervals are never opened.
    """
    n = boxes.agg(F.max("tile")).first()[0]
    levels = 0 if n is None else max(0, math.ceil(math.log(n + 1, fanout) - 1e-9))
    dims = LEADING + 1

    def at(level: int, side: str) -> DataFrame:
        node = F.floor(F.col("tile") / fanout**level).cast("long")
        corners = [F.min(F.col("low")[k]).alias(f"low{k}{side}") for k in range(dims)] + [F.max(F.col("high")[k]).alias(f"high{k}{side}") for k in range(dims)]
        nodes = boxes.groupBy(node.alias(side), F.col("dim").alias(f"dim{side}")).agg(*corners)
        return nodes.withColumn(f"up{side}", F.floor(F.col(side) / fanout).cast("long"))

    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"low{k}a") - F.col(f"high{k}b"), F.col(f"low{k}b") - F.col(f"high{k}a")), 2) for k in range(dims)), F.lit(0.0))
    pairs = boxes.sparkSession.range(1).select(F.lit(0).cast("long").alias("pa"), F.lit(0).cast("long").alias("pb"))
    for level in range(levels - 1, -1, -1):
        a, b = at(level, "a"), at(level, "b")
        near = (F.col("a") <= F.col("b")) & (F.col("dima") == F.col("dimb")) & (gap <= (eps + SLACK) ** 2)
        found = pairs.join(a, F.col("pa") == F.col("upa")).join(b, (F.col("pb") == F.col("upb")) & near)
        pairs = settle(found.select(F.col("a").alias("pa"), F.col("b").alias("pb")).distinct(), "tile-pairs")
    ball = lambda s: boxes.select(F.col("tile").alias(f"t{s}"), F.col("center").alias(f"c{s}"), F.col("radius").alias(f"r{s}"))
    apart = F.aggregate(F.zip_with("ca", "cb", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)
    met = pairs.join(ball("a"), F.col("pa") == F.col("ta")).join(ball("b"), F.col("pb") == F.col("tb"))
    met = met.where(F.sqrt(apart) - F.col("ra") - F.col("rb") <= eps + SLACK)
    return met.select(F.col("pa").alias("a"), F.col("pb").alias("b"))


def sorted_tiles(classes: DataFrame, eps: float, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """The tiles of ``classes`` (id, dim, unit, weight) along the epsilon grid order, and their numbers, boxes and balls."""
    directions = principal_directions(classes, LEADING)
    n = classes.count()
    rows = classes.select("id", "dim", "unit", "weight").mapInArrow(_projected(directions, LEADING), "id long, dim int, unit binary, weight long, p array<double>")
    rows = settle(rows, "projected")
    cells = [F.floor(F.col("p")[k] / eps).alias(f"cell{k}") for k in range(LEADING)]
    order = ["dim", *[f"cell{k}" for k in range(LEADING)], "id"]
    parts = max(1, math.ceil(n / (4 * tile_rows)))
    ordered = rows.select("*", *cells).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    coarse = F.array(*[f"cell{k}" for k in range(CUT_AT)]).alias("cells")
    tiles = ordered.select("id", "dim", "unit", "weight", "p", coarse).mapInArrow(_tiles(tile_rows, eps), _TILE_DDL)
    tiles = settle(tiles.select(F.spark_partition_id().alias("part"), "*"), "tiles")
    # tiles are numbered along the sorted sequence; there is one row per tile here
    numbered = tiles.select("part", "turn", "dim", "low", "high", "center", "radius").withColumn("tile", F.row_number().over(W.orderBy("part", "turn")) - 1)
    boxes = settle(numbered.withColumn("tile", F.col("tile").cast("long")), "boxes")
    return tiles, boxes


def link_vectors(vectors: DataFrame, cosine: float = 0.95, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(id, n_links, component) of the vectors that have a direction; ``vectors`` is (id, embedding).

    Equal unit vectors form a class, of which only the smallest id goes on, with the class
    size as its weight. The representatives are sorted by their grid cell of width epsilon
    on the leading principal dimensions, where epsilon is the distance of unit vectors at
    the threshold. Neither a projection nor the lengths of what it leaves over lengthen a
    distance, and vectors lie in the ball around their tile's mean, so tiles whose boxes or
    balls are further apart than that hold no link. Tiles of the sorted sequence are joined
    along a tree of intervals, and inside a pair of tiles halves are joined down to leaves,
    whose cosines are computed in double precision. Vectors without any grouping, in many
    dimensions, are nearly all within reach of each other's tiles and cost all pairs. A pair of tiles returns a count and a local root per vector, never
    its links. Vectors of different length are not compared.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    units = settle(vectors.select("id", "embedding").mapInArrow(_units, "id long, dim int, unit binary"), "units")
    classes = units.groupBy("dim", "unit").agg(F.min("id").alias("first"), F.count("*").alias("weight"))
    classes = settle(classes.select(F.col("first").alias("id"), "dim", "unit", "weight"), "classes")
    tiles, boxes = sorted_tiles(classes, eps, tile_rows)
    pairs = _near_tiles(boxes, eps, FANOUT)
    placed = boxes.select("part", "turn", "tile").join(tiles.select("part", "turn", "dim", "ids", "weights", "units", "ps"), ["part", "turn"]).drop("part", "turn")
    side = lambda s: placed.select(F.col("tile").alias(s), *([F.col("dim")] if s == "a" else []), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "weights", "units", "ps")])
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    linked = settle(joined.mapInArrow(_join_tiles(cosine, eps, LEAF_ROWS), "id long, n long, root long"), "linked")
    counts = linked.groupBy("id").agg(F.sum("n").alias("n"))
    found = connected_components(linked.select(F.col("id").alias("u"), F.col("root").alias("v")))
    reps = classes.join(counts, "id", "left").join(found, F.col("id") == F.col("node"), "left")
    reps = reps.select("dim", "unit", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    return units.join(reps, ["dim", "unit"]).select("id", "n_links", "component")


def near_vectors(vectors: DataFrame, cosine: float = 0.95, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row (vec_id, embedding).

    Vectors that are null, empty, zero or hold a null or a non-finite component link with
    nothing and are their own component; so do rows with a null vec_id, whose component is
    null and which are kept. Rows that share a vec_id count as vectors of their own for
    ``n_links``, and each gets the largest count among them. An empty table gives an empty
    table.
    """
    linked = link_vectors(vectors.select(F.col("vec_id").alias("id"), "embedding"), cosine, tile_rows)
    linked = linked.groupBy(F.col("id").alias("l_id")).agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    component = F.coalesce("component", "vec_id")
    return vectors.select("vec_id").join(linked, F.col("vec_id") == F.col("l_id"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
