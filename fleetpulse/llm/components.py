"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame, functions as F

from fleetpulse.session import settle


def _spread(edges: DataFrame, least_of: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least neighbour ``m`` of its end ``u``.

    ``least_of`` is already dealt by ``u``, and a join on ``u`` would run in the task of that
    aggregate, where the adaptive skew split can't cut a node with very many edges. The
    join takes a key made of ``u`` instead, so both sides come from shuffles of their own.
    """
    key = F.bitwise_not("u").alias("key")
    return edges.select(key, "u", "v").join(least_of.select(key, "m"), "key")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (u, v) reaches.

    Every round hangs the neighbours of each node on the least of them, first those above
    the node, then those below it. A node that has a third of all edges is counted by
    partial aggregates; its join is left to the adaptive skew split. Rounds write their
    edges to the shared folder, so no lineage grows and a lost executor costs one round.
    Nodes without an edge do not appear; loops and repeated edges are allowed, nulls not.
    """
    up, down = F.greatest("u", "v"), F.least("u", "v")
    edges = settle(edges.where("u <> v").select(up.alias("u"), down.alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # large star: each neighbour above a node joins the least of the node and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _spread(both, least).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its neighbours below it join the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = _spread(large, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
