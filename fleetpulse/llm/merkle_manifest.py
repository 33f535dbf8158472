"""Merkle manifest of a dataset: hash trees per group, stored in blocks of van Emde Boas layout."""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetpulse.session import settle

DIGEST = 32
# A step of a path: where the sibling stands, then its digest.
ALONE, SIBLING_LEFT, SIBLING_RIGHT = range(3)
STEP = 1 + DIGEST


@lru_cache(maxsize=64)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Places of the nodes of a whole binary tree, by depth from its root and then by index.

    The tree is split at half its height. Its top comes first, then the subtrees below it
    from left to right, each laid out by the same rule; so the nodes of a path lie in few
    runs, whatever the size of a cache line or of a disk block.
    """
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    below = addresses(levels - top)
    size = (1 << (levels - top)) - 1
    starts = ((1 << top) - 1) + size * np.arange(1 << top, dtype=np.int64)
    return *addresses(top), *[(starts[:, None] + places).ravel() for places in below]


def height_of(count: int) -> int:
    """Steps from ``count`` nodes to a single one."""
    return (count - 1).bit_length()


def hashed(*digests: bytes) -> bytes:
    """The digest of the hex texts of digests, one after the other."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


class Block:
    """An aligned subtree of ``height`` steps over ``count`` nodes, as bytes in van Emde Boas order.

    Nodes beyond the last one of a step are blank. The last node of an uneven step is hashed alone.
    """

    def __init__(self, nodes: bytes, count: int, height: int):
        self.nodes, self.count, self.height = nodes, count, height
        self.places = addresses(height + 1)

    @classmethod
    def built(cls, digests: list[bytes], height: int) -> "Block":
        block = cls(b"", len(digests), height)
        held = bytearray(DIGEST * ((1 << (height + 1)) - 1))
        now = digests
        for depth in range(height, -1, -1):
            for digest, at in zip(now, block.places[depth].tolist(), strict=False):
                held[DIGEST * at : DIGEST * (at + 1)] = digest
            now = [hashed(*now[k : k + 2]) for k in range(0, len(now), 2)]
        block.nodes = bytes(held)
        return block

    def node(self, depth: int, index: int) -> bytes:
        at = DIGEST * int(self.places[depth][index])
        return self.nodes[at : at + DIGEST]

    @property
    def root(self) -> bytes:
        return self.node(0, 0)

    def path(self, index: int) -> bytes:
        """Steps from node ``index`` of the lowest level up to the root of the block."""
        steps, count = [], self.count
        for depth in range(self.height, 0, -1):
            if index & 1:
                steps.append(bytes([SIBLING_LEFT]) + self.node(depth, index - 1))
            elif index + 1 < count:
                steps.append(bytes([SIBLING_RIGHT]) + self.node(depth, index + 1))
            else:
                steps.append(bytes([ALONE]) + bytes(DIGEST))
            index, count = index >> 1, (count + 1) >> 1
        return b"".join(steps)


def siblings(path: bytes) -> list[bytes]:
    return [path[k + 1 : k + STEP] for k in range(0, len(path), STEP) if path[k] != ALONE]


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    now = leaf
    for k in range(0, len(path), STEP):
        sibling = path[k + 1 : k + STEP]
        now = hashed(now) if path[k] == ALONE else hashed(sibling, now) if path[k] == SIBLING_LEFT else hashed(now, sibling)
    return now


def _built(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for k in range(batch.num_rows):
            digests = [d.as_py() for d in batch["digests"][k].values]
            block = Block.built(digests, batch["height"][k].as_py())
            columns = [batch[n].slice(k, 1) for n in ("tree", "block", "height", "members")]
            columns += [pa.array([len(digests)], pa.int32()), pa.array([block.nodes], pa.binary()), pa.array([block.root], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "block", "height", "members", "count", "nodes", "root"])


def _paths(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the nodes at the foot of each block up to the root of the whole."""
    for batch in stream:
        for k in range(batch.num_rows):
            block = Block(batch["nodes"][k].as_py(), batch["count"][k].as_py(), batch["height"][k].as_py())
            above = batch["above"][k].as_py()
            paths = [block.path(i) + above for i in range(block.count)]
            members = batch["members"].slice(k, 1).flatten()
            tree = pa.repeat(batch["tree"][k], block.count)
            places = pa.array(np.arange(block.count) + batch["base"][k].as_py(), pa.int64())
            digests = pa.array([block.node(block.height, i) for i in range(block.count)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [tree, places, digests, members, pa.array(paths, pa.binary())], names=["tree", "place", "digest", "member", "path"]
            )


def _checked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        proofs, roots = [], []
        claims = zip(batch["digest"].to_pylist(), batch["claimed"].to_pylist(), batch["path"].to_pylist(), strict=True)
        for leaf, claimed, path in claims:
            proofs.append(hashed(*siblings(path)).hex())
            roots.append(folded(leaf if claimed is None else claimed, path).hex())
        columns = [batch[n] for n in ("tree", "doc_id", "digest")] + [pa.array(proofs, pa.string()), pa.array(roots, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "doc_id", "digest", "proof_sha256", "folded_root"])


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Add ``place``, each row's number from 0 in its ``tree`` by ``order``, and the tree's ``total`` of rows.

    Rows are dealt by ranges, so a tree with a third of all rows, or all of them, is spread
    over many tasks; only the number of rows per (tree, range) is added up in order.
    """
    keys = ["tree", *order]
    numbered = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", F.monotonically_increasing_id().alias("_number"))
    numbered = settle(numbered, "leaves").withColumn("_range", F.shiftright("_number", 33))
    sizes = numbered.groupBy("tree", "_range").agg(F.count("*").alias("_size"), F.min("_number").alias("_first"))
    ahead = W.partitionBy("tree").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.concat("tree", F.lit("")).alias("_tree"), F.col("_range").alias("_at"),
        (F.coalesce(F.sum("_size").over(ahead), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_size").over(W.partitionBy("tree")).alias("total"),
    )
    met = numbered.join(offsets, (F.col("tree") == F.col("_tree")) & (F.col("_range") == F.col("_at")))
    return met.select(*leaves.columns, (F.col("_number") + F.col("_offset")).alias("place"), "total")


def _level(nodes: DataFrame, steps: int) -> DataFrame:
    """Blocks over ``nodes`` (tree, place, total, digest, member); ``total`` nodes of a tree end in one block if they fit."""
    size = 1 << steps
    # a tree that fits into one block is as high as its number of nodes needs
    height = F.when(F.col("total") > size, steps).otherwise(F.ceil(F.log2("total")).cast("int"))
    grouped = nodes.groupBy("tree", F.shiftright("place", steps).alias("block"), "total").agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "member"))).alias("all")
    )
    rows = grouped.select("tree", "block", "total", height.alias("height"), F.col("all.digest").alias("digests"), F.col("all.member").alias("members"))
    member = rows.schema["members"].dataType.simpleString()
    built = rows.select("tree", F.struct("block", "total").alias("block"), "height", "digests", "members").mapInArrow(
        _built, f"tree string, block struct<block: long, total: long>, height int, members {member}, count int, nodes binary, root binary"
    )
    return built.select("tree", "block.block", "block.total", "height", "members", "count", "nodes", "root")


def build(leaves: DataFrame, order: list[str], steps: int = 8) -> list[DataFrame]:
    """Stored blocks of the trees over ``leaves`` (tree, digest, member and the columns of ``order``), the lowest level first.

    Each level groups 2**steps neighbouring nodes into a block; the roots of its blocks are
    the nodes of the next level, until every tree has one block. Trees are named by
    ``tree``, which is never null. A tree with a single leaf is a block without a step.
    """
    size = 1 << steps
    nodes = placed(leaves, order).select("tree", "place", "total", "digest", "member")
    levels = []
    while True:
        level = settle(_level(nodes, steps), "blocks")
        levels.append(level)
        upper = level.where(F.col("total") > size)
        if upper.isEmpty():
            return levels
        nodes = upper.select(
            "tree", F.col("block").alias("place"), F.floor((F.col("total") + (size - 1)) / size).cast("long").alias("total"),
            F.col("root").alias("digest"), F.lit(None).cast("boolean").alias("member"),
        )


def roots(levels: list[DataFrame], steps: int = 8) -> DataFrame:
    """(tree, root) of every tree: the root of the block that holds all of its nodes."""
    size = 1 << steps
    tops = [level.where(F.col("total") <= size).select("tree", "root") for level in levels]
    out = tops[0]
    for top in tops[1:]:
        out = out.unionByName(top)
    return out


def proofs(levels: list[DataFrame], above: DataFrame, steps: int = 8) -> DataFrame:
    """(tree, place, digest, member, path) of every leaf, from the highest block down.

    ``above`` (tree, path) leads from the root of each tree onward. A block's path is handed
    to the blocks below it; the siblings inside a block are found by their address alone.
    """
    size = 1 << steps
    handed = None
    for level in reversed(levels):
        tops = level.where(F.col("total") <= size).join(above.select(F.col("tree").alias("_tree"), F.col("path").alias("above")), F.col("tree") == F.col("_tree"))
        rows = tops.drop("_tree")
        if handed is not None:
            inner = level.where(F.col("total") > size).join(handed, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_place")))
            rows = rows.unionByName(inner.drop("_tree", "_place"))
        member = level.schema["members"].dataType.elementType.simpleString()
        found = rows.select("tree", (F.col("block") * size).alias("base"), "height", "count", "nodes", "members", "above").mapInArrow(
            _paths, f"tree string, place long, digest binary, member {member}, path binary"
        )
        handed = found.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("path").alias("above"))
    return found


def hashed_row(values: list[Column]) -> Column:
    """The leaf of a row: sha256 over its values as text, each with its length in bytes and a colon, ``-`` for null."""
    parts = [
        F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tree_name(group: Column) -> Column:
    """Text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def manifest(docs: DataFrame, steps: int = 8, tampered: Column | None = None) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """The blocks of the trees per language, those of the tree over their roots, and a proof of every row.

    A leaf is the hash of doc_id, source, lang, n_chars and text; leaves ascend by doc_id,
    nulls first, rows with one id by their hash. Each two nodes are hashed together, the
    last of an uneven level alone. Languages ascend bytewise, null first, and their roots
    are hashed the same way to one root. Proofs hold the row's ``doc_id``, its leaf
    (``digest``), the ``path`` to the root and, where one is claimed, another leaf:
    ``tampered`` marks rows that claim one character more than they have; a null count stays. An empty table gives no
    block and no proof.

    Texts are read once and hashed where they are; only digests are shuffled. Blocks have
    at most 2**steps leaves, whatever share of the rows a language has.
    """
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    claims = [F.col(c) for c in ("doc_id", "source", "lang")], F.col("text")
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    leaf = hashed_row([*claims[0], F.col("n_chars"), claims[1]])
    claimed = F.when(changed, hashed_row([*claims[0], more, claims[1]]))
    leaves = docs.select(tree_name(F.col("lang")).alias("tree"), "doc_id", leaf.alias("digest"), F.struct("doc_id", claimed.alias("claimed")).alias("member"))
    trees = build(leaves, ["doc_id", "digest"], steps)
    subroots = roots(trees, steps).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"), F.col("tree").alias("member"))
    whole = build(subroots, ["name"], steps)
    start = whole[0].select("tree", F.lit(b"").alias("path")).distinct()
    above = settle(proofs(whole, start, steps).select(F.col("member").alias("tree"), "path"), "subroot-paths")
    found = proofs(trees, above, steps).select("tree", "member.doc_id", "digest", "member.claimed", "path")
    return trees, whole, found


def crc_tampered(divisor: int = 7) -> Column:
    """Rows whose id's checksum ``divisor`` divides; rows without an id are left alone."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == 0


def verified(docs: DataFrame, steps: int = 8, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, a digest of the proof's siblings, the root that the claimed leaf folds to, and whether it is the root."""
    trees, whole, found = manifest(docs, steps, tampered)
    kind = found.schema["doc_id"].dataType.simpleString()
    checked = found.mapInArrow(_checked, f"tree string, doc_id {kind}, digest binary, proof_sha256 string, folded_root string")
    text = lambda c: F.lower(F.hex(c))
    root = roots(whole, steps).select(text(F.col("root")).alias("root"))
    subroots = roots(trees, steps).select(F.col("tree").alias("_tree"), text(F.col("root")).alias("subroot"))
    known = subroots.withColumn("root", root.scalar())
    return checked.join(known, F.col("tree") == F.col("_tree")).select(
        "doc_id", text(F.col("digest")).alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
