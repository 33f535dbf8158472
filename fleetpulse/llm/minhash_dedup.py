"""MinHash near-dedup: circulant signatures, banding, exact Jaccard verification, components."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fleetpulse.llm.common import documents_of
from fleetpulse.llm.components import connected_components
from fleetpulse.llm.shingles import alike, mixed, shingle_set, texts_of
from fleetpulse.session import settle

BANDS, ROWS = 32, 5
SPACE = 1 << 20
BEFORE = 8

_SIGNED = "id long, fp long, n_shingles long, s1 long, s2 long, bands array<long>"
_SCHEMA = pa.schema(
    [("id", pa.int64()), ("fp", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64()))]
)


class Circulant:
    """Signatures from two permutations.

    The first one deals the shingles over ``SPACE`` places. Coordinate k is the least
    value, over a text's places, of the second one shifted by k places around the circle.
    The values of one place under all shifts are neighbours in the second permutation, so
    a text's signature is the minimum of one slice of it per shingle.
    """

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        around = np.random.default_rng(5).permutation(SPACE).astype(np.uint32)
        around = np.concatenate([around, around[: bands * rows]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(around, bands * rows)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = (mixed(shingles ^ np.uint64(0x51ED270B)) >> np.uint64(44)).astype(np.int64)
        least = self.shifted[places[:2048]].min(axis=0)
        for k in range(2048, len(places), 2048):
            least = np.minimum(least, self.shifted[places[k : k + 2048]].min(axis=0))
        return least

    def band_hashes(self, shingles: np.ndarray) -> np.ndarray:
        parts = self.signature(shingles).astype(np.uint64).reshape(self.bands, self.rows)
        held = np.arange(self.bands, dtype=np.uint64)
        for k in range(self.rows):
            held = mixed(held * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
        return held.view(np.int64)


def _signed(bands: int, rows: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant(bands, rows)
        for batch in stream:
            sizes, s1, s2, keys = [], [], [], []
            for text in texts_of(batch["text"]):
                shingles = shingle_set(text)
                sizes.append(len(shingles))
                held = mixed(shingles * np.uint64(3)), mixed(shingles ^ np.uint64(0xA5A5A5A5))
                s1.append(int(held[0].sum().view(np.int64)))
                s2.append(int(held[1].sum().view(np.int64)))
                keys.append(circulant.band_hashes(shingles) if len(shingles) else [])
            columns = [batch["id"], batch["fp"], *[pa.array(c, t) for c, t in zip((sizes, s1, s2, keys), _SCHEMA.types[2:], strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    return batches


def _verified(percent: int):
    """Keeps the pairs (a, b) whose full shingle sets are alike; sorted by b, so a hub is hashed once."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in stream:
            keep = []
            b = batch["b"].to_pylist()
            for k in range(batch.num_rows):
                if b[k] != last:
                    last, held = b[k], shingle_set(batch["text_b"][k].as_py().encode())
                keep.append(alike(shingle_set(batch["text_a"][k].as_py().encode()), held, percent))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(keep)), batch["b"].filter(pa.array(keep))], names=["a", "b"])

    return batches


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ids with 100 * intersection >= percent * union, by their whole texts."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verified(percent), "a long, b long")


def _sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for k, text in enumerate(texts_of(batch["text"])):
            g = pa.array(shingle_set(text).view(np.int64))
            columns = [pa.array([batch[name][k].as_py()] * len(g), pa.int64()) for name in ("id", "c", "n")]
            yield pa.RecordBatch.from_arrays([*columns, g], names=["id", "c", "n", "g"])


def shared_rare_shingles(rest: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``rest`` (id, c, n) in different components c that may be alike; loses none.

    Of two alike sets the rarest 100 - ``percent`` percent and one more of either must meet
    in a shingle, in any common order. Shingles of one text alone meet nothing, so a text
    that has so many of them has no pair at all, and edited copies of one original, each
    with edits of its own, are not compared with each other. A pair need not meet again at a
    shingle that has another shared one among the ``BEFORE`` rarer ones ahead of it on both
    sides; each row carries these and no more, however long its text is.
    """
    held = rest.join(texts, "id").select("id", "c", "n", "text").mapInArrow(_sets, "id long, c long, n long, g long")
    held = settle(held, "sets")
    often = held.groupBy("g").agg(F.count("*").alias("df")).where("df > 1")
    common = held.join(often, "g")
    rank = F.row_number().over(W.partitionBy("id").orderBy("df", "g"))
    ranked = common.select("id", "c", "n", "g", rank.alias("rank"), F.count("*").over(W.partitionBy("id")).alias("n_common"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    ranked = ranked.where(F.col("rank") <= prefix - (F.col("n") - F.col("n_common"))).drop("df")
    ahead = W.partitionBy("id").orderBy("rank").rowsBetween(-BEFORE, -1)
    ranked = ranked.withColumn("ahead", F.collect_list("g").over(ahead)).withColumn("rest", F.col("n_common") - F.col("rank") + 1)
    other = ranked.select(F.col("id").alias("b"), F.col("c").alias("c_b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"), F.col("ahead").alias("ahead_b"), "g")
    near = (F.col("id") < F.col("b")) & (F.col("c") != F.col("c_b"))
    # from the first shingle that both hold, two sets share at most what either has left to share with any other;
    # at a later one they have less left, so a pair that passes there passes at its first one too
    near &= (100 + percent) * F.least("rest", "rest_b") >= percent * (F.col("n") + F.col("n_b"))
    near &= ~F.arrays_overlap("ahead", "ahead_b")
    return ranked.join(other, "g").where(near).select(F.col("id").alias("a"), "b").distinct()


def link_documents(docs: DataFrame, percent: int = 85, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component) per distinct doc_id; near copies share a component, its smallest id.

    Texts with equal shingle sets form a class and only its smallest id goes on, so groups
    of exact copies of any size cost one row. Classes that agree in a band meet in its
    bucket. First each is verified against the bucket's hub, the member that shares most
    buckets with others; this links groups around a common original without looking at
    their pairs. Then, among the members of buckets that still hold several components,
    pairs that share a rare shingle are verified (see ``shared_rare_shingles``). A pair at
    the threshold agrees in none of 32 bands of 5 rows with a chance of 7 in a billion.

    Null and empty texts have no shingle and no link. Rows that share a doc_id count with
    the smallest text fingerprint; rows with a null doc_id are left out here.
    """
    documents = documents_of(docs).where(F.col("id").isNotNull())
    signed = documents.select("id", "fp", "text").mapInArrow(_signed(bands, rows), _SIGNED)
    signed = settle(signed, "signed")
    only = signed.groupBy("id").agg(F.min_by(F.struct("n_shingles", "s1", "s2", "bands"), "fp").alias("s"), F.min("fp").alias("fp"))
    only = settle(only.select("id", "fp", "s.*"), "signatures")
    key = ["n_shingles", "s1", "s2"]
    first = only.where("n_shingles > 0").groupBy(*key).agg(F.min(F.struct("id", "bands", "fp")).alias("first"))
    first = first.select(*key, "first.*")
    member = first.select("id", "n_shingles", F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    member = settle(member.join(shared, "bucket"), "members")
    degree = member.groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = member.join(degree, "id").select("bucket", "id", F.struct("degree", (-F.col("id")).alias("low")).alias("rank"))
    hubs = ranked.groupBy("bucket").agg((-F.max("rank")["low"]).alias("b"))
    spokes = member.join(hubs, "bucket").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    texts = documents.join(only.select(F.col("id").alias("k_id"), F.col("fp").alias("k_fp")), (F.col("id") == F.col("k_id")) & (F.col("fp") == F.col("k_fp")))
    texts = texts.select("id", "text")
    texts = texts.join(member.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    texts = settle(texts, "texts")
    edges = settle(verified(spokes, texts, percent), "spokes")
    found = connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = member.join(found, F.col("id") == F.col("node"), "left").select("bucket", "id", "n_shingles", F.coalesce("component", "id").alias("c"))
    open_ = placed.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("bucket")
    placed = placed.join(open_, "bucket", "left_semi")
    rest = settle(placed.groupBy("id", "c").agg(F.first("n_shingles").alias("n")), "rest")
    pairs = shared_rare_shingles(rest, texts, percent)
    tried = spokes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = settle(verified(pairs.join(tried, ["a", "b"], "left_anti"), texts, percent), "pairs")
    edges = edges.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = connected_components(edges).withColumnsRenamed({"node": "id"})
    # the class's first id stands for its members
    reached = first.join(found, "id", "left").select(*key, F.coalesce("component", "id").alias("component"))
    return only.join(reached, key, "left").select("id", "fp", "n_shingles", F.coalesce("component", "id").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = 85, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row; see ``link_documents``.

    A row with a null doc_id is linked with nothing, has null for its component, and is
    kept. Repeated rows get equal results; an empty table gives an empty table.
    """
    linked = link_documents(docs, percent, bands, rows).withColumnRenamed("id", "l_id")
    ids = docs.select("doc_id")
    kept = F.col("doc_id").eqNullSafe(F.col("component"))
    return ids.join(linked, F.col("doc_id") == F.col("l_id"), "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept")
    )


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` less near copies: of each group the document with the smallest id stays.

    Of rows that share a doc_id one stays; rows with a null doc_id all stay, and texts
    without a word are near copies of nothing.
    """
    documents = documents_of(docs)
    kept = link_documents(docs, percent).where("id = component").select(F.col("id").alias("k_id"), F.col("fp").alias("k_fp"))
    same = (F.col("id") == F.col("k_id")) & (F.col("fp") == F.col("k_fp"))
    first = documents.join(kept, same, "left_semi").dropDuplicates(["id"])
    return first.unionByName(documents.where(F.col("id").isNull())).select("doc.*")
