"""Mixing sources to target weights: a low-discrepancy schedule of equal blocks of words."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetpulse.functions.ordered import row_numbers
from fleetpulse.llm.common import documents_of, word_count
from fleetpulse.session import settle

# The weights of the sources in their order, the share of all words the mix
# takes, and how often a word may be taken.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0

GOLDEN = 0.6180339887498949


def sizes(docs: DataFrame) -> DataFrame:
    """(id, fp, source, size, turn): ``turn`` is the document's place in its source's shuffle."""
    documents = documents_of(docs)
    turn = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    source = F.col("doc.source").cast("string").alias("source")
    return documents.select("id", "fp", source, word_count(F.col("text")).alias("size"), turn.alias("turn"))


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: ``source_size`` and ``target``, the words the mix shall take.

    Sources, by code point and null last, weigh ``weights`` in turn. A source that would
    get over ``most`` times its size gets just that; what it leaves goes to the others by
    weight until none is above. In the order of size per weight, the capped sources come
    first, so running sums find the level of all others without a loop. One row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int"))
    limit = F.lit(most) * F.col("source_size")
    weighed = per_source.withColumn("weight", weight).withColumn("limit", limit)
    everything = W.partitionBy()
    before = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1
    )
    capped = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    passed = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    wanted = F.lit(share) * F.sum("source_size").over(everything)
    level = (wanted - capped) / (F.sum("weight").over(everything) - passed)
    leveled = weighed.withColumn("level", level)
    # from the first source that its level does not fill, levels only fall
    reached = F.col("level") * F.col("weight") <= F.col("limit")
    final = F.max(F.when(reached, F.col("level"))).over(everything)
    target = F.coalesce(F.least(F.col("limit"), final * F.col("weight")), F.col("limit"))
    return leveled.select("source", "source_size", target.alias("target"))


def _point(j: str) -> Column:
    """frac(j * golden ratio), exact to some 30 bits for any j below 2**41."""
    high, low = F.floor(F.col(j) / 2**20), F.col(j) % 2**20
    step = (2**20 * 0.6180339887498948482) % 1.0
    x = high * F.lit(step) + low * F.lit(GOLDEN)
    return x - F.floor(x)


def schedule(wanted: DataFrame, block_words: int, slice_slots: int = 1 << 16, bins: int = 4096) -> DataFrame:
    """(slot, source, rank, words): which source gives the block in each slot of the mix.

    ``wanted`` has (source, source_size, target). The source of slot j is the one whose
    part of the cumulative weights holds the j-th golden-ratio point; ``rank`` counts the
    slots of a source and names the block: rank modulo its number of blocks. A source's
    slots end where its target is met, the last one inside a block. Ranks that the points
    did not reach come after the others. A source that takes half of all slots is ranked
    in slices of ``slice_slots``.
    """
    whole = F.round("target").cast("long")
    blocks = F.ceil(F.col("source_size") / block_words)
    full, rest = F.floor(F.col("words_wanted") / F.col("source_size")), F.col("words_wanted") % F.col("source_size")
    n_slots = (full * F.col("n_blocks") + F.ceil(rest / block_words)).cast("long")
    upto = W.orderBy(F.col("source").asc_nulls_last())
    needs = (
        wanted.where("source_size > 0")
        .select("source", "source_size", whole.alias("words_wanted"), blocks.alias("n_blocks"))
        .where("words_wanted > 0")
        .withColumn("n_slots", n_slots)
        .withColumn("upto", F.sum("n_slots").over(upto))
        .withColumn("slots", F.sum("n_slots").over(W.partitionBy()))
        .withColumn("from", (F.col("upto") - F.col("n_slots")) / F.col("slots"))
        .withColumn("upto", F.col("upto") / F.col("slots"))
        .withColumn("place", F.row_number().over(upto))
    )
    needs = settle(needs, "needs")
    total = needs.agg(F.max("slots")).first()[0] or 0
    # a source's part of [0, 1) overlaps some of the bins; each point meets only the sources of its bin
    parts = needs.select(
        "place",
        F.col("from"),
        F.col("upto"),
        F.explode(F.sequence(F.floor(F.col("from") * bins), F.floor(F.col("upto") * bins))).alias("bin"),
    )
    points = needs.sparkSession.range(total).select(F.col("id").alias("slot"), _point("id").alias("point"))
    points = points.withColumn("bin", F.floor(F.col("point") * bins))
    inside = (F.col("point") >= F.col("from")) & (F.col("point") < F.col("upto"))
    placed = points.join(parts, "bin").where(inside).select("slot", "place")
    ranked = row_numbers(placed, "place", ["slot"], F.floor(F.col("slot") / slice_slots), "rank")
    ranked = ranked.select("slot", "place", (F.col("rank") - 1).alias("rank"))
    reached = ranked.groupBy("place").agg(F.count("*").alias("n"))
    left = (
        needs.join(reached, "place", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .where(F.col("n") < F.col("n_slots"))
        .select(F.lit(total).cast("long").alias("slot"), "place", F.explode(F.sequence(F.col("n").cast("long"), F.col("n_slots") - 1)).alias("rank"))
    )
    length = F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words)
    given = F.floor(F.col("rank") / F.col("n_blocks")) * F.col("source_size") + F.col("block") * block_words
    return (
        ranked.unionByName(left)
        .join(needs, "place")
        .where(F.col("rank") < F.col("n_slots"))
        .withColumn("block", F.col("rank") % F.col("n_blocks"))
        .withColumn("words", F.least(length, F.col("words_wanted") - given).cast("long"))
        .select("slot", "source", "rank", "block", "words")
    )


def shuffled_places(sized: DataFrame, slices: int = 4096) -> DataFrame:
    """Add ``start``: the words of the source that come before the document in its shuffle.

    The shuffle goes by a hash, so slices of the hash cut a source of any size evenly; the
    slices' sums, at most ``slices`` per source, give each slice its offset.
    """
    sliced = sized.withColumn("slice", F.conv(F.substring("turn", 1, 8), 16, 10).cast("long") * slices / 2**32)
    sliced = sliced.withColumn("slice", F.floor("slice"))
    before = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("source", "slice")
        .agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("o_source"), F.col("slice").alias("o_slice"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    )
    inside = W.partitionBy("source", "slice").orderBy("turn", "id", "fp").rowsBetween(W.unboundedPreceding, -1)
    ranked = sliced.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("o_source")) & (F.col("slice") == F.col("o_slice"))
    return ranked.join(offsets, same).select("id", "fp", "source", "size", (F.col("start") + F.col("offset")).alias("start"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, block_words: int = 1024) -> DataFrame:
    """Take words of each source up to its target, by whole passes over its shuffled documents.

    Returns (id, fp, source, size, source_size, target, taken), one row per input row.
    Each source's documents, shuffled by a hash of their id, form one run of words that is
    cut into blocks of ``block_words``; the schedule says how often each block is used,
    and a document gets its overlap with the used blocks. No block is used more than
    ceil(``most``) times. The result depends on ids and texts only, so reruns agree.

    Null texts have size 0, are never taken and still get a row; null sources form one
    source, the last; repeated rows are documents of their own; an empty table gives an
    empty table.
    """
    sized = settle(sizes(docs), "sizes")
    wanted = settle(targets(sized, weights, share, most), "targets")
    uses = (
        schedule(wanted, block_words)
        .groupBy("source", "block")
        .agg(F.collect_list("words").alias("uses"))
        .withColumnsRenamed({"source": "u_source", "block": "u_block"})
    )
    placed = shuffled_places(sized)
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    spread = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0))
    end = F.col("start") + F.col("size") - F.col("block") * block_words
    part = F.aggregate(
        "uses", F.lit(0).cast("long"), lambda n, words: n + F.greatest(F.least(end, words) - begin, F.lit(0)).cast("long")
    )
    same = F.col("source").eqNullSafe(F.col("u_source")) & (F.col("block") == F.col("u_block"))
    key = ["id", "fp", "source", "size", "start"]
    taken = spread.join(uses, same, "left").groupBy(*key).agg(F.sum(part).alias("taken"))
    unsized = placed.where("size = 0").select(*key, F.lit(0).cast("long").alias("taken"))
    targets_of = wanted.withColumnRenamed("source", "t_source")
    return (
        taken.unionByName(unsized)
        .join(targets_of, F.col("source").eqNullSafe(F.col("t_source")))
        .select("id", "fp", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def scheduled_parts(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, block_words: int = 1024
) -> DataFrame:
    """The mix in its order: (slot, rank, source, block, id, fp, first_word, words), a row per document in each use of a block.

    Reading by (slot, source, rank, id, fp) interleaves the sources as their targets ask,
    with little discrepancy in any stretch. ``first_word`` is the place in the document of
    the first of its ``words`` in that block. The words of a document add up to ``taken`` of
    ``mix``. Blocks are joined by (source, block), of which none has more documents than
    words, so no source gathers in one task.
    """
    sized = settle(sizes(docs), "sizes")
    wanted = settle(targets(sized, weights, share, most), "targets")
    uses = schedule(wanted, block_words).select("slot", "rank", F.col("source").alias("u_source"), F.col("block").alias("u_block"), F.col("words").alias("used"))
    placed = shuffled_places(sized).where("size > 0")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    spread = placed.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0))
    end = F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.col("used"))
    same = F.col("source").eqNullSafe(F.col("u_source")) & (F.col("block") == F.col("u_block"))
    return spread.join(uses, same).where(end > begin).select(
        "slot", "rank", "source", "block", "id", "fp", (F.col("block") * block_words + begin - F.col("start")).alias("first_word"), (end - begin).cast("long").alias("words")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, to the nearest whole copy.

    At most one document per source is taken in part. Documents without a word are taken never.
    """
    documents = documents_of(docs)
    taken = mix(docs, **options).where("size > 0").groupBy(F.col("id").alias("t_id"), F.col("fp").alias("t_fp"))
    copies = F.round(F.sum("taken") / F.sum("size")).cast("int")
    taken = taken.agg(copies.alias("copies")).where("copies > 0")
    same = F.col("id").eqNullSafe(F.col("t_id")) & (F.col("fp") == F.col("t_fp"))
    each = documents.join(taken, same).select("doc", F.explode(F.sequence(F.lit(1), "copies")))
    return each.select("doc.*")
