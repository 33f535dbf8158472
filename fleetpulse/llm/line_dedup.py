"""Line dedup: hashed lines, first occurrences by a range shuffle, bitmaps of kept lines."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetpulse.llm.common import WHITE, documents_of, hash_pair, lowered


def line_keys(documents: DataFrame) -> DataFrame:
    """One row (id, fp, pos, h1, h2) per line that is not blank.

    A line's key is the line without white space at both ends and with ``A-Z`` in lower case.
    """
    split = F.posexplode(F.split(lowered(F.col("text")), "\n")).alias("pos", "line")
    lines = documents.select("id", "fp", split).withColumn("key", F.btrim("line", F.lit(WHITE)))
    return lines.where(F.length("key") > 0).select("id", "fp", "pos", *hash_pair(F.col("key")))


def first_occurrences(lines: DataFrame) -> DataFrame:
    """Per key: the number of documents that have it and its first place (id, pos, fp).

    The range shuffle includes the document, so a key that fills a third of all rows is
    cut over many tasks. Each task streams its sorted rows and keeps the first of each
    (key, document); of those a key sends one row per task to the final count.
    """
    ranged = lines.repartitionByRange("h1", "h2", "id")
    in_document = W.partitionBy("h1", "h2", "id").orderBy("pos", "fp")
    firsts = ranged.withColumn("rank", F.row_number().over(in_document)).where("rank = 1")
    return firsts.groupBy("h1", "h2").agg(
        F.count("*").alias("n_docs"), F.min(F.struct("id", "pos", "fp")).alias("first")
    )


def keep_bitmaps(documents: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """Per document that loses lines: (id, fp, n_dropped, keep).

    ``keep`` holds (word, bits): 64 lines per word, bit 1 for a kept line. Words in which
    every line stays are left out.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    lines = line_keys(documents)
    frequent = first_occurrences(lines).where(F.col("n_docs") >= min_docs)
    # a join on h1 and h2 would run in the task of the count, out of reach of the adaptive skew split
    key = [F.bitwise_not("h1").alias("k1"), F.bitwise_not("h2").alias("k2")]
    dropped = lines.select("id", "fp", "pos", *key).join(frequent.select(*key, "first"), ["k1", "k2"])
    if keep == "first":
        dropped = dropped.where(~F.struct("id", "pos", "fp").eqNullSafe(F.col("first")))
    return (
        dropped.groupBy("id", "fp", F.expr("pos div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("gone"))
        .groupBy("id", "fp")
        .agg(
            F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
            F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
        )
    )


def _kept_text() -> Column:
    """The lines whose bit is set in ``dense``, the bitmap with its left out words filled in."""
    lines = F.split("text", "\n")
    kept = F.filter(
        lines,
        lambda _, i: F.expr("1L").bitwiseAND(
            F.call_function(
                "shiftright",
                F.coalesce(F.get("dense", F.floor(i / 64).cast("int")), F.lit(-1).cast("long")),
                i % 64,
            )
        )
        == 1,
    )
    return F.when(F.col("dense").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, keep: str = "none") -> DataFrame:
    """Drop lines that at least ``min_docs`` documents share.

    With ``keep="none"`` such a line goes in every document, with ``keep="first"`` all but
    its first occurrence by (doc_id, position) go; then a repeat inside one document counts
    only if ``min_docs`` is 1. Blank lines always stay.

    Returns (doc, n_lines, n_dropped, keep, kept_text), one row per input row; ``doc`` is
    the input row, ``keep`` the bitmap of ``keep_bitmaps`` (null: all lines stay).

    Nulls: a null text is one empty line; rows with a null doc_id count as one document
    together. Repeated rows count as one document and get equal results. An empty table
    gives an empty table.
    """
    documents = documents_of(docs)
    dense = F.expr(
        "flatten(transform(keep, (x, i) -> concat("
        "array_repeat(-1L, cast(x.word - coalesce(get(keep, i - 1).word, -1L) - 1 as int)), array(x.bits))))"
    )
    bitmaps = keep_bitmaps(documents, min_docs, keep).withColumn("dense", dense)
    bitmaps = bitmaps.withColumnsRenamed({"id": "b_id", "fp": "b_fp"})
    same = F.col("id").eqNullSafe(F.col("b_id")) & (F.col("fp") == F.col("b_fp"))
    return documents.join(bitmaps, same, "left").select(
        "doc",
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        "keep",
        _kept_text().alias("kept_text"),
    )


def without_shared_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The rows of ``docs`` with ``text`` less the lines that ``min_docs`` documents share, and ``n_chars`` to match."""
    deduped = dedup_lines(docs, min_docs)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return deduped.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
