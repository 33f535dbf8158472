"""Every operator and stage on nulls, empty and long texts, repeats, clashing names and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetpulse.llm import embedding_dedup, line_dedup, minhash_dedup, mixing, packing, quality_rules, substring_dedup, suffix_dedup, token_counts, toxicity
from fleetpulse.llm.queries import vocabulary

LONG = " ".join(random.Random(1).choices("alpha beta gamma delta epsilon zeta. eta theta\niota".split(" "), k=20_000))
PROSE = " ".join(f"word{k}" for k in range(90)) + "."
ROWS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "One line\nshared line\nTwo"), (4, "One line\nshared line\nTwo"),
    (5, "ONE LINE \nshared line"), (6, LONG), (7, LONG), (8, PROSE), (9, PROSE + " extra"), (None, None), (None, "Shared line\nno id"),
    (10, "é" * 300), (11, "a" * 5000), (12, "x" * 120 + "y" * 120 + "x" * 120), (13, "<|endoftext|> it's  \n  '' 12"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have names that operators use inside."""
    plain = spark.createDataFrame(ROWS, SCHEMA)
    more = {"lang": F.lit(None).cast("string"), "source": F.when(F.col("doc_id") % 3 > 0, F.lit("s")), "n_chars": F.length("text").cast("long")}
    clashing = {c: F.lit(c) for c in ("doc", "id", "fp", "pos", "line", "kept", "size", "n_words", "spans", "h1", "component", "label_id", "dense")}
    return plain.withColumns(more | clashing).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(8, 1, 0), (9, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None), (8, 1, 0)], "doc_id long, quality int, toxic int")


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.select(name).collect()), key=lambda x: (x is not None, x))


ALL = sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))


def operators(labels):
    network = toxicity.train([("you fool", 1), ("a fine day", 0)], rounds=1)
    return {
        "lines": lambda d: line_dedup.dedup_lines(d, 2).select("doc.doc_id"),
        "first lines": lambda d: line_dedup.dedup_lines(d, 1, keep="first").select("doc.doc_id"),
        "substrings": lambda d: substring_dedup.dedup_substrings(d).select("doc.doc_id"),
        "toxicity": lambda d: toxicity.score_toxicity(d, network).select("doc.doc_id"),
        "near copies": minhash_dedup.near_duplicates,
        "bytes": lambda d: suffix_dedup.dedup_bytes(d).select("doc.doc_id"),
        "tokens": lambda d: token_counts.count_tokens(d, vocabulary()).select("doc.doc_id"),
        "mix": lambda d: mixing.mix(d).withColumnRenamed("id", "doc_id"),
        "rules": lambda d: quality_rules.judge(quality_rules.text_counts(d), labels).withColumnRenamed("id", "doc_id"),
    }


NAMES = ["lines", "first lines", "substrings", "toxicity", "near copies", "bytes", "tokens", "mix", "rules"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(docs, labels, name):
    operator = operators(labels)[name]
    assert ids(operator(docs)) == ALL
    assert ids(operator(docs.limit(0))) == []


def test_lines(docs):
    rows = line_dedup.dedup_lines(docs, 3).select("doc.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    by = {(r.doc_id, r.n_lines): r for r in rows}
    assert by[4, 3].kept_text == "One line\nTwo" and by[4, 3].n_dropped == 1
    assert by[5, 2].kept_text == "ONE LINE "
    assert by[None, 2].kept_text == "no id" and by[None, 1].n_dropped == 0
    assert by[3, 2].kept_text == " \n\t"


def test_first_lines_stay(docs):
    rows = line_dedup.dedup_lines(docs, 2, keep="first").select("doc.doc_id", "kept_text").collect()
    by = {r.doc_id: r.kept_text for r in rows if r.doc_id is not None}
    assert by[4] == "One line\nTwo" and by[5] == ""  # the rows without an id come first
    with pytest.raises(ValueError, match="keep"):
        line_dedup.dedup_lines(docs, 2, keep="last")


def test_bytes_inside_one_document(docs):
    rows = {r[0]: r for r in suffix_dedup.dedup_bytes(docs).select("doc.doc_id", "n_bytes", "n_removed", "n_spans").collect()}
    assert rows[11].n_removed == 4999 and rows[11].n_spans == 1
    assert (rows[12].n_bytes, rows[12].n_removed, rows[12].n_spans) == (360, 358, 2)
    assert rows[10].n_bytes == 600 and rows[10].n_removed == 598
    assert rows[7].n_removed == rows[7].n_bytes


def test_near_copies(docs):
    rows = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs).collect()}
    assert rows[7].component_id == 6 and not rows[7].kept
    assert rows[9].component_id == 8 and rows[8].kept
    assert rows[2].n_shingles == 0 and rows[2].kept and rows[1].component_id == 1
    assert rows[None].component_id is None and rows[None].kept


def test_rules_need_labels_of_both_kinds(docs, labels):
    counts = quality_rules.text_counts(docs)
    judged = quality_rules.judge(counts, labels.where("quality = 1"))
    assert {r.id for r in judged.where("kept").collect()} == {8, 9}


def test_pieces(docs):
    pieces = packing.binary_pieces(docs, vocabulary(), 64).collect()
    per = {}
    for r in pieces:
        assert len(r.ids) == 4 * r.length and r.length & (r.length - 1) == 0
        per.setdefault(r.doc_id, []).append(r)
    assert [r.length for r in per[1]] == [1] and per[1][0].ids == b"\0" * 4
    assert sum(r.length for r in per[6]) == per[6][0].doc_tokens
    packed = packing.packed_digests(docs, vocabulary()).collect()
    assert len({r.sequence_id for r in packed}) == len(packed)
    assert packing.packed_digests(docs.limit(0), vocabulary()).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.binary_pieces(docs, vocabulary(), 100)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0])]
    rows += [(9, [None, 1.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 0.01]), (12, [1e300, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(vectors).collect()}
    assert {k for k, r in got.items() if r.component_id == 1} == {1, 2, 11, 12}
    assert got[1].n_links == 3 and got[11].n_links == 3
    for k in (3, 4, 5, 6, 7, 8, 9, 10):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert got[None].n_links == 0
    assert embedding_dedup.near_vectors(vectors.limit(0)).count() == 0


def test_stages_keep_the_columns(spark, docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.dtypes == now.dtypes, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert ids(corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))) == [8, 9]
    assert ids(corpus_pipeline.STAGES[2][1](spark, docs, str(tmp_path))) == [None, None, 1, 2, 3, 4, 5, 6, 8, 10, 11, 12, 13]
