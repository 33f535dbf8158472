"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random
import struct

import pytest
import sentencepiece
from pyspark.sql import functions as F

from fleetpulse.llm import sentence_pieces
from fleetpulse.llm.queries import QUERIES, piece_vocabulary, table, vocabulary


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary())


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.PieceModel(piece_vocabulary())


def test_hostile_texts(model, library):
    r = random.Random(1)
    parts = [*"abcdeths  ▁\n\t.,'ABéßñ中文😀\x00<s>/0x41", "▁▁", "  ", "<s>", "</s>", "<0x41>", "the", "ing"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(40)))
        ids = library.encode(text)
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids)


def test_any_ids(model, library):
    r = random.Random(2)
    for _ in range(4000):
        ids = [r.choice([0, 1, 2, 28705, 259, 264, *range(3, 259)]) for _ in range(r.randrange(9))]
        assert model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 100_000, " " * 100_000, "\n" * 100_000, "ab" * 50_000, "中" * 100_000])
def test_long_stretches(model, library, text):
    assert model.encode(text) == library.encode(text)


def test_forgetting_changes_nothing(spark, small):
    docs = table(spark, small, "documents")
    few = sentence_pieces.encode_documents(docs, piece_vocabulary(), ["doc_id"], remembered=50, chars=1000)
    many = sentence_pieces.encode_documents(docs, piece_vocabulary(), ["doc_id"])
    assert sorted(few.collect()) == sorted(many.collect())


def test_query_equals_the_library(spark, medium, library):
    want = {}
    for r in table(spark, medium, "documents").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        digests = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)), hashlib.sha256(library.decode(ids).encode())
        want[r.doc_id] = (len(ids), *[d.hexdigest() for d in digests])
    got = QUERIES["op11_sentence_pieces"](spark, medium).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert sentence_pieces.differences(table(spark, medium, "documents"), piece_vocabulary()).count() == 0


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, " "), (None, "a  b"), (4, "x y"), (4, "x y"), (5, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("doc", "id", "fp", "ids", "n_tokens", "decoded")})
    got = sentence_pieces.encode_documents(docs, piece_vocabulary()).select("doc.doc_id", "n_tokens", "decoded").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == 2 and by[1].decoded == by[2].decoded == ""
    assert by[3].decoded == " " and by[None].decoded == "a  b"
    assert sentence_pieces.differences(docs, piece_vocabulary()).count() == 0
    assert sentence_pieces.encode_documents(docs.limit(0), piece_vocabulary()).count() == 0


def test_other_kinds_of_model_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    held = sentencepiece_model_pb2.ModelProto()
    with open(piece_vocabulary(), "rb") as f:
        held.ParseFromString(f.read())
    held.trainer_spec.model_type = 1
    (tmp_path / "m.model").write_bytes(held.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        sentence_pieces.PieceModel(str(tmp_path / "m.model"))
