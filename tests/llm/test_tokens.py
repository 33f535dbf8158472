"""Token counts and packing plans against the tokenizers library, whole queries and hostile texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tokenizers

from fleetpulse.llm import packing, token_counts
from fleetpulse.llm.queries import QUERIES, table, vocabulary


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def ids(spark, medium, library):
    rows = table(spark, medium, "documents").select("doc_id", "text").collect()
    return {r.doc_id: (r.text or "", library.encode(r.text or "", add_special_tokens=False).ids) for r in rows}


def test_counts_query_equals_the_library(spark, medium, ids):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op7_token_counts"](spark, medium).collect()}
    assert got == {d: (len(text.encode()), len(own), len(own) > 512) for d, (text, own) in ids.items()}


def test_packing_query_equals_the_library(spark, medium, ids):
    """Checksums and totals by the library; every sequence gapless from 0 and as long as a power of two."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op4_packing"](spark, medium).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for d, (_, own) in ids.items():
        whole, start = np.array([*own, packing.END_ID], "<u4"), 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (start, len(whole))
            assert r.ids_crc32 == zlib.crc32(whole[start : start + r.length].tobytes())
            start += r.length
        assert start == len(whole)
    for rows in sequences.values():
        end = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 1024 and end & (end - 1) == 0


HOSTILE = ["'s", "'re", "'", " ", "  ", "\n", "\t", "a", "don", "ing", "é", "1", "23", "!", "...", "　", "\x85", "\x1c", "<|endoftext|>", "漢字", "😀", "Ⅷ"]


def test_hostile_texts(library):
    r = random.Random(6)
    texts = ["".join(r.choices(HOSTILE, k=r.randint(0, 30))) for _ in range(3000)] + ["", "<|endoftext|>", "<|endoftext|><|endoftext|>"]
    for text, got in zip(texts, packing.Encoder(vocabulary(), remembered=100).encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" ", "a", "\n", "!", "ab ", "é"])
def test_very_long_runs(spark, library, text):
    """Two million letters of a kind: the counts are those of the encoder, the ids those of the library."""
    long = text * (2_000_000 // len(text))
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    want = library.encode(long, add_special_tokens=False).ids
    pieces = packing.binary_pieces(docs, vocabulary()).orderBy("start").collect()
    assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == [*want, packing.END_ID]
    assert token_counts.count_tokens(docs, vocabulary()).first().n_tokens == len(want)


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_chunk_maps(library, chunk):
    """Counts of long pieces from composed maps of their chunks."""
    held = token_counts.CountTransducer(token_counts.Vocabulary(vocabulary()), chunk=chunk)
    r = random.Random(chunk)
    for letters in ("ab", "etaoinshrdlu", "é漢a", "x"):
        for n in (1, 2, 50, 400):
            piece = "".join(r.choices(letters, k=n))
            assert held.count(piece) == len(library.encode(piece, add_special_tokens=False).ids)


def test_forgotten_states_change_nothing(library):
    held = token_counts.CountTransducer(token_counts.Vocabulary(vocabulary()), max_states=5, max_pieces=4)
    r = random.Random(7)
    words = ["".join(r.choices("etaoin", k=r.randint(1, 9))) for _ in range(300)]
    assert held.count_all(words).tolist() == [len(library.encode(w, add_special_tokens=False).ids) for w in words]
