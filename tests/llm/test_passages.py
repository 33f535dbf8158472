"""Repeated passages inside long sentences and texts without terminators."""

import hashlib
import random
import re
import zlib

import pytest

from fleetpulse.llm import substring_dedup
from fleetpulse.llm.queries import QUERIES, table
from fleetpulse.llm.substring_dedup import dedup_substrings, pieces, runs, sentences


def test_pieces_are_the_text():
    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choices(["a", "be", " ", "  ", "\n", ".", "!", "\t", "É", "漢", "\x0b", "word "], k=r.randrange(60)))
        assert b"".join(pieces(text)).decode() == text


def test_runs_reach_both_ends():
    parts = [b"w " * n for n in random.Random(4).choices(range(1, 9), k=60)]
    found = {(a, a + n) for a, n, _ in runs(parts, 2, 20, True)}
    assert {(a, a + n) for a, n, _ in runs(parts, 2, 20)} <= found
    words = [len(p.split()) for p in parts]
    for end in range(2, 61):
        start = next((a for a in range(end - 2, -1, -1) if sum(words[a:end]) >= 20), None)
        assert start is None or (start, end) in found


@pytest.mark.parametrize("cut, most", [(sentences, None), (pieces, 16)])
def test_planted_passages(spark, cut, most):
    r = random.Random(9)
    own = lambda n: " ".join(f"own{r.randrange(10**9)}" for _ in range(n))
    passages = [" ".join(f"Word{r.randrange(10**9)}" for _ in range(80)) for _ in range(40)]
    rows = [(k, f"{own(30)} {p} {own(30)}") for k, p in enumerate(passages)]
    rows += [(100 + k, f"{own(7)} {p.lower()} {own(11)}. {own(40)}") for k, p in enumerate(passages)]
    rows += [(200, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {x.doc_id: x.kept_text for x in dedup_substrings(docs, cut=cut).select("doc.doc_id", "kept_text").collect()}
    left = [sum(w in kept[100 + k].split() for w in p.lower().split()) for k, p in enumerate(passages)]
    assert all(kept[k] == text for k, text in rows[:40])
    if most is None:
        assert set(left) == {80} and kept[200] == rows[0][1]
    else:
        assert sum(left) <= 40 * most and max(left) <= 50 and kept[200] == ""
        for k in range(40):
            assert [w for w in rows[40 + k][1].split() if w.startswith("own")] == [w for w in kept[100 + k].split() if w.startswith("own")]


def cut_by_hand(text):
    """Pieces of sentences: a cut after each word that a hash of the word and the one before picks, or after the sixteenth."""
    out = []
    for sentence in re.findall(rb"[^.!?\n]*[.!?\n][.!?\x20\x09-\x0D]*|[^.!?\n]+", text.encode()):
        words = re.findall(rb"\s*\S+\s*", sentence)
        now, n, before = b"", 0, 0
        for w in words:
            now, n, own = now + w, n + 1, zlib.crc32(w.strip().lower())
            if zlib.crc32(own.to_bytes(4, "little"), before) % 4 == 0 or n == 16:
                out.append(now)
                now, n = b"", 0
            before = own
        rest = now + sentence[len(b"".join(words)) :]
        if rest:
            out.append(rest)
    return out


def test_passage_query_equals_brute_force(spark, small):
    docs = {r.doc_id: r.text or "" for r in table(spark, small, "documents").collect()}
    cut = {d: cut_by_hand(t) for d, t in sorted(docs.items())}
    found = []
    for d, parts in cut.items():
        words = [p.lower().split() for p in parts]
        n = [len(w) for w in words]
        spans = set()
        for a in range(len(parts)):
            end = next((b for b in range(a + 2, len(parts) + 1) if sum(n[a:b]) >= 20), None)
            spans |= {(a, end)} if end else set()
            start = next((b for b in range(a - 1, -1, -1) if sum(n[b : a + 1]) >= 20), None)
            spans |= {(start, a + 1)} if start is not None else set()
        found += [(d, a, b, b"\n".join(b" ".join(w) for w in words[a:b])) for a, b in spans]
    first = {}
    for d, a, _, key in sorted(found):
        first.setdefault(key, (d, a))
    gone = {d: set() for d in docs}
    for d, a, b, key in found:
        if first[key] != (d, a):
            gone[d] |= set(range(a, b))
    got = {r.doc_id: (r.n_pieces, r.n_removed, r.kept_sha256) for r in QUERIES["op2_passage_dedup"](spark, small).collect()}
    for d, parts in cut.items():
        kept = b"".join(p for k, p in enumerate(parts) if k not in gone[d])
        assert got[d] == (len(parts), len(gone[d]), hashlib.sha256(kept).hexdigest()), d
    assert any(gone.values())
