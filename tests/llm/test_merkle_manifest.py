"""The manifest against trees built by hand."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import merkle_manifest as merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, source, lang, n_chars, text):
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    """Levels of digests, and the siblings of each leaf with their side."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([H(*now[k : k + 2]) for k in range(0, len(now), 2)])
    return levels


def climb(levels, at, digest):
    proof = []
    for level in levels[:-1]:
        pair = level[at - at % 2 : at - at % 2 + 2]
        others = [d for k, d in enumerate(pair) if k != at % 2]
        proof += others
        digest = H(*others, digest) if at % 2 else H(digest, *others)
        at //= 2
    return proof, digest


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = tree([leaf(*r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    for place, g in enumerate(names):
        for k, r in enumerate(groups[g]):
            claimed = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                claimed = leaf(*r[:3], r[3] + 1, r[4])
            inner, folded = climb(trees[g], k, claimed)
            outer, folded = climb(top, place, folded)
            out.append((r[0], leaf(*r), trees[g][-1][0], top[-1][0], H(*inner, *outer), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def some_rows(n, langs, seed=3):
    r = random.Random(seed)
    rows = [(k * 3, r.choice(["a", None, "é"]), r.choice(langs), r.choice([None, 5, 2**63 - 1]), r.choice(["", None, f"text {k}", "ß" * k])) for k in range(n)]
    return rows + [(None, "a", langs[0], 1, "x"), (None, "a", langs[0], 1, "x"), (6, "b", langs[0], 9, "same id"), (6, "b", langs[0], 9, "same id")]


@pytest.mark.parametrize("n, langs, steps", [
    (150, ["en", "en", "en", "de", "Zz", "é", None, ""], 2), (70, ["en"], 1), (130, ["en", "fr"], 8), (0, ["en"], 3), (60, [f"l{k}" for k in range(40)], 2),
])
def test_equals_trees_by_hand(spark, n, langs, steps):
    rows = some_rows(n, langs)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("tree", "place", "digest", "member", "root", "path")})
    got = merkle.verified(docs, steps, merkle.crc_tampered())
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == by_hand(rows)


def test_nothing_and_one(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle.verified(none).count() == 0
    one = merkle.verified(spark.createDataFrame([(1, "a", "en", 1, "t")], SCHEMA)).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root
    assert one[0].proof_sha256 == H() and one[0].verified


@pytest.mark.parametrize("levels", range(1, 11))
def test_layout(levels):
    """Every address is used once; each half of the height lies in one run."""
    places = merkle.addresses(levels)
    assert sorted(p for level in places for p in level.tolist()) == list(range((1 << levels) - 1))
    top = levels // 2
    assert sorted(p for level in places[:top] for p in level.tolist()) == list(range((1 << top) - 1))
    size = (1 << (levels - top)) - 1
    for k in range(1 << top):
        own = [p for d in range(top, levels) for p in places[d][k << (d - top) : (k + 1) << (d - top)].tolist()]
        assert sorted(own) == list(range((1 << top) - 1 + k * size, (1 << top) - 1 + (k + 1) * size))


def test_stored_blocks_prove_every_row(spark):
    """The blocks alone are enough to fold each leaf to its subroot."""
    rows = some_rows(90, ["en", "de"])
    trees, whole, found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), 3)
    subroots = {r.tree: r.root for r in merkle.roots(trees, 3).collect()}
    root = merkle.roots(whole, 3).first().root
    per = {}
    for r in trees[0].collect():
        block = merkle.Block(r.nodes, r["count"], r.height)
        for k in range(r["count"]):
            assert merkle.folded(block.node(r.height, k), block.path(k)) == r.root
        per[r.tree] = per.get(r.tree, 0) + r["count"]
    assert sum(per.values()) == len(rows) and set(per) == set(subroots)
    assert all(merkle.folded(r.digest, r.path) == root for r in found.collect())
