"""The operators against brute force on the smallest tables, and their parts by themselves."""

import hashlib
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetpulse.llm import minhash_dedup, mixing, packing, quality_rules, suffix_dedup, token_counts, toxicity
from fleetpulse.llm.components import connected_components
from fleetpulse.llm.queries import QUERIES, table, vocabulary


def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}


LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def word_sets(text):
    """Five-word shingles as the contract words them."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(5)], strict=False))


def roots(n, links):
    up = dict.fromkeys(n)

    def top(x):
        while up[x] is not None:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        if a != b:
            up[b] = a
    return {x: top(x) for x in n}


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {x.node: x.component for x in got} == roots(nodes, edges)


def test_near_copies_equal_all_pairs(spark, small):
    sets = {d: word_sets(t) for d, t in texts(spark, small).items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    got = QUERIES["op5_minhash_dedup"](spark, small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {d: (len(s), want[d]) for d, s in sets.items()}


def test_edited_copies_of_one_original(spark):
    r = random.Random(8)
    words = [f"w{r.randrange(10**6)}" for _ in range(150)]
    rows = [(0, " ".join(words))]
    for k in range(1, 60):
        own = list(words)
        for _ in range(r.choice([1, 2, 3, 4, 6])):
            own[r.randrange(150)] = f"new{r.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    sets = {d: word_sets(t) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in got} == roots(sets, links)


def test_long_near_copies(spark):
    """Three texts of 120,000 words, alike to 0.84, 0.84 and 0.90: no row grows with a text's length."""
    r = random.Random(3)
    words = [f"w{r.randrange(10**7)}" for _ in range(120_000)]

    def edited(base, n):
        own = list(base)
        for _ in range(n):
            own[r.randrange(len(own))] = f"x{r.randrange(10**9)}"
        return own

    one, two = edited(words, 1050), edited(words, 1050)
    rows = [(0, " ".join(one)), (1, " ".join(two)), (2, " ".join(edited(two, 1250)))]
    sets = {d: word_sets(t) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert links == [(1, 2)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == {d: (len(s), roots(sets, links)[d]) for d, s in sets.items()}


def test_circulant_signature_estimates_jaccard():
    r = np.random.default_rng(2)
    a = r.integers(0, 2**63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], r.integers(0, 2**63, 600, dtype=np.uint64)])
    made = minhash_dedup.Circulant(64, 8)
    same = (made.signature(a) == made.signature(b)).mean()
    assert same == pytest.approx(2400 / 3600, abs=0.08)


def test_bytes_equal_brute_force(spark, small):
    seen, want = set(), {}
    for d, t in sorted(texts(spark, small).items()):
        data = t.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(data[k : k + 100])
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[d] = (len(data), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    got = QUERIES["op6_suffix_dedup"](spark, small).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_suffix_order():
    r = random.Random(3)
    rows = [(7, k, 0, 0, 1, 0, bytes(r.choices(b"ab", k=r.randint(5, 40)))) for k in range(60)]
    held = suffix_dedup.Suffixes(rows, 100)
    import functools

    order = sorted(range(60), key=functools.cmp_to_key(held.compare))
    assert [rows[k][6] for k in order] == sorted(x[6] for x in rows)


def test_token_counts_equal_the_library(spark, small):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary())
    held = token_counts.Vocabulary(vocabulary())
    splitter, transducer = token_counts.Splitter(chunk=15), token_counts.CountTransducer(held, max_states=2000)
    r = random.Random(5)
    parts = ["'s", "'re", "'", " ", "  ", "\n", "\t", "a", "don", "ing", "é", "1", "23", "!", "...", "　", "\x85", "\x1c", "<|endoftext|>", "漢字", "😀", "Ⅷ"]
    own = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(400)] + list(texts(spark, small).values())
    for text in own:
        cut, found = token_counts.segments(text, held.special)
        pieces, _ = splitter.pieces(cut)
        assert found + transducer.count_all(pieces).sum() == len(library.encode(text, add_special_tokens=False).ids), text[:80]


def test_pieces_hold_the_library_ids(spark, small):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary())
    docs = texts(spark, small)
    parts = {}
    for r in packing.binary_pieces(table(spark, small, "documents"), vocabulary()).collect():
        parts.setdefault(r.doc_id, []).append((r.start, r.ids))
    for d, text in docs.items():
        ids = np.frombuffer(b"".join(x for _, x in sorted(parts[d])), "<u4").tolist()
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 0]


def test_schedule_spreads_each_source(spark):
    wanted = spark.createDataFrame([("a", 60_000, 90_000.0), ("b", 30_000, 10_000.0), (None, 5_000, 7_500.0)], "source string, source_size long, target double")
    rows = mixing.schedule(wanted, 100, slice_slots=64).collect()
    words = Counter()
    for r in rows:
        words[r.source] += r.words
    assert words == {"a": 90_000, "b": 10_000, None: 7_500}
    first = Counter(r.source for r in rows if r.slot < 430)
    assert abs(first["a"] - 430 * 900 / 1075) < 8
    assert max(Counter((r.source, r.block) for r in rows).values()) <= 2


def test_learned_rules():
    r = random.Random(6)
    names = list(quality_rules.MEASURES)
    rows = []
    for k in range(600):
        row = {m: r.random() for m in names}
        row["quality"] = 0 if row["symbol_rate"] > 0.8 or (row["upper_share"] > 0.6 and row["word_length"] > 0.7) else 1
        rows.append(row)
    rules = quality_rules.learn_list(rows)
    right = sum(any(quality_rules.covers(x, row) for x in rules) == (row["quality"] == 0) for row in rows)
    assert right >= 570
    assert quality_rules.learn_list([x for x in rows if x["quality"] == 1]) == []


def test_rules_on_held_out_labels(spark, medium):
    got = QUERIES["op10_quality_rules"](spark, medium).join(table(spark, medium, "labels"), "doc_id").where("not base_failed")
    wrong = got.where(F.col("kept") != (F.col("quality") == 1)).count()
    assert wrong <= 0.03 * got.count()


def test_repeat_words(spark):
    docs = spark.createDataFrame([(1, "a b c a b c a x"), (2, "a a a a"), (3, "a b"), (4, "p q r s\nP q r s")], "doc_id long, text string")
    got = {r.id: r.n_repeat_words for r in quality_rules.text_counts(docs).collect()}
    assert got == {1: 7, 2: 4, 3: 0, 4: 6}


def test_network_gradients():
    network = toxicity.train([("you fool " * 20, 1), ("a fine day " * 20, 0)], rounds=1)
    r = np.random.default_rng(1)
    x = r.normal(size=(3, toxicity.WINDOW, 8))
    mask = np.ones((3, toxicity.WINDOW))
    mask[1, 10:] = 0
    network.weights = {k: np.asarray(v, np.float64) for k, v in network.weights.items()}
    target, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        p = 1 / (1 + np.exp(-network.logits(x, mask)))
        return float(-(target * np.log(p) + (1 - target) * np.log(1 - p)).mean())

    found, _ = network.gradients(x, mask, target, weight)
    for name in ("uf", "wb", "bf", "att", "att_v", "out"):
        held = network.weights[name]
        place = tuple(r.integers(0, n) for n in held.shape)
        before = held[place]
        held[place] = before + 1e-4
        up = loss()
        held[place] = before - 1e-4
        down = loss()
        held[place] = before
        assert found[name][place] == pytest.approx((up - down) / 2e-4, abs=2e-3), name


def test_toxicity_on_held_out_labels(spark, medium):
    got = QUERIES["op3_toxicity"](spark, medium).join(table(spark, medium, "labels"), "doc_id").where("held_out")
    assert got.where(F.col("toxic") == F.col("predicted")).count() >= 0.9 * got.count()


def test_parts_of_the_schedule_add_up(spark, small):
    docs = table(spark, small, "documents")
    parts = mixing.scheduled_parts(docs, block_words=64).collect()
    taken = Counter()
    for r in parts:
        taken[r.id] += r.words
        assert r.words > 0 and r.first_word >= 0
    rows = mixing.mix(docs, block_words=64).collect()
    assert {r.id: r.taken for r in rows if r.taken} == taken
    # any stretch of slots holds the sources in the proportion of their targets
    target = {r.source: r.target for r in rows}
    slots = max(r.slot for r in parts)
    early = Counter()
    for r in parts:
        if r.slot < slots // 4:
            early[r.source] += r.words
    for source, words in early.items():
        assert words / sum(early.values()) == pytest.approx(target[source] / sum(target.values()), abs=0.02)


def counts_by_hand(text):
    """op10's columns as the contract words them."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {k + i for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for i in range(3)}
    seen, n_dup = set(), 0
    for line in text.split("\n"):
        if word.search(line):
            n_dup += line in seen
            seen.add(line)
    base = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>[]" for c in text if c not in "[]"), n_dup, len(repeated), base


def test_rule_counts_equal_brute_force(spark, small):
    got = {r.doc_id: tuple(r[1:7]) for r in QUERIES["op10_quality_rules"](spark, small).collect()}
    assert got == {d: counts_by_hand(t) for d, t in texts(spark, small).items()}
