"""The pipeline's rows rebuilt by brute force; only the learned verdicts come from op10."""

import hashlib
import re
import string
import zlib
from collections import Counter

import numpy as np
import tokenizers

import corpus_pipeline
from fleetpulse.llm.queries import QUERIES, table, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def without_shared_lines(docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    df = Counter(k for text in docs.values() for k in {key(line) for line in text.split("\n")} if k)
    return {d: "\n".join(line for line in text.split("\n") if df[key(line)] < 10) for d, text in docs.items()}


def one_of_near_copies(docs):
    def shingles(text):
        words = WORD.findall(text.translate(LOWER))
        return set(zip(*[words[k:] for k in range(5)], strict=False)) if len(words) >= 5 else {tuple(words)} - {()}

    sets = {d: shingles(t) for d, t in docs.items()}
    least = {d: d for d in docs}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {d: t for d, t in docs.items() if least[d] == d}


def copies(docs, sources):
    """How often each document comes: its words taken by whole passes and a prefix of its source's shuffle."""
    size = {d: len(WORD.findall(t)) for d, t in docs.items()}
    names = sorted({sources[d] for d in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[d] for d in docs if sources[d] == s) for s in names}
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(names)}
    target, free, rest = {}, list(names), 1.5 * sum(total.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * total[s]]
        for s in over or free:
            target[s] = 2.0 * total[s] if over else level * weight[s]
            rest -= target[s]
        free = [s for s in free if s not in target]
    out = Counter()
    for s in names:
        wanted = round(target[s])
        start = 0
        for d in sorted((d for d in docs if sources[d] == s), key=lambda d: (hashlib.md5(str(d).encode()).hexdigest(), d)):
            if total[s] and size[d]:
                taken = size[d] * (wanted // total[s]) + max(min(start + size[d], wanted % total[s]) - start, 0)
                out[d] = int(taken / size[d] + 0.5)
            start += size[d]
    return out


def packed(docs, times):
    library = tokenizers.Tokenizer.from_file(vocabulary())
    out = Counter()
    for d, text in docs.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for length in [1024] * (len(ids) // 1024) + [1 << k for k in range(9, -1, -1) if len(ids) % 1024 >> k & 1]:
            crc = zlib.crc32(ids[start : start + length].tobytes())
            out[d, start, length, crc, len(ids), 0] += times[d]
            start += length
    return +out


def test_rows_equal_brute_force(spark, small):
    rows = table(spark, small, "documents").select("doc_id", "text", "source").collect()
    sources = {r.doc_id: r.source for r in rows}
    kept = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, small).where("kept").collect()}
    docs = {r.doc_id: r.text or "" for r in rows if r.doc_id in kept}
    docs = one_of_near_copies(without_shared_lines(docs))
    want = packed(docs, copies(docs, sources))
    got = corpus_pipeline.run(spark, small).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in got) == want
    assert len({r.sequence_id for r in got}) == len(got)
