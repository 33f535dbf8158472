"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetpulse.llm.common import documents_of, whole_text

WORD = re.compile(r"\w+")
WINDOW, STEP = 24, 12
WORD_DIMS, CHAR_DIMS, HIDDEN = 4, 4, 6
BUCKETS, VOCABULARY = 1 << 13, 4000


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def grams(word: str) -> list[int]:
    """Buckets of the word's character 3- to 5-grams, with its ends marked."""
    marked = f"<{word}>"
    return [zlib.crc32(marked[k : k + n].encode()) % BUCKETS for n in (3, 4, 5) for k in range(max(1, len(marked) - n + 1))]


def windows(n_words: int) -> range:
    """Starts of the overlapping windows that cover a text."""
    return range(0, max(1, n_words - WINDOW + STEP), STEP) if n_words else range(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


@dataclass
class Network:
    """Parameters by name; the word at place 0 is padding, at place 1 any word outside the vocabulary."""

    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]
    prior: float

    def inputs(self, words: list[str]) -> np.ndarray:
        """The input vector of each word."""
        return self.vectors(*self.places(words))[0]

    def places(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' places in the vocabulary, their character n-grams, and where each word's n-grams begin."""
        held = [grams(w) for w in words]
        begins = np.cumsum([0, *map(len, held[:-1])])
        flat = np.fromiter((g for h in held for g in h), np.int64)
        return np.array([self.vocabulary.get(w, 1) for w in words], np.int64), flat, begins

    def vectors(self, places: np.ndarray, flat: np.ndarray, begins: np.ndarray, trace: bool = False):
        """Per word, its embedding next to the largest value of its n-grams in each dimension; and which n-grams have it."""
        if not len(places):
            return np.zeros((0, WORD_DIMS + CHAR_DIMS), np.float32), None
        rows = self.weights["char"][flat]
        chars = np.maximum.reduceat(rows, begins, axis=0)
        best = None
        if trace:
            top = rows == np.repeat(chars, np.diff(begins, append=len(flat)), axis=0)
            best = flat[np.minimum.reduceat(np.where(top, np.arange(len(flat))[:, None], len(flat)), begins, axis=0)]
        return np.hstack([self.weights["word"][places], chars]), best

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """``x`` is (windows, WINDOW, inputs), ``mask`` 1 for words and 0 for padding."""
        runs = [self._run(x, mask, d, keep) for d in ("f", "b")]
        h = np.concatenate([r[0] for r in runs], axis=2)
        u = np.tanh(h @ self.weights["att"] + self.weights["att_b"])
        e = u @ self.weights["att_v"] + (mask - 1) * np.float32(1e4)
        a = np.exp(e - e.max(axis=1, keepdims=True))
        a /= a.sum(axis=1, keepdims=True)
        pooled = (a[:, :, None] * h).sum(axis=1)
        out = pooled @ self.weights["out"] + self.weights["out_b"]
        return (out, (runs, h, u, a, pooled)) if keep else out

    def _run(self, x, mask, d, keep):
        w, u, b = self.weights["w" + d], self.weights["u" + d], self.weights["b" + d]
        n, length, _ = x.shape
        gx = x @ w + b
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((n, length, HIDDEN), np.float32)
        cache = []
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            gh = h @ u
            zr = _sigmoid(gx[:, t, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(gx[:, t, 2 * HIDDEN :] + r * gh[:, 2 * HIDDEN :])
            new = c + z * (h - c)
            m = mask[:, t, None]
            if keep:
                cache.append((t, h, z, r, c, gh[:, 2 * HIDDEN :], m))
            h = h + m * (new - h)
            out[:, t] = h
        return out, cache

    def gradients(self, x, mask, target, weight):
        """Gradients of the weighted log loss, by parameter and for ``x``."""
        logit, (runs, h, u, a, pooled) = self.logits(x, mask, keep=True)
        g: dict[str, np.ndarray] = {}
        d_out = (_sigmoid(logit) - target) * weight / len(target)
        g["out"], g["out_b"] = pooled.T @ d_out, d_out.sum()
        d_pooled = d_out[:, None] * self.weights["out"]
        d_a = (d_pooled[:, None, :] * h).sum(axis=2)
        d_e = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
        g["att_v"] = np.einsum("nt,ntk->k", d_e, u)
        d_u = d_e[:, :, None] * self.weights["att_v"] * (1 - u * u)
        g["att"], g["att_b"] = np.einsum("nti,ntk->ik", h, d_u), d_u.sum(axis=(0, 1))
        d_h = a[:, :, None] * d_pooled[:, None, :] + d_u @ self.weights["att"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            d_x += self._run_back(x, runs[k][1], d_h[:, :, k * HIDDEN : (k + 1) * HIDDEN], d, g)
        return g, d_x

    def _run_back(self, x, cache, d_h, d, g):
        u = self.weights["u" + d]
        d_gx = np.zeros((*x.shape[:2], 3 * HIDDEN), np.float32)
        d_u, after = np.zeros_like(u), np.zeros((len(x), HIDDEN), np.float32)
        for t, h, z, r, c, ghc, m in reversed(cache):
            total = after + d_h[:, t]
            d_new = total * m
            d_c = d_new * (1 - z) * (1 - c * c)
            d_z = d_new * (h - c) * z * (1 - z)
            d_r = d_c * ghc * r * (1 - r)
            d_gh = np.hstack([d_z, d_r, d_c * r])
            d_gx[:, t] = np.hstack([d_z, d_r, d_c])
            d_u += h.T @ d_gh
            after = total * (1 - m) + d_new * z + d_gh @ u.T
        g["u" + d], g["w" + d], g["b" + d] = d_u, np.einsum("nti,ntk->ik", x, d_gx), d_gx.sum(axis=(0, 1))
        return d_gx @ self.weights["w" + d].T


def _odds(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int, key, pseudo: float) -> float:
    """Log odds of meeting ``key`` in a toxic text, drawn towards 0 for rare ones."""
    return float(np.log((toxic[key] + pseudo) / (n_toxic + 2 * pseudo)) - np.log((clean[key] + pseudo) / (n_clean + 2 * pseudo)))


def _cut(texts: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words (0: padding), all windows as places in them, and the text of each window."""
    places: dict[str, int] = {"": 0}
    rows, owner = [], []
    for k, words in enumerate(texts):
        held = [places.setdefault(w, len(places)) for w in words]
        for s in windows(len(words)):
            row = held[s : s + WINDOW]
            rows.append(row + [0] * (WINDOW - len(row)))
            owner.append(k)
    return list(places), np.array(rows, np.int64).reshape(-1, WINDOW), np.array(owner, np.int64)


def train(rows: list[tuple[str, int]], rounds: int = 12, seed: int = 7) -> Network:
    """Learn from (text, label) rows; each round trains on the windows that score highest now.

    A text is toxic if any of its windows is, so the label is put on a text's best window
    (for clean texts the best three). Words and character n-grams start with their log
    odds between the labels in their first dimension, which also picks the first windows.
    """
    rng = np.random.default_rng(seed)
    texts = [WORD.findall(t.lower()) for t, _ in rows]
    label = np.array([y for _, y in rows], np.float32)
    n_toxic, n_clean = int(label.sum()), int(len(label) - label.sum())
    words = Counter[str](), Counter[str]()
    chars = Counter[int](), Counter[int]()
    for held, y in zip(texts, label, strict=True):
        distinct = set(held)
        words[int(y == 0)].update(distinct)
        chars[int(y == 0)].update({g for w in distinct for g in grams(w)})
    odds = {w: _odds(*words, n_toxic, n_clean, w, 5.0) for w in words[0] | words[1] if words[0][w] + words[1][w] >= 5}
    chosen = sorted(odds, key=lambda w: (-abs(odds[w]), w))[:VOCABULARY]
    scale = np.float32(0.1)
    normal = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    weights = {"word": scale * normal(len(chosen) + 2, WORD_DIMS), "char": scale * normal(BUCKETS, CHAR_DIMS)}
    weights["word"][:2] = 0
    weights["word"][2:, 0] = [odds[w] / 2 for w in chosen]
    weights["char"][:, 0] = [_odds(*chars, n_toxic, n_clean, g, 20.0) / 2 for g in range(BUCKETS)]
    for d in "fb":
        weights["w" + d] = normal(WORD_DIMS + CHAR_DIMS, 3 * HIDDEN) / 3
        weights["u" + d] = normal(HIDDEN, 3 * HIDDEN) / 3
        weights["b" + d] = np.zeros(3 * HIDDEN, np.float32)
    weights |= {"att": normal(2 * HIDDEN, 2 * HIDDEN) / 4, "att_b": np.zeros(2 * HIDDEN, np.float32), "att_v": normal(2 * HIDDEN) / 4}
    weights |= {"out": normal(2 * HIDDEN) / 4, "out_b": np.float32(0)}
    network = Network({w: k + 2 for k, w in enumerate(chosen)}, weights, 0.0)
    distinct, cut, owner = _cut(texts)
    if not n_toxic or not n_clean or not len(cut):
        network.weights["out"] = np.zeros(2 * HIDDEN, np.float32)
        network.weights["out_b"] = np.float32(5.0 if n_toxic else -5.0)
        network.prior = float(n_toxic > 0)
        return network
    places, flat, begins = network.places(distinct)
    moments: dict[str, list[np.ndarray]] = {}
    steps = 0
    for turn in range(rounds):
        x, best = network.vectors(places, flat, begins, trace=True)
        x[0] = 0
        mask = (cut > 0).astype(np.float32)
        if turn:
            score = np.concatenate([network.logits(x[cut[k : k + 4096]], mask[k : k + 4096]) for k in range(0, len(cut), 4096)])
        else:
            score = np.maximum(x[:, 0], x[:, WORD_DIMS])[cut].max(axis=1)
        order = np.lexsort((-score, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        picked = order[rank < np.where(label[owner[order]] == 1, 1, 3)]
        for _ in range(3):
            rng.shuffle(picked)
            for k in range(0, len(picked), 128):
                batch = picked[k : k + 128]
                target = label[owner[batch]]
                share = target.mean()
                weight = np.where(target == 1, 0.5 / max(share, 0.05), 0.5 / max(1 - share, 0.05)).astype(np.float32)
                g, d_x = network.gradients(x[cut[batch]], mask[batch], target, weight)
                into = cut[batch].ravel()
                pull = d_x.reshape(-1, x.shape[1]) * (into > 0)[:, None]
                g["word"], g["char"] = np.zeros_like(weights["word"]), np.zeros_like(weights["char"])
                np.add.at(g["word"], places[into], pull[:, :WORD_DIMS])
                g["word"][:2] = 0
                for dim in range(CHAR_DIMS):
                    np.add.at(g["char"][:, dim], best[into, dim], pull[:, WORD_DIMS + dim])
                steps += 1
                for name, grad in g.items():
                    m, v = moments.setdefault(name, [np.zeros_like(weights[name]), np.zeros_like(weights[name])])
                    m += np.float32(0.1) * (grad - m)
                    v += np.float32(0.001) * (grad * grad - v)
                    rate = np.float32(0.01 * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps))
                    weights[name] = weights[name] - rate * m / (np.sqrt(v) + np.float32(1e-8))
                    moments[name] = [m, v]
    network.prior = min(0.49, n_toxic / len(label))
    return network


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> list[tuple[str, int]]:
    """At most ``max_labelled`` labelled texts that are not held out, half of them toxic where there are as many.

    A document labelled more than once counts with its highest label; the choice goes by a
    hash of the id, and chosen texts come whole.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    half = lambda y: known.where(F.col("toxic") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled // 2)
    texts = docs.select(F.col("doc_id").alias("id"), whole_text().alias("text"))
    rows = texts.join(half(0).unionByName(half(1)), F.col("id") == F.col("label_id")).select("id", "text", "toxic").collect()
    return [(r.text, r.toxic) for r in sorted(rows)]


def _scored(network: Network, words_at_once: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, int] = {}
        x = np.zeros((1, WORD_DIMS + CHAR_DIMS), np.float32)

        def best_scores(texts: list[list[str]]) -> np.ndarray:
            nonlocal x
            if len(places) > 400_000:
                places.clear()
                x = x[:1]
            before = len(places)
            held = [[places.setdefault(w, len(places) + 1) for w in words] for words in texts]
            if len(places) > before:
                x = np.vstack([x, network.inputs(list(places)[before:])])
            rows, owner = [], []
            for k, row in enumerate(held):
                padded = np.array(row + [0] * WINDOW)
                starts = np.array(windows(len(row)), np.int64)
                rows.append(padded[starts[:, None] + np.arange(WINDOW)])
                owner += [k] * len(starts)
            out = np.full(len(texts), -np.inf, np.float32)
            cut = np.concatenate(rows) if rows else np.zeros((0, WINDOW), np.int64)
            for k in range(0, len(cut), 4096):
                part = cut[k : k + 4096]
                np.maximum.at(out, owner[k : k + 4096], network.logits(x[part], (part > 0).astype(np.float32)))
            return out

        for batch in stream:
            scores = np.zeros(batch.num_rows)
            texts: list[list[str]] = []
            first = held = 0
            for k, text in enumerate(batch["text"]):
                texts.append(WORD.findall(text.as_py().lower()))
                held += len(texts[-1])
                if held >= words_at_once or k == batch.num_rows - 1:
                    logit = best_scores(texts).astype(np.float64)
                    scores[first : k + 1] = np.where(np.isfinite(logit), 1 / (1 + np.exp(-np.clip(logit, -60, 60))), network.prior)
                    texts, first, held = [], k + 1, 0
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(scores)], names=["doc", "score"])

    return batches


def score_toxicity(docs: DataFrame, network: Network, columns: list[str] | None = None, words_at_once: int = 100_000) -> DataFrame:
    """``doc`` (the input row, or its ``columns``), ``score`` (0 to 1) of its whole text and ``predicted``.

    The score is that of the text's highest window; windows overlap by half and cover every
    word. Null texts and texts without a word get the share of toxic texts in the sample.
    Repeated rows get equal scores; an empty table gives an empty table. No shuffle.
    """
    documents = documents_of(docs)
    kept = documents.select(F.struct(*[F.col("doc")[c].alias(c) for c in columns or docs.columns]).alias("doc"), "text")
    scored = kept.mapInArrow(_scored(network, words_at_once), f"doc {kept.schema['doc'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
