"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary."""

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.common import Remembered, documents_of

# Unicode's White_Space, and the letters that follow an apostrophe in a piece.
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

END, LETTER, NUMBER, OTHER, GAP, LAST_SPACE, LAST_GAP, SHORT, LONG = range(9)
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)


def code_point_classes() -> np.ndarray:
    """The class of each code point; one more entry stands for the end of a text."""
    kinds = np.fromiter((ord(unicodedata.category(chr(c))[0]) for c in range(0x110000)), np.uint8, 0x110000)
    table = np.full(0x110001, OTHER, np.uint8)
    table[:-1][kinds == ord("L")] = LETTER
    table[:-1][kinds == ord("N")] = NUMBER
    table[SPACES] = GAP
    table[-1] = END
    return table


def piece_transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a piece) by state * 9 + class, for the vocabulary's splitting rule."""
    after = np.tile(
        np.array([CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, AFTER_SPACE, CLOSED, ONE_MORE, TWO_MORE], np.uint8), (8, 1)
    )
    starts = np.ones((8, 9), bool)
    starts[:, END] = False
    for state, symbol in ((IN_LETTERS, LETTER), (IN_NUMBERS, NUMBER), (IN_GAP, GAP), (AFTER_SPACE, LETTER), (AFTER_SPACE, NUMBER)):
        starts[state, symbol] = False
    for state in (IN_OTHERS, AFTER_SPACE):
        for symbol in (OTHER, SHORT, LONG):
            after[state, symbol], starts[state, symbol] = IN_OTHERS, False
    for state, to in ((ONE_MORE, CLOSED), (TWO_MORE, ONE_MORE)):
        after[state, LETTER], starts[state, LETTER] = to, False
    return after.ravel(), starts.ravel()


class Splitter:
    """Cuts texts into the pieces that are tokenized apart."""

    def __init__(self, chunk: int = 192):
        if chunk % 3:
            raise ValueError(f"chunk must be a multiple of 3, not {chunk}")
        self.chunk = chunk
        self.classes = code_point_classes()
        self.after, self.starts = piece_transducer()
        step = self.after.reshape(8, 9).astype(np.intp)
        self.after_three = step[step[step]].ravel()

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """The classes, with the bounded look-ahead of the rule folded in."""
        symbols = self.classes[points]
        following = np.append(symbols[1:], END)
        last = (symbols == GAP) & (following != GAP) & (following != END)
        symbols[last] = np.where(points[last] == 32, LAST_SPACE, LAST_GAP)
        for k in np.flatnonzero(points == 39):
            one, two = (chr(p) if p < 0x110000 else "" for p in (*points[k + 1 : k + 3], 0x110000, 0x110000)[:2])
            if one and one in ONE_LETTER:
                symbols[k] = SHORT
            elif one + two in TWO_LETTERS:
                symbols[k] = LONG
        return symbols

    def piece_starts(self, symbols: np.ndarray) -> np.ndarray:
        """Where pieces start: chunks as maps from state to state, composed by a parallel prefix scan, then replayed."""
        n_chunks = -(-len(symbols) // self.chunk)
        padded = np.zeros(n_chunks * self.chunk, np.uint8)
        padded[: len(symbols)] = symbols
        columns = np.ascontiguousarray(padded.reshape(n_chunks, self.chunk).T).astype(np.intp)
        maps = np.tile(np.arange(8, dtype=np.intp), (n_chunks, 1))
        # three symbols at a time
        for k in range(0, self.chunk, 3):
            column = (columns[k] * 9 + columns[k + 1]) * 9 + columns[k + 2]
            maps = self.after_three.take(maps * 729 + column[:, None])
        after = self.after.astype(np.intp)
        reach = 1
        while reach < n_chunks:
            maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].copy(), axis=1)
            reach *= 2
        state = np.concatenate([[CLOSED], maps[:-1, CLOSED]])
        out = np.empty((self.chunk, n_chunks), bool)
        for k, column in enumerate(columns):
            place = state * 9 + column
            out[k] = self.starts[place]
            state = after[place]
        return out.T.ravel()[: len(symbols)]

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """All pieces in order, and the number of pieces of each text."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        points[ends] = 0x110000
        starts = self.piece_starts(self.symbols(points))
        cuts = starts.copy()
        cuts[ends] = True
        cuts = np.flatnonzero(cuts)
        is_piece = starts[cuts]
        first, last = cuts[:-1][is_piece[:-1]], cuts[1:][is_piece[:-1]]
        counts = np.diff(np.searchsorted(first, ends), prepend=0)
        return [joined[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)], counts


def byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte: printable ones stand for themselves, others start at 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        letters = byte_letters()
        ids = held["model"]["vocab"]
        self.special = [t["content"] for t in held["added_tokens"]]
        self.special_ids = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.ids = {bytes(map(letters.__getitem__, t)): k for t, k in ids.items() if t not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in held["model"]["merges"])
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        # the two halves each token is merged from, and when
        self.halves = {to: (pair, rank) for pair, (rank, to) in self.merges.items()}

    def apart(self, left: int, right: int) -> bool:
        """Whether the merge rules keep two neighbouring tokens as they are.

        Takes the merges inside both tokens back, the latest first; a rule that would join
        the parts at the border before the next of those merges breaks the pair.
        """
        latest = len(self.merges)
        while True:
            joined = self.merges.get((left, right))
            if joined and joined[0] < latest:
                return False
            from_left, from_right = self.halves.get(left), self.halves.get(right)
            if from_left and (not from_right or from_left[1] > from_right[1]):
                # a merge at the border with the rank of this one lies further left and goes first
                (_, left), latest = from_left[0], from_left[1]
            elif from_right:
                (right, _), latest = from_right[0], from_right[1] + 1
            else:
                return True


class CountTransducer:
    """A deterministic transducer over bytes; its transitions carry the change of the token count.

    The tokens of a prefix end in the one vocabulary token whose pair with the tokens
    before it survives the merge rules. A state holds what later bytes can depend on: the
    starts from which the bytes so far are the beginning of some token, each as (place in
    the token trie, token before it, tokens up to there minus tokens up to now). States
    and transitions are compiled when first met and shared by all pieces; beyond
    ``max_states`` the compiled part is dropped and grows anew, while the answers stay.

    A piece of more than ``chunk`` bytes is cut into chunks. Each one is run by itself, as a
    map from entry states to (exit state, tokens); a scan composes the maps (see ``scan``).
    """

    def __init__(self, vocabulary: Vocabulary, max_states: int = 150_000, max_pieces: int = 1_000_000, chunk: int = 256):
        self.vocabulary, self.max_states, self.chunk = vocabulary, max_states, chunk
        self.counts = Remembered(self.count, max_pieces)
        self.children: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        nodes = 1
        for token, k in vocabulary.ids.items():
            node = 0
            for b in token:
                step = node << 8 | b
                if step not in self.children:
                    self.children[step] = nodes
                    nodes += 1
                node = self.children[step]
            self.token_at[node] = k
        self.inner = {step >> 8 for step in self.children}
        self.forget()

    def forget(self) -> None:
        start = ((0, -1, 0),)
        self.states: list[tuple] = [start]
        self.known = {start: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def follows(self, before: int, token: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged by the rules."""
        if before < 0:
            return True
        pair = before, token
        if pair not in self.pairs:
            self.pairs[pair] = self.vocabulary.apart(before, token)
        return self.pairs[pair]

    def compiled(self, state: int, byte: int) -> tuple[int, int]:
        alive, last = [], None
        for node, before, behind in self.states[state]:
            to = self.children.get(node << 8 | byte)
            if to is None:
                continue
            if to in self.inner:
                alive.append((to, before, behind))
            token = self.token_at.get(to)
            if last is None and token is not None and self.follows(before, token):
                last = token, behind + 1
        token, change = last
        to = (*[(node, before, behind - change) for node, before, behind in alive], (0, token, 0))
        if to not in self.known:
            self.known[to] = len(self.states)
            self.states.append(to)
        self.steps[state << 8 | byte] = step = self.known[to], change
        return step

    def run(self, data: bytes, state: int) -> tuple[int, int]:
        """(exit state, tokens) of ``data`` from a state."""
        total = 0
        steps = self.steps
        for byte in data:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self.compiled(state, byte)
            state = step[0]
            total += step[1]
        return state, total

    def count(self, piece: str) -> int:
        if len(self.states) > self.max_states:
            self.forget()
        data = piece.encode()
        if len(data) <= self.chunk:
            return self.run(data, 0)[1]
        return self.scan([data[k : k + self.chunk] for k in range(0, len(data), self.chunk)])

    def scan(self, chunks: list[bytes]) -> int:
        """Tokens of consecutive chunks, from the maps of all of them.

        What a state remembers lies a few tokens back, so a chunk is first run from the state
        that the last bytes before it lead to from the start. Neighbouring maps are
        composed pair by pair, in as many rounds as the number of chunks has bits. Where a
        map lacks the state that its left neighbour leads to, its chunks are run from that
        state too; the composition is exact whatever was guessed.
        """
        guesses = [0, *[self.run(c[-64:], 0)[0] for c in chunks[:-1]]]
        maps = [({g: self.run(c, g)}, (c,)) for c, g in zip(chunks, guesses, strict=True)]
        while len(maps) > 1:
            maps = [self.composed(*maps[k : k + 2]) for k in range(0, len(maps), 2)]
        return maps[0][0][0][1]

    def composed(self, left: tuple, right: tuple | None = None) -> tuple:
        if right is None:
            return left
        out = {}
        for entry, (middle, tokens) in left[0].items():
            if middle not in right[0]:
                state, more = middle, 0
                for chunk in right[1]:
                    state, n = self.run(chunk, state)
                    more += n
                right[0][middle] = state, more
            state, more = right[0][middle]
            out[entry] = state, tokens + more
        return out, left[1] + right[1]

    def count_all(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.counts.__getitem__, pieces), np.int64, len(pieces))


@lru_cache(maxsize=1)
def compiled_parts(path: str) -> tuple[Vocabulary, "Splitter", CountTransducer]:
    """What a worker compiles once and uses for all its tasks: no result depends on it."""
    vocabulary = Vocabulary(path)
    return vocabulary, Splitter(), CountTransducer(vocabulary)


def segments(text: str, special: list[str]) -> tuple[list[str], int]:
    """The text between special strings, and how many of those there are; the leftmost longest one counts."""
    parts, found = [text], 0
    for token in sorted(special, key=len, reverse=True):
        split = [p.split(token) for p in parts]
        found += sum(len(s) - 1 for s in split)
        parts = [x for s in split for x in s]
    return parts, found


def _counted(path: str, chars: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, splitter, transducer = compiled_parts(path)
        for batch in stream:
            texts = batch["text"].to_pylist()
            totals = np.zeros(len(texts), np.int64)
            parts: list[str] = []
            owners: list[int] = []
            held = 0
            for k, text in enumerate(texts):
                own, found = segments(text, vocabulary.special) if any(s in text for s in vocabulary.special) else ([text], 0)
                totals[k] += found
                parts += own
                owners += [k] * len(own)
                held += len(text)
                if held >= chars or k == len(texts) - 1:
                    pieces, counts = splitter.pieces(parts)
                    upto = np.concatenate([[0], np.cumsum(transducer.count_all(pieces))])
                    ends = np.cumsum(counts)
                    np.add.at(totals, owners, upto[ends] - upto[ends - counts])
                    parts, owners, held = [], [], 0
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(totals)], names=["doc", "n_tokens"])

    return batches


def count_tokens(docs: DataFrame, vocabulary_path: str, columns: list[str] | None = None, chars: int = 1 << 20) -> DataFrame:
    """``doc`` (the input row, or its ``columns``) with ``n_bytes`` and ``n_tokens`` of its whole text.

    The counts are those of the tokenizer in the file ``vocabulary_path`` (a byte-level
    BPE with the splitting rule of its kind), special strings in a text counting as one
    token each. Two transducers are compiled from it: one cuts texts into pieces, with
    chunks of the text as maps between its few states that a prefix scan composes; one
    counts the tokens of a piece byte by byte, long ones by chunks as well. No shuffle; a
    task holds ``chars`` characters of symbols at a time, and a worker a bounded part of the
    second transducer and of its answers, over all its tasks.

    Null and empty texts have no token. Rows keep their order and number.
    """
    documents = documents_of(docs)
    kept = documents.select(F.struct(*[F.col("doc")[c].alias(c) for c in columns or docs.columns]).alias("doc"), "text")
    kept = kept.select(F.struct("doc", F.octet_length("text").cast("long").alias("n_bytes")).alias("doc"), "text")
    counted = kept.mapInArrow(_counted(vocabulary_path, chars), f"doc {kept.schema['doc'].dataType.simpleString()}, n_tokens long")
    return counted.select("doc.doc", "doc.n_bytes", "n_tokens")
