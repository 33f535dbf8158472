"""Suffix-array dedup: bytes covered by a string of 100 bytes that also starts earlier.

A suffix of every byte would multiply the corpus, so suffixes are sorted from anchors only.
The anchor of a 100-byte string is its 32-byte part with the least hash: equal strings have
equal anchors at equal places. Neighbouring strings mostly share their anchor and form one
stretch. Equal stretches meet by hash; where stretches of one anchor differ, their suffixes
are sorted and compared byte by byte.
"""

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.common import documents_of
from fleetpulse.llm.shingles import mixed
from fleetpulse.session import settle

LENGTH, GRAM = 100, 32
NO_ID = -(2**63)
_SPAN = 1 << 22


class PrefixHashes:
    """Polynomial hashes of all substrings of ``data`` from prefix sums, modulo 2**64 over random byte values."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(101 + seed)
        values = rng.integers(0, 2**64, 256, dtype=np.uint64)
        base = int(rng.integers(0, 2**62, dtype=np.uint64)) * 4 + 3
        self.power, self.inverse = self.tables(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * self.power[: len(data)], out=self.sums[1:])

    @classmethod
    def tables(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        held = cls._powers.get(base)
        if held is None or len(held[0]) < n:
            size = max(1 << 16, 1 << (n - 1).bit_length())
            factors = (np.full(size, x, np.uint64) for x in (base % 2**64, pow(base, -1, 2**64)))
            held = tuple(np.concatenate([[np.uint64(1)], np.cumprod(f[1:])]) for f in factors)
            cls._powers[base] = held
        return held

    def of(self, start, end):
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.inverse[start]


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima inside blocks of that width."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def reach(length: int, gram: int) -> int:
    """How many bytes a string of ``length`` holds at least on one side of an anchor inside it."""
    return (length - gram + 1) // 2


def stretches(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(lo, cnt, at, g, s, sides) of each stretch: its strings start at lo, lo + 1, ...; the anchor starts at lo + at.

    ``g`` is the hash of the anchor, ``s`` of all bytes of the stretch with the anchor's place in
    it. ``sides`` holds 32 bits each of the hashes of the anchor with the ``half`` bytes before
    it and of the anchor with those after it, where the stretch has a string that reaches so far.
    """
    half = reach(length, gram)
    out = []
    for begin in range(0, len(data) - length + 1, _SPAN):
        part = data[begin : begin + _SPAN + length - 1]
        hashes = PrefixHashes(part)
        place = np.arange(len(part) - gram + 1)
        grams = mixed(hashes.of(place, place + gram))
        # the upper bits decide, the place breaks ties to the left
        packed = (grams & ~np.uint64(2 * _SPAN - 1)) | place.astype(np.uint64)
        anchor = (least_in_windows(packed, length - gram + 1) & np.uint64(2 * _SPAN - 1)).astype(np.int64)
        lo = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        cnt = np.diff(lo, append=len(anchor))
        at = anchor[lo] - lo
        s = mixed(hashes.of(lo, lo + cnt + length - 1) + mixed((cnt * 256 + at + 1).astype(np.uint64)))
        a = anchor[lo]
        left = mixed(hashes.of(np.maximum(a - half, 0), a + gram)) >> np.uint64(32) << np.uint64(32)
        right = mixed(hashes.of(a, np.minimum(a + gram + half, len(part))) + np.uint64(1)) >> np.uint64(32)
        out.append((lo + begin, cnt, at, grams[a], s, left | right))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


_ROW = [("id", pa.int64()), ("fp", pa.int64()), ("lo", pa.int64()), ("cnt", pa.int32())]
_FOUND = pa.schema([*_ROW, ("at", pa.int16()), ("g", pa.int64()), ("s", pa.int64()), ("sides", pa.int64()), ("sure", pa.bool_())])
_FOUND_DDL = "id long, fp long, lo long, cnt int, at short, g long, s long, sides long, sure boolean"


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _stretch_rows(length: int, gram: int):
    """All stretches of a batch; those that repeat in it are sure to start earlier too and are joined to runs."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            ids, fps = (batch[c].to_numpy(zero_copy_only=False) for c in ("id", "fp"))
            parts, last = [], None
            for k in np.lexsort((fps, ids)):
                text = np.frombuffer(batch["text"][int(k)].as_py().encode(), np.uint8)
                if (ids[k], fps[k]) == last or len(text) < length:
                    continue
                last = (ids[k], fps[k])
                found = stretches(text, length, gram)
                n = len(found[0])
                parts.append((np.full(n, ids[k]), np.full(n, fps[k]), *found))
            if not parts:
                continue
            row, fp, lo, cnt, at, g, s, sides = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(s, kind="stable")
            again = np.zeros(len(s), bool)
            again[order[1:]] = s[order[1:]] == s[order[:-1]]
            yield _batch(_FOUND, *(c[~again] for c in (row, fp, lo, cnt, at, g.view(np.int64), s.view(np.int64), sides.view(np.int64), again)))
            row, fp, lo, cnt, g = (c[again] for c in (row, fp, lo, cnt, g))
            if len(row):
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (fp[1:] != fp[:-1]) | (lo[1:] != lo[:-1] + cnt[:-1])
                first = np.flatnonzero(new)
                runs = np.add.reduceat(cnt, first)
                spread = mixed(g[first]).view(np.int64)
                none = np.zeros(len(first), np.int64)
                yield _batch(_FOUND, row[first], fp[first], lo[first], runs, none, spread, lo[first], none, np.ones(len(first), bool))

    return batches


_SORTED = pa.schema([*_ROW, ("at", pa.int16()), ("g", pa.int64()), ("sides", pa.int64()), ("head", pa.bool_())])
_SORTED_DDL = "id long, fp long, lo long, cnt int, at short, g long, sides long, head boolean"


def _heads(hot: list[int]):
    """Streams rows sorted by (g, s, id, fp, lo): repeats of a stretch, and first stretches whose anchor has others.

    The stretches of the anchors in ``hot`` lie in several tasks and count as having others.
    """
    common = np.array(sorted(hot), np.int64)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "fp", "lo", "cnt", "at", "g", "sides")
        last = None  # the latest row as (g, s, id, fp, lo)
        held = {c: np.empty(0, np.int64) for c in names}  # the latest first stretch, of which it is not yet known whether it has others
        before = False  # whether its anchor has others before it
        for batch in stream:
            columns = {c: batch[c].to_numpy(zero_copy_only=False) for c in batch.schema.names}
            sure = columns["sure"].astype(bool)
            if sure.any():
                yield _batch(_SORTED, *(columns[c][sure] for c in names), np.zeros(sure.sum(), bool))
            rows = {c: v[~sure] for c, v in columns.items()}
            n = len(rows["g"])
            if not n:
                continue
            keys = [np.concatenate([[x], rows[c]]) for c, x in zip(("g", "s", "id", "fp", "lo"), last or (0,) * 5, strict=True)]
            same = [k[1:] == k[:-1] for k in keys]
            if last is None:
                same = [np.concatenate([[False], x[1:]]) for x in same]
            head = ~(same[0] & same[1])
            repeat = ~head & ~(same[2] & same[3] & same[4])
            last = tuple(int(k[-1]) for k in keys)
            if repeat.any():
                yield _batch(_SORTED, *(rows[c][repeat] for c in names), np.zeros(repeat.sum(), bool))
            if not head.any():
                continue
            held = {c: np.concatenate([held[c], rows[c][head]]) for c in names}
            alike = held["g"][1:] == held["g"][:-1]
            others = (np.concatenate([[before], alike[:-1]]) | alike | np.isin(held["g"][:-1], common)) if len(alike) else alike
            if others.any():
                yield _batch(_SORTED, *(held[c][:-1][others] for c in names), np.ones(others.sum(), bool))
            before = bool(alike[-1]) if len(alike) else before
            held = {c: v[-1:] for c, v in held.items()}
        if len(held["g"]) and (before or np.isin(held["g"][0], common)):
            yield _batch(_SORTED, *(held[c] for c in names), [True])

    return batches


_CONTEXT = pa.schema([("key", pa.int64()), *_ROW, ("at", pa.int16()), ("large", pa.bool_()), ("ctx", pa.binary())])
_CONTEXT_DDL = "key long, id long, fp long, lo long, cnt int, at short, large boolean, ctx binary"


def _parted(heads: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, id, fp, lo, cnt, at): the strings of first stretches, told apart by the side on which they reach further.

    A string of ``length`` bytes holds at least ``half`` bytes before its anchor or after
    it; equal strings agree in which and in those bytes, so these join the anchor in the key.
    """
    half = reach(length, gram)
    anchor, end = F.col("lo") + F.col("at"), F.col("lo") + F.col("cnt")
    middle = F.least(F.greatest(anchor - (half - 1), F.col("lo")), end)

    def part(side: int, bits, lo, hi):
        key = F.xxhash64("g", F.lit(side), bits)
        return F.struct(key.alias("key"), lo.alias("lo"), (hi - lo).cast("int").alias("cnt"), (anchor - lo).cast("short").alias("at"))

    left = part(0, F.shiftrightunsigned("sides", 32), F.col("lo"), middle)
    right = part(1, F.col("sides").bitwiseAND(0xFFFFFFFF), middle, end)
    parts = heads.select("id", "fp", F.explode(F.filter(F.array(left, right), lambda p: p["cnt"] > 0)).alias("p"))
    return parts.select("p.key", "id", "fp", "p.lo", "p.cnt", "p.at")


def _contexts(length: int):
    """The bytes of the given parts of stretches."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out: list[tuple] = []
            held = 0
            for k in range(batch.num_rows):
                text = batch["text"][k].as_py().encode()
                row, fp = batch["id"][k].as_py(), batch["fp"][k].as_py()
                for p in batch["parts"][k].as_py():
                    lo, cnt = p["lo"], p["cnt"]
                    out.append((p["key"], row, fp, lo, cnt, p["at"], p["large"], text[lo : lo + cnt + length - 1]))
                    held += cnt + length
                if out and (held > 1 << 24 or k == batch.num_rows - 1):
                    yield _batch(_CONTEXT, *zip(*out, strict=True))
                    out, held = [], 0

    return batches


class Suffixes:
    """The suffixes, from their anchors, of the stretches of a task, sorted inside groups of equal keys."""

    def __init__(self, rows: list[tuple], length: int, seed: int = 0):
        self.rows, self.length = rows, length
        self.text = b"".join(r[-1] for r in rows)
        self.data = np.frombuffer(self.text, np.uint8)
        self.begin = np.cumsum([0, *(len(r[-1]) for r in rows)])
        self.at = np.array([r[5] for r in rows])
        self.anchor = self.begin[:-1] + self.at
        self.end = self.begin[1:]
        hashes = PrefixHashes(self.data, seed)
        self.hashes, self.sums, self.inverse = hashes, hashes.sums, hashes.inverse

    def common(self, i: int, j: int) -> int:
        """How many bytes two suffixes share, by binary search over prefix hashes; checked byte by byte."""
        a, b = int(self.anchor[i]), int(self.anchor[j])
        most = min(int(self.end[i]) - a, int(self.end[j]) - b)
        low, high = 0, most
        sums, inverse = self.sums, self.inverse
        with np.errstate(over="ignore"):
            while low < high:
                middle = (low + high + 1) // 2
                if (sums[a + middle] - sums[a]) * inverse[a] == (sums[b + middle] - sums[b]) * inverse[b]:
                    low = middle
                else:
                    high = middle - 1
        if self.text[a : a + low] != self.text[b : b + low]:
            low = next(k for k in range(low) if self.text[a + k] != self.text[b + k])
        return low

    def compare(self, i: int, j: int) -> int:
        n = self.common(i, j)
        a, b = int(self.anchor[i]) + n, int(self.anchor[j]) + n
        ends = a == self.end[i], b == self.end[j]
        if ends[0] or ends[1]:
            return int(ends[1]) - int(ends[0]) or i - j
        return int(self.text[a]) - int(self.text[b])

    def later(self) -> Iterator[tuple[int, int, int, int]]:
        """(id, fp, lo, cnt) of the strings that another stretch of their group has earlier."""
        n = len(self.rows)
        group = np.array([r[0] for r in self.rows])
        order: list[int] = []
        edges = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [n]])
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 1:
                order += sorted(range(a, b), key=functools.cmp_to_key(self.compare))
        if not order:
            return
        shared = np.array([0] + [self.common(i, j) if group[i] == group[j] else 0 for i, j in zip(order, order[1:], strict=False)])
        order = np.array(order)
        # rows come sorted by (key, id, fp, lo), so the place of a row is its turn
        at, anchor, cnt = self.at[order], self.anchor[order], np.array([r[4] for r in self.rows])[order]
        gone: dict[int, list[int]] = {}
        for before in range(int(at.max()) + 1):
            held = np.flatnonzero((before <= at) & (before > at - cnt))
            if len(held) < 2:
                continue
            run = np.cumsum(shared < self.length - before)[held]
            left = self.hashes.of(anchor[held] - before, anchor[held])
            by = np.lexsort((order[held], left, run))
            same = (run[by[1:]] == run[by[:-1]]) & (left[by[1:]] == left[by[:-1]])
            starts = anchor[held][by] - before
            same &= np.all([self.data[starts[1:] + k] == self.data[starts[:-1] + k] for k in range(before)], axis=0) if before else True
            for k in order[held][by[1:][same]]:
                gone.setdefault(int(k), []).append(int(self.at[k]) - before)
        for k, starts in gone.items():
            _, row, fp, lo, *_ = self.rows[k]
            places = np.sort(np.array(starts))
            first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
            for a, size in zip(places[first], np.diff(first, append=len(places)), strict=True):
                yield row, fp, lo + int(a), int(size)


def _sorted_suffixes(length: int, rows_at_once: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def found(rows):
            out = list(Suffixes(rows, length).later())
            if out:
                yield _batch(pa.schema(_ROW), *zip(*out, strict=True))

        last = None
        for batch in stream:
            for row in zip(*(batch[c].to_pylist() for c in _CONTEXT.names), strict=True):
                if row[:4] == last:
                    continue
                last = row[:4]
                if held and len(held) >= rows_at_once and row[0] != held[-1][0]:
                    yield from found(held)
                    held = []
                held.append(row)
        if held:
            yield from found(held)

    return batches


def _strings(length: int):
    """Each string of the stretches, as a row of its own."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            row, fp, lo, cnt = (batch[c].to_numpy(zero_copy_only=False) for c in ("id", "fp", "lo", "cnt"))
            texts = batch["ctx"].to_pylist()
            for a in range(0, len(texts), 1000):
                part = slice(a, a + 1000)
                n = cnt[part]
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                strings = [t[k : k + length] for t, c in zip(texts[part], n, strict=True) for k in range(c)]
                yield _batch(_STRING, *(np.repeat(c[part], n) for c in (row, fp)), np.repeat(lo[part], n) + place, strings)

    return batches


_STRING = pa.schema([*_ROW[:3], ("string", pa.binary())])


def _later_strings(stretches_of: DataFrame, length: int) -> DataFrame:
    """What ``Suffixes.later`` finds, string by string: none of it is held by one task.

    A string's least place is found map-side first; the join back has a key of its own, so
    a string with very many places can be split. Strings are compared by their bytes.
    """
    strings = stretches_of.mapInArrow(_strings(length), "id long, fp long, lo long, string binary")
    first = strings.groupBy("string").agg(F.min(F.struct("id", "fp", "lo")).alias("first"))
    first = first.select(F.xxhash64("string").alias("h"), F.col("string").alias("same"), "first")
    met = strings.withColumn("h", F.xxhash64("string")).join(first, "h").where("string = same")
    return met.where(F.struct("id", "fp", "lo") != F.col("first")).select("id", "fp", "lo", F.lit(1).alias("cnt"))


def _applied(length: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out: tuple[list, ...] = ([], [], [], [])
            for text, spans in zip(batch["text"], batch["spans"].to_pylist(), strict=True):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                change = np.zeros(len(data) + 1, np.int64)
                for s in spans or []:
                    change[s["lo"]] += 1
                    change[s["lo"] + s["cnt"] + length - 1] -= 1
                gone = np.cumsum(change)[:-1] > 0
                values = len(data), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()), data[~gone].tobytes()
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            extra = [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc"], *extra], names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    return batches


def _common_anchors(narrow: DataFrame, length: int, gram: int, share: int = 64, most: int = 1000) -> list[int]:
    """Anchors that hold over one in ``most`` of the stretches of every ``share``-th document, at most ``most`` of them.

    They decide how rows are dealt and nothing else.
    """
    sample = narrow.where(F.xxhash64(F.lit(5), "id") % share == 0).mapInArrow(_stretch_rows(length, gram), _FOUND_DDL).where("not sure")
    counts = settle(sample.groupBy("g").count(), "anchor-sample")
    least = (counts.agg(F.sum("count")).first()[0] or 0) / most
    return [r.g for r in counts.where(F.col("count") > max(share, least)).orderBy(F.desc("count"), "g").limit(most).collect()]


def dedup_bytes(docs: DataFrame, columns: list[str] | None = None, length: int = LENGTH, gram: int = GRAM, rows_at_once: int = 20_000, group_rows: int = 5_000) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts earlier.

    Earlier is a smaller doc_id (nulls first), or an earlier start in the same document;
    strings lie inside one document and are judged on the input. Returns ``doc`` (the input
    row, or its ``columns``), n_bytes, n_removed, n_spans and ``kept``, the remaining bytes.

    Shuffled are one row per stretch, some 3 for 100 bytes (a stretch that fills a third of
    the corpus sends one row per batch; an anchor that a sample of documents shows to be
    common is dealt by the hashes of its stretches, over all tasks), and
    the bytes of stretches whose anchor occurs in several contexts. The latter are sorted
    inside groups that agree in 66 bytes. A group of up to ``group_rows`` is held by one
    task; a larger one is exchanged for its strings, one row each, and is spread.

    Null texts count as empty; texts shorter than ``length`` stay whole. Rows that share
    doc_id and text are one document and get equal results; rows that share only the
    doc_id are ordered by a hash of their text. An empty table gives an empty table.
    """
    documents = documents_of(docs).withColumn("id", F.coalesce("id", F.lit(NO_ID)).cast("long"))
    narrow = documents.select("id", "fp", "text")
    found = narrow.mapInArrow(_stretch_rows(length, gram), _FOUND_DDL)
    hot = _common_anchors(narrow, length, gram)
    # an anchor's stretches meet in one task, those of a common one are dealt by their own hash
    dealt = found.repartition("g", F.when(F.col("g").isin(hot), F.col("s")).otherwise(0)) if hot else found.repartition("g")
    ordered = dealt.sortWithinPartitions("g", "s", "id", "fp", "lo")
    met = settle(ordered.mapInArrow(_heads(hot), _SORTED_DDL), "stretches")
    parts = _parted(met.where("head"), length, gram)
    # a key of its own: a join on the grouping's key would run in the grouping's tasks, where a large group can't be split
    sizes = parts.groupBy("key").count().where("count > 1").select(F.bitwise_not("key").alias("other"), (F.col("count") > group_rows).alias("large"))
    parts = settle(parts.withColumn("other", F.bitwise_not("key")).join(sizes, "other").drop("other"), "parts")
    several = not parts.where("large").isEmpty()
    places = parts.groupBy("id", "fp").agg(F.collect_list(F.struct("key", "lo", "cnt", "at", "large")).alias("parts"))
    contexts = narrow.join(places, ["id", "fp"]).mapInArrow(_contexts(length), _CONTEXT_DDL)
    if several:
        contexts = settle(contexts, "contexts")
    grouped = contexts.where("not large").repartition("key").sortWithinPartitions("key", "id", "fp", "lo")
    later = grouped.mapInArrow(_sorted_suffixes(length, rows_at_once), "id long, fp long, lo long, cnt int")
    if several:
        later = later.unionByName(_later_strings(contexts.where("large"), length))
    spans = met.where("not head").select("id", "fp", "lo", "cnt").unionByName(later).groupBy("id", "fp")
    spans = spans.agg(F.collect_list(F.struct("lo", "cnt")).alias("spans"))
    kept = documents.select(F.struct(*[F.col("doc")[c].alias(c) for c in columns or docs.columns]).alias("doc"), "id", "fp", "text")
    joined = kept.join(spans, ["id", "fp"], "left").select("doc", "text", "spans")
    schema = f"doc {joined.schema['doc'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(_applied(length), schema)
