"""Generalised LR repair of conversations: the cheapest edits that make their roles follow the grammar."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetpulse.llm.common import WHITE
from fleetpulse.session import settle

# The grammar (s?(ua)+)? as an automaton over role initials, and the weights of the edits.
# A pair of user and assistant is reduced as its assistant is shifted, so these are all tops a stack can have.
START, SYSTEM, USER, PAIR = range(4)
SHIFT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
ACCEPTING = (START, PAIR)
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FINE, SHORT, MUST_GO = range(3)

# (cost, edits) of going from one top to another
Moves = list[list[tuple[int, int, str]]]


def inserted(top: int) -> str:
    """The initial of the only turn that can be inserted on ``top``."""
    return "a" if top == USER else "u"


def _inserts() -> list[list[tuple[int, int, str]]]:
    """(top, cost, edits) reachable by inserts alone; two inserts lead to every top that inserts lead to."""
    out = []
    for top in range(4):
        reached, now, cost = {top: (0, "")}, top, 0
        for k in (1, 2):
            now, cost = SHIFT[now, inserted(now)], cost + INSERT
            reached.setdefault(now, (cost, "I" * k))
        out.append([(to, *how) for to, how in reached.items()])
    return out


INSERTS = _inserts()


def _least(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    best: dict[int, tuple[int, str]] = {}
    for to, cost, edits in found:
        if to not in best or (cost, edits) < best[to]:
            best[to] = cost, edits
    return [(to, *how) for to, how in best.items()]


def turn_moves(initial: str, fault: int) -> Moves:
    """What one turn does to each stack top: inserts before it, then the turn kept, reroled or deleted."""
    extra = TRUNCATED if fault == SHORT else 0
    out = []
    for top in range(4):
        found = []
        for now, cost, edits in INSERTS[top]:
            found.append((now, cost + DELETE, edits + "D"))
            if fault != MUST_GO:
                if (now, initial) in SHIFT:
                    found.append((SHIFT[now, initial], cost + extra, edits + "K"))
                found += [(SHIFT[now, r], cost + extra + REROLE, edits + "R") for r in ROLES if (now, r) in SHIFT]
        out.append(_least(found))
    return out


#: Moves by 3 * (place of the initial in INITIALS, or 3) + fault.
TURN_MOVES = [turn_moves(initial, fault) for initial in (*INITIALS, "") for fault in (FINE, SHORT, MUST_GO)]
#: (cost, edits) of the inserts that end a conversation at each top.
ENDINGS = [min((cost, edits) for to, cost, edits in INSERTS[top] if to in ACCEPTING) for top in range(4)]


class Frontier:
    """The tops of a graph-structured stack, each with its least (cost, audit).

    Tops that meet are merged. Audits that lead to one top at one cost are never
    prefixes of each other, since the edits fix all tops in between; so the lesser one stays
    the lesser one whatever follows. Every ``freeze`` steps the common length of all audits is
    set aside, shared between tops and known by its rank, so a step costs the same however
    long the conversation is.
    """

    def __init__(self, top: int, freeze: int = 256):
        self.tops = {top: (0, 0, "")}
        self.shared: list[tuple | None] = [None]
        self.freeze = self.left = freeze

    def advance(self, moves: Moves) -> None:
        merged: dict[int, tuple[int, int, str]] = {}
        for top, (cost, rank, tail) in self.tops.items():
            for to, more, edits in moves[top]:
                path = cost + more, rank, tail + edits
                if to not in merged or path < merged[to]:
                    merged[to] = path
        self.tops = merged
        self.left -= 1
        if not self.left:
            self.set_aside()

    def set_aside(self) -> None:
        size = min(len(tail) for _, _, tail in self.tops.values())
        parts = sorted({(rank, tail[:size]) for _, rank, tail in self.tops.values()})
        place = {part: k for k, part in enumerate(parts)}
        self.shared = [(self.shared[rank], text) for rank, text in parts]
        self.tops = {top: (cost, place[rank, tail[:size]], tail[size:]) for top, (cost, rank, tail) in self.tops.items()}
        self.left = self.freeze

    def _audit(self, rank: int, tail: str) -> str:
        parts, node = [tail], self.shared[rank]
        while node is not None:
            node, text = node
            parts.append(text)
        return "".join(reversed(parts))

    def paths(self) -> list[tuple[int, int, str]]:
        """(top, cost, audit) of every top."""
        return [(top, cost, self._audit(rank, tail)) for top, (cost, rank, tail) in self.tops.items()]

    def accepted(self) -> tuple[int, str]:
        """The least (cost, audit) that ends the conversation here."""
        ends = []
        for top, (cost, rank, tail) in self.tops.items():
            more, edits = ENDINGS[top]
            ends.append((cost + more, rank, tail + edits))
        cost, rank, tail = min(ends)
        return cost, self._audit(rank, tail)


class Stretch:
    """What is known of consecutive turns of one conversation: counts, ends, and paths from each top it may start on."""

    def __init__(self, entries: tuple[int, ...]):
        self.frontiers = {top: Frontier(top) for top in entries}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_initial = self.last_initial = None
        self.first_turn = self.last_turn = None
        self.last_key = None

    def add(self, turn: int | None, initial: str, key: tuple, later: bool, blank: bool, truncated: bool) -> None:
        duplicate = not blank and (later or key == self.last_key)
        truncated = truncated and not blank and not duplicate
        self.last_key = key
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last_initial is None:
            self.first_initial = initial
        else:
            self.illegal += self.last_initial + initial not in LEGAL
        self.last_initial = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        fault = MUST_GO if blank or duplicate else SHORT if truncated else FINE
        moves = TURN_MOVES[3 * (INITIALS.index(initial) if initial and initial in INITIALS else 3) + fault]
        for frontier in self.frontiers.values():
            frontier.advance(moves)

    def row(self) -> dict:
        paths = [{"top": a, "to": b, "cost": c, "audit": d} for a, f in self.frontiers.items() for b, c, d in f.paths()]
        names = ("blank", "duplicate", "truncated", "illegal", "turns", "first_initial", "last_initial", "first_turn", "last_turn")
        return {n: getattr(self, n) for n in names} | {"paths": paths}


_PATH = pa.struct([("top", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_STRETCH = pa.schema(
    [("part", pa.int32()), ("key", pa.string()), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "turns")]]
    + [("first_initial", pa.string()), ("last_initial", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64())]
    + [("paths", pa.list_(_PATH))]
)
_STRETCH_TYPE = (
    "part int, key string, blank long, duplicate long, truncated long, illegal long, turns long, first_initial string, "
    "last_initial string, first_turn long, last_turn long, paths array<struct<top int, to int, cost long, audit string>>"
)
_REPORT = [("key", pa.string()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())]


def _stretches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a sorted partition. Only the first one can have begun in an earlier partition."""
    part = key = None
    now: Stretch | None = None
    out: list[dict] = []
    for batch in stream:
        columns = [batch[n].to_pylist() for n in ("part", "key", "turn", "initial", "d1", "d2", "later", "blank", "truncated")]
        for part, own, turn, initial, d1, d2, later, blank, truncated in zip(*columns, strict=True):
            if now is None or own != key:
                if now is not None:
                    out.append({"part": part, "key": key, **now.row()})
                now = Stretch((START,) if now is not None else (START, SYSTEM, USER, PAIR))
                key = own
            now.add(turn, initial, (turn, d1, d2), later, blank, truncated)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=_STRETCH)
                out = []
    if now is not None:
        out.append({"part": part, "key": key, **now.row()})
        yield pa.RecordBatch.from_pylist(out, schema=_STRETCH)


def _joined(stretches: list[dict]) -> dict:
    """The report of a conversation from its stretches in order."""
    frontier = Frontier(START, freeze=1)
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    initial = turn = first = None
    for s in stretches:
        for n in total:
            total[n] += s[n]
        if initial is not None:
            total["illegal"] += initial + s["first_initial"] not in LEGAL
        initial = s["last_initial"]
        if s["first_turn"] is not None:
            total["turns"] -= turn is not None and turn == s["first_turn"]
            first = s["first_turn"] if first is None else first
            turn = s["last_turn"]
        moves: Moves = [[], [], [], []]
        for p in s["paths"]:
            moves[p["top"]].append((p["to"], p["cost"], p["audit"]))
        frontier.advance(moves)
    cost, audit = frontier.accepted()
    turns = total.pop("turns")
    return {**total, "gaps": 0 if turn is None else turn - first + 1 - turns, "cost": cost, "audit": audit}


def _reports(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for at in range(0, batch.num_rows, 1024):
            rows = batch.slice(at, 1024).to_pylist()
            yield pa.RecordBatch.from_pylist([{"key": r["key"], **_joined(r["stretches"])} for r in rows], schema=pa.schema(_REPORT))


class _Turns:
    """Walks along the audit of a conversation and yields the turns that stay."""

    def __init__(self, audit: str):
        self.audit, self.at, self.top = audit, 0, START

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield self._shifted(inserted(self.top)), ""
            self.at += 1

    def _shifted(self, initial: str) -> str:
        self.top = SHIFT[self.top, initial]
        return ROLES.get(initial, "")

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._shifted(role[0])
            yield role, text
        elif edit == "R":
            yield self._shifted(inserted(self.top)), text


def _walk(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, str]]]]:
    """(report, kept turns) step by step: a report, then the turns of its conversation, then its last inserts."""
    report = turns = None
    for batch in stream:
        columns = [batch[n] for n in ("audit", "role", "text")]
        for k in range(batch.num_rows):
            audit = columns[0][k].as_py()
            if audit is not None:
                if turns is not None:
                    yield report, turns.inserts()
                report, turns = (batch, k), _Turns(audit)
            else:
                yield report, turns.turn(columns[1][k].as_py(), columns[2][k].as_py())
    if turns is not None:
        yield report, turns.inserts()


def _digests(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flushed(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["key", "repaired_sha256"])

    now = digest = None
    empty = True
    rows: list[tuple[str, str]] = []
    for report, kept in _walk(stream):
        if report is not now:
            if now is not None:
                rows.append((now[0]["key"][now[1]].as_py(), digest.hexdigest()))
                if len(rows) >= 4096:
                    yield flushed(rows)
                    rows = []
            now, digest, empty = report, hashlib.sha256(), True
        for role, text in kept:
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
    if now is not None:
        rows.append((now[0]["key"][now[1]].as_py(), digest.hexdigest()))
    if rows:
        yield flushed(rows)


_KEPT = pa.schema([("key", pa.string()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _kept_turns(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, position = None, 0
    rows: list[tuple] = []
    for report, kept in _walk(stream):
        if report is not now:
            now, position = report, 0
        for role, text in kept:
            rows.append((now[0]["key"][now[1]].as_py(), position, role, text))
            position += 1
        if len(rows) >= 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KEPT.types, strict=True)], schema=_KEPT)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KEPT.types, strict=True)], schema=_KEPT)


def conversation_key(conv_id: Column) -> Column:
    """Text that stands for an id and is never null, so that a null id is a conversation of its own."""
    return F.coalesce(F.concat(F.lit("+"), conv_id.cast("string")), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with planted faults, picked by a checksum of id and turn.

    Of twenty equal shares one is dropped, one loses its text, one its end marks, one comes
    twice and one becomes a user's. Nulls count as one space; null turns stay null.
    """
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    spot = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(spot == 4, "user").otherwise(role).alias("role"),
        F.when(spot == 1, "").when(spot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(spot == 0, F.array().cast("array<int>")).when(spot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


ORDER = ["key", "at", "role", "d1", "d2"]


def _turns(conversations: DataFrame) -> DataFrame:
    """Rows with their key, their place ``at`` (null turns first), and two hashes that stand for (key, role, text)."""
    space = F.lit(" ")
    key, role, text = conversation_key(F.col("conv_id")), F.coalesce("role", space), F.coalesce("text", space)
    turn = F.col("turn").cast("long")
    return conversations.select(
        key.alias("key"),
        turn.alias("turn"),
        F.struct(turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn")).alias("at"),
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(key, role, text).alias("d1"),
        F.xxhash64(F.lit(7), key, role, text).alias("d2"),
    )


def _narrow(turns: DataFrame) -> DataFrame:
    """The turns without their text: faults that a turn shows by itself, and whether its role and text were seen at an earlier place."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    narrow = turns.select(
        "key", "turn", "at", "role", F.left("role", F.lit(1)).alias("initial"), "d1", "d2",
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    # keys of their own: a join on the grouping's keys would run in the grouping's tasks, where a hot one can't be split
    own = [F.bitwise_not(c).alias(f"j{c}") for c in ("d1", "d2")]
    first = narrow.groupBy("d1", "d2").agg(F.min("at").alias("first")).select(*own, "first")
    return narrow.withColumns({"jd1": F.bitwise_not("d1"), "jd2": F.bitwise_not("d2")}).join(first, ["jd1", "jd2"]).select(
        *narrow.columns, (F.col("at") > F.col("first")).alias("later")
    )


def reports(conversations: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation that has rows."""
    flagged = settle(_narrow(_turns(conversations)), "turns")
    ranged = flagged.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    stretches = ranged.select(
        F.spark_partition_id().alias("part"), "key", "turn", "initial", "d1", "d2", "later", "blank", "truncated"
    ).mapInArrow(_stretches, _STRETCH_TYPE)
    gathered = stretches.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("part", *[c for c in stretches.columns if c not in ("part", "key")]))).alias("stretches")
    )
    return gathered.mapInArrow(
        _reports, "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    )


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _all_reports(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    every = ids.select(conversation_key(F.col("conv_id")).alias("key"), "conv_id").groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS]
    return settle(every.join(reports(conversations), "key", "left").select("key", "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit")), "repairs")


def _with_turns(conversations: DataFrame, every: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order, in one partition."""
    heads = every.select("key", F.lit(False).alias("is_turn"), "audit")
    rows = _turns(conversations).select("key", F.lit(True).alias("is_turn"), "at", "role", "d1", "d2", "text")
    order = ["key", "is_turn", *ORDER[1:]]
    return heads.unionByName(rows, allowMissingColumns=True).repartition("key").sortWithinPartitions(*order).select("key", "audit", "role", "text")


def repair_conversations(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One report per conversation: faults, the cost of the cheapest repair, its audit and a digest of the repaired turns.

    Roles must follow ``(s?(ua)+)?`` by their initials. Edits are Keep, Rerole (2), Delete (3;
    blank turns and turns whose role and text were seen earlier must go) and Insert of an
    empty turn (2); a turn that ends without ``.!?`` and stays costs 1. Of the cheapest
    repairs the one whose audit, the initials of its edits, is least stays.

    Turns are ordered by turn, nulls first; turns with one number by role and a hash of
    their text. A null role or text counts as one space. Rows are dealt by ranges of
    (conversation, place), so a conversation with a third of all rows is parsed in as many
    tasks as it has ranges: each yields the least paths from any stack top to any other, and
    these are joined in order, one row per range. Only the digest reads a conversation's
    repaired turns one after the other in one task, since a SHA-256 has no parallel form;
    that task streams them and holds the audit, a letter per turn.

    ``ids`` (conv_id) may name conversations without any row, which get zeros, an empty
    audit and the digest of nothing; as do none by default. An empty table gives no row.
    """
    every = _all_reports(conversations, conversations if ids is None else ids)
    digests = _with_turns(conversations, every).mapInArrow(_digests, "key string, repaired_sha256 string")
    return every.join(digests, "key").select("conv_id", *COUNTS[:5], "cost", "audit", "repaired_sha256")


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """The turns after the repair: conv_id, ``position`` from 0, role and text."""
    every = _all_reports(conversations, conversations)
    kept = _with_turns(conversations, every).mapInArrow(_kept_turns, "key string, position long, role string, text string")
    return kept.join(every.select("key", "conv_id"), "key").select("conv_id", "position", "role", "text")
