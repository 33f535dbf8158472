"""Repair of conversations against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import conversation_repair as repair
from fleetpulse.llm.queries import QUERIES, table

BLANKS = " \t\n\x0b\x0c\r"


def by_hand(rows):
    """Damage of one conversation's rows (conv_id, turn, role, text), as the contract words it."""
    out = []
    for conv, turn, role, text in rows:
        role, text = role or (" " if role is None else ""), " " if text is None else text
        spot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if spot == 0:
            continue
        text = "" if spot == 1 else re.sub("[.!?]", "", text) if spot == 2 else text
        out += [(turn, "user" if spot == 4 else role, text)] * (2 if spot == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, found):
    """All edit strings by (cost, audit): a search over (place, roles so far as the grammar sees them)."""
    agenda = [(0, "", 0, "", ())]
    done = set()
    whole = re.compile(r"(s?(ua)+)?\Z")
    begun = re.compile(r"(s?(ua)*u?)?\Z")
    while agenda:
        cost, audit, at, roles, kept = heapq.heappop(agenda)
        if at == len(rows) and whole.match(roles):
            return cost, audit, kept
        # equal endings have equal futures; an earlier pop is the lesser one
        state = at, roles if len(roles) < 2 else roles[-1] + "+"
        if (state, audit) in done or sum(s == state for s, _ in done) > 40:
            continue
        done.add((state, audit))
        steps = [(cost + 2, audit + "I", at, roles + r[0], (*kept, f"{r}:")) for r in ("user", "assistant")]
        if at < len(rows):
            _, role, text = rows[at]
            steps.append((cost + 3, audit + "D", at + 1, roles, kept))
            if found[at] not in ("blank", "duplicate"):
                more = found[at] == "truncated"
                steps.append((cost + more, audit + "K", at + 1, roles + (role[:1] or "-"), (*kept, f"{role}:{text}")))
                steps += [(cost + 2 + more, audit + "R", at + 1, roles + r[0], (*kept, f"{r}:{text}")) for r in ("user", "assistant")]
        for s in steps:
            if begun.match(s[3]):
                heapq.heappush(agenda, s)
    raise AssertionError


def report(rows):
    found = faults(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit, kept = cheapest(rows, found)
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(tuple(r))
    return out


def test_query_equals_search(spark, small):
    rows = [tuple(r) for r in table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = {c: report(by_hand(sorted(own, key=lambda r: r[1]))) for c, own in grouped(rows).items()}
    assert got(QUERIES["op13_conversation_repair"](spark, small)) == want


@pytest.fixture(scope="module")
def odd():
    """Many faults, odd roles, nulls, no two different rows with one turn."""
    r = random.Random(5)
    rows = []
    for conv in [None, *range(120)]:
        turns = r.sample(range(12), r.randrange(1, 8))
        if r.random() < 0.2:
            turns[0] = None
        for t in turns:
            role = r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"])
            rows.append((conv, t, role, r.choice(["Yes.", "No!", "so", " \n", None, "", "Why? \n", "a.b", "é?"])))
    return rows


def test_odd_conversations(spark, odd):
    want = {c: report(by_hand(own)) for c, own in grouped(odd).items()}
    frame = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    clashing = frame.withColumns({c: F.lit(c) for c in ("key", "at", "part", "audit", "d1", "cost", "position")})
    for deal in (clashing.repartition(7), clashing.coalesce(1)):
        assert got(repair.repair_conversations(repair.damaged(deal), deal)) == want


def test_one_conversation_over_many_ranges(spark, small):
    """Stretches of one long conversation, cut anywhere, give what one pass gives."""
    r = random.Random(9)
    rows = [(k, r.choice(["user", "assistant", "system"]), r.choice([f"Turn {k}.", f"turn {k}", "", "Same."])) for k in range(3000)]
    rows += [(3000, "user", "Twice.")] * 3
    found = faults(rows)
    whole = repair.Stretch((repair.START,))
    for (turn, role, _), f in zip(rows, found, strict=True):
        whole.add(turn, role[0], (turn, id(f)), f == "duplicate", f == "blank", f == "truncated")
    frame = spark.createDataFrame([(1, *x) for x in rows] + [(2, 0, "user", "Hi."), (0, 5, "assistant", "Oh.")], "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        out = got(repair.repair_conversations(frame))
        kept = repair.repaired_turns(frame).where("conv_id = 1").orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[1][5:7] == whole.frontiers[0].accepted()
    assert out[1][1:4] == tuple(found.count(f) for f in ("blank", "duplicate", "truncated"))
    assert out[1][7] == hashlib.sha256("\n".join(f"{k.role}:{k.text}" for k in kept).encode()).hexdigest()
    assert re.fullmatch("(s?(ua)+)?", "".join(k.role[0] for k in kept))
    assert out[2][5:7] == (2, "KI") and out[0][5:7] == (2, "IK")


@pytest.mark.parametrize("seed", range(3))
def test_frozen_audits(seed):
    """Audits set aside often, rarely and by stretches are the same."""
    r = random.Random(seed)
    symbols = [r.randrange(12) for _ in range(200)]
    often, rarely, joined = repair.Frontier(0, freeze=1), repair.Frontier(0, freeze=10**9), repair.Frontier(0, freeze=2)
    for k in range(0, 200, 25):
        moves = []
        for top in range(4):
            part = repair.Frontier(top, freeze=7)
            for s in symbols[k : k + 25]:
                part.advance(repair.TURN_MOVES[s])
            moves.append(part.paths())
        joined.advance(moves)
        for s in symbols[k : k + 25]:
            often.advance(repair.TURN_MOVES[s])
            rarely.advance(repair.TURN_MOVES[s])
    assert often.accepted() == rarely.accepted() == joined.accepted()


def test_nothing_left_and_nothing_at_all(spark):
    rows = spark.createDataFrame([(7, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    none = got(repair.repair_conversations(rows.limit(0), rows))
    assert none == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert got(repair.repair_conversations(rows.limit(0))) == {}
    assert repair.repaired_turns(rows.limit(0)).count() == 0
