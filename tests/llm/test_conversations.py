"""Conversation repair against brute force over edits, and against a plain pass over long rows."""

import hashlib
import random
import re
from itertools import groupby, product
from zlib import crc32

import pytest

from tillwork.llm import QUERIES, conversations

GOAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, gaps long, audit string"


def flags(rows):
    """(role, text, fault) of rows (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        if not bare:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest_by_hand(rows):
    """(cost, audit, lines) over all edits with up to two insertions before and after each row."""
    best = None
    inserts = [[("I", r)] for r in "ua"] + [[("I", "u"), ("I", "a")], [("I", "a"), ("I", "u")], []]
    choices = []
    for i, (role, text, fault) in enumerate(rows):
        edits = [[("D", None)]]
        if fault not in ("blank", "duplicate"):
            edits += [[("K", i)], [("R", "u", i)], [("R", "a", i)]]
        choices += [inserts, edits]
    for picked in product(*choices, inserts):
        edits = [e for part in picked for e in part]
        cost, initials, lines = 0, "", []
        for e in edits:
            if e[0] == "D":
                cost += 3
                continue
            cost += {"K": 0, "R": 2, "I": 2}[e[0]]
            if e[0] == "I":
                role, text = {"u": "user", "a": "assistant"}[e[1]], ""
            else:
                role, text, fault = rows[e[-1]]
                cost += fault == "truncated"
                if e[0] == "R":
                    role = {"u": "user", "a": "assistant"}[e[1]]
            initials += role[:1] or "-"
            lines.append(f"{role}:{text}")
        if GOAL.fullmatch(initials):
            best = min(best or (10**9,), (cost, "".join(e[0] for e in edits), "\n".join(lines)))
    return best


def cheapest_by_row(rows):
    """The same row by row, for any length."""
    states = {"": (0, "", ())}  # by last initial

    def insert(states):
        for _ in range(3):
            for last, (cost, audit, lines) in list(states.items()):
                new, role = ("a", "assistant") if last == "u" else ("u", "user")
                offer(states, new, (cost + 2, audit + "I", (*lines, f"{role}:")))

    def offer(states, key, found):
        states[key] = min(states.get(key, found), found)

    insert(states)
    for role, text, fault in rows:
        after = {}
        for last, (cost, audit, lines) in states.items():
            offer(after, last, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            paid = cost + (fault == "truncated")
            fits = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
            if role[:1] and role[0] in fits:
                offer(after, role[0], (paid, audit + "K", (*lines, f"{role}:{text}")))
            new, other = ("a", "assistant") if last == "u" else ("u", "user")
            offer(after, new, (paid + 2, audit + "R", (*lines, f"{other}:{text}")))
        insert(after)
        states = after
    cost, audit, lines = min(states[k] for k in ("", "a") if k in states)
    return cost, audit, "\n".join(lines)


def expected(rows, by=cheapest_by_row):
    """The result for one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = flags(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    roles = [r[1][:1] for r in rows]
    cost, audit, lines = by(found)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == kind for *_, f in found) for kind in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
        cost, audit, hashlib.sha256(lines.encode()).hexdigest(),
    )


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_conversation(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


def drawn(draw, n):
    texts = ["Yes.", "No", "", " \n", "Why?", "a\n", "é!", "Yes"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    return [(draw.choice([None, *range(n + 1)]) if draw.random() < 0.3 else i, draw.choice(roles), draw.choice(texts))
            for i in range(n)]


def test_cells_against_all_edits():
    draw = random.Random(1)
    parser = conversations.Parser()
    for _ in range(150):
        rows = flags([(t, r or " ", x) for t, r, x in drawn(draw, draw.randint(0, 3))])
        kinds = tuple((r[:1], f in ("blank", "duplicate"), f == "truncated", 1) for r, _, f in rows)
        _, (cost, audit) = conversations.best(parser.span(kinds))
        lines = "\n".join(conversations.rewrite([(r, t, 1) for r, t, _ in rows], audit))
        assert (cost, audit, lines) == cheapest_by_hand(rows) == cheapest_by_row(rows)


def test_every_split_of_a_span_gives_the_same_cell():
    draw = random.Random(2)
    leaves = [conversations.leaf(draw.choice("sua "), draw.random() < 0.2, draw.random() < 0.3, 1) for _ in range(9)]
    whole = conversations.levels(leaves)[-1][0]
    for k in range(1, 9):
        left, right = (conversations.levels(part)[-1][0] for part in (leaves[:k], leaves[k:]))
        assert conversations.product(left, right) == whole


@pytest.mark.parametrize("chunk_rows", [2, 256])
def test_repair_of_drawn_rows(spark, chunk_rows):
    draw = random.Random(chunk_rows)
    rows = [(conv, *r) for conv in range(40) for r in drawn(draw, draw.randint(1, 9))]
    rows += [(None, *r) for r in drawn(draw, 60)]  # a conversation of very many rows, for its chunks
    rows += [(99, i, draw.choice(["user", "assistant"]), f"Row {i}." if i % 7 else "x" * 50_000) for i in range(400)]
    rows += rows[:5]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = conversations.repair(frame, chunk_rows)
    have = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert have == {conv: expected(part) for conv, part in by_conversation(rows).items()}
    texts = [r for r in got.where("repaired is not null").collect()]
    assert all(hashlib.sha256(r["repaired"].encode()).hexdigest() == r["repaired_sha256"] for r in texts)


def test_conversations_without_rows_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, 3, "user", "a", 0), (2, None, None, None, 1)],
                                  "conv_id long, turn long, role string, text string, copies int")
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in conversations.repair(frame).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {1: (0, 0, 0, 0, 0, 0, "", nothing), 2: (0, 1, 0, 0, 0, 3, "D", nothing)}
    assert conversations.repair(frame.limit(0)).count() == 0


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def test_query_against_a_plain_pass(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_conversation_repair"](spark, small).collect()}
    left = by_conversation(damaged(rows))
    assert got == {conv: expected(left.get(conv, [])) for conv, _ in groupby(sorted(r[0] for r in rows))}
