"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from ordertally.llm import chat_repair

CONVERSATIONS = "conv_id long, turn long, role string, text string"
LETTER_COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        elif k == 2:
            text = re.sub("[.!?]", "", text)
        elif k == 4:
            role = "user"
        out += [] if k == 0 else [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Least (cost, audit) with its lines, over all edit sequences: states are the initials' pattern so far."""
    step = lambda state, c: {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, c))
    front = {"": (0, "", ())}  # rows taken so far -> state -> cheapest

    def better(to, state, option):
        if state is not None and (state not in to or option[:2] < to[state][:2]):
            to[state] = option

    def with_inserts(front):
        front = dict(front)
        for _ in range(4):
            for state, (cost, audit, lines) in list(front.items()):
                for name in ("user", "assistant"):
                    better(front, step(state, name[0]), (cost + 2, audit + "I", lines + ((name, ""),)))
        return front

    # Ways of equal length of rows may differ by put in turns, so both forms are kept until a row is taken.
    for (_, _, role, text), mark in zip(rows, marks):
        to = {}
        for state, (cost, audit, lines) in expand(front, with_inserts, step):
            better(to, state, (cost + 3, audit + "D", lines))
            if mark in ("blank", "duplicate"):
                continue
            more = 1 if mark == "truncated" else 0
            better(to, step(state, role[:1]), (cost + more, audit + "K", lines + ((role, text),)))
            for name in ("user", "assistant"):
                better(to, step(state, name[0]), (cost + 2 + more, audit + "R", lines + ((name, text),)))
        front = to
    ends = [o for state, o in expand(front, with_inserts, step) if state in ("", "a")]
    return min(ends, key=lambda o: o[:2])


def expand(front, with_inserts, step):
    """Every way with up to three put in turns, without choosing between them."""
    ways = [(s, o) for s, o in front.items()]
    layer = ways
    for _ in range(3):
        nxt = []
        for state, (cost, audit, lines) in layer:
            for name in ("user", "assistant"):
                to = step(state, name[0])
                if to is not None:
                    nxt.append((to, (cost + 2, audit + "I", lines + ((name, ""),))))
        ways = ways + nxt
        layer = nxt
    return ways


def brute(rows):
    out = {}
    null_first = lambda x: (x is not None, x if x is not None else 0)
    for conv in {r[0] for r in rows}:
        mine = damage([r for r in rows if r[0] == conv])
        mine.sort(key=lambda r: (null_first(r[1]), r[2].encode(), r[3].encode()))
        marks = faults(mine)
        cost, audit, lines = cheapest(mine, marks)
        turns = {r[1] for r in mine if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        said = "\n".join(f"{r}:{t}" for r, t in lines)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[marks.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256(said.encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def check(spark, rows):
    df = spark.createDataFrame(rows, CONVERSATIONS) if rows else spark.createDataFrame([], CONVERSATIONS)
    have, want = got(chat_repair.op13(df)), brute(rows)
    assert have.keys() == want.keys()
    for conv in want:
        assert have[conv] == want[conv], (conv, [r for r in rows if r[0] == conv], have[conv], want[conv])


def test_random_conversations(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "s"]
    texts = ["Yes.", "No!", "so", "", None, " \t", "Well.\n ", "why?", "é.", "end. "]
    rows = []
    for conv in [None, *range(160)]:
        for _ in range(rng.randint(0, 14)):
            turn = None if rng.random() < 0.08 else rng.randint(0, 9)
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{rng.random()}."))
    rows += rng.sample(rows, 60)
    check(spark, rows)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_empty_extra_columns_and_long_texts(spark):
    check(spark, [])
    rows = [(5, t, "user" if t % 2 == 0 else "assistant", "word " * 200_000 + f"{t}.") for t in range(4)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], CONVERSATIONS + ", n long, part long, audit long")
    assert got(chat_repair.op13(df)) == brute(rows)


@pytest.mark.parametrize("n_ranges", ["8", "40"])
def test_large_conversation_over_many_ranges(spark, n_ranges):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "user", "system"]), rng.choice(["same.", f"turn {t}", f"turn {t}."])) for t in range(3000)]
    rows += [(c, 0, "user", "Hi.") for c in range(100, 400)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", n_ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_runs_by_binary_powers():
    for sym in range(9):
        for n in (1, 2, 3, 7, 100):
            one = chat_repair.IDENTITY
            for _ in range(n):
                one = chat_repair.product(one, chat_repair.transition(sym))
            assert chat_repair.advance(chat_repair.IDENTITY, sym, n) == one
