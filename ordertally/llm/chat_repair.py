"""Repair of damaged conversations by run-length dynamic programming.

Every row of a conversation is a symbol: its role initial and its fault.  A
symbol moves the automaton of ``(s?(ua)+)?`` (four states) at the costs of its
edits, which is a 4 x 4 min-plus matrix.  Equal consecutive symbols are one
run; a run is advanced by cached binary powers of its matrix.

The rows of all conversations are dealt by range of (conv_id, turn, role,
text), so a large conversation is spread over many tasks.  The rows of one
conversation in one range are a unit.  Units become matrices in parallel, and
the costs behind every unit follow from the few matrices of its conversation.
The audit and the digest are single strings over a whole conversation, so they
are written by one pass through its units, in order, that holds the symbols of
one unit and no text.  Rows equal in all columns are counted before any of
that, so a row repeated millions of times is one row and one run.

Defined cases: a null conv_id or turn is one space in the damage key and a
value of its own in grouping (turns: nulls first); a null role or text is one
space; rows of one turn are in order of role, then text; an empty role has no
initial and fits nowhere; role initials count, so ``system`` and ``s`` are
alike; an empty table gives no rows; further columns are ignored, and texts of
any length are whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import map_arrow, staged

INF = 1 << 60
# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# The turn that may be put in, or take another role, in each state, and the state after it.
NEXT = {EMPTY: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
KEEP = {("s", EMPTY): SYSTEM, ("u", EMPTY): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

# Symbols: must go, or 1 + 2 * (role initial) + (truncated).
MUST_GO = 0
INITIALS = "sua?"


def symbol(initial: str, truncated: bool) -> int:
    kind = INITIALS.index(initial) if initial in ("s", "u", "a") else 3
    return 1 + 2 * kind + truncated


def _edits(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that take up a row, in letter order."""
    out = [("D", DELETE_COST, state)]
    if sym != MUST_GO:
        initial, extra = INITIALS[(sym - 1) // 2], TRUNCATED_COST * ((sym - 1) % 2)
        kept = KEEP.get((initial, state))
        if kept is not None:
            out.append(("K", extra, kept))
        out.append(("R", REROLE_COST + extra, NEXT[state][1]))
    return out


Matrix = tuple[tuple[int, ...], ...]
IDENTITY: Matrix = tuple(tuple(0 if i == j else INF for j in STATES) for i in STATES)


@lru_cache(maxsize=None)
def transition(sym: int) -> Matrix:
    """Cheapest cost from state to state over one row, with the turns put in before it."""
    rows = []
    for start in STATES:
        best, state, cost = [INF] * 4, start, 0
        for _ in range(3):  # two put in turns at most are of use
            for _, c, to in _edits(sym, state):
                best[to] = min(best[to], cost + c)
            state, cost = NEXT[state][1], cost + INSERT_COST
        rows.append(tuple(best))
    return tuple(rows)


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(x + b[k][j] for k, x in enumerate(row)), INF) for j in STATES) for row in a)


@lru_cache(maxsize=None)
def power(sym: int, k: int) -> Matrix:
    """The transition over 2 ** k equal rows."""
    if k == 0:
        return transition(sym)
    half = power(sym, k - 1)
    return product(half, half)


def advance(m: Matrix, sym: int, n: int) -> Matrix:
    """``m`` and then a run of ``n`` equal rows."""
    k = 0
    while n:
        if n & 1:
            m = product(m, power(sym, k))
        n, k = n >> 1, k + 1
    return m


# Cost to end in each state, turns put in at the end included.
END = (0, 2 * INSERT_COST, INSERT_COST, 0)


def behind(m: Matrix, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a unit from those after it."""
    return tuple(min(min(x + y for x, y in zip(row, after)), INF) for row in m)


@lru_cache(maxsize=1 << 16)
def _back(sym: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """(costs before a row less the least of them, that least)."""
    before = behind(transition(sym), after)
    low = min(before)
    return tuple(x - low for x in before), low


@lru_cache(maxsize=1 << 16)
def _choice(sym: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The least letters of a cheapest way over a row, and the state behind it."""
    letters = ""
    while True:
        best = behind(transition(sym), after)[state]
        for letter, cost, to in sorted(_edits(sym, state) + [("I", INSERT_COST, NEXT[state][1])]):
            rest = behind(transition(sym), after)[to] if letter == "I" else after[to]
            if cost + rest == best:
                letters, state = letters + letter, to
                if letter != "I":
                    return letters, state
                break


def unroll(runs: list[tuple[int, int]], after: tuple[int, ...], state: int) -> Iterator[tuple[str, int]]:
    """(letters, state before the row) of every row of ``runs``, given the costs behind the last one."""
    low = min(after)
    here = tuple(x - low for x in after)
    costs: list[tuple[int, ...]] = []  # behind each row, last row first; only the differences matter
    for sym, n in reversed(runs):
        for _ in range(n):
            costs.append(here)
            here, _ = _back(sym, here)
    for sym, n in runs:
        for _ in range(n):
            letters, to = _choice(sym, costs.pop(), state)
            yield letters, state
            state = to


def _squeezed(symbols: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of equal consecutive symbols."""
    out: list[tuple[int, int]] = []
    for sym, n in symbols:
        if out and out[-1][0] == sym:
            out[-1] = (sym, out[-1][1] + n)
        elif n:
            out.append((sym, n))
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows after damage, equal ones counted."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id",
        "turn",
        shown("role").alias("role"),
        shown("text").alias("text"),
        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("k"),
    )
    k = F.col("k")
    text = F.when(k == 1, "").when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter(k != 0).select(
        "conv_id",
        "turn",
        F.when(k == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(k == 3, 2).otherwise(1).cast("long").alias("n"),
    )
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``part``, the range they lie in, and ``pos``, their place in the order of all rows."""
    keys = ["conv_id", "turn", "role", "text"]  # ascending, nulls first
    # A text's beginning orders it as far as the ranges need; whole texts would be sampled to the driver.
    spread = rows.repartitionByRange(*keys[:3], F.substring("text", 1, 32)).sortWithinPartitions(*keys)
    return spread.select(*keys, "n", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"))


_INK = r"[^\x20\x09-\x0D]"


def with_symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, part, pos, n, initial, fault of the first copy; any further copy is its fault again or a duplicate)."""
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    blank = ~F.col("text").rlike(_INK)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    narrow = rows.select(
        "conv_id", "turn", "part", "pos", "n", F.substring("role", 1, 1).alias("initial"),
        blank.alias("blank"), cut.alias("cut"), said.alias("said"),
    )
    # The place of a text's first row is unique, so this join knows no hot keys.
    first = narrow.groupBy("conv_id", "said").agg(F.min("pos").alias("first")).select("first")
    joined = narrow.drop("said").join(first, F.col("pos") == F.col("first"), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return joined.select("conv_id", "turn", "part", "pos", "n", "initial", F.coalesce(fault, F.lit("none")).alias("fault"))


def _row_runs(initial: str, fault: str, n: int) -> list[tuple[int, int]]:
    if fault in ("blank", "duplicate"):
        return [(MUST_GO, n)]
    return [(symbol(initial, fault == "truncated"), 1), (MUST_GO, n - 1)]


_LEGAL = {"su", "ua", "au"}


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matrix and ends of every unit; rows come in order of part and place."""
    here, state = None, None
    done: list[tuple] = []
    schema = pa.schema([("part", pa.int64()), ("start", pa.int64()), ("matrix", pa.list_(pa.int64())),
                        ("head", pa.string()), ("tail", pa.string()), ("illegal", pa.int64())])

    def close() -> None:
        if state is not None:
            m = state["m"]
            if state["run"]:
                m = advance(m, *state["run"])
            done.append((here[0], state["start"], [x for row in m for x in row], state["head"], state["tail"], state["illegal"]))

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[]] * len(schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        done.clear()
        return batch

    for b in batches:
        for part, conv, pos, n, initial, fault in zip(*[b.column(i).to_pylist() for i in range(6)]):
            if state is None or here != (part, conv):
                close()
                here = (part, conv)
                state = {"m": IDENTITY, "run": None, "start": pos, "head": initial, "tail": None, "illegal": 0}
            for sym, copies in _row_runs(initial, fault, n):
                if not copies:
                    continue
                if state["run"] and state["run"][0] == sym:
                    state["run"] = (sym, state["run"][1] + copies)
                else:
                    if state["run"]:
                        state["m"] = advance(state["m"], *state["run"])
                    state["run"] = (sym, copies)
            if state["tail"] is not None and state["tail"] + initial not in _LEGAL:
                state["illegal"] += 1
            state["illegal"] += n - 1  # a copy beside its like is never legal
            state["tail"] = initial
        if len(done) >= 1000:
            yield out()
    close()
    yield out()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its cost and illegal pairs, and per unit the costs behind it."""
    for b in batches:
        costs, illegal, after = [], [], []
        for units in b.column(1).to_pylist():
            behind_it, rest = [], END
            for u in reversed(units):
                behind_it.append((u["start"], list(rest)))
                m = u["matrix"]
                rest = behind(tuple(tuple(m[4 * i : 4 * i + 4]) for i in STATES), rest)
            costs.append(rest[EMPTY])
            pairs = sum((x["tail"] + y["head"]) not in _LEGAL for x, y in zip(units, units[1:]))
            illegal.append(sum(u["illegal"] for u in units) + pairs)
            after.append([{"start": s, "after": a} for s, a in behind_it])
        unit = pa.struct([("start", pa.int64()), ("after", pa.list_(pa.int64()))])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(costs, pa.int64()), pa.array(illegal, pa.int64()), pa.array(after, pa.list_(unit))],
            ["conv_id", "cost", "illegal", "units"],
        )


class _Repair:
    """One conversation's audit and digest, from its units in order."""

    def __init__(self) -> None:
        self.audit: list[str] = []
        self.digest, self.lines, self.state = hashlib.sha256(), 0, EMPTY
        self.runs: list[tuple[int, int]] = []
        self.after: tuple[int, ...] = END
        self.plan: Iterator[tuple[str, int]] | None = None

    def unit(self, after: list[int]) -> None:
        self.after, self.runs, self.plan = tuple(after), [], None

    def symbols(self, runs: list[tuple[int, int]]) -> None:
        self.runs.extend(runs)

    def say(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def apply(self, letters: str, role: str, text: str) -> None:
        self.audit.append(letters)
        for letter in letters:
            given, to = NEXT[self.state]
            if letter == "I":
                self.say(given, "")
            elif letter == "R":
                self.say(given, text)
            elif letter == "K":
                self.say(role, text)
                to = KEEP[(role[:1], self.state)]
            if letter != "D":
                self.state = to

    def row(self, role: str, text: str, n: int) -> None:
        if self.plan is None:
            self.plan = unroll(_squeezed(iter(self.runs)), self.after, self.state)
        for _ in range(n):
            self.apply(next(self.plan)[0], role, text)

    def end(self) -> tuple[str, str]:
        while self.state in (SYSTEM, USER):
            self.apply("I", "", "")
        return "".join(self.audit), self.digest.hexdigest()


UNIT, SYMBOL, TEXT = 0, 1, 2


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, audit, repaired_sha256); rows come by conversation, unit, kind and place."""
    here, at, open_ = None, None, False

    def out(conv, repair, kind) -> pa.RecordBatch:
        audit, digest = repair.end()
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([audit], pa.string()), pa.array([digest], pa.string())],
            ["conv_id", "audit", "repaired_sha256"],
        )

    for b in batches:
        kind_of_id = b.schema.field(0).type
        columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for conv, _, kind, _, n, initial, fault, role, text, after in zip(*columns):
            if not open_ or conv != at:
                if open_:
                    yield out(at, here, kind_of_id)
                here, at, open_ = _Repair(), conv, True
            if kind == UNIT:
                here.unit(after)
            elif kind == SYMBOL:
                here.symbols(_row_runs(initial, fault, n))
            else:
                here.row(role, text, n)
    if open_:
        yield out(at, here, kind_of_id)


def _id_ddl(df: DataFrame) -> str:
    return f"conv_id {df.schema['conv_id'].dataType.simpleString()}"


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id."""
    spark = conversations.sparkSession
    conversations = conversations.select("conv_id", "turn", "role", "text")
    conv = _id_ddl(conversations)
    rows = staged(spark, ordered(damaged(conversations)), "repair-rows")
    marks = staged(spark, with_symbols(rows), "repair-symbols")

    units = map_arrow(
        marks.select("part", "conv_id", "pos", "n", "initial", "fault").repartition("part").sortWithinPartitions("part", "pos"),
        _units,
        "part long, start long, matrix array<long>, head string, tail string, illegal long",
    )
    # A unit's first place names its conversation.
    owners = marks.groupBy("part", "conv_id").agg(F.min("pos").alias("start")).select("conv_id", "start")
    units = units.join(owners, "start").select("conv_id", F.struct("start", "matrix", "head", "tail", "illegal").alias("unit"))
    # At most one unit for each range of the order.
    whole = units.groupBy("conv_id").agg(F.sort_array(F.collect_list("unit")).alias("units"))
    folded = map_arrow(whole, _fold, f"{conv}, cost long, illegal long, units array<struct<start:long,after:array<long>>>")
    folded = staged(spark, folded, "repair-units")

    stream = _streamed(rows, marks, folded)
    texts = map_arrow(stream, _repaired, f"{conv}, audit string, repaired_sha256 string")

    turns = marks.groupBy("conv_id", "turn").agg(
        *[F.sum(F.when(F.col("fault") == f, F.lit(1)).otherwise(0) * _times(f)).alias(f) for f in ("blank", "truncated")],
        F.sum(F.when(F.col("fault") == "duplicate", F.col("n")).when(F.col("fault") == "blank", 0).otherwise(F.col("n") - 1)).alias("duplicate"),
    )
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    every = conversations.select("conv_id").distinct()
    narrow = [counts, folded.select("conv_id", "illegal", "cost"), texts]
    out = every
    for side in narrow:
        side = side.withColumnRenamed("conv_id", "_id")
        out = out.join(side, out["conv_id"].eqNullSafe(side["_id"]), "left").drop("_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def _times(fault: str):
    """Rows that a counted row stands for: every copy of a blank one is blank, one copy is truncated."""
    return F.col("n") if fault == "blank" else F.lit(1)


def _streamed(rows: DataFrame, marks: DataFrame, folded: DataFrame) -> DataFrame:
    """Units, symbols and texts of every conversation in the order in which they are needed."""
    none, no_costs = F.lit(None).cast("string"), F.lit(None).cast("array<long>")
    heads = folded.select("conv_id", F.explode("units").alias("u")).select(
        "conv_id", F.shiftright("u.start", 33).cast("int").alias("part"), F.lit(UNIT).alias("kind"), F.col("u.start").alias("pos"),
        F.lit(0).cast("long").alias("n"), none.alias("initial"), none.alias("fault"), none.alias("role"), none.alias("text"),
        F.col("u.after").alias("after"),
    )
    symbols = marks.select(
        "conv_id", "part", F.lit(SYMBOL).alias("kind"), "pos", "n", "initial", "fault",
        none.alias("role"), none.alias("text"), no_costs.alias("after"),
    )
    texts = rows.select(
        "conv_id", "part", F.lit(TEXT).alias("kind"), "pos", "n", none.alias("initial"), none.alias("fault"),
        "role", "text", no_costs.alias("after"),
    )
    every = heads.unionByName(symbols).unionByName(texts)
    return every.repartition("conv_id").sortWithinPartitions("conv_id", "part", "kind", "pos")


def op13(conversations: DataFrame) -> DataFrame:
    return repair(conversations)
