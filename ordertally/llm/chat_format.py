"""Conversations as budgeted training windows with a loss mask.

A conversation's turns are rendered by a template and cut into windows of
about ``BUDGET`` tokens.  Prefix sums of the turns' tokens choose the cuts,
always between turns.  A later window repeats the system turn and a limited
history before its own turns.  The loss mask covers the assistant texts of a
window's own turns; what is repeated, as every other role, is masked out, so
each assistant text is a target exactly once.

Control strings in roles and texts are escaped by one more ``~`` after their
first character, which undoes itself on reading whatever the text holds.

Everything runs as DataFrame expressions.  A conversation is one row, since
its digest runs over all its turns.

Defined cases: null texts and roles are empty; turns are ordered by turn
number (nulls first), then role, then text, and repeated rows are turns of
their own; rows with a null conv_id form one conversation; a turn larger than
the budget is a window of its own, uncut; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET = 512  # tokens of a window, its repeated turns included
HISTORY_TOKENS = 128  # most tokens of repeated history
HISTORY_TURNS = 8  # most turns of repeated history
TURN_OVERHEAD = 4  # tokens of the template around a turn
SYSTEM, TARGET = "system", "assistant"

# The template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# What may not stand in a text as it is: the template's own marks and those
# that common chat templates use.
_CONTROL = r"([<\[])(~*)(\||/?s>|/?INST\]|</?SYS>|/?SYS>)"
_ESCAPED = r"([<\[])~(~*)(\||/?s>|/?INST\]|</?SYS>|/?SYS>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, "$1~$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def token_count(text: Column) -> Column:
    """Tokens of a text: words, and signs one by one."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"))


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is evaluated once."""
    return F.transform(F.array(value), fn)[0]


def _starts(ends: Column, room: Column) -> Column:
    """First turns of the windows, given the running token sums at the turns' ends."""
    zero = F.struct(F.array(F.lit(0)).alias("starts"), F.lit(0).cast("long").alias("base"), F.lit(0).alias("i"), F.lit(0).cast("long").alias("before"))

    def step(a: Column, end: Column) -> Column:
        full = (end - a["base"] > room) & (a["i"] > F.element_at(a["starts"], -1))
        return F.struct(
            F.when(full, F.concat(a["starts"], F.array(a["i"]))).otherwise(a["starts"]).alias("starts"),
            F.when(full, a["before"]).otherwise(a["base"]).alias("base"),
            (a["i"] + 1).alias("i"),
            end.alias("before"),
        )

    return F.aggregate(ends, zero, step, lambda a: a["starts"])


def _spans(turns: Column, repeated: Column) -> Column:
    """Loss spans (start, end; code points of the window) of the own assistant texts."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), none.alias("spans"))

    def step(a: Column, t: Column) -> Column:
        start = a["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        own = (a["i"] >= repeated) & (t["role"] == TARGET)
        return F.struct(
            (end + len(END)).alias("at"),
            (a["i"] + 1).alias("i"),
            F.when(own, F.concat(a["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(a["spans"]).alias("spans"),
        )

    return F.aggregate(turns, zero, step, lambda a: a["spans"])


def chat_windows(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(conv_id, window_id, n_repeated, formatted, loss_spans, n_tokens), a row per window.

    One shuffle, on conv_id.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            "text",
            F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT)).alias("head"),
            escaped(F.col("text")).alias("body"),
            (token_count(F.col("text")) + TURN_OVERHEAD).cast("long").alias("n"),
        ).alias("t"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    running = F.aggregate(
        F.transform("turns", lambda t: t["n"]),
        F.array(F.lit(0).cast("long")),
        lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)),
    )
    # sums[i]: tokens before turn i.
    convs = convs.withColumn("sums", running).withColumn("n_system", (F.get("turns", F.lit(0))["role"] == SYSTEM).cast("int"))
    system_tokens = F.when(F.col("n_system") == 1, F.get("sums", F.lit(1))).otherwise(F.lit(0).cast("long"))
    room = F.greatest(F.lit(1).cast("long"), F.lit(budget - HISTORY_TOKENS).cast("long") - system_tokens)
    convs = convs.withColumn("starts", _starts(F.slice("sums", F.lit(2), F.size("turns")), room))
    windows = convs.select("conv_id", "turns", "sums", "n_system", "starts", F.posexplode("starts").alias("window_id", "own"))
    after = F.coalesce(F.get("starts", F.col("window_id") + 1), F.size("turns"))
    oldest = F.greatest(F.col("n_system"), F.col("own") - HISTORY_TURNS)
    recent = F.filter(
        F.slice("sums", oldest + 1, F.greatest(F.lit(0), F.col("own") - oldest)),
        lambda before: F.get("sums", F.col("own")) - before <= HISTORY_TOKENS,
    )
    n_history = F.when(F.col("window_id") > 0, F.size(recent)).otherwise(0)
    system = F.when(F.col("window_id") > 0, F.slice("turns", F.lit(1), F.col("n_system"))).otherwise(F.slice("turns", F.lit(1), F.lit(0)))
    windows = windows.withColumns({"after": after, "n_history": n_history, "system_part": system})
    windows = windows.select(
        "conv_id",
        "window_id",
        (F.size("system_part") + F.col("n_history")).alias("n_repeated"),
        F.concat(
            "system_part",
            F.slice("turns", F.col("own") - F.col("n_history") + 1, F.col("after") - F.col("own") + F.col("n_history")),
        ).alias("turns"),
    )
    return windows.select(
        "conv_id",
        "window_id",
        "n_repeated",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        _spans(F.col("turns"), F.col("n_repeated")).alias("loss_spans"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["n"]).alias("n_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """(role, text) structs read back from a window."""
    parts = F.slice(F.split(formatted, TURN.replace("|", r"\|")), 2, 1 << 30)
    fields = F.transform(parts, lambda p: F.split(p, TEXT.replace("|", r"\|")))
    return F.transform(
        fields,
        lambda f: F.struct(
            unescaped(f[0]).alias("role"), unescaped(F.substr(f[1], F.lit(1), F.length(f[1]) - len(END))).alias("text")
        ),
    )


def read_conversations(windows: DataFrame) -> DataFrame:
    """Conversations read back from windows: turns without repetition, and all text under the loss mask."""
    own = windows.select(
        "conv_id",
        "window_id",
        "formatted",
        "loss_spans",
        F.slice(read_turns(F.col("formatted")), F.col("n_repeated") + 1, F.lit(1 << 30)).alias("turns"),
    )
    own = own.select(
        "conv_id",
        F.struct(
            "window_id",
            F.size("turns").alias("n"),
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join(
                F.transform(
                    "loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
                ),
                "",
            ).alias("loss"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    whole = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    total = lambda name: F.aggregate("ws", F.lit(0).cast("long"), lambda a, w: a + w[name])
    joined = lambda name: F.array_join(F.transform("ws", lambda w: w[name]), "")
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        joined("turns").alias("turns"),
        joined("loss").alias("loss"),
        total("chars").alias("formatted_chars"),
    )


def op7(conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    source = conversations.select("conv_id", "turn", "role", "text")
    extra = source.sparkSession.range(2).select(
        F.lit(-1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"),
        F.lit(said).alias("text"),
    )
    extra = extra.select(*[F.col(f.name).cast(f.dataType) for f in source.schema.fields])
    read = read_conversations(chat_windows(source.unionByName(extra)))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
