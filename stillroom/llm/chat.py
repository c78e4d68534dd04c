"""Conversations formatted as training windows within a token budget.

Prefix sums of turn tokens cut a conversation into spans of whole turns. Each window holds the system turn, as much of
the turns before its span as two limits allow, and the span itself. Only assistant texts of the span are targets: what is
repeated from earlier windows is masked, so that each assistant text is a target once. A turn over the budget is a
window by itself, without history.

Roles and texts stand between marks. Control strings inside them, those of this template and of common others, get a
backslash after their first character; one that has backslashes there gets one more, so that removing one restores any
text.

Defined results: turns are ordered by turn (null first), then role, then text, and repeated rows are turns of their own;
null roles and texts are empty; rows without conv_id are one conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
CONTROLS = (ROLE, TEXT, END, "<|system|>", "<|user|>", "<|assistant|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
SYSTEM, ASSISTANT = "system", "assistant"
#: Tokens that a turn's marks and role stand for.
TURN_TOKENS = 6


def _sites(backslashes: str) -> str:
    rests = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
    firsts = "".join(sorted({re.escape(c[0]) for c in CONTROLS}))
    return rf"([{firsts}]){backslashes}(?={rests})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _sites(r"(\\*)"), r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _sites(r"\\(\\*)"), "$1$2")


def estimated_tokens(text: Column) -> Column:
    """Up to four letters or three digits, or one other visible character, count as a token."""
    return F.regexp_count(text, F.lit(r"\p{L}{1,4}|\p{N}{1,3}|[^\s\p{L}\p{N}]"))


def format_windows(
    conversations: DataFrame, budget: int = 2048, history_tokens: int = 512, history_turns: int = 4, token_count: Callable[[Column], Column] = estimated_tokens
) -> DataFrame:
    """A row for each window: conv_id, window, n_repeated (turns at its front that earlier windows have as well), text,
    loss_spans (from, length in code points), tokens, over_budget. conversations: conv_id, turn, role, text."""
    blank = F.lit("")
    rows = conversations.select(
        conversations["conv_id"], conversations["turn"], F.coalesce(conversations["role"], blank).alias("role"), F.coalesce(conversations["text"], blank).alias("text")
    )
    counted = rows.select("*", (token_count(F.col("text")) + TURN_TOKENS).cast("long").alias("tokens"))
    upto = F.sum("tokens").over(W.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0))
    turns = F.sort_array(F.collect_list(F.struct("upto", "turn", "role", "text")))
    talks = counted.select("conv_id", "turn", "role", "text", upto.alias("upto")).groupBy("conv_id").agg(turns.alias("turns"))
    talks = talks.select("*", F.size("turns").alias("n"), F.when(F.col("turns")[0]["role"] == SYSTEM, 1).otherwise(0).alias("n_system"))
    talks = talks.select("*", F.when(F.col("n_system") == 1, F.col("turns")[0]["upto"]).otherwise(F.lit(0)).cast("long").alias("system_tokens"))

    turns, n, system, system_tokens = F.col("turns"), F.col("n"), F.col("n_system"), F.col("system_tokens")

    def before(i: Column) -> Column:
        """Tokens of all turns before the i-th."""
        return F.when(i > 0, turns[F.greatest(i - 1, F.lit(0))]["upto"]).otherwise(F.lit(0)).cast("long")

    def history_of(first: Column) -> Column:
        """The first turn to repeat before a span that begins at ``first``; ``first`` itself for none."""

        def fits(j: Column) -> Column:
            return (before(first) - before(j) <= history_tokens) & (system_tokens + turns[first]["upto"] - before(j) <= budget)

        return F.coalesce(F.array_min(F.filter(F.sequence(F.greatest(system, first - history_turns), first), lambda j: fits(j))), first)

    def opened(state: Column, first: Column) -> Column:
        history = history_of(first)
        start = F.struct(history.alias("history"), first.alias("first"))
        return F.struct((budget - system_tokens + before(history)).cast("long").alias("limit"), F.concat(state["starts"], F.array(start)).alias("starts"))

    # Walk through the turns; a span ends where the next turn would pass its limit. A system turn alone is a span too.
    places = F.when(n > system, F.sequence(system, n - 1)).otherwise(F.array(F.lit(0)))
    none = F.struct(F.lit(-1).cast("long").alias("limit"), F.array().cast("array<struct<history:int,first:int>>").alias("starts"))
    starts = F.aggregate(places, none, lambda state, i: F.when(turns[i]["upto"] > state["limit"], opened(state, i)).otherwise(state), lambda state: state["starts"])
    talks = talks.select("conv_id", "turns", "n", "n_system", starts.alias("starts"))

    def window(x: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1)["first"], n)
        leading = F.when(x["history"] >= system, F.slice(turns, 1, system)).otherwise(F.slice(turns, 1, 0))
        return F.struct(
            k.alias("window"),
            (F.when(k > 0, system).otherwise(0) + x["first"] - x["history"]).alias("n_repeated"),
            F.concat(leading, F.slice(turns, x["history"] + 1, end - x["history"])).alias("turns"),
        )

    windows = talks.select("conv_id", F.inline(F.transform("starts", window)))
    spoken = F.transform(
        "turns",
        lambda t, i: F.struct(
            F.concat(F.lit(ROLE), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body"), ((t["role"] == ASSISTANT) & (i >= F.col("n_repeated"))).alias("target")
        ),
    )
    windows = windows.select("conv_id", "window", "n_repeated", "turns", spoken.alias("spoken"))
    walked = F.aggregate(
        "spoken",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,length:int>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(t["target"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["head"])).alias("from"), F.length(t["body"]).alias("length"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    text = F.array_join(F.transform("spoken", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    tokens = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + token_count(t["text"]) + TURN_TOKENS)
    out = windows.select("conv_id", "window", "n_repeated", text.alias("text"), walked.alias("loss_spans"), tokens.alias("tokens"))
    return out.select("*", (F.col("tokens") > budget).alias("over_budget"))


def read_windows(windows: DataFrame) -> DataFrame:
    """The turns of each window, read from its text: conv_id, window, turns (role, text) that it has first, and losses,
    the unescaped texts under its loss mask."""
    parts = F.filter(F.split("text", re.escape(END), -1), lambda p: p != "")

    def turn(part: Column) -> Column:
        pair = F.split(F.substring(part, len(ROLE) + 1, 2**31 - 1), re.escape(TEXT), 2)
        return F.struct(unescape(pair[0]).alias("role"), unescape(pair[1]).alias("text"))

    new = F.slice(F.transform(parts, turn), F.col("n_repeated") + 1, 2**31 - 1)
    losses = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["from"] + 1, s["length"])))
    return windows.select("conv_id", "window", "n_repeated", new.alias("turns"), losses.alias("losses"), F.length("text").alias("chars"))


def digests(windows: DataFrame) -> DataFrame:
    """A row for each conversation, read back from its windows: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_windows, n_repeated (turns that windows repeat from earlier ones)."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read_windows(windows).select("conv_id", "window", "n_repeated", F.size("turns").alias("n"), said.alias("said"), F.array_join("losses", "").alias("loss"), "chars")
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("parts"), F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"), F.sum("n_repeated").cast("long").alias("n_repeated"),
    )
    joined = whole.select(
        "conv_id", "n_turns", "formatted_chars", "n_windows", "n_repeated", F.array_join(F.col("parts.said"), "").alias("said"), F.array_join(F.col("parts.loss"), "").alias("loss")
    )
    return joined.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
        "n_repeated",
    )
