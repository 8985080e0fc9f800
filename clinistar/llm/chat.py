"""Operator 10: chat formatting in budgeted windows.

A conversation becomes training windows of at most ``BUDGET`` tokens. Prefix
sums of the turns' tokens place every turn on a line that is cut into equal
stretches; a window holds the turns that start in its stretch, after the
system turn, the turns that start in the last ``HISTORY`` tokens before it, and
the turn before its first new one wherever that starts. Turns are never cut. Assistant texts are targets under the loss mask; in
windows that repeat them they are masked out, so each is learnt once.

The template marks a turn as ``### Role: text</turn>`` and a line end. Control
strings inside roles and texts are escaped by a backslash, and so is the
backslash, hence a text that looks like the template reads back as it was.

A conversation may hold a third of all turns: prefix sums run inside ranges of
``RANGE`` turn numbers and over one row per range, and a window is a group of
its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinistar.llm.common import table

#: Tokens of a window, of the history in it, and least tokens of new turns.
BUDGET, HISTORY, LEAST_NEW = 1024, 256, 128
#: Turn numbers of one range.
RANGE = 256
#: Tokens of the template around a turn.
MARKS = 4
TARGET = "assistant"
SYSTEM = "system"
#: The template's control strings (fixed values).
ESCAPED_TEXT = r"(\\|###|</turn>)"
ESCAPED_ROLE = r"(\\|###|</turn>|: )"
UNESCAPE = re.compile(r"\\(\\|###|</turn>|: )")
TURN = re.compile(r"### ((?:\\.|[^\\])*?): ((?:\\.|[^\\])*?)</turn>\n", re.S)

ORDER = ("turn", "role", "text")


def n_tokens(text: Column) -> Column:
    """Tokens of a text: runs of letters, digits, and other signs one by one."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]")).cast("long")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, count=n_tokens) -> DataFrame:
    """``conv_id, window, formatted, fresh, loss, n_tokens`` for each window.

    ``turns`` needs ``conv_id, turn, role, text``; other columns are ignored.
    ``fresh`` is the offset in ``formatted`` (code points) from which turns
    are new; ``loss`` lists the stretches ``[start, stop)`` under the mask.

    Turns are ordered by number, role and text, a null number first; repeated
    rows are turns of their own. A null role or text is empty; a null
    ``conv_id`` is a conversation like any other. A conversation starts with
    its system turn if its first turn's role is ``system``; later system turns
    are ordinary. A window stays within the budget unless the system turn, the
    history (or the conversation's longest turn, if that is longer) and the
    longest turn leave less than ``LEAST_NEW`` tokens; then it may exceed it by
    those. No rows give no rows.
    """
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("size", count(F.col("text")) + MARKS).withColumn("range", F.floor(F.col("turn") / RANGE))
    place = F.struct(*ORDER)
    stats = rows.groupBy("conv_id").agg(
        F.min(F.struct(*ORDER, "size")).alias("first"), F.max("size").alias("largest")
    ).select(
        F.col("conv_id").alias("conv"),
        F.when(F.col("first.role") == SYSTEM, F.col("first")).alias("system"),
        "largest",
    )
    sums = rows.groupBy("conv_id", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("sum_conv"), F.col("range").alias("sum_range"), F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("conv_id", "range").orderBy(*ORDER)
    placed = (
        rows.withColumn("nth", F.row_number().over(inside))
        .withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
        .join(sums, F.col("conv_id").eqNullSafe(F.col("sum_conv")) & F.col("range").eqNullSafe(F.col("sum_range")))
        .join(stats, F.col("conv_id").eqNullSafe(F.col("conv")))
        .withColumn("start", F.col("offset") + F.col("inside"))
    )
    system_size = F.coalesce("system.size", F.lit(0))
    is_system = F.col("system").isNotNull() & (F.col("start") == 0)
    stretch = F.greatest(F.lit(LEAST_NEW), budget - system_size - F.greatest(F.lit(history), F.col("largest")) - F.col("largest")).cast("long")
    placed = (
        placed.withColumn("is_system", is_system)
        .withColumn("stretch", stretch)
        .withColumn("line", F.greatest(F.lit(0), F.col("start") - system_size))
        .withColumn("window", F.expr("line div stretch"))
        .withColumn("last", F.expr(f"(line + {int(history)}) div stretch"))  # the last window whose history it starts in
        .withColumn("next", F.floor((F.col("start") + F.col("size") - system_size) / F.col("stretch")))  # the next turn's window
        .withColumn("again", F.when(F.col("is_system"), F.array(F.col("window"))).otherwise(F.array_distinct(
            F.concat(F.sequence("window", F.greatest("window", "last")), F.array(F.greatest("window", "next"))))))
        .withColumn("copy", F.explode(F.transform("again", lambda w: w - F.col("window"))))
        .withColumn("window", F.col("window") + F.col("copy"))
    )
    marked = lambda role, text: F.concat(
        F.lit("### "), F.regexp_replace(role, ESCAPED_ROLE, r"\\$1"), F.lit(": "),
        F.regexp_replace(text, ESCAPED_TEXT, r"\\$1"), F.lit("</turn>\n"),
    )
    pieces = placed.withColumn("piece", marked(F.col("role"), F.col("text"))).withColumn(
        "system_piece", F.when(F.col("window") > 0, marked(F.col("system.role"), F.col("system.text")))
    )
    grouped = pieces.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("start", "nth", "copy", "role", "piece", "size"))).alias("turns"),
        F.min(F.col("copy")).alias("newest"),
        F.first("system_piece").alias("system_piece"),
        F.first(system_size).alias("system_size"),
    ).where(F.col("newest") == 0)  # a window of repeated turns alone teaches nothing
    ahead = F.coalesce(F.length("system_piece"), F.lit(0))
    ends = F.aggregate(
        "turns", F.array(ahead), lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(t["piece"])))
    )
    shaped = grouped.withColumn("ends", ends).withColumn(
        "formatted", F.concat(F.coalesce("system_piece", F.lit("")), F.array_join(F.transform("turns", lambda t: t["piece"]), ""))
    )
    n_old = F.size(F.filter("turns", lambda t: t["copy"] > 0))
    head = F.length(F.concat(F.lit("### "), F.lit(TARGET), F.lit(": ")))
    spans = F.filter(
        F.transform(
            "turns",
            lambda t, i: F.when(
                (t["copy"] == 0) & (t["role"] == TARGET),
                F.struct((F.get("ends", i) + head).alias("start"), (F.get("ends", i) + F.length(t["piece"]) - len("</turn>\n")).alias("stop")),
            ),
        ),
        lambda s: s.isNotNull(),
    )
    tokens = F.aggregate("turns", F.when(F.col("window") > 0, F.col("system_size")).otherwise(F.lit(0)).cast("long"), lambda a, t: a + t["size"])
    return shaped.select(
        "conv_id", "window", "formatted", F.get("ends", n_old).alias("fresh"), spans.alias("loss"), tokens.alias("n_tokens")
    )


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns (role, text) of a formatted text, unescaped."""
    at = 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        yield tuple(UNESCAPE.sub(r"\1", x) for x in found.groups())
        at = found.end()


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from its windows in order: ``conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    A digest needs its conversation in order, so each is read as a stream:
    memory is one window and the digests' state.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for b in batches:
            done = []
            for conv, text, fresh, loss in zip(b["conv_id"], b["formatted"], b["fresh"], b["loss"]):
                conv = None if pd.isna(conv) else conv
                if state is None or conv != current:
                    if state is not None:
                        done.append(row(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text[fresh:]):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for span in loss:
                    learnt = UNESCAPE.sub(r"\1", text[span["start"] : span["stop"]])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode("utf-8", "replace"))
                state[4] += len(text)
            yield frame(done)
        if state is not None:
            yield frame([row(current, state)])

    def row(conv, s):
        return (conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])

    def frame(rows):
        return pd.DataFrame(rows, columns=columns).astype({"conv_id": "object"})

    n = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = formatted.select("conv_id", "window", "formatted", "fresh", "loss").repartition(n, "conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInPandas(
        read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def op10_chat(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return read_back(windows(turns.unionByName(extra)))
