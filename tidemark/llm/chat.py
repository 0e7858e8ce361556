"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation becomes one text in the usual turn template.  Each assistant
turn then is an example of its own: all turns before it are the context and
its reply is the only part under the loss mask.  Examples keep their place
in the conversation's text; ``examples`` writes context and reply out.

The template marks turns with control strings.  In role and text every
``<|``, also one that already holds backslashes after the ``<``, gets one
more backslash, so that neither contains a control string afterwards;
taking one away restores the original.  In a role, line feeds and percent
signs are percent-encoded as well, because a line feed ends the role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import picked

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def turn_rows(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn: ``conv_id, n, start, chars, block, context_chars, reply_chars``.

    ``block`` is the turn in the template and ``start`` its place in the
    conversation's text, which is the blocks in the order of ``n`` (from 1).
    An assistant turn is an example: ``context_chars`` is the length of
    everything before the reply, its header included, ``reply_chars`` that of
    the reply.  The loss mask covers the reply only; other turns have nulls.

    Rows are ordered by turn, then by role and text; a null turn comes first
    and repeated rows all stay.  A null role or text counts as empty, rows
    with a null id form one conversation, and an empty table gives no rows.
    Other columns are dropped, whatever their names.
    """
    rows = picked(
        turns, conv_id=(conv_col, "long"), turn=(turn_col, "long"), role=(role_col, "string"), text=(text_col, "string")
    ).fillna("", ["role", "text"])
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    blocks = rows.select(
        "*", F.length(head).cast("long").alias("head_chars"),
        F.concat(head, escaped(F.col("text")), F.lit(END)).alias("block"),
    ).withColumn("chars", F.length("block").cast("long"))
    # number and place of each turn: running values, so a long conversation is not held for them
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = blocks.withColumn("n", F.row_number().over(order)).withColumn(
        "start", F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars")
    )
    own = F.col("role") == ASSISTANT
    return placed.select(
        "conv_id", "n", "start", "chars", "block", F.when(own, F.col("start") + F.col("head_chars")).alias("context_chars"),
        F.when(own, F.col("chars") - F.col("head_chars") - len(END)).alias("reply_chars"),
    )


def masked_reply() -> Column:
    """The reply of a row of ``turn_rows``, unescaped: what the loss mask covers; null for other turns."""
    place = F.col("context_chars") - F.col("start") + 1
    return unescaped(F.substr("block", place.cast("int"), F.col("reply_chars").cast("int")))


def read_block(block: Column) -> Column:
    """Role and text, unescaped, of what precedes the first end of a turn."""
    first = F.element_at(F.split(block, "<\\|im_end\\|>\n"), 1)
    return _turn(first)


def _turn(block: Column) -> Column:
    ends = F.instr(block, F.lit("\n"))
    role = F.substr(block, F.lit(len(START) + 1), ends - len(START) - 1)
    return F.struct(unescaped_role(role).alias("role"), unescaped(F.substr(block, ends + 1)).alias("text"))


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id``, its ``formatted`` text and its ``examples``.

    An example is (turn, context_chars, reply_chars), as in ``turn_rows`` but
    with turns counted from 0.  A whole conversation becomes one value here;
    ``turn_rows`` has the same without that bound.
    """
    placed = turn_rows(turns, conv_col, turn_col, role_col, text_col)
    sorted_turns = F.sort_array(F.collect_list(F.struct("n", "context_chars", "reply_chars", "block")))
    return placed.groupBy("conv_id").agg(sorted_turns.alias("turns")).select(
        "conv_id",
        F.array_join(F.col("turns.block"), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["reply_chars"].isNotNull()),
            lambda t: F.struct((t["n"] - 1).alias("turn"), t["context_chars"].alias("context_chars"), t["reply_chars"].alias("reply_chars")),
        ).alias("examples"),
    )


def examples(conversations: DataFrame, keep: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """Every assistant turn as a row: ``conv_id, example, context, reply``, both parts still escaped.

    The context is written out only here, as its size grows with the square
    of a conversation's length; one example is held at a time.  ``keep`` names
    columns of the conversation to repeat in its rows; with ``outer`` one
    without assistant turns is a row of nulls.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    rows = conversations.select("conv_id", "formatted", *keep, explode("examples").alias("example", "e"))
    return rows.select(
        "conv_id", *keep, "example",
        F.substr("formatted", F.lit(1), F.col("e.context_chars").cast("int")).alias("context"),
        F.substr("formatted", (F.col("e.context_chars") + 1).cast("int"), F.col("e.reply_chars").cast("int")).alias("reply"),
    )


def masked_text(context: Column, reply: Column) -> Column:
    """What the loss mask of an example covers, unescaped: all of its text after the context."""
    return unescaped(F.substr(F.concat(context, reply), F.length(context) + 1))


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds ``turns`` (role and text, unescaped) and ``loss`` (the masked texts, unescaped) from the formatted text."""
    parts = F.split("formatted", "<\\|im_end\\|>\n")
    blocks = F.slice(parts, F.lit(1), F.size(parts) - 1)
    read = conversations.withColumn("turns", F.transform(blocks, _turn))
    return read.withColumn(
        "loss", F.transform("examples", lambda e: F.element_at(F.col("turns"), (e["turn"] + 1).cast("int"))["text"])
    )
