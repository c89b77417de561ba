"""Chat formatting by prefix-target expansion.

Each assistant turn becomes an example of its own: all turns before it as context, then the
reply, which alone is trainable. Turns that no reply follows are kept in one more example
without a trainable part, so nothing of a conversation is lost.

A turn is written ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. Inside texts and roles a
backslash becomes ``\\b`` and ``<|`` becomes ``<\\p``, and a line break in a role ``\\n``; escaped
text holds no ``<|``, so it can neither open nor close a turn, and ``unescaped`` undoes it exactly.

Rows: a NULL text or role is empty, a NULL turn comes first. Equal turns are ordered by role
and text, repeated rows all stay. A row without a conversation id is a conversation of one
turn. An empty table gives an empty result. Extra columns are not read.

A conversation is one training sequence and therefore one row; it is not split. Its array is
carried once per example, the texts are joined row by row, so memory follows one example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """Undo ``escaped`` and ``escaped_role``: after escaping, a backslash opens a pair and nothing else."""
    pairs = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\p"), F.lit("|"))
    return F.replace(pairs, F.lit("\\b"), F.lit("\\"))


def examples(conversations: DataFrame) -> DataFrame:
    """``(conv_id, example, formatted, loss_start, loss_chars, complete)`` per assistant turn.

    ``loss_start`` counts code points of ``formatted`` before the trainable text; it is NULL for
    the example of trailing turns. ``complete`` marks the one example with all turns.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.struct(
        F.col("turn"), role.alias("role"), text.alias("text")
    )
    rows = conversations.select("conv_id", turn.alias("turn"))
    keyed = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    loose = rows.where("conv_id IS NULL").select("conv_id", F.array("turn").alias("turns"))
    rendered = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == ASSISTANT).alias("reply"),
            F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
        ),
    )
    whole = keyed.unionByName(loose).select("conv_id", rendered.alias("turns"))
    positions = F.sequence(F.lit(1), F.size("turns"))
    ends = F.filter(positions, lambda k: F.element_at("turns", k)["reply"] | (k == F.size("turns")))
    one = whole.select("conv_id", "turns", F.posexplode(ends).alias("example", "upto"))
    last = F.element_at("turns", F.col("upto"))
    context = F.array_join(
        F.transform(F.slice("turns", 1, F.col("upto") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(END))), ""
    )
    before = F.concat(context, last["head"])
    cut = one.select(
        "conv_id", "example", before.alias("before"), last["body"].alias("body"), last["reply"].alias("reply"),
        (F.col("upto") == F.size("turns")).alias("complete"),
    )
    return cut.select(
        "conv_id",
        "example",
        F.concat("before", "body", F.lit(END)).alias("formatted"),
        F.when(F.col("reply"), F.char_length("before")).alias("loss_start"),
        F.when(F.col("reply"), F.char_length("body")).alias("loss_chars"),
        "complete",
    )


def turns_of(formatted: Column) -> Column:
    """``array<struct<role, text>>`` read back from one example."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    inner = lambda p: F.substring(p, len(START) + 1, 2147483647)

    def read(piece: Column) -> Column:
        role = F.substring_index(inner(piece), "\n", 1)
        text = F.substr(inner(piece), F.char_length(role) + 2)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, read)


def loss_text(formatted: str = "formatted") -> Column:
    """The trainable text of an example, unescaped; NULL if it has none."""
    return unescaped(F.substr(F.col(formatted), F.col("loss_start") + 1, F.col("loss_chars")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, all taken from the examples' text and loss spans."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    seen = formatted.select(
        "conv_id",
        F.char_length("formatted").cast("long").alias("chars"),
        F.when(F.col("loss_start").isNotNull(), F.struct("example", loss_text().alias("text"))).alias("loss"),
        F.when(F.col("complete"), F.struct(turns_of(F.col("formatted")).alias("turns"))).alias("full"),
    )
    # the loose conversations are told apart by their own rows
    keyed = seen.where("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.sum("chars").alias("chars"), F.sort_array(F.collect_list("loss")).alias("losses"), F.collect_list("full")[0]["turns"].alias("turns")
    )
    loose = seen.where("conv_id IS NULL").select(
        "conv_id", "chars", F.filter(F.array("loss"), lambda x: x.isNotNull()).alias("losses"), F.col("full.turns").alias("turns")
    )
    loss = F.array_join(F.transform("losses", lambda x: x["text"]), "")
    return keyed.unionByName(loose).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )
