"""Chat formatting with typed content parts, with DataFrame functions only.

A message's content is an array of typed parts (text, image, audio, document).  The visitor
flattens the parts in order: text is escaped, any other part becomes a run of placeholder tokens
as long as the attachment's expanded token count, and its reference, kind, count and place are
recorded as an attachment.  Turns are then put into the template and joined by conversation.

Template:  ``<|turn|>`` role ``<|body|>`` content ``<|end|>``, one after another by turn.
Escaping:  ``&`` to ``&amp;``, ``<`` to ``&lt;``, ``[`` to ``&lsqb;`` in roles and texts, so no
control string of this or a bracket style of template can come from a text; unescaping undoes it.
The loss mask is a list of (start, length) in code points: the contents of assistant turns.

Edge cases: a null text is the empty text and a null role the empty role; turns with equal numbers
are ordered by role and text, null turns first; rows that repeat are separate turns; a null conv_id
is a conversation of its own; an empty table gives no rows; other columns are ignored.  A
conversation is one output string, so it has to fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
ASSISTANT = "assistant"
PART = "struct<kind:string,text:string,ref:string,tokens:int>"
KINDS = ("image", "audio", "document")
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))


def escape(text: Column) -> Column:
    for plain, safe in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(_ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def placeholder(kind: Column, tokens: Column) -> Column:
    known = F.when(kind.isin(*KINDS), kind).otherwise(F.lit("attachment"))
    return F.repeat(F.concat(F.lit("<|"), known, F.lit("|>")), F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(0)))


def visit(parts: Column) -> Column:
    """struct(content, attachments) of an array of typed parts, in their order."""
    flat = F.transform(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: F.struct(
        F.when(p["kind"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(placeholder(p["kind"], p["tokens"])).alias("out"),
        F.when(p["kind"] != "text", F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), F.greatest(F.coalesce(p["tokens"], F.lit(0)), F.lit(0)).alias("tokens"))).alias("attachment")))
    placed = F.transform(flat, lambda x, i: F.when(x["attachment"].isNotNull(), F.struct(
        i.alias("part"), x["attachment"]["kind"].alias("kind"), x["attachment"]["ref"].alias("ref"), x["attachment"]["tokens"].alias("tokens"))))
    return F.struct(F.array_join(F.transform(flat, lambda x: x["out"]), "").alias("content"), F.filter(placed, lambda x: x.isNotNull()).alias("attachments"))


def text_part(text: Column) -> Column:
    """The parts of a message that is a plain text."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def format_chats(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask, attachments of messages (conv_id, turn, role, parts).

    loss_mask holds (turn, offset, length, start): start counts code points of the whole string,
    offset those of the turn's own piece, both to the first one that is learned.
    """
    plain = F.array_join(F.transform(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), lambda p: F.coalesce(p["text"], F.lit(""))), "")
    seen = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(F.col("parts")).alias("v"), plain.alias("plain"))
    piece = seen.select("conv_id", "plain", F.struct(
        "turn", "role", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY), F.col("v.content"), F.lit(END)).alias("piece"), F.col("v.attachments").alias("attachments")).alias("t"))
    before = Window.partitionBy("conv_id").orderBy("t.turn", "t.role", "plain", "t.piece").rowsBetween(Window.unboundedPreceding, -1)
    started = piece.withColumn("start", F.coalesce(F.sum(F.length("t.piece")).over(before), F.lit(0)))
    grouped = started.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "t"))).alias("turns"))
    offset = F.length(F.lit(TURN + BODY))

    def learned(x: Column, i: Column) -> Column:
        head = offset + F.length(escape(x["t"]["role"]))
        return F.when(x["t"]["role"] == ASSISTANT, F.struct(
            i.alias("turn"), head.alias("offset"), (F.length(x["t"]["piece"]) - head - len(END)).alias("length"), (x["start"] + head).alias("start")))

    placed = F.transform("turns", lambda x, i: F.transform(x["t"]["attachments"], lambda a: F.struct(
        i.alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    return grouped.select(
        "conv_id", F.array_join(F.transform("turns", lambda x: x["t"]["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", learned), lambda x: x.isNotNull()).alias("loss_mask"), F.flatten(placed).alias("attachments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with read: array of (piece, role, text) parsed from the formatted string alone."""
    body = F.split("formatted", r"(?=<\|turn\|>)")
    turn = F.transform(F.filter(body, lambda t: t != ""), lambda t: F.struct(
        t.alias("piece"),
        unescape(F.substring_index(F.substring_index(t, BODY, 1), TURN, -1)).alias("role"),
        unescape(F.substring_index(F.substring_index(t, BODY, -1), END, 1)).alias("text")))
    return formatted.withColumn("read", turn)


def chat_report(messages: DataFrame) -> DataFrame:
    """The digests of every conversation, all taken from its formatted string and loss mask."""
    out = read_back(format_chats(messages))
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss_mask", lambda m: unescape(F.substring(F.get("read", m["turn"])["piece"], m["offset"] + 1, m["length"]))), "")
    return out.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"), learned.alias("learned"), "formatted").select(
        "conv_id", "n_turns", "turns_sha256", F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
