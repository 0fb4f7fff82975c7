"""Chat formatting with typed content parts (native: SQL functions only).

A turn has a role and a list of parts ``struct<kind, body, tokens>``. Parts are
visited in order: a text part yields its escaped text; an image, audio or document
part yields an ordered placeholder ``<|image:k|>`` (k counts the attachments of the
conversation from 0) and one entry of the attachment list: its kind, reference and
expanded token count.

Template of a conversation: for every turn

    <|turn:ROLE|>TEXT<|end|>

Inside roles and texts the escape character U+001B is written ``ESC e``, every
``<|`` as ``ESC l|`` and every ``|>`` as ``ESC r>``; no control string can therefore
come from a text, and ``unescape`` restores it. Everything else, such as ``</s>`` or ``[INST]``, means
nothing to this template and is left as it is.

The output row holds the formatted text, the loss spans (offset and length in code
points of the formatted text, one for each assistant turn) and the attachments.

Cases: null text, role or part list counts as empty; turns with equal numbers are
ordered by role, then text; repeated rows are turns of their own; a null turn number
comes first; rows without conv_id form one conversation with id null; an unknown
part kind is a document; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESC = "\x1b"
OPEN, MID, END = "<|turn:", "|>", "<|end|>"
_ESCAPES = ((ESC, ESC + "e"), ("<|", ESC + "l|"), ("|>", ESC + "r>"))
KINDS = ("image", "audio", "document")


def escape(c: Column) -> Column:
    """Reversible: afterwards ``c`` holds neither ``<|`` nor ``|>``."""
    for plain, marked in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(marked))
    return c


def unescape(c: Column) -> Column:
    for plain, marked in reversed(_ESCAPES):
        c = F.replace(c, F.lit(marked), F.lit(plain))
    return c


def text_parts(c: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(c, F.lit("")).alias("body"),
                            F.lit(0).cast("long").alias("tokens")))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         parts: str = "parts") -> DataFrame:
    """Turns ``(conv, turn, role, parts)`` -> one row a conversation:
    ``conv_id, formatted, loss_spans array<struct<start, length>>,
    attachments array<struct<slot, kind, ref, tokens>>, expanded_tokens``.

    A conversation is one output text, so its turns meet in one row, as they must;
    conversations are spread by id.
    """
    t = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("n"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(parts), F.array()).alias("parts")).alias("t"))
    grouped = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def is_attachment(p):
        return F.coalesce(p["kind"], F.lit("text")) != F.lit("text")

    def kind(p):
        return F.when(p["kind"].isin(*KINDS), p["kind"]).otherwise(F.lit("document"))

    # attachments in visiting order; a part finds its slot by its place in that order
    flat = F.flatten(F.transform("ts", lambda x, i: F.transform(
        x["parts"], lambda p, j: F.struct(i.cast("int").alias("t"), j.cast("int").alias("p"), p.alias("part")))))
    with_att = grouped.withColumn("att", F.filter(flat, lambda f: is_attachment(f["part"])))

    def slot(i, j):
        return F.size(F.filter("att", lambda a: (a["t"] < i) | ((a["t"] == i) & (a["p"] < j)))).cast("string")

    def visit(x, i):
        body = F.transform(x["parts"], lambda p, j: F.when(
            is_attachment(p), F.concat(F.lit("<|"), kind(p), F.lit(":"), slot(i, j), F.lit("|>")))
            .otherwise(escape(F.coalesce(p["body"], F.lit("")))))
        return F.struct(x["role"].alias("role"), F.concat(F.lit(OPEN), escape(x["role"]), F.lit(MID)).alias("head"),
                        F.array_join(body, "").alias("body"))

    visited = with_att.withColumn("vs", F.transform("ts", visit))
    pieces = F.transform("vs", lambda v: F.concat(v["head"], v["body"], F.lit(END)))
    # running offset and the loss spans in one pass over the turns
    spans = F.aggregate(
        "vs",
        F.struct(F.lit(0).cast("long").alias("at"),
                 F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, v: F.struct(
            (acc["at"] + F.char_length(v["head"]) + F.char_length(v["body"]) + F.lit(len(END))).cast("long").alias("at"),
            F.when(v["role"] == "assistant", F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.char_length(v["head"])).cast("long").alias("start"),
                F.char_length(v["body"]).cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans")))
    attachments = F.transform("att", lambda a, k: F.struct(
        k.cast("long").alias("slot"), kind(a["part"]).alias("kind"), a["part"]["body"].alias("ref"),
        F.coalesce(a["part"]["tokens"], F.lit(0)).cast("long").alias("tokens")))
    return visited.select(
        "conv_id", F.array_join(pieces, "").alias("formatted"), spans["spans"].alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate("att", F.lit(0).cast("long"),
                    lambda s, a: s + F.coalesce(a["part"]["tokens"], F.lit(0)).cast("long")).alias("expanded_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations: adds ``turns array<struct<role, text>>`` (texts
    unescaped, placeholders left in place) and ``loss_texts array<string>`` (what the
    loss spans cover, unescaped)."""
    rows = F.filter(F.split("formatted", r"<\|turn:"), lambda r, i: i > 0)  # nothing stands before the first mark
    turns = F.transform(rows, lambda r: F.struct(
        unescape(F.substring_index(r, MID, 1)).alias("role"),
        unescape(F.substr(r, F.instr(r, MID) + F.lit(2),
                          F.char_length(r) - F.instr(r, MID) - F.lit(1 + len(END)))).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumn("turns", turns).withColumn("loss_texts", loss)


def digest(parsed: DataFrame) -> DataFrame:
    """The checked columns of a parsed conversation."""
    joined = F.array_join("loss_texts", "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
               .cast("binary"), 256).alias("turns_sha256"),
        F.char_length(joined).cast("long").alias("loss_chars"),
        F.sha2(joined.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
