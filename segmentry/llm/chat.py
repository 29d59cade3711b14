"""Chat formatting over typed content parts, with DataFrame functions only.

A visitor flattens the parts of a message: text is escaped, any other part becomes a placeholder and an
attachment.  ``<|im_start|>role`` and ``<|im_end|>`` mark the turns; a text cannot hold them, as ``<`` before
``|`` or at the end of a part is written ``&lt;`` and ``&`` is written ``&amp;``, which reading undoes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Pixels of an image patch, audio frames of a second, tokens of a page.
PATCH, FRAMES, PAGE = 28, 25, 256
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("&"), F.lit("&amp;")), r"<(?=\||\z)", "&lt;")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _role(role: Column) -> Column:
    return F.replace(escape(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit("&#10;"))


def _patches(pixels: Column) -> Column:
    return F.ceil(F.coalesce(pixels, F.lit(0)) / PATCH)


#: What a part becomes: its tokens by type.  A part of any other type, or none, is text.
ATTACHMENTS = {
    "image": lambda p: _patches(p["width"]) * _patches(p["height"]),
    "audio": lambda p: F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * FRAMES),
    "document": lambda p: F.coalesce(p["pages"], F.lit(0)) * PAGE,
}


def visit(part: Column) -> Column:
    """``struct(written, type, ref, tokens)`` of a part; type, ref and tokens are null for text."""
    kind = part["type"]
    known = kind.isin(*ATTACHMENTS)
    tokens = F.lit(None).cast("bigint")
    for name, count in ATTACHMENTS.items():
        tokens = F.when(kind == name, count(part).cast("bigint")).otherwise(tokens)
    return F.struct(
        F.when(known, F.concat(F.lit("<|"), kind, F.lit("|>"))).otherwise(escape(F.coalesce(part["text"], F.lit("")))).alias("written"),
        F.when(known, kind).alias("type"),
        F.when(known, part["ref"]).alias("ref"),
        tokens.alias("tokens"),
    )


def as_parts(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, parts`` of plain messages ``(conv_id, turn, role, text)``."""
    blank = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"), *blank)
    return messages.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def format_chats(messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_mask, attachments, attachment_tokens)`` per conversation.

    ``messages`` has ``conv_id, turn, role, parts`` with parts as ``PART``.  Turns are in order of
    ``turn``, then role and content, null first; repeated rows are turns of their own, null conversations are one.
    Null parts and texts are empty, a null role is "".  ``loss_mask`` says for each turn of the string
    whether its content is learned (role ``learned``).  The n-th placeholder belongs to the n-th
    attachment.  Other columns are ignored, and an empty table gives no rows.
    The rows of a conversation meet in the one string they become.
    """
    parts = F.transform(F.coalesce("parts", F.array().cast(f"array<{PART}>")), visit)
    seen = messages.select("conv_id", "turn", _role(F.col("role")).alias("role"), (F.col("role") == learned).alias("learned"), parts.alias("parts"))
    seen = seen.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            F.array_join(F.transform("parts", lambda p: p["written"]), "").alias("content"),
            F.coalesce("learned", F.lit(False)).alias("learned"),
            F.filter("parts", lambda p: p["type"].isNotNull()).alias("attached"),
        ).alias("t"),
    )
    turns = seen.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    attachments = F.flatten(F.transform("turns", lambda t: t["attached"]))
    attachments = F.transform(attachments, lambda a: F.struct(a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    line = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["content"], F.lit(END + "\n"))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", line), "").alias("formatted"),
        F.transform("turns", lambda t: t["learned"]).alias("loss_mask"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda s, a: s + F.coalesce(a["tokens"], F.lit(0))).alias("attachment_tokens"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``: ``(role, text, learned)`` read from the string, placeholders as they stand."""
    bodies = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30)
    role = lambda s: F.substring_index(s, "\n", 1)
    content = lambda s: F.substring(s, F.char_length(role(s)) + 2, F.char_length(s) - F.char_length(role(s)) - 2 - len(END))
    turn = lambda s, learned: F.struct(
        unescape(F.replace(role(s), F.lit("&#10;"), F.lit("\n"))).alias("role"), unescape(content(s)).alias("text"), learned.alias("learned")
    )
    return formatted.withColumn("__bodies", bodies).withColumn("turns", F.zip_with("__bodies", "loss_mask", turn)).drop("__bodies")


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of what ``read_chats`` returns."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: t["text"]), "")
    read = chats.select("conv_id", "formatted", F.size("turns").cast("bigint").alias("n_turns"), whole.alias("whole"), learned.alias("learned"))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2("whole", 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
