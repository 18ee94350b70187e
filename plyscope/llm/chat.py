"""Chat formatting with typed content parts, in DataFrame expressions only.

A visitor turns each part of a message into text: text parts are escaped, images, audio and documents become
placeholders in their order, with the number of tokens that each expands to; the references are listed in the same
order. The template marks turns with control strings that begin with ``<``. Inside texts and roles the characters
``\\``, ``<`` and ``>`` are written ``\\b``, ``\\l`` and ``\\g``, so no text can contain a control string and every
text can be had back.

NULL texts and roles count as empty; a NULL or unknown part type counts as text. Rows go by turn (NULL first), then
role, then text; rows without a conversation id form one conversation. A conversation is one row of the result,
so it is the one thing that must fit into a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TURN_END = "</turn>\n"
#: An image costs a base and a number for each tile; sound and pages cost by length.
IMAGE_BASE, IMAGE_TILE, TILE_PIXELS = 85, 170, 512
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 800
PARTS = "array<struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
MEDIA = ("image", "audio", "document")


def escape(text: Column) -> Column:
    for raw, safe in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for safe, raw in (("\\l", "<"), ("\\g", ">"), ("\\b", "\\")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def text_part(text: Column) -> Column:
    """A message of plain text as a list of one typed part."""
    empty = [F.lit(None).cast(k).alias(n) for n, k in (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), *empty))


def is_media(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*MEDIA), F.lit(False))


def part_tokens(part: Column) -> Column:
    """Tokens that a placeholder expands to; 0 for text."""
    size = lambda c: F.greatest(F.lit(1), F.coalesce(c, F.lit(1)))
    tiles = F.ceil(size(part["width"]) / TILE_PIXELS) * F.ceil(size(part["height"]) / TILE_PIXELS)
    seconds = F.greatest(F.lit(0.0), F.coalesce(part["seconds"], F.lit(0.0)))
    return (
        F.when(part["type"] == "image", tiles * IMAGE_TILE + IMAGE_BASE)
        .when(part["type"] == "audio", F.ceil(seconds * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", size(part["pages"]) * DOCUMENT_TOKENS_PER_PAGE)
        .otherwise(0)
        .cast("long")
    )


def visit(part: Column) -> Column:
    """What a part becomes in the message."""
    placeholder = F.concat(F.lit("<"), part["type"], F.lit(" tokens="), part_tokens(part).cast("string"), F.lit("/>"))
    return F.when(is_media(part), placeholder).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def format_chat(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learned: str = "assistant"
) -> DataFrame:
    """One row per conversation.

    formatted; loss_spans: begin and end (in characters of ``formatted``) of every text part of the learned role;
    attachments: type, uri, tokens in the order of the placeholders; media_tokens: their sum.
    """
    rows = df.select(
        F.col(f"`{conversation}`").alias("_conv"),
        F.col(f"`{turn}`").alias("_turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("_role"),
        F.coalesce(F.col(f"`{parts}`").cast(PARTS), F.array().cast(PARTS)).alias("_parts"),
    )
    rows = rows.withColumn("_parts", F.filter("_parts", lambda p: p.isNotNull()))
    rows = rows.withColumn("_flat", F.transform("_parts", visit)).withColumn("_head", F.concat(F.lit("<turn "), escape(F.col("_role")), F.lit(">\n")))
    rows = rows.withColumn("_piece", F.concat(F.col("_head"), F.concat_ws("", "_flat"), F.lit(TURN_END)))
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_piece")
    placed = rows.withColumns(
        {
            "_n": F.row_number().over(order),
            "_begin": F.sum(F.length("_piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)),
        }
    ).withColumn("_begin", F.coalesce("_begin", F.lit(0)) + F.length("_head"))
    # texts of the learned role: length of what stands before, for each part
    before = lambda i: F.aggregate(F.slice("_flat", F.lit(1), i), F.lit(0), lambda n, s: n + F.length(s))
    spans = F.transform(
        F.filter(F.transform("_parts", lambda p, i: F.struct(is_media(p).alias("m"), i.alias("i"))), lambda x: ~x["m"]),
        lambda x: F.struct(
            (F.col("_begin") + before(x["i"])).alias("begin"),
            (F.col("_begin") + before(x["i"]) + F.length(F.element_at("_flat", x["i"] + 1))).alias("end"),
        ),
    )
    no_spans = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    media = F.transform(
        F.filter("_parts", is_media), lambda p: F.struct(p["type"].alias("type"), p["uri"].alias("uri"), part_tokens(p).alias("tokens"))
    )
    each = placed.select(
        "_conv",
        F.struct(
            "_n",
            "_piece",
            F.when(F.col("_role") == learned, spans.cast("array<struct<begin:bigint,end:bigint>>")).otherwise(no_spans).alias("spans"),
            media.alias("media"),
        ).alias("t"),
    )
    whole = each.groupBy("_conv").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return whole.select(
        F.col("_conv").alias(conversation),
        F.size("t").cast("long").alias("n_turns"),
        F.concat_ws("", F.transform("t", lambda x: x["_piece"])).alias("formatted"),
        F.flatten(F.transform("t", lambda x: x["spans"])).alias("loss_spans"),
        F.flatten(F.transform("t", lambda x: x["media"])).alias("attachments"),
    ).withColumn("media_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """Role and text of every turn of a formatted conversation; placeholders stay as they are."""
    pieces = F.split(formatted, TURN_END, -1)
    head = lambda t: F.substring_index(t, ">\n", 1)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda t: F.struct(
            unescape(F.substr(head(t), F.lit(7))).alias("role"), unescape(F.substr(t, F.length(head(t)) + 3)).alias("text")
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.concat_ws("", F.transform(spans, lambda s: F.substr(formatted, (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")))))
