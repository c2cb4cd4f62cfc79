"""Chat formatting of typed content parts, with built-in functions only.

A visitor turns the parts of a turn into one text: text parts are escaped, and
image, audio and document parts become numbered placeholders. Each attachment is
recorded with its reference, its place in the formatted text and the tokens that
it expands to. Markers are ``<|name|>``; inside texts and roles each ``<`` that a
bar follows, with any number of backslashes between, gets one backslash more, so
no text can hold a marker and unescaping is exact.

Defined results: turns are in order of turn, role and parts; rows that repeat a
turn are kept; a null turn comes first; null roles, texts and references are empty;
a turn without parts has the empty text; null conversation ids are one conversation;
other columns are not read; an empty table gives no rows. A part of an unknown type
is a document.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.llm.common import text_of

#: Fixed texts of the template.
START, STOP = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,units:bigint>"
#: Tokens per unit: tiles of an image, seconds of an audio, pages of a document.
TOKENS = {"image": 256, "audio": 25, "document": 800}


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role's line breaks would end its line, so they are written as ``%0A``, and ``%`` as ``%25``."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def text_parts(text: str) -> Column:
    """A text column as its only part."""
    part = F.struct(F.lit("text").alias("type"), text_of(text).alias("text"), F.lit("").alias("ref"), F.lit(0).cast("long").alias("units"))
    return F.array(part).cast(f"array<{PART}>")


def _kind(part: Column) -> Column:
    return F.when(part["type"].isin("text", "image", "audio"), part["type"]).otherwise("document")


def _visit(part: Column, place: Column) -> Column:
    """The text a part becomes; ``place`` is its number in the turn."""
    mark = F.concat(F.lit("<|"), _kind(part), F.lit(":"), place.cast("string"), F.lit("|>"))
    return F.when(_kind(part) == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(mark)


def _expansion(part: Column) -> Column:
    units = F.greatest(F.coalesce(part["units"], F.lit(0)), F.lit(0))
    rate = F.when(part["type"] == "image", TOKENS["image"]).when(part["type"] == "audio", TOKENS["audio"]).otherwise(TOKENS["document"])
    return units * rate


def format_chats(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation.

    ``formatted`` is the whole text; ``loss_spans`` (start, length, code points) are the
    contents of turns whose role is in ``trained``; ``attachments`` hold conversation-wide
    place, ref, type and expanded tokens in order; ``attachment_tokens`` is their sum.
    A conversation is one row of the output by nature; offsets are running sums of
    its turns, not worked out over the joined text.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        text_of(role).alias("role"),
        F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")).alias("parts"),
    )
    contents = F.transform("parts", _visit)
    visited = rows.select("conv_id", "turn", "role", "parts", contents.alias("contents")).select(
        "*",
        F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join("contents", "").alias("content"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.length("head") + F.length("content") + len(STOP) + 1
    placed = visited.withColumn("before", F.sum(whole).over(order) - whole).withColumn("start", F.col("before") + F.length("head"))
    heard = F.zip_with("parts", "contents", lambda part, content: F.struct(part.alias("part"), F.length(content).alias("size")))
    sizes = placed.withColumn("heard", heard)
    earlier = lambda i: F.aggregate(F.slice("heard", 1, i), F.lit(0), lambda total, h: total + h["size"])
    attached = F.filter(
        F.transform(
            "heard",
            lambda h, i: F.struct(
                (F.col("start") + earlier(i)).cast("long").alias("start"),
                F.coalesce(h["part"]["ref"], F.lit("")).alias("ref"),
                _kind(h["part"]).alias("type"),
                _expansion(h["part"]).cast("long").alias("tokens"),
            ),
        ),
        lambda a: a["type"] != "text",
    )
    # places rise from turn to turn, so they are the order
    out = sizes.select(
        "conv_id",
        F.struct(
            F.col("before").cast("long").alias("before"),
            F.concat("head", "content", F.lit(f"{STOP}\n")).alias("piece"),
            F.when(F.col("role").isin(*trained), F.struct(F.col("start").cast("long").alias("start"), F.length("content").cast("long").alias("length"))).alias("span"),
            attached.alias("attached"),
        ).alias("t"),
    )
    ordered = out.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    listed = ordered.select(
        "conv_id",
        F.array_join("t.piece", "").alias("formatted"),
        F.filter("t.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten("t.attached").alias("attachments"),
    )
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"])
    return listed.withColumn("attachment_tokens", tokens)


def parse_chats(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) read back from ``formatted``, and ``trained``: the texts under the loss spans, unescaped.

    Placeholders stay as they are.
    """
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.size(F.split("formatted", r"<\|im_start\|>")))
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescaped_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescaped(
                F.substr(p, F.instr(p, F.lit("\n")) + 1, F.length(p) - F.instr(p, F.lit("\n")) - len(STOP) - 1)
            ).alias("text"),
        ),
    )
    trained = F.transform("loss_spans", lambda s: unescaped(F.substr("formatted", s["start"].cast("int") + 1, s["length"].cast("int"))))
    return formatted.withColumns({"turns": turns, "trained": trained})
