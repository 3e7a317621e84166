"""Chat formatting of typed content parts, in DataFrame expressions only.

A message's content is an array of parts (text, image, audio, document).  A
visitor flattens it in order: text is escaped, any other part becomes a
numbered placeholder, its reference and the tokens it expands to are recorded.

    <turn ROLE>escaped text<part image 0>more text</turn>

Every ``<`` of a text is written ``\\l`` and every backslash ``\\b``; in a role or a kind
``>`` is ``\\g`` too.  So a ``<`` of the output is always markup, however texts are cut
into parts: the output splits at plain strings, and ``unescape`` restores every text.

Conversations are put together in two levels (blocks of turns, then
conversations), and offsets are running sums in the same two levels, so the
turns of one very long conversation are formatted in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,"
        "seconds:double,pages:int>")
OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"
PLACEHOLDER = "<part [^<>]*>"
LOSS_ROLE = "assistant"
TURN_BLOCK = 64

# What a placeholder expands to: image patches, audio frames, tokens of a page.
IMAGE_PATCH, IMAGE_TOKENS = 14, 256
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 512


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    for code, char in (("\\g", ">"), ("\\l", "<"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _escape_name(name: Column) -> Column:
    """A role or kind, which stands before a ``>``."""
    return F.replace(escape(name), F.lit(">"), F.lit("\\g"))


def text_parts(text: Column) -> Column:
    """One text part per message; null text counts as empty."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages")))


def _tokens(part: Column) -> Column:
    """Tokens that an attachment expands to (unknown kinds: none)."""
    patches = lambda side: F.ceil(part[side] / IMAGE_PATCH)
    return F.coalesce(
        F.when(part["kind"] == "image",
               F.coalesce(patches("width") * patches("height"), F.lit(IMAGE_TOKENS)))
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND))
        .when(part["kind"] == "document", part["pages"] * DOCUMENT_TOKENS_PER_PAGE),
        F.lit(0)).cast("bigint")


def _visit(parts: Column) -> Column:
    """Body of a message: its parts in order, attachments as placeholders."""
    def one(part: Column, i: Column) -> Column:
        return F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit("")))) \
            .otherwise(F.concat(F.lit("<part "), _escape_name(F.coalesce(
                part["kind"], F.lit("unknown"))), F.lit(" "), i.cast("string"), F.lit(">")))
    return F.array_join(F.transform(parts, one), "")


def _attachments(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda p, i: F.struct(
        i.alias("ordinal"), F.coalesce(p["kind"], F.lit("unknown")).alias("kind"),
        p["ref"].alias("ref"), _tokens(p).alias("tokens"))), lambda a: a["kind"] != "text")


def format_conversations(messages: DataFrame, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role",
                         parts_col: str | None = None, text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_col``, ``formatted``, ``turns``, ``attachments``
    and ``attachment_tokens``.

    ``turns`` holds per turn the code points at which its markup (``begin``) and
    its body start and end, and whether the body is under the loss mask.  Turns
    are ordered by turn (null first), role, then body; repeated rows are turns
    of their own, a null role is an empty one, a null conversation is one.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>")) if parts_col \
        else text_parts(F.col(text_col))
    head = F.concat(F.lit(OPEN), _escape_name(F.coalesce(F.col("role"), F.lit(""))),
                    F.lit(CLOSE))
    rows = (messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                            F.col(role_col).alias("role"), parts.alias("parts"))
            .withColumn("body", _visit(F.col("parts")))
            .withColumn("attached", _attachments(F.col("parts"))).drop("parts")
            .withColumn("block", F.floor(F.col("turn") / TURN_BLOCK))
            .withColumn("head", head)
            .withColumn("n_head", F.length("head").cast("bigint"))
            .withColumn("n_body", F.length("body").cast("bigint"))
            .withColumn("size", F.col("n_head") + F.col("n_body") + len(END)))
    in_block = Window.partitionBy("conv", "block").orderBy("turn", "role", "body")
    rows = (rows.withColumn("nth", F.row_number().over(in_block))
            .withColumn("till", F.sum("size").over(in_block.rowsBetween(
                Window.unboundedPreceding, Window.currentRow))))
    blocks = rows.groupBy("conv", "block").agg(
        F.sum("size").alias("size"),
        F.sort_array(F.collect_list(F.struct(
            "nth", "till", "size", "n_head", "n_body", "head", "body", "attached",
            (F.coalesce(F.col("role"), F.lit("")) == LOSS_ROLE).alias("loss")))).alias("all"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    blocks = blocks.withColumn("base", base).select(
        "conv", "block",
        F.array_join(F.transform("all", lambda t: F.concat(t["head"], t["body"], F.lit(END))),
                     "").alias("text"),
        F.transform("all", lambda t: F.struct(
            (F.col("base") + t["till"] - t["size"]).alias("begin"),
            (F.col("base") + t["till"] - t["n_body"] - len(END)).alias("start"),
            (F.col("base") + t["till"] - len(END)).alias("end"),
            t["loss"].alias("loss"))).alias("turns"),
        F.flatten(F.transform("all", lambda t: t["attached"])).alias("attached"))
    whole = blocks.groupBy("conv").agg(F.sort_array(F.collect_list(
        F.struct("block", "text", "turns", "attached"))).alias("b"))
    return whole.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.col("b.text"), "").alias("formatted"),
        F.flatten("b.turns").alias("turns"),
        F.flatten("b.attached").alias("attachments")).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"),
                                         lambda s, a: s + a["tokens"]))


def _texts(body: Column) -> Column:
    """The texts of a body, without its placeholders."""
    return unescape(F.regexp_replace(body, PLACEHOLDER, ""))


def _parts(body: Column) -> Column:
    """Parts of a body: ``(kind, ordinal, text)``.

    Texts have no ordinal, attachments no text; neighbouring texts are one.
    """
    def part(kind: Column, ordinal: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), ordinal.cast("int").alias("ordinal"), text.alias("text"))

    def of(piece: Column, i: Column) -> Column:
        close = F.position(F.lit(CLOSE), piece)
        name = F.substring(piece, F.lit(len("part ") + 1), close - len("part ") - 1)
        kind = F.regexp_replace(name, " [0-9]+$", "")
        none = F.lit(None).cast("string")
        text = lambda t: part(F.lit("text"), none, unescape(t))
        return F.when(i == 0, F.array(text(piece))).otherwise(F.array(
            part(unescape(kind), F.regexp_extract(name, "([0-9]+)$", 1), none),
            text(F.substring(piece, close + 1, F.length(piece)))))

    every = F.flatten(F.transform(F.split(body, "<"), of))
    return F.filter(every, lambda p: p["ordinal"].isNotNull() | (p["text"] != ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``read``: array of ``(role, text, loss_text, parts)`` taken from ``formatted``.

    Roles, texts and parts are parsed from the markup; ``text`` is all text of the turn
    without its placeholders, ``parts`` has both in order.  ``loss_text`` is the text that
    lies at the code points of the loss mask, unescaped (null outside the mask).
    """
    pieces = F.split("formatted", END)

    def one(p: Column, m: Column) -> Column:
        close = F.position(F.lit(CLOSE), p)
        body = F.substring(p, close + 1, F.length(p))
        return F.struct(
            unescape(F.substring(p, F.lit(len(OPEN) + 1), close - len(OPEN) - 1)).alias("role"),
            _texts(body).alias("text"),
            F.when(m["loss"], _texts(F.substring(
                p, (m["start"] - m["begin"] + 1).cast("int"),
                (m["end"] - m["start"]).cast("int")))).alias("loss_text"),
            _parts(body).alias("parts"))

    split = formatted.withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    return split.withColumn("read", F.zip_with("pieces", "turns", one)).drop("pieces")
