"""Chat formatting: typed content parts become one training string per conversation.

A turn's content is an array of parts ``(kind, text, ref, units)``. Text parts are written out; image, audio
and document parts become placeholders in their place, and their references and token counts are recorded.
Everything is built-in Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
#: Tokens that one unit of a medium expands to: an image tile, a second of audio, a document page.
TOKENS_PER_UNIT = {"image": 576, "audio": 25, "document": 1024}
PARTS_TYPE = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def text_part(text: Column) -> Column:
    """Content of a turn that is plain text."""
    part = F.struct(
        F.lit("text").alias("kind"), text.alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part).cast(PARTS_TYPE)


def escape(text: Column) -> Column:
    """Every control string begins with ``<|`` and a letter, so one more bar after ``<|`` hides it."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _is_medium(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*TOKENS_PER_UNIT), F.lit(False))


def _written(parts: Column) -> Column:
    """The parts in order, texts escaped as if those between two placeholders were one: no control string forms where parts meet."""
    shown = F.filter(parts, lambda p: _is_medium(p) | (F.coalesce(p["text"], F.lit("")) != ""))

    def one(part: Column, i: Column) -> Column:
        before = F.get(shown, i - 1)
        opened = F.coalesce(~_is_medium(before) & F.endswith(before["text"], F.lit("<")) & F.startswith(part["text"], F.lit("|")), F.lit(False))
        text = F.concat(F.when(opened, "|").otherwise(""), escape(part["text"]))
        return F.when(_is_medium(part), F.concat(F.lit("<|"), part["kind"], F.lit("|>"))).otherwise(text)

    return F.array_join(F.transform(shown, one), "")


def _attachment(part: Column, turn_no: Column, tokens_per_unit: dict[str, int]) -> Column:
    units = F.coalesce(part["units"], F.lit(1).cast("bigint"))
    rate = F.coalesce(*[F.when(part["kind"] == kind, F.lit(n).cast("bigint")) for kind, n in tokens_per_unit.items()])
    return F.struct(
        turn_no.alias("turn_no"), part["kind"].alias("kind"), part["ref"].alias("ref"), units.alias("units"),
        (units * rate).alias("tokens"),
    )


def format_conversations(
    turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), tokens_per_unit: dict[str, int] = TOKENS_PER_UNIT
) -> DataFrame:
    """One row per conversation from ``conv_id, turn, role, parts``: the formatted text and what it holds.

    Returns ``conv_id, n_turns, formatted, loss_spans, attachments, expanded_tokens``. Loss spans are code point
    ranges (end exclusive) of the texts of ``loss_roles``; attachments are in order of their placeholders.
    Rows go by turn (null first), then role, then content, so ties have a fixed order and repeated rows all stay.
    Null roles and texts count as empty, null parts as none, other kinds as text, missing units as one. Null
    conversation ids form one conversation. Other columns are ignored; no rows give no rows.
    """
    parts = F.filter(F.coalesce("parts", F.array().cast(PARTS_TYPE)), lambda p: p.isNotNull())
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit(NEWLINE))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"),
        F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
        _written(parts).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body", F.to_json("parts"))
    size = F.length("head") + F.length("body") + F.lit(len(END) + 1)
    placed = rows.select(
        "*",
        F.row_number().over(order).alias("turn_no"),
        F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )
    media = F.filter("parts", _is_medium)
    begin = (F.col("start") + F.length("head")).cast("bigint")
    span = F.struct(begin.alias("start"), (begin + F.length("body")).cast("bigint").alias("end"))
    one = F.struct(
        "turn_no",
        F.concat("head", "body", F.lit(f"{END}\n")).alias("written"),
        F.when(F.col("role").isin(*loss_roles), span).alias("loss"),
        F.transform(media, lambda p: _attachment(p, F.col("turn_no"), tokens_per_unit)).alias("media"),
    )
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("all"))
    attachments = F.flatten(F.col("all.media"))
    return whole.select(
        "conv_id",
        F.size("all").cast("bigint").alias("n_turns"),
        F.array_join(F.col("all.written"), "").alias("formatted"),
        F.filter(F.col("all.loss"), lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of ``(role, text)``; placeholders stay as they are written."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        role = unescape(F.replace(F.substring(piece, F.lit(1), line - 1), F.lit(NEWLINE), F.lit("\n")))
        body = F.substring(piece, line + 1, F.length(piece) - line - F.lit(len(END) + 1))
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def read_loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order and with nothing between."""
    texts = F.transform(
        loss_spans,
        lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return F.array_join(texts, "")
