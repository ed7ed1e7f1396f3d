"""Operator 2, chat formatting with a grammar round trip.

Grammar of a formatted conversation (``<|`` never occurs inside role or text):

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

Each conversation is rendered as it is, parsed again, and compared with its source
turns.  Where they differ the conflicting conversation is rendered with escapes and
parsed and compared once more.  The escape inserts a backslash into every ``<``,
backslashes, ``|`` sequence, so it can always be undone and leaves no ``<|``; one
escape round therefore makes the round trip exact.  In a role, a line break becomes
``<n|``.  Only DataFrame expressions are used.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let

START, END = "<|im_start|>", "<|im_end|>\n"


def escape_text(s: Column) -> Column:
    return F.regexp_replace(s, r"<(\\*)\|", r"<\\$1|")


def unescape_text(s: Column) -> Column:
    return F.regexp_replace(s, r"<\\(\\*)\|", r"<$1|")


def escape_role(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"<(\\*)(n?)\|", r"<\\$1$2|"), "\n", "<n|")


def unescape_role(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"<n\|", "\n"), r"<\\(\\*)(n?)\|", r"<$1$2|")


def render(turns: Column, escaped: bool) -> Column:
    """Text of a conversation from its array of (role, text)."""
    role, text = (escape_role, escape_text) if escaped else ((lambda s: s), (lambda s: s))
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), role(t["role"]), F.lit("\n"), text(t["text"]), F.lit(END))), "")


def segments(formatted: Column) -> Column:
    """The raw turns of a formatted conversation, without their start marks."""
    return let(F.split(formatted, r"<\|im_start\|>"), lambda p: F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))))


def parse(formatted: Column) -> Column:
    """Array of (role, text): what the grammar reads back; nulls for a turn that breaks it."""
    def turn(seg: Column) -> Column:
        role = F.substring_index(seg, "\n", 1)
        body = F.substring(seg, F.length(role) + 2, F.length(seg))
        text = F.substring(body, F.lit(1), F.length(body) - len(END))
        sound = seg.contains("\n") & seg.endswith(END) & ~role.contains("<|") & ~text.contains("<|")
        return F.struct(F.when(sound, unescape_role(role)).alias("role"),
                        F.when(sound, unescape_text(text)).alias("text"))
    return F.transform(segments(formatted), turn)


def _same(parsed: Column, turns: Column) -> Column:
    """Whether the parser recovered exactly the source turns."""
    def pairs(turns: Column) -> Column:
        return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(pairs(parsed) == pairs(turns), F.lit(False))


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans``, ``escape_rounds`` (0 or 1), ``round_trip``.

    A loss span is (turn, start, offset, chars): the turn's index, the span's first code
    point in the conversation and in its turn, and its length.

    Turns go by turn number; equal numbers by role, then text; a repeated row is a turn of
    its own and a null turn number comes first.  Null role or text: empty.  Rows with a
    null conversation id form one conversation.  Other columns are not read.  A formatted
    conversation is one value, so its turns meet in one task; they arrive as rows, never
    as pairs, and all work on them is linear.  Empty table: no rows.
    """
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(W.unboundedPreceding, -1)

    def place(role: Column, text: Column) -> Column:
        header = (F.length(role) + len(START) + 1).cast("long")
        chars = F.length(text).cast("long")
        at = F.coalesce(F.sum(header + chars + len(END)).over(before), F.lit(0))
        return F.struct((at + header).alias("start"), header.alias("offset"), chars.alias("chars"))

    placed = rows.select("*", (F.row_number().over(order) - 1).alias("no"),
                         place(F.col("role"), F.col("text")).alias("as_is"),
                         place(escape_role(F.col("role")), escape_text(F.col("text"))).alias("escaped"))
    grouped = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("no", "role", "text", "as_is", "escaped"))).alias("turns"))
    plain = grouped.select("*", render(F.col("turns"), False).alias("plain"))
    tried = plain.select("*", _same(parse(F.col("plain")), F.col("turns")).alias("fits"))
    done = tried.select(
        "conv_id", "turns", "fits",
        F.when(F.col("fits"), F.col("plain")).otherwise(render(F.col("turns"), True)).alias("formatted"))

    def span(t: Column) -> Column:
        at = F.when(F.col("fits"), t["as_is"]).otherwise(t["escaped"])
        return F.struct(t["no"].alias("turn"), at["start"].alias("start"), at["offset"].alias("offset"),
                        at["chars"].alias("chars"))

    return done.select(
        "conv_id", "formatted",
        F.transform(F.filter("turns", lambda t: t["role"] == trained_role), span).alias("loss_spans"),
        F.when(F.col("fits"), 0).otherwise(1).alias("escape_rounds"),
        _same(parse(F.col("formatted")), F.col("turns")).alias("round_trip"))


def masked_text(formatted: Column, spans: Column) -> Column:
    """Unescaped text under the mask, once and in order, nothing between."""
    return let(segments(formatted), lambda segs: F.array_join(F.transform(spans, lambda p: unescape_text(F.substring(
        F.get(segs, p["turn"]), (p["offset"] - len(START) + 1).cast("int"), p["chars"].cast("int")))), ""))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from the output alone."""
    read = formatted.select("conv_id", "formatted", "escape_rounds", "round_trip",
                            parse(F.col("formatted")).alias("parsed"),
                            masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("parsed", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "escape_rounds", "round_trip")
