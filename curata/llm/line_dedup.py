"""Operator 12, line dedup: explode normalised lines, hash, count distinct documents per hash,
drop lines over the threshold, reassemble by position.

Only numbers travel: a row is named by a 128-bit hash of its id and text, a key by one of
the line, so equal rows (which get equal results) share their work.  A row's keys are made
distinct before they are counted, the count is pre-aggregated by Spark, and only keys over
the threshold meet their lines again; that join has plain exchanges on both sides, so a key
found in a third of all documents is split by AQE.  The positions to drop come back to the
text by the row's hash, and the other lines are joined in order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text in order; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _digest(*parts: Column) -> Column:
    """128 bits in two longs, from two seeds."""
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def _long_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, row, pos, h): every line whose key is long enough to count."""
    # a shorter line cannot have a longer key: most of a text is never normalised
    lines = rows.select("id", "row", F.posexplode(lines_of(F.col("text"))).alias("pos", "line")) \
        .filter(F.length("line") >= min_chars)
    return lines.select("id", "row", "pos", line_key(F.col("line")).alias("key")) \
        .filter(F.length("key") >= min_chars).select("id", "row", "pos", _digest(F.col("key")).alias("h"))


def common_lines(df: DataFrame, min_chars: int = 40, min_documents: int = 5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(h, documents, keeper): keys found in ``min_documents`` ids or more, and the largest of these."""
    return _common(_rows(df, id_col, text_col), min_chars, min_documents)


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.withColumn("row", _digest(F.col("id"), F.col("text")))


def _common(rows: DataFrame, min_chars: int, min_documents: int) -> DataFrame:
    held = _long_lines(rows, min_chars).filter(F.col("id").isNotNull()).select("h", "id").distinct()
    return held.groupBy("h").agg(F.count(F.lit(1)).alias("documents"), F.max("id").alias("keeper")) \
        .filter(F.col("documents") >= min_documents)


def dedup_lines(df: DataFrame, min_chars: int = 40, min_documents: int = 5, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, text), one row per input row: the text without its common lines.

    A key of ``min_chars`` code points or more that ``min_documents`` different ids hold loses
    all its lines, in every row but those of the largest such id (which keep all of theirs).
    Null and empty texts are one empty line.  A row with a null id counts as no document and
    keeps no common line; rows of one id are one document.  Repeated rows are treated alike.
    Very long texts are taken whole.  A text that loses all lines is empty.  Other columns are
    not read.  Empty table: no rows.
    """
    rows = _rows(df, id_col, text_col)
    common = materialize(_common(rows, min_chars, min_documents).select("h", "keeper"), "common-lines")
    found = _long_lines(rows, min_chars).join(common, "h").filter(~F.col("id").eqNullSafe(F.col("keeper")))
    drop = found.groupBy("row").agg(F.collect_set("pos").alias("drop"))
    out = rows.join(drop, "row", "left").select("id", lines_of(F.col("text")).alias("lines"), "drop")
    # positions that stay, in order: a hash lookup per line, however many lines a text has
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    return out.select(
        F.col("id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
            F.transform(stay, lambda i: F.get("lines", i))), "\n").alias("text"))
