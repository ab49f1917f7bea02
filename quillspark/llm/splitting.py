"""Splitting oversized texts at natural boundaries with bounded-quantifier regular expressions.

One pattern cuts a whole text: its alternatives, from the strongest boundary to none, each take as many
characters as the limit lets them; the last takes the limit itself. Offsets into the text before a piece
supply its overlap. Everything is an SQL string or array function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: an estimated token is this many code points, rounded down.
CHARS = 4
#: What a piece may end with, strongest first: a paragraph before a heading, a paragraph, a list item or
#: table row or any line, a sentence, a clause, a word.
BOUNDARIES = [
    r"\R(?=#{1,6} |\\(?:sub)*section)",
    r"\R[ \t]*\R\s*",
    r"\R",
    r"[.!?][\"'”’)\]]*\s+|[。！？]",
    r"[;:,]\s+|[；：，、]",
    r"\s+",
]


def estimate(text: Column) -> Column:
    return F.floor(F.length(text) / CHARS)


def cut_pattern(limit: int, share: float = 0.5) -> str:
    """Pieces of `limit` code points at most. A boundary counts if it leaves a piece of at least `share` of the
    limit, so that a strong boundary near the start doesn't win over a weaker one near the end."""
    least = max(1, int(limit * share))
    whole = rf"(?s:.{{1,{limit}}})\z"
    ends = "|".join(_ended(b, least, limit) for b in BOUNDARIES)
    return rf"{whole}|{ends}|(?s:.{{1,{limit}}})"


#: The most characters that a boundary takes: two line ends of two characters with two blanks between, and four
#: blanks after them.
ROOM = 10


def _ended(boundary: str, least: int, limit: int) -> str:
    """The longest run that a boundary follows, boundary included, for which the run leaves ROOM."""
    room = ROOM
    return rf"(?s:.{{{max(1, least - room)},{limit - room}}})(?:{boundary.replace(r'\s*', r'\s{0,4}').replace(r'\s+', r'\s{1,4}').replace('[ \\t]*', '[ \\t]{0,2}').replace(']*', ']{0,2}')})"


def split_texts(df: DataFrame, text: str, limit: int = 2048, overlap: int = 128) -> DataFrame:
    """df with one row for each piece: piece (from 1), piece_text, piece_start and core_start (offsets in code
    points, from 0), piece_tokens, lines_before and lines_within (line feeds before and inside the piece).

    Texts of at most `limit` estimated tokens come out as one piece. Each later piece begins with up to
    `overlap` estimated tokens from the end of the one before, from a sentence or word start where there is
    one. Without their overlaps the pieces are the text, character by character. A null or empty text gives no
    row. Columns of df that are named like the new ones are replaced.
    """
    back = overlap * CHARS + CHARS - 1
    core = limit * CHARS + CHARS - 1 - back
    t = F.col(text)
    fits = F.length(t) <= limit * CHARS + CHARS - 1
    cores = F.when(fits, F.array(t)).otherwise(F.regexp_extract_all(t, F.lit(cut_pattern(core)), F.lit(0)))
    new = ["piece", "piece_text", "piece_start", "core_start", "piece_tokens", "lines_before", "lines_within"]
    rows = df.drop(*[c for c in new if c != text]).where(F.length(t) > 0).withColumn("_cores", cores)
    starts = F.aggregate(
        F.transform("_cores", lambda c: F.length(c)), F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    )
    rows = rows.withColumn("_starts", starts)
    tail = F.when(F.col("_i") == 0, F.lit("")).otherwise(_lookback(F.right(F.get(F.col("_cores"), F.col("_i") - 1), F.lit(back))))
    out = (
        rows.select("*", F.posexplode("_cores").alias("_i", "_core"))
        .withColumn("_tail", tail)
        .withColumn("core_start", F.get("_starts", F.col("_i")))
        .withColumn("piece", F.col("_i") + 1)
        .withColumn("piece_start", F.col("core_start") - F.length("_tail"))
        .withColumn("piece_text", F.concat("_tail", "_core"))
        .withColumn("piece_tokens", estimate(F.col("piece_text")).cast("int"))
        .withColumn("lines_before", _line_feeds(F.substring(t, F.lit(1), F.col("piece_start"))))
        .withColumn("lines_within", _line_feeds(F.regexp_replace(F.col("piece_text"), r"\n+\z", "")))
    )
    return out.drop("_cores", "_starts", "_i", "_core", "_tail")


def _line_feeds(x: Column) -> Column:
    return (F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))).cast("int")


def _lookback(tail: Column) -> Column:
    """The longest end of tail that begins a sentence or line, else a word, else all of it."""
    sentence = F.regexp_extract(tail, r"(?s)(?:\R|[.!?][\"'”’)\]]{0,2}\s|[。！？])\s{0,4}(\S.*)\z", 1)
    word = F.regexp_extract(tail, r"(?s)\s(\S.*)\z", 1)
    return F.when(F.length(sentence) > 0, sentence).when(F.length(word) > 0, word).otherwise(tail)


def split_segments(segments: DataFrame, limit: int = 2048, overlap: int = 128) -> DataFrame:
    """The pieces of every oversized segment: seg_uid, cite_key, id, section_id, piece, piece_text,
    source_lines, token_estimate.

    Only the last row of each (cite_key, id) counts, by updated_at (a null is the earliest) and then seg_uid;
    which row that is gets decided without moving bodies. The stored estimate is ignored. source_lines are the
    piece's own first and last line, null where the segment's are missing. Null bodies are no cases.
    """
    keyed = segments.select("cite_key", "id", F.struct("updated_at", "seg_uid").alias("_at"), (F.coalesce(estimate(F.col("body")), F.lit(0)) > limit).alias("_big"))
    last = keyed.groupBy("cite_key", "id").agg(F.max(F.struct("_at", "_big")).alias("_last")).where("_last._big").select(F.col("_last._at.seg_uid").alias("seg_uid"))
    big = segments.where(estimate(F.col("body")) > limit).join(last, "seg_uid", "left_semi").select("seg_uid", "cite_key", "id", "section_id", "source_lines", "body")
    pieces = split_texts(big, "body", limit, overlap)
    first = F.when(F.size("source_lines") > 0, F.get("source_lines", F.lit(0))) + F.col("lines_before")
    return pieces.select(
        "seg_uid", "cite_key", "id", "section_id", "piece", "piece_text", F.when(first.isNotNull(), F.array(first, first + F.col("lines_within"))).alias("source_lines"), F.col("piece_tokens").alias("token_estimate")
    )
