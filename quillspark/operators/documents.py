"""Operators from a document's text to rows: lines, headings, blocks, tables, front matter, environments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import clean_text

#: Words of an introduction's paragraphs by class, the first class that fits wins.
BLOCK_RULES = [
    ("CONTRIBUTION", ["we propose", "we introduce", "our contribution", "in this paper, we"]),
    ("GAP", ["however", "limitation", "gap", "missing", "fails to", "lack of"]),
    ("PRIOR_WORK", ["previous work", "prior work", "has been studied", "et al."]),
    ("MOTIVATION", ["motivated by", "challenge", "difficulty", "problem of"]),
    ("ROADMAP", ["the rest of this paper", "section", "organized as follows", "outline"]),
]


def first_rule(text: Column, rules: list[tuple[str, list[str]]], other: str) -> Column:
    """The name of the first rule one of whose words the text holds, as one CASE."""
    low = F.lower(text)
    out = None
    for name, words in rules:
        hit = low.contains(words[0])
        for w in words[1:]:
            hit = hit | low.contains(w)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


def with_lines(docs: DataFrame, key: str, text: str | Column) -> DataFrame:
    """key, _lines of each document. The array comes out of a generator, through which no optimizer rule copies it:
    inside a lambda a plain expression would split the text again for every element."""
    return docs.select(key, F.explode(F.array(F.split(F.col(text) if isinstance(text, str) else text, "\r?\n"))).alias("_lines"))


def numbers(array: str) -> Column:
    """The positions of an array, from 1; empty for an empty one."""
    return F.when(F.size(array) > 0, F.sequence(F.lit(1), F.size(array))).otherwise(F.array().cast("array<int>"))


def runs_of(flags: str) -> Column:
    """array<struct<first, last>> of the runs of true elements of an array, positions from 1; linear, no shuffle."""
    at = lambda i: F.coalesce(F.get(F.col(flags), i), F.lit(False))
    starts = F.filter(numbers(flags), lambda i: at(i - 1) & ~F.when(i >= 2, at(i - 2)).otherwise(False))
    ends = F.filter(numbers(flags), lambda i: at(i - 1) & ~at(i))
    return F.transform(F.arrays_zip(starts.alias("first"), ends.alias("last")), lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last")))


def sections(docs: DataFrame, key: str, text: str | Column) -> DataFrame:
    """key, heading, first_line, last_line, body (array of its lines) of every section; what stands before the first
    heading has a null heading. A document stays in its row until it is cut, so nothing is shuffled."""
    heads = F.filter(numbers("_lines"), lambda i: F.get(F.col("_lines"), i - 1).rlike("^#{1,6} "))
    starts = with_lines(docs, key, text).select(key, "_lines", F.explode(F.array(heads)).alias("_h"))
    firsts = F.when(F.coalesce(F.get("_h", F.lit(0)), F.lit(0)) == 1, F.col("_h")).otherwise(F.concat(F.array(F.lit(1)), F.col("_h")))
    starts = starts.select(key, "_lines", F.explode(F.array(firsts)).alias("_f"))
    last = lambda k: F.coalesce(F.get("_f", k + 1) - 1, F.size("_lines"))
    cut_up = F.transform("_f", lambda at, k: F.struct(at.alias("first_line"), last(k).alias("last_line"), F.slice("_lines", at, last(k) - at + 1).alias("body")))
    head = F.get("_s.body", F.lit(0))
    return starts.select(key, F.explode(cut_up).alias("_s")).select(
        key, F.when(head.rlike("^#{1,6} "), F.regexp_extract(head, r"^#{1,6} +(.*?)[ \r]*$", 1)).alias("heading"), "_s.first_line", "_s.last_line", "_s.body"
    )


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 1), line."""
    return docs.select(key, F.posexplode(F.split(F.col(text), "\r?\n")).alias("_p", "line")).select(key, (F.col("_p") + 1).alias("line_no"), "line")


def headed_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """lines with the heading they stand under, null before the first."""
    return sections(docs, key, text).select(key, "heading", "first_line", F.posexplode("body").alias("_p", "line")).select(key, (F.col("first_line") + F.col("_p")).alias("line_no"), "line", "heading")


def section_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, heading, first_line, last_line of every headed section."""
    return sections(docs, key, text).where("heading IS NOT NULL").select(key, "heading", "first_line", "last_line")


def short_line_runs(docs: DataFrame, key: str, text: str, longest: int = 30, least: int = 3) -> DataFrame:
    """key, first_line, n of runs of at least `least` short non-blank lines."""
    short = F.transform("_lines", lambda x: (F.length(F.trim(x)) > 0) & (F.length(F.trim(x)) < longest))
    flagged = with_lines(docs, key, text).select(key, F.explode(F.array(short)).alias("_flags"))
    runs = flagged.select(key, F.explode(runs_of("_flags")).alias("_r")).select(key, F.col("_r.first").alias("first_line"), (F.col("_r.last") - F.col("_r.first") + 1).cast("long").alias("n"))
    return runs.where(F.col("n") >= least)


def document_metrics(text: Column) -> list[Column]:
    """Sections, words, display equations, balance of dollar signs and the estimate of tokens."""
    return [
        F.size(F.filter(F.split(text, "\r?\n"), lambda x: x.rlike("^## ") & ~x.rlike("^###"))).alias("sections"), F.size(F.filter(F.split(text, r"[ \t\r\n]+"), lambda x: x != "")).alias("words"), F.floor(F.regexp_count(text, F.lit(r"\$\$")) / 2).alias("equations"),
        ((F.regexp_count(text, F.lit(r"\$\$")) % 2 == 0) & (F.regexp_count(F.regexp_replace(text, r"\$\$", ""), F.lit(r"\$")) % 2 == 0)).alias("balanced"), F.floor(F.length(text) / 4).alias("token_estimate"),
    ]


def table_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, table_no (from 1), row_no (the header is 0), line_no, cells, header of every pipe table; a table is a run
    of lines between bars. Short rows are padded to the header's width and longer ones cut; rules aren't rows."""
    piped = F.transform("_lines", lambda x: x.rlike(r"^\s*\|.*\|\s*$"))
    flagged = with_lines(docs, key, text).select(key, "_lines", F.explode(F.array(piped)).alias("_flags"))
    blocks = F.transform(runs_of("_flags"), lambda r: F.struct(r["first"].alias("first"), F.slice("_lines", r["first"], r["last"] - r["first"] + 1).alias("rows")))
    tables = flagged.select(key, F.posexplode(blocks).alias("_t", "_b"))
    split_row = lambda x: F.transform(F.split(F.regexp_replace(F.trim(x), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = tables.select(key, (F.col("_t") + 1).alias("table_no"), F.col("_b.first").alias("_first"), F.explode(F.array(split_row(F.get("_b.rows", F.lit(0))))).alias("header"), F.col("_b.rows").alias("_rows"))
    rows = rows.select(key, "table_no", "_first", "header", F.posexplode("_rows").alias("row_no", "_line")).where(~F.col("_line").rlike(r"^[\s|:\-]+$"))
    cells = split_row(F.col("_line"))
    padded = F.slice(F.concat(cells, F.array_repeat(F.lit(""), F.greatest(F.size("header") - F.size(cells), F.lit(0)))), F.lit(1), F.size("header"))
    return rows.select(key, "table_no", "row_no", (F.col("_first") + F.col("row_no")).alias("line_no"), padded.alias("cells"), "header")


def table_cells(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no, cells of the body rows of pipe tables; short rows are padded to the header's width."""
    return table_rows(docs, key, text).where("row_no > 0").select(key, "line_no", "cells")


def front_matter(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, field, value of the scalar fields between the opening and the closing rule."""
    head = F.regexp_extract(text, r"(?s)^---\r?\n(.*?)\r?\n---", 1)
    pairs = docs.select(key, F.explode(F.split(head, "\r?\n")).alias("_l")).where(F.col("_l").rlike(r"^[A-Za-z_]+:"))
    return pairs.select(key, F.regexp_extract("_l", "^([A-Za-z_]+):", 1).alias("field"), F.trim(F.regexp_replace(F.regexp_extract("_l", "^[A-Za-z_]+:(.*)$", 1), "[ \t]+", " ")).alias("value"))


def environments(docs: DataFrame, key: str, text: str, names: list[str]) -> DataFrame:
    """key, ordinal (from 1, in order of place), statement of the LaTeX environments of these names."""
    pattern = rf"(?s)\\begin\{{(?:{'|'.join(names)})\}}(.*?)\\end\{{(?:{'|'.join(names)})\}}"
    found = docs.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("_p", "_s"))
    return found.select(key, (F.col("_p") + 1).alias("ordinal"), clean_text(F.col("_s")).alias("statement"))


def labelled_equations(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, number, label of equation labels in order of place."""
    found = docs.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(r"\\label\{(eq:[A-Za-z0-9_]+)\}"), F.lit(1))).alias("_p", "label"))
    return found.select(key, (F.col("_p") + 1).alias("number"), "label")


def cited_keys(docs: DataFrame, key: str, text: str, pattern: str = r"\\cite\{([A-Za-z0-9_]+)\}|\[\[([a-z0-9_]+)") -> DataFrame:
    """key, target, n of citations and wiki links."""
    found = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    return docs.select(key, F.explode(F.filter(F.concat(found(1), found(2)), lambda t: t != "")).alias("target")).groupBy(key, "target").agg(F.count(F.lit(1)).alias("n"))


def prefix_distinct(docs: DataFrame, key: str, text: str, width: int = 120) -> DataFrame:
    """The first key of each collapsed lower-case prefix; blank texts are dropped. The prefix is the operator's
    own key, as descriptions of gaps are compared."""
    mark = F.substring(F.lower(clean_text(F.col(text))), 1, width)
    return docs.select(key, mark.alias("mark")).where("mark != ''").groupBy("mark").agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n"))


def packed_paragraphs(text: Column, most: int) -> Column:
    """Paragraphs joined greedily into segments of at most `most` bytes; a longer paragraph stands alone."""
    parts = F.filter(F.split(text, "\r?\n[ \t]*\r?\n"), lambda p: F.trim(p) != "")
    joined = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, p: F.when((F.size(acc) > 0) & (F.octet_length(F.element_at(acc, -1)) + 2 + F.octet_length(p) <= most), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(F.element_at(acc, -1), F.lit("\n\n"), p)))).otherwise(F.concat(acc, F.array(p))),
    )
    return joined
