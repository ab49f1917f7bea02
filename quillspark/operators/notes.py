"""Operators on Markdown notes: front matter, blocks under headings, bullets, sentences, keywords, pages, demotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import clean_text
from quillspark.operators.documents import sections

#: Words that are no tokens of a claim.
CLAIM_STOP_WORDS = "a an and are as at be by for from in is it of on or that the to was were with".split()
#: Marks of a translator that failed.
ARTIFACTS = ["TRANSLATION_ERROR", "[[untranslated]]", "???", "\ufffd"]


def without_front_matter(text: Column) -> Column:
    """The text after the closing rule of its front matter; the whole text without one."""
    return F.regexp_replace(text, r"(?s)\A---\r?\n.*?\r?\n---[ \t]*(?:\r?\n|\z)", "")


def block_under(docs: DataFrame, key: str, text: str, heading: str) -> DataFrame:
    """key, block of the lines under the first heading of that wording, in any case, to the next heading."""
    found = sections(docs, key, text).where(F.lower(F.trim("heading")) == heading.lower())
    first = found.groupBy(key).agg(F.min_by(F.slice("body", F.lit(2), F.greatest(F.size("body") - 1, F.lit(0))), "first_line").alias("_b"))
    return first.select(key, F.array_join("_b", "\n").alias("block"))


def bullets(text: Column, least: int = 12) -> Column:
    """Cleaned texts of the bulleted lines, without outer stars, of `least` characters at least."""
    found = F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]*[-*+][ \t]+(\S[^\r\n]*)"), F.lit(1))
    plain = F.transform(found, lambda x: F.trim(F.regexp_replace(clean_text(x), r"^\*+|\*+$", "")))
    return F.filter(plain, lambda x: F.length(x) >= least)


def sentences_about(text: Column, words: list[str], most: int | None = 8) -> Column:
    """Sentences of 20 to 320 characters one of whose tokens is among the words, the first `most`."""
    said = F.transform(F.split(clean_text(text), r"(?<=[.!?])\s+"), lambda s: F.trim(s))
    tokens = lambda s: F.regexp_extract_all(F.lower(s), F.lit(r"[a-z0-9]+(?:-[a-z0-9]+)?"), F.lit(0))
    hits = F.filter(said, lambda s: F.length(s).between(20, 320) & F.arrays_overlap(tokens(s), F.array(*map(F.lit, words))))
    return hits if most is None else F.slice(hits, 1, most)


def distinct_claims(items: Column, most: int | None = 24) -> Column:
    """Cleaned items, each at its first place whatever its case, the first `most`."""
    plain = F.filter(F.transform(items, clean_text), lambda x: x != "")
    keys = F.transform(plain, lambda x: F.lower(x))
    kept = F.filter(F.transform(F.arrays_zip(plain.alias("v"), keys.alias("k")), lambda z, i: F.when(F.array_position(keys, z["k"]) == i + 1, z["v"])), lambda x: x.isNotNull())
    return kept if most is None else F.slice(kept, 1, most)


def plain_claim(text: Column) -> Column:
    """A claim for comparison: cleaned, in lower case, without marks of emphasis and closing punctuation."""
    return F.regexp_replace(F.regexp_replace(F.lower(clean_text(text)), r"[`*_]", ""), r"[ .;:,!?]+$", "")


def claim_tokens(text: Column) -> Column:
    """Distinct words of more than two letters or digits that aren't stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) > 2) & ~w.isin(CLAIM_STOP_WORDS)))


def author_keywords(text: Column) -> Column:
    """The keywords that a text gives in its first keyword line, split at semicolons, commas and middle dots."""
    raw = F.regexp_extract(text, r"(?i)(?:^|\n)\s*\*{0,2}(?:Key\s*words?|KEYWORDS?)\s*\*{0,2}\s*[:\-—]\s*([^\n]+)", 1)
    parts = F.split(F.regexp_replace(F.trim(raw), r"\.+$", ""), "[;,·]")
    return F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(F.trim(x), r"^\*+|\*+$", ""))), lambda x: x != "")


def unspaced_title(title: Column, index: Column) -> Column:
    """A title whose letters stand apart, joined; page_chunk_ and the index if less than two letters are left."""
    joined = F.trim(F.regexp_replace(title, r"(?U)(\b\w) (?=\w)", "$1"))
    spaced = title.rlike(r"(?U)(?:\b\w\s){4,}")
    return F.when(spaced & (F.length(joined) >= 2), joined).when(spaced, F.concat(F.lit("page_chunk_"), index.cast("string"))).otherwise(title)


def source_pages(text: Column, index: Column, per_group: int, total: Column) -> Column:
    """The pages that a comment names, in either order, else those of the group by its index."""
    at = lambda g: F.regexp_extract(text, r"<!--\s*pages:\s*(\d+)\s*-\s*(\d+)\s*-->", g).try_cast("int")
    start = (index - 1) * per_group + 1
    end = F.greatest(start, F.when(total > 0, F.least(start + per_group - 1, total)).otherwise(start + per_group - 1))
    return F.when(at(1).isNotNull(), F.sequence(F.least(at(1), at(2)), F.greatest(at(1), at(2)))).otherwise(F.sequence(start.cast("int"), end.cast("int")))


def demoted(text: Column) -> Column:
    """Headings of the second level one level lower."""
    return F.regexp_replace(text, r"(?m)^## (?=\S)", "### ")


def with_section(text: Column, heading: str, block: Column) -> Column:
    """text with the block under a second-level heading replaced, or put at the end."""
    whole = F.concat(F.lit(f"## {heading}\n\n"), F.trim(block), F.lit("\n"))
    there = text.rlike(rf"(?m)^## {heading}[ \t]*$")
    # a mark takes the section's place first, so that no character of the block has a meaning in the pattern
    marked = F.regexp_replace(text, rf"(?s)(\A|(?<=\n))## {heading}[ \t]*(?:\r?\n.*?)?(?=\n## |\z)", "\u0001")
    return F.when(there, F.replace(marked, F.lit("\u0001"), whole)).otherwise(F.concat(F.regexp_replace(text, r"\s+\z", ""), F.lit("\n\n"), whole))


def badly_translated(text: Column) -> Column:
    """Whether a text holds a mark of a translator that failed."""
    return F.exists(F.array(*map(F.lit, ARTIFACTS)), lambda m: F.contains(text, m))


def heavy_text(text: Column) -> Column:
    """Whether a text is heavy in formulas or tables: a formula mark for each 400 characters, three short lines in a row,
    or an environment."""
    marks = F.regexp_count(text, F.lit(r"\$|\\\["))
    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.when((F.length(F.trim(x)) > 0) & (F.length(F.trim(x)) < 30), "s").otherwise("-"))
    return F.coalesce((F.length(text) > 0) & ((marks * 400 >= F.length(text)) | F.contains(F.array_join(lines, ""), F.lit("sss")) | F.contains(text, F.lit("\\begin{"))), F.lit(False))
