"""Operators on LaTeX and Markdown sources: comments, sections and their types, figures, authors, readable text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import clean_text

#: Section types by words of a heading, for each kind of source; the first that fits wins.
SECTION_WORDS = {
    "latex": [
        ("introduction", "introduction"), ("background", "background|model|review"), ("theory", "approach|concentration|inequality|theory"), ("methods", "estimation|regression|lasso|oracle"), ("methods", "screen|selection"),
        ("simulation", "simulation"), ("application", "data|application|real"), ("discussion", "discussion|conclusion"), ("appendix", "proof|appendix|technical|auxiliary"),
    ],
    "markdown": [
        ("introduction", "introduction"), ("background", "background|model|review"), ("theory", "approach|concentration|inequality|theory"), ("methods", "estimation|regression|lasso|oracle"), ("methods", "screen|selection|penali|cluster"),
        ("simulation", "simulation"), ("application", "data|application|real|spike"), ("discussion", "discussion|conclusion"), ("appendix", "proof|appendix|technical|auxiliary|algorithm"),
    ],
    "html": [
        ("introduction", "introduction"), ("background", "background|model|review"), ("theory", "theory|concentration|inequality|approach"), ("methods", "estimation|method|regression|lasso"), ("simulation", "simulation"),
        ("application", "data|application|real|spike"), ("discussion", "discussion|conclusion"), ("appendix", "reference|appendix|proof|algorithm"),
    ],
    "pdf": [
        ("introduction", "introduction"), ("model", "model|framework|notation|assumption|identification|causal"), ("background", "background|model|review"), ("theory", "approach|concentration|inequality|theorem|theory|lemma|proof"),
        ("methods", "estimation|regression|lasso|oracle|screen|selection|penali|cluster"), ("simulation", "simulation"), ("application", "data|application|real|spike"), ("discussion", "discussion|conclusion"), ("appendix", "appendix|technical|auxiliary|algorithm"),
    ],
}


def section_type(heading: Column, kind: str) -> Column:
    """The type of a section by its heading (of a PDF by its text), `section` if nothing fits."""
    low = F.lower(F.coalesce(heading, F.lit("")))
    out = None
    for name, words in SECTION_WORDS[kind]:
        hit = low.rlike(words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("section")


def without_comments(text: Column) -> Column:
    """Without what follows a per cent sign that isn't escaped, to the end of the line."""
    return F.regexp_replace(text, r"(?<!\\)%[^\n]*", "")


def sections(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """key, ordinal (from 1), title, body, is_appendix of the LaTeX sections; what stands before the first is none."""
    marked = F.regexp_replace(text, r"(\\section\*?\{[^}]+\})", "\u0001$1")
    pieces = docs.select(key, F.posexplode(F.split(marked, "\u0001")).alias("ordinal", "_s"), F.instr(text, "\\appendix").alias("_any"), marked.alias("_m"))
    heads = F.regexp_extract("_s", r"^\\section\*?\{([^}]+)\}", 1)
    # the appendix begins in the first piece that has the command; the sections after that one are in it
    first = F.regexp_count(F.regexp_extract("_m", r"(?s)^(.*?)\\appendix\b", 1), F.lit("\u0001"))
    inside = F.col("_m").rlike(r"\\appendix\b") & (F.col("ordinal") > first)
    body = F.regexp_replace(F.regexp_replace("_s", r"^\\section\*?\{[^}]+\}", ""), r"^\s+|\s+$", "")
    return pieces.where(F.col("ordinal") > 0).select(key, "ordinal", F.trim(heads).alias("title"), body.alias("body"), inside.alias("is_appendix"))


def front_abstract(text: Column) -> Column:
    """struct<title, abstract> of the front matter environment; null without one."""
    front = F.regexp_extract(text, r"(?s)\\begin\{frontmatter\}(.*?)\\end\{frontmatter\}", 1)
    title = F.regexp_extract(front, r"(?s)\\title\{(.*?)\}", 1)
    body = F.regexp_replace(F.regexp_extract(front, r"(?s)\\begin\{abstract\}(.*?)\\end\{abstract\}", 1), r"^\s+|\s+$", "")
    return F.when(text.rlike(r"(?s)\\begin\{frontmatter\}.*?\\end\{frontmatter\}"), F.struct(F.when(front.rlike(r"(?s)\\title\{.*?\}"), clean_text(title)).otherwise("Abstract").alias("title"), body.alias("abstract")))


def reference_numbers(text: Column, kind: str) -> Column:
    """Sorted distinct numbers of the figures or tables (kind) that a text names: written ones, those in the labels it
    refers to (a label without digits counts by its place), and if there are none, the captioned environments by
    place."""
    name = f"[{kind[0].upper()}{kind[0]}]{kind[1:]}"
    written = F.transform(F.regexp_extract_all(text, F.lit(rf"{name}\s+(\d+)"), F.lit(1)), lambda x: x.try_cast("int"))
    labels = F.regexp_extract_all(text, F.lit(rf"{name}[~\s]+\\ref\{{([^}}]+)\}}"), F.lit(1))
    labelled = F.transform(labels, lambda x, i: F.coalesce(F.regexp_extract(x, r"(\d+)", 1).try_cast("int"), i + 1))
    told = F.concat(written, labelled)
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s)\\begin\{{{kind}[*]?\}}.*?\\end\{{{kind}[*]?\}}"), F.lit(0))
    placed = F.filter(F.transform(blocks, lambda b, i: F.when(F.contains(b, F.lit("\\caption")), i + 1)), lambda n: n.isNotNull())
    return F.array_sort(F.array_distinct(F.when(F.size(told) > 0, told).otherwise(placed)))


def readable_statement(text: Column) -> Column:
    """A theorem's body as text: displays become [math], text commands their content, other commands and braces go."""
    out = F.regexp_replace(text, r"(?s)\\begin\{(?:align|equation|gather|multline)\*?\}.*?\\end\{(?:align|equation|gather|multline)\*?\}", " [math] ")
    out = F.regexp_replace(out, r"\\(?:text|emph|textbf|textit|mathrm|mathbf|mathit|mathcal|mathbb)\{([^}]*)\}", "$1")
    return clean_text(F.regexp_replace(F.regexp_replace(out, r"\\[a-zA-Z@]+\*?\s*", " "), r"[{}]", ""))


#: Accents that bibliographies spell as commands.
ACCENTS = {"{\\c{c}}": "ç", "{\\c{C}}": "Ç", "{\\'e}": "é", "{\\'E}": "É", "{\\'o}": "ó", "{\\'a}": "á", '{\\"{u}}': "ü", '{\\"{o}}': "ö"}


def readable_field(text: Column) -> Column:
    """A bibliography's field as text: some accents decoded, commands replaced by their content, braces gone."""
    for spelt, letter in ACCENTS.items():
        text = F.replace(text, F.lit(spelt), F.lit(letter))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\\[a-zA-Z]+\{([^{}]*)\}", "$1"), "[{}]", ""), r"(?U)^\s+|\s+$", "")


def title_and_author(text: Column) -> list[Column]:
    """tex_title and tex_author of a source's commands, by their first line-free argument; null without them."""
    arg = lambda name: F.regexp_extract(text, rf"(?s)\\{name}(?:\[[^\]]*\])?\{{((?:[^{{}}]|\{{[^{{}}]*\}})*)\}}", 1)
    plain = lambda x: F.when(x != "", readable_statement(x))
    return [plain(arg("title")).alias("tex_title"), plain(arg("author")).alias("tex_author")]
