"""BibTeX: whole entries out, entries and fields in."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import ids
from quillspark.functions.text import clean_text

_ENTRY = regex.compile(r"@(\w+)\s*\{\s*([^,\s{}]+)\s*,")
_FIELD = regex.compile(r"\s*,?\s*([A-Za-z][\w-]*)\s*=\s*")


def balanced(text: str, at: int) -> int:
    """The offset after the brace that closes the one at `at`; the end of the text if none does."""
    depth = 0
    for k in range(at, len(text)):
        if text[k] == "{" and (k == 0 or text[k - 1] != "\\"):
            depth += 1
        elif text[k] == "}" and (k == 0 or text[k - 1] != "\\"):
            depth -= 1
            if not depth:
                return k + 1
    return len(text)


def entries_of(text: str | None) -> list[tuple[str, str, dict[str, str]]]:
    """(type, key, fields) of a bibliography's entries; values in braces, quotes or bare."""
    out, at = [], 0
    while m := _ENTRY.search(text or "", at):
        end = balanced(text, text.index("{", m.start()))
        fields, k = {}, m.end()
        while (f := _FIELD.match(text, k, end)) is not None:
            k = f.end()
            if k < end and text[k] == "{":
                stop = min(balanced(text, k), end)
                value = text[k + 1 : stop - (text[stop - 1] == "}")]
            elif k < end and text[k] == '"':
                stop = text.find('"', k + 1, end)
                stop = end if stop < 0 else stop + 1
                value = text[k + 1 : stop - 1]
            else:
                stop = min((p for p in (text.find(",", k, end), text.find("}", k, end), text.find("\n", k, end)) if p >= 0), default=end)
                value = text[k:stop].strip()
            fields.setdefault(f[1].lower(), value)
            k = stop
        out.append((m[1].lower(), m[2], fields))
        at = max(end, m.end())
    return out


def bibliography_entries(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, entry_no (from 1), entry_type, cite_key, fields of the entries of each text. Balanced braces aren't regular,
    hence the one Arrow function; texts without an entry pass by it. Broken entries end with their text."""

    @F.pandas_udf("array<struct<entry_type:string,cite_key:string,fields:map<string,string>>>")
    def parsed(texts: pd.Series) -> pd.Series:
        return texts.map(entries_of)

    held = docs.where(F.col(text).rlike(r"@\w+\s*\{")).select(key, F.posexplode(parsed(F.col(text))).alias("_p", "_e"))
    return held.select(key, (F.col("_p") + 1).alias("entry_no"), "_e.entry_type", "_e.cite_key", "_e.fields")


def escaped(x: Column) -> Column:
    for c in ("\\", "&", "_", "%", "#"):
        x = F.replace(x, F.lit(c), F.lit("\\" + c))
    return x


def bib_authors(authors: Column) -> Column:
    """Names as `Last, First`, joined by and; blank ones are left out."""
    def one(name: Column) -> Column:
        parts = F.split(name, " ")
        return F.when(F.contains(name, F.lit(",")) | (F.size(parts) < 2), name).otherwise(F.concat(F.element_at(parts, -1), F.lit(", "), F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " ")))
    plain = F.filter(F.transform(F.coalesce(authors, F.array().cast("array<string>")), clean_text), lambda x: x != "")
    return F.array_join(F.transform(plain, one), " and ")


def entry_type(told: Column, booktitle: Column, journal: Column, doi: Column, arxiv: Column) -> Column:
    has = lambda x: clean_text(x) != ""
    return F.when(has(told), F.lower(clean_text(told))).when(has(booktitle), "inproceedings").when(has(journal) | has(doi) | has(arxiv), "article").otherwise("misc")


def bib_entry(**given: Column) -> Column:
    """A whole entry from cite_key, entry_type, authors, title, journal, booktitle, year, volume, number, pages,
    arxiv_id, categories, doi, pmid, url and abstract, all but the key optional; blank fields are left out, the title
    keeps its capitals, and the address comes from arXiv or the DOI if there is none."""
    none = F.lit(None).cast("string")
    get = lambda name: given.get(name, none)
    text = lambda name: clean_text(get(name))
    arxiv, doi = text("arxiv_id"), ids.clean_doi(get("doi"))
    url = F.coalesce(F.when(text("url") != "", text("url")), F.when(arxiv != "", F.concat(F.lit("https://arxiv.org/abs/"), arxiv)), F.concat(F.lit("https://doi.org/"), doi))
    short = F.when(F.length(text("abstract")) > 500, F.concat(F.substring(text("abstract"), 1, 500), F.lit("..."))).otherwise(text("abstract"))
    first_category = F.get(F.filter(F.transform(given.get("categories", F.array().cast("array<string>")), clean_text), lambda x: x != ""), F.lit(0))
    line = lambda name, v: F.when(F.coalesce(clean_text(v), F.lit("")) != "", F.concat(F.lit(f"  {name} = {{"), v, F.lit("},")))
    lines = [
        F.concat(F.lit("@"), entry_type(get("entry_type"), get("booktitle"), get("journal"), get("doi"), get("arxiv_id")), F.lit("{"), text("cite_key"), F.lit(",")), line("author", bib_authors(given.get("authors", F.array().cast("array<string>")))),
        F.when(text("title") != "", F.concat(F.lit("  title = {{"), escaped(text("title")), F.lit("}},"))), line("journal", escaped(text("journal"))), line("booktitle", escaped(text("booktitle"))), *(line(x, text(x)) for x in ("year", "volume", "number", "pages")),
        line("eprint", arxiv), F.when(arxiv != "", F.lit("  archivePrefix = {arXiv},")), F.when(arxiv != "", line("primaryClass", first_category)), line("doi", doi), line("pmid", text("pmid")), line("url", escaped(url)), line("abstract", escaped(short)), F.lit("}"),
    ]
    return F.array_join(F.array_compact(F.array(*lines)), "\n")
