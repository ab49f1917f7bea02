"""Identifier and bibliographic field expressions (normalizers P2-P8, P16-P18)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import blank_to_null, clean_text

#: Words that no cite key takes from a title.
KEY_STOP_WORDS = "a an and by for from in of on or the to toward towards with".split()
#: Suffixes of exchanges that a ticker may end with.
EXCHANGES = "SH SZ HK TW T KS KQ L PA AS MI MC F DE SI AX NZ TO V BO NS SS BK JK KL TWO".split()


def first_match(x: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null if there is none."""
    found = F.regexp_extract(x, pattern, group)
    return F.when(found != "", found)


def clean_doi(x: Column) -> Column:
    """The bare DOI in lower case; null unless the whole rest is one."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(clean_text(x)), r"^https?://(dx\.)?doi\.(org|example)/", ""), r"^doi:\s*", "")
    return F.when(bare.rlike(r"^10\.[0-9]{4,9}/\S+$"), bare)


def clean_openalex(x: Column) -> Column:
    """The first W id in upper case."""
    return F.upper(first_match(x, r"(?i)(w[0-9]+)"))


def clean_pmid(x: Column) -> Column:
    """A PubMed number of 5 to 12 digits: the whole text, or the first in a text that names PubMed."""
    bare = F.regexp_replace(F.lower(clean_text(x)), r"^(pmid|pubmed)\s*:\s*", "")
    return F.when(bare.rlike("^[0-9]{5,12}$"), bare).when(F.lower(x).rlike("pmid|pubmed"), first_match(x, "([0-9]{5,12})"))


def arxiv_id(x: Column) -> Column:
    """The arXiv number without version, new style or old; null for a DOI that isn't arXiv's."""
    text = clean_text(x)
    foreign = clean_doi(x).isNotNull() & ~F.lower(text).contains("arxiv")
    return F.when(~foreign, F.coalesce(first_match(text, r"([0-9]{4}\.[0-9]{4,5})"), first_match(text, r"(?i)arxiv[:/ ]([a-z\-.]+/[0-9]{7})")))


def arxiv_pdf(number: Column) -> Column:
    """The address of a paper's PDF; null without a number."""
    return F.concat(F.lit("https://arxiv.org/pdf/"), number, F.lit(".pdf"))


def truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty, as given."""
    return F.coalesce(*(F.when(c != "", c) for c in columns))


def parse_int(x: Column) -> Column:
    """The first whole number in a text."""
    return first_match(x.cast("string"), r"(-?[0-9]+)").try_cast("int")


def parse_year(x: Column) -> Column:
    """The first year of the twentieth or twenty-first century in a text."""
    return first_match(x.cast("string"), "((?:19|20)[0-9]{2})").try_cast("int")


def ordered_distinct(x: Column) -> Column:
    """Non-blank texts of an array, cleaned, each at its first place."""
    return F.array_distinct(F.filter(F.transform(x, clean_text), lambda v: v != ""))


def split_list(x: Column, pattern: str = "[,;]") -> Column:
    """An array of the non-blank parts of a text."""
    return ordered_distinct(F.split(F.coalesce(x, F.lit("")), pattern))


def normal_form(x: Column, form: str) -> Column:
    """Unicode's NFKC or NFKD. Spark has no such function, so rows that aren't ASCII alone go through Arrow."""

    @F.pandas_udf("string")
    def normalized(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    ascii_only = ~x.rlike(r"[^\x00-\x7F]")
    return F.coalesce(F.when(ascii_only, x), normalized(F.when(~ascii_only, x)))


def plain_title(x: Column) -> Column:
    """NFKC in lower case, anything but letters, digits and underscores as one blank."""
    return F.trim(F.regexp_replace(F.lower(normal_form(F.coalesce(x, F.lit("")), "NFKC")), r"(?U)[^\w]+", " "))


def canonical_id(arxiv: Column, doi: Column, openalex: Column, title: Column, year: Column) -> Column:
    """arxiv:, doi:, openalex: or manual: with a hash of title and year, the first that there is."""
    tag = lambda name, v: F.when(blank_to_null(v).isNotNull(), F.concat(F.lit(f"{name}:"), v))
    text = F.concat(plain_title(title), F.coalesce(year.cast("string"), F.lit("0")))
    return F.coalesce(tag("arxiv", arxiv), tag("doi", doi), tag("openalex", openalex), F.concat(F.lit("manual:"), F.substring(F.sha2(text, 256), 1, 8)))


def slug(x: Column) -> Column:
    """ASCII letters and digits of the decomposed text, in lower case; `unknown` if none are left."""
    bare = F.lower(F.regexp_replace(normal_form(F.coalesce(x, F.lit("")), "NFKD"), "[^A-Za-z0-9]+", ""))
    return F.when(bare != "", bare).otherwise("unknown")


def slug_words(x: Column, mark: str, most: int | None = None, other: str = "unknown") -> Column:
    """ASCII letters and digits of the decomposed text in lower case, other runs as one mark, none outside; cut
    to `most` characters."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(normal_form(F.coalesce(x, F.lit("")), "NFKD"), r"[^\x00-\x7F]+", "")), "[^a-z0-9]+", mark)
    bare = F.regexp_replace(bare, f"^{mark}+|{mark}+$", "")
    if most is not None:
        bare = F.regexp_replace(F.substring(bare, 1, most), f"{mark}+$", "")
    return F.when(bare != "", bare).otherwise(other)


def surname(author: Column) -> Column:
    """The slug of the part before a comma, else of the last word."""
    return slug(F.when(F.instr(author, ",") > 0, F.split(author, ",")[0]).otherwise(F.element_at(F.split(clean_text(author), " "), -1)))


def cite_key(author: Column, year: Column, title: Column, most_words: int = 1) -> Column:
    """Surname, year and the first title words that count, as `zhang2024neural`; words end at combining marks."""
    words = F.filter(F.split(F.lower(normal_form(F.coalesce(title, F.lit("")), "NFKD")), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(KEY_STOP_WORDS))
    said = F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, most_words), "")).otherwise("paper")
    return F.concat(surname(author), F.coalesce(year.cast("string"), F.lit("0")), said)


def key_suffix(canonical: Column) -> Column:
    """What tells apart equal cite keys: a letter for the kind of id and four of its characters."""
    rest = F.regexp_replace(canonical, "^[a-z]+:", "")
    some = lambda x: F.when(x != "", x).otherwise("0000")
    named = F.filter(F.split(rest, "/"), lambda x: x != "")
    return (
        F.when(canonical.startswith("arxiv:"), F.concat(F.lit("a"), some(F.substring(F.regexp_replace(rest, "[^0-9]", ""), 1, 4))))
        .when(canonical.startswith("doi:"), F.concat(F.lit("d"), some(F.right(slug(F.coalesce(F.get(named, F.lit(1)), F.get(named, F.lit(0)))), F.lit(4)))))
        .when(canonical.startswith("openalex:"), F.concat(F.lit("o"), F.lower(some(F.right(F.regexp_replace(rest, "[^A-Za-z0-9]", ""), F.lit(4))))))
        .when(canonical.startswith("manual:"), F.concat(F.lit("m"), F.lower(F.substring(rest, 1, 4))))
        .otherwise(F.concat(F.lit("x"), F.substring(F.sha1(canonical), 1, 4)))
    )


def inverted_abstract(index: Column) -> Column:
    """The text of a map of words to positions; on a shared position the word later in the map stands."""
    entries = F.map_entries(index)
    at = F.flatten(F.transform(entries, lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w")))))
    sorted_ = F.array_sort(at)
    last = F.filter(sorted_, lambda x, i: F.coalesce(F.get(sorted_, i + 1)["p"] != x["p"], F.lit(True)))
    return F.array_join(F.transform(last, lambda x: x["w"]), " ")


def identifier_aliases(x: Column) -> Column:
    """Every written form of the identifiers in a text, the cleaned text itself last; empty for a blank text."""
    text = clean_text(x)
    forms = []
    for kind, found in (("arxiv", arxiv_id(x)), ("doi", clean_doi(x)), ("openalex", clean_openalex(x)), ("pmid", clean_pmid(x))):
        forms += [found, F.concat(F.lit(f"{kind}:"), found)]
    return F.array_distinct(F.array_compact(F.array(*forms, F.when(text != "", text))))


def record_aliases(values: list[Column]) -> Column:
    """The aliases of several identifiers and addresses, distinct."""
    return F.array_distinct(F.flatten(F.array(*(identifier_aliases(v) for v in values))))


#: Country suffixes of tickers, by what becomes of them.
COUNTRY_FORMS = {
    "CN": r"(?i)^([0-9]+)\s*[-\s](?:CN|CH|SS)$",
    "HK": r"(?i)^([0-9]{4,5})\s*[-\s]HK$",
    "TW": r"(?i)^([0-9]{4})\s*[-\s]TW$",
    "US": r"(?i)^([A-Z0-9./]+)\s*[-\s](?:US|UN|UW)$",
}


def ticker(raw: Column) -> Column:
    """struct<ticker, kind>: an exchange's own suffix is kept, a country's becomes an exchange's, that of the
    United States goes; any other text stays as it is."""
    t = F.trim(raw)
    code = lambda p: F.regexp_extract(t, p, 1)
    cn, hk, tw, us = (COUNTRY_FORMS[k] for k in ("CN", "HK", "TW", "US"))
    out = lambda value, kind: F.struct(value.alias("ticker"), F.lit(kind).alias("kind"))
    shenzhen = F.substring(code(cn), 1, 1).isin("0", "3", "4", "8")
    return (
        F.when(t.rlike(rf"(?i)\.(?:{'|'.join(EXCHANGES)})$"), out(t, "preserved_known"))
        .when(t.rlike(cn), out(F.concat(code(cn), F.when(shenzhen, ".SZ").otherwise(".SH")), "mapped_exchange"))
        .when(t.rlike(hk), out(F.concat(code(hk), F.lit(".HK")), "mapped_exchange"))
        .when(t.rlike(tw), out(F.concat(code(tw), F.lit(".TW")), "mapped_exchange"))
        .when(t.rlike(us), out(F.upper(code(us)), "us_bare"))
        .otherwise(out(t, "preserved_unknown"))
    )
