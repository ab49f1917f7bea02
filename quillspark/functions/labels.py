"""Row-local labels and normal forms of the records of a review: gaps, rates, assumptions, claims, proposals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.ids import normal_form
from quillspark.functions.text import clean_text

#: Kinds of gaps by letter, and words that tell them, the first that fits wins; S for any other.
GAP_WORDS = [("C", ["concept", "theoretical", "definition", "notation"]), ("X", ["cross", "xref", "reference", "link"]), ("E", ["empirical", "data", "experiment", "evidence", "real_data"])]
GAP_TYPES = ["C", "X", "E", "S"]
SEVERITIES = ["low", "medium", "high"]
ACTIONS = ["read", "reread", "ask", "note", "verify_lean"]
RATE_TYPES = ["upper_bound", "lower_bound", "exact", "minimax"]
STRENGTHS = ["standard", "moderate", "strong"]
#: Categories of assumptions by what they are called.
ASSUMPTIONS = {
    "regularity": "regularity_of_design", "moment": "moment_conditions", "mixing": "stability_stationarity", "smoothness": "smoothness", "sparsity": "sparsity", "identifiability": "identifiability", "independence": "independence",
    "positivity": "positivity", "dimensionality": "dimensionality", "stability_stationarity": "stability_stationarity", "moment_conditions": "moment_conditions", "regularity_of_design": "regularity_of_design", "other": "other",
}
#: Categories of concepts by the kind of a notation's entry and by a section's type; notation for any other.
ENTRY_CONCEPTS = {"method": "method", "model": "model", "assumption": "assumption", "proof-pattern": "proof-pattern"}
SECTION_CONCEPTS = {"methods": "method", "theory": "proof-pattern", "proofs": "proof-pattern", "assumptions": "assumption"}
#: Words of a claim by its type, the first that fits wins; sections whose claims are empirical.
CLAIM_WORDS = [
    ("assumption", ["assumption", "stationary", "ergodic", "boundedness"]), ("convergence", ["convergence", "rate", "bound", "theorem", "lemma", "proposition", "corollary"]),
    ("computational", ["runtime", "complexity", "computational", "algorithm", "scalability"]), ("empirical", ["experiment", "empirical", "dataset", "outperform", "accuracy"]),
]
EMPIRICAL_SECTIONS = ["simulation", "real_data", "discussion"]
#: Words of a heading whose scenario only adds to another.
DELTA_WORDS = ["ablation", "sensitivity", "appendix", "supplementary", "additional"]


def holds_any(text: Column, words: list[str]) -> Column:
    """Whether a lower-case text holds one of the words."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))


def looked_up(x: Column, table: dict[str, str], other: str) -> Column:
    known = F.create_map(*(F.lit(v) for kv in table.items() for v in kv))
    return F.coalesce(F.element_at(known, F.coalesce(x, F.lit(""))), F.lit(other))


def one_of(x: Column, values: list[str], other: str) -> Column:
    """x in lower case if it is one of the values."""
    return F.when(F.lower(x).isin(values), F.lower(x)).otherwise(other)


def gap_type(x: Column) -> Column:
    """A letter of GAP_TYPES in any case, else by words, else S."""
    low = F.lower(F.coalesce(x, F.lit("none")))
    out = F.when(F.upper(x).isin(GAP_TYPES), F.upper(x))
    for letter, words in GAP_WORDS:
        out = out.when(holds_any(low, words), letter)
    return out.otherwise("S")


def gap_severity(x: Column) -> Column:
    return one_of(x, SEVERITIES, "medium")


def gap_action(x: Column) -> Column:
    return one_of(x, ACTIONS, "note")


def rate_type(x: Column) -> Column:
    """A known type as it is written, else an upper bound."""
    return F.when(x.isin(RATE_TYPES), x).otherwise("upper_bound")


def convergence_rate(fields: Column) -> Column:
    """struct of a rate's fields from a map under their names or their older ones; minimax unless told otherwise if the
    type is."""
    get = lambda *names: F.coalesce(*(F.when(F.element_at(fields, F.lit(n)) != "", F.element_at(fields, F.lit(n))) for n in names))
    kind = rate_type(get("rate_type", "type"))
    minimax = F.when(F.map_contains_key(fields, F.lit("is_minimax")), F.element_at(fields, F.lit("is_minimax")).try_cast("boolean")).otherwise(F.when(kind == "minimax", F.lit(True)))
    return F.struct(F.coalesce(get("result_id", "result"), F.lit("unknown")).alias("result"), kind.alias("type"), *(get(n).alias(n) for n in ("estimand", "estimator", "loss")), get("rate_expression", "rate").alias("rate"), get("conditions", "regime").alias("regime"), minimax.alias("is_minimax"))


def assumption_category(x: Column) -> Column:
    return looked_up(F.trim(F.lower(x)), ASSUMPTIONS, "other")


def assumption_strength(x: Column) -> Column:
    return one_of(F.trim(x), STRENGTHS, "standard")


def concept_category(entry_type: Column) -> Column:
    return looked_up(entry_type, ENTRY_CONCEPTS, "notation")


def section_concept(section_type: Column) -> Column:
    return looked_up(section_type, SECTION_CONCEPTS, "notation")


def section_kind(x: Column) -> Column:
    """A section's type in lower case; a method is methods."""
    low = F.lower(clean_text(x))
    return F.when(low == "method", "methods").otherwise(low)


def claim_type(section: Column, claim: Column) -> Column:
    low = F.lower(claim)
    out = None
    for name, words in CLAIM_WORDS:
        hit = holds_any(low, words)
        if name == "empirical":
            hit = hit | F.coalesce(section.isin(EMPIRICAL_SECTIONS), F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("novelty")


def scenario_importance(heading: Column) -> Column:
    return F.when(holds_any(F.lower(F.coalesce(heading, F.lit(""))), DELTA_WORDS), "delta").otherwise("important")


def reported_confidence(told: Column, total: Column, flagged: Column) -> Column:
    """A known confidence that a report tells, else by the share of flagged claims, else medium."""
    low = F.lower(clean_text(told))
    share = flagged / F.when(total > 0, total)
    return F.when(low.isin(SEVERITIES), low).when(share <= 0.1, "high").when(share <= 0.35, "medium").when(share.isNotNull(), "low").otherwise("medium")


def first_sentence(text: Column, most: int = 80) -> Column:
    """Up to the first stop, question or exclamation mark, cut to `most` characters; empty for a null."""
    found = F.regexp_extract(text, r"(?s)^(.*?[.!?])", 1)
    sentence = F.regexp_replace(F.when(found != "", found).otherwise(text), r"(?U)^\s+|\s+$", "")
    return F.coalesce(F.when(F.length(sentence) > most, F.regexp_replace(F.substring(sentence, 1, most), r"(?U)\s+$", "")).otherwise(sentence), F.lit(""))


def bar_free(title: Column) -> Column:
    """A title for a cell of a pipe table: bars become dashes."""
    return F.replace(title, F.lit("|"), F.lit("\u2014"))


def preview(text: Column, most: int) -> Column:
    """The cleaned text, or its start and three dots within `most` characters."""
    plain = clean_text(text)
    return F.when(F.length(plain) <= most, plain).otherwise(F.concat(F.regexp_replace(F.substring(plain, 1, most - 3), r"(?U)\s+$", ""), F.lit("...")))


def supplement_id(identifier: Column, mark: str = "supp_") -> Column:
    """The id with the mark before it, once."""
    return F.when(identifier.startswith(mark), identifier).otherwise(F.concat(F.lit(mark), identifier))


def author_slug(name: Column) -> Column:
    """Last name and first initial of a name in either order: `last_f`; `unknown` and `u` for what is missing."""
    plain = F.regexp_replace(normal_form(F.coalesce(name, F.lit("")), "NFKD"), r"[^\x00-\x7F]+", "")
    tokens = F.filter(F.split(plain, r"[\s,]+"), lambda t: t != "")
    turned = F.contains(name, F.lit(","))
    last = F.when(turned, F.get(tokens, F.lit(0))).otherwise(F.get(tokens, F.size(tokens) - 1))
    first = F.when(F.size(tokens) > 1, F.substring(F.when(turned, F.get(tokens, F.lit(1))).otherwise(F.get(tokens, F.lit(0))), 1, 1))
    bare = lambda x: F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]", "")
    filled = lambda x, other: F.when(bare(x) != "", bare(x)).otherwise(other)
    return F.concat(filled(last, "unknown"), F.lit("_"), filled(first, "u"))


def proposal_id(cite_key: Column, dimension: Column, proposal: Column) -> Column:
    digest = F.substring(F.sha1(F.concat_ws("|", cite_key, dimension, proposal)), 1, 8)
    return F.concat(F.lit("l2-"), cite_key, F.lit("-"), dimension, F.lit("-"), digest)


def queue_boost(importance: Column) -> Column:
    """A fifth for each mention, one at most."""
    return F.least(F.lit(1.0), 0.2 * importance)


def child_status(position: Column, children: Column) -> Column:
    """Status of a split segment's children: the first and the last are read, those between must be read again."""
    return F.when((position == 1) | (position == children), "comprehended").otherwise("needs_re-read")
