"""Queries of the functions and operators on notes, sources and bibliographies, each with its SQL where SQL can say it.

The SQL is written apart from the expressions: word lists stand as patterns, folds as windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import ids, labels
from quillspark.functions.text import clean_text
from quillspark.operators import latex, merging, notes
from quillspark.sources import bibliography
from quillspark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: White space as Spark's patterns know it, in the SQL.
_SP = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_SP}+', ' ', 'g'))"


def query(sql: str | None = None):
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", "text")


def _documents(spark: SparkSession, folder: str, **columns) -> DataFrame:
    return _texts(spark, folder).select("doc_id", *(c.alias(n) for n, c in columns.items()))


@query(
    r"""SELECT doc_id, CASE WHEN t IN ('c', 'x', 'e', 's') THEN upper(t) WHEN regexp_matches(t, 'concept|theoretical|definition|notation') THEN 'C' WHEN regexp_matches(t, 'cross|xref|reference|link') THEN 'X' WHEN regexp_matches(t, 'empirical|data|experiment|evidence') THEN 'E' ELSE 'S' END AS gap_type
    FROM (SELECT doc_id, lower(text) AS t FROM documents WHERE text IS NOT NULL) d"""
)
def gap_types(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, gap_type=labels.gap_type(F.col("text")))


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'high' WHEN event_type = 'view' THEN 'low' ELSE 'medium' END AS severity, CASE WHEN event_type = 'click' THEN 'reread' WHEN event_type = 'view' THEN 'read' ELSE 'note' END AS action,
    CASE WHEN event_type = 'purchase' THEN 'minimax' WHEN event_type = 'signup' THEN 'lower_bound' ELSE 'upper_bound' END AS rate_type, CASE WHEN event_type = 'click' THEN 'moment_conditions' WHEN event_type = 'view' THEN 'sparsity' ELSE 'other' END AS category,
    CASE WHEN event_type = 'click' THEN 'strong' WHEN event_type = 'view' THEN 'moderate' ELSE 'standard' END AS strength FROM events"""
)
def review_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The closed lists of gaps, rates and assumptions, spelt in several ways by the kind of an event."""
    e = table(spark, folder, "events")
    say = lambda **kinds: F.coalesce(*(F.when(F.col("event_type") == k, F.lit(v)) for k, v in kinds.items()), F.col("event_type"))
    return e.select(
        "event_id", labels.gap_severity(say(error="HIGH", view="Low")).alias("severity"), labels.gap_action(say(click="ReRead", view="read")).alias("action"), labels.rate_type(say(purchase="minimax", signup="lower_bound", click="Exact")).alias("rate_type"),
        labels.assumption_category(say(click=" Moment ", view="sparsity")).alias("category"), labels.assumption_strength(say(click=" Strong", view="moderate ")).alias("strength"),
    )


@query(
    """SELECT seg_uid, CASE section_type WHEN 'methods' THEN 'method' WHEN 'theory' THEN 'proof-pattern' WHEN 'proofs' THEN 'proof-pattern' WHEN 'assumptions' THEN 'assumption' ELSE 'notation' END AS concept, CASE WHEN lower(trim(section_type)) = 'method' THEN 'methods' ELSE coalesce(lower(trim(section_type)), '') END AS kind,
    CASE WHEN regexp_matches(lower(coalesce(section_type, '')), 'ablation|sensitivity|appendix|supplementary|additional') THEN 'delta' ELSE 'important' END AS importance, CASE WHEN starts_with(id, 'supp_') THEN id ELSE 'supp_' || id END AS supplement FROM segment_entries"""
)
def section_labels(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "segment_entries")
    kind = F.col("section_type")
    return s.select("seg_uid", labels.section_concept(kind).alias("concept"), labels.section_kind(kind).alias("kind"), labels.scenario_importance(kind).alias("importance"), labels.supplement_id(F.col("id")).alias("supplement"))


@query(
    r"""SELECT seg_uid, CASE WHEN regexp_matches(t, 'assumption|stationary|ergodic|boundedness') THEN 'assumption' WHEN regexp_matches(t, 'convergence|rate|bound|theorem|lemma|proposition|corollary') THEN 'convergence' WHEN regexp_matches(t, 'runtime|complexity|computational|algorithm|scalability') THEN 'computational'
    WHEN section_type IN ('simulation', 'real_data', 'discussion') OR regexp_matches(t, 'experiment|empirical|dataset|outperform|accuracy') THEN 'empirical' ELSE 'novelty' END AS claim_type FROM (SELECT seg_uid, section_type, lower(body) AS t FROM segment_entries WHERE body IS NOT NULL) s"""
)
def claim_types(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "segment_entries").where("body IS NOT NULL")
    return s.select("seg_uid", labels.claim_type(F.col("section_type"), F.col("body")).alias("claim_type"))


@query(
    f"""WITH s AS (SELECT doc_id, text, regexp_extract(text, '(?s)^(.*?[.!?])', 1) AS f, {_clean('text')} AS p FROM documents WHERE text IS NOT NULL), t AS (SELECT *, regexp_replace(CASE WHEN f <> '' THEN f ELSE text END, '^{_SP}+|{_SP}+$', '', 'g') AS g FROM s)
    SELECT doc_id, CASE WHEN length(g) > 80 THEN regexp_replace(substr(g, 1, 80), '{_SP}+$', '') ELSE g END AS sentence, CASE WHEN length(p) <= 180 THEN p ELSE regexp_replace(substr(p, 1, 177), '{_SP}+$', '') || '...' END AS preview, replace(substr(p, 1, 60), '|', chr(8212)) AS cell FROM t"""
)
def text_previews(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    return _documents(spark, folder, sentence=labels.first_sentence(t), preview=labels.preview(t, 180), cell=labels.bar_free(F.substring(clean_text(t), 1, 60)))


@query(
    r"""WITH n AS (SELECT DISTINCT name FROM (SELECT unnest(authors) AS name FROM zotero_results) u WHERE name IS NOT NULL AND NOT regexp_matches(name, '[^\x00-\x7F]')), t AS (SELECT name, [x FOR x IN regexp_split_to_array(name, '[\s,]+') IF x <> ''] AS k FROM n),
    p AS (SELECT name, regexp_replace(lower(CASE WHEN contains(name, ',') THEN k[1] ELSE k[-1] END), '[^a-z0-9]', '', 'g') AS l, regexp_replace(lower(CASE WHEN len(k) < 2 THEN 'u' WHEN contains(name, ',') THEN substr(k[2], 1, 1) ELSE substr(k[1], 1, 1) END), '[^a-z0-9]', '', 'g') AS f FROM t)
    SELECT name, CASE WHEN coalesce(l, '') = '' THEN 'unknown' ELSE l END || '_' || CASE WHEN coalesce(f, '') = '' THEN 'u' ELSE f END AS slug FROM p UNION ALL SELECT DISTINCT name, 'marked' FROM (SELECT unnest(authors) AS name FROM zotero_results) u WHERE regexp_matches(name, '[^\x00-\x7F]')"""
)
def author_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of all distinct names; those of names with marked letters, which SQL can't decompose, only count as there."""
    names = table(spark, folder, "zotero_results").select(F.explode("authors").alias("name")).where("name IS NOT NULL").distinct()
    return names.select("name", F.when(F.col("name").rlike(r"[^\x00-\x7F]"), F.when(labels.author_slug(F.col("name")).rlike("^[a-z0-9]+_[a-z0-9]$"), "marked")).otherwise(labels.author_slug(F.col("name"))).alias("slug"))


@query("SELECT seg_uid, 'l2-' || cite_key || '-' || section_type || '-' || substr(sha1(cite_key || '|' || section_type || '|' || coalesce(body, '')), 1, 8) AS proposal FROM segment_entries WHERE cite_key IS NOT NULL AND section_type IS NOT NULL AND body IS NOT NULL")
def proposal_ids(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "segment_entries").where("cite_key IS NOT NULL AND section_type IS NOT NULL AND body IS NOT NULL")
    return s.select("seg_uid", labels.proposal_id(F.col("cite_key"), F.col("section_type"), F.col("body")).alias("proposal"))


@query(
    """SELECT user_id, least(1.0, 0.2 * n) AS boost, CASE WHEN errors * 1.0 / n <= 0.1 THEN 'high' WHEN errors * 1.0 / n <= 0.35 THEN 'medium' ELSE 'low' END AS confidence FROM (SELECT user_id, count(*) AS n, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors FROM events GROUP BY user_id) t"""
)
def boosts_and_confidence(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("event_type") == "error").cast("int")).alias("errors"))
    return e.select("user_id", labels.queue_boost(F.col("n")).cast("double").alias("boost"), labels.reported_confidence(F.lit("unsure"), F.col("n"), F.col("errors")).alias("confidence"))


@query(
    """SELECT seg_uid, CASE WHEN rn = 1 OR rn = n THEN 'comprehended' ELSE 'needs_re-read' END AS status FROM (SELECT seg_uid, row_number() OVER (PARTITION BY cite_key, section_id ORDER BY seg_uid) AS rn, count(*) OVER (PARTITION BY cite_key, section_id) AS n FROM segment_entries) t"""
)
def child_statuses(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "segment_entries").select("cite_key", "section_id", "seg_uid")
    # first and last by map-side extremes, so that a section of any size is no task's
    ends = s.groupBy("cite_key", "section_id").agg(F.min("seg_uid").alias("first"), F.max("seg_uid").alias("last"))
    joined = s.join(ends, s["cite_key"].eqNullSafe(ends["cite_key"]) & s["section_id"].eqNullSafe(ends["section_id"]))
    return joined.select("seg_uid", labels.child_status(F.when(F.col("seg_uid") == F.col("first"), 1).otherwise(0), F.when(F.col("seg_uid") == F.col("last"), 0).otherwise(-1)).alias("status"))


_TYPES = {
    "latex": "introduction:introduction;background:background|model|review;theory:approach|concentration|inequality|theory;methods:estimation|regression|lasso|oracle|screen|selection;simulation:simulation;application:data|application|real;discussion:discussion|conclusion;appendix:proof|appendix|technical|auxiliary",
    "markdown": "introduction:introduction;background:background|model|review;theory:approach|concentration|inequality|theory;methods:estimation|regression|lasso|oracle|screen|selection|penali|cluster;simulation:simulation;application:data|application|real|spike;discussion:discussion|conclusion;appendix:proof|appendix|technical|auxiliary|algorithm",
    "html": "introduction:introduction;background:background|model|review;theory:theory|concentration|inequality|approach;methods:estimation|method|regression|lasso;simulation:simulation;application:data|application|real|spike;discussion:discussion|conclusion;appendix:reference|appendix|proof|algorithm",
    "pdf": "introduction:introduction;model:model|framework|notation|assumption|identification|causal;background:background|model|review;theory:approach|concentration|inequality|theorem|theory|lemma|proof;methods:estimation|regression|lasso|oracle|screen|selection|penali|cluster;simulation:simulation;application:data|application|real|spike;discussion:discussion|conclusion;appendix:appendix|technical|auxiliary|algorithm",
}
_CASES = {k: "CASE " + " ".join("WHEN regexp_matches(t, '{1}') THEN '{0}'".format(*r.split(":")) for r in v.split(";")) + " ELSE 'section' END" for k, v in _TYPES.items()}


@query(f"SELECT rec_id, {', '.join(f'{c} AS {k}_type' for k, c in _CASES.items())} FROM (SELECT rec_id, lower(coalesce(title, '')) AS t FROM openalex_results) o")
def section_types(spark: SparkSession, folder: str) -> DataFrame:
    """The four classifiers of headings, on titles."""
    o = table(spark, folder, "openalex_results")
    return o.select("rec_id", *(latex.section_type(F.col("title"), k).alias(f"{k}_type") for k in latex.SECTION_WORDS))


@query(
    r"""WITH s AS (SELECT doc_id, text, regexp_extract_all(text, '\\section\*?\{([^}]+)\}', 1) AS titles, string_split(regexp_replace(text, '\\section\*?\{[^}]+\}', chr(1), 'g'), chr(1)) AS bodies FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, text, unnest(titles) AS title, generate_subscripts(titles, 1) AS i, bodies FROM s)
    SELECT doc_id, CAST(i AS INTEGER) AS ordinal, trim(title) AS title, regexp_replace(bodies[i + 1], '^[\s\x{0B}]+|[\s\x{0B}]+$', '', 'g') AS body, contains(list_aggregate(bodies[1:i], 'string_agg', ''), '\appendix') AS is_appendix FROM u"""
)
def latex_sections(spark: SparkSession, folder: str) -> DataFrame:
    return latex.sections(_texts(spark, folder), "doc_id", F.col("text"))


@query(
    r"""SELECT doc_id, regexp_replace(replace(text, '\%', chr(2)), '%[^\n]*', '', 'g') AS x FROM documents WHERE text IS NOT NULL"""
)
def latex_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without comments; escaped signs are shown as one character on both sides."""
    return _documents(spark, folder, x=F.replace(latex.without_comments(F.col("text")), F.lit("\\%"), F.lit("\u0002")))


@query(
    r"""WITH d AS (SELECT doc_id, [CAST(x AS INTEGER) FOR x IN regexp_extract_all(text, '[Tt]able\s+(\d+)', 1)] AS a, [regexp_extract(x, '(\d+)', 1) FOR x IN regexp_extract_all(text, '[Tt]able[~\s]+\\ref\{([^}]+)\}', 1)] AS b, regexp_extract_all(text, '(?s)\\begin\{table[*]?\}.*?\\end\{table[*]?\}') AS e FROM documents WHERE text IS NOT NULL),
    r AS (SELECT doc_id, a || [CASE WHEN b[i] <> '' THEN CAST(b[i] AS INTEGER) ELSE CAST(i AS INTEGER) END FOR i IN range(1, len(b) + 1)] AS n, [CAST(i AS INTEGER) FOR i IN range(1, len(e) + 1) IF contains(e[i], '\caption')] AS c FROM d)
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(n) > 0 THEN n ELSE c END)) AS numbers FROM r"""
)
def table_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, numbers=latex.reference_numbers(F.col("text"), "table"))


@query(
    rf"""SELECT doc_id, {_clean(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?s)\\begin\{(?:align|equation|gather|multline)\*?\}.*?\\end\{(?:align|equation|gather|multline)\*?\}', ' [math] ', 'g'), '\\(?:text|emph|textbf|textit|mathrm|mathbf|mathit|mathcal|mathbb)\{([^}]*)\}', '\1', 'g'), '\\[a-zA-Z@]+\*?[\s\x{0B}]*', ' ', 'g'), '[{}]', '', 'g')")} AS statement FROM documents WHERE text IS NOT NULL"""
)
def readable_latex(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, statement=latex.readable_statement(F.col("text")))


@query()
def latex_heads(spark: SparkSession, folder: str) -> DataFrame:
    d = _texts(spark, folder)
    return d.select("doc_id", latex.front_abstract(F.col("text")).alias("front"), *latex.title_and_author(F.col("text")))


@query(r"SELECT doc_id, regexp_replace(text, '(?s)\A---\r?\n.*?\r?\n---[ \t]*(?:\r?\n|\z)', '') AS body FROM documents WHERE text IS NOT NULL")
def note_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, body=notes.without_front_matter(F.col("text")))


@query(
    rf"""SELECT doc_id, [x FOR x IN [trim(regexp_replace({_clean('y')}, '^\*+|\*+$', '', 'g')) FOR y IN regexp_extract_all(text, '(?m)^[ \t]*[-*+][ \t]+(\S[^\r\n]*)', 1)] IF length(x) >= 12] AS items FROM documents WHERE text IS NOT NULL"""
)
def note_bullets(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, items=notes.bullets(F.col("text")))


_ABOUT = ["theorem", "bound", "estimator", "proof"]


@query()
def claim_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences about proofs; the first eight of a text are the feature."""
    return _documents(spark, folder, claims=notes.distinct_claims(notes.sentences_about(F.col("text"), _ABOUT)))


@query(
    rf"""SELECT rec_id, regexp_replace(regexp_replace(lower({_clean('title')}), '[`*_]', '', 'g'), '[ .;:,!?]+$', '') AS claim,
    list_sort(list_distinct([x FOR x IN regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]+') IF length(x) > 2 AND NOT regexp_full_match(x, 'and|are|for|from|that|the|was|were|with')])) AS tokens FROM web_results"""
)
def claim_forms(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "web_results").select("rec_id", notes.plain_claim(F.col("title")).alias("claim"), F.array_sort(notes.claim_tokens(F.col("title"))).alias("tokens"))


@query(
    r"""WITH r AS (SELECT doc_id, regexp_extract(text, '(?i)(?:^|\n)\s*\*{0,2}(?:Key\s*words?|KEYWORDS?)\s*\*{0,2}\s*[:\-—]\s*([^\n]+)', 1) AS raw FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, [x FOR x IN [trim(regexp_replace(trim(y), '^\*+|\*+$', '', 'g')) FOR y IN regexp_split_to_array(regexp_replace(trim(raw), '\.+$', ''), '[;,·]')] IF x <> ''] AS keywords FROM r"""
)
def keywords_given(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, keywords=notes.author_keywords(F.col("text")))


@query(r"SELECT doc_id, regexp_replace(text, '(?m)^## (\S)', '### \1', 'g') AS lower_text FROM documents WHERE text IS NOT NULL AND NOT contains(text, chr(13)) AND NOT regexp_matches(text, '[\x{85}\x{2028}\x{2029}]') UNION ALL SELECT doc_id, NULL FROM documents WHERE contains(text, chr(13)) OR regexp_matches(text, '[\x{85}\x{2028}\x{2029}]')")
def demoted_headings(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with their headings a level lower; null where line ends other than line feeds make SQL's lines differ."""
    t = F.col("text")
    return _documents(spark, folder, lower_text=F.when(~t.rlike(r"[\r\u0085\u2028\u2029]"), notes.demoted(t)))


@query(
    r"""SELECT doc_id, coalesce(length(text) > 0 AND (len(regexp_extract_all(text, '\$|\\\[')) * 400 >= length(text) OR contains(text, '\begin{') OR contains(list_aggregate([CASE WHEN length(trim(x)) > 0 AND length(trim(x)) < 30 THEN 's' ELSE '-' END FOR x IN regexp_split_to_array(text, '\r?\n')], 'string_agg', ''), 'sss')), false) AS heavy,
    contains(text, 'TRANSLATION_ERROR') OR contains(text, '[[untranslated]]') OR contains(text, '???') OR contains(text, chr(65533)) AS bad FROM documents WHERE text IS NOT NULL"""
)
def chunk_tests(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, heavy=notes.heavy_text(F.col("text")), bad=notes.badly_translated(F.col("text")))


@query()
def unspaced_titles(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "openalex_results").where("title IS NOT NULL")
    spaced = F.trim(F.regexp_replace(clean_text(F.col("title")), "(.)", "$1 "))
    return o.select("rec_id", notes.unspaced_title(spaced, F.lit(3)).alias("joined"), notes.unspaced_title(F.col("title"), F.lit(3)).alias("kept"))


@query("SELECT seg_uid, CASE WHEN seg_uid % 2 = 0 THEN [CAST(x AS INTEGER) FOR x IN range(3, 3 + seg_uid % 5 + 1)] ELSE [CAST(x AS INTEGER) FOR x IN range((seg_uid % 7) * 4 + 1, greatest((seg_uid % 7) * 4 + 1, least((seg_uid % 7) * 4 + 4, 18)) + 1)] END AS pages FROM segment_entries")
def page_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Pages by a comment, last page first, or by the group's index in a document of 18 pages."""
    u = F.col("seg_uid")
    comment = F.when(u % 2 == 0, F.concat(F.lit("<!-- pages: "), (3 + u % 5).cast("string"), F.lit("-3 -->"))).otherwise("no comment")
    return table(spark, folder, "segment_entries").select("seg_uid", notes.source_pages(comment, (u % 7 + 1).cast("int"), 4, F.lit(18)).alias("pages"))


@query()
def overview_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return notes.block_under(_texts(spark, folder), "doc_id", "text", "Findings")


@query()
def overview_upserts(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, text=notes.with_section(F.col("text"), "Findings", F.lit("See the $1 index \\ of results.")))


_Z = "lower(regexp_replace(regexp_replace(lower({0}), '^https?://(dx\\.)?doi\\.(org|example)/', ''), '^doi:\\s*', ''))"


@query(
    rf"""WITH p AS (SELECT rec_id, coalesce(uid, 'rec' || rec_id) AS k, {_clean('title')} AS t, regexp_extract(coalesce(pubdate, ''), '((?:19|20)[0-9]{{2}})', 1) AS y, [{_clean('x')} FOR x IN coalesce(authors, []) IF {_clean('x')} <> ''] AS au, regexp_replace(regexp_replace(lower({_clean('doi')}), '^https?://(dx\.)?doi\.(org|example)/', ''), '^doi:\s*', '') AS d0, doi, {_clean('pmid')} AS pm FROM pubmed_results),
    q AS (SELECT *, CASE WHEN regexp_full_match(d0, '10\.[0-9]{{4,9}}/\S+') THEN d0 END AS d, list_aggregate([CASE WHEN contains(a, ',') OR NOT contains(a, ' ') THEN a ELSE regexp_extract(a, '([^ ]+)$', 1) || ', ' || regexp_extract(a, '^(.*) [^ ]+$', 1) END FOR a IN au], 'string_agg', ' and ') AS names FROM p)
    SELECT rec_id, concat_ws(E'\n', '@' || CASE WHEN {_clean('doi')} <> '' THEN 'article' ELSE 'misc' END || '{{' || k || ',', CASE WHEN coalesce(names, '') <> '' THEN '  author = {{' || names || '}},' END, CASE WHEN t <> '' THEN '  title = {{{{' || regexp_replace(t, '([\\&_%#])', '\\\1', 'g') || '}}}},' END, CASE WHEN y <> '' THEN '  year = {{' || y || '}},' END,
        CASE WHEN d IS NOT NULL THEN '  doi = {{' || d || '}},' END, CASE WHEN pm <> '' THEN '  pmid = {{' || pm || '}},' END, CASE WHEN d IS NOT NULL THEN '  url = {{' || regexp_replace('https://doi.org/' || d, '([\\&_%#])', '\\\1', 'g') || '}},' END, '}}') AS entry FROM q"""
)
def bibliography_export(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pubmed_results").select("rec_id", _entry().alias("entry"))


def _entry():
    c = F.col
    return bibliography.bib_entry(cite_key=F.coalesce(c("uid"), F.concat(F.lit("rec"), c("rec_id").cast("string"))), authors=c("authors"), title=c("title"), year=F.regexp_extract("pubdate", "((?:19|20)[0-9]{2})", 1), doi=c("doi"), pmid=c("pmid"))


@query(
    rf"""SELECT rec_id, coalesce(uid, 'rec' || rec_id) AS cite_key, CASE WHEN {_clean('doi')} <> '' THEN 'article' ELSE 'misc' END AS entry_type, CASE WHEN {_clean('title')} <> '' THEN '{{' || regexp_replace({_clean('title')}, '([\\&_%#])', '\\\1', 'g') || '}}' END AS title, nullif(regexp_extract(coalesce(pubdate, ''), '((?:19|20)[0-9]{{2}})', 1), '') AS year FROM pubmed_results"""
)
def bibliography_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every record written as an entry and read again."""
    out = table(spark, folder, "pubmed_results").select("rec_id", _entry().alias("entry"))
    return bibliography.bibliography_entries(out, "rec_id", "entry").select("rec_id", "cite_key", "entry_type", F.element_at("fields", F.lit("title")).alias("title"), F.element_at("fields", F.lit("year")).alias("year"))


_RICH = "CASE WHEN coalesce({0}doi, '') <> '' THEN 1 ELSE 0 END + CASE WHEN coalesce({0}arxiv_id, '') <> '' THEN 2 ELSE 0 END + CASE WHEN coalesce({0}pmid, '') <> '' THEN 4 ELSE 0 END + CASE WHEN coalesce({0}abstract, '') <> '' THEN 8 ELSE 0 END + CASE WHEN coalesce({0}pdf_url, '') <> '' THEN 16 ELSE 0 END + CASE WHEN coalesce({0}cite_key, '') <> '' THEN 32 ELSE 0 END"
_PICK = "coalesce(arg_max({0}, rec_id) FILTER (WHERE takes AND coalesce({0}, '') <> ''), arg_min({0}, rec_id) FILTER (WHERE coalesce({0}, '') <> '')) AS {0}"


@query(
    f"""WITH z AS (SELECT *, CASE WHEN regexp_replace(coalesce(item_key, ''), '{_SP}+', '', 'g') <> '' THEN item_key ELSE 'title:' || lower({_clean('title')}) || ':' || coalesce(CAST(year AS VARCHAR), '') END AS key, {_RICH.format('')} AS mask FROM zotero_results),
    b AS (SELECT *, bit_or(mask) OVER (PARTITION BY key ORDER BY rec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM z), t AS (SELECT *, seen IS NULL OR bit_count(mask) > bit_count(seen) AS takes FROM b)
    SELECT key, {', '.join(_PICK.format(f) for f in ('doi', 'arxiv_id', 'pmid', 'abstract', 'pdf_url', 'cite_key', 'zotero_url'))} FROM t GROUP BY key"""
)
def library_merge(spark: SparkSession, folder: str) -> DataFrame:
    return merging.merged_items(table(spark, folder, "zotero_results")).select("key", *merging.FILLED)


@query()
def library_merge_lists(spark: SparkSession, folder: str) -> DataFrame:
    return merging.merged_items(table(spark, folder, "zotero_results")).select("key", "authors", "categories")


_TITLE = "nullif(trim(regexp_replace(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+', ' ', 'g')), '')"


@query()
def library_match(spark: SparkSession, folder: str) -> DataFrame:
    """The library's best item for each work of the open index."""
    c = F.col
    n = merging.matching_fields(table(spark, folder, "openalex_results"), "rec_id", "note_id", F.coalesce(c("doi"), c("ids.doi")), ids.arxiv_id(c("ids.arxiv")), c("title"), c("publication_year"))
    i = merging.matching_fields(table(spark, folder, "zotero_results"), "rec_id", "item_id", c("doi"), ids.arxiv_id(c("arxiv_id")), c("title"), c("year"))
    return merging.best_items(n, i)
