"""Queries of the reference's operators on the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import ids, scoring
from quillspark.functions.text import clean_text
from quillspark.operators import documents as docs_
from quillspark.operators import review
from quillspark.operators import tabular as tab
from quillspark.operators.graph import connected_components, hop_distances
from quillspark.plans import discovery
from quillspark.sources import sinks
from quillspark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEYWORDS = ["calibration", "forests", "attention"]


def query(sql: str | None = None):
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@query()
def discovery_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: five sources to a ranked list (a top-k report, so the limit is the feature)."""
    records = discovery.normalized_records(*(table(spark, folder, f"{x}_results") for x in discovery.SOURCES))
    return discovery.ranked_works(records, ["W2000506014", "pmid:10216575"], KEYWORDS, 2015, 2026, 30, repeated="keep")


@query()
def discovery_violations(spark: SparkSession, folder: str) -> DataFrame:
    records = discovery.normalized_records(*(table(spark, folder, f"{x}_results") for x in discovery.SOURCES))
    return discovery.manifest_violations(discovery.ranked_works(records, ["W2000506014"], KEYWORDS, 2015, 2026, None, repeated="keep"))


#: SQL of the identifiers of the records with a title, in the five dialects, by record; written apart from the
#: expressions it checks.
_IDENTIFIERS = r"""raw AS (
    SELECT rec_id, title, coalesce(nullif(arxiv_id, ''), nullif(id, '')) AS ax, doi AS d, CAST(NULL AS VARCHAR) AS w, pmid AS p FROM zotero_results
    UNION ALL SELECT rec_id, title, id, NULL, NULL, NULL FROM arxiv_results
    UNION ALL SELECT rec_id, title, ids.arxiv, coalesce(nullif(doi, ''), nullif(ids.doi, '')), coalesce(nullif(id, ''), nullif(ids.openalex, '')), ids.pmid FROM openalex_results
    UNION ALL SELECT rec_id, title, url, url, url, NULL FROM web_results
    UNION ALL SELECT rec_id, title, NULL, doi, NULL, coalesce(nullif(pmid, ''), nullif(uid, '')) FROM pubmed_results),
kept AS (SELECT rec_id, trim(ax) AS ax, regexp_replace(regexp_replace(lower(trim(d)), '^https?://(dx\.)?doi\.(org|example)/', ''), '^doi:\s*', '') AS d,
        regexp_replace(regexp_replace(lower(trim(ax)), '^https?://(dx\.)?doi\.(org|example)/', ''), '^doi:\s*', '') AS axd, w, p, regexp_replace(lower(trim(p)), '^(pmid|pubmed)\s*:\s*', '') AS pb
    FROM raw WHERE regexp_replace(coalesce(title, ''), '[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+', '', 'g') <> ''),
idents AS (SELECT rec_id, CASE WHEN NOT (regexp_full_match(axd, '10\.[0-9]{4,9}/\S+') AND NOT contains(lower(ax), 'arxiv')) THEN coalesce(nullif(regexp_extract(ax, '([0-9]{4}\.[0-9]{4,5})', 1), ''), nullif(regexp_extract(ax, '(?i)arxiv[:/ ]([a-z\-.]+/[0-9]{7})', 1), '')) END AS arxiv_id,
        CASE WHEN regexp_full_match(d, '10\.[0-9]{4,9}/\S+') THEN d END AS doi, upper(nullif(regexp_extract(w, '(?i)(w[0-9]+)', 1), '')) AS openalex_id,
        CASE WHEN regexp_full_match(pb, '[0-9]{5,12}') THEN pb WHEN contains(lower(p), 'pmid') OR contains(lower(p), 'pubmed') THEN nullif(regexp_extract(pb, '([0-9]{5,12})', 1), '') END AS pmid FROM kept)"""


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.normalized_records(*(table(spark, folder, f"{x}_results") for x in discovery.SOURCES))


@query(f"WITH {_IDENTIFIERS} SELECT rec_id AS rid, arxiv_id, doi, openalex_id, pmid FROM idents")
def discovery_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """The identifiers that the five dialects give, of every record with a title."""
    return _records(spark, folder).select("rid", *discovery.KINDS)


@query(
    f"""WITH RECURSIVE {_IDENTIFIERS}, named AS (SELECT rec_id, 'a' || arxiv_id AS v FROM idents WHERE arxiv_id IS NOT NULL UNION SELECT rec_id, 'd' || doi FROM idents WHERE doi IS NOT NULL UNION SELECT rec_id, 'o' || openalex_id FROM idents WHERE openalex_id IS NOT NULL UNION SELECT rec_id, 'p' || pmid FROM idents WHERE pmid IS NOT NULL),
    star AS (SELECT rec_id, min(rec_id) OVER (PARTITION BY v) AS low FROM named), l AS (SELECT DISTINCT rec_id AS u, low AS v FROM star UNION SELECT DISTINCT low, rec_id FROM star),
    r AS (SELECT u AS node, u AS seen FROM l UNION SELECT r.node, l.v FROM r JOIN l ON r.seen = l.u), c AS (SELECT node, min(seen) AS low FROM r GROUP BY node)
    SELECT rec_id AS rid, '0' || lpad(CAST(coalesce(low, rec_id) AS VARCHAR), 19, '0') AS "group" FROM idents LEFT JOIN c ON node = rec_id"""
)
def discovery_groups(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.identifier_groups(_records(spark, folder))


@query(
    """WITH s AS (SELECT doc_id, (CASE WHEN contains(lower(text), 'calibration') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'forests') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'attention') THEN 1 ELSE 0 END) / 3.0 AS kw,
    CASE WHEN n_chars > 0 THEN least(1.0, log10(n_chars + 1) / 4) ELSE 0.0 END AS cites, (greatest(2010, least(2026, 2000 + doc_id % 27)) - 2010) / 16.0 AS recency FROM documents)
    SELECT doc_id, round(0.3 * kw + 0.2 * recency + 0.2 * cites, 4) AS score FROM s ORDER BY score DESC, doc_id LIMIT 30"""
)
def rank_topk(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").select("doc_id", "text", F.col("n_chars").cast("double").alias("n"), (2000 + F.col("doc_id") % 27).alias("year"))
    score = scoring.relevance(scoring.keyword_score(F.coalesce("text", F.lit("")), KEYWORDS), F.lit(0.0), scoring.recency_score(F.col("year"), 2026, 2010), scoring.citation_score(F.col("n")))
    return d.select("doc_id", score.alias("score")).orderBy(F.desc("score"), "doc_id").limit(30)


@query(
    """SELECT o_orderkey, rk AS rank, CASE WHEN rk * 1.0 / n <= 0.3 THEN 'high' WHEN rk * 1.0 / n <= 0.7 THEN 'medium' ELSE 'low' END AS bucket
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rk, count(*) OVER () AS n FROM orders) t"""
)
def priority_bucket(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    ranked = tab.global_rank(o, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return ranked.select("o_orderkey", F.col("rank").cast("long").alias("rank"), tab.percentile_bucket(F.col("rank"), F.col("total")).alias("bucket"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL)")
def anti_append(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return tab.not_listed(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), listed, "o_orderkey")


@query("SELECT cite_key, catalog_id FROM paper_catalogs WHERE cite_key NOT IN (SELECT cite_key FROM segment_entries WHERE section_type = 'appendix' AND cite_key IS NOT NULL)")
def pipeline_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    busy = table(spark, folder, "segment_entries").where(F.col("section_type") == "appendix").select("cite_key")
    return tab.not_listed(table(spark, folder, "paper_catalogs").select("cite_key", "catalog_id").where("cite_key IS NOT NULL"), busy, "cite_key")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 40) THEN 'P' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def promote_status(spark: SparkSession, folder: str) -> DataFrame:
    exported = table(spark, folder, "lineitem").where("l_quantity >= 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return tab.promoted(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), exported, "o_orderkey", "o_orderstatus", "O", "P")


@query("SELECT DISTINCT s_suppkey, s_acctbal FROM supplier JOIN lineitem ON s_suppkey = l_suppkey WHERE l_quantity >= 49")
def watch_overlap(spark: SparkSession, folder: str) -> DataFrame:
    held = table(spark, folder, "lineitem").where("l_quantity >= 49").select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    return table(spark, folder, "supplier").select("s_suppkey", "s_acctbal").join(held, "s_suppkey", "left_semi")


@query("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_discount >= 0.09) ORDER BY s_acctbal DESC NULLS LAST, s_suppkey LIMIT 10")
def watch_gap_top10(spark: SparkSession, folder: str) -> DataFrame:
    held = table(spark, folder, "lineitem").where("l_quantity >= 50 AND l_discount >= 0.09").select(F.col("l_suppkey").alias("s_suppkey"))
    gaps = tab.not_listed(table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"), held, "s_suppkey")
    return gaps.orderBy(F.desc_nulls_last("s_acctbal"), "s_suppkey").limit(10)


@query(
    """SELECT p_brand, p_partkey, p_type FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_type LIKE '%ECONOMY%' THEN 2 WHEN p_type LIKE '%STANDARD%' THEN 1 ELSE 0 END DESC, p_partkey) AS rn FROM part) t WHERE rn = 1"""
)
def tier_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rank = F.when(F.col("p_type").contains("ECONOMY"), 2).when(F.col("p_type").contains("STANDARD"), 1).otherwise(0)
    return tab.preferred_row(table(spark, folder, "part").select("p_brand", "p_partkey", "p_type"), "p_brand", rank, F.col("p_partkey"))


@query(
    """WITH RECURSIVE e AS (SELECT DISTINCT 'z' || rec_id AS a, 'd' || lower(doi) AS b FROM zotero_results WHERE doi IS NOT NULL UNION SELECT DISTINCT 'z' || rec_id, 'k' || item_key FROM zotero_results WHERE item_key IS NOT NULL),
    l AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e), r AS (SELECT u AS node, u AS seen FROM l UNION SELECT r.node, l.v FROM r JOIN l ON r.seen = l.u)
    SELECT node, min(seen) AS component FROM r GROUP BY node"""
)
def component_merge(spark: SparkSession, folder: str) -> DataFrame:
    z = table(spark, folder, "zotero_results")
    node = F.concat(F.lit("z"), F.col("rec_id").cast("string"))
    edges = z.where("doi IS NOT NULL").select(node.alias("a"), F.concat(F.lit("d"), F.lower("doi")).alias("b")).union(z.where("item_key IS NOT NULL").select(node, F.concat(F.lit("k"), F.col("item_key"))))
    return connected_components(edges)


@query(
    """WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS a, 'n' || n_nationkey AS b FROM nation UNION SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
    l AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e), d AS (SELECT 'n3' AS node, 0 AS distance UNION SELECT l.v, d.distance + 1 FROM d JOIN l ON d.node = l.u WHERE d.distance < 6)
    SELECT node, min(distance) AS distance FROM d GROUP BY node"""
)
def bfs_distance(spark: SparkSession, folder: str) -> DataFrame:
    n, s, c = (table(spark, folder, x) for x in ("nation", "supplier", "customer"))
    e = lambda df, p, a, q, b: df.select(F.concat(F.lit(p), F.col(a)).alias("a"), F.concat(F.lit(q), F.col(b)).alias("b"))
    edges = e(n, "r", "n_regionkey", "n", "n_nationkey").union(e(s, "n", "s_nationkey", "s", "s_suppkey")).union(e(c, "n", "c_nationkey", "c", "c_custkey"))
    return hop_distances(edges, spark.createDataFrame([("n3",)], "node string"))


@query(
    r"""SELECT rec_id, CASE WHEN regexp_full_match(d, '10\.[0-9]{4,9}/\S+') THEN d END AS doi, CASE WHEN w <> '' THEN w END AS openalex_id, try_cast(CASE WHEN y <> '' THEN y END AS INTEGER) AS year
    FROM (SELECT rec_id, regexp_replace(regexp_replace(lower(trim(doi)), '^https?://(dx\.)?doi\.(org|example)/', ''), '^doi:\s*', '') AS d, upper(regexp_extract(id, '(?i)(w[0-9]+)', 1)) AS w, regexp_extract(CAST(publication_year AS VARCHAR), '((?:19|20)[0-9]{2})', 1) AS y FROM openalex_results) t"""
)
def id_cleaners(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "openalex_results").select("rec_id", ids.clean_doi(F.col("doi")).alias("doi"), ids.clean_openalex(F.col("id")).alias("openalex_id"), ids.parse_year(F.col("publication_year")).alias("year"))


@query(
    r"""SELECT rec_id, CASE WHEN regexp_full_match(b, '[0-9]{5,12}') THEN b WHEN contains(lower(pmid), 'pmid') OR contains(lower(pmid), 'pubmed') THEN nullif(regexp_extract(b, '([0-9]{5,12})', 1), '') END AS pmid,
    CAST(nullif(regexp_extract(pubdate, '((?:19|20)[0-9]{2})', 1), '') AS INTEGER) AS year FROM (SELECT *, regexp_replace(lower(trim(pmid)), '^(pmid|pubmed):\s*', '') AS b FROM pubmed_results) t"""
)
def pubmed_cleaners(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pubmed_results").select("rec_id", ids.clean_pmid(F.col("pmid")).alias("pmid"), ids.parse_year(F.col("pubdate")).alias("year"))


@query(r"SELECT rec_id, nullif(regexp_extract(lower(id), '([0-9]{4}\.[0-9]{4,5})', 1), '') AS arxiv_id, CAST(substr(published, 1, 4) AS INTEGER) AS year FROM arxiv_results")
def arxiv_cleaners(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "arxiv_results").select("rec_id", ids.arxiv_id(F.col("id")).alias("arxiv_id"), ids.parse_year(F.col("published")).alias("year"))


@query(
    r"""SELECT doc_id, len([x for x in regexp_split_to_array(text, '\r?\n') if starts_with(x, '## ')]) AS sections, len([x for x in regexp_split_to_array(text, '[ \t\r\n]+') if x <> '']) AS words,
    CAST(floor((length(text) - length(replace(text, '$$', ''))) / 2 / 2) AS BIGINT) AS equations, CAST(floor(length(text) / 4) AS BIGINT) AS token_estimate,
    ((length(text) - length(replace(text, '$$', ''))) / 2) % 2 = 0 AND length(replace(text, '$$', '')) % 2 = length(replace(replace(text, '$$', ''), '$', '')) % 2 AS balanced FROM documents WHERE text IS NOT NULL"""
)
def doc_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", *docs_.document_metrics(F.col("text")))


@query(
    """SELECT t.term, count(w.rec_id) AS n FROM (VALUES ('calibration'), ('forests'), ('attention'), ('no such term')) t(term) LEFT JOIN (SELECT rec_id, lower(title) AS lt FROM web_results) w ON contains(w.lt, t.term) GROUP BY t.term"""
)
def keyword_hits(spark: SparkSession, folder: str) -> DataFrame:
    terms = [*KEYWORDS, "no such term"]
    low = F.lower("title")
    hits = table(spark, folder, "web_results").select(F.explode(F.filter(F.array(*(F.when(low.contains(t), F.lit(t)) for t in terms)), lambda x: x.isNotNull())).alias("term"))
    return tab.zero_filled_counts(hits, "term", terms)


@query(
    r"""WITH c AS (SELECT rec_id AS claim_id, list_distinct([x for x in regexp_split_to_array(lower(title), '[^a-z0-9]+') if length(x) > 2]) AS t FROM web_results), n AS (SELECT rec_id AS note_id, list_distinct([x for x in regexp_split_to_array(lower(title), '[^a-z0-9]+') if length(x) > 2]) AS t FROM zotero_results),
    p AS (SELECT claim_id, note_id, len(list_intersect(c.t, n.t)) AS shared, greatest(5, 0) AS need FROM c, n)
    SELECT claim_id, note_id, CAST(shared AS INTEGER) AS shared FROM p JOIN (SELECT claim_id AS cid, greatest(2, least(4, CAST(floor(len(t) / 2) AS INTEGER))) AS need2 FROM c) q ON cid = claim_id WHERE shared >= need2"""
)
def claim_overlap(spark: SparkSession, folder: str) -> DataFrame:
    tokens = F.array_distinct(F.filter(F.split(F.lower("title"), "[^a-z0-9]+"), lambda w: F.length(w) > 2))
    claims = table(spark, folder, "web_results").select(F.col("rec_id").alias("claim_id"), tokens.alias("tokens"))
    return tab.overlap_matches(claims, table(spark, folder, "zotero_results").select(F.col("rec_id").alias("note_id"), tokens.alias("tokens")))


@query(r"""SELECT mark, min(doc_id) AS doc_id, count(*) AS n FROM (SELECT doc_id, substr(lower(trim(regexp_replace(text, '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))), 1, 120) AS mark FROM documents WHERE text IS NOT NULL) t WHERE mark <> '' GROUP BY mark""")
def near_dup_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.prefix_distinct(table(spark, folder, "documents"), "doc_id", "text")


@query("SELECT comprehension_status, section_type, count(*) AS n FROM segment_entries GROUP BY comprehension_status, section_type")
def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "segment_entries").groupBy("comprehension_status", "section_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(t, 'we propose|we introduce|our contribution|in this paper, we') THEN 'CONTRIBUTION' WHEN regexp_matches(t, 'however|limitation|gap|missing|fails to|lack of') THEN 'GAP' WHEN regexp_matches(t, 'previous work|prior work|has been studied|et al\\.') THEN 'PRIOR_WORK'
    WHEN regexp_matches(t, 'motivated by|challenge|difficulty|problem of') THEN 'MOTIVATION' WHEN regexp_matches(t, 'the rest of this paper|section|organized as follows|outline') THEN 'ROADMAP' ELSE 'BACKGROUND' END AS block
    FROM (SELECT doc_id, lower(text) AS t FROM documents WHERE text IS NOT NULL) d"""
)
def block_class(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", docs_.first_rule(F.col("text"), docs_.BLOCK_RULES, "BACKGROUND").alias("block"))


_LINES = r"SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line, generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) AS line_no FROM documents WHERE text IS NOT NULL"


@query(
    rf"""WITH l AS ({_LINES}) SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, last_value(CASE WHEN regexp_matches(line, '^#{{1,6}} ') THEN regexp_extract(line, '^#{{1,6}} +(.*?)[ \r]*$', 1) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM l"""
)
def carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.headed_lines(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", "text").select("doc_id", "line_no", "heading")


@query(
    rf"""WITH l AS ({_LINES}), h AS (SELECT * FROM l WHERE regexp_matches(line, '^#{{1,6}} ')), c AS (SELECT doc_id, max(line_no) AS n FROM l GROUP BY doc_id)
    SELECT h.doc_id, regexp_extract(line, '^#{{1,6}} +(.*?)[ \r]*$', 1) AS heading, CAST(line_no AS INTEGER) AS first_line, CAST(coalesce(lead(line_no) OVER (PARTITION BY h.doc_id ORDER BY line_no) - 1, n) AS INTEGER) AS last_line FROM h JOIN c ON h.doc_id = c.doc_id"""
)
def header_span(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.section_spans(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", "text")


@query(
    rf"""WITH l AS (SELECT doc_id, line_no, length(trim(line)) AS n, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM ({_LINES}) x WHERE length(trim(line)) > 0 AND length(trim(line)) < 30)
    SELECT doc_id, CAST(min(line_no) AS INTEGER) AS first_line, count(*) AS n FROM l GROUP BY doc_id, g HAVING count(*) >= 3"""
)
def short_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.short_line_runs(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", "text")


@query(
    """WITH f AS (SELECT l_orderkey, l_linenumber, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM lineitem WHERE l_returnflag = 'N'), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, g ORDER BY l_linenumber) AS rn FROM f)
    SELECT l_orderkey, min(l_linenumber) AS first, max(l_linenumber) AS second FROM r GROUP BY l_orderkey, g, CAST(floor((rn - 1) / 2) AS BIGINT) HAVING count(*) = 2"""
)
def adjacent_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return tab.adjacent_pairs(table(spark, folder, "lineitem").where("l_returnflag = 'N'"), "l_orderkey", "l_linenumber")


@query("SELECT seg_uid, coalesce(lead(id) OVER (PARTITION BY cite_key ORDER BY seg_uid), '') AS next_id FROM segment_entries")
def next_segment(spark: SparkSession, folder: str) -> DataFrame:
    rows = tab.neighbours(table(spark, folder, "segment_entries").select("cite_key", "seg_uid", "id"), "cite_key", "seg_uid", {"next_id": ("id", 1)})
    return rows.select("seg_uid", F.coalesce("next_id", F.lit("")).alias("next_id"))


@query("SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1")
def latest_status(spark: SparkSession, folder: str) -> DataFrame:
    return tab.latest_rows(table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])


@query("SELECT event_id, CASE WHEN event_type = 'signup' THEN 'manual-pending' WHEN event_type = 'purchase' THEN 'downloaded' WHEN event_type = 'error' AND value >= 50 THEN 'rate-limited' WHEN event_type = 'error' THEN 'failed-incomplete' ELSE 'pending' END AS status FROM events")
def step_status(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "signup", "manual-pending").when(kind == "purchase", "downloaded").when((kind == "error") & (F.col("value") >= 50), "rate-limited").when(kind == "error", "failed-incomplete").otherwise("pending")
    return table(spark, folder, "events").select("event_id", status.alias("status"))


@query("SELECT source, count(*) AS n, CAST(sum(CASE WHEN text IS NULL OR length(text) < 200 THEN 1 ELSE 0 END) AS BIGINT) AS hits, round(sum(CASE WHEN text IS NULL OR length(text) < 200 THEN 1 ELSE 0 END) * 1.0 / count(*), 3) AS rate FROM documents GROUP BY source HAVING count(*) >= 5")
def meta_gate(spark: SparkSession, folder: str) -> DataFrame:
    return tab.gated_rates(table(spark, folder, "documents"), "source", F.coalesce(F.length("text") < 200, F.lit(True)), 5)


@query("SELECT t.event_type, count(e.event_id) AS n FROM (VALUES ('click'), ('view'), ('error'), ('purchase'), ('signup'), ('refund')) t(event_type) LEFT JOIN events e ON e.event_type = t.event_type GROUP BY t.event_type")
def zero_fill_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tab.zero_filled_counts(table(spark, folder, "events"), "event_type", ["click", "view", "error", "purchase", "signup", "refund"])


@query("SELECT user_id, count(*) AS importance_score, count(DISTINCT CAST(ts AS DATE)) AS sessions_cited, min(ts) AS first_seen FROM events GROUP BY user_id")
def queue_merge(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("importance_score"), F.countDistinct(F.to_date("ts")).alias("sessions_cited"), F.min("ts").alias("first_seen"))


@query(
    """SELECT coalesce(a.cite_key, b.cite_key) AS cite_key, a.cite_key IS NOT NULL AS catalogs, b.cite_key IS NOT NULL AS documents FROM (SELECT DISTINCT cite_key FROM paper_catalogs WHERE cite_key IS NOT NULL) a FULL OUTER JOIN (SELECT DISTINCT cite_key FROM documents WHERE cite_key IS NOT NULL) b ON a.cite_key = b.cite_key WHERE a.cite_key IS NULL OR b.cite_key IS NULL"""
)
def full_outer_integrity(spark: SparkSession, folder: str) -> DataFrame:
    return tab.key_integrity({"catalogs": table(spark, folder, "paper_catalogs"), "documents": table(spark, folder, "documents")}, "cite_key")


@query("SELECT cite_key, id, count(*) AS n FROM segment_entries GROUP BY cite_key, id HAVING count(*) > 1")
def uniqueness_violations(spark: SparkSession, folder: str) -> DataFrame:
    return tab.repeated_keys(table(spark, folder, "segment_entries"), ["cite_key", "id"])


@query("SELECT seg_uid FROM (SELECT seg_uid, updated_at, lag(updated_at) OVER (PARTITION BY cite_key ORDER BY seg_uid) AS before FROM segment_entries) t WHERE before > updated_at")
def sort_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = tab.neighbours(table(spark, folder, "segment_entries").select("cite_key", "seg_uid", "updated_at"), "cite_key", "seg_uid", {"before": ("updated_at", -1)})
    return rows.where("before > updated_at").select("seg_uid")


@query(
    """WITH e AS (SELECT rec_id, map_keys(abstract_inverted_index) AS k, map_values(abstract_inverted_index) AS v FROM openalex_results WHERE abstract_inverted_index IS NOT NULL), w AS (SELECT rec_id, unnest(k) AS word, unnest(v) AS places, generate_subscripts(k, 1) AS i FROM e),
    p AS (SELECT rec_id, word, i, unnest(places) AS pos FROM w), u AS (SELECT rec_id, pos, arg_max(word, i) AS word FROM p GROUP BY rec_id, pos)
    SELECT e.rec_id, coalesce(string_agg(word, ' ' ORDER BY pos), '') AS abstract FROM e LEFT JOIN u ON u.rec_id = e.rec_id GROUP BY e.rec_id"""
)
def inverted_abstract(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "openalex_results").where("abstract_inverted_index IS NOT NULL").select("rec_id", ids.inverted_abstract(F.col("abstract_inverted_index")).alias("abstract"))


@query(
    """WITH p AS (SELECT z.rec_id AS z_id, p.rec_id AS p_id, CASE WHEN lower(z.doi) = lower(p.doi) THEN 100 ELSE 0 END + CASE WHEN z.pmid = p.uid THEN 70 ELSE 0 END + CASE WHEN lower(z.title) = lower(p.title) THEN 30 ELSE 0 END AS score FROM zotero_results z JOIN pubmed_results p ON lower(z.doi) = lower(p.doi) OR z.pmid = p.uid OR lower(z.title) = lower(p.title))
    SELECT z_id, p_id, score FROM (SELECT *, row_number() OVER (PARTITION BY z_id ORDER BY score DESC, p_id) AS rn FROM p) t WHERE rn = 1"""
)
def best_match_argmax(spark: SparkSession, folder: str) -> DataFrame:
    forms = lambda df, a, pm: df.select(F.col("rec_id").alias(a), F.explode(F.array(F.struct(F.lit(100).alias("w"), F.lower("doi").alias("v")), F.struct(F.lit(70).alias("w"), F.col(pm).alias("v")), F.struct(F.lit(30).alias("w"), F.lower("title").alias("v")))).alias("f")).where("f.v IS NOT NULL")
    z, p = forms(table(spark, folder, "zotero_results"), "z_id", "pmid"), forms(table(spark, folder, "pubmed_results"), "p_id", "uid")
    pairs = z.join(p, "f").groupBy("z_id", "p_id").agg(F.sum("f.w").cast("int").alias("points"))
    return tab.best_match(pairs, "z_id", "p_id", F.col("points"))


@query(
    """SELECT c_custkey, CASE WHEN m % 4 = 0 THEN code || '.SH' WHEN m % 4 = 1 THEN code || '.HK' WHEN m % 4 = 2 THEN 'T' || code ELSE 'X?' || code END AS ticker, CASE WHEN m % 4 IN (0, 1) THEN 'mapped_exchange' WHEN m % 4 = 2 THEN 'us_bare' ELSE 'preserved_unknown' END AS kind
    FROM (SELECT c_custkey, c_custkey AS m, CASE WHEN c_custkey % 4 = 0 THEN '6' || lpad(CAST(c_custkey % 90000 AS VARCHAR), 5, '0') WHEN c_custkey % 4 = 1 THEN lpad(CAST(c_custkey % 90000 AS VARCHAR), 5, '0') ELSE CAST(c_custkey AS VARCHAR) END AS code FROM customer) t"""
)
def ticker_forms(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    five = F.lpad((k % 90000).cast("string"), 5, "0")  # lpad would cut longer keys
    raw = F.when(k % 4 == 0, F.concat(F.lit("6"), five, F.lit("-CN"))).when(k % 4 == 1, F.concat(five, F.lit(" HK"))).when(k % 4 == 2, F.concat(F.lit("t"), k.cast("string"), F.lit("-US"))).otherwise(F.concat(F.lit("X?"), k.cast("string")))
    return table(spark, folder, "customer").select("c_custkey", ids.ticker(raw).alias("t")).select("c_custkey", "t.ticker", "t.kind")


@query(r"SELECT doc_id, regexp_extract(l, '^([A-Za-z_]+):', 1) AS field, trim(regexp_replace(regexp_extract(l, '^[A-Za-z_]+:(.*)$', 1), '[ \t]+', ' ', 'g')) AS value FROM (SELECT doc_id, unnest(regexp_split_to_array(regexp_extract(text, '(?s)^---\r?\n(.*?)\r?\n---', 1), '\r?\n')) AS l FROM documents WHERE text IS NOT NULL) t WHERE regexp_matches(l, '^[A-Za-z_]+:')")
def front_matter(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.front_matter(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", F.col("text"))


@query(r"SELECT doc_id, target, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\cite\{([A-Za-z0-9_]+)\}', 1)) AS target FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '\[\[([a-z0-9_]+)', 1)) FROM documents WHERE text IS NOT NULL) t GROUP BY doc_id, target")
def cited_keys(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.cited_keys(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", F.col("text"))


@query(r"SELECT doc_id, CAST(generate_subscripts(s, 1) AS INTEGER) AS number, unnest(s) AS label FROM (SELECT doc_id, regexp_extract_all(text, '\\label\{(eq:[A-Za-z0-9_]+)\}', 1) AS s FROM documents WHERE text IS NOT NULL) t")
def equation_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.labelled_equations(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", F.col("text"))


@query(r"SELECT doc_id, CAST(generate_subscripts(s, 1) AS INTEGER) AS ordinal, trim(regexp_replace(unnest(s), '[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+', ' ', 'g')) AS statement FROM (SELECT doc_id, regexp_extract_all(text, '(?s)\\begin\{(?:theorem|lemma)\}(.*?)\\end\{(?:theorem|lemma)\}', 1) AS s FROM documents WHERE text IS NOT NULL) t")
def theorem_index(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.environments(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", F.col("text"), ["theorem", "lemma"])


@query(
    rf"""WITH l AS (SELECT doc_id, line_no, line, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM ({_LINES}) x WHERE regexp_full_match(line, '\s*\|.*\|\s*')),
    c AS (SELECT *, [trim(y) FOR y IN string_split(regexp_replace(trim(line), '^\||\|$', '', 'g'), '|')] AS cells, row_number() OVER (PARTITION BY doc_id, g ORDER BY line_no) AS rn FROM l), h AS (SELECT *, first_value(len(cells)) OVER (PARTITION BY doc_id, g ORDER BY line_no) AS w FROM c)
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(list_resize(cells, w, '') AS VARCHAR[]) AS cells FROM h WHERE rn > 1 AND NOT regexp_full_match(line, '[\s|:\-]+')"""
)
def table_cells(spark: SparkSession, folder: str) -> DataFrame:
    return docs_.table_cells(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", "text")


@query()
def segments_pack(spark: SparkSession, folder: str) -> DataFrame:
    packed = docs_.packed_paragraphs(F.col("text"), 16_384)
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(packed).alias("position", "segment")).select("doc_id", "position", F.octet_length("segment").alias("bytes"))


@query(
    """SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal FROM (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0) o FULL OUTER JOIN (SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_custkey % 3 = 0) n ON o.c_custkey = n.c_custkey"""
)
def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return tab.upserted(c.where("c_custkey % 2 = 0"), c.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") * 2), "c_custkey")


@query(
    """SELECT user_id, event_id, value FROM (SELECT *, sum(size) OVER (PARTITION BY user_id) - 300 AS over_, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 0 ELSE size END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS dropped
    FROM (SELECT *, CAST(floor(value) AS BIGINT) AS size FROM events WHERE value IS NOT NULL) e) t WHERE event_type = 'purchase' OR dropped >= over_"""
)
def budget_eviction(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").where("value IS NOT NULL").withColumn("size", F.floor("value"))
    return tab.within_budget(e, "user_id", "event_id", "size", F.col("event_type") == "purchase", 300).select("user_id", "event_id", "value")


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS bucket, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) % 10")
def json_fields(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int") % 10
    return table(spark, folder, "events").groupBy("event_type", k.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    """WITH t AS (SELECT DISTINCT rec_id, unnest(categories) AS tag FROM zotero_results), u AS (SELECT DISTINCT rec_id, unnest(categories) AS tag FROM web_results) SELECT t.rec_id AS a, u.rec_id AS b, count(*) AS shared FROM t JOIN u ON t.tag = u.tag GROUP BY t.rec_id, u.rec_id HAVING count(*) >= 2"""
)
def shared_tags(spark: SparkSession, folder: str) -> DataFrame:
    tags = lambda n, k: table(spark, folder, n).select(F.col("rec_id").alias(k), F.explode(F.array_distinct("categories")).alias("tag"))
    return tags("zotero_results", "a").join(tags("web_results", "b"), "tag").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")).where("shared >= 2")


@query(
    r"""WITH c AS (SELECT rec_id, coalesce(uid, 'rec' || rec_id) AS k, regexp_replace(trim(regexp_replace(coalesce(title, ''), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')), '([&%#_])', '\\\1', 'g') AS t, regexp_extract(coalesce(pubdate, ''), '((?:19|20)[0-9]{2})', 1) AS y FROM pubmed_results)
    SELECT rec_id, '@article{' || k || E',\n' || concat_ws(E',\n', CASE WHEN t <> '' THEN '  title = {' || t || '}' END, CASE WHEN y <> '' THEN '  year = {' || y || '}' END) || E'\n}' AS entry FROM c"""
)
def bibtex_entries(spark: SparkSession, folder: str) -> DataFrame:
    year = F.regexp_extract("pubdate", "((?:19|20)[0-9]{2})", 1)
    return table(spark, folder, "pubmed_results").select("rec_id", sinks.bibtex(F.coalesce(F.col("uid"), F.concat(F.lit("rec"), F.col("rec_id").cast("string"))), F.lit("article"), {"title": clean_text(F.col("title")), "year": year}).alias("entry"))


@query(
    r"""WITH a AS (SELECT doc_id, text, regexp_replace(text, '(?is)<nav(?:\s[^>]*)?>.*?</nav>', '', 'g') AS t1 FROM documents WHERE text IS NOT NULL), b AS (SELECT *, regexp_replace(t1, '(?is)<header(?:\s[^>]*)?>.*?</header>', '', 'g') AS t2 FROM a)
    SELECT doc_id, regexp_replace(t2, '(?is)<footer(?:\s[^>]*)?>.*?</footer>', '', 'g') AS content, CAST(len(regexp_extract_all(text, '(?is)<nav(?:\s[^>]*)?>.*?</nav>')) + len(regexp_extract_all(t1, '(?is)<header(?:\s[^>]*)?>.*?</header>')) + len(regexp_extract_all(t2, '(?is)<footer(?:\s[^>]*)?>.*?</footer>')) AS INTEGER) AS removed FROM b"""
)
def html_chrome(spark: SparkSession, folder: str) -> DataFrame:
    """Pages without their navigation, headers and footers, by patterns."""
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", *review.without_chrome(F.col("text")))


@query()
def html_content(spark: SparkSession, folder: str) -> DataFrame:
    """The words of every page without what surrounds its content, by a parser: classes and ids count too."""
    d = table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", review.page_content(F.col("text")).alias("p"))
    return d.select("doc_id", "p.content", "p.removed", "p.root")


@query(
    r"""SELECT DISTINCT doc_id, technique FROM documents, (VALUES ('Bernstein inequality', '\bbernstein(?:''s)?\s+inequalit(?:y|ies)\b'), ('Martingale argument', '\bmartingale\s+(?:argument|method|approach)\b'), ('Union bound', '\bunion\s+bound\b'), ('Chaining argument', '\bchaining(?:\s+argument)?\b'), ('Concentration inequality', '\bconcentration\s+inequalit(?:y|ies)\b'),
    ('Azuma-Hoeffding inequality', '\bazuma(?:-|\s+)hoeffding\s+inequalit(?:y|ies)\b'), ('Azuma-Hoeffding inequality', '\bhoeffding\s+inequalit(?:y|ies)\b'), ('Doob decomposition', '\bdoob(?:-|\s+)meyer\s+decomposition\b'), ('Doob decomposition', '\bdoob\s+decomposition\b'), ('Gronwall inequality', '\bgronwall\s+inequalit(?:y|ies)\b'),
    ('Coupling argument', '\bcoupling\s+argument\b'), ('Fixed-point argument', '\bfixed(?:-|\s+)point\s+argument\b')) t(technique, p) WHERE text IS NOT NULL AND regexp_matches(lower(text), p)"""
)
def proof_techniques(spark: SparkSession, folder: str) -> DataFrame:
    return review.technique_hits(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", "text")


@query(r"SELECT doc_id, symbol, count(*) AS uses FROM (SELECT doc_id, unnest(regexp_extract_all(replace(text, '$$', E'\n\n'), '\$([^$\n]+)\$', 1)) AS symbol FROM documents WHERE text IS NOT NULL) t GROUP BY doc_id, symbol")
def notation_uses(spark: SparkSession, folder: str) -> DataFrame:
    return review.notation(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", F.col("text"))


@query(
    """WITH s AS (SELECT cite_key, seg_uid, strlen(body) AS sz, row_number() OVER w AS pos, lead(seg_uid) OVER w AS nxt FROM segment_entries WINDOW w AS (PARTITION BY cite_key ORDER BY seg_uid)), m AS (SELECT *, coalesce(sz < 300, true) AS small FROM s),
    i AS (SELECT *, pos - sum(CASE WHEN small THEN 1 ELSE 0 END) OVER (PARTITION BY cite_key ORDER BY seg_uid) AS island FROM m), r AS (SELECT *, row_number() OVER (PARTITION BY cite_key, island, small ORDER BY seg_uid) AS rin, count(*) OVER (PARTITION BY cite_key, island, small) AS rof FROM i),
    a AS (SELECT *, CASE WHEN sz > 4096 THEN 'split' WHEN small AND rin % 2 = 1 AND rin < rof THEN 'merge' WHEN small AND rin % 2 = 1 THEN 'rebalance' END AS action FROM r)
    SELECT cite_key, seg_uid, action, CASE WHEN action <> 'split' THEN nxt END AS partner FROM a WHERE action IS NOT NULL"""
)
def reseg_plan(spark: SparkSession, folder: str) -> DataFrame:
    return review.resegmentation(table(spark, folder, "segment_entries"), "cite_key", "seg_uid", F.octet_length("body"), 4096, 300)


@query(
    """WITH o AS (SELECT c_custkey AS k, c_mktsegment AS a, c_nationkey AS b FROM customer WHERE c_custkey % 5 <> 0), n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS a, c_nationkey AS b FROM customer WHERE c_custkey % 3 <> 0)
    SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'updated' END AS change FROM o FULL OUTER JOIN n ON o.k = n.k WHERE o.k IS NULL OR n.k IS NULL OR o.a <> n.a OR o.b <> n.b"""
)
def catalog_diff(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("a"), F.col("c_nationkey").alias("b"))
    new = c.where("k % 3 <> 0").withColumn("a", F.when(F.col("k") % 7 == 0, "CHANGED").otherwise(F.col("a")))
    return review.catalog_difference(c.where("k % 5 <> 0"), new, "k", ["a", "b"])


@query()
def small_merge(spark: SparkSession, folder: str) -> DataFrame:
    return review.merge_small_segments(table(spark, folder, "segment_entries"), "cite_key", "seg_uid", F.octet_length("body"))


@query()
def balanced_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = review.split_oversized(table(spark, folder, "segment_entries").where("body IS NOT NULL"), "seg_uid", "body")
    return parts.select("seg_uid", "part", F.octet_length("body").alias("bytes"))


@query(
    """WITH r(section_type, reader) AS (VALUES ('introduction', 'intro'), ('method', 'method'), ('theory', 'theory'), ('appendix', 'appendix')), p AS (SELECT DISTINCT section_type FROM segment_entries WHERE coalesce(comprehension_status, 'pending') = 'pending'),
    n AS (SELECT section_type, seg_uid, row_number() OVER (PARTITION BY section_type ORDER BY seg_uid) AS rn FROM segment_entries) SELECT reader, p.section_type, seg_uid AS note_id FROM p JOIN r ON p.section_type = r.section_type LEFT JOIN n ON n.section_type = p.section_type AND rn <= 3"""
)
def reader_routes(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "segment_entries")
    routes = {"introduction": "intro", "method": "method", "theory": "theory", "appendix": "appendix"}
    return review.reader_routes(s.select("section_type", F.col("comprehension_status").alias("status")), s.select(F.col("seg_uid").alias("note_id"), "section_type"), routes)


@query(
    """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN c_custkey % 50 WHEN 1 THEN (c_custkey % 50) * 1000.0 WHEN 2 THEN c_custkey % 50 WHEN 3 THEN (c_custkey % 50) * 1000.0 WHEN 4 THEN c_custkey % 50 + 0.5 WHEN 5 THEN (c_custkey % 50) * 1000.0 END AS cap FROM customer"""
)
def market_caps(spark: SparkSession, folder: str) -> DataFrame:
    """The customers' keys written as market caps in every spelling: bn, T, BILLION, trillion, b, Tn, no unit, NA."""
    k = (F.col("c_custkey") % 50).cast("string")
    spelt = [F.concat(F.lit("about "), k, F.lit(" bn")), F.concat(F.lit("$"), k, F.lit("T")), F.concat(k, F.lit(" BILLION")), F.concat(k, F.lit("trillion dollars")), F.concat(k, F.lit(".5b")), F.concat(k, F.lit(" Tn")), F.concat(k, F.lit(" euros")), F.lit("NA")]
    return table(spark, folder, "customer").select("c_custkey", review.market_cap(F.get(F.array(*spelt), (F.col("c_custkey") % 8).cast("int"))).alias("cap"))
