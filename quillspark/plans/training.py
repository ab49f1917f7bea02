"""Queries of the general training-data problems (4: nested records, 5: orphan references)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.operators.nested import nested_nodes
from quillspark.operators.orphans import catalog_orphans, orphan_report
from quillspark.sources.tables import table


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    return catalog_orphans(*(table(spark, folder, x) for x in ("openalex_results", "pubmed_results", "paper_catalogs", "segment_entries", "withdrawals")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested_nodes(table(spark, folder, "openalex_results"), table(spark, folder, "paper_catalogs"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder).select("src_table", "src_id", "ref_key", "ref_month").distinct()


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_report(_orphans(spark, folder))


QUERIES = {"p4_found": p4_found, "p5_found": p5_found, "p5_report": p5_report}
ORACLES: dict[str, str] = {
    "p4_found": r"""WITH RECURSIVE parsed AS (SELECT catalog_id, json(sections) AS j FROM paper_catalogs WHERE json_valid(sections)),
lists AS (SELECT catalog_id, CASE WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.sections') THEN json_extract(j, '$.sections') ELSE j END AS l FROM parsed),
nodes AS (SELECT catalog_id, CAST(i AS VARCHAR) AS node_path, '' AS parent_path, CASE WHEN json_type(l) = 'ARRAY' THEN json_extract(l, '$[' || (i - 1) || ']') ELSE l END AS node
    FROM (SELECT catalog_id, l, unnest(range(1, CASE WHEN json_type(l) = 'ARRAY' THEN CAST(json_array_length(l) AS BIGINT) WHEN json_type(l) = 'OBJECT' THEN 1 ELSE 0 END + 1)) AS i FROM lists) a
    UNION ALL SELECT catalog_id, node_path || '.' || i, node_path, CASE WHEN json_type(c) = 'ARRAY' THEN json_extract(c, '$[' || (i - 1) || ']') ELSE c END
    FROM (SELECT catalog_id, node_path, c, unnest(range(1, CASE WHEN json_type(c) = 'ARRAY' THEN CAST(json_array_length(c) AS BIGINT) WHEN json_type(c) = 'OBJECT' THEN 1 ELSE 0 END + 1)) AS i FROM (SELECT catalog_id, node_path, json_extract(node, '$.children') AS c FROM nodes WHERE json_type(node) = 'OBJECT') b) d)
SELECT 'paper_catalogs' AS src_table, catalog_id AS src_id, 'sections' AS field_name, node_path, parent_path, coalesce(trim(json_extract_string(node, '$.id'), chr(32) || chr(9) || chr(10) || chr(13)), '') AS item_value FROM nodes WHERE json_type(node) = 'OBJECT'
UNION ALL SELECT 'openalex_results', rec_id, 'referenced_works', CAST(i AS VARCHAR), '', x FROM (SELECT rec_id, unnest(referenced_works) AS x, generate_subscripts(referenced_works, 1) AS i FROM openalex_results) r WHERE x IS NOT NULL
UNION ALL SELECT 'openalex_results', rec_id, 'authorships', CAST(i AS VARCHAR), '', x.author.display_name FROM (SELECT rec_id, unnest(authorships) AS x, generate_subscripts(authorships, 1) AS i FROM openalex_results) r WHERE trim(coalesce(x.author.display_name, '')) <> ''""",
    "p5_found": r"""WITH RECURSIVE gone AS (SELECT target_table AS tab, CASE WHEN target_table = 'openalex_results' THEN upper(regexp_extract(target_key, '(?i)(w[0-9]+)', 1)) WHEN target_table = 'pubmed_results' THEN 'pmid:' || regexp_extract(target_key, '([0-9]+)', 1) ELSE lower(trim(target_key)) END AS k, max(withdrawn_at) AS gone_at FROM withdrawals GROUP BY 1, 2),
works AS (SELECT upper(regexp_extract(id, '(?i)(w[0-9]+)', 1)) AS k, min(retrieved_at) AS first_at, max(retrieved_at) AS last_at, 'openalex_results' AS tab FROM openalex_results GROUP BY 1 UNION ALL SELECT 'pmid:' || uid, min(retrieved_at), max(retrieved_at), 'pubmed_results' FROM pubmed_results GROUP BY 1),
papers AS (SELECT lower(trim(cite_key)) AS k, min(delivered_at) AS first_at, max(delivered_at) AS last_at, 'paper_catalogs' AS tab FROM paper_catalogs GROUP BY 1),
records AS (SELECT r.k, first_at, coalesce(last_at <= gone_at, false) AS withdrawn FROM (SELECT * FROM works UNION ALL SELECT * FROM papers) r LEFT JOIN gone g ON g.tab = r.tab AND g.k = r.k),
parsed AS (SELECT catalog_id, lower(trim(cite_key)) AS ck, coalesce(trim(paper.source_dir), '') AS dir, delivered_at, json(sections) AS j FROM paper_catalogs WHERE json_valid(sections)),
lists AS (SELECT *, CASE WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.sections') THEN json_extract(j, '$.sections') ELSE j END AS l FROM parsed),
readable AS (SELECT catalog_id, ck, dir, delivered_at, l FROM lists WHERE json_type(l) IN ('ARRAY', 'OBJECT')),
nodes AS (SELECT catalog_id, CASE WHEN json_type(l) = 'ARRAY' THEN json_extract(l, '$[' || (i - 1) || ']') ELSE l END AS node
    FROM (SELECT catalog_id, l, unnest(range(1, CASE WHEN json_type(l) = 'ARRAY' THEN CAST(json_array_length(l) AS BIGINT) ELSE 1 END + 1)) AS i FROM readable) a
    UNION ALL SELECT catalog_id, CASE WHEN json_type(c) = 'ARRAY' THEN json_extract(c, '$[' || (i - 1) || ']') ELSE c END
    FROM (SELECT catalog_id, c, unnest(range(1, CASE WHEN json_type(c) = 'ARRAY' THEN CAST(json_array_length(c) AS BIGINT) WHEN json_type(c) = 'OBJECT' THEN 1 ELSE 0 END + 1)) AS i FROM (SELECT catalog_id, json_extract(node, '$.children') AS c FROM nodes WHERE json_type(node) = 'OBJECT') b) d),
has AS (SELECT DISTINCT r.ck, r.dir, r.delivered_at, r.catalog_id, lower(trim(coalesce(json_extract_string(node, '$.id'), ''))) AS sec FROM nodes n JOIN readable r ON r.catalog_id = n.catalog_id WHERE json_type(node) = 'OBJECT'),
ends AS (SELECT ck, dir, catalog_id AS end_id FROM (SELECT *, row_number() OVER (PARTITION BY ck, dir ORDER BY delivered_at DESC NULLS LAST, catalog_id DESC) AS rn FROM readable) e WHERE rn = 1),
secs AS (SELECT h.ck, sec, min(delivered_at) AS first_at, bool_or(h.catalog_id = e.end_id) AS alive FROM has h JOIN ends e ON h.ck = e.ck AND h.dir = e.dir WHERE sec <> '' GROUP BY h.ck, sec),
sections AS (SELECT s.ck, sec, s.first_at, NOT alive OR coalesce(r.withdrawn, false) AS withdrawn FROM secs s LEFT JOIN records r ON r.k = s.ck),
refs AS (SELECT 'openalex_results' AS src_table, rec_id AS src_id, retrieved_at AS ref_at, CASE WHEN regexp_matches(x, '(?i)pmid|pubmed') THEN 'pmid:' || regexp_extract(x, '([0-9]+)', 1) ELSE upper(regexp_extract(x, '(?i)(w[0-9]+)', 1)) END AS ref_key FROM (SELECT rec_id, retrieved_at, unnest(referenced_works) AS x FROM openalex_results) o WHERE trim(coalesce(x, '')) <> ''
    UNION ALL SELECT 'paper_catalogs', catalog_id, delivered_at, regexp_replace(regexp_replace(lower(trim(x)), '^\[\[|\]\]$', '', 'g'), '\.md$', '') FROM (SELECT catalog_id, delivered_at, unnest(paper.related_papers) AS x FROM paper_catalogs) c WHERE trim(coalesce(x, '')) <> ''),
found AS (SELECT src_table, src_id, ref_key, ref_at FROM refs LEFT JOIN records r ON r.k = ref_key WHERE r.k IS NULL OR withdrawn OR first_at > ref_at
    UNION ALL SELECT 'segment_entries', seg_uid, lower(trim(section_id)), updated_at FROM segment_entries g LEFT JOIN sections s ON s.ck = lower(trim(g.cite_key)) AND s.sec = lower(trim(section_id)) WHERE trim(coalesce(section_id, '')) <> '' AND (s.sec IS NULL OR withdrawn OR first_at > updated_at))
SELECT DISTINCT src_table, src_id, ref_key, strftime(ref_at, '%Y-%m') AS ref_month FROM found""",
}
