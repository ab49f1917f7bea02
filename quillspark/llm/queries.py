"""Queries of the problems tagged llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import matching, names, packing, residue, splitting, survivor, tokens
from quillspark.sources.tables import table

CAPACITY = 2048


def _works(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return matching.match_works(*(table(spark, folder, f"{x}_results") for x in ("openalex", "arxiv", "pubmed", "web")))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    rows, _, classes = _works(spark, folder)
    return matching.work_pairs(rows, classes)


def p1_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links between the sources' entities, each with its confidence."""
    return _works(spark, folder)[1]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.name_pairs(_linked(spark, folder))


def p2_names(spark: SparkSession, folder: str) -> DataFrame:
    """Every spelling with its class, the rule and score that tie it to the class, and its links."""
    return names.with_links(_linked(spark, folder))


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    return names.link_names(names.spellings(*(table(spark, folder, f"{x}_results") for x in ("openalex", "pubmed", "zotero"))))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_survivors(spark, folder).select("src_table", "group_key", "rec_id")


def p3_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return survivor.best_values(*(table(spark, folder, f"{x}_results") for x in ("zotero", "openalex", "arxiv")))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_pieces(spark, folder).select("seg_uid").distinct()


def p6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_segments(table(spark, folder, "segment_entries"), limit=2048, overlap=128)


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, folder, "documents"))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    sizes = tokens.count_tokens(table(spark, folder, "documents"))
    return packing.pack_items(sizes, "doc_id", "n_tokens", CAPACITY)


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.container_fill(p8_containers(spark, folder), CAPACITY)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_residue(spark, folder).select("doc_id").distinct()


def p9_residue(spark: SparkSession, folder: str) -> DataFrame:
    return residue.find_residue(table(spark, folder, "documents"))


QUERIES = {"p1_found": p1_found, "p1_links": p1_links, "p2_found": p2_found, "p2_names": p2_names, "p3_found": p3_found, "p3_survivors": p3_survivors, "p6_found": p6_found, "p6_pieces": p6_pieces, "p9_found": p9_found, "p9_residue": p9_residue, "p7_ids": p7_ids, "p8_containers": p8_containers, "p8_fill": p8_fill}
ORACLES: dict[str, str] = {
    "p6_found": """SELECT seg_uid FROM (SELECT seg_uid, body, row_number() OVER (PARTITION BY cite_key, id ORDER BY updated_at DESC NULLS LAST, seg_uid DESC) AS rn FROM segment_entries) t
    WHERE rn = 1 AND floor(length(body) / 4) > 2048""",
}
