"""References to records that do not exist, are withdrawn, or arrive later than the reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.bloom import build_bloom
from quillspark.operators.nested import json_nodes
from quillspark.session import cut

#: Between the parts of a compound key; no key holds it after bare().
PART = "\u001f"


def bare(key: Column) -> Column:
    """A key without case, outer blanks or wrapping: [[key]], [[key|alias]], `key.md`, "key"."""
    plain = F.lower(F.regexp_replace(key, r"(?U)^[\s\[\"'`(<]+|[\s\]\"'`)>]+$|\x1f", ""))
    return F.regexp_replace(F.regexp_replace(plain, r"\|.*$", ""), r"(?U)\.md$|\s+$", "")


def work_key(ref: Column) -> Column:
    """`W` and digits, or `pmid:` and digits; any other text comes out bare and can match no record."""
    work = F.upper(F.regexp_extract(ref, r"(?i)(?:^|[^a-z0-9])(w[0-9]+)", 1))
    pmid = F.regexp_extract(ref, r"(?i)(?:pmid|pubmed)[^0-9]*([0-9]+)", 1)
    digits = F.regexp_extract(ref, r"^\s*([0-9]+)\s*$", 1)
    return (
        F.when(work != "", work).when(pmid != "", F.concat(F.lit("pmid:"), pmid)).when(digits != "", F.concat(F.lit("pmid:"), digits)).otherwise(bare(ref))
    )


def present(ref: Column) -> Column:
    return F.coalesce(F.regexp_replace(ref, r"(?U)\s+", "") != "", F.lit(False))


def keyed_targets(rows: DataFrame, key: Column, at: str, withdrawals: DataFrame, table: str, withdrawn_key: Column) -> DataFrame:
    """One row for each key: target, first_at, withdrawn. Both sides are aggregated map-side before they meet."""
    records = rows.select(key.alias("target"), F.col(at).alias("_at")).groupBy("target").agg(F.min("_at").alias("first_at"), F.max("_at").alias("_last"))
    gone = (
        withdrawals.where(F.lower(F.trim("target_table")) == table)
        .select(withdrawn_key.alias("target"), "withdrawn_at")
        .groupBy("target")
        .agg(F.max("withdrawn_at").alias("_gone"))
    )
    withdrawn = F.coalesce(F.coalesce(F.col("_last"), F.col("_gone")) <= F.col("_gone"), F.lit(False))
    return records.join(gone, "target", "left").select("target", "first_at", withdrawn.alias("withdrawn"))


def section_targets(catalogs: DataFrame, papers: DataFrame) -> DataFrame:
    """One row for each (cite_key, section id at any depth) of the readable catalogs.

    A section counts as withdrawn if its paper is, or if no (cite_key, source_dir) that ever had it has it in
    its last readable catalog. papers: what keyed_targets gives for catalogs.
    """
    readable = catalogs.select(
        bare(F.col("cite_key")).alias("_paper"), F.coalesce(F.trim(F.col("paper.source_dir")), F.lit("")).alias("_dir"), "catalog_id", "delivered_at", json_nodes(F.col("sections")).alias("_nodes")
    ).where(F.col("_nodes").isNotNull())
    seen = (
        readable.select("_paper", "_dir", "catalog_id", "delivered_at", F.explode_outer("_nodes").alias("_n"))
        .groupBy("_paper", "_dir", bare(F.coalesce(F.col("_n.value"), F.lit(""))).alias("_section"))
        .agg(F.min("delivered_at").alias("_first"), F.max(F.struct("delivered_at", "catalog_id")).alias("_latest"))
    )
    last = seen.groupBy("_paper", "_dir").agg(F.max("_latest").alias("_end"))
    alive = (
        seen.where(F.col("_section") != "")
        .join(last, ["_paper", "_dir"])
        .groupBy("_paper", "_section")
        .agg(F.min("_first").alias("first_at"), F.max(F.col("_latest") == F.col("_end")).alias("_alive"))
    )
    gone = papers.where("withdrawn").select(F.col("target").alias("_paper"), F.lit(True).alias("_gone"))
    return alive.join(gone, "_paper", "left").select(
        F.concat_ws(PART, "_paper", "_section").alias("target"), "first_at", (~F.col("_alive") | F.coalesce(F.col("_gone"), F.lit(False))).alias("withdrawn")
    )


def orphan_references(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """The rows of refs whose target is missing, withdrawn or first seen later, with the reason.

    refs: target, ref_at and any columns to keep; targets: target (unique), first_at, withdrawn. A Bloom filter
    of the target keys, at most 8 MiB however many there are, proves most orphans at the scan; only references
    that pass it are shuffled to the exact join, a left join on the reference's side, so adaptive execution
    may split a key that many rows refer to. A null ref_at is never earlier than its target; a null first_at is
    never later. Either side may be empty. Repeated references come out as often as they went in.
    """
    targets = cut(targets)
    bloom = build_bloom(targets, "target", targets.count())
    probed, maybe = bloom.probe(refs, "target")
    proven = probed.where(~maybe).drop("_hashed").withColumn("reason", F.lit("missing"))
    checked = probed.where(maybe).drop("_hashed").join(targets, "target", "left")
    reason = (
        F.when(F.col("withdrawn").isNull(), "missing").when(F.col("withdrawn"), "withdrawn").when(F.col("first_at") > F.col("ref_at"), "later")
    )
    verified = checked.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("first_at", "withdrawn")
    return proven.unionByName(verified)


def catalog_orphans(openalex: DataFrame, pubmed: DataFrame, catalogs: DataFrame, segments: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """src_table, src_id, ref_key, ref_month, reason of every reference that leads nowhere at its time.

    Distinct rows. Null and blank references are none. A null time gives a null month. Works are named by
    W id, PubMed records by number, papers by bare cite key, sections by cite key and bare section id.
    """
    works = keyed_targets(openalex, work_key(F.col("id")), "retrieved_at", withdrawals, "openalex_results", work_key(F.col("target_key")))
    pmids = keyed_targets(
        pubmed, work_key(F.concat(F.lit("pmid:"), F.col("uid"))), "retrieved_at", withdrawals, "pubmed_results", work_key(F.concat(F.lit("pmid:"), F.col("target_key")))
    )
    papers = keyed_targets(catalogs, bare(F.col("cite_key")), "delivered_at", withdrawals, "paper_catalogs", bare(F.col("target_key")))

    def space(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("target").isNotNull()).withColumn("target", F.concat(F.lit(name + PART), F.col("target")))

    targets = space(works, "work").unionByName(space(pmids, "work")).unionByName(space(papers, "paper")).unionByName(space(section_targets(catalogs, papers), "section"))

    def of(df: DataFrame, src: str, key: str, at: str, target: Column, ref_key: Column) -> DataFrame:
        return df.select(F.lit(src).alias("src_table"), F.col(key).alias("src_id"), ref_key.alias("ref_key"), F.col(at).alias("ref_at"), target.alias("target"))

    ref = F.col("_ref")
    cited = openalex.select("rec_id", "retrieved_at", F.explode("referenced_works").alias("_ref")).where(present(ref))
    related = catalogs.select("catalog_id", "delivered_at", F.explode("paper.related_papers").alias("_ref")).where(present(ref))
    placed = segments.select("seg_uid", "updated_at", "cite_key", F.col("section_id").alias("_ref")).where(present(ref))
    refs = (
        of(cited, "openalex_results", "rec_id", "retrieved_at", F.concat(F.lit("work" + PART), work_key(ref)), work_key(ref))
        .unionByName(of(related, "paper_catalogs", "catalog_id", "delivered_at", F.concat(F.lit("paper" + PART), bare(ref)), bare(ref)))
        .unionByName(
            of(placed, "segment_entries", "seg_uid", "updated_at", F.concat(F.lit("section" + PART), F.concat_ws(PART, F.coalesce(bare(F.col("cite_key")), F.lit("")), bare(ref))), F.lower(F.regexp_replace(ref, r"(?U)^\s+|\s+$", "")))
        )
    )
    found = orphan_references(refs, targets)
    return found.select("src_table", "src_id", "ref_key", F.date_format("ref_at", "yyyy-MM").alias("ref_month"), "reason").distinct()


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans by table, month and reason."""
    return found.groupBy("src_table", "ref_month", "reason").agg(F.count(F.lit(1)).alias("orphans"), F.countDistinct("ref_key").alias("targets"))
