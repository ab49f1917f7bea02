"""Discovery: five source dialects to one ranked list of works.

normalise, link by identifiers, merge, name, measure distance to seeds, score, rank.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import ids, scoring
from quillspark.functions.text import blank_to_null, clean_text
from quillspark.operators.graph import connected_components, hop_distances
from quillspark.session import cut

SOURCES = ("zotero", "arxiv", "openalex", "web", "pubmed")
#: Which source's fields win between equally full records.
PRIORITY = {"zotero": 5, "arxiv": 4, "openalex": 3, "pubmed": 2, "web": 1}
KINDS = ("arxiv_id", "doi", "openalex_id", "pmid")


def normalized_records(zotero: DataFrame, arxiv: DataFrame, openalex: DataFrame, web: DataFrame, pubmed: DataFrame) -> DataFrame:
    """The five dialects in one shape; records without a title are dropped. `ord` is the reading order, aliases
    are the written forms of a record's identifiers and addresses."""
    none = F.lit(None).cast("string")
    no_list = F.array().cast("array<string>")

    def of(df: DataFrame, source: str, extras: list[Column], **c: Column) -> DataFrame:
        pick = lambda name, default: c.get(name, default)
        rows = df.select(
            F.lit(source).alias("search_source"), F.struct(F.lit(SOURCES.index(source)).alias("src"), F.col("rec_id").alias("row")).alias("ord"), clean_text(F.col("title")).alias("title"), ids.ordered_distinct(F.coalesce(c["authors"], no_list)).alias("authors"),
            pick("year", F.lit(None).cast("int")).alias("year"), clean_text(pick("abstract", none)).alias("abstract"), *(pick(k, none).alias(k) for k in KINDS), F.array(*(x.cast("string") for x in extras)).alias("_extras"),
            blank_to_null(clean_text(pick("pdf_url", none))).alias("pdf_url"), ids.ordered_distinct(F.coalesce(pick("categories", no_list), no_list)).alias("categories"), pick("citations", F.lit(None).cast("int")).alias("citation_count"), blank_to_null(pick("cite_key", none)).alias("cite_key"), F.coalesce(pick("refs", no_list), no_list).alias("refs"),
        ).where(F.col("title") != "")
        if source in ("arxiv", "openalex", "web"):
            rows = rows.withColumn("pdf_url", F.coalesce("pdf_url", ids.arxiv_pdf(F.col("arxiv_id"))))
        found = F.flatten(F.transform(F.concat(F.array(*KINDS), F.col("_extras")), ids.identifier_aliases))
        return rows.withColumn("aliases", F.array_distinct(found)).drop("_extras")

    c = F.col
    parts = [
        of(
            zotero, "zotero", [c("item_key"), F.concat(F.lit("zotero:"), c("item_key")), c("zotero_url")], authors=c("authors"), year=c("year"), abstract=c("abstract"), arxiv_id=ids.arxiv_id(ids.truthy(c("arxiv_id"), c("id"))), doi=ids.clean_doi(c("doi")), pmid=ids.clean_pmid(c("pmid")), pdf_url=c("pdf_url"), categories=c("categories"),
            cite_key=F.lower(F.regexp_replace("cite_key", "[^A-Za-z0-9_]", "")),
        ),
        of(arxiv, "arxiv", [c("id"), F.coalesce(blank_to_null(c("pdf_url")), ids.arxiv_pdf(ids.arxiv_id(c("id"))))], authors=c("authors"), year=ids.parse_year(c("published")), abstract=c("summary"), arxiv_id=ids.arxiv_id(c("id")), pdf_url=c("pdf_url"), categories=c("categories"), refs=c("reference_ids")),
        of(
            openalex, "openalex", [c("id"), c("ids.openalex"), c("ids.doi"), c("ids.pmid")], authors=F.transform("authorships", lambda a: a["author"]["display_name"]), year=c("publication_year"), abstract=F.coalesce(blank_to_null(c("abstract")), ids.inverted_abstract(c("abstract_inverted_index"))),
            arxiv_id=ids.arxiv_id(c("ids.arxiv")), doi=ids.clean_doi(ids.truthy(c("doi"), c("ids.doi"))), openalex_id=ids.clean_openalex(ids.truthy(c("id"), c("ids.openalex"))), pmid=ids.clean_pmid(c("ids.pmid")), pdf_url=c("best_oa_location.pdf_url"),
            categories=F.transform("concepts", lambda a: a["display_name"]), citations=F.when(c("cited_by_count") != 0, c("cited_by_count")), refs=c("referenced_works"),
        ),
        of(web, "web", [c("url")], authors=c("authors"), year=c("year"), abstract=c("snippet"), arxiv_id=ids.arxiv_id(c("url")), doi=ids.clean_doi(c("url")), openalex_id=ids.clean_openalex(c("url")), categories=c("categories")),
        of(pubmed, "pubmed", [c("uid")], authors=c("authors"), year=ids.parse_year(c("pubdate")), abstract=c("abstract"), doi=ids.clean_doi(c("doi")), pmid=ids.clean_pmid(ids.truthy(c("pmid"), c("uid"))), categories=c("mesh_terms"), citations=c("citation_count"), refs=c("reference_ids")),
    ]
    rows = functools.reduce(DataFrame.unionByName, parts)
    return rows.withColumn("rid", F.col("ord.row"))


def identifier_groups(records: DataFrame) -> DataFrame:
    """rid, group: records joined by any shared identifier, directly or through others.

    Records meet their identifiers in a bipartite graph, so an identifier that very many records share gives
    as many edges as records, never pairs of records.
    """
    named = records.select("rid", F.explode(F.array(*(F.concat(F.lit(f"{k}:"), F.col(k)) for k in KINDS))).alias("id")).where(F.col("id").isNotNull())
    classes = connected_components(named.select(F.concat(F.lit("0"), F.lpad(F.col("rid").cast("string"), 19, "0")).alias("a"), F.concat(F.lit("1"), F.col("id")).alias("b")))
    mine = classes.where(F.col("node").startswith("0")).select(F.substring("node", 2, 19).cast("long").alias("rid"), "component")
    return records.select("rid").join(mine, "rid", "left").select("rid", F.coalesce("component", F.concat(F.lit("0"), F.lpad(F.col("rid").cast("string"), 19, "0"))).alias("group"))


def richness(r: str = "") -> Column:
    """Non-empty fields, authors, categories and a count, as one number."""
    c = lambda x: F.col(f"{r}{x}")
    full = [F.when(F.coalesce(c(x).cast("string"), F.lit("")) != "", 1).otherwise(0) for x in ("title", "year", "abstract", "pdf_url", *KINDS, "cite_key")]
    return functools.reduce(lambda a, b: a + b, full) + F.size(c("authors")) + F.size(c("categories")) + c("citation_count").isNotNull().cast("int")


def union_in_order(rows: DataFrame, group: str, lists: str, rank: str, out: str) -> DataFrame:
    """group, out: the distinct elements of a group's lists in the order of their first place, the lists of the
    greatest rank first. Elements are made distinct map-side before anything is gathered, so a group's row holds
    its result and no more."""
    each = rows.select(group, F.col(rank).alias("_r"), F.posexplode(lists).alias("_p", "_v"))
    first = each.groupBy(group, "_v").agg(F.max(F.struct("_r", (-F.col("_p")).alias("p"))).alias("_at"))
    return first.groupBy(group).agg(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("_at", "_v")))), lambda x: x["_v"]).alias(out))


def merged_works(records: DataFrame, groups: DataFrame) -> DataFrame:
    """One row for each group: every field from the fullest record that has it, lists united in that order.

    Equally full records stand by their source's priority, then in reading order. Fields are picked by map-side
    maxima of (fullness, priority, order), so a group of any size needs no sort and no single task. A work with
    an arXiv number and no PDF gets arXiv's; its source is the group's of the highest priority.
    """
    priority = functools.reduce(lambda acc, s: acc.when(F.col("search_source") == s, PRIORITY[s]), SOURCES[1:], F.when(F.col("search_source") == SOURCES[0], PRIORITY[SOURCES[0]]))
    ranked = records.join(groups, "rid").withColumn("_rank", F.struct(richness().alias("full"), priority.alias("priority"), (-F.col("ord.src")).alias("src"), (-F.col("rid")).alias("row")))
    first = lambda x, ok: F.max_by(F.when(ok, F.col(x)), F.when(ok, F.col("_rank"))).alias(x)
    texts = [first(x, F.coalesce(F.col(x).cast("string"), F.lit("")) != "") for x in ("title", "year", "abstract", *KINDS, "pdf_url", "citation_count", "cite_key")]
    works = ranked.groupBy("group").agg(*texts, first("authors", F.size("authors") > 0), F.max_by("search_source", "_rank.priority").alias("search_source"), F.min("ord").alias("ord"), F.count(F.lit(1)).alias("records"))
    works = works.withColumn("pdf_url", F.coalesce("pdf_url", ids.arxiv_pdf(F.col("arxiv_id"))))
    for column in ("categories", "refs", "aliases"):
        works = works.join(union_in_order(ranked, "group", column, "_rank", column), "group", "left").withColumn(column, F.coalesce(column, F.array().cast("array<string>")))
    return works.withColumn("authors", F.coalesce("authors", F.array().cast("array<string>")))


def assigned_keys(works: DataFrame, repeated: str = "raise") -> DataFrame:
    """works with canonical_id and cite_key: an explicit key stays; a base key that several works share, or that
    is explicit elsewhere, gets `_` and the suffix of each work's id.

    A key that two works would end up with is an error of the input: with repeated="raise" reading such a row
    fails and names it; with "keep" both rows have it, for manifest_violations to report.
    """
    w = works.withColumn("canonical_id", ids.canonical_id(F.col("arxiv_id"), F.col("doi"), F.col("openalex_id"), F.col("title"), F.col("year"))).withColumn("explicit", F.col("cite_key"))
    w = w.withColumn("base", ids.cite_key(F.coalesce(F.get("authors", F.lit(0)), F.lit("unknown")), F.col("year"), F.col("title")))
    shared = w.where("explicit IS NULL").groupBy("base").agg((F.count(F.lit(1)) > 1).alias("_shared"))
    taken = w.where("explicit IS NOT NULL").select(F.col("explicit").alias("base")).distinct().withColumn("_taken", F.lit(True))
    w = w.join(shared, "base", "left").join(taken, "base", "left")
    crowded = F.coalesce("_shared", F.lit(False)) | F.coalesce("_taken", F.lit(False))
    key = F.coalesce("explicit", F.when(crowded, F.concat("base", F.lit("_"), ids.key_suffix(F.col("canonical_id")))).otherwise(F.col("base")))
    w = w.withColumn("cite_key", key).drop("base", "explicit", "_shared", "_taken")
    if repeated == "keep":
        return w
    again = w.groupBy("cite_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return w.join(again, "cite_key", "left").withColumn("cite_key", F.when(F.col("_n").isNull(), F.col("cite_key")).otherwise(F.raise_error(F.concat(F.lit("cite_key of several works: "), "cite_key")))).select(*w.columns)


def work_aliases(works: DataFrame) -> DataFrame:
    """alias, canonical_id; of several works with one alias the last in reading order has it."""
    every = works.select(F.explode(F.array_distinct(F.concat(F.array("canonical_id", "cite_key"), "aliases"))).alias("alias"), "canonical_id", "ord")
    return every.groupBy("alias").agg(F.max_by("canonical_id", "ord").alias("canonical_id"))


def citation_edges(works: DataFrame, aliases: DataFrame) -> DataFrame:
    """a, b of works one of which refers to the other, by any written form of the reference."""
    refs = works.select(F.col("canonical_id").alias("a"), F.explode("refs").alias("_ref")).select("a", F.explode(ids.identifier_aliases(F.col("_ref"))).alias("alias")).distinct()
    return refs.join(aliases, "alias").select("a", F.col("canonical_id").alias("b")).where("a != b").distinct()


def resolved_seeds(seeds: DataFrame, aliases: DataFrame) -> DataFrame:
    """seed, canonical_id of every work that a seed names; one row with a null for a seed that names none."""
    forms = seeds.select("seed", F.explode_outer(ids.identifier_aliases(F.col("seed"))).alias("alias"))
    return forms.join(aliases, "alias", "left").groupBy("seed").agg(F.collect_set("canonical_id").alias("_c")).select("seed", F.explode_outer("_c").alias("canonical_id"))


def ranked_works(records: DataFrame, seeds: list[str], keywords: list[str], start: int, end: int, most: int | None = 30, repeated: str = "raise") -> DataFrame:
    """The works of normalized_records, best first: relevance, nearness to a seed, citations, year, id."""
    works = cut(assigned_keys(merged_works(records, identifier_groups(records)), repeated))
    aliases = cut(work_aliases(works))
    spark = works.sparkSession
    wanted = spark.createDataFrame([(s,) for s in seeds], "seed string")
    found = resolved_seeds(wanted, aliases).where("canonical_id IS NOT NULL").select(F.col("canonical_id").alias("node"))
    distances = hop_distances(citation_edges(works, aliases), found)
    scored = works.join(distances.withColumnsRenamed({"node": "canonical_id", "distance": "seed_distance"}), "canonical_id", "left")
    score = scoring.relevance(scoring.keyword_score(F.concat_ws(" ", "title", "abstract"), keywords), scoring.seed_score(F.col("seed_distance")), scoring.recency_score(F.col("year"), start, end), scoring.citation_score(F.col("citation_count")))
    out = scored.withColumn("relevance_score", score).orderBy(
        F.desc("relevance_score"), F.coalesce("seed_distance", F.lit(99)), F.desc(F.coalesce("citation_count", F.lit(-1))), F.desc(F.coalesce("year", F.lit(0))), "canonical_id"
    )
    columns = ["canonical_id", "cite_key", *KINDS, "title", "authors", "year", "abstract", "pdf_url", "categories", "relevance_score", "seed_distance", "citation_count", "search_source"]
    return (out if most is None else out.limit(most)).select(*columns)


def manifest_violations(entries: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """entry, rule for every rule that an entry breaks; repeated keys are reported from their second entry on."""
    bad = lambda name, cond: F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
    c = F.col
    rules = [
        bad("canonical_id", ~c("canonical_id").rlike(r"^(arxiv:\S+|doi:10\.[0-9]{4,9}/\S+|openalex:W[0-9]+|manual:[0-9a-f]{8})$")), bad("cite_key", ~c("cite_key").rlike("^[a-z0-9_]+$")), bad("title", c("title") == ""), bad("score", ~c("relevance_score").between(0.0, 1.0)),
        bad("source", ~c("search_source").isin(*sources)), bad("arxiv", c("canonical_id").startswith("arxiv:") & (c("canonical_id") != F.concat(F.lit("arxiv:"), c("arxiv_id")))), bad("manual", c("canonical_id").startswith("manual:") & (c("arxiv_id").isNotNull() | c("doi").isNotNull() | c("openalex_id").isNotNull())),
    ]
    own = entries.select(c("canonical_id").alias("entry"), F.explode(F.array_compact(F.array(*rules))).alias("rule"))
    keys = entries.select("canonical_id", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), c(k).cast("string").alias("v")) for k in ("canonical_id", "cite_key", *KINDS)))).alias("x")).where("x.v IS NOT NULL")
    again = keys.groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("v").alias("entry"), F.concat(F.lit("repeated "), F.col("k")).alias("rule"))
    return own.unionByName(again)


