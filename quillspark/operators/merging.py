"""Merging and matching of library items: a fold over repeated records, and the best item for a record."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import ids
from quillspark.functions.text import blank_to_null, clean_text
from quillspark.plans.discovery import union_in_order
from quillspark.session import cut

#: Fields whose number makes an item rich, and those that fill each other's gaps.
RICH = ["doi", "arxiv_id", "pmid", "abstract", "pdf_url", "cite_key"]
FILLED = [*RICH, "zotero_url"]


def merged_items(items: DataFrame, order: str = "rec_id") -> DataFrame:
    """One row for each item key (else for each title and year): key, the fields of FILLED, authors, categories.

    Records come in `order`. One takes over if it has more of the RICH fields than all before it together; then its
    values stand before theirs, else they fill gaps and its lists follow. What matters of a record is which fields it
    has, so a key's takeovers are told from the first place of each of at most 64 sets of fields, and values are picked
    by map-side maxima: no task holds a key's records.
    """
    key = F.coalesce(blank_to_null(F.col("item_key")), F.concat(F.lit("title:"), F.lower(clean_text(F.col("title"))), F.lit(":"), F.coalesce(F.col("year").cast("string"), F.lit(""))))
    has = lambda f: F.coalesce(F.col(f).cast("string"), F.lit("")) != ""
    mask = functools.reduce(lambda a, b: a + b, [F.when(has(f), 1 << i).otherwise(0) for i, f in enumerate(RICH)])
    rows = items.select(key.alias("key"), F.col(order).alias("_at"), mask.alias("_mask"), *FILLED, "authors", "categories")
    firsts = rows.groupBy("key", "_mask").agg(F.min("_at").alias("_at"))
    before = F.coalesce(F.bit_or("_mask").over(Window.partitionBy("key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    taking = firsts.withColumn("_before", before).where((F.col("_before") == -1) | (F.bit_count("_mask") > F.bit_count("_before"))).select("key", "_at", F.lit(True).alias("_takes"))
    told = rows.join(taking, ["key", "_at"], "left").withColumn("_takes", F.coalesce("_takes", F.lit(False)))
    pick = lambda f: F.coalesce(F.max_by(f, F.when(F.col("_takes") & has(f), F.col("_at"))), F.min_by(f, F.when(has(f), F.col("_at")))).alias(f)
    # takeovers stand in front, the last first; the others follow in their order
    rank = F.struct(F.col("_takes").cast("int").alias("t"), F.when(F.col("_takes"), F.col("_at")).otherwise(-F.col("_at")).alias("o"))
    told = told.withColumn("_rank", rank)
    out = told.groupBy("key").agg(*(pick(f) for f in FILLED))
    for column in ("authors", "categories"):
        lists = union_in_order(told.where(F.col(column).isNotNull()), "key", column, "_rank", column)
        out = out.join(lists, "key", "left").withColumn(column, F.coalesce(column, F.array().cast("array<string>")))
    return out


def match_score(note: str, item: str) -> Column:
    """Points of an item for a record (aliases of doi, arxiv, title, year): 100 for a DOI, 70 for an arXiv number, 30 for
    an equal title or 10 for one within the other, 5 for the year; none at all if both have a DOI, or a number, and they
    differ."""
    n, i = (lambda f: F.col(f"{note}.{f}")), (lambda f: F.col(f"{item}.{f}"))
    both = lambda f: n(f).isNotNull() & i(f).isNotNull()
    conflict = F.coalesce((both("doi") & (n("doi") != i("doi"))) | (both("arxiv") & (n("arxiv") != i("arxiv"))), F.lit(False))
    points = lambda condition, p: F.when(F.coalesce(condition, F.lit(False)), p)
    title = points(n("title") == i("title"), 30).when(F.coalesce(F.contains(i("title"), n("title")) | F.contains(n("title"), i("title")), F.lit(False)), 10).otherwise(0)
    return F.when(conflict, 0).otherwise(points(n("doi") == i("doi"), 100).otherwise(0) + points(n("arxiv") == i("arxiv"), 70).otherwise(0) + title + points(n("year") == i("year"), 5).otherwise(0))


def best_items(notes: DataFrame, items: DataFrame, gram: int = 12) -> DataFrame:
    """note_id, item_id, score of the best item of each record: notes (note_id) and items (item_id), each with doi, arxiv,
    title (normalised) and year.

    Records and items meet by an equal identifier or title, or if a title holds the other: a title within another
    shares its rarest run of `gram` characters with it, so only that run of the one is joined to all runs of the other.
    Titles of fewer characters meet by equality alone. The least item of equals wins; a record without points has no
    row. Records with the same fields have the same best item, and of items with the same fields only the least can be
    it, so each kind of them is compared once, and runs are those of distinct titles (counted with all their rows). The
    estimated sizes of unnested runs are far too small, so every join here is told to merge: else the driver would
    gather and broadcast them.
    """
    cols = ["doi", "arxiv", "title", "year"]
    kinds = lambda df, k: cut(df.groupBy(*cols).agg(F.min(k).alias(k), F.count(F.lit(1)).alias("_w")))
    n, i = kinds(notes, "note_id"), kinds(items, "item_id")
    met = lambda a, b, *on: a.join(b.hint("merge"), *on)
    named = lambda df, k: df.select(k, F.explode(F.array_compact(F.array(*(F.concat(F.lit(f"{c}:"), F.col(c)) for c in cols[:3])))).alias("_v"))
    equal = met(named(n, "note_id"), named(i, "item_id"), "_v").select("note_id", "item_id")
    titles = lambda df, k: df.where(F.length("title") >= gram).groupBy("title").agg(F.min(k).alias("_t"), F.sum("_w").alias("_w"))
    runs = lambda df: df.select("_t", "_w", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("title") - gram + 1), lambda p: F.substring("title", p, F.lit(gram))))).alias("_g"))
    of_notes, of_items = runs(titles(n, "note_id")), runs(titles(i, "item_id"))
    counts = of_notes.select("_g", "_w").union(of_items.select("_g", "_w")).groupBy("_g").agg(F.sum("_w").alias("_n"))
    rarest = lambda df: met(df, counts, "_g").groupBy("_t").agg(F.min(F.struct("_n", "_g"))["_g"].alias("_g"))
    share = lambda a, b: met(a.select("_g", F.col("_t").alias("_a")), b.select("_g", F.col("_t").alias("_b")), "_g")
    within = share(rarest(of_notes), of_items).select("_a", "_b").union(share(of_notes, rarest(of_items)).select("_a", "_b")).distinct()
    with_title = lambda df, k, as_: met(df.select("title", k), titles(df, k).select("title", F.col("_t").alias(as_)), "title").select(k, as_)
    within = met(met(within, with_title(n, "note_id", "_a"), "_a"), with_title(i, "item_id", "_b"), "_b").select("note_id", "item_id")
    pairs = equal.union(within).distinct()
    scored = met(met(pairs, n.select("note_id", F.struct(*cols).alias("n")), "note_id"), i.select("item_id", F.struct(*cols).alias("i")), "item_id").select("note_id", "item_id", match_score("n", "i").alias("score")).where("score > 0")
    best = scored.groupBy("note_id").agg(F.max(F.struct("score", (-F.col("item_id")).alias("c"))).alias("_b"))
    best = met(best, n, "note_id").select("_b", *(F.col(c).alias(f"_{c}") for c in cols))
    same = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols])
    return met(notes, best, same).select("note_id", (-F.col("_b.c")).alias("item_id"), F.col("_b.score").cast("int").alias("score"))


def matching_fields(df: DataFrame, key: str, as_: str, doi: Column, arxiv: Column, title: Column, year: Column) -> DataFrame:
    return df.select(F.col(key).alias(as_), ids.clean_doi(doi).alias("doi"), blank_to_null(arxiv).alias("arxiv"), F.when(ids.plain_title(title) != "", ids.plain_title(title)).alias("title"), year.cast("string").alias("year"))
