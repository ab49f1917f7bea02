"""Readers of saved search results and feeds."""

from __future__ import annotations

import functools
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Members under which a saved result keeps its list, in the order they are looked for.
LIST_MEMBERS = ["entries", "results", "works", "items", "data"]


def existing(paths: list[str]) -> list[str]:
    """paths, if all are there; a missing one is named in the error."""
    if missing := [p for p in paths if "://" not in p and not Path(p).exists()]:
        raise FileNotFoundError(", ".join(missing))
    return paths


def json_records(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Records of JSON files of any accepted shape: a list, an object with a list under one of LIST_MEMBERS (the
    first that is one), or one object without any list. Columns of `schema` and file_order, row_order for the
    order of reading, files as `paths` names them.

    Elements that are no objects are dropped and count for no order; texts that aren't JSON, and other shapes, give
    no rows; missing members are null.
    """
    read = lambda p: spark.read.text(p, wholetext=True).select(F.try_parse_json("value").alias("_v"))
    files = functools.reduce(DataFrame.unionByName, [read(p).withColumn("file_order", F.lit(i)) for i, p in enumerate(existing(paths))])
    is_list = lambda v: F.schema_of_variant(v).startswith("ARRAY")
    member = lambda m: F.try_variant_get("_v", f"$.{m}", "variant")
    lists = [F.when(is_list(F.col("_v")), F.try_variant_get("_v", "$", "array<variant>")), *(F.when(is_list(member(m)), F.try_variant_get("_v", f"$.{m}", "array<variant>")) for m in LIST_MEMBERS)]
    members = F.map_values(F.try_variant_get("_v", "$", "map<string, variant>"))
    alone = F.when(F.schema_of_variant("_v").startswith("OBJECT") & ~F.coalesce(F.exists(members, lambda m: F.coalesce(is_list(m), F.lit(False))), F.lit(False)), F.array("_v"))
    objects = F.filter(F.coalesce(*lists, alone), lambda r: F.coalesce(F.schema_of_variant(r).startswith("OBJECT"), F.lit(False)))
    rows = files.select("file_order", F.posexplode(objects).alias("row_order", "_r"))
    return rows.select("file_order", "row_order", F.from_json(F.to_json("_r"), schema).alias("_s")).select("_s.*", "file_order", "row_order")


ATOM = "id string, title string, summary string, published string, author array<struct<name:string>>, category array<struct<_term:string>>, link array<struct<_href:string,_title:string,_type:string>>, primary_category struct<_term:string>, doi string"


def atom_entries(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Entries of an Atom feed: id, title, summary, published, authors, categories (the primary first), pdf_url."""
    raw = spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", "true").schema(ATOM).load(",".join(existing(paths)))
    clean = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    terms = F.transform("category", lambda c: c["_term"])
    first = F.col("primary_category._term")
    pdf = F.filter("link", lambda x: F.coalesce(x["_title"] == "pdf", F.lit(False)) | F.coalesce(x["_type"] == "application/pdf", F.lit(False)) | x["_href"].contains("/pdf/"))
    return raw.select(
        F.trim("id").alias("id"), clean(F.col("title")).alias("title"), clean(F.col("summary")).alias("summary"), F.trim("published").alias("published"), F.transform("author", lambda a: clean(a["name"])).alias("authors"),
        F.array_distinct(F.array_compact(F.concat(F.array(first), F.coalesce(terms, F.array().cast("array<string>"))))).alias("categories"), F.get(pdf, F.lit(0))["_href"].alias("pdf_url"),
    )
