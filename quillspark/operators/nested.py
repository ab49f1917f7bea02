"""Deeply nested records to flat tables by Dewey labels.

A node's label is the path of ordinals from its root (`2.1.3`); its parent's label is the same path without
the last ordinal, so links need no generated keys, no shuffle and no second pass. Nodes are grouped by schema
path into tables.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from json.decoder import scanstring

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_FIELDS = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("value", T.StringType())]))


def parent_label(label: Column) -> Column:
    """The label without its last ordinal; empty for a top node."""
    return F.when(F.instr(label, ".") > 0, F.regexp_replace(label, r"\.[0-9]+$", "")).otherwise(F.lit(""))


def shred(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """One table for every array in df's schema, at any depth.

    Each has src_key (df's key), node_path, parent_path and the element's scalar fields under their dotted
    names with `_`, or `value` for an array of scalars. Positions count from 1; null elements keep their
    position and give no row; empty and null arrays give no rows. Columns of df named like the output's own
    are read before anything is renamed, so they can't clash.
    """
    tables: dict[str, DataFrame] = {}

    def scalars(at: Column, kind: T.DataType, prefix: str) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [c for f in kind for c in scalars(at[f.name], f.dataType, f"{prefix}_{f.name}" if prefix else f.name)]
        if isinstance(kind, (T.ArrayType, T.MapType)):
            return []
        return [at.alias(prefix or "value")]

    def arrays(kind: T.DataType, path: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], T.ArrayType]]:
        if isinstance(kind, T.ArrayType):
            yield path, kind
        elif isinstance(kind, T.StructType):
            for f in kind:
                yield from arrays(f.dataType, (*path, f.name))

    def walk(rows: DataFrame, kind: T.DataType, schema_path: str) -> None:
        for path, array in arrays(kind, ()):
            at = F.col("_node")
            for name in path:
                at = at[name]
            name = ".".join(x for x in (schema_path, *path) if x)
            nodes = (
                rows.select("_key", "_label", F.posexplode(at).alias("_pos", "_item"))
                .where(F.col("_item").isNotNull())
                .select("_key", F.concat_ws(".", F.when(F.col("_label") != "", F.col("_label")), (F.col("_pos") + 1).cast("string")).alias("_label"), F.col("_item").alias("_node"))
            )
            fields = scalars(F.col("_node"), array.elementType, "")
            tables[name] = nodes.select(F.col("_key").alias("src_key"), F.col("_label").alias("node_path"), parent_label(F.col("_label")).alias("parent_path"), *fields)
            if isinstance(array.elementType, (T.StructType, T.ArrayType)):
                walk(nodes, array.elementType, name)

    rest = [f for f in df.schema if f.name != key]
    top = df.select(F.col(f"`{key}`").alias("_key"), F.lit("").alias("_label"), F.struct(*[F.col(f"`{f.name}`") for f in rest]).alias("_node"))
    walk(top, T.StructType(rest), "")
    return tables


UNREADABLE = object()
_BLANK = regex.compile(r"[ \t\n\r]*+")
_SCALAR = regex.compile(r"(-?(?:0|[1-9][0-9]*+))((?:\.[0-9]++)?(?:[eE][-+]?[0-9]++)?)|(true|false|null)")
_CONSTANTS = {"true": True, "false": False, "null": None}


def _whole(digits: str) -> int | str:
    """A whole number; one too long for Python's conversion stays a text."""
    return int(digits) if len(digits) < 4000 else digits


def deep_json(text: str) -> object:
    """What json.loads gives, for nesting of any depth; UNREADABLE if the text isn't JSON.

    Open containers stand on a list of its own: (container, key of the member that comes next).
    """
    at = _BLANK.match(text, 0).end()
    held: list[tuple[list | dict, str | None]] = []

    def key_at(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            raise ValueError(at)
        key, at = scanstring(text, at + 1, True)
        at = _BLANK.match(text, at).end()
        if text[at : at + 1] != ":":
            raise ValueError(at)
        return key, _BLANK.match(text, at + 1).end()

    try:
        while True:
            c = text[at : at + 1]
            if c == "{" or c == "[":
                value: object = {} if c == "{" else []
                at = _BLANK.match(text, at + 1).end()
                if text[at : at + 1] != ("}" if c == "{" else "]"):
                    key, at = key_at(at) if c == "{" else (None, at)
                    held.append((value, key))
                    continue
                at += 1
            elif c == '"':
                value, at = scanstring(text, at + 1, True)
            else:
                m = _SCALAR.match(text, at)
                if not m:
                    return UNREADABLE
                value = _CONSTANTS[m[3]] if m[3] else float(m[0]) if m[2] else _whole(m[1])
                at = m.end()
            while True:  # value is complete: it goes into the innermost container, which may be complete by it
                at = _BLANK.match(text, at).end()
                if not held:
                    return value if at == len(text) else UNREADABLE
                inner, key = held.pop()
                if isinstance(inner, dict):
                    inner[key] = value
                else:
                    inner.append(value)
                c = text[at : at + 1]
                if c == ",":
                    at = _BLANK.match(text, at + 1).end()
                    key, at = key_at(at) if isinstance(inner, dict) else (None, at)
                    held.append((inner, key))
                    break
                if c != ("}" if isinstance(inner, dict) else "]"):
                    return UNREADABLE
                value, at = inner, at + 1
    except ValueError:
        return UNREADABLE


def walk_json(text: str | None, root_member: str, child_member: str, value_member: str) -> list[tuple[str, str]] | None:
    """Every object of a JSON tree as (label, value), in document order; None if the text is no readable tree.

    The list is the text itself or its member root_member; an object in place of a list is a list of one.
    Elements that are no objects keep their position. The walk uses its own stack, so depth is bounded by
    memory alone.
    """

    def refuse(constant: str) -> None:
        raise ValueError(constant)

    if text is None:
        return None
    try:
        tree = json.loads(text, parse_constant=refuse, parse_int=_whole)
    except RecursionError:
        tree = deep_json(text)
    except ValueError:
        return None
    if tree is UNREADABLE:
        return None
    if isinstance(tree, dict) and root_member in tree:
        tree = tree[root_member]
    if isinstance(tree, dict):
        tree = [tree]
    if not isinstance(tree, list):
        return None
    found = []
    stack = [(str(k), x) for k, x in reversed(list(enumerate(tree, 1)))]
    while stack:
        label, node = stack.pop()
        if not isinstance(node, dict):
            continue
        value = node.get(value_member)
        found.append((label, "" if value is None else (value if isinstance(value, str) else json.dumps(value)).strip()))
        children = node.get(child_member)
        if isinstance(children, dict):
            children = [children]
        if isinstance(children, list):
            stack += [(f"{label}.{k}", x) for k, x in reversed(list(enumerate(children, 1)))]
    return found


def json_nodes(text: Column, root_member: str = "sections", child_member: str = "children", value_member: str = "id") -> Column:
    """array<struct<path, value>> of a recursive JSON tree; null where it can't be read.

    Spark has no recursive schema, hence the one Arrow function here; it sees the JSON text alone.
    """

    @F.pandas_udf(NODE_FIELDS)
    def nodes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: walk_json(x, root_member, child_member, value_member))

    return nodes(text)


def flatten_nodes(df: DataFrame, key: str, nodes: str) -> DataFrame:
    """Rows src_id, node_path, parent_path, item_value of a column made by json_nodes."""
    return df.select(F.col(key).alias("src_id"), F.explode(nodes).alias("_n")).select(
        "src_id", F.col("_n.path").alias("node_path"), parent_label(F.col("_n.path")).alias("parent_path"), F.col("_n.value").alias("item_value")
    )


def nested_nodes(openalex: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Flat rows of authorships, referenced works and section trees.

    Columns src_table, src_id, field_name, node_path, parent_path, item_value. Null and blank names, null
    references and unreadable section texts give no rows but null elements count as positions; repeated
    equal rows of one record can't occur, as a label is unique in its record and field. Extra columns of the
    inputs are ignored.
    """
    tables = shred(openalex.select("rec_id", "authorships", "referenced_works"), "rec_id")
    out = ["src_table", "src_id", "field_name", "node_path", "parent_path", "item_value"]

    def of(df: DataFrame, src: str, field: str, value: Column, key: str = "src_key") -> DataFrame:
        return df.select(F.lit(src).alias("src_table"), F.col(key).alias("src_id"), F.lit(field).alias("field_name"), "node_path", "parent_path", value.alias("item_value")).select(*out)

    name = F.col("author_display_name")
    authors = of(tables["authorships"].where(F.regexp_replace(name, r"(?U)\s+", "") != ""), "openalex_results", "authorships", name)
    works = of(tables["referenced_works"], "openalex_results", "referenced_works", F.col("value"))
    sections = flatten_nodes(catalogs.select("catalog_id", json_nodes(F.col("sections")).alias("nodes")), "catalog_id", "nodes")
    return authors.unionByName(works).unionByName(of(sections, "paper_catalogs", "sections", F.col("item_value"), "src_id"))
