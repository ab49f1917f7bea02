"""Dewey labels and orphan references on small tables with known answers."""

import datetime as dt
import json

import pytest

from quillspark.operators import nested, orphans
from quillspark.operators.bloom import build_bloom

T = dt.datetime
OPENALEX = "rec_id long, id string, authorships array<struct<author:struct<display_name:string>>>, referenced_works array<string>, retrieved_at timestamp_ntz, node_path string"
CATALOGS = "catalog_id long, cite_key string, paper struct<related_papers:array<string>,source_dir:string>, sections string, delivered_at timestamp_ntz"


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None), ("", None), ("[", None), ('{"a": NaN}', None), ("[NaN]", None), ("3", None), ('"s"', None), ("[]", []), ("null", None), ('{"sections": null}', None), ('{"id": " x "}', [("1", "x")]), ('{"sections": {"id": "x"}}', [("1", "x")]),
        ('[null, {"id": "a", "children": [null, {"id": null}, 5, {"children": {"id": 7}}]}]', [("2", "a"), ("2.2", ""), ("2.4", ""), ("2.4.1", "7")]),
    ],
)
def test_walk_json(text, expected):
    assert nested.walk_json(text, "sections", "children", "id") == expected


def test_walk_deep_tree():
    tree = {"id": "0"}
    for k in range(1, 200):
        tree = {"id": str(k), "children": [tree]}
    found = nested.walk_json(json.dumps([tree]), "sections", "children", "id")
    assert len(found) == 200 and found[-1][0].count(".") == 199


def test_nodes_keep_place_and_parent(spark):
    openalex = spark.createDataFrame(
        [(1, "W1", [(("Ann",),), None, ((None,),), ((" ",),), (("Bo ",),)], [None, "W2", "W2"], T(2024, 1, 1), "clash"), (2, None, None, [], None, None), (3, "W3", [None], None, None, None)], OPENALEX
    )
    catalogs = spark.createDataFrame([(7, "k", (None, None), '[{"id": "a", "children": [{"id": "b"}]}]', None), (8, "k", None, "{bad", None), (9, None, None, None, None)], CATALOGS)
    got = sorted(map(tuple, nested.nested_nodes(openalex, catalogs).collect()))
    assert got == [
        ("openalex_results", 1, "authorships", "1", "", "Ann"), ("openalex_results", 1, "authorships", "5", "", "Bo "), ("openalex_results", 1, "referenced_works", "2", "", "W2"), ("openalex_results", 1, "referenced_works", "3", "", "W2"),
        ("paper_catalogs", 7, "sections", "1", "", "a"), ("paper_catalogs", 7, "sections", "1.1", "1", "b"),
    ]
    assert nested.nested_nodes(openalex.limit(0), catalogs.limit(0)).collect() == []


def test_shred_nested_arrays(spark):
    df = spark.createDataFrame([(1, [([("x",), None, ("y",)],), None, ([],)], "v")], "k long, a array<struct<b:array<struct<c:string>>>>, src_key string")
    tables = nested.shred(df, "k")
    assert set(tables) == {"a", "a.b"}
    assert sorted((r["node_path"], r["parent_path"], r["c"]) for r in tables["a.b"].collect()) == [("1.1", "1", "x"), ("1.3", "1", "y")]


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(3000).select(orphans.F.concat(orphans.F.lit("k"), "id").alias("k"))
    bloom = build_bloom(keys.union(spark.createDataFrame([(None,)], "k string")), "k", 3000)
    probed, maybe = bloom.probe(spark.range(9000).select(orphans.F.concat(orphans.F.lit("k"), "id").alias("k"), "id"), "k")
    counts = probed.groupBy((orphans.F.col("id") < 3000).alias("there"), maybe.alias("maybe")).count().collect()
    by = {(r["there"], r["maybe"]): r["count"] for r in counts}
    assert by[(True, True)] == 3000 and by.get((False, True), 0) < 600


def test_bare_keys(spark):
    forms = ["[[Key]]", " key", "KEY", "key.md", "[[key|An alias]]", '"key"', "key\n"]
    df = spark.createDataFrame([(f,) for f in forms], "k string")
    assert {r[0] for r in df.select(orphans.bare(orphans.F.col("k"))).collect()} == {"key"}


def test_orphans(spark):
    day = lambda n: T(2024, 1, n)
    openalex = spark.createDataFrame(
        [(1, "https://x.example/W1", None, ["W2", "w3", "openalex:W4", "pmid:11111", "PubMed: 22222", None, " ", "W1"], day(5), ""), (2, "w2", None, None, day(9), ""), (3, "W3", None, ["W9"], day(1), ""), (4, "W4", None, [], day(2), ""), (5, "W4", None, None, day(20), "")], OPENALEX
    )
    pubmed = spark.createDataFrame([(21, "11111", day(1)), (22, "22222", day(1))], "rec_id long, uid string, retrieved_at timestamp_ntz")
    tree = json.dumps([{"id": "S1", "children": [{"id": " s2 "}]}])
    catalogs = spark.createDataFrame(
        [(11, "aa", (["[[BB]]", " ", None, "zz.md", "cc"], "d"), tree, day(3)), (12, "aa", (None, "d"), json.dumps([{"id": "s1"}]), day(6)), (13, "aa", (None, "d"), "{broken", day(8)), (14, "bb", None, None, day(1)), (15, "cc", (None, ""), tree, day(9))], CATALOGS
    )
    segments = spark.createDataFrame([(31, "aa", "S1", day(7)), (32, "aa", "s2", day(7)), (33, "AA ", "s1", day(2)), (34, "aa", "s9", None), (35, "aa", None, day(7)), (36, None, "s1", day(7)), (37, "bb", "s1", day(7))], "seg_uid long, cite_key string, section_id string, updated_at timestamp_ntz")
    gone = spark.createDataFrame([("openalex_results", "https://x.example/W3", day(4)), ("openalex_results", "W4", day(10)), ("pubmed_results", "PMID:22222", day(2)), ("paper_catalogs", "BB", day(2)), ("paper_catalogs", "bb", day(3)), ("paper_catalogs", "none", day(3))], "target_table string, target_key string, withdrawn_at timestamp_ntz")
    got = {(r["src_table"], r["src_id"], r["ref_key"], r["reason"], r["ref_month"]) for r in orphans.catalog_orphans(openalex, pubmed, catalogs, segments, gone).collect()}
    m = "2024-01"
    assert got == {
        ("openalex_results", 1, "W2", "later", m), ("openalex_results", 1, "W3", "withdrawn", m), ("openalex_results", 1, "pmid:22222", "withdrawn", m), ("openalex_results", 3, "W9", "missing", m),
        ("paper_catalogs", 11, "bb", "withdrawn", m), ("paper_catalogs", 11, "zz", "missing", m), ("paper_catalogs", 11, "cc", "later", m),
        ("segment_entries", 32, "s2", "withdrawn", m), ("segment_entries", 33, "s1", "later", m), ("segment_entries", 34, "s9", "missing", None), ("segment_entries", 36, "s1", "missing", m), ("segment_entries", 37, "s1", "missing", m),
    }
    empty = orphans.catalog_orphans(*(f.limit(0) for f in (openalex, pubmed, catalogs, segments, gone)))
    assert empty.collect() == []


def test_json_of_any_depth():
    from quillspark.operators.nested import UNREADABLE, deep_json, walk_json

    deep = "[" * 20_000 + "]" * 20_000
    assert walk_json('{"x": ' + deep + ', "sections": [{"id": "a"}]}', "sections", "children", "id") == [("1", "a")]
    tree = '[{"id":"s","children":' * 5000 + "[]" + "}]" * 5000
    found = walk_json(tree, "sections", "children", "id")
    assert len(found) == 5000 and found[-1] == (".".join(["1"] * 5000), "s")
    assert walk_json(deep[:-1], "sections", "children", "id") is None and walk_json(deep + "x", "sections", "children", "id") is None
    for text in ('{"a": [1, -2.5e3, "b\\u00e9\\n", true, null, {}], "c": {"d": []}}', " [ ] ", '"x"', "0", "[01]", "[1,]", '{"a":1,}', "[NaN]", '{"a" 1}', "{1:2}", "", "tru"):
        try:
            want = json.loads(text, parse_constant=lambda c: 1 / 0)
        except (ValueError, ZeroDivisionError):
            want = UNREADABLE
        assert deep_json(text) == want
