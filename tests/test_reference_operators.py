"""Functions and operators of the literature pipeline."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import ids, scoring, text
from quillspark.operators import documents, graph, tabular
from quillspark.operators.graph import connected_components, hop_distances
from quillspark.plans import discovery
from quillspark.sources import records, sinks
from quillspark.streaming import status


def values(spark, rows, make):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_identifiers(spark):
    assert values(spark, ["https://doi.org/10.1234/AbC", "doi: 10.1234/x y", "10.12/x", None, " DOI:10.55555/q "], ids.clean_doi) == ["10.1234/abc", None, None, None, "10.55555/q"]
    assert values(spark, ["https://o.example/w12", "none", None], ids.clean_openalex) == ["W12", None, None]
    assert values(spark, ["PMID: 12345", "12345", "see 12345", "pubmed record 123456", "123"], ids.clean_pmid) == ["12345", "12345", None, "123456", None]
    assert values(spark, ["http://a.example/abs/2401.12345v2", "10.1/2401.12345", "10.48550/arxiv.2401.12345", "arXiv:hep-th/9901001", None], ids.arxiv_id) == ["2401.12345", "2401.12345", "2401.12345", "hep-th/9901001", None]
    assert values(spark, ["2024 May", "in 1899", "x1999y"], ids.parse_year) == [2024, None, 1999]


def test_keys_and_tickers(spark):
    assert values(spark, ["Zhang, Wei", "Wei Zhang", "Ångström Ø", ""], ids.surname) == ["zhang", "zhang", "unknown", "unknown"]
    assert values(spark, ["Towards the Neural Methods", "of the", None], lambda x: ids.cite_key(F.lit("Li Zhang"), F.lit(2024), x)) == ["zhang2024neural", "zhang2024paper", "zhang2024paper"]
    assert values(spark, ["arxiv:2401.12345", "doi:10.5678/example.2024.002", "openalex:W123456", "manual:abcdef12"], ids.key_suffix) == ["a2401", "d4002", "o3456", "mabcd"]
    got = values(spark, ["600519-CN", "000858-CN", "0700.HK", "700 HK", "12345-HK", "AAPL-US", "XYZ-UNKNOWN"], ids.ticker)
    assert [tuple(x) for x in got] == [("600519.SH", "mapped_exchange"), ("000858.SZ", "mapped_exchange"), ("0700.HK", "preserved_known"), ("700 HK", "preserved_unknown"), ("12345.HK", "mapped_exchange"), ("AAPL", "us_bare"), ("XYZ-UNKNOWN", "preserved_unknown")]


def test_text_functions(spark):
    assert values(spark, ["Ærøskøbing ŁÓDŹ", "é", None], text.fold) == ["aeroskobing lodz", "e", None]
    assert values(spark, ["the $\\beta$ and α", None], text.spell_greek) == ["the beta and alpha", None]
    df = spark.sql("SELECT map('b', array(1, 3), 'a', array(0, 3)) AS m")
    assert df.select(ids.inverted_abstract(F.col("m"))).first()[0] == "a b a"


@pytest.mark.parametrize("kw, seed, cites, expected", [(3, 0, 321, 0.8587), (1, 1, 12, 0.4990), (0, 1, 45, 0.4265), (0, None, None, 0.1333)])
def test_hand_derived_scores(spark, kw, seed, cites, expected):
    df = spark.createDataFrame([(kw / 3, seed, cites)], "kw double, seed int, cites int")
    score = scoring.relevance(F.col("kw"), scoring.seed_score(F.col("seed")), scoring.recency_score(F.lit(2024), 2020, 2026), scoring.citation_score(F.col("cites")))
    assert df.select(score).first()[0] == pytest.approx(expected, abs=1e-4)


def test_components_against_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(900, k) for k in range(901, 980)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    df = spark.createDataFrame(edges + [(None, 1)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {n: find(n) for n in parent}
    assert connected_components(df.limit(0)).collect() == []


def test_hops(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (8, 9)], "a long, b long")
    got = {r["node"]: r["distance"] for r in hop_distances(edges, spark.createDataFrame([(1,), (77,)], "node long")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 2, 77: 0}


def test_discovery_merges_and_names(spark, tmp_path):
    zotero = spark.createDataFrame([(1, "Neural methods", ["Wei Zhang"], 2024, "text", "10.1234/a", None, None, None, ["ml"], "zhang2024methods_zot", "K1", "K1", None)], "rec_id long, title string, authors array<string>, year int, abstract string, doi string, arxiv_id string, pmid string, pdf_url string, categories array<string>, cite_key string, id string, item_key string, zotero_url string")
    arxiv = spark.createDataFrame([(2, "http://a.example/abs/2401.12345v1", "Neural Methods", ["Zhang, Wei"], "s", "2024-01-01", None, ["cs.LG"], ["W77"]), (9, "http://a.example/abs/2402.00001v1", " ", None, None, None, None, None, None)], "rec_id long, id string, title string, authors array<string>, summary string, published string, pdf_url string, categories array<string>, reference_ids array<string>")
    openalex = spark.createDataFrame(
        [(3, "W5", "10.1234/a", "Neural methods", None, 2023, None, None, 321, (None, None, "2401.12345", None), ["doi:10.9999/none"], None, None), (4, "W77", None, "Graphs", [(("Bo Park",),)], 2024, None, None, 45, (None, None, None, None), None, None, None)],
        "rec_id long, id string, doi string, title string, authorships array<struct<author:struct<display_name:string>>>, publication_year int, abstract_inverted_index map<string,array<int>>, abstract string, cited_by_count int, ids struct<openalex:string,doi:string,arxiv:string,pmid:string>, referenced_works array<string>, best_oa_location struct<pdf_url:string>, concepts array<struct<display_name:string>>",
    )
    web = spark.createDataFrame([(5, "Attention everywhere", ["Al Morgan"], 2024, None, "https://w.example/x.pdf", None)], "rec_id long, title string, authors array<string>, year int, snippet string, url string, categories array<string>")
    pubmed = spark.createDataFrame([], "rec_id long, uid string, pmid string, title string, authors array<string>, pubdate string, doi string, abstract string, mesh_terms array<string>, citation_count int, reference_ids array<string>")
    ranked = discovery.ranked_works(discovery.normalized_records(zotero, arxiv, openalex, web, pubmed), ["arxiv:2401.12345"], ["neural methods"], 2020, 2026)
    rows = ranked.collect()
    assert [(r["canonical_id"], r["cite_key"], r["seed_distance"], r["citation_count"]) for r in rows][:2] == [("arxiv:2401.12345", "zhang2024methods_zot", 0, 321), ("openalex:W77", "park2024graphs", 1, 45)]
    assert rows[2]["canonical_id"].startswith("manual:") and rows[2]["cite_key"] == "morgan2024attention" and rows[0]["categories"] == ["ml", "cs.LG"] and len(rows) == 3
    out = spark.createDataFrame(rows, ranked.schema)
    assert discovery.manifest_violations(out).collect() == []
    assert {r["rule"] for r in discovery.manifest_violations(out.union(out).withColumn("relevance_score", F.lit(2.0))).collect()} >= {"score", "repeated canonical_id", "repeated cite_key"}


def test_tables_and_documents(spark):
    doc = "---\ntitle:  A  b\n---\n## One\n\n| a | b |\n|---|---|\n| 1 |\n| x | y |\n\n## Two\nshort\nlines\nhere\n\n$$x$$ and $y$ \\cite{k1} [[k1]]"
    df = spark.createDataFrame([(1, doc), (2, ""), (3, None)], "doc_id long, text string")
    assert [(r["line_no"], r["cells"]) for r in documents.table_cells(df, "doc_id", "text").orderBy("line_no").collect()] == [(8, ["1", ""]), (9, ["x", "y"])]
    assert [(r["heading"], r["first_line"], r["last_line"]) for r in documents.section_spans(df, "doc_id", "text").orderBy("first_line").collect()] == [("One", 4, 10), ("Two", 11, 16)]
    assert [tuple(r) for r in documents.front_matter(df, "doc_id", F.col("text")).collect()] == [(1, "title", "A b")]
    assert [tuple(r) for r in documents.cited_keys(df, "doc_id", F.col("text")).collect()] == [(1, "k1", 2)]
    metrics = df.where("doc_id = 1").select(*documents.document_metrics(F.col("text"))).first()
    assert metrics["sections"] == 2 and metrics["equations"] == 1 and metrics["balanced"]


def test_overlap_against_all_pairs(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(25)]
    pick = lambda: sorted(rng.sample(words, rng.randint(0, 9)))
    claims, notes = [(i, pick()) for i in range(60)], [(i, pick()) for i in range(80)]
    got = {(r["claim_id"], r["note_id"], r["shared"]) for r in tabular.overlap_matches(spark.createDataFrame(claims, "claim_id long, tokens array<string>"), spark.createDataFrame(notes, "note_id long, tokens array<string>")).collect()}
    assert got == {(i, j, len(set(a) & set(b))) for i, a in claims for j, b in notes if len(set(a) & set(b)) >= max(2, min(4, len(a) // 2))}


def test_global_rank(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") * 37 % 101).alias("v"))
    rows = tabular.global_rank(df, [F.desc("v"), F.asc("id")]).collect()
    order = sorted(((-(i * 37 % 101), i) for i in range(500)))
    assert {r["id"]: r["rank"] for r in rows} == {i: k for k, (_, i) in enumerate(order, 1)} and {r["total"] for r in rows} == {500}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "other").mkdir()
    for name, body in {"a.json": [{"t": "x"}, 3, {"t": None}, [1]], "b.json": {"results": [{"t": "y"}]}, "c.json": {"t": "z", "n": 1}, "e.json": {"foo": [1, 2], "t": "x"}, "other/a.json": {"entries": 1, "works": [{"t": "w"}], "data": []}, "f.json": 7}.items():
        (tmp_path / name).write_text(json.dumps(body))
    (tmp_path / "d.json").write_text("{broken")
    got = records.json_records(spark, [str(tmp_path / f"{x}.json") for x in ("a", "b", "c", "d", "e", "f", "other/a")], "t string, n int").orderBy("file_order", "row_order").collect()
    assert [(r["t"], r["n"], r["file_order"]) for r in got] == [("x", None, 0), (None, None, 0), ("y", None, 1), ("z", 1, 2), ("w", None, 6)]
    with pytest.raises(FileNotFoundError):
        records.json_records(spark, [str(tmp_path / "none.json")], "t string")
    (tmp_path / "f.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:a="urn:a"><entry><id> u1 </id><title>A\n title</title><summary>s</summary><published>2024</published><author><name>Ann</name></author><category term="x"/><category term="y"/><a:primary_category term="y"/><link href="http://h.example/pdf/1" type="application/pdf"/></entry></feed>')
    (entry,) = records.atom_entries(spark, [str(tmp_path / "f.xml")]).collect()
    assert (entry["id"], entry["title"], entry["authors"], entry["categories"], entry["pdf_url"]) == ("u1", "A title", ["Ann"], ["y", "x"], "http://h.example/pdf/1")
    df = spark.createDataFrame([("g", 2, "b|c"), ("g", 1, None)], "g string, o int, t string")
    assert sinks.pipe_table(df, "g", ["o", "t"], "o").first()["markdown"] == "| o | t |\n|---|---|\n| 1 |  |\n| 2 | b\\|c |"
    assert df.limit(1).select(sinks.bibtex(F.lit("k"), F.lit("misc"), {"title": F.lit("A & b"), "note": F.lit(" ")})).first()[0] == "@misc{k,\n  title = {A \\& b}\n}"


def test_streams(spark, tmp_path):
    src, ck = (str(tmp_path / x) for x in ("src", "ck"))
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00", "pending"), ("a", "2024-01-01 12:00:00", "read"), ("a", "2024-01-01 11:00:00", "downloaded"), ("b", "2024-01-02 01:00:00", "pending")], "k string, at string, status string").withColumn("at", F.col("at").cast("timestamp"))
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    states = status.latest_states(stream, "k", "at", "status")
    q = states.writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["k"]: r["status"] for r in spark.table("states").collect()} == {"a": "read", "b": "pending"}
    assert {(r["k"], r["mentions"]) for r in status.queue_counts(df, "k", "at").collect()} == {("a", 3), ("b", 1)}


def test_entry_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "p4_found" in e.queries()


def test_hops_go_on_to_the_end_of_a_chain(spark):
    edges = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(100)] + [("n005", "n005"), (None, "n001")], "a string, b string")
    got = {r["node"]: r["distance"] for r in graph.hop_distances(edges, spark.createDataFrame([("n000",), ("lone",), (None,)], "node string"), fold_every=16).collect()}
    assert got == {**{f"n{i:03}": i for i in range(101)}, "lone": 0}


def test_lines_stay_in_their_document(spark):
    text = "intro\r\n\n# One \r\na\nb\n\n##   Two\n#no heading\n| h | k |\n|---|---|\n| 1 |\n| 2 | 3 | 4 |\nend\n"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "# Only"), (5, "\n\n# H\n\n")], "d int, t string")
    got = {(r["d"], r["line_no"]): (r["line"], r["heading"]) for r in documents.headed_lines(df, "d", "t").collect()}
    want = {}
    for d, t in ((1, text), (2, ""), (4, "# Only"), (5, "\n\n# H\n\n")):
        head = None
        for n, line in enumerate(re.split("\r?\n", t), 1):
            if re.match("#{1,6} ", line):
                head = re.match(r"#{1,6} +(.*?)[ \r]*$", line)[1]
            want[d, n] = (line, head)
    assert got == want
    assert {tuple(r) for r in documents.section_spans(df, "d", "t").collect()} == {(1, "One", 3, 6), (1, "Two", 7, 14), (4, "Only", 1, 1), (5, "H", 3, 5)}
    assert {(r["d"], r["line_no"], tuple(r["cells"])) for r in documents.table_cells(df, "d", "t").collect()} == {(1, 11, ("1", "")), (1, 12, ("2", "3"))}
    assert {tuple(r) for r in documents.short_line_runs(df, "d", "t").collect()} == {(1, 3, 3), (1, 7, 7)}


def test_keys_of_works(spark):
    from quillspark.plans import discovery

    schema = "group string, title string, year int, authors array<string>, arxiv_id string, doi string, openalex_id string, pmid string, cite_key string"
    rows = [("1", "The Naïve Model", 2020, ["Łukasz Čapek"], "2001.00001", None, None, None, None), ("2", "A naive model", 2020, ["Capek, L."], None, "10.1000/ab.cd", None, None, None), ("3", "Other", None, [], None, None, None, None, "mine"), ("4", "On trees", 2019, ["X Mine"], None, None, "W12345", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r["group"]: r["cite_key"] for r in discovery.assigned_keys(df).collect()}
    assert got == {"1": "capek2020nai", "2": "capek2020naive", "3": "mine", "4": "mine2019trees"}
    shared = df.unionByName(spark.createDataFrame([("5", "Naive", 2020, ["Capek"], None, None, "W98765", None, None)], schema))
    got = {r["group"]: r["cite_key"] for r in discovery.assigned_keys(shared).collect()}
    assert got["2"] == "capek2020naive_dabcd" and got["5"] == "capek2020naive_o8765" and got["1"] == "capek2020nai"
    twice = df.unionByName(spark.createDataFrame([("6", "Again", 2021, [], None, None, None, None, "mine")], schema))
    assert sorted(r["cite_key"] for r in discovery.assigned_keys(twice, "keep").collect()).count("mine") == 2
    with pytest.raises(Exception, match="cite_key of several works: mine"):
        discovery.assigned_keys(twice).collect()


def test_merging_prefers_full_records_then_sources(spark):
    from quillspark.plans import discovery

    schema = "rid long, search_source string, ord struct<src:int,row:long>, title string, authors array<string>, year int, abstract string, arxiv_id string, doi string, openalex_id string, pmid string, pdf_url string, categories array<string>, citation_count int, cite_key string, refs array<string>, aliases array<string>"
    row = lambda rid, source, src, title, cats, refs=(), pdf=None: (rid, source, (src, rid), title, ["A"], 2020, "", "2001.00001", None, None, None, pdf, cats, None, None, list(refs), [])
    df = spark.createDataFrame([row(1, "openalex", 2, "Open", ["x", "y"], ["r1"]), row(2, "arxiv", 1, "Arx", ["y", "z"], ["r2", "r1"]), row(3, "web", 3, "Web", ["w"])], schema)
    (got,) = discovery.merged_works(df, spark.createDataFrame([(1, "g"), (2, "g"), (3, "g")], "rid long, group string")).collect()
    assert (got["title"], got["search_source"], got["categories"], got["refs"], got["pdf_url"], got["records"]) == ("Arx", "arxiv", ["y", "z", "x", "w"], ["r2", "r1"], "https://arxiv.org/pdf/2001.00001.pdf", 3)
