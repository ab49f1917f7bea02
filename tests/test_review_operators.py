"""Operators of reading and reviewing on small cases, and invariants of the folds."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.operators import documents, review, tabular


def test_page_chrome(spark):
    html = "<html><nav class='a'>Menu</nav><body><header>H</header><article><p>Real &amp; text</p></article><footer>F</footer></body></html>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "plain"), (4, "")], "i int, html string")
    rows = {r["i"]: r for r in df.select("i", *review.without_chrome(F.col("html"))).collect()}
    assert rows[1]["content"] == "<html><body><article><p>Real &amp; text</p></article></body></html>" and rows[1]["removed"] == 3
    assert rows[3]["content"] == "plain" and rows[2]["content"] is None and rows[4]["content"] == ""


def test_page_content_by_selectors(spark):
    page = "<body class=x><div class='social-links'><nav>a</nav>b</div><nav><header>c</header></nav><header>d<nav>e</nav></header><p id=toc1>f</p><main>Kept <b>words</b> &lt;<br class='banner'/> here<aside>too</aside><script>no()</script></main>tail<div class='article-share'>g"
    rows = [(1, page), (2, None), (3, "no  markup"), (4, ""), (5, "<article>one <nav>x</nav>two</article><main>three</main>"), (6, "<p>un<b>closed")]
    got = {r["i"]: r["p"] for r in spark.createDataFrame(rows, "i int, html string").select("i", review.page_content(F.col("html")).alias("p")).collect()}
    # nav in social goes first and counts; header in nav is gone before its turn; nav in header counts
    assert tuple(got[1]) == ("Kept words < here too", 8, "main")
    assert got[2] is None and tuple(got[3]) == ("no markup", 0, "body") and tuple(got[4]) == ("", 0, "body")
    assert tuple(got[5]) == ("one two", 1, "article") and tuple(got[6]) == ("un closed", 0, "body")


def test_exhibits(spark):
    text = "Intro\nExhibit 1: Sensors\nAAPL  Apple  integrator  US  12%  $3.1T  30x  note\nprose line\n0700.HK  Tencent  component  CN  3%  400bn\nExhibit 2: Figure only\nSee the chart."
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "d int, t string")
    rows = review.exhibit_rows(df, "d", "t").orderBy("line_no").collect()
    assert [(r["exhibit"], r["title"], r["ticker"], len(r["fields"])) for r in rows] == [(1, "Sensors", "AAPL", 8), (1, "Sensors", "0700.HK", 6)]
    caps = spark.createDataFrame([("$3.1T",), ("400bn",), ("none",), (None,), ("3 billion",), ("2 Trillion",), ("5 b",), ("NA",), ("",)], "x string").select(review.market_cap(F.col("x"))).collect()
    assert [c[0] for c in caps] == [3100.0, 400.0, None, None, 3.0, 2000.0, 5.0, None, None]


def test_claims(spark):
    full = {"scenario_label": "base", "horizon_year": "2030", "base_value": "1", "driver_assumptions": "x"}
    good = ("p. 3", "high")
    rows = [
        (1, "institutional", "projection", full, good), (2, "institutional", "projection", {k: v for k, v in full.items() if k != "scenario_label"}, good), (3, "institutional", "theorem", {}, good), (4, "hybrid", "theorem", None, good), (5, None, "theorem", {}, good),
        (6, None, "nothing", {}, None), (7, "academic", "connection", {}, good), (8, "academic", "connection", {"linked_paper_status": "in-corpus"}, good), (9, "sell_side", "supply-chain-fact", {"attestation_source": "x", "verifiability": "rumour"}, ("", "sure")), (10, "unheard of", "methodology", {}, good), (11, "sell_side", "empirical", {}, good),
    ]
    df = spark.createDataFrame([("a", *r) for r in rows], "cite_key string, claim_no int, domain string, type string, fields map<string,string>, anchor struct<locator string, confidence string>")
    assert {(r["claim_no"], r["rule"]) for r in review.claim_violations(df).collect()} == {
        (2, "missing scenario_label"), (3, "type not allowed in domain"), (6, "invalid type"), (6, "missing source_anchor"), (7, "missing linked_paper_status"),
        (9, "missing locator"), (9, "invalid confidence"), (9, "invalid verifiability"), (11, "type not allowed in domain"),
    }
    s = spark.createDataFrame([(2, 0, False), (0, 1, False), (0, 0, False), (3, 2, True)], "a int, b int, c boolean").select(review.claim_status(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [x[0] for x in s] == ["Supported", "Partially supported", "Uncertain", "Unsupported"]
    f = spark.createDataFrame([(10, 0, 1), (10, 3, 5), (10, 4, 0), (0, 0, 0)], "a int, b int, c int").select(review.faithfulness(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [x[0] for x in f] == ["high", "medium", "low", "low"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=14))
def test_merging_keeps_order_and_limits(sizes):
    runs = review.merged_small(sizes, 10, 45)
    assert len(runs) == len(sizes) and runs == sorted(runs)
    totals = {}
    for s, r in zip(sizes, runs):
        totals[r] = totals.get(r, 0) + s
    assert all(t <= 45 for t in totals.values())
    values = [totals[k] for k in sorted(totals)]
    for k, t in enumerate(values):
        if t < 10:
            assert all(t + values[j] > 45 for j in (k - 1, k + 1) if 0 <= j < len(values))


def test_balanced_split_and_packing(spark):
    rng = random.Random(4)
    text = "\n\n".join("word " * rng.randint(5, 60) + ("$x$" if rng.random() < 0.3 else "") for _ in range(120))
    parts = review.balanced_split(text, 2000)
    assert "\n\n".join(parts) == text and all(len(p.encode()) <= 2000 and p.count("$") % 2 == 0 for p in parts)
    assert review.balanced_split("x" * 100, 10) == ["x" * 100]
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, t string")
    packed = {r["k"]: r["p"] for r in df.select("k", documents.packed_paragraphs(F.col("t"), 3000).alias("p")).collect()}
    assert packed[2] == [] and packed[3] is None and all(len(p.encode()) <= 3000 for p in packed[1])
    assert review.split_oversized(df.where("t IS NOT NULL"), "k", "t", 2000).where("k = 1").count() == len(parts)


def test_tabular_edges(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert {r["v"] for r in tabular.not_listed(df, spark.createDataFrame([("a",), (None,)], "k string"), "k").collect()} == {2, 3}
    assert {(r["k"], r["v"]) for r in tabular.upserted(df.where("k = 'a'"), df.where("k = 'b'").union(spark.createDataFrame([("a", 9)], "k string, v int")), "k").collect()} == {("a", 9), ("b", 2)}
    assert {(r["k"], r["x"], r["y"]) for r in tabular.key_integrity({"x": df, "y": df.where("v = 1")}, "k").collect()} == {("b", True, False)}
    assert {(r["k"], r["n"]) for r in tabular.zero_filled_counts(df, "k", ["a", "z"]).collect()} == {("a", 1), ("z", 0)}
    flags = spark.createDataFrame([("g", p) for p in (1, 2, 3, 5, 7, 8, 9, 10)], "g string, p int")
    assert {(r["first"], r["second"]) for r in tabular.adjacent_pairs(flags, "g", "p").collect()} == {(1, 2), (7, 8), (9, 10)}
    rules = spark.createDataFrame([("g", i, 100, i == 0) for i in range(6)], "g string, i int, s int, keep boolean")
    assert {r["i"] for r in tabular.within_budget(rules, "g", "i", "s", F.col("keep"), 300).collect()} == {0, 4, 5}
    segs = spark.createDataFrame([("d", 1, 10), ("d", 2, 10), ("d", 3, 10), ("d", 4, 900), ("d", 5, 50)], "d string, i int, n int")
    assert {(r["i"], r["action"], r["partner"]) for r in review.resegmentation(segs, "d", "i", F.col("n"), 500, 20).collect()} == {(1, "merge", 2), (3, "rebalance", 4), (4, "split", None)}
    assert {(r["k"], r["change"]) for r in review.catalog_difference(df.where("k IS NOT NULL"), spark.createDataFrame([("a", 5), ("c", 1)], "k string, v int"), "k", ["v"]).collect()} == {("a", "updated"), ("b", "removed"), ("c", "added")}
    routed = review.reader_routes(spark.createDataFrame([("theory", None), ("method", "done"), ("other", "pending")], "section_type string, status string"), spark.createDataFrame([(n, "theory") for n in "dcba"], "note_id string, section_type string"), {"theory": "t", "method": "m"})
    assert [(r["reader"], r["note_id"]) for r in routed.orderBy("note_id").collect()] == [("t", "a"), ("t", "b"), ("t", "c")]
