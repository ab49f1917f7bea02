"""Queries run over every row of their tables."""

from quillspark.plans import relational


def test_ticker_forms_keeps_customers_of_any_key(spark, tmp_path):
    keys = [0, 14999, 89999, 90000, 90001, 90002, 90003, 123456, 150001, 9_000_000_000]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    got = {r["c_custkey"]: (r["ticker"], r["kind"]) for r in relational.ticker_forms(spark, str(tmp_path)).collect()}
    assert sorted(got) == keys
    assert got[90000] == ("600000.SH", "mapped_exchange") and got[90001] == ("00001.HK", "mapped_exchange")
    assert got[90002] == ("T90002", "us_bare") and got[90003] == ("X?90003", "preserved_unknown")
    assert got[123456] == ("633456.SH", "mapped_exchange")


def test_near_dup_prefix_reads_texts_of_any_script(spark, tmp_path):
    texts = ["Über  die Ähnlichkeit\n von Texten", "über die ähnlichkeit von texten", "机器学习 与 统计", "机器学习\u3000与 统计 ", "Plain text", "plain TEXT", "É" * 130, "é" * 125, "\u00a0 \n", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for i, t in enumerate(texts):
        mark = " ".join((t or "").split()).lower()[:120]
        if mark:
            first, n = want.get(mark, (i, 0))
            want[mark] = (first, n + 1)
    assert {r["mark"]: (r["doc_id"], r["n"]) for r in relational.near_dup_prefix(spark, str(tmp_path)).collect()} == want
    assert want["über die ähnlichkeit von texten"] == (0, 2)


def test_bibtex_entries_gives_every_record(spark, tmp_path):
    rows = [(1, "11", "Growth\n of R&D", "2019 May"), (2, "12", "Étude naïve", "2020"), (3, "13", None, "2021"), (4, "14", "No date", None), (5, None, "No uid", "2022")]
    spark.createDataFrame(rows, "rec_id long, uid string, title string, pubdate string").write.parquet(str(tmp_path / "pubmed_results.parquet"))
    assert {r["rec_id"]: r["entry"] for r in relational.bibtex_entries(spark, str(tmp_path)).collect()} == {
        1: "@article{11,\n  title = {Growth of R\\&D},\n  year = {2019}\n}", 2: "@article{12,\n  title = {Étude naïve},\n  year = {2020}\n}", 3: "@article{13,\n  year = {2021}\n}",
        4: "@article{14,\n  title = {No date}\n}", 5: "@article{rec5,\n  title = {No uid},\n  year = {2022}\n}",
    }


def test_html_content_is_the_cleaned_text(spark, tmp_path):
    texts = {1: "<body><nav>menu</nav><ARTICLE class='a'>One <b>two</b>\n three</ARTICLE>rest</body>", 2: "<html><header>h</header><main>Main\n<style>x{}</style> text</main><footer>f</footer></html>", 3: "no markup at  all", 4: "<body>only <aside>ads</aside>body</body>", 5: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["content"], r["removed"], r["root"]) for r in relational.QUERIES["html_content"](spark, str(tmp_path)).collect()}
    assert got == {1: ("One two three", 1, "article"), 2: ("Main text", 2, "main"), 3: ("no markup at all", 0, "body"), 4: ("only ads body", 0, "body")}


def test_long_formulas_are_notation(spark):
    from pyspark.sql import functions as F

    from quillspark.operators import review

    long = "x_{" + "1" * 90 + "}"
    df = spark.createDataFrame([(1, f"Let ${long}$ be $y$ and $y$; $$z$$ stays."), (2, None), (3, "")], "d int, t string")
    assert {(r["d"], r["symbol"], r["uses"]) for r in review.notation(df, "d", F.col("t")).collect()} == {(1, long, 1), (1, "y", 2)}
