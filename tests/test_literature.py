"""Labels, LaTeX, notes, bibliographies, merging and matching on small cases and by brute force."""

import itertools
import random

from pyspark.sql import functions as F

from quillspark.functions import labels
from quillspark.operators import latex, merging, notes
from quillspark.sources import bibliography


def values(spark, xs, f):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string").orderBy("i").select(f(F.col("x"))).collect()]


def test_labels(spark):
    assert values(spark, ["x", "E", "notation of the link", "the data", None, ""], labels.gap_type) == ["X", "E", "C", "E", "S", "S"]
    assert values(spark, ["Łuk Öst", "Doe, Ann", "Plato", "", None, ", B"], labels.author_slug) == ["ost_u", "doe_a", "plato_u", "unknown_u", "unknown_u", "b_u"]
    assert values(spark, ["One. Two", "x" * 90, None, "", " a! b"], labels.first_sentence) == ["One.", "x" * 80, "", "", "a!"]
    assert values(spark, ["a  b", "word " * 40, None], lambda x: labels.preview(x, 20)) == ["a b", "word word word wo...", ""]
    rates = spark.sql("SELECT map('rate_type', 'minimax', 'rate', 'n^{-1/2}', 'result', 'T1') AS m UNION ALL SELECT map('type', 'odd', 'is_minimax', 'false')").select(labels.convergence_rate(F.col("m")).alias("r")).collect()
    assert [(r["r"]["result"], r["r"]["type"], r["r"]["rate"], r["r"]["is_minimax"]) for r in rates] == [("T1", "minimax", "n^{-1/2}", True), ("unknown", "upper_bound", None, False)]


def test_latex(spark):
    source = "pre \\section{One} a % note\n50\\% b \\appendix tail \\section*{Two} Figure 3, Figure~\\ref{fig:7}, Figure \\ref{x}"
    df = spark.createDataFrame([(1, source), (2, ""), (3, None)], "d int, t string")
    got = [(r["d"], r["ordinal"], r["title"], r["is_appendix"]) for r in latex.sections(df, "d", F.col("t")).orderBy("ordinal").collect()]
    assert got == [(1, 1, "One", False), (1, 2, "Two", True)]
    assert values(spark, [source, ""], latex.without_comments) == [source.replace("% note", ""), ""]
    assert values(spark, [source, "\\begin{figure}\\caption{a}\\end{figure} \\begin{figure}\\end{figure} \\begin{figure*}\\caption{b}\\end{figure*}", ""], lambda x: latex.reference_numbers(x, "figure")) == [[2, 3, 7], [1, 3], []]
    front = values(spark, ["\\begin{frontmatter}\\title{A\n b}\\begin{abstract} text \\end{abstract}\\end{frontmatter}", "none", None], latex.front_abstract)
    assert tuple(front[0]) == ("A b", "text") and front[1:] == [None, None]
    assert values(spark, ["{\\'e}t{\\c{c}} \\emph{x}{y}"], latex.readable_field) == ["étç xy"]


def test_notes(spark):
    note = "---\ntitle: x\n---\n# Head\n\n## Findings\n- **A first finding here**\n* short\nThe bound holds for every estimator. Yes.\n\n## Later\nKeywords: a; *b*, c.\n"
    df = spark.createDataFrame([(1, note), (2, ""), (3, None)], "d int, t string")
    assert values(spark, [note, "no", None], notes.without_front_matter)[0].startswith("# Head") and values(spark, ["no", None], notes.without_front_matter) == ["no", None]
    assert [(r["d"], r["block"].splitlines()[0]) for r in notes.block_under(df, "d", "t", "findings").collect()] == [(1, "- **A first finding here**")]
    assert values(spark, [note, ""], notes.bullets) == [["A first finding here"], []]
    assert values(spark, [note, ""], lambda x: notes.sentences_about(x, ["bound"]))[1] == []
    assert values(spark, [note, "x", None], notes.author_keywords) == [["a", "b", "c"], [], None]
    assert values(spark, ["I n t r o d u c t i o n", "A title", "x y z a "], lambda x: notes.unspaced_title(x, F.lit(4))) == ["Introduction", "A title", "xyza"]
    assert values(spark, ["Same\u00a0 x", "## A\n### B\n##C"], notes.demoted) == ["Same\u00a0 x", "### A\n### B\n##C"]
    block = F.lit("new $1 \\\\ text")
    assert values(spark, ["## Findings\nold\n\n## B\nx", "a\n", ""], lambda x: notes.with_section(x, "Findings", block)) == ["## Findings\n\nnew $1 \\\\ text\n\n## B\nx", "a\n\n## Findings\n\nnew $1 \\\\ text\n", "\n\n## Findings\n\nnew $1 \\\\ text\n"]
    items = spark.createDataFrame([(["A b", "a  B", None, " ", "c"],), ([],), (None,)], "x array<string>").select(notes.distinct_claims(F.col("x"))).collect()
    assert [r[0] for r in items] == [["A b", "c"], [], None]


def test_bibliographies(spark):
    text = "@Article{k1, title = {A {B} c}, year=2020, note=\"q\"}\nnoise @misc{k2,\n author = {X and Y},\n}\n@broken{k3, title = {open"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "@ no entry")], "d int, t string")
    got = [(r["d"], r["entry_no"], r["entry_type"], r["cite_key"], r["fields"]) for r in bibliography.bibliography_entries(df, "d", "t").orderBy("entry_no").collect()]
    assert got == [(1, 1, "article", "k1", {"title": "A {B} c", "year": "2020", "note": "q"}), (1, 2, "misc", "k2", {"author": "X and Y"}), (1, 3, "broken", "k3", {"title": "open"})]
    row = spark.range(1).select(bibliography.bib_entry(cite_key=F.lit("k"), authors=F.array(F.lit("Ann B. Lee"), F.lit("Doe, J"), F.lit(" ")), title=F.lit("A & b_c"), arxiv_id=F.lit("2001.00001"), categories=F.array(F.lit("cs.LG")))).first()[0]
    assert row == "@article{k,\n  author = {Lee, Ann B. and Doe, J},\n  title = {{A \\& b\\_c}},\n  eprint = {2001.00001},\n  archivePrefix = {arXiv},\n  primaryClass = {cs.LG},\n  url = {https://arxiv.org/abs/2001.00001},\n}"


def folded(records):
    out = {}
    for r in records:
        r = {**r, "authors": list(r["authors"] or []), "categories": list(r["categories"] or [])}
        key = r["item_key"]
        if key not in out:
            out[key] = r
            continue
        old = out[key]
        rich = lambda x: sum(1 for f in merging.RICH if x[f])
        winner, loser = (r, old) if rich(r) > rich(old) else (old, r)
        for f in ("authors", "categories"):
            winner[f] = list(dict.fromkeys(winner[f] + loser[f]))
        for f in merging.FILLED:
            winner[f] = winner[f] or loser[f]
        out[key] = winner
    return out


def test_items_merge_like_a_fold(spark):
    rng = random.Random(8)
    schema = "rec_id long, item_key string, title string, year int, doi string, arxiv_id string, pmid string, abstract string, pdf_url string, cite_key string, zotero_url string, authors array<string>, categories array<string>"
    names = [x.split(":")[0] for x in schema.replace(" ", ":").split(",:")]
    rows = []
    for i in range(160):
        some = {f: f"{f}{i}" if rng.random() < 0.4 else rng.choice([None, ""]) for f in merging.FILLED}
        rows.append({"rec_id": i, "item_key": f"K{rng.randrange(25)}", "title": "t", "year": 2000, **some, "authors": [rng.choice("abc") + str(k) for k in range(rng.randrange(3))] or None, "categories": [rng.choice("xyz") for _ in range(rng.randrange(3))]})
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    got = {r["key"]: r for r in merging.merged_items(df).collect()}
    want = folded(rows)
    assert set(got) == set(want)
    for key, w in want.items():
        assert {f: got[key][f] or None for f in merging.FILLED} == {f: w[f] or None for f in merging.FILLED}
        assert got[key]["authors"] == list(dict.fromkeys(w["authors"])) and got[key]["categories"] == list(dict.fromkeys(w["categories"]))
    lone = spark.createDataFrame([(1, None, "A  b", None) + (None,) * 9, (2, " ", "a b", None) + (None,) * 9], schema)
    assert [r["key"] for r in merging.merged_items(lone).collect()] == ["title:a b:"]
    assert merging.merged_items(df.limit(0)).collect() == []


def test_best_items_by_brute_force(spark):
    rng = random.Random(9)
    titles = ["deep trees for slow rivers", "deep trees for slow rivers revisited", "on deep trees for slow rivers and lakes", "short", "short notes", None, "unrelated words about something else"]
    make = lambda k: (k, rng.choice([None, "10.1000/a", "10.1000/b"]), rng.choice([None, "2001.00001", "2001.00002"]), rng.choice(titles), rng.choice([None, "2020", "2021"]))
    a, b = [make(k) for k in range(40)], [make(k) for k in range(30)]

    def score(n, i):
        total = 0
        for f, p in ((1, 100), (2, 70)):
            if n[f] and i[f]:
                if n[f] != i[f]:
                    return 0
                total += p
        if n[3] and i[3]:
            total += 30 if n[3] == i[3] else 10 if n[3] in i[3] or i[3] in n[3] else 0
        return total + (5 if n[4] and n[4] == i[4] else 0)

    def met(n, i):
        return any(n[f] and n[f] == i[f] for f in (1, 2, 3)) or bool(n[3] and i[3] and min(len(n[3]), len(i[3])) >= 12 and (n[3] in i[3] or i[3] in n[3]))

    want = {}
    for n, i in itertools.product(a, b):
        if met(n, i) and score(n, i) > want.get(n[0], (0, 0))[1]:
            want[n[0]] = (i[0], score(n, i))
    shape = "doi string, arxiv string, title string, year string"
    got = {r["note_id"]: (r["item_id"], r["score"]) for r in merging.best_items(spark.createDataFrame(a, f"note_id long, {shape}"), spark.createDataFrame(b, f"item_id long, {shape}")).collect()}
    assert got == want


def test_best_items_compares_kinds_once_and_gathers_nothing(spark):
    """Repeated records all get the least item of equals; runs of titles are never broadcast, however small they seem."""
    shape = "doi string, arxiv string, title string, year string"
    kinds = [(None, None, "deep trees for slow rivers", None), ("10.1000/a", None, "on deep trees for slow rivers and lakes", "2020"), (None, None, None, None)]
    notes = spark.createDataFrame([(k, *kinds[k % 3]) for k in range(30)], f"note_id long, {shape}")
    items = spark.createDataFrame([(k, *kinds[(k + 1) % 3]) for k in range(10, 40)], f"item_id long, {shape}")
    best = merging.best_items(notes, items)
    least = {0: (11, 30), 1: (12, 135)}  # the least items with the first and the second kind of fields
    assert {r["note_id"]: (r["item_id"], r["score"]) for r in best.collect()} == {k: least[k % 3] for k in range(30) if k % 3 < 2}
    assert "Broadcast" not in best._jdf.queryExecution().executedPlan().toString()
