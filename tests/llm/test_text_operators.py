"""Splitting against the text itself, and residue on small cases of either kind."""

import datetime as dt

import pytest

from quillspark.llm import residue, splitting


def long_text(kind):
    sentence = "Each fold holds out some groups, so that nothing leaks. "
    return {
        "paragraphs": ("\n\n".join([sentence * 6] * 40)),
        "one line": sentence * 300,
        "no boundary": "x" * 20_000,
        "chinese": "本节研究用于文献的方法。" * 1500,
        "crlf": ("line of text\r\n" * 2000),
        "emoji": "🙂" * 9000,
    }[kind]


@pytest.mark.parametrize("kind", ["paragraphs", "one line", "no boundary", "chinese", "crlf", "emoji"])
def test_pieces_are_the_text_within_the_limits(spark, kind):
    text = long_text(kind)
    df = spark.createDataFrame([(1, text, 5)], "seg long, body string, piece int")
    rows = sorted(splitting.split_texts(df, "body").collect(), key=lambda r: r["piece"])
    assert [r["piece"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) > 1
    out = ""
    for r in rows:
        over = r["core_start"] - r["piece_start"]
        assert len(r["piece_text"]) // 4 <= 2048 and over // 4 <= 128 and r["piece_text"] == text[r["piece_start"] : r["piece_start"] + len(r["piece_text"])]
        assert (over > 0) == (r["piece"] > 1)
        out += r["piece_text"][over:]
    assert out == text
    if kind in ("paragraphs", "one line"):
        assert all(r["piece_text"].rstrip().endswith(".") for r in rows)


def test_only_the_last_oversized_row_counts(spark):
    t = dt.datetime
    big, small = "word " * 4000, "short"
    rows = [
        (1, "a", "s1", "x", [10, 12], big, t(2024, 1, 1)), (2, "a", "s1", "x", [10, 12], small, t(2024, 2, 1)), (3, "b", "s1", None, [5, 5], big, t(2024, 1, 1)), (4, "b", "s1", "y", None, big, t(2024, 1, 1)),
        (5, "c", "s1", "x", [1, 1], None, None), (6, "d", "s1", "x", [], "", None), (7, "e", "s1", "x", [3, 9], "l\n" * 5000, None),
    ]
    df = spark.createDataFrame(rows, "seg_uid long, cite_key string, id string, section_id string, source_lines array<int>, body string, updated_at timestamp_ntz")
    got = splitting.split_segments(df).collect()
    assert {r["seg_uid"] for r in got} == {4, 7}
    assert all(r["source_lines"] is None and r["section_id"] == "y" for r in got if r["seg_uid"] == 4)
    seven = sorted((r for r in got if r["seg_uid"] == 7), key=lambda r: r["piece"])
    assert seven[0]["source_lines"][0] == 3 and seven[-1]["source_lines"][1] == 3 + 4999


CASES = [
    ("{{ title }}", "placeholder"), ("title: <%= paper.title %>", "placeholder"), ("Intro text.\n\nThis paper by [title goes here] studies {0}.", "placeholder"), ("Keywords: TODO: fill in venue", "placeholder"), ("year: __YEAR__", "placeholder"),
    ("A fine text about trees. Keywords: undefined", "placeholder"), ("Lorem ipsum dolor sit amet consectetur elit", "filler"), ("Sample text. Sample text. Sample text. Sample text. Sample text.", "filler"), ("xxxxx " * 20, "filler"),
    ("404 Not Found", "error"), ("Real words here.\n\nInternal Server Error (request 1a).", "error"), ("Der Dienst ist vorübergehend nicht erreichbar.", "error"), ("Oops! Something went wrong on our side.", "error"), ("THE PDF COULD NOT BE LOADED.", "error"), ("jkl asdf asdf foo bar asdfg asdfg", "filler"), ("xxxxx xxxxx xxxxx xxxxx xxxxx", "filler"), ("Zugriff verweigert. Bitte neu anmelden.", "error"), ("Traceback (most recent call last):\n  File \"a.py\"", "error"),
    ("<html><body><h1>Please enable JavaScript to view this page.</h1></body></html>", "notice"), ("COOKIES MUST BE ALLOWED FOR THIS SITE TO WORK.", "notice"), ("请启用 JavaScript 以查看此页面。", "notice"),
]
CLEAN = [
    None, "", "   ", "​", "<|endoftext|>", "The set $\\{\\{a\\}\\}$ has ${k}$ members.", "\\begin{equation}\\label{eq:a} x_{ab} \\end{equation}", "Template matching with `${title}` is described in the manual.", "```\n{{ title }}\n```\nThe rest is prose.",
    'Coders wrote "page not found" in the margin.', "Page not found errors are modelled as a Poisson process.", "In the macro, %(year)s is expanded once per row.", "Access was denied to 12 applicants.", "Of the links, 3 answered with 404 Not Found and were dropped.",
    "JavaScript engines enable inline caching.", "See [[smith2020trees]] for more.", "Lorem ipsum paragraphs served as the control stimulus.", "The ratio is undefined for zero.", "The root could not be found in closed form, so we bound it.", "Ein Fehler von 3% bleibt.",
]


@pytest.mark.parametrize("text, kind", CASES)
def test_residue_is_found(text, kind):
    assert residue.inspect(text)[0] == kind


@pytest.mark.parametrize("text", CLEAN)
def test_talk_and_blanks_are_no_residue(text):
    assert residue.inspect(text) is None


def test_residue_in_a_very_long_text_and_on_tables(spark):
    body = " ".join(f"The estimator {i} is stable, and its rate {i % 7} is known." for i in range(20_000))
    rows = [(1, body), (2, body + "\n\n{{ title }}"), (3, None), (4, "404 Not Found"), (4, "404 Not Found")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", residue.F.lit("clash"))
    assert sorted(r["doc_id"] for r in residue.find_residue(df).collect()) == [2, 4, 4]
    assert residue.find_residue(df.limit(0)).collect() == []
