"""Inputs that shortcuts had left out."""

import datetime as dt
import random

import pytest

from quillspark.llm import matching, residue, survivor


@pytest.mark.parametrize(
    "text, kind",
    [
        *((t, "error") for t in ("301 Moved Permanently", "408 Request Timeout", "406 Not Acceptable", "You do not have access to this article.", "Nothing to see here.", "Nothing was found.", "You have exceeded your quota.", "Connection reset by peer.")),
        *((t, "error") for t in ("The site is down.", "The database did not respond.", "The service is overloaded.", "The article you want has moved.", "Le service ne répond pas", '{"fault": {"code": 3}}', "A first line.\nSome words. Nothing was found.")),
        ("This is filler text.", "filler"), ("dolor sit amet consectetur adipiscing elit", "filler"), ("blah blah blah blah blah", "filler"), ("Checking your connection", "notice"), ("TODO : fill in the abstract", "placeholder"),
    ],
)
def test_residue_reaches_its_pattern(text, kind):
    assert residue.inspect(text)[0] == kind


def test_every_placeholder_grammar_passes_the_triggers():
    examples = {
        "mustache": "{{ name }}", "statement": "{% if x %}", "erb": "<%= name %>", "shell": "${name}", "printf": "%(name)s", "format": "Dear {name}", "dunder": "__NAME__", "at": "@@name@@", "bracket": "[[NAME]]", "angle": "<NAME>", "entity": "&lt;name here&gt;", "guillemet": "«nom»",
        "dollar": "$$NAME$$", "percent": "%NAME%", "instruction": "[name goes here]", "todo": "FIXME : write this", "comment": "<!-- abstract placeholder -->", "object": "[object Object]",
    }
    assert set(examples) == set(residue.GRAMMARS)
    more = ["<TITLE>", "<your name>", "##NAME##", "[INSERT name]", "[Enter name]", "[ADD name]", "[TYPE name]", "[FILL IN name]", "[your name]", "(add name)", "(insert name)", "(fill in name)", "TBD", "XXXX (name)", "<!-- todo name -->", "undefined", "Title: NaN"]
    assert [t for t in (*examples.values(), *more) if (residue.inspect(t) or [""])[0] != "placeholder"] == []


def longest(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last, row = row, [0]
        for j, b in enumerate(y):
            row.append(last[j] + 1 if a == b else max(row[j], last[j + 1]))
    return row[-1]


def test_alignment_is_a_longest_one():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(30))] for _ in range(2))
        pairs = survivor.align(a, b)
        assert [i for i, _ in pairs if i >= 0] == list(range(len(a))) and [j for _, j in pairs if j >= 0] == list(range(len(b)))
        matched = [(i, j) for i, j in pairs if i >= 0 and j >= 0]
        assert all(a[i] == b[j] for i, j in matched) and len(matched) == longest(a, b)


def test_very_long_texts_are_aligned():
    words = [f"w{k}" for k in range(6000)]
    one, other = ["begin", *words, "end"], ["start", *words, "stop"]
    assert survivor.agreement(one, other) == 6000 / 6002
    agreed = survivor.consensus_tokens([(one, 1.0), (other, 0.9)])
    assert len(agreed) < 6010 and survivor.agreement(other, agreed) > 0.99


COUNTS = "rec_id long, id string, cited_by_count int, retrieved_at timestamp_ntz"


def counts(spark, courses):
    rows = [(f"https://openalex.example/W{w}", n, dt.datetime(2024, 1, 1) + dt.timedelta(days=d)) for w, course in courses.items() for d, n in enumerate(course)]
    got = survivor.best_counts(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], COUNTS)).collect()
    return {int(r["group_key"][1:]): int(r["value"]) for r in got}


@pytest.mark.parametrize("copies", [1, 40])
def test_a_spoilt_count_is_told_at_every_size(spark, copies):
    courses = {10 * c + w: [5, 6, 7, spoilt] for c in range(copies) for w, spoilt in enumerate([99999999, 99999999, 99998888, 99998888])}
    assert set(counts(spark, courses).values()) == {7}


def test_true_large_counts_stay_however_often_retrieved(spark):
    hot = {1: [70000] * 30 + [70001] * 30, 2: [90000, 90010], 3: [3, 99999], 4: [4, 99999], 5: [80000, 80000]}
    assert counts(spark, hot) == {1: 70001, 2: 90010, 3: 3, 4: 4, 5: 80000}


def test_an_abstract_vouches_for_a_pair_of_other_authors(spark):
    titles = ["causal forests for early flood warning in deltas", "causal forest for early flood warning in deltas"]
    row = lambda k, title, who, marks: (k, k, title, title.split(), who.split(), k, 1, marks, None, None, None)
    schema = "pid long, src int, plain string, terms array<string>, names array<string>, vid long, title_ents long, marks array<long>, doi string, arxiv string, pmid string"
    who = ["the delta study group", "müller quispe okafor zhang"]
    for marks, want in ([5, 6], [(1, 2)]), ([8, 9], []):
        spelt = spark.createDataFrame([row(1, titles[0], who[0], [5, 7]), row(2, titles[1], who[1], marks)], schema).withColumn("vector", matching.bit_vector(matching.F.col("terms")))
        assert [tuple(r) for r in matching.candidate_pairs(spelt)[0].collect()] == want


@pytest.mark.parametrize("text", ["Lorem ipsum", "<INSERT NAME>", "{{ customer_relationship_management_account_owner_name }}", "{" + "name" * 30 + "}", "<fault>" + "x" * 900 + "</fault>", "408 Request Time-out", "Connection reset by peer", "Le service est surchargé", "Wait 30 seconds and reload.", "Insert your own words in this box.", "Here is more text, then text, then text.", "As undefined argue, the result holds."])
def test_residue_of_any_length_and_wording(text):
    assert residue.inspect(text) is not None


@pytest.mark.parametrize("text", ["We return to the previous section later.", "The text of the notes is short.", "A value of `undefined` in column 3 is treated as missing.", "Its authors wait 30 seconds and reload the cell.", "The set {12} of $x_{ij}$ is used.", "# Heading\n\n[[note_key]] and [1, 2]"])
def test_texts_about_such_things_are_none(text):
    assert residue.inspect(text) is None


def test_pieces_end_within_the_limit_at_the_longest_boundary(spark):
    from quillspark.llm import splitting

    text = ("x" * 700 + "\r\n  \r\n    ") * 40
    rows = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, t string")
    got = splitting.split_texts(rows, "t").orderBy("piece").collect()
    assert {r["k"] for r in got} == {1} and all(r["piece_tokens"] <= 2048 and len(r["piece_text"]) <= 2048 * 4 + 3 for r in got)
    assert "".join(r["piece_text"][r["core_start"] - r["piece_start"] :] for r in got) == text


def test_gaps_are_filled_from_the_index():
    import itertools

    from quillspark.llm.packing import SumIndex

    rng = random.Random(9)
    for _ in range(60):
        counts = {rng.randrange(1, 41): rng.randrange(1, 3) for _ in range(rng.randrange(1, 9))}
        index = SumIndex(counts, 40)
        for size in list(counts):
            if rng.random() < 0.3:
                index.add(size, -1)
                counts[size] -= 1
        items = [s for s, n in counts.items() for _ in range(min(n, 3))]
        sums = {k: {sum(c) for c in itertools.combinations(items, k)} for k in (1, 2, 3)}
        for gap in range(1, 41):
            fill = index.fill(gap)
            least = next((k for k in (1, 2, 3) if gap in sums[k]), None)
            assert (fill is None) == (least is None) and (fill is None or (len(fill) == least and sum(fill) == gap))
        assert [int(x) for x in index.pairs[:41]] == [sum(1 for a in range(1, 41) for b in range(a, 41) if a + b == t and counts.get(a, 0) > 0 and counts.get(b, 0) > (a == b)) for t in range(41)]
