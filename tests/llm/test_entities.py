"""Matching, names and survivors on small tables with known answers."""

import datetime as dt

import numpy as np
import pytest

from quillspark.llm import matching, names, survivor
from quillspark.session import checkpoint_dir

T = dt.datetime
RESULTS = {
    "openalex": "rec_id long, id string, doi string, title string, authorships array<struct<author:struct<display_name:string>>>, publication_year int, abstract_inverted_index map<string,array<int>>, abstract string, cited_by_count int, ids struct<openalex:string,doi:string,arxiv:string,pmid:string>, retrieved_at timestamp_ntz, src string",
    "arxiv": "rec_id long, id string, title string, authors array<string>, summary string, published string, pdf_url string, retrieved_at timestamp_ntz",
    "pubmed": "rec_id long, uid string, pmid string, title string, authors array<string>, pubdate string, doi string, abstract string",
    "web": "rec_id long, title string, authors array<string>, year int, snippet string, url string",
}
TITLES = ["Learning from heavy tails: causal forests for flood warning", "Spectral clustering under rural clinics: the Furin index", "Does meta-learning help sleep staging? Evidence from small samples", "On the β-stability of optimal transport in panel attrition"]


def oa(i, work, title, authors, year, doi=None, arxiv=None):
    return (i, f"https://openalex.example/W{work}", doi, title, [((a,),) for a in authors] if authors is not None else None, year, None, None, 1, (None, None, arxiv, None), T(2024, 1, 1), "clash")


@pytest.fixture(scope="module")
def works(spark):
    openalex = [
        oa(1, 10, TITLES[0], ["Ann Lee", "Bo Hart"], 2020), oa(2, 10, TITLES[0].upper(), ["Lee, Ann", "Hart B"], 2020), oa(3, 11, "Erratum: " + TITLES[0], ["Ann Lee", "Bo Hart"], 2021), oa(4, 12, TITLES[0].replace("causal forests", "score matching"), ["Ann Lee", "Bo Hart"], 2020),
        oa(5, 13, TITLES[1], ["Cy Moss"], 2019), oa(6, 14, None, None, None), oa(7, 15, TITLES[3], ["Di Voss", "Ed Young"], 2022, arxiv="2201.00001v2"),
    ]
    arxiv = [(101, "http://arxiv.example/abs/2001.00001v1", "Learning from heavy tials:\n causal forests for flood warning", ["A. Lee", "Bo Hart"], None, "2019-12-30T00:00:00Z", None, None), (102, "http://arxiv.example/abs/2201.00001v2", "On the $\\beta$-stability of optimal transport in panel attrition", ["Voss D"], None, "2022-01-01", None, None)]
    pubmed = [(201, "12345678", "pmid:12345678", TITLES[1] + ".", ["Moss C"], "2019 May", None, None), (202, "12345679", None, TITLES[2], [], None, None, None)]
    web = [(301, TITLES[2] + " | Some Shelf", None, None, None, "https://shelf.example/1"), (302, "  ", None, None, None, "https://shelf.example/2")]
    frames = [spark.createDataFrame(rows, RESULTS[k]) for k, rows in (("openalex", openalex), ("arxiv", arxiv), ("pubmed", pubmed), ("web", web))]
    return frames


def test_works_are_matched_across_sources(works):
    rows, links, classes = matching.match_works(*works)
    pairs = {(r["rec_lo"], r["rec_hi"]) for r in matching.work_pairs(rows, classes).collect()}
    assert {(1, 101), (2, 101), (5, 201), (7, 102), (202, 301)} == pairs
    assert all(0.5 <= r["confidence"] <= 1 for r in links.collect())


def test_no_rows_match_nothing(works):
    rows, _, classes = matching.match_works(*(f.limit(0) for f in works))
    assert matching.work_pairs(rows, classes).collect() == []


def signed(bits):
    return [x - 2**64 if x >> 63 else x for x in ((bits >> (64 * k)) & (2**64 - 1) for k in range(matching.PARTS))]


def indexed(spark, vectors):
    df = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(vectors)], "vid long, vector array<long>")
    return df.withColumn("n", matching.ones(df["vector"])).checkpoint()


def test_index_finds_every_pair_within_its_radius(spark):
    checkpoint_dir(spark)
    rng = np.random.default_rng(3)
    draw = lambda n: sum(1 << int(b) for b in rng.choice(512, size=n, replace=False))
    base = [draw(90) for _ in range(60)]
    near = [v ^ draw(2 * matching.PARTS - 1) for v in base]
    df = indexed(spark, base + near)
    got = {tuple(r) for r in matching.close_vectors(df, df, 0.7).collect()}
    assert {(k, k + 60) for k in range(60)} <= got
    # the same by brute force: a part that differs in one bit at most and isn't empty, and the Dice
    every = base + near
    parts = lambda v: [(v >> (64 * k)) & (2**64 - 1) for k in range(matching.PARTS)]
    want = set()
    for i in range(len(every)):
        for j in range(i + 1, len(every)):
            x, y = parts(every[i]), parts(every[j])
            close = any((p or q) and ((p == q) or ((p ^ q).bit_count() == 1 and p and q)) for p, q in zip(x, y))
            if close and (every[i] ^ every[j]).bit_count() <= matching.RADIUS and 2 * (every[i] & every[j]).bit_count() >= 0.7 * (every[i].bit_count() + every[j].bit_count()):
                want.add((i, j))
    assert got == want
    left, right = df.where("vid < 60"), df.where("vid >= 60")
    assert {tuple(r) for r in matching.close_vectors(left, right, 0.7).collect()} == {(i, j) for i, j in want if i < 60 <= j}


def test_full_buckets_lose_no_pair(spark):
    checkpoint_dir(spark)
    rng = np.random.default_rng(4)
    shared = sum(1 << int(b) for b in rng.choice(64, size=20, replace=False))
    draw = lambda n: sum(1 << int(64 + b) for b in rng.choice(448, size=n, replace=False))
    far = [shared | draw(60) for _ in range(500)]
    twin = far[7] ^ sum(1 << (64 * k) for k in range(1, 8))
    df = indexed(spark, [*far, twin])
    for block in (40, 2000):
        assert (7, 500) in {tuple(r) for r in matching.close_vectors(df, df, 0.7, block).collect()}


def test_candidates_reach_noisy_titles(spark, works):
    """Share of made-up pairs with the noise of the sources that the index brings together, found by brute force over
    all pairs: 0.9 at least."""
    checkpoint_dir(spark)
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), size=rng.integers(3, 11))) for _ in range(400)]

    def noise(word):
        kind, at = rng.integers(4), int(rng.integers(len(word)))
        return {0: word[:at] + word[at + 1 :], 1: word[:at] + "q" + word[at:], 2: word[:at] + "q" + word[at + 1 :], 3: word[:at] + word[at : at + 2][::-1] + word[at + 2 :]}[int(kind)]

    titles = [list(rng.choice(vocabulary, size=rng.integers(4, 12))) for _ in range(250)]
    others = [[noise(w) if rng.random() < 0.12 else w for w in t] for t in titles]
    bits = lambda t: sum((x & (2**64 - 1)) << (64 * k) for k, x in enumerate(matching.pack_bits(matching.qgrams(t))))
    every = list(dict.fromkeys(map(bits, titles + others)))
    near = lambda i, j: (every[i] ^ every[j]).bit_count() <= matching.RADIUS
    want = {(i, j) for i in range(len(every)) for j in range(i + 1, len(every)) if near(i, j) and 2 * (every[i] & every[j]).bit_count() >= matching.LEAST_WHOLE * (every[i].bit_count() + every[j].bit_count())}
    df = indexed(spark, every)
    got = {tuple(r) for r in matching.close_vectors(df, df, matching.LEAST_WHOLE).collect()}
    assert got <= want and len(want) > 100 and len(got) >= 0.99 * len(want)
    place = {v: k for k, v in enumerate(every)}
    noisy = {tuple(sorted((place[bits(t)], place[bits(o)]))) for t, o in zip(titles, others) if bits(t) != bits(o)}
    assert len(noisy & got) >= 0.9 * len(noisy)


def test_one_title_of_many_works_is_not_all_pairs(spark):
    rows = lambda src: [(src * 1000 + i, src, "editorial notes", ["editorial", "notes"], [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}son"], 7, 300, matching.pack_bits(["x"]), None, None, None, None) for i in range(300)]
    spelt = spark.createDataFrame(rows(1) + rows(2), "pid long, src int, plain string, terms array<string>, names array<string>, vid long, title_ents long, vector array<long>, marks array<long>, doi string, arxiv string, pmid string")
    by_title, named = matching.candidate_pairs(spelt)
    assert {tuple(r) for r in by_title.collect()} == {(1000 + i, 2000 + i) for i in range(300)} and named.count() == 0


def test_fit_separates():
    rng = np.random.default_rng(0)
    x = rng.random((400, 2))
    w = matching.logistic_fit(x, (x[:, 0] > 0.5).astype(float))
    assert w[1] > 5 * abs(w[2])


def test_spellings_of_names(spark):
    same = [
        ["Constance J. C. Hale", "Hale CJC", "C. Hale", "Hale, Constance", "hale constance", "Connie Hale", "Contance Hale", "Prof. Constance J. C. Hale", "Hale, C.J.C."],
        ["Dmitri Møller-Strøm", "MØLLER-STRØM, Dmitri", "Dmitri Moeller-Stroem", "Møller-Strøm D"], ["The Fabek Study Group", "Fabek Study Grp.", "FABEK study group", "Study Group, Fabek"], ["Amara M. Rook"], ["Maria M. Rook"], ["Jon A. Vance"], ["Jon B. Vance"], ["J. Vance"],
    ]
    rows = [(n, 7) for group in same for n in group] + [(None, 1), (" ", 1), ("*", 1)]
    df = spark.createDataFrame([(i, [n]) for i, (n, _) in enumerate(rows)], "rec_id long, authors array<string>")
    oa_ = spark.createDataFrame([], RESULTS["openalex"])
    spelt = names.spellings(oa_, df, df.limit(0))
    got = {(r["name_lo"], r["name_hi"]) for r in names.name_pairs(names.link_names(spelt)).collect()}
    assert got == {tuple(sorted((a, b))) for g in same for i, a in enumerate(g) for b in g[i + 1 :]}


def classes_of(spark, spelt):
    df = spark.createDataFrame([(n,) for n in spelt], "name string")
    return {r["name"]: r for r in names.with_links(names.link_names(df)).collect()}


def test_names_that_differ_by_their_ending_stay_apart(spark):
    got = classes_of(spark, ["Maria Garcia", "Mario Garcia", "Daniel Chen", "Daniela Chen", "Katherine Wulf", "Kathorine Wulf", "Ann Lee"])
    person = {n: r["person"] for n, r in got.items()}
    assert person["Maria Garcia"] != person["Mario Garcia"] and person["Daniel Chen"] != person["Daniela Chen"]
    assert person["Katherine Wulf"] == person["Kathorine Wulf"] and got["Katherine Wulf"]["links"] == 1 and got["Ann Lee"]["links"] == 0
    assert all(0 < r["score"] <= 1 for r in got.values()) and got["Katherine Wulf"]["rule"] == "edit"


def test_rarity_scores_a_link(spark):
    many = [f"Maren {s}" for s in ("Abbott", "Bellamy", "Corwin", "Dunmore", "Easton")] + [f"Marek {s}" for s in ("Abbott", "Foster", "Gibson", "Harlow", "Irving")]
    slip = ["Marenn Corwin", "Lee Quill", "Quill L", "Zoe Smith", "Zoe Smithson", "Smith Z"]
    got = classes_of(spark, many + slip)
    assert got["Maren Abbott"]["person"] != got["Marek Abbott"]["person"]  # both are names that several people bear
    assert got["Marenn Corwin"]["person"] == got["Maren Corwin"]["person"]
    assert got["Quill L"]["person"] == got["Lee Quill"]["person"] and got["Quill L"]["rule"] == "initials"
    assert got["Maren Abbott"]["score"] < got["Lee Quill"]["score"]
    assert names.link_names(spark.createDataFrame([], "name string")).collect() == []


def test_large_groups_climb_the_guide_tree(spark):
    rng = np.random.default_rng(6)
    words = [f"w{j}" for j in range(20)]
    rows = [("g", [w for w in words if rng.random() < 0.9] + [f"x{i}"], float(1 + i % 3)) for i in range(100)] + [("h", ["a", "b"], 1.0), ("h", ["a", "b"], 1.0), ("n", ["q"], 0.0)]
    df = spark.createDataFrame(rows, "group_key string, tokens array<string>, weight double")
    want = survivor.guide_tree([(t, w) for g, t, w in rows if g == "g"], 8)
    for partitions in (1, 7):
        got = {r["group_key"]: r["consensus"] for r in survivor.group_consensus(df.repartition(partitions), 8).collect()}
        assert got == {"g": want, "h": ["a", "b"]}
    assert [t for t in want if t.startswith("w")] == words


def test_long_texts_unlike_at_both_ends_agree():
    middle = [f"w{k}" for k in range(2058)]
    one, other = [f"a{k}" for k in range(21)] + middle + ["z"] * 21, [f"b{k}" for k in range(21)] + middle + ["y"] * 21
    assert survivor.agreement(one, other) == 2058 / 2100
    assert survivor.agreement(one, survivor.guide_tree([(one, 1.0), (other, 1.0)])) > 0.97


def test_consensus_votes_and_cut_values():
    full = "a b c d e f g".split()
    assert survivor.consensus_tokens([(full, 1.0), (full[:4], 1.0), ("a b x d e f g".split(), 0.5)]) == full
    assert survivor.agreement(full[:4], full) == 1.0 and survivor.agreement(["q"], full) == 0.0 and survivor.agreement([], full) == 0.0


def test_every_pair_that_meets_the_threshold_is_linked(spark):
    """Names that overlap without a common start, and an excerpt of an abstract that shares neither its start nor its
    least shingles."""
    said = [f"word{k * 7919 % 997}" for k in range(90)]
    abstract = " ".join(said)
    marks = lambda text: set(spark.range(1).select(matching.shingle_vector(matching.F.lit(text))["marks"]).first()[0])
    excerpt = next(x for x in (" ".join(said[k : k + 12]) for k in range(5, 75)) if not marks(x) & marks(abstract))
    openalex = spark.createDataFrame([oa(1, 10, TITLES[0], ["Bujjidonquist", "Jonathan"], 2020), (*oa(2, 11, TITLES[1], ["Cy Moss"], 2019)[:7], abstract, 1, None, T(2024, 1, 1), "clash")], RESULTS["openalex"])
    arxiv = spark.createDataFrame([(101, "http://arxiv.example/abs/2001.00001v1", TITLES[0] + ".", ["Bujidonquist", "Jon"], None, "2020-01-01", None, None)], RESULTS["arxiv"])
    web = spark.createDataFrame([(301, TITLES[1], ["Study Group"], 2019, excerpt, "https://shelf.example/1"), (302, TITLES[1], ["Other Writers"], 2019, None, "https://shelf.example/2")], RESULTS["web"])
    rows, _, classes = matching.match_works(openalex, arxiv, spark.createDataFrame([], RESULTS["pubmed"]), web)
    assert {(r["rec_lo"], r["rec_hi"]) for r in matching.work_pairs(rows, classes).collect()} == {(1, 101), (2, 301)}


def test_profiles_read_the_records_once(works):
    """Counting the entities of a title is no second pass over the records."""
    read = lambda df: len([x for x in df._jdf.queryExecution().analyzed().toString().split("\n") if "LogicalRDD" in x or "LocalRelation" in x])
    rows, spelt = matching.profiles(*works)
    assert 0 < read(spelt) <= read(rows)


def test_a_title_is_its_works_own_in_each_source(spark):
    """What stands for missing authors: a title of one entity of each source, of five words in the earlier source."""
    vid = iter(range(100, 200))
    of = lambda pid, src, n, v, others=None: (pid, pid, src, v, "x", [f"w{k}" for k in range(n)], 0, 2020, 2020, others, None, None, matching.pack_bits(["a", "b"]), matching.pack_bits([]), matching.pack_bits([]))
    v = [next(vid) for _ in range(4)]
    rows = [of(1, 1, 5, v[1]), of(2, 2, 4, v[0]), of(3, 1, 5, v[2]), of(4, 1, 5, v[2]), of(5, 2, 5, v[3])]
    spelt = spark.createDataFrame(rows, "pid long, ent long, src int, vid long, plain string, terms array<string>, n_names int, year_from int, year_to int, doi string, arxiv string, pmid string, vector array<long>, name_vector array<long>, said array<long>")
    links = spark.createDataFrame([(v[0], v[1]), (v[2], v[3])], "vid_a long, vid_b long")
    got = {(r["pid_a"], r["pid_b"]): r["title_is_own"] for r in matching.scored_pairs(spelt, links).collect()}
    assert got == {(1, 2): True, (3, 5): False, (4, 5): False}
