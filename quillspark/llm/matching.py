"""Matching entities across sources without keys.

Attributes become fixed bit vectors of their q-grams. Multi-index hashing finds close vectors: a vector is
cut into parts, and vectors that differ in fewer than twice as many bits as there are parts differ in one bit at
most in one of them. Equal vectors are one in the index. Candidates get Dice scores by field, and a logistic model
turns the weighted scores into calibrated confidences.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import clean_text, spell_greek, words
from quillspark.operators.graph import connected_components
from quillspark.session import cut

#: Words of 64 bits in a vector, each one part of the index.
PARTS = 8
#: Vectors are close if they differ in this many bits at most: of 8 parts one then differs in one bit at most.
RADIUS = 2 * PARTS - 1
WORDS = regex.compile(r"\w+")
#: Labelled pairs that the confidence model is fitted on, at most, chosen by hash.
FIT_SAMPLE = 20_000
#: Rows of a bucket that one task compares with the bucket's others; a larger bucket is cut into blocks.
BLOCK = 2_000
#: Least Dice of two whole titles, and of a part of a title and a whole one.
LEAST_WHOLE, LEAST_PART = 0.7, 0.85
#: Pairs are works from this confidence on.
LEAST_CONFIDENCE = 0.5

#: Least shingle hashes of an abstract that stand for it.
MARKS = 6

#: Words that make a work of its own out of another's title.
MARKERS = ("erratum corrigendum correction addendum retraction reply response comment commentary discussion rejoinder revisited continued continuation sequel followup follow part ii iii iv v vi supplement supplementary appendix").split()


def pack_bits(grams: Iterable[str], parts: int = PARTS) -> list[int]:
    """`parts` signed words of 64 bits: each gram sets one bit."""
    bits = 0
    for g in grams:
        bits |= 1 << (xxhash.xxh64_intdigest(g) % (parts * 64))
    return [x - (1 << 64) if x >> 63 else x for x in ((bits >> (64 * k)) & (2**64 - 1) for k in range(parts))]


def qgrams(terms: Iterable[str], q: int = 2) -> set[str]:
    """q-grams of padded words; a set of words gives the same q-grams in any order."""
    return {w[i : i + q] for w in (f"_{t}_" for t in terms) for i in range(len(w) - q + 1)}


def bit_vector(terms: Column) -> Column:
    """array<long> of PARTS words for an array of words.

    An Arrow function, for it is evaluated once: as an SQL expression of array functions, each of a vector's
    many uses would compute it again.
    """

    @F.pandas_udf("array<bigint>")
    def vector(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: pack_bits(qgrams(() if x is None else x)))

    return vector(terms)


def shingle_vector(text: Column, width: int = 5) -> Column:
    """struct<bits, n, marks>: the bits of the shingles of `width` words of a whole text, how many there are, and the
    hashes of its least and first ones."""

    @F.pandas_udf("bits array<bigint>, n int, marks array<bigint>")
    def vector(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            said = WORDS.findall(text.lower()) if text else []
            grams = [" ".join(said[i : i + width]) for i in range(len(said) - width + 1)]
            hashes = sorted({xxhash.xxh64_intdigest(g) >> 1 for g in grams})
            first = [xxhash.xxh64_intdigest(g) >> 1 for g in grams[:2]]
            rows.append((pack_bits(set(grams)), len(hashes), sorted({*hashes[:MARKS], *first})))
        return pd.DataFrame(rows, columns=["bits", "n", "marks"])

    return vector(text)


def ones(vector: Column, parts: int = PARTS) -> Column:
    return functools.reduce(lambda a, b: a + b, [F.bit_count(F.get(vector, F.lit(i))) for i in range(parts)])


def common_ones(a: Column, b: Column, parts: int = PARTS) -> Column:
    return functools.reduce(lambda x, y: x + y, [F.bit_count(F.get(a, F.lit(i)).bitwiseAND(F.get(b, F.lit(i)))) for i in range(parts)])


def dice(a: Column, b: Column, na: Column, nb: Column, parts: int = PARTS) -> Column:
    return F.when(na + nb > 0, 2 * common_ones(a, b, parts) / (na + nb)).otherwise(0.0)


def overlap(a: Column, b: Column, na: Column, nb: Column, parts: int = PARTS) -> Column:
    least = F.least(na, nb)
    return F.when(least > 0, common_ones(a, b, parts) / least).otherwise(0.0)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys_of_vectors(words: np.ndarray, cleared: bool) -> tuple[np.ndarray, np.ndarray]:
    """(keys, number of keys of each row) of vectors, one row each: the key of every part that has bits, and, if
    cleared, of every part without each of its bits in turn where a bit is left; the lowest bit of a key tells a whole
    part from one without a bit."""
    rows, parts = words.shape
    salt = mixed(np.arange(1, parts + 1, dtype=np.uint64))[None, :]
    r, p = np.nonzero(words)
    at, value, own = [r], [mixed(words[r, p] + salt[0, p])], [np.ones(len(r), bool)]
    if cleared:
        flags = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(rows, parts, 8), axis=2, bitorder="little")
        r, p, bit = np.nonzero(flags)
        left = words[r, p] ^ (np.uint64(1) << bit.astype(np.uint64))
        kept = left != 0
        at.append(r[kept]), value.append(mixed(left[kept] + salt[0, p[kept]])), own.append(np.zeros(kept.sum(), bool))
    row, keys = np.concatenate(at), (np.concatenate(value) & ~np.uint64(1)) | np.concatenate(own).astype(np.uint64)
    order = np.argsort(row, kind="stable")
    return keys[order].view(np.int64), np.bincount(row, minlength=rows)


def part_keys(vector: Column, cleared: bool, parts: int = PARTS) -> Column:
    """array<long> of keys_of_vectors of a column of vectors, a batch at a time."""

    def keys(vectors: pa.Array) -> pa.Array:
        words = np.asarray(vectors.flatten()).astype(np.int64).view(np.uint64).reshape(len(vectors), parts)
        found, sizes = keys_of_vectors(words, cleared) if len(vectors) else (np.empty(0, np.int64), np.empty(0, np.int64))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(found, pa.int64()))

    keys.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(keys, "array<bigint>").asNondeterministic()(vector)


def bits_apart(a: Column, b: Column, parts: int = PARTS) -> Column:
    """The Hamming distance of two vectors."""
    return functools.reduce(lambda x, y: x + y, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(parts)])


def met_vectors(every: DataFrame, wanted: Callable[[Column, Column], Column], block: int = BLOCK) -> DataFrame:
    """vid_a < vid_b, kind_a, kind_b, dice of every two vectors (vid, vector, n for the number of its bits, kind below 4)
    that differ in at most RADIUS bits and whose kinds are wanted.

    Exact by multi-index hashing: of the parts of two such vectors one differs in one bit at most, by the pigeonhole
    principle, so the one's part meets the other's or the other's without a bit. Parts without a bit have no key, so
    where z parts are empty in both, 2 * (PARTS - z) - 1 bits are certain. Which pairs are found depends on the two
    vectors alone. The shuffle holds three numbers a key: the vector's, the vector folded to 64 bits, and the key with
    the kind and whether it is whole in its last three bits. Folding never adds distance, so pairs that it sets further
    apart than RADIUS never leave the join, and vectors are fetched for the others. A bucket with more than `block`
    whole parts is cut into blocks, each of which meets all of the other side, so it is spread and nothing in it is left
    out; there is at most one such bucket for `block` whole parts, so they are broadcast.
    """
    bits = lambda c, n: F.col(c).bitwiseAND(F.lit(n))

    def keyed(cleared: bool) -> DataFrame:
        fold = functools.reduce(lambda x, y: x.bitwiseXOR(y), [F.get("vector", F.lit(i)) for i in range(PARTS)])
        rows = every.select("vid", "kind", fold.alias("f"), F.explode(part_keys(F.col("vector"), cleared)).alias("k"))
        return rows.select("vid", "f", bits("k", -8).bitwiseOR(F.shiftleft(F.col("kind").cast("long"), 1)).bitwiseOR(bits("k", 1)).alias("k"))

    own = keyed(False)
    large = F.broadcast(own.groupBy(bits("k", -8).alias("key")).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > block).select("key", F.ceil(F.col("_m") / block).cast("long").alias("_blocks")))
    # the block is added to the key; should that be another's key, the vectors tell
    placed = lambda df, blocks: df.join(large, bits("k", -8) == F.col("key"), "left").select("vid", "f", F.when(F.col("_blocks").isNull(), F.array("k")).otherwise(F.transform(blocks, lambda j: F.col("k") + j * 8)).alias("_ks")).select("vid", "f", F.explode("_ks").alias("k"))
    o = placed(own, F.array(F.pmod(F.xxhash64("vid"), F.col("_blocks")))).alias("o")
    e = placed(keyed(True), F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("e")
    kind = lambda x: F.shiftright(bits(f"{x}.k", 6), 1).cast("int")
    # of two whole parts that meet, both ways would tell the same
    once = (bits("e.k", 1) == 0) | (F.col("o.vid") < F.col("e.vid"))
    near = F.bit_count(F.col("o.f").bitwiseXOR(F.col("e.f"))) <= RADIUS
    found = e.join(o, (bits("o.k", -8) == bits("e.k", -8)) & (F.col("o.vid") != F.col("e.vid")) & near & once & wanted(kind("o"), kind("e")))
    found = found.select(F.least("o.vid", "e.vid").alias("vid_a"), F.greatest("o.vid", "e.vid").alias("vid_b")).distinct()
    of = lambda x: every.select(*(F.col(c).alias(f"{c}_{x}") for c in ("vid", "vector", "n", "kind")))
    va, vb = F.col("vector_a"), F.col("vector_b")
    return found.join(of("a"), "vid_a").join(of("b"), "vid_b").where(bits_apart(va, vb) <= RADIUS).select("vid_a", "vid_b", "kind_a", "kind_b", dice(va, vb, F.col("n_a"), F.col("n_b")).alias("dice"))


def close_vectors(left: DataFrame, right: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Distinct (vid_a, vid_b) of different vectors of left and right that met_vectors finds and whose Dice is at least
    `least`. If right is left, each pair comes once."""
    if right is left:
        return met_vectors(left.withColumn("kind", F.lit(1)), lambda a, b: F.lit(True), block).where(F.col("dice") >= least).select("vid_a", "vid_b")
    every = left.withColumn("kind", F.lit(1)).unionByName(right.withColumn("kind", F.lit(2))).groupBy("vid").agg(F.first("vector").alias("vector"), F.first("n").alias("n"), F.bit_or("kind").alias("kind"))
    found = met_vectors(every, lambda a, b: a.bitwiseOR(b) == 3, block).where(F.col("dice") >= least)
    return sided(found).where((F.col("kind_a").bitwiseAND(F.lit(1)) != 0) & (F.col("kind_b").bitwiseAND(F.lit(2)) != 0)).select("vid_a", "vid_b")


def sided(found: DataFrame) -> DataFrame:
    """Pairs of met_vectors both ways."""
    return found.select("vid_a", "vid_b", "kind_a", "kind_b", "dice").union(found.select("vid_b", "vid_a", "kind_b", "kind_a", "dice"))


def profiles(openalex: DataFrame, arxiv: DataFrame, pubmed: DataFrame, web: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, profiles): rows maps rec_id to its source's own entity; profiles are the distinct spellings of
    every entity's attributes."""
    no = F.lit(None).cast("string")

    def of(df: DataFrame, src: int, own: Column, authors: Column, year: Column, doi: Column, arxiv_id: Column, pmid: Column, abstract: Column) -> DataFrame:
        return df.select(
            F.lit(src).alias("src"), "rec_id", F.coalesce(own, F.concat(F.lit("row:"), F.col("rec_id").cast("string"))).alias("own"), "title", authors.alias("authors"), year.alias("year"),
            doi.alias("doi"), arxiv_id.alias("arxiv"), pmid.alias("pmid"), abstract.alias("abstract"),
        )

    found = lambda x, p: F.when(F.regexp_extract(x, p, 1) != "", F.regexp_extract(x, p, 1))
    number = lambda x: found(x, r"([0-9]{4}\.[0-9]{4,5})")
    bare_doi = lambda x: found(F.lower(x), r"(10\.[0-9]{4,9}/[^\s]*[a-z0-9])")
    digits = lambda x: found(x, r"([0-9]{5,12})")
    year = lambda x: found(x, r"((?:19|20)[0-9]{2})").cast("int")
    positions = F.flatten(F.transform(F.map_entries("abstract_inverted_index"), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    indexed = F.array_join(F.transform(F.array_sort(positions), lambda x: x["w"]), " ")
    rows = functools.reduce(
        DataFrame.unionByName,
        [
            of(openalex, 1, F.upper(found(F.col("id"), r"(?i)(w[0-9]+)")), F.transform("authorships", lambda x: x["author"]["display_name"]), F.col("publication_year"), F.coalesce(bare_doi(F.col("doi")), bare_doi(F.col("ids.doi"))), number(F.col("ids.arxiv")), digits(F.col("ids.pmid")), F.coalesce(F.col("abstract"), indexed)),
            of(arxiv, 2, number(F.col("id")), F.col("authors"), year(F.col("published")), no, number(F.col("id")), no, F.col("summary")),
            of(pubmed, 3, F.coalesce(digits(F.col("uid")), digits(F.col("pmid"))), F.col("authors"), year(F.col("pubdate")), bare_doi(F.col("doi")), no, F.coalesce(digits(F.col("pmid")), digits(F.col("uid"))), F.col("abstract")),
            of(web, 4, F.lower(F.trim("url")), F.col("authors"), F.col("year"), no, no, no, F.col("snippet")),
        ],
    )
    rows = rows.withColumn("ent", F.xxhash64("src", "own"))
    # a site's name after the title: what follows a bar, and endings that at least 1 in 500 titles share, so
    # there are 500 of these at most
    tail = F.regexp_extract("title", r"( (?:[|·–—-]) [^|·–—-]{3,40})\s*$", 1)
    endings = rows.groupBy(tail.alias("_tail")).agg(F.count(F.lit(1)).alias("_n"))
    share = rows.agg(F.greatest(F.lit(20), F.count(F.lit(1)) / 500).alias("n"))
    sites = endings.where((F.col("_tail") != "") & (F.col("_n") >= share.scalar())).select("_tail", F.lit(True).alias("_site"))
    rows = rows.withColumn("_tail", tail).join(F.broadcast(sites), "_tail", "left")
    title = F.when(F.col("_site"), F.expr("left(rtrim(title), length(rtrim(title)) - length(_tail))")).otherwise(F.col("title"))
    plain = spell_greek(F.regexp_replace(F.lower(clean_text(title)), r"</?[a-z]+>", ""))
    plain = F.regexp_replace(F.replace(plain, F.lit("&"), F.lit(" and ")), r" [|] [^|]{3,40}$| \(pdf\)$", "")
    terms = F.array_sort(F.array_distinct(words(plain)))
    names = F.flatten(F.transform(F.filter("authors", lambda a: a.isNotNull()), lambda a: words(F.regexp_replace(a, r"(?i)\b(?:prof|dr|phd|et al|by)\b\.?", " "))))
    names = F.coalesce(F.array_sort(F.array_distinct(F.filter(names, lambda w: F.length(w) > 2))), F.array().cast("array<string>"))
    prepared = rows.select("src", "ent", plain.alias("plain"), terms.alias("terms"), names.alias("names"), "year", "doi", "arxiv", "pmid", shingle_vector(F.col("abstract")).alias("said"))
    spelt = prepared.groupBy("src", "ent", "plain", "terms").agg(
        F.max_by("names", F.size("names")).alias("names"), F.min("year").alias("year_from"), F.max("year").alias("year_to"), *(F.max(x).alias(x) for x in ("doi", "arxiv", "pmid")), F.max_by("said.bits", "said.n").alias("said")
    )
    spelt = spelt.withColumn("pid", F.xxhash64("ent", "plain")).withColumn("vid", F.xxhash64("terms")).withColumn("n_names", F.size("names")).withColumn("vector", bit_vector(F.col("terms"))).withColumn("name_vector", bit_vector(F.col("names"))).drop("names")
    return rows.select("rec_id", "src", "ent"), spelt


def title_parts(plain: Column) -> Column:
    """The parts of a title at its separators, each long enough to say something."""
    pieces = F.split(plain, r": | - | – |\? |[()]|\.\.\.|…")
    return F.filter(F.transform(pieces, lambda x: F.trim(x)), lambda x: F.length(x) >= 12)


@functools.lru_cache(maxsize=200_000)
def _close(a: str, b: str) -> bool:
    """Whether two words are one with typing errors, of which either may have its own: at most one edit (an
    exchange of neighbours is one) in words of four letters and more, two from six on, three from nine on."""
    if a == b:
        return True
    n, m = len(a), len(b)
    most = 3 if min(n, m) >= 9 else 2 if min(n, m) >= 6 else 1
    if min(n, m) < 4 or abs(n - m) > most:
        return False
    older, row = None, list(range(m + 1))
    for i in range(1, n + 1):
        last, row = row, [i] + [0] * m
        for j in range(1, m + 1):
            cost = a[i - 1] != b[j - 1]
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + cost)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                row[j] = min(row[j], older[j - 2] + 1)
        older = last
    return row[m] <= most


def unmatched(a: Iterable[str], b: Iterable[str]) -> tuple[int, int, bool]:
    """Letters of the words of each side that have no partner on the other, and whether one is a marker."""
    left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    for w in list(left):
        for v in right:
            if _close(w, v):
                left.remove(w)
                right.remove(v)
                break
    marker = any(w in MARKERS or w.isdigit() for w in (*left, *right))
    # a cut-off word
    for one, other in ((left, right), (right, left)):
        for w in list(one):
            if starts := [v for v in other if len(w) >= 3 and v.startswith(w)]:
                one.remove(w)
                other.remove(starts[0])
    return sum(map(len, left)), sum(map(len, right)), marker


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic model with intercept first, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence(spelt: DataFrame) -> DataFrame:
    """pid, src, vid, ev: what a profile has beside its title by which another profile of a like title may be the same
    work: the start of each of its authors' names, each of some shingles of its abstract, or, without authors, that no other entity
    of its source has the title. Not every pair that one_work accepts has one of these in common (names can overlap
    without a common start), so match_works does without; candidate_pairs tells what has."""
    alone = (F.size("names") == 0) & (F.col("title_ents") == 1)
    marks = F.concat(
        F.transform("names", lambda w: F.xxhash64(F.lit("name"), F.substring(w, 1, 4))), F.transform(F.coalesce("marks", F.array().cast("array<bigint>")), lambda w: F.xxhash64(F.lit("said"), w)),
        F.when(alone, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<bigint>")), F.when((F.size("names") > 0) & (F.col("title_ents") == 1), F.array(F.lit(1).cast("long"))).otherwise(F.array().cast("array<bigint>")),
    )
    return spelt.select("pid", "src", "vid", F.explode(F.array_distinct(marks)).alias("ev"))


def paired(links: DataFrame, evidence: DataFrame) -> DataFrame:
    """Distinct (pid_a, pid_b), of different sources and the lower source first, of the profiles of linked titles
    (vid_a, vid_b, both ways) that share evidence. A title that very many works have is met by title and evidence
    together, so its works are not paired with each other for the title alone. Titles that only one entity of each
    source has (evidence 0 and 1) meet if either has no authors."""
    a, b = evidence.alias("a"), evidence.alias("b")
    beside = F.when(F.col("ev").isin(0, 1), F.lit(-1)).otherwise(F.col("ev"))
    ahead = links.join(evidence.withColumn("_e", beside), F.col("vid_a") == F.col("vid")).select("vid_b", "_e", F.col("pid").alias("pid_a"), F.col("src").alias("src_a"), F.col("ev").alias("ev_a")).alias("x")
    there = evidence.withColumn("_e", beside).alias("y")
    lone = (F.col("x._e") != -1) | (F.col("x.ev_a") == 0) | (F.col("y.ev") == 0)
    return ahead.join(there, (F.col("x.vid_b") == F.col("y.vid")) & (F.col("x._e") == F.col("y._e")) & (F.col("x.src_a") < F.col("y.src")) & lone).select("pid_a", F.col("y.pid").alias("pid_b")).distinct()


def title_links(spelt: DataFrame) -> DataFrame:
    """Distinct vid_a <= vid_b of close titles: equal, or close whole with whole or part with whole. Titles and parts
    are one index."""
    parts_of = title_parts(F.col("plain"))
    pieces = spelt.where(F.size(parts_of) > 1).select(F.col("vid").alias("whole"), F.explode(parts_of).alias("_piece")).select("whole", F.array_sort(F.array_distinct(words(F.col("_piece")))).alias("_t")).distinct()
    pieces = cut(pieces.withColumn("vector", bit_vector(F.col("_t"))).select("whole", F.xxhash64("_t").alias("vid"), "vector"))
    both = spelt.select("vid", "vector", F.lit(1).alias("kind")).union(pieces.select("vid", "vector", F.lit(2).alias("kind")))
    every = cut(both.groupBy("vid").agg(F.first("vector").alias("vector"), F.bit_or("kind").alias("kind")).withColumn("n", ones(F.col("vector"))))
    has = lambda x, k: F.col(f"kind_{x}").bitwiseAND(F.lit(k)) != 0
    found = cut(met_vectors(every, lambda a, b: a.bitwiseOR(b).bitwiseAND(F.lit(1)) == 1))
    close = found.where(has("a", 1) & has("b", 1) & (F.col("dice") >= LEAST_WHOLE)).select("vid_a", "vid_b")
    of_parts = sided(found).where(has("a", 1) & has("b", 2) & (F.col("dice") >= LEAST_PART)).select("vid_a", "vid_b").union(every.where("kind = 3").select("vid", "vid"))
    through = of_parts.join(pieces.select("whole", "vid"), F.col("vid_b") == F.col("vid")).select("vid_a", F.col("whole").alias("vid_b"))
    own = every.where(F.col("kind").bitwiseAND(F.lit(1)) != 0).select("vid", "vid")
    return close.union(through).union(own).toDF("vid_a", "vid_b").select(F.least("vid_a", "vid_b").alias("vid_a"), F.greatest("vid_a", "vid_b").alias("vid_b")).distinct()


def candidate_pairs(spelt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by titles, by identifiers), each distinct (pid_a, pid_b) of profiles of different sources: profiles of close
    titles that share evidence, and profiles that share an identifier and half of a title's bits. scored_pairs judges
    all profiles of close titles."""
    links = title_links(spelt)
    links = cut(links.union(links.where("vid_a != vid_b").select("vid_b", "vid_a")))
    by_title = paired(links, evidence(spelt))
    ids = spelt.select("pid", "src", "vector", F.explode(F.array(*(F.concat(F.lit(x + ":"), F.col(x)) for x in IDS))).alias("id")).where(F.col("id").isNotNull())
    ids = ids.withColumn("n", ones(F.col("vector")))
    c, d = ids.alias("c"), ids.alias("d")
    alike = overlap(F.col("c.vector"), F.col("d.vector"), F.col("c.n"), F.col("d.n")) >= 0.5
    named = c.join(d, (F.col("c.id") == F.col("d.id")) & (F.col("c.src") < F.col("d.src")) & alike).select(F.col("c.pid").alias("pid_a"), F.col("d.pid").alias("pid_b"))
    return by_title, named.distinct()


IDS = ["doi", "arxiv", "pmid"]
#: src of the open index, arXiv, PubMed and the web.
SOURCES = (1, 2, 3, 4)
FEATURES = ["title_dice", "title_overlap", "names_overlap", "names_missing", "year_agrees", "year_missing", "said_overlap", "said_missing"]
#: Least overlap of names, of abstracts that vouch for a pair, and of titles that share an identifier.
LEAST_NAMES, LEAST_SAID, LEAST_ALIKE = 0.5, 0.7, 0.5


def scored_pairs(spelt: DataFrame, links: DataFrame) -> DataFrame:
    """Field scores and what identifiers say of each pair of profiles of different sources whose titles are linked, or
    that share an identifier and half of a title's bits, as far as one_work can accept it (see its `people` and
    `vouched`).

    What is compared travels with a profile and is judged where two meet, so that only scores leave the joins: not even
    a title of very many works gives more rows than pairs that may be works. Each pair comes once: by its first
    identifier, else by its titles. Both sides of a join have the same columns, so that one shuffle serves both.
    """
    cols = ["pid", "ent", "src", "vid", "n_terms", "n_names", "year_from", "year_to", *IDS, "vector", "n", "name_vector", "name_n", "said", "said_n", "title_ents"]
    rows = spelt.select("*", F.size("terms").alias("n_terms"), ones(F.col("vector")).alias("n"), ones(F.col("name_vector")).alias("name_n"), ones(F.col("said")).alias("said_n"))
    # the entities of each source that have a title
    ents = spelt.select("vid", "src", "ent").distinct().groupBy("vid").agg(*(F.count(F.when(F.col("src") == k, 1)).alias(f"_ents_{k}") for k in SOURCES))
    rows = rows.join(ents, "vid").withColumn("title_ents", F.element_at(F.array(*(f"_ents_{k}" for k in SOURCES)), F.col("src"))).select(cols)
    side = lambda df, x: df.select(*(F.col(c).alias(f"{c}_{x}") for c in df.columns))
    a, b = (lambda f: F.col(f"{f}_a")), (lambda f: F.col(f"{f}_b"))
    of = lambda score, vector, n: score(a(vector), b(vector), a(n), b(n))
    said_of_both = (a("said_n") > 4) & (b("said_n") > 4)
    said_overlap = F.when(said_of_both, of(overlap, "said", "said_n")).otherwise(0.0)
    nameless = (a("n_names") == 0) | (b("n_names") == 0)
    same = [F.coalesce(a(x) == b(x), F.lit(False)) for x in IDS]
    differ = [F.coalesce(a(x) != b(x), F.lit(False)) for x in IDS]
    any_of = lambda found: functools.reduce(lambda x, y: x | y, found)
    alike = of(overlap, "vector", "n") >= LEAST_ALIKE
    may = nameless | (of(overlap, "name_vector", "name_n") >= LEAST_NAMES) | (said_overlap >= LEAST_SAID)
    by_title = ((a("src") < b("src")) | ((a("src") > b("src")) & (a("vid") != b("vid")))) & F.when(any_of(same), ~alike).otherwise(may)
    titled = links.join(side(rows, "a"), "vid_a").join(side(rows, "b"), "vid_b").where(by_title)
    of_id = rows.withColumn("id", F.explode(F.array(*(F.when(F.col(x).isNotNull(), F.struct(F.lit(k).alias("k"), F.col(x).alias("v"))) for k, x in enumerate(IDS))))).where(F.col("id").isNotNull())
    of_id = of_id.select("*", F.col("id.k").alias("id_k"), F.col("id.v").alias("id_v")).drop("id")
    first = functools.reduce(lambda x, k: F.when(same[k], F.lit(k)).otherwise(x), reversed(range(len(IDS))), F.lit(-1))
    named = side(of_id, "a").join(side(of_id, "b"), (a("id_k") == b("id_k")) & (a("id_v") == b("id_v")) & (a("src") < b("src")) & alike & (first == a("id_k")))
    gap = F.greatest(a("year_from") - b("year_to"), b("year_from") - a("year_to"), F.lit(0))
    ahead = lambda f, x, y: F.when(a("src") < b("src"), x(f)).otherwise(y(f))
    scores = [
        *(ahead(f, a, b).alias(f"{f}_a") for f in ("pid", "ent")), *(ahead(f, b, a).alias(f"{f}_b") for f in ("pid", "ent")),
        of(dice, "vector", "n").alias("title_dice"), of(overlap, "vector", "n").alias("title_overlap"), of(overlap, "name_vector", "name_n").alias("names_overlap"),
        nameless.cast("double").alias("names_missing"), F.coalesce((gap <= 1).cast("double"), F.lit(0.0)).alias("year_agrees"), gap.isNull().cast("double").alias("year_missing"),
        said_overlap.alias("said_overlap"), F.coalesce(~said_of_both, F.lit(True)).cast("double").alias("said_missing"),
        functools.reduce(lambda x, y: x + y, [x.cast("int") for x in same]).alias("ids_same"), functools.reduce(lambda x, y: x + y, [x.cast("int") for x in differ]).alias("ids_differ"),
        ((a("title_ents") == 1) & (b("title_ents") == 1) & (ahead("n_terms", a, b) >= 5)).alias("title_is_own"),
    ]
    return titled.select(scores).union(named.select(scores))


def calibrated(scores: DataFrame) -> DataFrame:
    """scores with `confidence`, by a logistic model of the field scores.

    It is fitted on scored pairs that identifiers label: one in common makes a match, only differing ones none; at
    most FIT_SAMPLE of them, chosen by hash. Without both labels, fixed weights stand in. Identifiers, which
    are wrong at times, then shift the odds by a bounded amount.
    """
    labelled = scores.where(F.col("ids_same") + F.col("ids_differ") > 0).select(*FEATURES, (F.col("ids_same") > 0).cast("int").alias("y"), F.xxhash64("pid_a", "pid_b").alias("h"))
    sample = labelled.orderBy("h").limit(FIT_SAMPLE).toPandas()
    if sample["y"].nunique() == 2 and len(sample) >= 50:
        weights = logistic_fit(sample[FEATURES].to_numpy(float), sample["y"].to_numpy(float))
    else:
        weights = np.array([-14.0, 10.0, 5.0, 4.0, 2.0, 1.0, 0.5, 4.0, 2.0])
    odds = functools.reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(f) for w, f in zip(weights[1:], FEATURES)], F.lit(float(weights[0])))
    odds = odds + F.when(F.col("ids_same") > 0, 3.0).when(F.col("ids_differ") > 0, -3.0).otherwise(0.0)
    # without authors on one side, a long title that no other work of either source has stands for them
    odds = odds + F.when((F.col("names_missing") == 1.0) & F.col("title_is_own") & (F.col("title_dice") >= 0.93), 1.5).otherwise(0.0)
    return scores.withColumn("confidence", F.round(1 / (1 + F.exp(-odds)), 4))


CHECK = "left int, right int, marker boolean"


def with_check(pairs: DataFrame, spelt: DataFrame) -> DataFrame:
    """pairs with `check`: what unmatched finds in the words of their titles."""

    @F.pandas_udf(CHECK)
    def check(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([unmatched(x, y) for x, y in zip(a, b)], columns=["left", "right", "marker"])

    terms = lambda x: spelt.select(F.col("pid").alias(f"pid_{x}"), F.col("terms").alias(f"terms_{x}"))
    return pairs.join(terms("a"), "pid_a").join(terms("b"), "pid_b").withColumn("check", check("terms_a", "terms_b")).drop("terms_a", "terms_b")


def one_work() -> Column:
    """The exact check after the confidence: no marker of another work; what one title adds, the other must
    not replace by other words, unless an identifier or the abstract says so."""
    a, b = F.col("check.left"), F.col("check.right")
    replaced = F.least(a, b) > 3
    vouched = (F.col("said_overlap") >= LEAST_SAID) | (F.col("ids_same") > 0)
    people = (F.col("names_overlap") >= LEAST_NAMES) | (F.col("names_missing") == 1.0)
    added = (F.greatest(a, b) > 3) & (F.least(a, b) <= 3)
    return ~F.col("check.marker") & (~replaced) & (~added | (vouched | (F.col("names_overlap") >= 0.6))) & (people | vouched)


def match_works(openalex: DataFrame, arxiv: DataFrame, pubmed: DataFrame, web: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, links, classes): rows maps rec_id to ent, links are pairs of entities with their confidence,
    classes give each linked entity its work.

    Rows of one source with its own identifier are one entity however often they were retrieved. Null and
    empty attributes score as missing; a row without title, authors and identifiers matches nothing. Extra
    columns are ignored.
    """
    rows, spelt = profiles(openalex, arxiv, pubmed, web)
    spelt = cut(spelt.where(F.size("terms") > 0))
    scores = cut(scored_pairs(spelt, title_links(spelt)))
    likely = calibrated(scores).where(F.col("confidence") >= LEAST_CONFIDENCE)
    judged = with_check(likely, spelt).where(one_work())
    links = cut(judged.groupBy("ent_a", "ent_b").agg(F.max("confidence").alias("confidence")))
    return rows, links, connected_components(links, "ent_a", "ent_b")


def work_pairs(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """rec_lo, rec_hi of the rows of different tables in one class."""
    member = rows.join(classes.select(F.col("node").alias("ent"), "component"), "ent").select("component", "src", "rec_id")
    a, b = member.alias("a"), member.alias("b")
    return a.join(b, (F.col("a.component") == F.col("b.component")) & (F.col("a.src") < F.col("b.src"))).select(F.least("a.rec_id", "b.rec_id").alias("rec_lo"), F.greatest("a.rec_id", "b.rec_id").alias("rec_hi"))
