"""Best representative of each duplicate group by token-level consensus.

The values of a group are aligned progressively, the most trusted first; every column votes for a token with
the weights of the values that have it; the value closest to the consensus is the one to keep.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import clean_text
from quillspark.operators.tabular import rank_in_group
from quillspark.session import cut

#: Values that a node of the guide tree joins; a leaf is a value, heaviest first.
FAN = 32
#: The vote of an address that doesn't have the form of the paper's own PDF, beside 1.
OTHER_WEIGHT = 0.25
#: A count with more binary digits (of its successor) is odd if at least this share of the works with a count of as
#: many digits has it.
SMALL_BITS, LEAST_SHARE = 16, 0.1


def _common(x: Sequence[str], y: Sequence[str]) -> list[tuple[int, int]]:
    """The steps of a longest common subsequence: positions, -1 for a gap; of equal ways, y's gap comes first.

    Rows of the table are numbers with a bit for each token of y, from its end: 0 where the subsequence grows.
    Every k-th row is kept and those between are computed again, so memory is y's length times the root of x's,
    in bits.
    """
    n, m = len(x), len(y)
    full, places = (1 << m) - 1, dict.fromkeys(x, 0)
    for j, t in enumerate(y):
        if t in places:
            places[t] |= 1 << (m - 1 - j)

    def above(row: int, i: int) -> int:
        u = row & places[x[i]]
        return ((row + u) | (row - u)) & full

    k = math.isqrt(n) + 1
    row, kept = full, {n: full}
    for i in range(n - 1, -1, -1):
        row = above(row, i)
        if i % k == 0:
            kept[i] = row
    pairs, rows = [], {}
    left = m - row.bit_count()
    i = j = 0
    while i < n and j < m:
        if i not in rows or i + 1 not in rows:
            end = min(n, (i // k + 1) * k)
            rows = {end: kept[end]}
            for h in range(end - 1, i - 1, -1):
                rows[h] = above(rows[h + 1], h)
        if x[i] == y[j]:
            pairs.append((i, j))
            i, j, left = i + 1, j + 1, left - 1
        elif not rows[i] >> (m - 1 - j) & 1 or m - j - (rows[i + 1] & ((1 << (m - j)) - 1)).bit_count() == left:
            left = m - j - (rows[i + 1] & ((1 << (m - j)) - 1)).bit_count()
            pairs.append((i, -1))
            i += 1
        else:
            pairs.append((-1, j))
            j += 1
    return pairs + [(h, -1) for h in range(i, n)] + [(-1, h) for h in range(j, m)]


def align(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs of positions, -1 for a gap, of a longest common subsequence after the common start and end."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start : len(a) - end], b[start : len(b) - end]
    pairs = [(k, k) for k in range(start)]
    if not x or not y or not set(x) & set(y):
        pairs += [(start + k, -1) for k in range(len(x))] + [(-1, start + k) for k in range(len(y))]
    else:
        pairs += [(i + start if i >= 0 else -1, j + start if j >= 0 else -1) for i, j in _common(x, y)]
    pairs += [(len(a) - end + k, len(b) - end + k) for k in range(end)]
    return pairs


def consensus_tokens(values: Sequence[tuple[Sequence, float]], least_share: float = 0.0) -> list:
    """The tokens that the weighted columns of a progressive alignment vote for, heaviest values first.

    A value that ends early or begins late casts no vote beyond its ends: a cut text doesn't vote for being
    cut. A column is kept if its tokens weigh at least as much as the gaps of the values that span it, and more than
    least_share of all values.
    """
    order = sorted((v for v in values if v[1] > 0 and v[0]), key=lambda v: (-v[1], -len(v[0]), list(v[0])))
    columns: list[dict[str, float]] = []
    before = 0.0
    for tokens, weight in order:
        lead = [max((t for t in c if t != ""), key=lambda t: (c[t], t)) for c in columns]
        pairs = align(lead, tokens)
        spans = [k for k, (i, j) in enumerate(pairs) if i >= 0 and j >= 0]
        first, last = (spans[0], spans[-1]) if spans else (len(pairs), -1)
        merged = []
        for k, (i, j) in enumerate(pairs):
            column = columns[i] if i >= 0 else {"": before}
            if j >= 0:
                column[tokens[j]] = column.get(tokens[j], 0.0) + weight
            elif first < k < last:
                column[""] = column.get("", 0.0) + weight
            merged.append(column)
        columns = merged
        before += weight
    out = []
    for c in columns:
        token = max((t for t in c if t != ""), key=lambda t: (c[t], t), default="")
        if token != "" and c[token] >= c.get("", 0.0) and c[token] > least_share * before:
            out.append(token)
    return out


def agreement(tokens: Sequence[str], consensus: Sequence[str]) -> float:
    """Share of a value's tokens that its alignment with the consensus finds there."""
    if not len(tokens) or not len(consensus):
        return 0.0
    return sum(i >= 0 and j >= 0 for i, j in align(list(tokens), list(consensus))) / len(tokens)


def guide_tree(values: Sequence[tuple[Sequence[str], float]], fan: int | None = None) -> list[str]:
    """The consensus of any number of values, by the tree that group_consensus climbs, in one process."""
    level = sorted(((list(t), w) for t, w in values if w > 0 and t), key=lambda v: (-v[1], -len(v[0]), v[0]))
    fan = fan or FAN
    while len(level) > 1:
        level = [(consensus_tokens(level[k : k + fan]), sum(w for _, w in level[k : k + fan])) for k in range(0, len(level), fan)]
    return level[0][0] if level else []


def group_consensus(values: DataFrame, fan: int | None = None) -> DataFrame:
    """group_key, consensus (array of tokens) of values: group_key, tokens, weight.

    Equal values are one with their weights summed, before any shuffle of a group. A group's values are the leaves
    of a guide tree, ordered by weight, then length, then their tokens; a node is the consensus of FAN neighbours,
    in this order, and of their weight. The tree and so the result depend on the values alone, not on partitions or
    hashes, and no task holds an unbounded group: leaves are numbered by a range-partitioned rank. Groups without a
    value of positive weight have no row.
    """
    fan = fan or FAN
    level = values.where((F.col("weight") > 0) & (F.size("tokens") > 0)).groupBy("group_key", "tokens").agg(F.sum("weight").alias("weight"))
    schema = "group_key string, node long, tokens array<string>, weight double"

    def vote(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        leaves = [(list(t), w) for t, w in zip(rows["tokens"], rows["weight"])]
        if len(leaves) > 1:
            rows = rows.assign(_order=rows["rank"])
            leaves = [(list(t), w) for t, w in zip(rows.sort_values("_order")["tokens"], rows.sort_values("_order")["weight"])]
            found = consensus_tokens(leaves)
        else:
            found = leaves[0][0]
        return pd.DataFrame({"group_key": [key[0]], "node": [key[1]], "tokens": [found], "weight": [float(rows["weight"].sum())]})

    level = cut(level)
    sizes = level.groupBy("group_key").agg(F.count(F.lit(1)).alias("_n"))
    single = level.join(sizes.where("_n = 1").select("group_key"), "group_key", "left_semi")
    out = [single.select("group_key", F.col("tokens").alias("consensus"))]
    rest = level.join(sizes.where("_n > 1").select("group_key"), "group_key", "left_semi")
    rest = rank_in_group(rest, "group_key", [F.desc("weight"), F.desc(F.size("tokens")), F.asc("tokens")])
    while True:
        node = F.floor((F.col("rank") - 1) / fan).cast("long").alias("node")
        voted = cut(rest.select("group_key", node, "rank", "tokens", "weight").groupBy("group_key", "node").applyInPandas(vote, schema))
        most = voted.agg(F.max("node")).first()[0]
        if not most:  # a single node in every group, or no group
            out.append(voted.select("group_key", F.col("tokens").alias("consensus")))
            return functools.reduce(DataFrame.unionByName, out)
        rest = voted.withColumn("rank", F.col("node") + 1)


def with_agreement(values: DataFrame, consensus: DataFrame) -> DataFrame:
    """values of the groups that have a consensus, with `agreement`."""

    @F.pandas_udf("double")
    def share(tokens: pd.Series, agreed: pd.Series) -> pd.Series:
        return pd.Series([agreement(list(t), list(c)) for t, c in zip(tokens, agreed)], dtype="float64")

    # spread by number: a small join would leave the alignments, which are slow for their bytes, to one task
    joined = values.join(consensus, "group_key").repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return joined.withColumn("agreement", share("tokens", "consensus")).drop("consensus")


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"(?<=[.!?。])\s+"), lambda s: s != "")


def text_trust(rows: DataFrame, share: float = 0.01, least_words: int = 5) -> DataFrame:
    """rows (group_key, rec_id, value) with `weight`: the share of a text's letters in sentences of its own
    group.

    A sentence that at least `share` of the groups hold, and at least five, is boilerplate wherever it stands;
    sentences are counted over all groups. Texts of fewer than least_words words weigh nothing.
    """
    said = rows.select("group_key", "rec_id", F.explode(F.array_distinct(sentences(F.lower(F.col("value"))))).alias("_s"))
    groups = rows.agg(F.greatest(F.lit(5.0), F.countDistinct("group_key") * share).alias("n"))
    spread = said.groupBy("_s").agg(F.countDistinct("group_key").alias("_df"))
    common = spread.where(F.col("_df") >= groups.scalar()).select("_s", F.lit(True).alias("_common"))
    # at most 1 / share sentences for each one that a group holds; adaptive execution broadcasts it if it is small
    own = said.join(common, "_s", "left").groupBy("group_key", "rec_id").agg(
        (F.sum(F.when(F.col("_common").isNull(), F.length("_s")).otherwise(0)) / F.sum(F.length("_s"))).alias("weight")
    )
    worded = F.size(F.filter(F.split("value", r"[^\p{L}\p{N}]+"), lambda w: w != "")) >= least_words
    return rows.join(own, ["group_key", "rec_id"], "left").withColumn("weight", F.when(worded & (F.col("weight") >= 0.3), F.col("weight")).otherwise(0.0))


def in_groups(rows: DataFrame) -> DataFrame:
    """The rows of groups of two or more; counted map-side and joined back."""
    several = rows.groupBy("group_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("group_key")
    return rows.where(F.col("group_key").isNotNull()).join(several, "group_key", "left_semi")


def best_abstracts(zotero: DataFrame) -> DataFrame:
    """group_key, rec_id, value: the longest abstract of each item that agrees with its group's consensus.

    Blank abstracts, notes in place of one and boilerplate weigh nothing. Ties go to the least rec_id; a group
    without an abstract has no row.
    """
    rows = cut(in_groups(zotero.select(F.col("item_key").alias("group_key"), "rec_id", clean_text(F.col("abstract")).alias("value"))))
    weighed = text_trust(rows).withColumn("tokens", F.split("value", " "))
    agreed = with_agreement(weighed.where("weight > 0"), group_consensus(weighed))
    pick = F.struct(F.length("value").alias("n"), (-F.col("rec_id")).alias("first"), "value")
    best = agreed.where("agreement >= 0.6").groupBy("group_key").agg(F.max(pick).alias("_b"))
    return best.select("group_key", (-F.col("_b.first")).alias("rec_id"), F.col("_b.value").alias("value"))


def last_of_course(counts: Sequence[int]) -> int:
    """The last count of the course that a work's counts took, in the order of retrieval; a course never falls.

    Two witnesses are aligned: the counts as they were retrieved, and the same counts as they would have been if
    none were spoilt, in the order of size. Columns that both vote for are the consensus, and its last token is the
    value nearest to the end that fits; the others are spoilt. Zeros beside other counts stand for lost ones.
    """
    told = [c for c in counts if c] or list(counts)
    return consensus_tokens([(told, 1.0), (sorted(told), 1.0)], 0.5)[-1]


def best_counts(openalex: DataFrame) -> DataFrame:
    """group_key, rec_id, value: the count retrieved last that fits a count which never falls.

    The counts of a work in the order of retrieval are aligned with themselves in the order of size, and the columns
    that both vote for are the course of the real ones (last_of_course). Negative counts weigh nothing; nor do large counts that
    different works share, as large natural counts hardly do: at least LEAST_SHARE of the works with a count of
    that binary order of magnitude, and two at least. How often a count was retrieved doesn't matter for that.
    Equal counts of one work are one step however often they were retrieved.
    """
    key = F.upper(F.regexp_extract("id", r"(?i)(w[0-9]+)", 1))
    rows = cut(in_groups(openalex.select(F.when(key != "", key).alias("group_key"), "rec_id", "retrieved_at", F.col("cited_by_count").cast("long").alias("value"))))
    real = rows.where("value >= 0")
    size = F.length(F.bin(F.col("value") + 1))
    works = real.where(size > SMALL_BITS).select(size.alias("_size"), "value", "group_key").distinct()
    held = works.groupBy("_size", "value").agg(F.count(F.lit(1)).alias("_works"))
    sizes = works.groupBy("_size").agg(F.countDistinct("group_key").alias("_all"))  # 63 rows at most
    # few values: for each size at most 1 / LEAST_SHARE for each large count that a work has on average
    odd = held.join(F.broadcast(sizes), "_size").where((F.col("_works") >= 2) & (F.col("_works") >= LEAST_SHARE * F.col("_all"))).select("value")
    real = real.join(odd, "value", "left_anti")
    steps = real.groupBy("group_key", "value").agg(F.max("retrieved_at").alias("last_at"), F.count(F.lit(1)).alias("n"))

    @F.pandas_udf("long")
    def course(courses: pd.Series) -> pd.Series:
        return pd.Series([last_of_course([int(x["value"]) for x in c]) for c in courses], dtype="int64")

    # one short array for each work: its different counts in the order of their last retrieval
    ordered = steps.groupBy("group_key").agg(F.array_sort(F.collect_list(F.struct("last_at", "value", "n"))).alias("_steps"))
    last = ordered.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))).select("group_key", course("_steps").alias("value"))
    fits = real.join(last, ["group_key", "value"])
    pick = F.struct(F.coalesce("retrieved_at", F.lit("0001-01-01").cast("timestamp_ntz")).alias("at"), (-F.col("rec_id")).alias("first"), "value")
    best = fits.groupBy("group_key").agg(F.max(pick).alias("_b"))
    return best.select("group_key", (-F.col("_b.first")).alias("rec_id"), F.col("_b.value").cast("string").alias("value"))


def best_addresses(arxiv: DataFrame) -> DataFrame:
    """group_key, rec_id, value: the usable address of the paper's own PDF, of the highest version of the id.

    Addresses are tokens of scheme, host, path and number, without their version; a group's rows vote for each
    column, an address of several rows with the weight of all of them, and the addresses that agree with the
    consensus go on to the exact check, which asks for the group's own number at the end of a PDF path. Ties go to
    the latest retrieval, then the least rec_id.
    """
    number = F.regexp_extract("id", r"([0-9]{4}\.[0-9]{4,5})", 1)
    version = F.regexp_extract("id", r"[0-9]{4}\.[0-9]{4,5}v([0-9]+)", 1)
    rows = cut(
        in_groups(arxiv.select(F.when(number != "", number).alias("group_key"), "rec_id", "retrieved_at", F.trim("pdf_url").alias("value"), F.coalesce(F.try_to_number(F.when(version != "", version), F.lit("999999999")).cast("int"), F.lit(0)).alias("version")))
    )
    own = F.coalesce(F.col("value").rlike(r"^https?://[^/?#\s]+/pdf/") & (F.regexp_extract("value", r"/pdf/([0-9]{4}\.[0-9]{4,5})(?:v[0-9]+)?(?:\.pdf)?$", 1) == F.col("group_key")), F.lit(False))
    weighed = rows.withColumn("own", own).withColumn("weight", F.when(F.col("own"), 1.0).when(F.col("value") != "", OTHER_WEIGHT).otherwise(0.0)).withColumn("tokens", F.filter(F.split(F.regexp_replace("value", r"(?:v[0-9]+)?(?:\.pdf)?$", ""), r"[:/]+"), lambda t: t != ""))
    agreed = with_agreement(weighed.where("own"), group_consensus(weighed))
    pick = F.struct("version", "retrieved_at", (-F.col("rec_id")).alias("first"), "value")
    best = agreed.where("agreement >= 0.6").groupBy("group_key").agg(F.max(pick).alias("_b"))
    return best.select("group_key", (-F.col("_b.first")).alias("rec_id"), F.col("_b.value").alias("value"))


def best_values(zotero: DataFrame, openalex: DataFrame, arxiv: DataFrame) -> DataFrame:
    """src_table, group_key, rec_id, value of the surviving values. Rows without a group key are in no group;
    extra columns are ignored; empty tables give no rows."""
    parts = {"zotero_results": best_abstracts(zotero), "openalex_results": best_counts(openalex), "arxiv_results": best_addresses(arxiv)}
    out = [df.select(F.lit(name).alias("src_table"), "group_key", "rec_id", "value") for name, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])
