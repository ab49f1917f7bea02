"""Operators on keyed tables: exclusion, promotion, upsert, latest state, integrity, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import cut


def not_listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The rows whose key isn't listed; a null key is never listed."""
    return rows.join(listed.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def promoted(queue: DataFrame, exported: DataFrame, key: str, status: str = "status", before: str = "mentioned", after: str = "pending") -> DataFrame:
    """queue with `before` turned into `after` for exported keys."""
    hit = exported.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = queue.join(hit, key, "left")
    return joined.withColumn(status, F.when(F.col("_hit") & (F.col(status) == before), F.lit(after)).otherwise(F.col(status))).drop("_hit").select(*queue.columns)


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row for each key: a new value where there is one, else the old."""
    cols = [c for c in old.columns if c != key]
    a = old.select(F.col(key), *(F.col(c).alias(f"_old_{c}") for c in cols))
    return a.join(new.select(key, *cols), key, "full_outer").select(key, *(F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) for c in cols))


def latest_rows(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by `order`, by a map-side maximum: no sort, and no task holds a key's rows."""
    rest = [c for c in rows.columns if c != key and c not in order]
    return rows.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_last")).select(key, *(F.col(f"_last.{c}").alias(c) for c in (*order, *rest)))


def key_integrity(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """key and one flag for each side, for keys that not every side has."""
    names = list(sides)
    tagged = None
    for i, (_, df) in enumerate(sides.items()):
        one = df.select(key).where(F.col(key).isNotNull()).distinct().select(key, *(F.lit(i == j).alias(n) for j, n in enumerate(names)))
        tagged = one if tagged is None else tagged.unionByName(one)
    flags = tagged.groupBy(key).agg(*(F.max(n).alias(n) for n in names))
    missing = None
    for n in names:
        missing = ~F.col(n) if missing is None else missing | ~F.col(n)
    return flags.where(missing)


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def zero_filled_counts(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """One row for each of the fixed values, zeros included."""
    spark = rows.sparkSession
    fixed = spark.createDataFrame([(v,) for v in values], f"{column} string")
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(fixed).join(counted, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def gated_rates(rows: DataFrame, group: str, hit: Column, least: int) -> DataFrame:
    """Share of hits in each group of at least `least` rows, rounded to three places."""
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("int")).alias("hits")).where(F.col("n") >= least).withColumn("rate", F.round(F.col("hits") / F.col("n"), 3))


def global_rank(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with `rank` (from 1) and `total`, for a total order, without one task for all.

    Rows are range-partitioned by the order and numbered within their partition; the partitions' sizes, a few
    numbers, give the offsets.
    """
    from pyspark.sql import Window

    placed = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # as many rows as partitions
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("total"))
    numbered = placed.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return numbered.join(F.broadcast(before), "_part").withColumn("rank", F.col("_row") + F.col("_before")).drop("_part", "_row", "_before")


def rank_in_group(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """rows with `rank`, from 1 within each group, for a total order. A group of any size is spread over range
    partitions; its first place in the order of all rows gives the offset."""
    ranked = cut(global_rank(rows, [F.asc(group), *order]).drop("total"))
    first = ranked.groupBy(group).agg(F.min("rank").alias("_first"))
    return ranked.join(first, group).withColumn("rank", F.col("rank") - F.col("_first") + 1).drop("_first")


def neighbours(rows: DataFrame, group: str, order: str, wanted: dict[str, tuple[str, int]]) -> DataFrame:
    """rows with a column for each of `wanted` (new name: column, +1 for the next row of the group or -1 for the one
    before), null at the group's ends. order is unique in a group.

    Rows are range-partitioned by group and order, so a group that holds most rows is spread over partitions; the
    first and last row of each partition, a few rows, close the seams.
    """
    from pyspark.sql import Window

    cols = sorted({c for c, _ in wanted.values()})
    placed = cut(rows.repartitionByRange(F.asc(group), F.asc(order)).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(group, order)
    edge = F.struct(F.struct(F.col(group).alias("g"), F.col(order).alias("o")).alias("at"), *(F.col(c).alias(f"v_{c}") for c in cols))
    parts = Window.orderBy("_part")
    # as many rows as partitions
    ends = placed.groupBy("_part").agg(F.min_by(edge, edge["at"]).alias("_head"), F.max_by(edge, edge["at"]).alias("_tail"))
    seams = ends.select("_part", F.lead("_head").over(parts).alias("_after"), F.lag("_tail").over(parts).alias("_before"))
    out = placed.withColumn("_n", F.coalesce(F.lead(edge).over(inside), F.lit(None))).withColumn("_p", F.lag(edge).over(inside)).join(F.broadcast(seams), "_part")
    beside = {1: F.coalesce("_n", "_after"), -1: F.coalesce("_p", "_before")}
    news = [F.when(beside[d]["at"]["g"].eqNullSafe(F.col(group)), beside[d][f"v_{c}"]).alias(new) for new, (c, d) in wanted.items()]
    return out.select(*rows.columns, *news)


def percentile_bucket(rank: Column, total: Column) -> Column:
    share = rank / total
    return F.when(share <= 0.30, "high").when(share <= 0.70, "medium").otherwise("low")


def preferred_row(rows: DataFrame, key: str, rank: Column, order: Column) -> DataFrame:
    """The row of each key with the greatest rank, the first of equals."""
    cols = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(rank.alias("r"), (-order).alias("o"))).alias("_b"))
    return best.select(key, *(F.col(f"_b.{c}").alias(c) for c in cols))


def best_match(pairs: DataFrame, key: str, candidate: str, score: Column, least: float = 0) -> DataFrame:
    """The candidate of each key with the greatest score above `least`; the least candidate of equals."""
    scored = pairs.withColumn("score", score).where(F.col("score") > least)
    return scored.groupBy(key).agg(F.max(F.struct("score", (-F.col(candidate)).alias("c"))).alias("_b")).select(key, (-F.col("_b.c")).alias(candidate), F.col("_b.score").alias("score"))


def adjacent_pairs(rows: DataFrame, group: str, position: str) -> DataFrame:
    """Disjoint pairs of neighbouring positions, greedily from the start of each run of neighbours."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(position)
    runs = rows.select(group, position).withColumn("_run", F.col(position) - F.row_number().over(w))
    numbered = runs.withColumn("_rn", F.row_number().over(Window.partitionBy(group, "_run").orderBy(position)))
    pairs = numbered.groupBy(group, "_run", F.floor((F.col("_rn") - 1) / 2).alias("_pair")).agg(F.min(position).alias("first"), F.max(position).alias("second"), F.count(F.lit(1)).alias("_n"))
    return pairs.where("_n = 2").select(group, "first", "second")


def overlap_matches(claims: DataFrame, notes: DataFrame) -> DataFrame:
    """claim_id, note_id, shared of the pairs that share enough tokens: max(2, min(4, n // 2)) of a claim's n.

    claims: claim_id, tokens; notes: note_id, tokens (arrays without repeats). Exact by prefix filtering: a pair
    that shares t of the claim's n tokens shares one of its n - t + 1 rarest, so only those are joined, and
    frequent tokens are left to the check.
    """
    need = F.greatest(F.lit(2), F.least(F.lit(4), F.floor(F.size("tokens") / 2).cast("int")))
    rare = notes.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    exploded = claims.select("claim_id", F.col("tokens").alias("claim_tokens"), need.alias("need"), F.explode("tokens").alias("token")).join(rare, "token")
    ordered = exploded.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("_by"), F.max("need").alias("need"), F.max(F.size("claim_tokens")).alias("n"), F.max("claim_tokens").alias("claim_tokens"))
    # tokens that no note has can't be shared; of the others the rarest, as many as can't all be missed
    probes = ordered.select("claim_id", "claim_tokens", "need", F.explode(F.slice("_by", 1, F.greatest(F.size("_by") - F.col("need") + 1, F.lit(0)))).alias("_p")).select("claim_id", "claim_tokens", "need", F.col("_p.token").alias("token"))
    index = notes.select("note_id", F.col("tokens").alias("note_tokens"), F.explode("tokens").alias("token"))
    met = probes.join(index, "token").select("claim_id", "note_id", "need", F.size(F.array_intersect("claim_tokens", "note_tokens")).alias("shared"))
    return met.where(F.col("shared") >= F.col("need")).select("claim_id", "note_id", "shared").distinct()


def within_budget(rows: DataFrame, group: str, order: str, size: str, keep: Column, budget: int) -> DataFrame:
    """Rows that stay when the oldest that needn't be kept are dropped until a group's sizes fit the budget."""
    from pyspark.sql import Window

    w = Window.partitionBy(group)
    over = F.sum(size).over(w) - F.lit(budget)
    dropped = F.sum(F.when(keep, 0).otherwise(F.col(size))).over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_over", over).withColumn("_dropped", F.coalesce(dropped, F.lit(0))).where(keep | (F.col("_dropped") >= F.col("_over"))).drop("_over", "_dropped")
