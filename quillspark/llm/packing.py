"""Filling containers of fixed capacity by exact complements.

The plan works on the histogram of sizes, of at most `capacity` entries however many items there are; the
items themselves are only numbered within their size and looked up in the plan.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.session import cut

#: Ranks within a size stay below this.
RANKS = 1 << 44


class SumIndex:
    """Which gaps one, two or three of the sizes left fill exactly.

    Counts stand by size. The pair sums are counted by sum and kept up to date: a size that comes or goes changes
    one entry for each other size. The sizes left are also the bits of a number, in rising and in falling order, so
    the pairs of a sum come from one shift and one conjunction; a triple takes one lookup of a pair sum for each
    first size. Nothing is scanned anew for a gap.
    """

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.have = [0] * (capacity + 1)
        self.pairs = np.zeros(2 * capacity + 1, np.int32)
        self.left = np.zeros(capacity + 1, np.int32)
        self.rising = self.falling = 0
        for size, n in counts.items():
            self.add(size, n)

    def add(self, size: int, n: int) -> None:
        """n more of a size, or fewer."""
        before, now = self.have[size], self.have[size] + n
        self.have[size] = now
        if (before > 0) != (now > 0):
            step = 1 if now > 0 else -1
            self.left[size] = 0
            self.pairs[size : size + self.capacity + 1] += step * self.left
            self.left[size] = now > 0
            self.rising ^= 1 << size
            self.falling ^= 1 << (self.capacity - size)
        if (before > 1) != (now > 1):
            self.pairs[2 * size] += 1 if now > 1 else -1

    def largest(self, most: int) -> int:
        """The largest size left that isn't over `most`; 0 if there is none."""
        fitting = self.rising & ((1 << (most + 1)) - 1)
        return fitting.bit_length() - 1 if fitting else 0

    def pair(self, total: int, most: int) -> tuple[int, int] | None:
        """Two items of that sum, neither over `most`, the larger one as large as may be."""
        if total < 2 or not self.pairs[total]:
            return None
        sizes = self.rising & (self.falling >> (self.capacity - total)) & ((1 << (min(most, total - 1) + 1)) - 1)
        while sizes:
            a = sizes.bit_length() - 1
            if 2 * a < total:
                return None
            if 2 * a > total or self.have[a] > 1:
                return a, total - a
            sizes ^= 1 << a
        return None

    def fill(self, gap: int) -> list[int] | None:
        """One, two or three items that sum to gap, the fewest and then the largest first."""
        if self.have[gap]:
            return [gap]
        if two := self.pair(gap, gap):
            return list(two)
        a = self.largest(gap - 2)
        while a and 3 * a >= gap:
            if self.pairs[gap - a]:
                self.add(a, -1)
                two = self.pair(gap - a, a)
                self.add(a, 1)
                if two:
                    return [a, *two]
            a = self.largest(a - 1)
        return None


def plan_containers(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(copies, {size: items in a container}) patterns that use every item of the histogram once.

    A container begins with the largest size left. Its gap is filled exactly by the single, pair or triple
    of sizes that sums to it, if there is one; else the largest fitting item goes in and the new gap is
    tried. Each pattern is repeated as often as its sizes last, so it uses one of them up: there are at most
    `capacity` patterns, and the time doesn't depend on the number of items.
    """
    for size in counts:
        if not 0 < size <= capacity:
            raise ValueError(f"size {size} is outside 1..{capacity}")
    index = SumIndex(counts, capacity)
    patterns = []
    while first := index.largest(capacity):
        used = {first: 1}
        index.add(first, -1)
        gap = capacity - first
        while gap:
            if fill := index.fill(gap):
                gap = 0
            elif fits := index.largest(gap):
                fill = [fits]
                gap -= fits
            else:
                break
            for size in fill:
                used[size] = used.get(size, 0) + 1
                index.add(size, -1)
        more = min(index.have[s] // k for s, k in used.items())
        if more:
            for size, k in used.items():
                index.add(size, -more * k)
        patterns.append((1 + more, used))
    return patterns


def pack_items(items: DataFrame, key: str, size: str, capacity: int, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """container_id, key, piece, item_start, item_size of every item with a size.

    An item within the capacity has one row, piece 0, and is never split. A longer one is cut into full
    containers and a rest, which is packed as an item of its own; item_start counts from 0. Items of size 0
    or null hold nothing and have no row. key is a unique long. Equal sizes are numbered in buckets of about
    rows_per_bucket rows, so a size that a third of all items share is numbered by many tasks. No items give
    no rows. Extra columns are ignored.
    """
    spark = items.sparkSession
    sized = items.select(F.col(key).alias("_key"), F.col(size).cast("long").alias("_size")).where(F.col("_size") > 0)
    pieces = sized.select(
        "_key", F.posexplode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_size") - 1, F.lit(capacity).cast("long")), lambda at: F.struct(at.alias("at"), F.least(F.col("_size") - at, F.lit(capacity)).cast("int").alias("n")))).alias("piece", "_p")
    ).select("_key", "piece", F.col("_p.at").alias("item_start"), F.col("_p.n").alias("item_size"))
    pieces = cut(pieces)
    buckets = max(16, pieces.count() // rows_per_bucket)
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("_key", "piece"), F.lit(buckets).cast("long")).cast("int"))
    by_bucket = pieces.groupBy("item_size", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counts = {r["item_size"]: r["n"] for r in by_bucket.groupBy("item_size").agg(F.sum("_n").alias("n")).collect()}  # at most `capacity` rows
    patterns = plan_containers(counts, capacity)

    keys, bases, each = [], [], []
    used = dict.fromkeys(counts, 0)
    base = 0
    for copies, sizes in patterns:
        for s, k in sizes.items():
            keys.append(s * RANKS + used[s])
            bases.append(base)
            each.append(k)
            used[s] += k * copies
        base += copies
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    plan = spark.sparkContext.broadcast(tuple(np.array(x, np.int64)[order] for x in (keys, bases, each)))  # bounded by the capacity, not by the items

    @F.pandas_udf(T.LongType())
    def container(sizes: pd.Series, ranks: pd.Series) -> pd.Series:
        starts, first, per = plan.value
        at = sizes.to_numpy(np.int64) * RANKS + ranks.to_numpy(np.int64)
        slot = np.searchsorted(starts, at, side="right") - 1
        return pd.Series(first[slot] + (at - starts[slot]) // per[slot])

    offsets = by_bucket.select(
        "item_size", "_bucket", (F.sum("_n").over(_running("item_size", "_bucket")) - F.col("_n")).alias("_offset")
    )
    numbered = pieces.withColumn("_rank", F.row_number().over(_running("item_size", "_bucket", "_key", "piece")))
    ranked = numbered.join(offsets, ["item_size", "_bucket"]).withColumn("_rank", F.col("_rank") - 1 + F.col("_offset"))
    return ranked.select(container("item_size", "_rank").alias("container_id"), F.col("_key").alias(key), "piece", "item_start", "item_size")


def _running(part: str, *order: str):
    from pyspark.sql import Window

    parts, rest = ([part], list(order)) if len(order) == 1 else ([part, order[0]], list(order[1:]))
    return Window.partitionBy(*parts).orderBy(*rest).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def container_fill(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, items, used, least_containers (the bound that no packing can beat) and fill."""
    by = packed.groupBy("container_id").agg(F.sum("item_size").alias("_used"), F.count(F.lit(1)).alias("_items"))
    return by.agg(
        F.count(F.lit(1)).alias("containers"), F.sum("_items").alias("items"), F.sum("_used").alias("used"), F.max("_used").alias("fullest"),
        F.ceil(F.sum("_used") / F.lit(capacity)).alias("least_containers"), F.round(F.sum("_used") / (F.count(F.lit(1)) * capacity), 6).alias("fill"),
    )
