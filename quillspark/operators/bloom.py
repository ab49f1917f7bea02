"""A Bloom filter of keys in public SQL functions: built distributed, tested inside code generation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^26 bits are 8 MiB, the most that is ever broadcast; beyond it the filter gets fuller, never larger.
MOST_BITS = 1 << 26


@dataclass(frozen=True)
class BloomFilter:
    """words: one row, one array of 64-bit words."""

    words: DataFrame
    bits: int
    hashes: int

    @staticmethod
    def positions(hashed: Column, bits: int, hashes: int) -> list[Column]:
        """hashed: xxhash64 of the key, so that a costly key expression is evaluated once."""
        return [F.pmod(F.xxhash64(hashed, F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]

    def probe(self, df: DataFrame, key: str) -> tuple[DataFrame, Column]:
        """df with the column _hashed, and the test on it; false proves that the key isn't there.

        The hash comes out of a generator, through which no optimizer rule copies it: a plain expression
        pushed down to the scan would be evaluated again in every one of the tests. The filter reaches the
        scan as a scalar subquery.
        """
        words = self.words.scalar()
        found = F.lit(True)
        for at in self.positions(F.col("_hashed"), self.bits, self.hashes):
            found = found & (F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return df.withColumn("_hashed", F.explode(F.array(F.xxhash64(key)))), found


def build_bloom(keys: DataFrame, column: str, expected: int, hashes: int = 4, bits_per_key: int = 10) -> BloomFilter:
    """expected only sets the size (a power of two, MOST_BITS at most). Words are or-ed map-side, so the
    shuffle holds one row for each word and task at most. Null keys are left out."""
    bits = 1 << 12
    while bits < min(MOST_BITS, expected * bits_per_key):
        bits *= 2
    spark = keys.sparkSession
    at = keys.where(F.col(column).isNotNull()).select(F.explode(F.array(*BloomFilter.positions(F.xxhash64(column), bits, hashes))).alias("_at"))
    set_bits = at.select(F.shiftright("_at", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_at").bitwiseAND(F.lit(63)).cast("int")).alias("mask"))
    empty = spark.range(0, bits // 64, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = set_bits.union(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    packed = words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "mask"))), lambda x: x["mask"]).alias("words"))
    return BloomFilter(packed, bits, hashes)
