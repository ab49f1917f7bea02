"""Encoding of a corpus with a public byte-level BPE vocabulary by overlapping chunks.

Texts longer than a chunk are cut into overlapping chunks, which are pre-tokenised in parallel. Two
neighbours are stitched at the first place of their overlap where both have a pre-token boundary: from a
common boundary on, a left-to-right matcher that never looks back finds the same pre-tokens in both. The
pieces between stitches are encoded on their own, in parallel again, and their ids are joined.
"""

from __future__ import annotations

import base64
import functools
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points of a chunk, and of the overlap on either side of a seam.
CHUNK, OVERLAP = 16_384, 512
#: A pre-token depends on this many code points past its end at most (the longest contraction, or one of lookahead).
REACH = 8
#: Between these two characters every pre-token ends, whatever stands before: no alternative of the pattern
#: goes on from a non-space to a space.
SURE = regex.compile(r"\P{White_Space}(?=\p{White_Space})")
#: Fixed value: the pre-tokenisation pattern of the byte-level 50k vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_folder() -> str:
    """Where the vocabulary files are if no path is given: QUILLSPARK_TOKENIZERS, else the installed package."""
    if named := os.environ.get("QUILLSPARK_TOKENIZERS"):
        return named
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec else "/opt/tokenizers"


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """The encoder of a file of ranks, one for each worker process. It knows no special tokens, so their
    strings are ordinary text."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=1)
def _pattern() -> regex.Pattern:
    return regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


@functools.lru_cache(maxsize=1)
def _space() -> regex.Pattern:
    return regex.compile(r"\p{White_Space}")


def boundaries(chunk: str, at: int, first: bool, last: bool, seam_before: int, seam_after: int, overlap: int) -> tuple[list[int], list[int]]:
    """Offsets in the text of the pre-token boundaries near the seam before and the seam after a chunk that
    begins at `at`. After a seam only boundaries that hold for the whole text are given: the chunk is the
    first, or a sure boundary lies before them."""
    end = at + len(chunk)
    trusted = end if last else end - REACH
    before, after = [], []
    sure = None if first else SURE.search(chunk)
    sure_at = at if first else (at + sure.end() if sure else end + 1)
    for m in _pattern().finditer(chunk):
        p = at + m.start()
        if p > trusted:
            break
        if not m.start() or _space().match(chunk, m.start() - 1):
            continue  # a piece that ends in white space would keep as one run what the text splits
        if not first and abs(p - seam_before) <= overlap:
            before.append(p)
        if not last and abs(p - seam_after) <= overlap and p >= sure_at:
            after.append(p)
    return before, after


def encode_column(text: Column, path: str, count_only: bool = False) -> Column:
    """ids (or their number) of a text; an empty list (or 0) for a null or empty one."""

    def arrow(texts: pa.Array) -> pa.Array:
        enc = encoder(path)
        found = [enc.encode_to_numpy(x.as_py()) if x.is_valid and len(x.as_py()) else np.empty(0, np.uint32) for x in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        if count_only:
            return pa.array(sizes, pa.int64())
        values = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int32()))

    arrow.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    # not deterministic, as far as the optimizer may know: a filter on the result would encode every text twice
    return F.arrow_udf(arrow, "long" if count_only else "array<int>").asNondeterministic()(text)


def pieces_of_long(df: DataFrame, key: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, piece, text of the texts longer than chunk, cut where chunks resynchronise.

    A seam whose overlap has no common boundary is no cut: the piece goes on to the next one, so the result
    is exact for any text, a single endless word included.
    """
    long = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.length("_text") > chunk)
    number = F.ceil(F.length("_text") / F.lit(chunk)).cast("int")
    chunks = long.select("_key", number.alias("_n"), F.posexplode(F.transform(F.sequence(F.lit(0), number - 1), lambda k: F.substring(F.col("_text"), F.greatest(F.lit(1), k * chunk - overlap + 1), F.when(k == 0, F.lit(chunk + overlap)).otherwise(F.lit(chunk + 2 * overlap))))).alias("_k", "_chunk"))
    # one task may hold a text of any length; its chunks are spread before the work begins
    chunks = chunks.repartition(F.col("_key"), F.col("_k"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, seams, sides, where = [], [], [], []
            for key_, n, k, body in zip(b["_key"], b["_n"], b["_k"], b["_chunk"]):
                at = max(0, k * chunk - overlap)
                before, after = boundaries(body, at, k == 0, k == n - 1, k * chunk, (k + 1) * chunk, overlap)
                for seam, side, points in ((k, 1, before), (k + 1, 0, after)):
                    if 0 < seam < n:
                        keys.append(key_), seams.append(seam), sides.append(side), where.append(points)
            yield pd.DataFrame({"_key": pd.Series(keys, dtype="int64"), "_seam": pd.Series(seams, dtype="int32"), "_side": pd.Series(sides, dtype="int32"), "_at": pd.Series(where, dtype=object)})

    seams = chunks.mapInPandas(scan, "_key long, _seam int, _side int, _at array<int>")
    common = (
        seams.groupBy("_key", "_seam")
        .agg(F.max(F.when(F.col("_side") == 0, F.col("_at"))).alias("_left"), F.max(F.when(F.col("_side") == 1, F.col("_at"))).alias("_right"))
        .select("_key", F.array_min(F.array_intersect("_left", "_right")).alias("_cut"))
    )
    cuts = common.groupBy("_key").agg(F.array_sort(F.array_distinct(F.collect_list("_cut"))).alias("_cuts"))
    ends = F.concat(F.col("_cuts"), F.array(F.length("_text")))
    spans = F.transform(ends, lambda end, i: F.struct(F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_cuts"), i - 1)).alias("a"), end.alias("b")))
    cut = long.join(cuts, "_key").select("_key", F.posexplode(F.transform(spans, lambda s: F.substring(F.col("_text"), s["a"] + 1, s["b"] - s["a"]))).alias("piece", "text"))
    return cut.select(F.col("_key").alias(key), "piece", "text").repartition(F.col(key), F.col("piece"))


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, name: str = "byte_bpe_50k", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, ids of every row. key is a unique long.

    Null and empty texts have an empty list; the strings of special tokens are ordinary text; equal texts
    have equal ids. Extra columns are ignored, even if named like the output's.
    """
    path = os.path.join(folder or tokenizer_folder(), f"{name}.tiktoken")
    rows = df.select(F.col(key).alias(key), F.col(text).alias("text"))
    short = rows.where(F.coalesce(F.length("text") <= chunk, F.lit(True))).select(key, encode_column(F.col("text"), path).alias("ids"))
    pieces = pieces_of_long(rows, key, "text", chunk, overlap).select(key, "piece", encode_column(F.col("text"), path).alias("ids"))
    joined = pieces.groupBy(key).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])).alias("ids"))
    return short.unionByName(joined)


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, name: str = "byte_bpe_50k", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, n_tokens as encode_corpus would give them, without moving ids; 0 for null and empty texts."""
    path = os.path.join(folder or tokenizer_folder(), f"{name}.tiktoken")
    rows = df.select(F.col(key).alias(key), F.col(text).alias("text"))
    short = rows.where(F.coalesce(F.length("text") <= chunk, F.lit(True))).select(key, encode_column(F.col("text"), path, True).alias("n_tokens"))
    pieces = pieces_of_long(rows, key, "text", chunk, overlap).select(key, encode_column(F.col("text"), path, True).alias("n"))
    return short.unionByName(pieces.groupBy(key).agg(F.sum("n").alias("n_tokens")))


def decode_column(ids: Column, folder: str | None = None, name: str = "byte_bpe_50k") -> Column:
    """The text of a list of ids: the raw bytes of the tokens, joined."""
    path = os.path.join(folder or tokenizer_folder(), f"{name}.tiktoken")

    @F.pandas_udf("string")
    def decode(lists: pd.Series) -> pd.Series:
        enc = encoder(path)
        return lists.map(lambda x: None if x is None else enc.decode_bytes([int(i) for i in x]).decode("utf-8", "replace"))

    return decode(ids)
