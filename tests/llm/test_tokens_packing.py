"""Encoding against whole-text encoding, and packing against its invariants."""

import os
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import packing, tokens

PATH = os.path.join(tokens.tokenizer_folder(), "byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "\n\n", "a" * 900, "word " * 300, "It's   a\n\n\n test  \n" * 40, "数据集中的估计量" * 120, "x y z " * 150, "<|endoftext|> is text " * 40, "'re 've don't " * 70, "🙂‍🙂 é" * 100, "  \n \t" * 200, "tail   ", "1234567890" * 90,
]


def whole(text):
    return tokens.encoder(PATH).encode_ordinary(text or "")


def test_chunks_give_the_ids_of_the_whole_text(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS + TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.encode_corpus(df, chunk=128, overlap=24).collect()}
    assert got == {i: whole(t) for i, t, _ in rows}
    counted = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df, chunk=128, overlap=24).collect()}
    assert counted == {k: len(v) for k, v in got.items()}


def test_round_trip_and_empty_table(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    back = {r["doc_id"]: r["t"] for r in tokens.encode_corpus(df).select("doc_id", tokens.decode_column(tokens.F.col("ids")).alias("t")).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert tokens.encode_corpus(df.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab '\n\t.é数1 r"), min_size=60, max_size=300))
def test_stitches_are_boundaries_of_the_whole_text(text):
    chunk, overlap = 40, 12
    n = -(-len(text) // chunk)
    seams = {}
    for k in range(n):
        at = max(0, k * chunk - overlap)
        before, after = tokens.boundaries(text[at : (k + 1) * chunk + overlap], at, k == 0, k == n - 1, k * chunk, (k + 1) * chunk, overlap)
        seams.setdefault(k, [None, None])[1] = before
        seams.setdefault(k + 1, [None, None])[0] = after
    cuts = [min(set(seams[k][0]) & set(seams[k][1]), default=None) for k in range(1, n)]
    out, start = [], 0
    for c in [*(c for c in cuts if c is not None), len(text)]:
        out += whole(text[start:c])
        start = c
    assert out == whole(text)


def unpacked(rows, capacity):
    used = Counter()
    for r in rows:
        used[r["container_id"]] += r["item_size"]
    assert all(v <= capacity for v in used.values())
    return used


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(5)
    sizes = [rng.randint(1, 90) for _ in range(3000)] + [7] * 1500 + [100, 100, 250, 0, None]
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "doc_id long, n_tokens long, piece string")
    rows = packing.pack_items(df, "doc_id", "n_tokens", 100, rows_per_bucket=100).collect()
    used = unpacked(rows, 100)
    held = Counter()
    for r in rows:
        held[r["doc_id"]] += r["item_size"]
        if (sizes[r["doc_id"]] or 0) <= 100:
            assert r["piece"] == 0 and r["item_size"] == sizes[r["doc_id"]]
    assert held == Counter({i: n for i, n in enumerate(sizes) if n})
    assert len(used) <= -(-sum(n or 0 for n in sizes) // 100) + 1
    assert sorted(used) == list(range(len(used)))


def test_packing_no_items(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, n_tokens long")
    assert packing.pack_items(df, "doc_id", "n_tokens", 10).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), max_size=12))
def test_plan_uses_every_item_once(counts):
    patterns = packing.plan_containers(counts, 30)
    used = Counter()
    for copies, sizes in patterns:
        assert sum(s * k for s, k in sizes.items()) <= 30
        for s, k in sizes.items():
            used[s] += copies * k
    assert used == Counter(counts)


def test_plan_refuses_sizes_out_of_range():
    with pytest.raises(ValueError):
        packing.plan_containers({31: 1}, 30)
