"""Sharding and packing: exact sizes, gapless places, round trips, uniformity."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandspark.llm import bins, packing, sharding, tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("rows", [0, 1, 23, 24, 25, 500])
def test_shards_have_exact_sizes_and_gapless_slots(documents, rows):
    docs = documents([(k if k % 7 else None, ["a", None, "b" * k][k % 3]) for k in range(rows)])
    if rows == 0:
        docs = documents([(1, "x")]).where("doc_id = 2")
    placed = sharding.shard(docs, cells=4)
    assert set(placed.columns) == set(docs.columns)
    slots = defaultdict(list)
    for r in placed.select("shard", "slot").collect():
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[k]) for k in range(24)]
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_same_shards_under_other_partitions(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('t', id % 9) AS text")
    one, many = (sorted(map(tuple, sharding.shard(docs.repartition(n)).select("doc_id", "shard", "slot").collect())) for n in (1, 13))
    assert one == many


def test_matrix_has_the_law_of_a_permutation():
    """Mean and variance of a cell against the hypergeometric ones, and exact margins."""
    counts, sizes = {0: 30, 1: 50, 5: 20}, [25, 25, 50]
    cells = []
    for seed in range(2000):
        matrix = sharding.communication(counts, sizes, seed)
        assert [sum(matrix[p]) for p in counts] == list(counts.values())
        assert np.sum(list(matrix.values()), 0).tolist() == sizes
        cells.append(matrix[1][2])
    mean, share = 50 * 50 / 100, 50 / 100
    variance = 50 * share * (1 - share) * (100 - 50) / 99
    assert abs(np.mean(cells) - mean) < 4 * (variance / 2000) ** 0.5
    assert 0.85 < np.var(cells) / variance < 1.15


def test_draws_beyond_the_samplers_range():
    rng = np.random.default_rng(0)
    got = [sharding.hypergeometric(rng, 10**9, 10**9, 1000) for _ in range(20)]
    assert abs(np.mean(got) - 500) < 30


TEXTS = [
    "Hello, WORLD! it's don't 123 héllo Ünïcode",
    "",
    "   \n\t ",
    "<|endoftext|> in text<|startoftext|>x",
    "nbsp\u00a0here \u2003em \x1cfs\x1d \x85nel e\u0301 \u0301alone ΑΣ Σ. ﬁ",
    "日本語 テキスト 😀😀 a'll we'RE",
    "word " * 5000,
    "x" * 30_000,
]


def test_word_by_word_ids_are_the_tokenizers(monkeypatch):
    whole = Tokenizer.from_file(VOCABULARY)
    for cached in (400_000, 5):
        monkeypatch.setattr(tokens, "CACHED_WORDS", cached)
        encoder = tokens.Encoder(VOCABULARY)
        for _ in range(2):
            got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.texts(TEXTS, 0)]
            assert got == [whole.encode(t, add_special_tokens=False).ids + [0] for t in TEXTS]


def check(rows, length=packing.LENGTH):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        upto = 0
        for offset, size in sorted(parts):
            assert offset == upto
            upto += size
        assert upto <= length
    return len(held)


def test_packing(documents):
    docs = documents([(k, t) for k, t in enumerate(TEXTS)] + [(None, None), (3, TEXTS[3]), (3, TEXTS[3])])
    rows = packing.pack_documents(docs, VOCABULARY).collect()
    check(rows)
    whole = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for k, text in [*enumerate(TEXTS), (None, ""), (3, TEXTS[3]), (3, TEXTS[3])]:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [0], "<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[k, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want


@pytest.mark.parametrize("node,more", [(200, 1.03), (1000, 1.01), (3000, 1.0)])
def test_rounds_stay_bounded_and_pack_well(spark, node, more):
    """Against best fit of all items in one node; nodes of a few hundred items lose a little."""
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 2049, 3000).tolist()
    items = spark.createDataFrame([(k, 0, 0, n, k) for k, n in enumerate(lengths)], packing.PIECES)
    rows = packing.pack(items, node=node).collect()
    assert len(rows) == 3000
    alone = max(bins.best_fit(np.sort(lengths)[::-1], 2048)) + 1
    assert check(rows) <= more * alone


def test_items_that_never_fit_together(spark):
    items = spark.createDataFrame([(k, 0, 0, 1100, k) for k in range(900)], packing.PIECES)
    assert check(packing.pack(items, node=100).collect()) == 900


def test_no_documents(documents):
    assert packing.pack_documents(documents([(1, "x")]).where("doc_id = 2"), VOCABULARY).count() == 0


def test_sequences_hold_the_ids(documents):
    docs = documents([(k, t) for k, t in enumerate(TEXTS)])
    got = packing.sequences(docs, VOCABULARY).collect()
    whole = Tokenizer.from_file(VOCABULARY)
    want = Counter(i for t in TEXTS for i in whole.encode(t, add_special_tokens=False).ids + [0])
    assert Counter(i for r in got for i in r["ids"]) == want
    assert all(len(r["ids"]) <= 2048 for r in got)


def test_tasks_need_no_package_on_the_executors(tmp_path):
    """Workers start in another folder without this package on their path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    script = """
import sys; sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("op3_suffix_dedup", "op5_quality_classifier", "op6_rlz_dedup", "op9_jaccard_join", "op10_pack"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    repo = str(Path(__file__).resolve().parent.parent.parent)
    done = subprocess.run([sys.executable, "-c", script, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.stdout.count("True") == 5, done.stderr[-2000:]
