"""Suffix, substring and near-duplicate operators against brute force."""

import hashlib
import random

import numpy as np
import pytest

from demandspark.llm import jaccard, links, rlz_dedup, suffix_dedup, symbols

from . import brute


def test_suffix_dedup_equals_brute_force(documents, corpus):
    want = brute.removed_bytes(corpus)
    got = {r["doc_id"]: r for r in suffix_dedup.deduplicate(documents(corpus)).collect()}
    assert len(got) == len(corpus)
    for i, text in corpus:
        data, gone = (text or "").encode(), want[i]
        kept = bytes(b for b, g in zip(data, gone) if not g)
        starts = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == (len(data), sum(gone), starts, kept)


def test_rlz_dedup_equals_brute_force(documents, corpus):
    want = brute.removed_words(corpus)
    got = {r["doc_id"]: r for r in rlz_dedup.deduplicate(documents(corpus)).collect()}
    assert len(got) == len(corpus)
    for i, _ in corpus:
        words, gone = want[i]
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["text"]) == (len(words), sum(gone), kept)


@pytest.mark.parametrize("segment", [1 << 8, 1 << 10])
def test_long_texts_are_cut_without_loss(documents, monkeypatch, segment):
    """The segment is far below the texts' lengths: spans that cross it are found whole."""
    rng = random.Random(1)
    long = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 6) for _ in range(1200))
    rows = [(1, long), (2, "x " + long[500:4000] + " y"), (3, long[:1000])]
    pieces = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]

    def found(width):
        monkeypatch.setattr(symbols, "SEGMENT", 1 << 18)
        whole = [sorted(set(zip(*found_runs(p, width)))) for p in pieces]
        monkeypatch.setattr(symbols, "SEGMENT", segment)
        cut = [sorted(set(zip(*found_runs(p, width)))) for p in pieces]
        return whole, cut

    def found_runs(piece, width):
        starts, blocks_at = [], []
        for _, offsets, bounds, values in symbols.segments([piece.tobytes()], symbols.byte_symbols, width):
            text, start, count, _, block, _, _ = symbols.runs(bounds, values, width, 32)
            for t, s, c, b in zip(text, start, count, block):
                starts += range(offsets[t] + s, offsets[t] + s + c)
                blocks_at += [int(b)] * c
        return starts, blocks_at

    monkeypatch.setitem(symbols._powers, "up", ())
    whole, cut = found(100)
    assert whole == cut
    assert [len(w) for w in whole] == [len(p) - 99 for p in pieces]


def test_near_duplicates_equal_brute_force(documents, corpus):
    component, size = brute.components(corpus)
    got = jaccard.near_duplicates(documents(corpus)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (size[i], component[i]) for i, _ in corpus}


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_of_small_sets(documents, seed, monkeypatch):
    """Few words and few tokens: many candidates, sizes at the edge, tokens outside the counted share, more hubs."""
    monkeypatch.setattr(jaccard, "PENDING", 0.5)
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    base = [rng.choice("abcdefghijklmnop") for _ in range(60)]
    for i in range(60, 100):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(60)] = rng.choice("xyz")
        rows.append((i, " ".join(words)))
    component, _ = brute.components(rows)
    got = jaccard.near_duplicates(documents(rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == component


def test_one_of_each_keeps_the_smallest(documents):
    text = " ".join(map(str, range(60)))
    rows = [(5, text), (3, text + " x"), (9, "alone here now"), (None, text), (7, ""), (8, None)]
    kept = jaccard.one_of_each(documents(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8, 9]
    assert kept.columns == documents(rows).columns


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(129, 7), (500, 501), (600, 600)]
    random.Random(2).shuffle(edges)
    got = {r["node"]: r["component"] for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in (*range(41), *range(100, 130))} | {500: 500, 501: 500}
    assert got == want


def test_repeated_ids_and_nulls(documents):
    text = " ".join("v%d" % k for k in range(80))
    rows = [(1, text), (1, text), (1, text + " more"), (None, text), (None, None), (2, text)]
    words = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in rlz_dedup.deduplicate(documents(rows)).collect())
    assert words == [(False, 1, 80, 0), (False, 1, 80, 0), (False, 1, 81, 0), (False, 2, 80, 80), (True, 0, 0, 0), (True, 0, 80, 80)]
    size = len(text)
    parts = suffix_dedup.deduplicate(documents(rows)).collect()
    assert sum(r["n_removed"] >= size - 5 for r in parts) in (3, 4)  # the first of id 1 stays, by the hash of its text
    assert [r["n_removed"] for r in parts if r["doc_id"] == 2] == [size]
    near = jaccard.near_duplicates(documents(rows)).collect()
    assert {r["component_id"] for r in near if r["n_shingles"]} == {1}
    assert [r["component_id"] for r in near if not r["n_shingles"]] == [None]


def test_empty_tables(documents):
    empty = documents([(1, "x")]).where("doc_id = 0")
    assert suffix_dedup.deduplicate(empty).count() == 0
    assert rlz_dedup.deduplicate(empty).count() == 0
    assert jaccard.near_duplicates(empty).count() == 0


def test_query_digests(spark):
    """The registered queries' digest is that of the kept text."""
    from demandspark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op6_rlz_dedup"](spark, folder).where("n_removed = 0 and n_words > 0").limit(3).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in rows:
        joined = " ".join(brute.SPACE.findall(texts[r["doc_id"]]))
        assert r["kept_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
