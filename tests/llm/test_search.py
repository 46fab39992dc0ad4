"""Resampling, lexical search and SimHash against brute force, and their edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from demandspark.llm import lexical, resampling, simhash, trie

from . import brute

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def terms(text):
    return WORD.findall(lower(text))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "The of a w1 w2 w3 w3"), (2, "Ünd é w10, w11; w12"), (3, None), (4, ""), (5, "nowhere"), (None, "w5 w6"), (7, "w5 w6")]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, score string")


def runs(text):
    w = terms(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def test_resampling_equals_brute_force(documents, corpus, items):
    size = 50
    bucket = lambda f: zlib.crc32(f.encode()) % size
    source, target = Counter(), Counter()
    for _, t in corpus:
        source.update(map(bucket, runs(t)))
    for r in items.collect():
        target.update(map(bucket, runs(r["text"])))
    S, T = sum(source.values()), sum(target.values())
    gain = {k: math.floor(1000 * math.log((target[k] + 1) * (S + size) / ((source[k] + 1) * (T + size)))) for k in range(size)}
    want, able = {}, []
    for i, t in corpus:
        f = runs(t)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want[i] = [len(terms(t)), len(f), weight, score, None]
        if len(terms(t)) >= 20:
            able.append((-score, i))
    for rank, (_, i) in enumerate(sorted(able)[: 25 * len(able) // 100], 1):
        want[i][4] = rank
    got = resampling.resample(documents(corpus), items, size=size).collect()
    assert {r["doc_id"]: [r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]] for r in got} == want


@pytest.mark.parametrize("n", [1, 3])
def test_runs_of_other_lengths(documents, items, n):
    rows = [(1, "a B c-d"), (2, "--"), (3, "é1")]
    got = {r["doc_id"]: r["n_features"] for r in resampling.resample(documents(rows), items, n=n).collect()}
    assert got == {1: sum(max(0, 4 - k) for k in range(n)), 2: 0, 3: 1}


def test_resampling_edges(documents, items):
    long = " ".join("w%d" % (k % 977) for k in range(300_000))
    rows = [(None, None), (None, "é " * 30), (1, ""), (2, "a " * 30), (2, "a " * 30), (3, long), (4, "b " * 25)]
    got = sorted(((r["doc_id"], r["n_words"], r["n_features"], r["rank"]) for r in resampling.resample(documents(rows), items, share=100).collect()), key=repr)
    assert [g[:3] for g in got] == sorted([(None, 0, 0), (None, 30, 59), (1, 0, 0), (2, 30, 59), (2, 30, 59), (3, 300_000, 599_999), (4, 25, 49)], key=repr)
    assert sorted(g[3] for g in got if g[3]) == [1, 2, 3, 4, 5]
    assert resampling.resample(documents(rows).where("false"), items).count() == 0
    assert resampling.resample(documents(rows), items.where("false")).count() == 7
    wide = resampling.resample(documents(rows), items, size=1 << 17).collect()
    assert sum(r["n_features"] for r in wide) == sum(g[2] for g in got)


def best_documents(rows, items, top):
    words = [(i, Counter(terms(t))) for i, t in rows]
    total, length = sum(1 for _, c in words if c), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for i, c in words:
            m = 100 - 50 + (50 * sum(c.values()) * total) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i if i is not None else 2**63))
        for rank, (score, i) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, i if i < 2**63 else None, -score] += 1
    return out


@pytest.mark.parametrize("top", [1, 7, 500])
def test_search_equals_brute_force(documents, corpus, items, top):
    rows = [*corpus, (None, "w5 w6 w5"), (907, "w1 w2"), (907, "w1 w2")]
    got = Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(documents(rows), items, top).collect())
    assert got == best_documents(rows, [(r["item_id"], r["text"]) for r in items.collect()], top)


def test_search_in_blocks_of_items_and_documents(documents, corpus, items, monkeypatch):
    want = Counter(lexical.search(documents(corpus), items, 9).collect())
    monkeypatch.setattr(lexical, "ITEM_TERMS", 5)
    monkeypatch.setattr(lexical, "BLOCK", 1)
    assert Counter(lexical.search(documents(corpus), items, 9).collect()) == want


def test_search_edges(documents, items):
    long = "w1 " * 400_000
    rows = [(1, None), (2, ""), (3, long), (4, "w1"), (4, "w1"), (None, "W1")]
    got = [tuple(r) for r in lexical.search(documents(rows), items).orderBy("item_id", "rank").collect()]
    assert [g[:3] for g in got] == [(1, 1, 3), (1, 2, 4), (1, 3, 4), (1, 4, None)] or [g[2] for g in got][:3] == [4, 4, None]
    assert lexical.search(documents(rows).where("false"), items).count() == 0
    assert lexical.search(documents(rows), items.where("false")).count() == 0
    assert lexical.search(documents([(1, None), (2, "--")]), items).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_trie_finds_what_a_scan_finds_and_scores_less(seed):
    rng = np.random.default_rng(seed)
    n, v, top = 700, 40, 10
    weight = rng.integers(0, 5000, v)
    sizes = rng.integers(0, 12, n)
    sizes[sizes == 0] = 1
    ranks = [np.sort(rng.choice(v, s, replace=False, p=np.arange(v, 0, -1) / (v * (v + 1) / 2))) for s in sizes]
    for k in range(300):  # equal vectors, more than a leaf holds
        ranks[k] = ranks[0]
    sizes = np.array([len(r) for r in ranks])
    tf = rng.geometric(0.6, int(sizes.sum()))
    ids, m = rng.permutation(n), rng.integers(50, 400, n)
    tree = trie.Trie(ids, m, sizes, np.concatenate(ranks), tf, weight)
    assert sum(tree.high[k] - tree.low[k] for k in tree.leaves) == n
    starts = np.cumsum(sizes) - sizes
    scored = 0
    for _ in range(20):
        item = rng.choice(v, 4, replace=False)
        best = trie.Best(top)
        scored += tree.search(item, best)
        scores = np.array([sum(weight[r] * (1_000_000_000 * t // (1000 * t + 20 * m[i])) for r, t in zip(ranks[i], tf[starts[i] : starts[i] + sizes[i]]) if r in item) for i in range(n)])
        order = np.lexsort((ids, -scores))[:top]
        order = order[scores[order] > 0]
        assert list(zip(best.scores, best.ids)) == list(zip(scores[order], ids[order]))
    assert scored < 20 * n


def fingerprint(text):
    words = brute.SPACE.findall(lower(text))
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + size]).encode(), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(prints, reach):
    """Component by fingerprint of (id, fingerprint) rows."""
    root = {f: f for f in set(prints)}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(root, 2):
        if (a ^ b).bit_count() <= reach:
            root[find(a)] = find(b)
    return {f: find(f) for f in root}


def test_simhash_equals_brute_force(documents, corpus):
    prints = {i: fingerprint(t) for i, t in corpus}
    component = reachable(prints.values(), 4)
    least = {c: min(i for i, f in prints.items() if component[f] == c) for c in component.values()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents(corpus)).collect()}
    assert got == {i: (f"{f:016x}", least[component[f]]) for i, f in prints.items()}


@pytest.mark.parametrize("seed,reach,pending", [(1, 4, 2), (2, 4, 0), (3, 3, 2), (4, 6, 0)])
def test_links_of_crowded_fingerprints(spark, seed, reach, pending, monkeypatch):
    """Fingerprints a few bits from few centres, in chains too: crowded cells, rounds of hubs, no lost link."""
    monkeypatch.setattr(simhash, "PENDING", pending)
    rng = random.Random(seed)
    prints = set()
    for _ in range(4):
        now = rng.getrandbits(64)
        for _ in range(120):
            if rng.random() < 0.3:
                now ^= sum(1 << b for b in rng.sample(range(64), 3))
            prints.add(now ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))))
    want = reachable(prints, reach)
    points = spark.createDataFrame([(simhash.signed(f),) for f in prints], "fp long")
    found = {r["node"]: r["component"] for r in simhash.linked(points, reach).collect()}
    ours = {f: found.get(simhash.signed(f), simhash.signed(f)) for f in prints}
    pairs = lambda c: {frozenset((a, b)) for a, b in combinations(sorted(c), 2) if c[a] == c[b]}
    assert pairs(ours) == pairs(want)


def test_simhash_edges(documents):
    long = " ".join("w%d" % (k % 9973) for k in range(200_000))
    rows = [(None, None), (5, ""), (6, " \n"), (7, "one"), (7, "one"), (8, "ONE"), (9, long), (None, long)]
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents(rows)).collect()), key=repr)
    zero = [g for g in got if g[1] == "0" * 16]
    assert len(got) == 8 and sorted(g[0] is None for g in zero) == [False, False, True] and {g[2] for g in zero} == {5}
    assert {g[2] for g in got if g[0] in (7, 8)} == {7} and [g[2] for g in got if g[1] == f"{fingerprint(long):016x}"] == [9, 9]
    assert simhash.near_duplicates(documents(rows).where("false")).count() == 0
