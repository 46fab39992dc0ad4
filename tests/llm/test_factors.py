"""Factor parsing and prefix doubling: many holders, small alphabets, texts over a segment, the factors themselves."""

import random

import numpy as np
import pyarrow as pa
import pytest

from demandspark.llm import doubling, factors, parse, rlz_dedup, stretches, suffix_dedup, symbols

from . import brute


def kept_words(rows, width):
    return {i: (len(words), " ".join(w for w, g in zip(words, gone) if not g)) for i, (words, gone) in brute.removed_words(rows, width).items()}


def holders(rng, unit, n):
    """One passage in many texts, cut at varied places, so that cores have many holders that agree to varied lengths."""
    passage = [rng.choice(unit) for _ in range(90)]
    rows = []
    for i in range(n):
        low, high = rng.randrange(40), rng.randrange(50, 91)
        before, after = ([rng.choice(unit) for _ in range(rng.randrange(60))] for _ in range(2))
        rows.append((i, before + passage[low:high] + after))
    return rows


@pytest.mark.parametrize("width, block", [(20, 6), (21, 5), (50, 10)])
def test_factors_of_a_passage_with_many_holders(documents, width, block):
    rng = random.Random(width)
    rows = [(i, " ".join(w)) for i, w in holders(rng, ["w%d" % k for k in range(60)], 50)]
    got = rlz_dedup.deduplicate(documents(rows), width, block).collect()
    assert {r["doc_id"]: (r["n_words"], r["text"]) for r in got} == kept_words(rows, width)


@pytest.mark.parametrize("seed", range(2))
def test_factors_over_two_words(documents, seed):
    """Few different words: blocks repeat everywhere, also within a text."""
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(70)))) for i in range(60)] + [(70, "a " * 90), (71, "a " * 40)]
    got = rlz_dedup.deduplicate(documents(rows), 12, 4).collect()
    assert {r["doc_id"]: (r["n_words"], r["text"]) for r in got} == kept_words(rows, 12)


def test_factors_name_their_reference(documents):
    """Each factor equals the words at its reference, and the longest piece is taken at a boundary."""
    rng = random.Random(4)
    word = lambda n: ["v%d" % rng.randrange(5000) for _ in range(n)]
    a, b = word(300), word(300)
    texts = {1: a, 2: b, 3: a[20:120] + b[100:180], 4: word(10) + a[100:170] + word(5), 5: a[:160] + word(3)}
    found = {r["id"]: [tuple(f) for f in r["factors"]] for r in rlz_dedup.parsed(documents([(i, " ".join(w)) for i, w in texts.items()])).collect()}
    assert {i: [(f[0], f[1], f[2]) for f in fs] for i, fs in found.items()} == {3: [(0, 100, 1), (100, 80, 2)], 4: [(10, 70, 1)], 5: [(0, 160, 1)]}
    for i, fs in found.items():
        for start, length, ref, _, ref_start in fs:
            assert ref < i and texts[i][start : start + length] == texts[ref][ref_start : ref_start + length]


def test_greedy_parse():
    """Diagonals that touch are one; at each boundary the piece that reaches furthest goes on; gaps are literals."""
    pieces = [(0, 60, 1, 7, 100), (50, 110, 1, 7, 150), (40, 95, 2, 8, 0), (100, 170, 3, 9, 5), (300, 350, 2, 8, 1), (300, 350, 1, 7, 1)]
    rows = pa.array([[dict(zip(parse.FIELDS, p)) for p in pieces], [], [dict(zip(parse.FIELDS, pieces[2]))]], pa.list_(pa.struct([(f, pa.int64()) for f in parse.FIELDS])))
    got = [[tuple(f.values()) for f in row] for row in parse.greedy(rows).to_pylist()]
    assert got == [[(0, 110, 1, 7, 100), (110, 60, 3, 9, 15), (300, 50, 1, 7, 1)], [], [(40, 55, 2, 8, 0)]]


@pytest.mark.parametrize("width, block", [(100, 32), (52, 12), (51, 10)])
def test_doubling_with_many_holders(documents, width, block):
    rng = random.Random(width)
    rows = [(i, "".join(w)) for i, w in holders(rng, ["é", "bc", "d ", "efg", "h"], 40)]
    rows += [(80, "xy" * 150), (81, "xy" * 60), (82, "z" * 250), (90, None), (91, "")]
    want = brute.removed_bytes(rows, width)
    for r in suffix_dedup.deduplicate(documents(rows), width, block).collect():
        data = (dict(rows)[r["doc_id"]] or "").encode()
        assert bytes(r["kept"]) == bytes(b for b, g in zip(data, want[r["doc_id"]]) if not g), r["doc_id"]


def test_rounds_drop_unique_prefixes(spark):
    rows = [(1, 1, 0, [1, 2, 3, 4]), (2, 1, 0, [1, 2, 3, 4]), (3, 1, 5, [1, 2, 3, 5]), (4, 1, 0, [9, 2, 3, 4]), (2, 1, 7, [1, 2, 3, 4])]
    positions = spark.createDataFrame(rows, "id long, key long, start long, names array<long>")
    assert sorted(tuple(r) for r in doubling.doubled(positions, 100).collect()) == [(2, 1, 0), (2, 1, 7)]
    assert [doubling.first_length(w) for w in (100, 52, 51, 25)] == [(25, 2), (13, 2), (51, 0), (25, 0)]


def test_stretches_agree_up_to_the_ends_of_texts():
    mine = stretches.laid_out([b"abCOREde", b"COREd"], np.array([2, 0]), 3, 4)
    other = stretches.laid_out([b"xbCOREdef", b"aCORXd"], np.array([2, 1]), 3, 4)
    l, r = stretches.agreement(mine, other, 3, 4)
    assert (l.tolist(), r.tolist()) == ([1, -1], [2, -1])


@pytest.mark.parametrize("width, block", [(50, 10)])
def test_cores_of_texts_over_a_segment(spark, monkeypatch, width, block):
    """Hashes and neighbours of cores are those of the whole text, wherever segments end."""
    rng = random.Random(8)
    data = " ".join("w%d" % rng.randrange(9) for _ in range(900)).encode()
    side, size, reach = factors.side_sizes(width, block)
    values = symbols.word_symbols(data)
    places = [0, 5, 31, 225, 226, 255, 256, 400, 500, 512, len(values) - size]
    asked = [{"at": a, "from": a, "n": 1, "rank": 1, "holders": 2, "is_ref": False} for a in places]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([data]), pa.array([asked])], ["id", "key", "data", "todo"])

    class Asked:
        def select(self, *_):
            return self

        def mapInArrow(self, work, _):
            return [row for out in work([batch]) for row in out.to_pylist()]

    whole = factors.context_rows(Asked(), symbols.word_symbols, width, block)
    monkeypatch.setattr(symbols, "SEGMENT", 256)
    cut = factors.context_rows(Asked(), lambda d: values, width, block)
    assert whole == cut and [r["at"] for r in whole] == places
    for r in whole:
        assert len(r["left"]) == min(reach, r["at"]) and len(r["right"]) == min(reach, len(values) - r["at"] - size)
