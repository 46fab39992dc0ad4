import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use for results or on the way
CLASHES = "n_words spans shard slot kept item_ids text_key host id key data blob set component w at _id _key n h hits row others changed".split()


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns of clashing names."""

    def make(pairs):
        df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs], DOCS)
        return df.withColumns({name: F.lit("x") for name in CLASHES})

    return make


@pytest.fixture(scope="session")
def corpus():
    """Random prose with exact copies, near copies in chains, a shared passage, repeats and odd texts."""
    rng = random.Random(5)
    vocabulary = ["w%d" % k for k in range(400)] + ["Ünd", "É", "the", "of", "a"] * 20
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = prose(70)
    texts = []
    for k in range(40):
        words = prose(rng.randrange(20, 250))
        if k % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passage
        texts.append(words)
    for k in range(12):
        texts.append(list(texts[k]))  # copies
    base = prose(200)
    for _ in range(15):  # each one an edit further from the first
        base = list(base)
        base[rng.randrange(len(base))] = rng.choice(vocabulary)
        texts.append(base)
    texts.append(prose(60) * 3)
    out = [(i, ("\n" if i % 5 else " ").join([" ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :])])) for i, words in enumerate(texts)]
    out += [(900, None), (901, ""), (902, "  \n\t"), (903, "one"), (904, "One"), (905, "two words"), (906, "é" * 300), (907, "aé" * 400), (908, "ab " * 200)]
    rng.shuffle(out)
    return out
