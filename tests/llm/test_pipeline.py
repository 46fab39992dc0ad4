"""The pipeline's stages, each against a plain statement of its effect on its own input."""

import re

import corpus_pipeline

from demandspark.llm import packing, secrets

from . import brute

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs.cache()
        after = stage(spark, docs, FOLDER).cache()
        outputs.append((docs, after))
        docs = after
    for before, after in outputs[:-1]:
        assert after.columns == columns

    before, after = outputs[0]
    kept = {r["doc_id"] for r in after.collect()}
    for r in before.collect():
        words = brute.SPACE.findall(r["text"] or "")
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        assert (r["doc_id"] in kept) == (len(words) >= 20 and 100 * len(covered) <= 30 * len(words)), r["doc_id"]
    given = {r["doc_id"]: r for r in before.collect()}
    for r in after.collect():
        lines = iter(given[r["doc_id"]]["text"].split("\n"))
        assert r == given[r["doc_id"]] or all(line in lines for line in r["text"].split("\n"))  # cut lines only

    before, after = outputs[1]
    component, _ = brute.components([(r["doc_id"], r["text"]) for r in before.collect()], 80, 5)
    assert as_rows(after) == [r for r in as_rows(before) if component[r[0]] == r[0]]

    before, after = outputs[2]
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        words = WORD.findall(lower(r["text"]))
        n = min(10, len(words))
        windows |= {tuple(words[k : k + n]) for k in range(len(words) - n + 1) if n}
    clean = []
    for r in before.collect():
        words = WORD.findall(lower(r["text"]))
        if not any(tuple(words[k : k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words) - n + 1)):
            clean.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(clean)

    before, after = outputs[3]
    texts = {r["doc_id"]: r for r in after.collect()}
    assert len(texts) == before.count()
    for r in before.collect():
        hits = [m for rule in secrets.RULES for m in re.finditer(rule.pattern, r["text"]) if len(m.group(rule.group)) >= rule.least]
        assert ("[secret]" in texts[r["doc_id"]]["text"]) == bool(hits)
        assert all(m.group(rule.group) not in texts[r["doc_id"]]["text"] for rule in secrets.RULES[:3] for m in re.finditer(rule.pattern, r["text"]) if len(m.group(rule.group)) >= max(12, rule.least))
        if not hits:
            assert texts[r["doc_id"]] == r
        assert texts[r["doc_id"]]["n_chars"] == (len(texts[r["doc_id"]]["text"]) if hits else r["n_chars"])

    before, after = outputs[4]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}
    ran = corpus_pipeline.run(spark, FOLDER)
    assert ran.columns == after.columns and ran.count() == after.count()
    assert max(r["offset"] + r["length"] for r in ran.collect()) <= packing.LENGTH


def test_edge_rows_pass_through(documents, corpus, spark):
    docs = documents([*corpus, (None, None), (None, "a b c"), (1, None)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns
        assert after.count() <= docs.count()
        assert stage(spark, docs.where("false"), FOLDER).count() == 0


def test_near_duplicates_by_five_words(spark):
    """Also links what the thin operator's three words and 0.9 do not."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sets = {r["doc_id"]: brute.shingles(r["text"], 5) for r in docs.collect()}
    root = {i: i for i in sets}
    for a, b in ((a, b) for a in sorted(sets) for b in sorted(sets) if a < b and sets[a]):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {i: new if r == old else r for i, r in root.items()}
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect())
    assert kept == [i for i in sorted(root) if root[i] == i] and len(kept) == 187


def test_quality_cuts_boilerplate_lines(documents, spark):
    own = [" ".join("d%dw%d" % (k, j) for j in range(25)) for k in range(12)]
    docs = documents([(k, "Home  and Search\n" + text) for k, text in enumerate(own)] + [(50, "few words")])
    after = corpus_pipeline.quality(spark, docs, FOLDER)
    assert after.columns == docs.columns
    got = {r["doc_id"]: r for r in after.collect()}
    assert {i: r["text"] for i, r in got.items()} == dict(enumerate(own))
    assert all(r["n_chars"] == len(r["text"]) and r["others"] == "x" and r["source"] == "src0" for r in got.values())
