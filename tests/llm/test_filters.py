"""Secrets, decontamination, quality rules, URL filters, classifier: edge cases and what SQL does not show."""

import re

import pytest

from demandspark.llm import classifier, decontaminate, machine, quality_rules, secrets, url_filter
from demandspark.llm.common import fresh_path

KEY = "AKIA" + "B" * 16
SECRETS = [
    (1, f"é{KEY} and password = 'abcdef' token: token: abcdef"),
    (2, f"é{KEY} and password = 'abcdef' token: token: abcdef"),
    (3, None),
    (4, ""),
    (5, "PassWord=\"short\" api-key: nothing secret=" + "0123456789abcdef" * 2),
    (None, "-----BEGIN RSA PRIVATE KEY-----" + " gho_" + "a" * 36),
    (6, ("x" * 50 + " ") * 2000 + KEY),
]


def spans_of(df):
    return {(r["doc_id"], r["blob"]): [(s["start"], s["kind"], s["end"]) for s in r["spans"]] for r in df.collect()}


def python_spans(text):
    out = []
    for place, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), place, rule.kind, m.end()))
    return [(s, k, e) for s, _, k, e in sorted(out)]


def test_secrets_equal_python(documents):
    found = secrets.scan_paths(documents(SECRETS), ["doc_id"])
    rows = found.collect()
    texts = dict(SECRETS)
    assert len(rows) == len(SECRETS)
    for r in rows:
        assert [(s["start"], s["kind"], s["end"]) for s in r["spans"]] == python_spans(texts[r["doc_id"]])


def test_ledger_scans_only_what_is_new(spark, documents):
    ledger = fresh_path(spark, "ledger")
    first = spans_of(secrets.scan_paths(documents(SECRETS[:4]), ["doc_id"], ledger))
    pairs = spark.read.parquet(f"{ledger}/pairs").count()
    assert pairs == 2 * len(secrets.RULES)  # two different texts
    assert secrets.unseen(documents(SECRETS[:4]), ledger, secrets.RULES).count() == 0
    assert secrets.unseen(documents(SECRETS), ledger, secrets.RULES).count() == 3
    again = spans_of(secrets.scan_paths(documents(SECRETS), ["doc_id"], ledger))
    assert all(again[k] == v for k, v in first.items())
    newer = (secrets.Rule("access", r"AKIA[A-Z0-9]+", 0, 21, version=2),) + secrets.BASE[:1]
    todo = secrets.unseen(documents(SECRETS), ledger, newer).select("todo").distinct().collect()
    assert [r["todo"] for r in todo] == [["access:2"]]
    changed = spans_of(secrets.scan_paths(documents(SECRETS), ["doc_id"], ledger, newer))
    assert not any(kind == "access" for spans in changed.values() for _, kind, _ in spans)


def test_a_wider_version_finds_more(spark, documents):
    ledger = fresh_path(spark, "ledger")
    docs = documents([(1, "x " + "0123456789abcdef" + " y"), (2, "deadbeef00"), (3, "z" * 9)])
    assert not any(spans_of(secrets.scan_paths(docs, ["doc_id"], ledger)).values())
    wider = (secrets.Rule("hex", "[0-9a-f]+", 0, 16, version=2), secrets.Rule("hex", "[0-9a-f]+", 0, 12, version=3))
    found = {i: spans for (i, _), spans in spans_of(secrets.scan_paths(docs, ["doc_id"], ledger, wider[:1])).items()}
    assert found == {1: [(2, "hex", 18)], 2: [], 3: []}
    both = documents([(4, "0123456789abc")])
    assert [r["version"] for r in secrets.scan(both.select("text"), fresh_path(spark, "ledger"), wider).collect()] == [3]


def test_mask(documents):
    found = secrets.scan_paths(documents(SECRETS), ["doc_id"])
    masked = {r["doc_id"]: r["m"] for r in found.select("doc_id", secrets.masked(found.text, found.spans).alias("m")).collect()}
    for doc_id, text in SECRETS:
        out, upto = "", 0
        for start, _, end in python_spans(text):
            out += (text[upto:start] + "[secret]") if start >= upto else ""
            upto = max(upto, end)
        assert masked[doc_id] == (None if text is None else out + text[upto:])


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "rare Pair"), (3, None), (4, "..."), (None, "null item"), (2, "rare Pair")]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, w string")


CONTAMINATED = [
    (1, "so ALPHA, beta gamma-delta epsilon zeta eta theta iota kappa lambda. No"),
    (1, "so ALPHA, beta gamma-delta epsilon zeta eta theta iota kappa lambda. No"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (3, "a rare pair, and a rare pair null item"),
    (4, None),
    (5, ""),
    (None, "rare pair"),
    (6, "RARE É pair"),
]


def test_decontamination(documents, benchmark):
    docs = documents(CONTAMINATED)
    rows = {r["doc_id"]: r for r in decontaminate.contamination(docs, benchmark).collect()}
    assert {i: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for i, r in rows.items()} == {
        1: (13, 11, ["1"], True),
        2: (9, 0, [], False),
        3: (9, 6, ["2"], True),
        4: (0, 0, [], False),
        5: (0, 0, [], False),
        None: (2, 2, ["2"], True),
        6: (3, 0, [], False),
    }
    assert [(s["start"], s["end"]) for s in rows[3]["spans"]] == [(1, 3), (5, 9)]
    clean = decontaminate.remove_documents(docs, benchmark)
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 4, 5, 6] and clean.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert texts[1] == "so. No"[:2] + " No" or texts[1] == "so. No"
    assert texts[3] == "a, and a" and texts[2] == CONTAMINATED[2][1] and texts[4] is None


def test_decontamination_in_blocks(documents, benchmark, monkeypatch):
    whole = sorted(map(str, decontaminate.contamination(documents(CONTAMINATED), benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 2)
    assert sorted(map(str, decontaminate.contamination(documents(CONTAMINATED), benchmark).collect())) == whole
    nothing = decontaminate.contamination(documents(CONTAMINATED), benchmark.where("item_id = 77"))
    assert not any(r["contaminated"] for r in nothing.collect())


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return [" ".join("t%d" % rng.randrange(5000) for _ in range(12)) for _ in range(n)]


def test_boilerplate_depletes_but_copies_do_not(documents):
    shared = "Menu  Home ABOUT contact"
    rows = [(k, "\n".join([*prose(k, 2), shared, *prose(1000 + k, 2)])) for k in range(30)]
    rows += [(100 + k, "\n".join(prose(77, 4))) for k in range(40)]  # copies of one text
    rows += [(200 + k, "\n".join([*prose(88, 4), "edit %d" % k])) for k in range(40)]  # near copies
    rows += [(300, "\n".join([shared.lower(), "menu home about  contact"] * 6)), (301, None), (302, ""), (303, "few words")]
    docs = documents(rows)
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert all(judged[k]["n_boilerplate_words"] == 4 and judged[k]["kept"] for k in range(30))
    assert all(judged[k]["n_boilerplate_words"] == 0 and judged[k]["kept"] for k in (*range(100, 140), *range(200, 240)))
    assert judged[300]["n_boilerplate_words"] == 48 and not judged[300]["kept"]
    assert all(judged[k]["base_failed"] and not judged[k]["kept"] for k in (301, 302, 303))
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 110
    texts = {r["doc_id"]: r["text"] for r in quality_rules.without_boilerplate(docs).collect()}
    assert texts[3] == rows[3][1].replace(shared + "\n", "") and texts[100] == rows[30][1]


def test_fixed_places_and_passages_are_boilerplate(documents):
    header, footer = "Site header with seven words in it", "site footer and nothing after it"
    licence = ["Licensed under the terms of some licence,", "see the notice for all its details."]
    rows = [(k, "\n".join([header, *prose(k, 2), *licence, *prose(1000 + k, 2), footer])) for k in range(30)]
    rows += [(50, "\n".join([header, *licence, "three own words", footer]))]  # depleted
    docs = documents(rows)
    assert [r["n_docs"] for r in quality_rules.boilerplate(docs).collect()] == [31] * 4
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert all(judged[k]["n_boilerplate_words"] == 27 and judged[k]["kept"] for k in range(30))
    assert judged[50]["n_boilerplate_words"] == 27 and not judged[50]["base_failed"] and not judged[50]["kept"]
    texts = {r["doc_id"]: r["text"] for r in quality_rules.without_boilerplate(docs).collect()}
    assert texts[4] == "\n".join([*prose(4, 2), *prose(1004, 2)])


def test_a_large_family_counts_once(documents):
    """Also where each copy has an edit of its own, in another line."""
    base = [line.split() for line in prose(99, 20)]
    rows = []
    for k in range(150):
        words = [list(line) for line in base]
        words[k % 20][k % 12] = "edit%d" % k
        rows.append((k, "\n".join(map(" ".join, words))))
    docs = documents(rows)
    assert quality_rules.common_lines(docs, "source", 10, 0.005).count() == 20
    assert quality_rules.boilerplate(docs).count() == 0
    assert all(r["kept"] for r in quality_rules.judge(docs).collect())


def test_quality_edges(documents):
    repeat = "a b c d e f g h i j k l m n o p q r s t u v w x y z "
    rows = [(1, repeat * 2), (1, repeat * 2), (None, "#a *b\n#a *b\n \n"), (2, "x" * 100_000 + " y" * 3000)]
    got = sorted((r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality_rules.judge(documents(rows)).collect())
    assert got == [(0, 4, 8, 4, 1, 0, True), (1, 52, 52, 0, 0, 52, True), (1, 52, 52, 0, 0, 52, True), (2, 3001, 103_000, 0, 0, 3000, True)]
    assert quality_rules.judge(documents(rows).where("doc_id = 9")).count() == 0


def test_urls(spark):
    rows = [
        (1, "https://www.Example.com/en/x?y#z"),
        (2, "http://a.example.com/en/"),
        (3, "http://a.example.com/en"),
        (4, "http://example.org/en/"),
        (5, None),
        (6, "example.com/en/"),
        (7, "x://net/es/"),
        (8, "x://a.net?/es/"),
        (9, "http://notexample.com/en/a"),
        (10, "http://" + "a." * 300 + "net/fr/" + "b" * 5000),
        (None, "http://b.com/"),
        (1, "http://c.net/fr/"),
        (1, "http://c.net/fr/"),
        (11, ""),
        (12, "http://www.example.com:80/en/"),
        (13, "a://b://c.com/"),
    ]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, rule string, host string")
    got = {(r["page_id"], r["host"]): (r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages).collect()}
    assert len(got) == 15
    assert got[1, "www.example.com"] == ("/en/x", "www.example.com/en/", "allow")
    assert got[2, "a.example.com"] == ("/en/", "example.com/en/", "block")
    assert got[3, "a.example.com"] == ("/en", "com/", "allow")
    assert got[4, "example.org"] == ("/en/", None, "allow")
    assert got[5, ""] == got[6, ""] == got[11, ""] == ("", None, "allow")
    assert got[7, "net"] == ("/es/", "net/es/", "block")
    assert got[8, "a.net"] == ("", None, "allow")
    assert got[9, "notexample.com"] == ("/en/a", "com/", "allow")
    assert got[10, "a." * 300 + "net"][1:] == ("net/fr/", "block")
    assert got[None, "b.com"] == ("/", "com/", "allow")
    assert got[1, "c.net"] == ("/fr/", "net/fr/", "block")
    assert got[12, "www.example.com:80"] == ("/en/", None, "allow")
    assert got[13, "b:"] == ("//c.com/", None, "allow")
    assert {r["verdict"] for r in url_filter.filter_urls(pages, [], "block").collect()} == {"block"}
    assert url_filter.filter_urls(pages.where("page_id = 99")).count() == 0


def test_many_rules_are_not_broadcast(spark, monkeypatch):
    pages = spark.createDataFrame([(k, f"http://h{k % 7}.com/p{k}/q") for k in range(50)], "page_id long, url string")
    rules = spark.createDataFrame([(f"h{k}.com/p{j}/", "block") for k in range(7) for j in range(0, 50, 3)], "rule string, verdict string")
    few = sorted(map(str, url_filter.filter_urls(pages, rules).collect()))
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 1)
    assert sorted(map(str, url_filter.filter_urls(pages, rules).collect())) == few
    assert sum("block" in r for r in few) == 17


def test_classifier_on_held_out_rows(spark):
    from demandspark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op5_quality_classifier"](spark, folder).collect()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r["score"], r["predicted"], quality[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert all(0 <= s <= 1 and p == (s >= 0.3) for s, p, _ in held)
    good, bad = ([s for s, _, q in held if q == v] for v in (1, 0))
    assert sum(a > b for a in good for b in bad) >= 0.97 * len(good) * len(bad)
    assert sum(p == q for _, p, q in held) >= 0.95 * len(held)


def test_classifier_edges(spark, documents):
    docs = documents([(1, "good text here"), (2, None), (3, ""), (None, "x " * 100_000), (1, "again")])
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    model = classifier.train(docs, labels)
    scores = classifier.score(docs, model).collect()
    assert len(scores) == 5 and all(0 <= r["score"] <= 1 for r in scores)
    nothing = classifier.train(docs, labels.where("doc_id = 99"))
    assert {round(r["score"], 6) for r in classifier.score(docs, nothing).collect()} == {0.5}
    assert classifier.score(docs.where("doc_id = 99"), nothing).count() == 0


def test_pairwise_identity():
    """The score equals the sum over all pairs."""
    import numpy as np

    rng = np.random.default_rng(0)
    size = machine.slots_of(["n"])
    model = 0.3, rng.normal(0, 0.1, size), rng.normal(0, 0.1, (size, machine.FACTORS))
    idx, x = machine.features("Some words | and 12 more!".encode(), [25.0])
    z = model[0] + model[1][idx] @ x + sum(float(model[2][i] @ model[2][j]) * x[a] * x[b] for a, i in enumerate(idx) for b, j in enumerate(idx) if a < b)
    assert abs(machine.score_text("Some words | and 12 more!".encode(), [25.0], model) - 1 / (1 + np.exp(-z))) < 1e-6
