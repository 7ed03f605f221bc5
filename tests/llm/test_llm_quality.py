"""Mixing, quality rules, classifier, surrogates and the queries with SQL."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from compare import connect, differences, expected_of
from conftest import SMALL
from llm import samples
from pyspark.sql import functions as F

from strikelens.llm import classifier, mixing, quality_rules, surrogates
from strikelens.llm.oracles import ORACLE_SQL
from strikelens.llm.queries import QUERIES
from strikelens.runtime import stage


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    actual = QUERIES[name](spark, SMALL).toArrow()
    connection = connect(SMALL, ["documents", "labels", "conversations"])
    assert differences(actual, expected_of(connection, ORACLE_SQL[name])) == ""


# ---- mixing


def level_targets(sizes, weights, total):
    """Deals out the excess again and again."""
    targets, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * unit >= 2 * sizes[s]}
        if not full:
            targets |= {s: weights[s] * unit for s in open_}
            break
        targets |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return targets


def test_mixing(spark):
    docs = samples.documents(spark)
    rows = mixing.plan(docs).collect()
    assert len(rows) == docs.count()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len(samples.WORD.findall(r.text or ""))
        sizes[r.source] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    expected = level_targets(sizes, weights, 1.5 * sum(sizes.values()))
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        assert r.target / r.source_size - 1 < r.copies < r.target / r.source_size + 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert Counter(map(repr, mixed.collect())) == Counter(map(repr, mixing.mix(docs).collect()))
    assert mixing.plan(samples.empty(spark)).count() == 0


# ---- quality rules


def expected_counts(text):
    words = samples.WORD.findall(text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(k, k + 8))
    lines = [line for line in (text or "").split("\n") if samples.WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in quality_rules.SYMBOLS for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_quality_rules(spark):
    docs = samples.documents(spark)
    judged = quality_rules.judge(docs).collect()
    assert len(judged) == docs.count()
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(r.text)
    for r in judged:
        if len(texts[r.doc_id]) == 1:
            (text,) = texts[r.doc_id]
            expected = expected_counts(text)
            assert {k: r[k] for k in expected} == expected
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.posterior >= 0.5)
    assert quality_rules.judge(samples.empty(spark)).count() == 0


def test_kept_rows_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("digest", F.lit("d"))
    kept = quality_rules.filter_documents(docs)
    judged = {(r.doc_id, r.n_words) for r in quality_rules.judge(docs).filter("kept").collect()}
    rows = kept.collect()
    assert kept.columns == docs.columns and rows
    assert {(r.doc_id, len(samples.WORD.findall(r.text or ""))) for r in rows} == judged
    assert quality_rules.filter_documents(samples.empty(spark)).count() == 0


def test_posteriors_against_plain_python(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.gauss(1 if i % 3 else -2, 1.5), f"h{i % 4}" if i % 7 else None, f"p{i % 2}" if i % 5 else None) for i in range(300)]
    rows += [(300, -1.0, "alone", "p0"), (300, -1.0, "alone", "p0"), (None, 2.0, "new", None)]
    scored = spark.createDataFrame(rows, "doc_id long, evidence double, source string, lang string")
    sites = stage(classifier.site_posteriors(scored), "sites")
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    logit = lambda p: math.log(min(max(p, 1e-4), 1 - 1e-4) / (1 - min(max(p, 1e-4), 1 - 1e-4)))
    paths, hosts = defaultdict(list), defaultdict(list)
    for _, evidence, host, path in rows:
        paths[host, path].append(sigmoid(evidence))
        hosts[host].append(sigmoid(evidence))

    def strength(groups):
        """Groups by what is above them; the variance of their means, less what chance explains."""
        members = [g for parent in groups.values() for g in parent]
        n, inside = sum(map(len, members)), sum(sum(x * x for x in g) - sum(g) ** 2 / len(g) for g in members)
        between = spread = 0.0
        for parent in groups.values():
            whole = sum(map(len, parent))
            between += sum(sum(g) ** 2 / len(g) for g in parent) - sum(map(sum, parent)) ** 2 / whole
            spread += whole - sum(len(g) ** 2 for g in parent) / whole
        noise = inside / (n - len(members))
        variance = (between - (len(members) - len(groups)) * noise) / spread
        return 10_000.0 if variance <= 0 else min(10_000.0, max(2.0, noise / variance))

    nested = defaultdict(list)
    for (host, _), g in paths.items():
        nested[host].append(g)
    prior = sum(map(sum, hosts.values())) / len(rows)
    by_host, by_path = strength({None: list(hosts.values())}), strength(nested)
    for r in classifier.judge(scored, sites).collect():
        h, g = hosts[r.source], paths[r.source, r.lang]
        host_quality = (sum(h) + by_host * prior) / (len(h) + by_host)
        path_quality = (sum(g) + by_path * host_quality) / (len(g) + by_path)
        odds = r.evidence + min(max(logit(path_quality) - logit(prior), -2.0), 2.0)
        assert (r.host_quality, r.path_quality, r.quality) == pytest.approx((host_quality, path_quality, sigmoid(odds)))
        assert r.kept == (r.quality >= 0.5)


def test_expectation_maximisation_finds_the_rules_that_are_right(spark):
    import random

    rnd = random.Random(1)
    rows = Counter()
    for _ in range(4000):
        good = rnd.random() < 0.8
        # two rules see what is bad, one is a coin
        votes = [(1 if rnd.random() < 0.98 else -1) if good else (-1 if rnd.random() < 0.8 else 1) for _ in range(2)]
        rows[(*votes, rnd.choice((1, 0)))] += 1
    table = spark.createDataFrame([(*k, n) for k, n in rows.items()], "a int, b int, c int, n long")
    chances, share = quality_rules.fit(table, ["a", "b", "c"])
    found = quality_rules.accuracies(chances, share)
    assert abs(share - 0.8) < 0.1 and found["a"] > 0.85 and found["b"] > 0.85
    assert chances["c"][1][0] / chances["c"][1][1] < 1.3


def test_rules_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged = QUERIES["op10_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    found = Counter((r.quality, r.kept) for r in judged.filter("NOT base_failed").collect())
    assert found[1, False] <= 0.02 * found[1, True] and found[0, True] <= 0.2 * (found[0, True] + found[0, False])


# ---- classifier


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 4000")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = classifier.classify(docs, labels.filter(seen)).join(labels.filter(~seen).selectExpr("doc_id", "quality AS truth"), "doc_id")
    found = Counter((r.truth, r.kept) for r in judged.collect())
    assert found[1, True] / (found[1, True] + found[1, False]) > 0.97
    assert found[0, False] / (found[0, True] + found[0, False]) > 0.9


def test_classifier_stands_awkward_rows(spark):
    docs = samples.documents(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (5, None, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    judged = classifier.classify(docs, labels)
    assert judged.count() == docs.count() and judged.filter("quality IS NULL OR kept IS NULL").isEmpty()
    kept = classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == judged.filter("kept").count()
    # nothing to learn from: nothing is rejected
    assert classifier.keep_good(docs, labels.filter("quality = 1")).count() == docs.count()
    assert classifier.classify(samples.empty(spark), labels).count() == 0


def test_sparse_sites_shrink_to_what_is_above(spark):
    rows = [("big", "a", 3.0)] * 400 + [("big", "b", -3.0)] * 400 + [("poor", "a", -3.0)] * 300 + [("tiny", "a", -3.0)]
    scored = spark.createDataFrame(rows, "source string, lang string, evidence double")
    found = {(r._q_host, r._q_path): r for r in classifier.site_posteriors(scored).collect()}
    prior = found["tiny", "a"].prior
    bad = 1 / (1 + 2.718281828**3)
    assert abs(found["poor", "a"].host_quality - bad) < 0.05
    assert abs(found["tiny", "a"].host_quality - prior) < abs(found["tiny", "a"].host_quality - bad)
    assert found["big", "a"].path_quality > 0.9 > 0.1 > found["big", "b"].path_quality


# ---- surrogates


def test_surrogates(spark):
    rows = [
        (1, "Mrs. Anna Meier met Mr. Bond, Herr Иван and (212) 555-0199; +49 30 1234567. Mail ÄNNA.x@Foo.Org änna.x@foo.org"),
        (2, None), (3, ""), (4, "clean text, 12.5 and 2024-01-02, v1.2.3 and 1.2.3.4.5"), (None, "+1 (212) 555-0199 or +12125550199"),
        (5, 'token = "11acdfb36bb72224148e6160f674b4be45601bff", 4465758382889437 4465758382889437 on 127.5.221.1###'),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_entities string")
    found = {r.doc_id: r for r in surrogates.replace(docs).collect()}
    assert len(found) == len(rows) and found[2].text is None and found[3].text == "" and found[4].text == rows[3][1]
    people = re.fullmatch(
        r"Mrs\. (\w+na) (\w+) met Mr\. (\w+ron), Herr (\w+) and (\(\d{3}\) \d{3}-\d{4}); (\+\d\d \d\d \d{7})\. Mail (\S+) (\S+)", found[1].text
    )
    assert people and re.fullmatch("[А-я]+", people[4]) and people[4].endswith("рон")
    assert people[7].lower() == people[8] and people[8].endswith(".org") and people[8] != "änna.x@foo.org"
    a, b = found[None].text.split(" or ")
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) != "12125550199"
    secret = re.fullmatch(r'token = "([0-9a-f]{40})", (4\d{15}) (4\d{15}) on ([\d.]+)###', found[5].text)
    assert secret and secret[2] == secret[3] != "4465758382889437" and all(int(x) < 256 for x in secret[4].split("."))
    assert surrogates.replace(samples.empty(spark)).count() == 0


def test_surrogates_in_long_texts(spark):
    many = 6_000
    shapes = ["x a@" + "b." * many + "com y", "a." * many + "@b.org", "Mr. " + "Dr. " * many + "Smith", "Mrs. A" + "b" * many, "1." * many, "+1" + " 12" * many]
    shapes += ["DE12" + " 1234" * many, 'token = "' + "a" * many + '"', "0" * many, "12-" * many, "(" * many, "@" * many, "A B" * many]
    docs = spark.createDataFrame(list(enumerate(shapes)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in surrogates.replace(docs).collect()}
    assert len(found) == len(shapes) and found[0] != shapes[0] and found[7] != shapes[7]
    assert found[10] == shapes[10] and found[11] == shapes[11]


def test_surrogates_stay_distinct(spark):
    # so many short numbers that first draws collide with each other and with those that occur
    rows = [(i, f"{i:03d}-{i % 7:02d}-{i:04d} and 10.0.{i // 200}.{i % 200}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = surrogates.draws(surrogates.entities(surrogates.occurrences(docs))).collect()
    assert len({(r.kind, r.new) for r in found}) == len(found) == 1800
    real = {(r.kind, r.canon) for r in found}
    assert not real & {(r.kind, r.new) for r in found}
    texts = [r.text for r in surrogates.replace(docs).collect()]
    assert len(set(texts)) == len(texts)


def test_small_spaces_of_surrogates_grow(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "GROWS_AFTER", 2)
    # more names of a gender and script than two syllables make, and formats in which everything or nothing can be drawn
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = ["".join(letters[n // 26**k % 26] for k in range(4)).capitalize() for n in range(10_000)]
    greek = ["".join("αβγδεζηθικλμνξοπ"[n // 16**k % 16] for k in range(4)).capitalize() for n in range(1500)]
    texts = [f"Mr {n} came" for n in names] + [f"Frau {n} kam" for n in greek]
    texts += [f"{a}@{b}.de" for a in letters for b in letters] + ["用户@例子.公司", 'key = "------------"', "ł@ł.pl"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = surrogates.draws(surrogates.entities(surrogates.occurrences(docs))).collect()
    assert len({(r.kind, r.new) for r in found}) == len(found) == len(texts)
    assert not {(r.kind, r.canon) for r in found} & {(r.kind, r.new) for r in found}
    assert all(re.fullmatch("m [a-z]+ron|f [α-ω]+να", r.new) for r in found if r.kind == "name")
    new = [r.text for r in surrogates.replace(docs).collect()]
    assert len(set(new)) == len(new) and not set(new) & set(texts)


FOUND = [
    # what is found, and how its surrogate looks
    ('TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"', 'TOKEN = "[0-9A-F]{40}"'),
    ('token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"', 'token = "[0-9a-f]{40}"'),
    ('PASSWORD: "Correct_Horse_Staple"', 'PASSWORD: "[A-Z][a-z]{6}_[A-Z][a-z]{4}_[A-Z][a-z]{5}"'),
    ("Dr. Meier kam", r"Dr\. [A-Z][a-z]+lin kam"),
    ("DR. MEIER KAM", r"DR\. [A-Z]+LIN [A-Z]+"),
    ("Frau Prof. Dr. Weber kam", r"Frau Prof\. Dr\. [A-Z][a-z]+na kam"),
    ("тут г-н Иванов сказал", "тут г-н [А-Я][а-я]+рон сказал"),
    ("Госпожа Петрова", "Госпожа [А-Я][а-я]+на"),
    ("η κυρία Παππά ήρθε", "η κυρία [Α-Ω][α-ω]+να ήρθε"),
    ("Δρ. Παππάς ήρθε", r"Δρ\. [Α-Ω][α-ω]+λιν ήρθε"),
    ("call 212 555 0199 now", r"call \d{3} \d{3} \d{4} now"),
    ("call 1-800-555-0199 now", r"call 1-\d{3}-\d{3}-\d{4} now"),
    ("ruf 030 1234567 an", r"ruf 0\d\d \d{7} an"),
    ("appelle 06 12 34 56 78.", r"appelle 0\d(?: \d\d){4}\."),
    ("ring 020 7946 0958, please", r"ring 0\d\d \d{4} \d{4}, please"),
    ("ruf 0049 30 1234567 an", r"ruf 004\d \d\d \d{7} an"),
    ("ruf +49 30 1234567 an", r"ruf \+4\d \d\d \d{7} an"),
]
CLEAN = ["Prof. Dr. h.c. kam", "I miss Paris", "on 05-02-2024 or 2024 05 02", "100 200 3000 400", "the keys: none", "0.5 0.25 012 345", "Drink Drachme"]


def test_forms_that_surrogates_find(spark):
    texts = [text for text, _ in FOUND] + CLEAN
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in surrogates.replace(docs).collect()}
    for i, (text, form) in enumerate(FOUND):
        assert re.fullmatch(form, found[i]) and found[i] != text, (text, found[i])
    assert [found[len(FOUND) + i] for i in range(len(CLEAN))] == CLEAN
    # the same entity in another way of writing
    assert found[0].lower() == found[1]
    assert re.sub(r"\D", "", found[15])[2:] == re.sub(r"\D", "", found[16])
