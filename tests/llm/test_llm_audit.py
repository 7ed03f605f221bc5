"""MinHash components, filter audit and Merkle manifest against brute force."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm import samples
from llm.test_llm_dedup import expected_components, plain_rows
from pyspark.sql import functions as F

from strikelens.llm import blocks, filter_audit, merkle, minhash

# ---- near duplicates


@pytest.mark.parametrize("options", [{}, {"bands": 40, "rows": 1, "block": 3}])
def test_minhash(spark, options):
    docs = samples.documents(spark)
    found = minhash.join(docs, **options)
    assert found.count() == docs.count()
    expected = expected_components([row for row in plain_rows(docs) if row[0] is not None], 3, 85)
    for i, row in expected.items():
        row["kept"] = i == row["component_id"]
    assert samples.by_id(found.filter("doc_id IS NOT NULL")) == expected


def test_minhash_where_buckets_stay_mixed(spark):
    rnd = random.Random(5)
    base = samples.sentence(rnd, 60, 5000).split()
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(60)] = f"y{rnd.randrange(9999)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = {i: c["component_id"] for i, c in expected_components(rows, 3, 85).items()}
    assert 1 < len(set(expected.values())) < 90
    for options in ({"bands": 4, "rows": 1, "block": 7}, {"partners": (1, 2, None)}, {"partners": (None,), "block": 20}):
        assert {r.doc_id: r.component_id for r in minhash.join(docs, **options).collect()} == expected


def test_minhash_of_nothing_and_without_identifiers(spark):
    assert minhash.join(samples.empty(spark)).count() == 0
    rows = [(None, "a b c d"), (None, "A b  c d"), (7, "a b c d"), (7, "x"), (7, "x"), (None, None)]
    found = minhash.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(None, 2, 7, False)] * 2 + [(7, 2, 7, True), (7, 1, 7, True), (7, 1, 7, True), (None, 0, None, True)], key=repr
    )


def test_outlines_bound_what_sets_share():
    rnd = np.random.default_rng(4)
    for n in (1, 30, 400, 3000, 400_000):
        values = rnd.integers(-(2**63), 2**63 - 1, 2 * n, dtype=np.int64)
        for k in (0, n // 2, n):
            a, b = np.unique(values[:n]), np.unique(np.concatenate([values[:k], values[n : 2 * n - k]]))
            p, q = blocks.outline_batch(pa.array([1, 2]), [a, b]).to_pylist()
            bits = [np.bitwise_count(np.frombuffer(x["planes"], np.uint64) & np.frombuffer(p["planes"], np.uint64)).sum() for x in (p, q)]
            assert len(a) == bits[0] + p["beyond"] and len(np.intersect1d(a, b)) <= bits[1] + min(p["beyond"], q["beyond"])
            counts = [np.frombuffer(x["counts"], np.uint8).astype(int) for x in (p, q)]
            assert len(a) == counts[0].sum() + p["over"]
            assert len(np.intersect1d(a, b)) <= np.minimum(*counts).sum() + min(p["over"], q["over"])


def test_bins_agree_as_often_as_sets_are_alike():
    sketcher, rnd = minhash.Sketcher(), np.random.default_rng(3)
    for n in (12, 40, 900):
        agree = []
        for _ in range(60):
            values = rnd.integers(-(2**63), 2**63 - 1, 2 * n, dtype=np.int64)
            k = n * 11 // 12
            a, b = np.unique(values[:n]), np.unique(np.concatenate([values[:k], values[n : 2 * n - k]]))
            alike = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append(np.mean(sketcher.bins_of(a) == sketcher.bins_of(b)) - alike)
            assert (sketcher.bands_of(a) == sketcher.bands_of(b)).any() or alike < 0.85
        assert abs(np.mean(agree)) < 0.02


# ---- filter audit


def test_galloping_merges():
    rnd = random.Random(1)
    for _ in range(300):
        lists = [sorted(rnd.sample(range(60), rnd.randint(0, 40))) for _ in range(rnd.randint(0, 5))]
        lists += [list(range(20, 50))] if rnd.random() < 0.3 else []
        whole = sorted(set().union(*lists))
        assert filter_audit.united(lists) == whole
        ids = sorted(rnd.sample(range(60), rnd.randint(0, 40)))
        assert filter_audit.without(ids, whole) == [i for i in ids if i not in set(whole)]
        assert filter_audit.gallop(whole, 0, 30) == sum(i < 30 for i in whole)


def expected_audit(rows, labels):
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    first, found = {}, {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for k, (i, text, part) in enumerate(rows):
        text = text or ""
        words = samples.WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and i > first[text],
        }
        found.setdefault(part or "", []).append((i, {f for f, failing in fails.items() if failing}))
    out = []
    for part, docs in found.items():
        counted, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = sum(f in d[1] for d in docs)
                alone = sum(d[1] == {f} for d in docs)
                lost = [sum(d[0] in said for d in removed) for said in (good, toxic)]
                shapley[f] += len(removed)
                counted.append((part, "".join(order), step, len(left), len(removed), failing - len(removed), alone, *lost, f))
        out += [(*row[:-1], shapley[row[-1]]) for row in counted]
    return sorted(out)


@pytest.mark.parametrize("bits", [14, 3])
def test_filter_audit(spark, bits):
    docs = samples.documents(spark).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "en").when(F.col("doc_id") % 3 == 1, ""))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat(F.repeat("text", F.lit(9)), F.lit("#AB"))).otherwise(F.col("text")))
    labels = [(i, i % 2, int(i % 4 == 0)) for i in range(0, 60, 3)] + [(0, 1, 0), (0, None, 1), (None, 1, 1), (999, 1, 1)]
    marked = filter_audit.answers(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    lists = filter_audit.postings(marked, bits=bits)
    assert lists.filter(F.col("n_rows") > 2**bits).isEmpty()
    found = filter_audit.audit(filter_audit.set_sizes(lists))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert sorted(map(tuple, found.collect())) == expected_audit(rows, labels)


def test_filter_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    marked = filter_audit.answers(samples.empty(spark), labels)
    assert filter_audit.audit(filter_audit.set_sizes(filter_audit.postings(marked))).count() == 0


# ---- Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """The root, and for each node the siblings before and after it, level by level."""
    proofs, members = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        higher = []
        for start in range(0, len(nodes), 8):
            run = nodes[start : start + 8]
            for k in range(len(run)):
                for m in members[start + k]:
                    proofs[m].append(("".join(run[:k]), "".join(run[k + 1 :])))
            higher.append((digest(*run), sum(members[start : start + 8], [])))
        nodes, members = [h for h, _ in higher], [m for _, m in higher]
    return nodes[0], proofs


def expected_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[g] = tree([h for h, _ in groups[g]])
    root, upper = tree([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, upper):
        for (h, row), proof in zip(groups[g], trees[g][1]):
            i, text = row[0], row[-1]
            if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf([*row[:-1], text])
            for before, after in proof + above:
                now = digest(before, now, after)
            siblings = [x for pair in proof + above for x in pair]
            out.append((i, h, trees[g][0], root, digest(*siblings), now, now == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("groups", [0, 1, 3, 20])
def test_merkle_manifest(spark, groups):
    # no groups: all of one language, so the subroot is the root; twenty: some groups of one row and a tree above of two levels
    lang = F.lit("en") if not groups else F.concat(F.lit("é"), (F.coalesce("doc_id", F.lit(0)) % groups).cast("string"))
    lang = lang if groups < 3 else F.when(F.col("doc_id") == 60, None).when(F.col("doc_id") == 61, "").otherwise(lang)
    docs = samples.documents(spark).withColumn("lang", lang).withColumn("text", F.initcap("text"))
    found = merkle.verified(merkle.manifest(docs, merkle.tampered()))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    expected = expected_manifest(rows)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    assert {row[-1] for row in expected} == {True, False}


def test_merkle_manifest_of_little(spark):
    assert merkle.verified(merkle.manifest(samples.empty(spark))).count() == 0
    one = spark.createDataFrame([(None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.verified(merkle.manifest(one)).collect()
    assert row.leaf == row.root == row.subroot == row.folded_root == digest("-----") and row.proof_sha256 == digest() and row.verified
