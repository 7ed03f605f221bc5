"""Exact and near copies and repeated byte strings against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm import samples
from pyspark.sql import functions as F

from strikelens.llm import blocks, common, components, exact_dedup, jaccard_join, shingles as word_shingles, suffix_dedup


def plain_rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# ---- exact dedup


def expected_groups(rows):
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(strip(t), []).append((-len(t or ""), i is None, i or 0, i))
    return {
        i: {"keep_id": min(groups[strip(t)])[3], "group_size": len(groups[strip(t)]), "kept": i == min(groups[strip(t)])[3],
            "text_sha256": hashlib.sha256(strip(t).encode()).hexdigest()}
        for i, t in rows
        if i is not None
    }


@pytest.mark.parametrize("hex_digits", [64, 1])
def test_exact_dedup(spark, hex_digits):
    docs = samples.documents(spark)
    found = exact_dedup.decisions(docs, hex_digits)
    assert found.count() == docs.count()
    named = samples.by_id(found.filter("doc_id IS NOT NULL"))
    assert named == expected_groups(plain_rows(docs))


def test_exact_dedup_keeps_one_row_of_each_content(spark):
    docs = samples.documents(spark)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    contents = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in plain_rows(docs)}
    assert kept.count() == len(contents)
    assert exact_dedup.decisions(samples.empty(spark)).count() == 0


def test_exact_dedup_keeps_rows_of_null_text(spark):
    rows = [(7, None, "a"), (9, None, "b"), (3, "x y", "c"), (None, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(tuple, exact_dedup.deduplicate(docs).collect())) == [(3, "x y", "c"), (7, None, "a")]
    repeated = spark.createDataFrame([(7, None, "a"), (7, "", "a")], docs.schema)
    assert [tuple(r) for r in exact_dedup.deduplicate(repeated).collect()] == [(7, "", "a")]


def test_state_goes_on_with_further_tables(spark, folder):
    seen = exact_dedup.SeenTexts(spark, folder())
    for part in ([(1, "a b"), (2, "c")], [(3, "ab"), (4, "a  b")]):
        seen.add(spark.createDataFrame(part, "doc_id long, text string"))
    groups = {(r.group_size, r.keep_id) for r in seen.groups().collect()}
    assert groups == {(3, 4), (1, 2)}


# ---- Jaccard join


def shingles(text, size=5):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def expected_components(rows, size=5, similar=80):
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: {"n_shingles": len(s), "component_id": root(i)} for i, s in sets.items()}


@pytest.mark.parametrize("options", [{}, {"common": 0, "block": 3}, {"often": 2, "partners": (None,)}])
def test_jaccard_join(spark, options):
    docs = samples.documents(spark)
    found = jaccard_join.join(docs, **options)
    assert found.count() == docs.count()
    named = [row for row in plain_rows(docs) if row[0] is not None]
    assert samples.by_id(found.filter("doc_id IS NOT NULL")) == expected_components(named)


def test_jaccard_join_where_regions_stay_mixed(spark):
    rnd = random.Random(2)
    passage = samples.sentence(rnd, 60, 5000)
    rows = [(i, f"{samples.sentence(rnd, rnd.randint(0, 25), 5000)} {passage} {samples.sentence(rnd, rnd.randint(0, 25), 5000)}") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (4, 32):
        assert samples.by_id(jaccard_join.join(docs, common=0, block=block, partners=(1, None))) == expected_components(rows)


def test_jaccard_join_of_nothing_and_rows_kept(spark):
    assert jaccard_join.join(samples.empty(spark)).count() == 0
    docs = samples.documents(spark)
    kept = jaccard_join.deduplicate(docs)
    named = [row for row in plain_rows(docs) if row[0] is not None]
    expected = {i for i, c in expected_components(named).items() if c["component_id"] == i}
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted(expected)


def test_jaccard_rows_that_share_identifiers(spark):
    a = samples.sentence(random.Random(3), 60)
    near, nearer = a + " end", "begin " + a
    rows = [(1, a), (1, "quite another text of some words here"), (2, near), (None, nearer), (None, nearer), (3, None), (3, ""), (None, "alone among all of these rows")]
    kept = jaccard_join.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[1], (3, None), (3, ""), rows[-1]], key=repr)


def test_pairs_that_share_many_groups_come_once(spark):
    """All meet in 40 groups; 5, 6 and 7 are alike, and of all others none."""
    rnd = random.Random(6)
    own = [[rnd.getrandbits(63) for _ in range(200)] for _ in range(12)]
    own[6], own[7] = own[5][:195] + own[6][:5], own[5][:190] + own[7][:10]
    sets = [np.sort(np.array(x, np.int64)) for x in own]
    schema = f"class long, {blocks.PLANES}, {blocks.COUNTS}"
    outlined = spark.createDataFrame([tuple(r.values()) for r in blocks.outline_batch(pa.array(range(12)), sets).to_pylist()], schema)
    rows = [(g, 12, c, 200, c) for g in range(40) for c in range(12)] + [(99, 2, c, 200, c) for c in (6, 7)]
    members = spark.createDataFrame(rows, "group long, members long, class long, n long, root long")
    outlined = outlined.join(blocks.lowest_groups(members), "class")
    for block in (4, 100):
        for most in (1, 2, None):
            found = [tuple(r) for r in blocks.possible(members, outlined, 80, most, block).collect()]
            assert len(found) == len({x[:2] for x in found}) <= 3
            opened = {x[2] for x in found} - {None}
            assert {x[:2] for x in found} == {(5, 6), (5, 7), (6, 7)} or opened == {0}
            assert most == 1 or not opened


def test_rows_probably_in(spark, monkeypatch):
    rows = spark.range(3000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("key"), F.col("id").alias("own"))
    keys = rows.filter("own % 10 = 0").select("key")
    for parts in (1, 1024):
        monkeypatch.setattr(common, "MAP_PARTS", parts)
        found = common.probably_in(rows, keys)
        assert found.columns == rows.columns and "Exchange hashpartitioning(key" not in found._jdf.queryExecution().toString()
        own = [r.own for r in found.collect()]
        assert {i for i in own if i % 10 == 0} == set(range(0, 3000, 10)) and len(own) == len(set(own)) < 600
    assert common.probably_in(rows, keys.limit(0)).count() == 0


def test_sets_of_many_texts_are_those_of_each():
    rnd = random.Random(8)
    words = ["a", "A", "bc", "seventy", "eightlet", "ninelette", "é" * 9, "x" * 16, "x" * 17, "y" * 2000, "\0", "\0\0"]
    texts = ["", " \t", None] + ["".join(rnd.choice(words) + rnd.choice([" ", "\n", "  "]) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    data = [t and t.encode() for t in texts]
    for size in (1, 3, 5):
        shingler, named = word_shingles.Shingler(size), {}
        found = shingler.sets(data)
        for text, one in zip(data, found):
            assert one.tolist() == sorted(set(one.tolist())) == shingler.set(text).tolist()
            own = shingles((text or b"").decode(), size)
            assert len(own) == len(one)
            named.setdefault(frozenset(own), one.tobytes())
            assert named[frozenset(own)] == one.tobytes()
        assert len(set(named.values())) == len(named)


def test_slices_of_batches():
    texts = [b"a" * n for n in (3, 9, 0, 2, 30, 1, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    found = [s.column("text").to_pylist() for s in common.slices([batch, batch.slice(0, 0)], size=10)]
    assert sum(found, []) == texts and [len(s) for s in found] == [1, 2, 1, 1, 3]


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (200, 200)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# ---- repeated byte strings


def expected_removals(rows):
    seen, out = set(), {}
    for i, t in sorted(set(rows)):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        rest = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(data)))
        out[i] = {"n_bytes": len(data), "n_removed": sum(gone), "n_spans": spans, "kept_sha256": hashlib.sha256(rest).hexdigest()}
    return out


@pytest.mark.parametrize("options", [{}, {"part": 3, "bucket": 20}])
def test_suffix_dedup(spark, options):
    docs = samples.documents(spark).filter("doc_id IS NOT NULL")
    found = suffix_dedup.remove_repeats(docs, **options)
    assert found.count() == docs.count()
    assert samples.by_id(found) == expected_removals(plain_rows(docs))


def test_suffix_dedup_of_short_pieces_of_passages(spark):
    rnd = random.Random(4)
    passages = [samples.sentence(rnd, 40, 900) for _ in range(4)]
    rows = []
    for i in range(80):
        text = ""
        for _ in range(rnd.randint(0, 4)):
            passage, start = rnd.choice(passages), rnd.randint(0, 40)
            text += passage[start : start + rnd.randint(60, 190)] + samples.sentence(rnd, rnd.randint(0, 3))
        rows.append((i, text))
    rows += [(90, "a" * 500), (91, "a" * 99), (92, "a" * 100 + "b"), (93, "\0" * 300), (94, "x" + "\0" * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert samples.by_id(suffix_dedup.remove_repeats(docs)) == expected_removals(rows)


def test_suffix_dedup_without_identifiers(spark):
    rows = [(None, "q" * 150), (1, "q" * 150), (1, "z" * 150), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(docs, with_text=True).collect()
    # of a letter in a row only the first is in no string that starts earlier, too; a copy goes whole
    removed = sorted((r.n_bytes, r.n_removed) for r in found)
    assert removed == [(0, 0), (150, 149), (150, 149), (150, 150)]
    assert suffix_dedup.remove_repeats(samples.empty(spark)).count() == 0


def test_merge_of_runs():
    rnd = random.Random(7)
    strings = [bytes(rnd.choice(b"ab") for _ in range(8)).ljust(suffix_dedup._WIDTH, b"c") for _ in range(300)]
    runs, cut = [], [sorted(strings[k::7]) for k in range(7)] + [[]]
    for run in cut:
        shared, rests, last = [], b"", b""
        for x in run:
            n = next((k for k, (p, q) in enumerate(zip(last, x)) if p != q), min(len(last), len(x)))
            shared.append(n)
            rests += x[n:]
            last = x
        runs.append((bytes(shared), rests))
    sources, common = suffix_dedup.merge_runs(runs)
    feeds = [iter(run) for run in cut]
    merged = [next(feeds[s]) for s in sources]
    assert merged == sorted(strings)
    for k in range(1, len(merged)):
        n = next((j for j, (p, q) in enumerate(zip(merged[k - 1], merged[k])) if p != q), suffix_dedup._WIDTH)
        assert common[k] == n
