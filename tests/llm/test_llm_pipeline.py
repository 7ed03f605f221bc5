"""The pipeline and the registration of the corpus queries."""

import hashlib
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from conftest import SMALL
from llm import samples
from llm.test_llm_dedup import expected_components
from llm.test_llm_quality import level_targets
from llm.test_llm_tokens import BYTES, whole

import __spark_entry__ as contract
from strikelens.llm import classifier, mixing
from strikelens.llm.common import table
from strikelens.runtime import stage


def test_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in contract.queries() if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, SMALL), "test-stage")
        assert docs.columns == columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before and ids, name
        before = ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == before


def test_whole_pipeline_against_plain_python(spark, folder):
    sf_dir = folder()
    docs = samples.documents(spark)
    labels = [(r.doc_id, int(len(r.text or "") > 60), 0) for r in docs.collect() if r.doc_id is not None and r.doc_id % 3]
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    # the verdicts of the classifier, which has tests of its own
    judged = classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).filter("kept").collect()
    verdicts = {r.doc_id for r in judged}
    rows = [r for r in table(spark, sf_dir, "documents").collect() if r.doc_id in verdicts and r.doc_id is not None]
    assert None not in verdicts and 10 < len(rows) < docs.count()
    # copies: of equal contents the longest, then the smallest identifier
    best = {}
    for r in rows:
        content = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        rank = (-len(r.text or ""), r.doc_id)
        if content not in best or rank < best[content][0]:
            best[content] = rank, r
    rows = [r for _, r in best.values()]
    groups = expected_components([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if groups[r.doc_id]["component_id"] == r.doc_id]
    # the mix
    sizes = {r.doc_id: len(samples.WORD.findall(r.text or "")) for r in rows}
    of_source = Counter()
    for r in rows:
        of_source[r.source] += sizes[r.doc_id]
    order = sorted(of_source, key=lambda s: (s is None, s))
    targets = level_targets(dict(of_source), {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(of_source.values()))
    expected = Counter()
    for r in rows:
        rate = targets[r.source] / of_source[r.source] if of_source[r.source] else 0.0
        coin = int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        ids = np.array([*whole(BYTES, r.text), 2], "<u4")
        first = len(ids) % 1024 or min(1024, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[r.doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += int(rate) + (coin < rate % 1)
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == +expected
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 1024
