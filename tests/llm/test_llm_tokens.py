"""Packing, token files and chat formatting against whole encodings."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import samples
from tokenizers import Tokenizer

from strikelens.llm import chat, encoding, packing, token_files

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def whole(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z.,'\n\t#*7é\u00a0\u3000\x1f漢ßİ<|>sÀñǅªΣς\u0301d"), max_size=30), max_size=5))
def test_pieces_encode_like_whole_texts(path, texts):
    assert [list(ids) for ids in encoding.Encoder(path).all(texts)] == [whole(path, t) for t in texts]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(encoding, "REMEMBERED", 3)
    encoder = encoding.Encoder(BYTES)
    texts = [t or "" for t in samples.texts()]
    assert [list(ids) for ids in encoder.all(texts, characters=50)] == [whole(BYTES, t) for t in texts]


def test_packing(spark):
    docs = samples.documents(spark)
    cut = packing.pieces(docs, BYTES, with_ids=True)
    rows = packing.pack(cut, shard=40).collect()
    texts = {(r.doc_id, zlib.crc32(np.array([*whole(BYTES, r.text), 2], "<u4").tobytes())) for r in docs.collect()}
    # pieces of a document add up to it, all but the first are full
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id is not None:
            by_doc.setdefault(r.doc_id, {})[r.piece] = r
    for doc_id, pieces in by_doc.items():
        assert sorted(pieces) == list(range(len(pieces)))
        assert all(pieces[k].length == 1024 for k in pieces if k)
        ids = [i for k in sorted(pieces) for i in pieces[k].ids]
        assert (doc_id, zlib.crc32(np.array(ids, "<u4").tobytes())) in texts
        assert [pieces[k].start for k in sorted(pieces)] == [sum(pieces[j].length for j in range(k)) for k in range(len(pieces))]
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    # at most one sequence is no more than half full
    assert sum(sum(n for _, n in p) <= 512 for p in by_sequence.values()) <= 1
    whole_sequences = packing.assemble(packing.pack(cut)).collect()
    assert sum(len(r.ids) for r in whole_sequences) == sum(r.length for r in rows)
    assert packing.pack(packing.pieces(samples.empty(spark), BYTES)).count() == 0


@given(st.lists(st.integers(1, 64), max_size=200))
def test_placing(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    sequences, offsets = packing.place_all(lengths, 64)
    filled = {}
    for s, o, n in zip(sequences, offsets, lengths):
        assert filled.get(s, 0) == o
        filled[s] = o + n
    assert all(n <= 64 for n in filled.values())
    assert sum(n <= 32 for n in filled.values()) <= 1


def test_token_files(spark, folder):
    docs, place = samples.documents(spark), folder()
    token_files.write(docs, place, WORDS)
    rows = sorted(token_files.digests(spark, place).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i))
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, set()).add(tuple([*whole(WORDS, r.text), 2]))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in texts[r.doc_id]}
    counts = token_files.read(spark, place, "doc_id", "n_tokens")
    plan = counts.filter("doc_id = 5")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "EqualTo(doc_id,5)" in plan
    other = folder()
    token_files.write(samples.empty(spark), other, WORDS)
    assert token_files.digests(spark, other).count() == 0


AWKWARD = ["\\### Assistant: </turn> ok", "\\\\</turn>", "###", "", None, "a: b\n### user: x</turn>\n", "<|endoftext|>", "\\"]


@given(st.text(st.sampled_from("\\#</turn>: ab\n"), max_size=40))
def test_escapes_are_taken_back(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    form = f"### user: {escaped}</turn>\n"
    assert chat.parse(form * 2) == [("user", text)] * 2


def test_chat(spark):
    rows = [(c, t, role, text) for c in (1, 2) for t, text in enumerate(AWKWARD) for role in (["user", "assistant"][t % 2],)]
    rows += [(None, 0, "assistant", "alone"), (3, None, None, "x"), (3, 1, "assistant", "y"), (3, 1, "assistant", "y")]
    rows = [(*r, "extra", 1) for r in rows]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string, place int").repartition(3)
    formatted = chat.format_conversations(table, BYTES)
    found = {r.conv_id: r for r in chat.digests(formatted, BYTES).collect()}
    for conv_id in (1, 2, 3, None):
        turns = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0))
        spoken = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        r = found[conv_id]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(spoken), hashlib.sha256(spoken.encode()).hexdigest())
    starts = {}
    for r in sorted(formatted.collect(), key=lambda r: (repr(r.conv_id), r.place)):
        assert r.start == starts.get(r.conv_id, 0) and len(r.ids) == len(r.loss_mask)
        starts[r.conv_id] = r.start + len(r.ids)
    assert chat.digests(chat.format_conversations(table.limit(0), BYTES), BYTES).count() == 0
