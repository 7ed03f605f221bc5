"""Chat formatting at token level.

A turn is written as ``### Role: text</turn>`` and a line break. What marks a turn is spliced in as
reserved ids beyond the vocabulary, and role and text are encoded separately, so no text can be taken for a mark and no merge
crosses a border. In the text form the marks are strings; where a content holds one, a
backslash is put before it, and before every backslash, which ``unescape`` takes back.

Where a segment stands in its conversation is a prefix sum over the segments' lengths, and the loss mask,
1 on the ids of assistant texts, is the prefix sum of +1 where such a segment starts and -1
where it ends.

One output row is one turn: a conversation of any length is spread over rows and never held
whole. Turns are encoded wherever they lie. Only when a conversation is read back in order do its rows meet,
and then as a stream.

Null text and null role are empty. Turns are ordered by ``turn``, nulls first, then by a hash of role
and text; repeated rows are turns of their own. A null conv_id is a conversation. An empty table gives
an empty output. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strikelens.llm.encoding import encoder
from strikelens.runtime import stage

#: What the reserved ids stand for, in the order of the ids.
MARKS = ("### ", ": ", "</turn>\n")
#: Contents that could be taken for marks: a backslash comes before each.
CONTROLS = ("###", "</turn>")
RESERVED = 50_257
LEARNED = "assistant"
_CONTROL = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
ENCODED = "conv_id long, turn long, tie long, ids array<int>, loss_mask array<tinyint>"
PLACED = "part int, conv_id long, place long, start long, ids array<int>, loss_mask array<tinyint>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda found: "\\" + found[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|###|</turn>)", r"\1", text)


def encode_turns(conversations: DataFrame, vocabulary: str, learned: str = LEARNED) -> DataFrame:
    """conv_id, turn, tie, ids and loss_mask of each row, wherever it lies. ``tie`` orders rows of one turn."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, middle, tail = (np.array([RESERVED + k], np.uint32) for k in range(len(MARKS)))
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            escaped = (escape(x or "") for pair in zip(roles, texts) for x in pair)
            encoded = encoder(vocabulary).all(escaped)
            ids, masks = [], []
            for role, name, text in zip(roles, encoded, encoded):
                row = np.concatenate([head, name, middle, text, tail]).astype(np.int32)
                step = np.zeros(len(row), np.int8)
                if role == learned and len(text):
                    start = len(name) + 2
                    step[start], step[start + len(text)] = 1, -1
                ids.append(row)
                masks.append(np.cumsum(step, dtype=np.int8))
            columns = [*(batch.column(c) for c in ("conv_id", "turn", "tie"))]
            columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "tie", "ids", "loss_mask"])

    whole = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    tie = F.xxhash64("role", "text").alias("tie")
    return conversations.select(*whole, tie, "role", "text").mapInArrow(encode, ENCODED)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts turns and ids of each conversation as its rows pass, from where this task's part of it begins."""
    part, last, place, start = TaskContext.get().partitionId(), object(), 0, 0
    for batch in batches:
        conv_ids = batch.column("conv_id").to_pylist()
        lengths = pc.list_value_length(batch.column("ids")).to_pylist()
        places, starts = [], []
        for conv_id, length in zip(conv_ids, lengths):
            if conv_id != last:
                last, place, start = conv_id, 0, 0
            places.append(place)
            starts.append(start)
            place, start = place + 1, start + length
        columns = [pa.array([part] * len(conv_ids), pa.int32()), batch.column("conv_id")]
        columns += [pa.array(places, pa.int64()), pa.array(starts, pa.int64()), batch.column("ids"), batch.column("loss_mask")]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "conv_id", "place", "start", "ids", "loss_mask"])


def format_conversations(conversations: DataFrame, vocabulary: str, learned: str = LEARNED) -> DataFrame:
    """One row per turn: conv_id, place (number of the turn), start (ids before it), ids, loss_mask.

    Rows are dealt by range of (conversation, turn), so a long conversation goes to several tasks;
    the parts' totals say where each goes on.
    """
    encoded = encode_turns(conversations, vocabulary, learned)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("tie")]
    placed = stage(encoded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_number, PLACED), "turns")
    sizes = placed.groupBy("conv_id", "part").agg(F.count("*").alias("turns"), F.sum(F.size("ids")).alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # only the first conversation of a part can have begun before it: at most one row for each part
    moved = sizes.select(
        F.col("conv_id").alias("_conv"),
        F.col("part").alias("_part"),
        F.sum("turns").over(earlier).alias("_turns"),
        F.sum("size").over(earlier).alias("_size"),
    ).filter("_turns > 0")
    same = (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    return placed.join(moved, same, "left").select(
        "conv_id",
        (F.col("place") + F.coalesce("_turns", F.lit(0))).alias("place"),
        (F.col("start") + F.coalesce("_size", F.lit(0))).alias("start"),
        "ids",
        "loss_mask",
    )


def turns_of(ids: np.ndarray, decode) -> tuple[str, str, str]:
    """Role and text of a turn, unescaped, and its text form."""
    marks = np.flatnonzero(ids >= RESERVED)
    if list(ids[marks] - RESERVED) != list(range(len(MARKS))):
        raise ValueError("not one whole turn")
    name, text = decode(ids[marks[0] + 1 : marks[1]]), decode(ids[marks[1] + 1 : marks[2]])
    return unescape(name), unescape(text), MARKS[0] + name + MARKS[1] + text + MARKS[2]


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a text form: marks are those controls that no backslash escapes."""
    turn = r"### ((?:[^\\#:]|\\.|#(?!##)|:(?! ))*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n"
    return [(unescape(r), unescape(t)) for r, t in re.findall(turn, formatted, re.DOTALL)]


def digests(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, decoded from formatted turns.

    A digest of a whole conversation goes through it in order, so one task takes each conversation, turn by turn.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(vocabulary).decode
        last, state = object(), None
        done: list[tuple] = []

        def made() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = [pa.array([row[k] for row in done], kind) for k, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def finish() -> None:
            if state:
                n, turns, loss_chars, loss, chars = state
                done.append((last, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            columns = (batch.column(c) for c in ("conv_id", "ids", "loss_mask"))
            for conv_id, ids, mask in zip(*(column.to_pylist() for column in columns)):
                if state is None or conv_id != last:
                    finish()
                    last, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, mask = np.array(ids), np.array(mask)
                role, text, form = turns_of(ids, decode)
                learned = unescape(decode(ids[mask == 1]))
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(form)
            if len(done) > 10_000:
                yield made()
                done.clear()
        finish()
        if done:
            yield made()

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "start", "place")
    return dealt.select("conv_id", "ids", "loss_mask").mapInArrow(read, schema)
