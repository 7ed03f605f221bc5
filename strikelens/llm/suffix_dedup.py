"""Removal of byte strings that occur before, by a distributed merge sort of suffixes.

Every string of ``LENGTH`` bytes contains, within its first bytes, the smallest of their 8-byte
hashes, its anchor, and equal strings have it at equal places. So only suffixes at anchors are sorted, about one in 35, and nothing is lost. A first
exchange of hashed anchor contexts leaves those that can have an equal; only their suffixes go on.

Each task sorts its suffixes and sends runs that are front-coded: of each suffix the length of the prefix
it shares with the one before, and the rest. A receiver merges the runs by a loser tree whose players know the prefix they share with
the last winner: a longer one wins without a look at the bytes, and equal ones are compared
from there on. Its output is the sorted order with the shared prefixes, from which follows for each distance to the
anchor which suffixes begin with the same bytes; the bytes before the anchor are compared in the same way. Of
equal strings the first stays and the others' bytes are removed.

Suffixes are ordered by a hash of their first bytes and then by all their bytes, so that the ranges given to the
receivers are even without sampling. Suffixes that are equal as far as it matters are merged in the task that has them, so a passage found
everywhere arrives once for each task. A whole text that repeats another is not sorted at all.

Null text is empty. Texts shorter than ``LENGTH`` lose nothing. Null identifiers come last, in the order of a
hash, and so do rows that share an identifier and have different texts. Repeated rows get the same result, that of
one. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikelens.runtime import stage

LENGTH = 100
#: Anchors are looked for in so many first bytes; at least ``CONTEXT`` bytes follow one inside its string.
FIRST = 76
CONTEXT = LENGTH - FIRST + 8
LEFT = FIRST - 8
_PLACES = LEFT + 1
#: Bytes of hash before a suffix in the order, and of both.
_HEAD = 4
_WIDTH = _HEAD + LENGTH
#: Bytes that are looked at together, contexts in a bucket and suffixes in a part, about.
CHUNK = 4 << 20
BUCKET = 200_000
PART = 50_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Identifiers of rows without one of their own begin here.
NAMELESS = 1 << 62


def _words(data: bytes) -> np.ndarray:
    """The 8 bytes from every place as a number."""
    n = len(data) - 7
    out = np.empty(max(n, 0), np.uint64)
    for r in range(min(8, max(n, 0))):
        part = np.frombuffer(data, "<u8", (len(data) - r) // 8, r)
        out[r::8] = part[: len(out[r::8])]
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every ``width`` neighbours, by doubling."""
    done, out = 1, values
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of anchors in ``data``, texts one after the other that end at ``ends``, and hashes of what follows each."""
    words = _words(data)
    if len(words) < _PLACES:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = (_mixed(words) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    lowest = _slide(h, _PLACES, np.minimum)
    # a string must lie in one text
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(len(data) + 1, np.int32)
    fits = ends - starts >= LENGTH
    np.add.at(inside, starts[fits], 1)
    np.add.at(inside, ends[fits] - LENGTH + 1, -1)
    lowest = np.where(np.cumsum(inside)[: len(lowest)] > 0, lowest, np.uint32(0))
    padded = np.concatenate([np.zeros(LEFT, np.uint32), lowest, np.zeros(len(h) - len(lowest), np.uint32)])
    places = np.flatnonzero(_slide(padded, _PLACES, np.maximum) == h)
    places = places[places + CONTEXT <= len(data)]
    keys = np.zeros(len(places), np.uint64)
    for k in range(0, CONTEXT, 8):
        keys = _mixed(keys * _MIX + words[places + k])
    return places, keys


def _chunks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, bytes, np.ndarray]]:
    """Rows of ``columns`` whose texts together are about CHUNK bytes, the texts joined, and their ends."""
    rows, texts, size = [], [], 0
    for batch in batches:
        values = zip(*(batch.column(c).to_pylist() for c in columns))
        for row, text in zip(values, batch.column("text")):
            text = text.as_py()
            if len(text) < LENGTH:
                continue
            rows.append(row)
            texts.append(text)
            size += len(text)
            if size >= CHUNK:
                yield rows, b"".join(texts), np.cumsum([len(t) for t in texts])
                rows, texts, size = [], [], 0
    if rows:
        yield rows, b"".join(texts), np.cumsum([len(t) for t in texts])


def _hashed_contexts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket and chunk: the hashes, documents and places of anchors as arrays of bytes."""
    for rows, data, ends in _chunks(batches, "id"):
        ids, starts = np.array([r[0] for r in rows], np.int64), np.concatenate(([0], ends[:-1]))
        places, keys = anchors(data, ends)
        owner = np.searchsorted(ends, places, side="right")
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        columns: list[list] = [[], [], [], []]
        for b in np.flatnonzero(np.diff(cuts)):
            chosen = order[cuts[b] : cuts[b + 1]]
            own = owner[chosen]
            parts = keys[chosen], ids[own], (places[chosen] - starts[own]).astype(np.int32)
            for column, value in zip(columns, (int(b), *(x.tobytes() for x in parts))):
                column.append(value)
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "keys", "ids", "places"])


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Consecutive rows with one value of ``key``."""
    last, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != last:
                yield last, held
                held = []
            last = row[key]
            held.append(row)
    if held:
        yield last, held


def _shared_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, place) of anchors whose hash occurs again."""
    for _, rows in _grouped(batches, "bucket"):
        keys = np.frombuffer(b"".join(r["keys"] for r in rows), np.uint64)
        ids = np.frombuffer(b"".join(r["ids"] for r in rows), np.int64)
        places = np.frombuffer(b"".join(r["places"] for r in rows), np.int32)
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        yield pa.RecordBatch.from_arrays([pa.array(ids[again]), pa.array(places[again])], names=["id", "place"])


def _neighbour_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row of bytes shares with the row before, 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 20_000):
        b = min(len(rows), a + 20_000)
        differ = rows[a:b] != rows[a - 1 : b - 1]
        out[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def _byte_order(rows: np.ndarray, *last: np.ndarray) -> np.ndarray:
    """The order of rows of bytes, and of equal ones by ``last``."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    numbers = padded.view(">u8").astype(np.uint64)
    return np.lexsort([*last[::-1], *(numbers[:, k] for k in range(numbers.shape[1] - 1, -1, -1))])


def _runs(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Sorted, front-coded runs of the suffixes at the places that came with each text, one for each part.

    Rows of part -1 are removals known here: (id, start, end) of all but the first of suffixes
    with equal surroundings.
    """
    names = ["part", "shared", "rests", "before", "lengths", "ids", "places"]
    kinds = (pa.int32(), *[pa.binary()] * 6)
    for rows, data, ends in _chunks(batches, "id", "places"):
        starts = np.concatenate(([0], ends[:-1]))
        counts = np.array([len(r[1]) for r in rows])
        ids = np.repeat(np.array([r[0] for r in rows], np.int64), counts)
        places = np.concatenate([np.array(r[1], np.int64) for r in rows])
        start, end = np.repeat(starts, counts), np.repeat(ends, counts)
        padded = np.frombuffer(b"\0" * LEFT + data + b"\0" * LENGTH, np.uint8)
        at = start + places
        columns: list[list] = [[] for _ in names]
        view = np.lib.stride_tricks.sliding_window_view(padded, LEFT + LENGTH)
        around = view[at].copy()
        left, right = np.minimum(places, LEFT), np.minimum(end - at, LENGTH)
        around[:, :LEFT][np.arange(LEFT)[None, :] < (LEFT - left)[:, None]] = 0
        around[:, LEFT:][np.arange(LENGTH)[None, :] >= right[:, None]] = 0
        head = np.zeros(len(at), np.uint64)
        context = np.ascontiguousarray(around[:, LEFT : LEFT + CONTEXT]).view("<u8")
        for k in range(context.shape[1]):
            head = _mixed(head * _MIX + context[:, k])
        head = (head >> np.uint64(32)).astype(np.uint32)
        suffixes = np.concatenate([head.astype(">u4").view(np.uint8).reshape(-1, _HEAD), around[:, LEFT:]], axis=1)
        sizes = np.stack([left, right], axis=1).astype(np.uint8)
        whole = np.concatenate([suffixes, around[:, :LEFT], sizes], axis=1)
        order = _byte_order(whole, ids, places)
        repeated = np.zeros(len(order), bool)
        repeated[1:] = _neighbour_prefixes(whole[order])[1:] == whole.shape[1]
        gone, order = order[repeated], order[~repeated]
        lowest = np.maximum(0, LENGTH - right[gone])
        some = lowest <= left[gone]
        gone, lowest = gone[some], lowest[some]
        removed = [x.astype(np.int64).tobytes() for x in (ids[gone], places[gone] - left[gone], places[gone] - lowest + LENGTH)]
        for column, value in zip(columns, (-1, b"", b"", b"", removed[0], removed[1], removed[2])):
            column.append(value)
        part = (head[order].astype(np.uint64) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        for p in np.flatnonzero(np.diff(cuts)):
            chosen = order[cuts[p] : cuts[p + 1]]
            run = suffixes[chosen]
            shared = _neighbour_prefixes(run)
            rests = run[np.arange(_WIDTH)[None, :] >= shared[:, None]]
            values = (
                int(p), shared.astype(np.uint8).tobytes(), rests.tobytes(), around[chosen, :LEFT].tobytes(),
                sizes[chosen].tobytes(), ids[chosen].tobytes(), places[chosen].astype(np.int32).tobytes(),
            )
            for column, value in zip(columns, values):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _unpacked(shared: bytes, rests: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a front-coded run, each with the prefix it shares with the one before."""
    last, at = b"", 0
    for n in shared:
        end = at + _WIDTH - n
        last = last[:n] + rests[at:end]
        at = end
        yield last, n


def merge_runs(runs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Merges front-coded runs: the run that each next string comes from, and the prefix it shares with the one before.

    A loser tree. Each player's prefix is that shared with the last string that won where it lost, so at a
    node the player with the longer prefix is the smaller; equal prefixes are compared beyond
    them, once, and the loser remembers how far it went along with the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    feeds = [_unpacked(*run) for run in runs]
    strings: list[bytes | None] = [None] * k
    for r, feed in enumerate(feeds):
        strings[r] = next(feed, (None, 0))[0]
    losers, prefixes = [0] * k, [0] * k
    number, bits = int.from_bytes, 8 * _WIDTH

    def play(a: int, pa_: int, b: int, pb: int) -> tuple[int, int, int, int]:
        """Winner and its prefix, loser and its prefix."""
        x, y = strings[a], strings[b]
        if y is None or (x is not None and pa_ > pb):
            return a, pa_, b, pb
        if x is None or pb > pa_:
            return b, pb, a, pa_
        differ = number(x[pa_:], "big") ^ number(y[pa_:], "big")
        far = (bits - differ.bit_length()) // 8 if differ else _WIDTH
        if x <= y:
            return a, pa_, b, far
        return b, pb, a, far

    # the first round, from the leaves up
    level = [(r, 0) for r in range(k)]
    node = k
    while len(level) > 1:
        node //= 2
        above = []
        for j in range(0, len(level), 2):
            w, pw, l, pl = play(*level[j], *level[j + 1])
            losers[node + j // 2], prefixes[node + j // 2] = l, pl
            above.append((w, pw))
        level = above
    winner, prefix = level[0]
    total = sum(len(shared) for shared, _ in runs)
    sources, common = np.empty(total, np.int32), np.empty(total, np.uint8)
    for i in range(total):
        sources[i], common[i] = winner, prefix
        player, own = winner, 0
        strings[player], own = next(feeds[player], (None, 0))
        node = (k + player) >> 1
        while node:
            other, its = losers[node], prefixes[node]
            mine = strings[player]
            # the usual cases of ``play``, decided without a call
            if mine is None or its > own:
                if strings[other] is not None or mine is None:
                    losers[node], prefixes[node] = player, own
                    player, own = other, its
            elif its == own and strings[other] is not None:
                player, own, losers[node], prefixes[node] = play(player, own, other, its)
            node >>= 1
        winner, prefix = player, own
    return sources, common


def repeats(common: np.ndarray, before: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix in sorted order, the least and greatest distance to the anchor at which a string repeats an earlier one.

    ``common`` is the shared prefix with the suffix before, ``before`` the bytes before each anchor, ``left`` and ``right``
    how many bytes there are before and from the anchor, ``rank`` the order of first occurrence. Distance -1: none.
    """
    n = len(common)
    backwards = np.ascontiguousarray(before[:, ::-1])
    by_before = _byte_order(backwards)
    shared_before = _neighbour_prefixes(backwards[by_before])
    least, greatest = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    first = np.argsort(rank)
    place = np.empty(n, np.int64)
    place[by_before] = np.arange(n)
    for distance in range(LEFT + 1):
        after = np.cumsum(common < LENGTH - distance)
        ahead = np.cumsum(shared_before < distance)[place] if distance else np.zeros(n, np.int64)
        exists = (left >= distance) & (right >= LENGTH - distance)
        chosen = first[exists[first]]
        _, kept = np.unique(after[chosen] * (n + 1) + ahead[chosen], return_index=True)
        again = np.ones(len(chosen), bool)
        again[kept] = False
        again = chosen[again]
        least[again] = np.where(least[again] < 0, distance, least[again])
        greatest[again] = distance
    return least, greatest


def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, start, end) of what goes, from the runs of whole parts."""
    for part, rows in _grouped(batches, "part"):
        if part < 0:
            for r in rows:
                columns = [pa.array(np.frombuffer(r[c], np.int64)) for c in ("lengths", "ids", "places")]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "end"])
            continue
        sources, common = merge_runs([(r["shared"], r["rests"]) for r in rows])
        # the n-th string of a run is its n-th in the merged order
        back = np.argsort(sources, kind="stable")
        order = np.empty(len(back), np.int64)
        order[back] = np.arange(len(back))
        whole = {c: b"".join(r[c] for r in rows) for c in ("ids", "places", "before", "lengths")}
        ids = np.frombuffer(whole["ids"], np.int64)[order]
        places = np.frombuffer(whole["places"], np.int32)[order].astype(np.int64)
        before = np.frombuffer(whole["before"], np.uint8).reshape(-1, LEFT)[order]
        sizes = np.frombuffer(whole["lengths"], np.uint8).reshape(-1, 2)[order].astype(np.int64)
        common = np.maximum(common.astype(np.int64) - _HEAD, 0)
        # a text's end is not a byte that others can share
        common[1:] = np.minimum(common[1:], np.minimum(sizes[1:, 1], sizes[:-1, 1]))
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort([places, ids])] = np.arange(len(ids))
        least, greatest = repeats(common, before, sizes[:, 0], sizes[:, 1], rank)
        some = least >= 0
        columns = [ids[some], places[some] - greatest[some], places[some] - least[some] + LENGTH]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "start", "end"])


def _merged(starts: list, ends: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in range(6)]
        for row in batch.to_pylist():
            text = row["text"]
            gone = [(0, len(text))] if row["copy"] and len(text) >= LENGTH else _merged(row["starts"] or [], row["ends"] or [])
            kept, at = [], 0
            for a, b in gone:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            rest = b"".join(kept)
            values = (row["doc_id"], len(text), len(text) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), rest)
            for column, value in zip(columns, values):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        n = 6 if with_text else 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds)], names=names[:n])


def remove_repeats(docs: DataFrame, with_text: bool = False, part: int = PART, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and the bytes kept if ``with_text``."""
    text = F.coalesce("text", F.lit(""))
    # rows without an identifier of their own
    other = F.lit(NAMELESS) + F.pmod(F.xxhash64("doc_id", text), F.lit(NAMELESS))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), other.alias("other"), F.sha2(text, 256).alias("digest"))
    named = named.withColumn("id", F.coalesce("doc_id", "other"))
    prints = stage(named.select("id", "other", "digest", F.length("text").alias("n")), "texts")
    clashes = prints.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high")
    clashes = stage(clashes.select("id"), "clashes")
    if not clashes.isEmpty():
        renamed = lambda rows: rows.join(clashes.withColumn("clash", F.lit(True)), "id", "left").withColumn(
            "id", F.when(F.col("clash"), F.col("other")).otherwise(F.col("id"))
        )
        named, prints = renamed(named), renamed(prints)
    named = named.select("id", "doc_id", "text")
    total = prints.agg(F.sum("n")).first()[0] or 0
    firsts = prints.groupBy("digest").agg(F.min("id").alias("first"))
    copies = stage(prints.join(firsts, "digest").select("id", (F.col("id") != F.col("first")).alias("copy")).distinct(), "copies")
    expected = 2 * total // (_PLACES + 1)
    buckets = max(16, expected // bucket)
    schema = "bucket int, keys binary, ids binary, places binary"
    hashed = named.select("id", "text").mapInArrow(lambda rows: _hashed_contexts(rows, buckets), schema)
    hashed = hashed.repartition("bucket").sortWithinPartitions("bucket")
    found = hashed.mapInArrow(_shared_contexts, "id long, place int")
    shared = stage(found.groupBy("id").agg(F.collect_set("place").alias("places")), "shared")
    shared = shared.join(copies.filter("NOT copy").select("id"), "id", "left_semi")
    count = shared.agg(F.sum(F.size("places"))).first()[0] or 0
    parts = max(8, count // part)
    run_schema = "part int, shared binary, rests binary, before binary, lengths binary, ids binary, places binary"
    texts = named.select("id", "text").join(shared, "id")
    if prints.count() > copies.count():
        # a row that is there twice does not come before itself
        texts = texts.dropDuplicates(["id"])
    runs = texts.mapInArrow(lambda rows: _runs(rows, parts), run_schema)
    runs = runs.repartition("part").sortWithinPartitions("part")
    gone = runs.mapInArrow(_removals, "id long, start long, end long")
    spans = gone.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    spans = stage(copies.join(spans, "id", "left"), "spans")
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return named.join(spans, "id").mapInArrow(lambda rows: _cut(rows, with_text), fields)
