"""Merkle manifest of a table, with a proof for every row.

A leaf is the hash of a row's fields, each as its length in bytes, a colon and its value, or ``-`` for null. Leaves of
one group (a language) ascend by identifier, and every ``FAN_OUT`` consecutive nodes become their hash until one is left,
the group's subroot. Subroots in the order of their groups likewise give the root. A hash is SHA-256 in hexadecimal, and what
it takes in are the texts of the digests below.

Proofs come by pointer jumping. A node holds a pointer to an ancestor and the siblings on the way there, those before and
those after the path at each level. At first the ancestor is the parent; a self-join of the nodes then follows the
ancestor's own pointer and appends its siblings, which doubles the distance each time, so the number of joins is
logarithmic in the height. Inner nodes, an eighth of all rows, are jumped and written; leaves take the tables so made one after the other.

Nothing is numbered in one task: rows are dealt by range of (group, identifier), and a row's place is its place in the
part plus the sizes of the group's parts before, of which there are as many as parts and groups. A run that becomes a node is at most
``FAN_OUT`` rows. The driver gets one digest, the root, and the size of the largest group. Ancestors high up are shared by many rows,
but there are few of them, and Spark broadcasts a table only while its written size is under
its threshold; beyond, the join is by sorting, whose hot keys adaptive execution splits.

A null group is a group of its own and comes first. A null identifier comes first in its group; of equal identifiers the smaller
leaf comes first, so repeated rows, which have equal leaves, get places of their own. Empty and long texts are hashed whole. An
empty table gives an empty result. Columns other than the fields are not read and may have any name.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strikelens.runtime import stage

#: The fields of a leaf in their order, and the column that groups leaves.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP = "lang"
FAN_OUT = 8
#: The tree above the subroots. Groups are named "" for null and "=" with their value, so this is no group's name.
TOP = "^"
#: Bytes of a digest; siblings are held as bytes, which is half the size of their text.
_WIDTH = 32
SEGMENTS = "array<struct<before:binary,after:binary>>"


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row with these field values."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def _numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``place``, from 0 within each ``tree`` by ``order``, and the ``size`` of the tree; and the largest size."""
    by = [F.asc("tree"), *[F.asc_nulls_first(c) for c in order]]
    # this number goes up by one along a sorted part
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("part", F.shiftright("at", 33)), "numbered")
    parts = dealt.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    of_tree = Window.partitionBy("tree").orderBy("part")
    earlier = F.coalesce(F.sum("n").over(of_tree.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("n").over(of_tree.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    offsets = stage(parts.select("tree", "part", (earlier - F.col("first")).alias("shift"), whole.alias("size")), "offsets")
    placed = dealt.join(offsets, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift"))
    return placed.drop("at", "shift", "part"), offsets.agg(F.max("size")).first()[0] or 0


def _node(level: int) -> Column:
    return F.concat_ws("/", F.lit(level), "place", "tree")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _build(nodes: DataFrame, largest: int, carried: Sequence[str] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """The last node of each tree (tree, node, digest), and by height the edges of all others.

    ``nodes`` (tree, place, size, node, digest) have height 0, and the largest tree has ``largest``. An edge is node, ancestor
    and segments: what is before and after the node in its run, for each level of the way. The lowest edges have the
    ``carried`` columns of their nodes, too.
    """
    tops, edges = [nodes.filter("size = 1").select("tree", "node", "digest")], []
    while largest > 1:
        kept = carried if not edges else ()
        member = F.struct("place", "node", "digest", *kept)
        parent = F.floor(F.col("place") / FAN_OUT)
        runs = nodes.filter("size > 1").groupBy("tree", "size", parent.alias("place"))
        runs = runs.agg(F.sort_array(F.collect_list(member)).alias("run")).withColumn("node", _node(len(edges) + 1))
        whole = F.array_join("run.digest", "")
        runs = stage(runs.withColumn("digest", F.sha2(whole, 256)), "runs")
        each = runs.select("tree", F.col("node").alias("ancestor"), F.unhex(whole).alias("bytes"), F.posexplode("run").alias("k", "one"))
        before = F.substr("bytes", F.lit(1), F.col("k") * _WIDTH)
        after = F.substr("bytes", (F.col("k") + 1) * _WIDTH + 1)
        segments = F.array(F.struct(before.alias("before"), after.alias("after"))).alias("segments")
        edges.append(each.select("tree", "one.node", "ancestor", segments, *[f"one.{c}" for c in kept]))
        nodes = runs.select("tree", "place", F.ceil(F.col("size") / FAN_OUT).alias("size"), "node", "digest")
        largest = -(-largest // FAN_OUT)
        tops.append(nodes.filter("size = 1").select("tree", "node", "digest"))
    return _union(tops), edges


def _jump(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """``rows`` with their ancestor's ancestor from ``steps`` and the siblings on the way; those at the root stay."""
    further = steps.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_next"), F.col("segments").alias("_more"))
    segments = F.when(F.col("_next").isNull(), F.col("segments")).otherwise(F.concat("segments", "_more"))
    return rows.join(further, "ancestor", "left").select(
        *[c for c in rows.columns if c not in ("ancestor", "segments")], F.coalesce("_next", "ancestor").alias("ancestor"), segments.alias("segments")
    )


def proof_digest(segments: Column) -> Column:
    """One digest for all siblings of a proof, from the leaf's level up and left to right."""
    return F.sha2(F.array_join(F.transform(segments, lambda s: F.lower(F.concat(F.hex(s.before), F.hex(s.after)))), ""), 256)


def fold(digest: Column, segments: Column) -> Column:
    """The root that follows from a leaf's digest and its siblings."""
    up = lambda below, s: F.sha2(F.concat(F.lower(F.hex(s.before)), below, F.lower(F.hex(s.after))), 256)
    return F.aggregate(segments, digest, up)


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS, group: str = GROUP) -> DataFrame:
    """doc_id, leaf, altered_leaf, subroot, root and segments, the proof, of every row.

    ``altered`` gives other values of some fields, such as those of a later copy of the table, for ``altered_leaf``; the tree is that of
    the values as they are. A proof has (before, after), bytes of digests, for every level from the leaf to the root.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    later = [(altered or {}).get(f, F.col(f)) for f in fields]
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        name.alias("tree"),
        leaf([F.col(f) for f in fields]).alias("digest"),
        leaf(later).alias("altered_leaf"),
    )
    # hashed once: finding the ranges of the parts reads the rows, too
    leaves, largest = _numbered(stage(hashed, "leaves"), ["doc_id", "digest"])
    leaves = leaves.withColumn("node", _node(0)).withColumn("leaf", F.col("digest"))
    carried = ["doc_id", "leaf", "altered_leaf"]
    tops, edges = _build(leaves, largest, carried)
    subroots = stage(tops, "subroots")
    # the subroots are the lowest nodes of one more tree, under the names that they have in their own
    upper, groups = _numbered(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("group"), "node", "digest"), ["group"])
    root, upper_edges = _build(upper, groups)
    found = root.first()
    root_digest = F.lit(found["digest"] if found else None).cast("string").alias("root")

    # a leaf without siblings is its group's subroot and has not set out yet
    alone = leaves.filter("size = 1").select("tree", "node", F.col("node").alias("ancestor"), F.array().cast(SEGMENTS).alias("segments"), *carried)
    proofs = _union([alone, *edges[:1]])
    inner = [e.select("node", "ancestor", "segments") for e in (*edges[1:], *upper_edges)]
    height, reach = len(edges) + len(upper_edges), 1
    if inner:
        steps = stage(_union(inner), "steps")
        while True:
            proofs, reach = _jump(proofs, steps), 2 * reach
            if reach > height:
                break
            steps = stage(_jump(steps, steps), "steps")
    of_group = subroots.select("tree", F.col("digest").alias("subroot"))
    return proofs.join(of_group, "tree").select(*carried, "subroot", root_digest, "segments")


def verified(proofs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, the root that follows from the altered leaf and whether it is the root."""
    checked = proofs.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("segments")).alias("proof_sha256"),
        fold(F.col("altered_leaf"), F.col("segments")).alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered() -> dict[str, Column]:
    """The text in small letters A-Z where three divides the CRC-32 of the identifier in decimals; null identifiers and texts stay."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return {"text": F.when(chosen, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))}
