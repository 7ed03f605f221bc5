"""Exact Jaccard join of documents' word shingles, by pivots in the metric space.

Documents with equal sets are one class, at distance 0. Classes are placed in regions: two sets
that are similar enough share one of the first shingles of each (in an order that puts very common ones
last), so a region is all classes with such a shingle, and no link crosses regions. Random documents are all
at distance 1 from any pivot, which is why regions start from shingles and not from a few pivots for all.

A region's pivot is its smallest class. Over all regions a class meets several pivots, and belongs to the cell of the one with which it shares most
first shingles. The first round measures it against that pivot alone; it is linked, beyond the radius, or undecided. By the triangle
inequality a class of the pivot's component at some distance can only be linked to those within that distance and the radius, so others leave, and classes on the
boundary go on with both sides. A region is done when all its classes are in one component.
In the others, classes of different components are compared by outlines (``blocks``), block by block, which bound what two sets share; pairs that pass are measured
on whole sets, the best partners of each class first, then more, at last all. A pair is given out by one of the regions in which its classes meet, and no other
pairs of a region are made. Sets are made of texts
wherever they are needed and never written: a text is the smaller of the two.

Shingles that are common in a task's documents are gathered in a table of bounded size; it decides the order only, never the
result. Shingles are 64-bit hashes of their words.

Empty texts and null texts have an empty set and are linked to nothing; a null identifier is a row like others, and the smallest
identifier of a component ignores it. Rows that share an identifier with other texts are documents of their own. Repeated rows are
copies. Python works on slices of a few megabytes of text at a time, so that memory follows the longest text and not a batch.
An empty table gives an empty result. Only doc_id and text are read; ``deduplicate`` passes all columns through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikelens.llm.blocks import BLOCK, COUNTS, PARTNERS, count_batch, lowest_groups, measured, planes, possible, screened
from strikelens.llm.common import WORD, discard, probably_in, row_key, slices, small_batches, whole_text
from strikelens.llm.components import components
from strikelens.llm.shingles import MIX, PRIME, Shingler
from strikelens.runtime import new_folder, stage

WORDS = 5
#: Similarity in percent.
SIMILAR = 80
#: Common shingles, at most, and how often one must be seen in a task to be offered.
COMMON = 500_000
OFTEN = 4
#: First shingles in a bucket, about.
BUCKET = 200_000

#: Shingles that a task holds before it combines them and forgets those seen once.
HELD = 250_000


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _binary(docs: DataFrame, *keys: Column | str) -> DataFrame:
    return docs.select(*keys, F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches and their sets; no more than a slice's sets are held."""
    shingler = Shingler(words)
    for batch in slices(batches):
        yield batch, shingler.sets(batch.column("text").to_pylist())


def _prefix_length(n: int, similar: int) -> int:
    """A set of ``n`` and a similar one share one of so many first shingles of each."""
    return n - -(-similar * n // 100) + 1 if n else 0


def common_shingles(docs: DataFrame, words: int = WORDS, similar: int = SIMILAR, most: int = COMMON, often: int = OFTEN) -> tuple[np.ndarray, int]:
    """The shingles found most often, at most ``most``, sorted; and the number of first shingles of all documents.

    Tasks offer shingles that they saw ``often`` times at least since they last forgot them.
    """

    def combined(held: list[tuple[np.ndarray, np.ndarray]], least: int) -> tuple[np.ndarray, np.ndarray]:
        shingles, place = np.unique(np.concatenate([s for s, _ in held]), return_inverse=True)
        n = np.bincount(place, np.concatenate([n for _, n in held]), len(shingles)).astype(np.int64)
        return shingles[n >= least], n[n >= least]

    def batch(held: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), pa.array(held[1])], names=["shingle", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        firsts = 0
        for _, sets in _sets(batches, words):
            firsts += sum(_prefix_length(len(s), similar) for s in sets)
            held.append(np.unique(np.concatenate(sets), return_counts=True))
            if sum(len(s) for s, _ in held) > HELD:
                held = [combined(held, 2)]
                if len(held[0][0]) > HELD // 2:
                    yield batch(combined(held, often))
                    held = []
        if held:
            yield batch(combined(held, often))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([firsts], pa.int64())], names=["shingle", "n"])

    counted = _binary(docs).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):
        counted = stage(counted, "counted")
    total = counted.filter("shingle IS NULL").first()
    rows = counted.filter("shingle IS NOT NULL").orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toArrow()
    return np.sort(rows.column("shingle").to_numpy().astype(np.int64)), total["n"] if total else 0


def first_shingles(docs: DataFrame, common: np.ndarray, buckets: int, words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """Two kinds of rows. Bucket -1: doc_id, key of the row, n_shingles, class (a hash of the set) and counts and over of a document's outline,
    which bound what two sets share.

    Others: the first shingles of a slice's documents that belong to a bucket, with class and size of the set they are from, as bytes
    of arrays; of equal sets in a slice only one is there.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, words):
            sizes = np.array([len(s) for s in sets], np.int64)
            classes = np.array([class_of(s) for s in sets], np.int64)
            n = len(sets)
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ["bucket", "doc_id", "key", "n_shingles", "class", "counts", "over", "shingles", "classes", "sizes"]
            nothing = [pa.nulls(n, pa.binary())] * 3
            own = [batch.column("doc_id"), batch.column("key"), pa.array(sizes), pa.array(classes), *count_batch(sets)]
            rows = [pa.array(np.full(n, -1, np.int32)), *own, *nothing]
            yield pa.RecordBatch.from_arrays(rows, names=names)
            chosen = np.unique(classes, return_index=True)[1]
            firsts = []
            for k in chosen:
                s = sets[k]
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    is_common = common[at] == s
                    s = np.concatenate([s[~is_common], s[is_common]])
                firsts.append(s[: _prefix_length(len(s), similar)])
            counts = [len(f) for f in firsts]
            shingles = np.concatenate(firsts)
            of_class, of_size = np.repeat(classes[chosen], counts), np.repeat(sizes[chosen], counts).astype(np.int32)
            bucket = (shingles.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            columns: list[list] = [[] for _ in names]
            for b in np.flatnonzero(np.diff(ends)):
                part = order[ends[b] : ends[b + 1]]
                packed = (x[part].tobytes() for x in (shingles, of_class, of_size))
                for column, value in zip(columns, (int(b), *[None] * 6, *packed)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    kept = f"bucket int, doc_id long, key binary, n_shingles long, class long, {COUNTS}"
    return _binary(docs, F.col("doc_id").cast("long").alias("doc_id"), row_key()).mapInArrow(cut, f"{kept}, shingles binary, classes binary, sizes binary")


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(region, a, n_a, b, n_b, members) for every class b of each region of two and more, a being its pivot.

    A region is named by a hash of its classes: shingles that the same classes have make one region.
    """
    for rows in _by_bucket(batches):
        shingles, classes, sizes = (np.concatenate([np.frombuffer(r[c], k) for r in rows]) for c, k in _PACKED)
        order = np.lexsort([classes, shingles])
        shingles, classes, sizes = shingles[order], classes[order], sizes[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (shingles[1:] != shingles[:-1]) | (classes[1:] != classes[:-1])
        shingles, classes, sizes = shingles[fresh], classes[fresh], sizes[fresh]
        starts = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1])))
        members = np.diff(np.append(starts, len(shingles)))
        mixed = classes.view(np.uint64) * PRIME
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[0]
        names = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts).view(np.int64)
        first = np.unique(names, return_index=True)[1]
        kept = np.zeros(len(starts), bool)
        kept[first] = True
        kept &= members > 1
        rows_kept = np.repeat(kept, members)
        of = np.repeat(np.arange(len(starts)), members)[rows_kept]
        columns = [names[of], classes[starts[of]], sizes[starts[of]], classes[rows_kept], sizes[rows_kept], members[of]]
        arrays = [pa.array(c.astype(np.int64)) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=["region", "a", "n_a", "b", "n_b", "members"])


_PACKED = (("shingles", np.int64), ("classes", np.int64), ("sizes", np.int32))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["bucket"] != held[-1]["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _comparable(n_a: str, n_b: str, similar: int) -> Column:
    """Sizes that allow the similarity."""
    low, high = F.least(n_a, n_b), F.greatest(n_a, n_b)
    return 100 * low >= similar * high


class _Rounds:
    """Links and components known so far, and the measuring of further pairs."""

    def __init__(self, docs: DataFrame, classes: DataFrame, counted: DataFrame, words: int, similar: int):
        self.docs, self.classes, self.counted, self.words, self.similar = docs, classes, counted, words, similar
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None

    def measure(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b) with the size of intersection and union of their sets; written."""
        # one text of each class that is measured, and no others are moved
        needed = stage(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(self.classes, "class"), "needed")
        source = self.docs.select(row_key(), whole_text().cast("binary").alias("text"))
        source = probably_in(source, needed).join(needed, "key")
        # rows that repeat have one key
        texts = stage(source.groupBy("class").agg(F.min("text").alias("text")), "texts")
        found = measured(pairs, texts, self.words)
        links = found.filter(100 * F.col("shared") >= self.similar * F.col("joined")).select("a", "b")
        self.links = links if self.links is None else self.links.union(links)
        self.roots = components(self.links)
        return found

    def rooted(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        """``rows`` with the component of ``column`` as ``name``."""
        roots = self.roots.select(F.col("node").alias(column), F.col("root").alias(name))
        return rows.join(roots, column, "left").withColumn(name, F.coalesce(name, column))


def region_members(found: DataFrame) -> DataFrame:
    """The classes of all regions, from what ``first_shingles`` made."""
    packed = found.filter("bucket >= 0").select("bucket", *[c for c, _ in _PACKED])
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    members = dealt.mapInArrow(_regions, "region long, a long, n_a long, b long, n_b long, members long")
    return members.dropDuplicates(["region", "b"])


def class_links(
    docs: DataFrame, found: DataFrame, members: DataFrame, counted: DataFrame, similar: int = SIMILAR, words: int = WORDS,
    partners: Sequence[int | None] = PARTNERS, block: int = BLOCK,
) -> DataFrame | None:
    """node, root of the components of classes with links, from documents' rows, regions' members and their outlines, all written."""
    near = _comparable("n_a", "n_b", similar)
    # regions in which a class has a pivot are first shingles that both have: the more, the nearer
    stars = members.filter((F.col("a") != F.col("b")) & near).groupBy("a", "b").agg(F.count("*").alias("shared"))
    stars = stage(stars, "stars")
    if members.isEmpty():
        return None
    classes = found.filter("n_shingles > 0").groupBy("class").agg(F.min("key").alias("key"))
    rounds = _Rounds(docs, classes, counted, words, similar)
    # a class and the nearest of its pivots, its cell; then whatever is still apart in a region
    nearest = stars.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a"))
    first = rounds.measure(screened(nearest, counted, similar))
    return _settle(rounds, members, first, similar, partners, block)


def _settle(
    rounds: _Rounds, members: DataFrame, first: DataFrame, similar: int, partners: Sequence[int | None], block: int
) -> DataFrame:
    """Measures what regions still leave open: pairs of different components that the window and the outlines let pass."""
    radius = 1 - similar / 100
    near = first.select("a", "b", (1 - F.col("shared") / F.col("joined")).alias("distance"))
    rest = members.join(near, ["a", "b"], "left").withColumn("distance", F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.col("distance")))
    rest = rounds.rooted(rest.select("region", "members", F.col("b").alias("class"), F.col("n_b").alias("n"), "a", "distance"), "class", "root")
    rest = rounds.rooted(rest, "a", "pivot_root")
    # regions in one component are done
    mixed = rest.groupBy("region").agg(
        F.min("root").alias("low"), F.max("root").alias("high"),
        F.min(F.when(F.col("root") != F.col("pivot_root"), F.coalesce("distance", F.lit(0.0)))).alias("nearest"),
    ).filter("low <> high").select("region", "nearest")
    rest = rest.join(mixed, "region")
    # of the pivot's component, only those stay that the triangle inequality lets reach somebody outside it
    reach = F.coalesce("distance", F.lit(1.0)) + radius + 1e-9 >= F.col("nearest")
    rest = rest.filter((F.col("root") != F.col("pivot_root")) | F.col("distance").isNull() | reach)
    rest = stage(rest.select(F.col("region").alias("group"), "members", "class", "n"), "rest")
    done, outlined = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), None
    for most in partners:
        rest = rounds.rooted(rest.drop("root"), "class", "root")
        ends = rest.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        rest = stage(rest.join(ends.filter("low <> high").select("group"), "group", "left_semi"), "rest")
        if rest.isEmpty():
            break
        if outlined is None:
            met = lowest_groups(members.select(F.col("region").alias("group"), F.col("b").alias("class")))
            open_classes = rounds.counted.join(rest.select("class").distinct(), "class", "left_semi")
            outlined = stage(planes(open_classes).join(met, "class"), "outlines")
        found = possible(rest, outlined, similar, most, block)
        passed = found.select("a", "b").distinct().join(done, ["a", "b"], "left_anti")
        fresh = screened(passed, rounds.counted, similar)
        if not fresh.isEmpty():
            rounds.measure(fresh)
        # what the screen has dropped is settled, too, and is dropped again
        done = done.union(fresh)
        rest = rest.join(found.select(F.col("open").alias("group")).distinct(), "group", "left_semi")
    return rounds.roots


def _joined(
    docs: DataFrame, words: int = WORDS, similar: int = SIMILAR, common: int = COMMON, often: int = OFTEN,
    partners: Sequence[int | None] = PARTNERS, block: int = BLOCK,
) -> DataFrame:
    """doc_id, key, n_shingles, component_id and root of every row: a root is one class of the component, null for an empty set."""
    often_found, firsts = common_shingles(docs, words, similar, common, often)
    spark = docs.sparkSession
    path = new_folder(spark, "first-shingles")
    with small_batches(spark):
        first_shingles(docs, often_found, max(16, firsts // BUCKET), words, similar).write.parquet(path)
    written = spark.read.parquet(path)
    rows = written.filter("bucket = -1")
    found = stage(rows.select("doc_id", "key", "n_shingles", "class"), "sets-of-documents")
    members = stage(region_members(written), "members")
    # outlines of the classes that share a region
    ends = members.select(F.col("b").alias("class")).distinct()
    counted = stage(rows.select("class", "counts", "over").join(ends, "class", "left_semi").dropDuplicates(["class"]), "outlines")
    # what is larger than all that follows is not needed any more
    discard(spark, path)
    roots = class_links(docs, found, members, counted, similar, words, partners, block)
    rows = found.select("doc_id", "key", "n_shingles", "class")
    some = rows.filter("n_shingles > 0")
    classes = some.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    if roots is None:
        classes = classes.withColumn("root", F.col("class"))
    else:
        rooted = classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
        rooted = stage(rooted.withColumn("root", F.coalesce("root", "class")), "rooted")
        lowest = rooted.groupBy("root").agg(F.min("component_id").alias("component_id"))
        classes = rooted.select("class", "root").join(lowest, "root")
    columns = ["doc_id", "key", "n_shingles", "component_id", "root"]
    none = rows.filter("n_shingles = 0").select(
        "doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root")
    )
    return some.join(classes, "class").select(columns).unionByName(none)


def join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest identifier that links reach. Options are those of ``_joined``."""
    return _joined(docs, **options).select("doc_id", "n_shingles", "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component with the columns of ``docs``: that of its smallest identifier, or of none if no row has one.

    Of rows of one component that share this identifier, and of rows that repeat it with its text, one stays. Documents
    without words are linked with nothing and all stay.
    """
    joined = _joined(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    linked = joined.filter("root IS NOT NULL").groupBy("root").agg(F.min_by("key", order).alias("_kept")).select("_kept")
    rows = docs.select(F.struct("*").alias("_row"), row_key().alias("_key"))
    chosen = rows.join(linked, F.col("_key") == F.col("_kept"))
    single = chosen.groupBy("_key").agg(F.max_by("_row", F.xxhash64("_row")).alias("_row"))
    return single.select("_row.*").union(docs.filter(~F.coalesce("text", F.lit("")).rlike(WORD)))
