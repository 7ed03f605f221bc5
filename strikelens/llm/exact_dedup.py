"""Exact deduplication with keyed streaming state.

A document is known by the SHA-256 of its text without white space. A streaming
aggregation keeps, for every digest and for ever, how many rows had it and the
best of them: the number of code points, the stable identifier and where the
content lies. The state is on disk (RocksDB) and is saved as changes with the checkpoint, so
further tables can be added to the same state later.

A digest alone never drops a document: the contents of every digest that was hit
more than once are compared byte for byte, as the smallest and largest content
per digest, and a digest with two contents is grouped by the whole content instead.

Skew: copies are combined before the shuffle, both in the state and in the
comparison, whose rows are dealt out by digest and a salt, so that no task gets
all copies of a text. Only documents' fingerprints are written; whole texts are
shuffled once, for the comparison.

Null text counts as empty; empty texts equal each other. Of equal texts the
longest original stays, then the smallest identifier, null identifiers last. Rows that repeat
an identifier and its text are copies of each other: ``decisions`` says the same
of all of them and ``deduplicate`` returns one. Extra columns are passed through by
``deduplicate`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strikelens.llm.common import SPACE, whole_text
from strikelens.runtime import new_folder, stage

#: State on disk; space is not reserved ahead, since there are many stores and each may be small.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
SALTS = 16


def content() -> Column:
    return F.regexp_replace(whole_text(), SPACE + "+", "")


def digest_of(text: Column, hex_digits: int = 64) -> Column:
    return F.substring(F.sha2(text, 256), 1, hex_digits)


class SeenTexts:
    """The digests seen so far. ``folder`` holds state and results; the same folder goes on where it was left."""

    def __init__(self, spark: SparkSession, folder: str, hex_digits: int = 64):
        self.spark, self.folder, self.hex_digits = spark, folder, hex_digits

    def fingerprints(self, docs: DataFrame) -> DataFrame:
        return docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            digest_of(content(), self.hex_digits).alias("digest"),
            F.char_length(whole_text()).alias("n_points"),
            F.input_file_name().alias("place"),
        )

    def add(self, docs: DataFrame) -> DataFrame:
        """Takes in ``docs`` and returns their fingerprints as written."""
        conf = self.spark.conf
        inbox = f"{self.folder}/fingerprints"
        prints = self.fingerprints(docs)
        prints.write.mode("append").parquet(inbox)
        stored = self.spark.read.schema(prints.schema).parquet(inbox)
        before = {key: conf.get(key, None) for key in STATE_CONF}
        for key, value in STATE_CONF.items():
            conf.set(key, value)
        try:
            best = F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus_id"), "place")).alias("best")
            state = (
                self.spark.readStream.schema(prints.schema)
                .parquet(inbox)
                .groupBy("digest")
                .agg(F.count("*").alias("group_size"), best)
            )
            query = (
                state.writeStream.outputMode("update")
                .option("checkpointLocation", f"{self.folder}/checkpoint")
                .trigger(availableNow=True)
                .foreachBatch(self._write)
                .start()
            )
            query.awaitTermination()
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)
        return stored

    def _write(self, changed: DataFrame, batch: int) -> None:
        """A replayed batch overwrites its own folder, so each change counts once."""
        changed.write.mode("overwrite").parquet(f"{self.folder}/groups/batch={batch}")

    def groups(self) -> DataFrame:
        """digest, group_size, keep_id, keep_place: the latest state of each digest."""
        schema = (
            "digest string, group_size long, best struct<n_points: int, minus_id: long, place: string>, batch long"
        )
        written = self.spark.read.schema(schema).parquet(f"{self.folder}/groups")
        latest = written.groupBy("digest").agg(F.max_by(F.struct("group_size", "best"), "batch").alias("now"))
        return latest.select(
            "digest",
            F.col("now.group_size").alias("group_size"),
            (-F.col("now.best.minus_id")).alias("keep_id"),
            F.col("now.best.place").alias("keep_place"),
        )


def unequal_digests(docs: DataFrame, groups: DataFrame, hex_digits: int = 64) -> DataFrame:
    """Digests that stand for more than one content: whole contents are compared wherever a digest was hit again."""
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    texts = docs.select(content().alias("content"), spread.alias("salt")).withColumn(
        "digest", digest_of(F.col("content"), hex_digits)
    )
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    hits = groups.filter("group_size > 1").select("digest", salts.alias("salt"))
    ends = [F.min("content").alias("low"), F.max("content").alias("high")]
    salted = texts.join(hits, ["digest", "salt"], "left_semi").groupBy("digest", "salt").agg(*ends)
    # equal ends within every part, and one content among the parts
    parts = salted.select("digest", (F.col("low") == F.col("high")).alias("same"), "low")
    whole = parts.groupBy("digest").agg(F.min("same").alias("same"), F.min("low").alias("low"), F.max("low").alias("high"))
    return whole.filter(~F.col("same") | (F.col("low") != F.col("high"))).select("digest")


def decisions(docs: DataFrame, hex_digits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    ``hex_digits`` shortens the digest of the state, for tests of the comparison.
    """
    spark = docs.sparkSession
    seen = SeenTexts(spark, new_folder(spark, "seen-texts"), hex_digits)
    prints = seen.add(docs).select("doc_id", "digest")
    groups = stage(seen.groups(), "text-groups")
    broken = stage(unequal_digests(docs, groups, hex_digits), "unequal-digests")
    sound = prints.join(groups, "digest")
    columns = ["doc_id", "keep_id", "group_size"]
    if hex_digits == 64 and broken.isEmpty():
        return _with_kept(sound.select(*columns, F.col("digest").alias("text_sha256")))
    # the exact way for digests that stand for several contents
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), content().alias("content"), F.char_length(whole_text()).alias("n_points")
    ).withColumn("digest", digest_of(F.col("content"), hex_digits))
    whole = F.sha2("content", 256).alias("text_sha256")
    split = texts.join(broken, "digest", "left_semi").select("doc_id", "content", "n_points", whole)
    best = F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus_id"))).alias("best")
    by_content = split.groupBy("content").agg(F.count("*").alias("group_size"), best)
    exact = split.join(
        by_content.select("content", "group_size", (-F.col("best.minus_id")).alias("keep_id")), "content"
    ).select(*columns, "text_sha256")
    good = texts.join(broken, "digest", "left_anti").join(groups, "digest").select(*columns, whole)
    return _with_kept(good.unionByName(exact))


def _with_kept(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each content, with the columns of ``docs``."""
    keepers = (
        decisions(docs)
        .filter("kept")
        .select(F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_digest"))
        .distinct()
    )
    rows = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.sha2(content(), 256).alias("_digest")
    )
    same = F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_digest") == F.col("_keep_digest"))
    # a null text has length 0; of equal lengths a text goes before null, then its hash decides
    order = F.struct(
        F.char_length(F.coalesce("_row.text", F.lit(""))), F.col("_row.text").isNotNull(), F.xxhash64("_row.text")
    )
    longest = F.max_by("_row", order).alias("_row")
    return rows.join(keepers, same).groupBy("_id", "_digest").agg(longest).select("_row.*")
