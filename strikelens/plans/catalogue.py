"""One query per operator, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.codec import decode
from ..functions.quantity import mean_quantity, parse_quantity
from ..operators import codes, narrow, rank, route, totals, validate
from ..runtime import new_folder, stage, state_for
from ..schemas import DETAIL_COLUMNS, GROUPED, KEY, SUMMARY
from ..settings import LENIENT_THRESHOLD, STRICT_THRESHOLD
from ..sources import csv_files, topics
from ..sources.files import Files
from ..streaming import jobs
from ..streaming.replay import Replay
from ..streaming.run import drain, drain_ticks, ticked
from ..streaming.upserts import UpsertLog
from . import batch
from .tables import details_of, events_of, table_stream

Query = Callable[[SparkSession, str], DataFrame]

CODES = ["record_id", "airport_id", "airport_name", "species_id", "species_name"]
EVENT_KEY = ["user_id", "event_type"]
DAY = "1 day"
INCIDENT_WINDOW = "730 days"


def _prepared(spark: SparkSession, folder: str) -> tuple[DataFrame, batch.Preparation]:
    details = details_of(spark, folder)
    return details, batch.prepare(details)


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return stage(codes.code_pairs(details_of(spark, folder)), "pairs")


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return batch.clean_incidents(*_prepared(spark, folder))


def _window_seconds(rows: DataFrame) -> DataFrame:
    """Window bounds as seconds, which read the same in every time zone."""
    return rows.withColumns({c: F.unix_timestamp(c) for c in ("window_start", "window_end")})


# --- records and scalar functions


def normalize_summary(spark: SparkSession, folder: str) -> DataFrame:
    return narrow.to_summary(details_of(spark, folder))


def quantity_forms(spark: SparkSession, folder: str) -> DataFrame:
    low, high = parse_quantity(F.col("species_quantity"))
    parsed = details_of(spark, folder).select("species_quantity", low.alias("low"), high.alias("high"))
    parsed = parsed.withColumn("mean", mean_quantity(F.col("low"), F.col("high")))
    return parsed.groupBy("species_quantity", "low", "high", "mean").agg(F.count(F.lit(1)).alias("n"))


def upper_ids(spark: SparkSession, folder: str) -> DataFrame:
    lowered = details_of(spark, folder).select("record_id", F.lower("species_id").alias("species_id"))
    return narrow.upper_ids(lowered)


# --- rules


def rule_profile(spark: SparkSession, folder: str) -> DataFrame:
    return validate.profile_rows(validate.profile(details_of(spark, folder)))


def rule_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Fields validated under the strict, the lenient and a middle threshold."""
    profiled = stage(validate.profile(details_of(spark, folder)), "profile")
    chosen = [
        validate.summary_fields(validate.kept_fields(profiled, t)).select(F.lit(t).alias("threshold"), "field")
        for t in (STRICT_THRESHOLD, 0.05, LENIENT_THRESHOLD)
    ]
    return chosen[0].union(chosen[1]).union(chosen[2])


def invalid_topics(spark: SparkSession, folder: str) -> DataFrame:
    rows = batch.validated(*_prepared(spark, folder))
    return rows.select("record_id", F.array_join("topics", ",").alias("topics"))


def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct summaries, apart from their record ids, that fail a kept field, under each such field."""
    details, prepared = _prepared(spark, folder)
    return validate.failing_by_field(batch.repaired_summary(details, prepared).drop("record_id"), prepared.rules)


def route_fanout(spark: SparkSession, folder: str) -> DataFrame:
    routed = route.fan_out(batch.validated(*_prepared(spark, folder)))
    return routed.select(*CODES, "topic")


def clean_incidents(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder)


# --- codes


def id_name_map(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _pairs(spark, folder)
    airports, species = (
        codes.id_name_map(pairs, kind).select(F.lit(kind).alias("kind"), "id", "name") for kind in codes.CODE_COLUMNS
    )
    return airports.union(species)


def multi_code(spark: SparkSession, folder: str) -> DataFrame:
    return codes.ambiguous_codes(_pairs(spark, folder))


def mapping_direction(spark: SparkSession, folder: str) -> DataFrame:
    return codes.mapping_directions(_pairs(spark, folder))


def mapping_orientation(spark: SparkSession, folder: str) -> DataFrame:
    return codes.mapping_orientation(_swapped_pairs(spark, folder))


def unknown_species(spark: SparkSession, folder: str) -> DataFrame:
    return codes.unknown_codes(_pairs(spark, folder))


def canonical_id_sync(spark: SparkSession, folder: str) -> DataFrame:
    return batch.repaired_summary(*_prepared(spark, folder)).select(CODES)


def _swapped_details(spark: SparkSession, folder: str) -> DataFrame:
    """Records in which some airport ids hold the name of another airport."""
    following = (F.substring("airport_name", 8, 10).cast("int") + 1) % 25
    misplaced = F.concat(F.lit("NATION_"), following.cast("string"))
    is_swapped = F.col("airport_id").rlike("^K.*3$")
    details = details_of(spark, folder)
    return details.withColumn("airport_id", F.when(is_swapped, misplaced).otherwise(F.col("airport_id")))


def _swapped_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return stage(codes.code_pairs(_swapped_details(spark, folder)), "pairs")


def swapped_codes(spark: SparkSession, folder: str) -> DataFrame:
    repairs = stage(codes.code_repairs(_swapped_pairs(spark, folder)), "repairs")
    needed = codes.needed_lookups(repairs)
    return codes.apply_repairs(_swapped_details(spark, folder).select(CODES), repairs, needed)


# --- aggregates and ranking


def grouped_incidents(spark: SparkSession, folder: str) -> DataFrame:
    return totals.grouped(_clean(spark, folder)).drop("creatures")


def grouped_creatures(spark: SparkSession, folder: str) -> DataFrame:
    return totals.grouped(_clean(spark, folder)).drop("incidents")


def yearly_totals(spark: SparkSession, folder: str) -> DataFrame:
    return totals.yearly_totals(totals.grouped(_clean(spark, folder)))


def topn_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return batch.top_n_per_year(details_of(spark, folder))


def topn_creatures(spark: SparkSession, folder: str) -> DataFrame:
    """The same ranking by creatures instead of incidents."""
    per_key = totals.grouped(_clean(spark, folder))
    return rank.in_output_order(rank.top_n_per_year(totals.yearly_totals(per_key, "creatures")))


def topn_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked rows nested per year, through the JSON array of their topic and back."""
    nested = rank.nested_by_year(topn_per_year(spark, folder))
    stored = stage(topics.ranked_to_envelopes(nested), "topic")
    return rank.exploded_by_year(topics.ranked_from_envelopes(stored))


def distinct_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Per year and species name the id with the largest total."""
    per_year = totals.yearly_incidents(details_of(spark, folder))
    order = [F.desc("amount"), F.asc("species_id")]
    return rank.first_per_key(per_year, ["year", "species_name"], order)


def merge_topn(spark: SparkSession, folder: str) -> DataFrame:
    """A ranking of the first half of each year, then updated with the totals of the whole year."""
    details = details_of(spark, folder)
    half = totals.yearly_incidents(details.filter("month <= 6"))
    return rank.merge_top_n(rank.top_n_per_year(half), totals.yearly_incidents(details))


def latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return totals.latest_by_key(events_of(spark, folder), EVENT_KEY, "value", ["ts", "event_id"])


def tumbling_last(spark: SparkSession, folder: str) -> DataFrame:
    last = totals.tumbling_last(events_of(spark, folder), ["event_type"], "value", "ts", ["event_id"], DAY)
    return _window_seconds(last)


def running_count(spark: SparkSession, folder: str) -> DataFrame:
    counted = totals.running_count(events_of(spark, folder), EVENT_KEY, "ts", ["event_id"])
    return counted.select("event_id", *EVENT_KEY, "running_count")


def windowed_last_sum(spark: SparkSession, folder: str) -> DataFrame:
    last = totals.windowed_running_count(events_of(spark, folder), EVENT_KEY, "ts", DAY)
    return totals.windowed_last_sum(last, ["event_type"], "running_count")


# --- sources and sinks


def _wide_details(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of a raw record; those the tables do not offer follow from the record id."""
    details = details_of(spark, folder)
    record, offered = F.col("record_id"), set(details.columns)
    made = []
    for place, (_, name, dtype) in enumerate(DETAIL_COLUMNS):
        if name in offered:
            made.append(F.col(name))
        elif dtype == "boolean":
            step = (record + place) % 7
            made.append(F.when(step < 6, step < 2).alias(name))
        elif dtype == "string":
            made.append(F.concat(F.lit('a "b", '), (record % (place + 2)).cast("string")).alias(name))
        else:
            made.append((record % (place + 2)).cast(dtype).alias(name))
    return details.select(made)


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "raw-csv")
    csv_files.write_details(_wide_details(spark, folder), path)
    return csv_files.read_details(spark, path)


def csv_untyped(spark: SparkSession, folder: str) -> DataFrame:
    """How often each line of a headed file occurs, with all columns and line breaks in texts, its header line among them.

    Every third record is written without its last column, so the lines differ in width, and the first orders have a text of
    100,000 characters. Each file has a header; a header counts once if there are as many as files.
    """
    path = new_folder(spark, "raw-csv")
    wide = _wide_details(spark, folder)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in wide.columns]
    long = F.when(F.col("record_id").cast("long") < 50, F.repeat(F.lit('x,"'), 33_334)).otherwise("")
    broken = wide.select(texts).withColumn("operator", F.concat("operator", F.lit("\n\"x\","), long))
    narrow, extra = F.col("record_id").cast("long") % 3 == 0, F.lit(0)
    for rows in (broken.filter(~narrow), broken.filter(narrow).drop(wide.columns[-1])):
        before = len(Files(spark).names(f"{path}/part-*"))
        quoting = {"quote": '"', "escape": '"', "emptyValue": ""}
        rows.write.mode("append").options(header=True, compression="gzip", **quoting, **csv_files.GZIP_FAST).csv(path)
        files = len(Files(spark).names(f"{path}/part-*")) - before
        extra = F.when(F.col("line") == "|".join(rows.columns), files - 1).otherwise(extra)
    lines = csv_files.read_untyped(spark, path).select(F.array_join("fields", "|").alias("line"))
    return lines.groupBy("line").agg(F.count("*").alias("n")).select("line", (F.col("n") - extra).alias("n"))


def csv_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "ranked-csv")
    csv_files.write_ranked(topn_per_year(spark, folder), path)
    return csv_files.read_ranked(spark, path)


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    envelopes = topics.to_envelopes(normalize_summary(spark, folder))
    return topics.summaries(stage(envelopes, "topic"))


def envelope(spark: SparkSession, folder: str) -> DataFrame:
    stored = stage(topics.to_envelopes(normalize_summary(spark, folder)), "topic")
    header = F.col("headers")[0]
    decoded = stored.select(
        decode("key", KEY).alias("key"),
        decode("value", SUMMARY).alias("value"),
        header["key"].alias("header"),
        F.length(header["value"]).alias("uuid_length"),
    )
    return decoded.select("value.record_id", "key.*", "header", "uuid_length")


# --- streams


def _detail_stream(spark: SparkSession, folder: str) -> DataFrame:
    return details_of(spark, folder, table_stream(spark, folder, "lineitem"))


def _stream_of(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the work folder and read back as a stream."""
    staged = new_folder(rows.sparkSession, label)
    rows.write.parquet(staged)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(staged)


def stream_source(spark: SparkSession, folder: str) -> DataFrame:
    """Records through the raw topic: written by one stream, read and decoded by the next."""
    topic, rows = new_folder(spark, "raw-topic"), new_folder(spark, "rows")
    envelopes = topics.to_envelopes(narrow.to_summary(_detail_stream(spark, folder)))
    drain(topics.topic_sink(envelopes, new_folder(spark, "state"), topic))
    read = topics.summaries(topics.topic_source(spark, topic))
    drain(jobs.append_rows(read, rows, new_folder(spark, "state")))
    return spark.read.schema(SUMMARY).parquet(rows)


def stream_static(spark: SparkSession, folder: str) -> DataFrame:
    """Streamed records with repairs and rules of the batch preparation, routed to the quarantine topics."""
    details, kept = details_of(spark, folder), new_folder(spark, "preparation")
    batch.store(batch.prepare(details), kept)
    # as after a restart: rules and repairs come from the store, and the raw records are not looked at again
    prepared = batch.stored(spark, kept)
    path = new_folder(spark, "quarantine")
    validated = batch.validated(_detail_stream(spark, folder), prepared)
    drain(jobs.quarantine(validated, path, new_folder(spark, "state")))
    return spark.read.parquet(path).select(*CODES, "topic")


def replay_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Clean rows of the replayed raw topic, read back from the clean topic."""
    details, prepared = _prepared(spark, folder)
    raw, path = new_folder(spark, "raw-topic"), new_folder(spark, "clean-topic")
    repaired = batch.repaired_summary(details, prepared)
    topics.to_envelopes(repaired).write.parquet(raw)
    replayed = topics.summaries(topics.topic_source(spark, raw, per_trigger=4))
    drain(jobs.clean_topic(route.with_topics(replayed, prepared.rules), path, new_folder(spark, "state")))
    return topics.summaries(topics.read_topic(spark, path))


def _clean_stream(spark: SparkSession, folder: str) -> DataFrame:
    _, prepared = _prepared(spark, folder)
    return batch.clean_incidents(_detail_stream(spark, folder), prepared)


def _dated(rows: DataFrame) -> DataFrame:
    """With the day of the incident as its time, which reads the same in every time zone."""
    return rows.withColumn("ts", F.timestamp_seconds(F.unix_date(F.make_date("year", "month", "day")) * 86_400))


def _drain_topic(writer: DataStreamWriter, spark: SparkSession, topic: str) -> None:
    """``drain`` of a stream over a topic that is whole, with state for what it holds."""
    with state_for(spark, Files(spark).size(topic)):
        drain(writer)


@dataclass(frozen=True)
class _Offer:
    """Records as a topic stream, ``rows``, whose micro-batches are the windows of their time, in order, of however many files."""

    replay: Replay
    topic: str
    rows: DataFrame

    @classmethod
    def of(cls, envelopes: DataFrame, width: str, label: str) -> _Offer:
        spark = envelopes.sparkSession
        topic = new_folder(spark, label)
        Files(spark).make(topic)
        return cls(Replay.by_time(envelopes, width, gathered=False), topic, topics.topic_source(spark, topic))

    def drain(self, writer: DataStreamWriter) -> None:
        """Each window is a micro-batch of the query that ``writer`` starts."""
        drain_ticks(self.replay, self.topic, writer)


def _clean_batches(spark: SparkSession, folder: str) -> _Offer:
    """Clean incidents with their time as a stream of several batches in the order of time, from the raw topic."""
    details, prepared = _prepared(spark, folder)
    raw = topics.to_envelopes(_dated(narrow.to_summary(details)), at="ts")
    offer = _Offer.of(raw, INCIDENT_WINDOW, "raw-topic")
    return replace(offer, rows=batch.clean_summaries(topics.summaries(offer.rows, "ts"), prepared))


def stream_grouped(spark: SparkSession, folder: str) -> DataFrame:
    log = jobs.counts_log(new_folder(spark, "counts"))
    drain(jobs.count_keys(_clean_stream(spark, folder), log, new_folder(spark, "state")))
    return log.latest(spark)


def grouped_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Counts through their changelog topics, the latest record of each key."""
    paths = new_folder(spark, "grouped-incidents"), new_folder(spark, "grouped-creatures")
    clean = _clean_batches(spark, folder)
    clean.drain(jobs.publish_counts(clean.rows, *paths, new_folder(spark, "state"), "ts"))
    latest = []
    for path, name in zip(paths, ("incidents", "creatures")):
        records = topics.grouped_counts(spark.read.parquet(path))
        kept = totals.latest_by_key(records, KEY.fieldNames(), "amount", ["id"])
        latest.append(kept.select(*KEY.fieldNames(), F.lit(name).alias("measure"), "amount"))
    return latest[0].unionByName(latest[1])


def replay_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Changelog topics of a stream that fails after a batch is written and before it is committed, and starts again.

    A second stream reads the topics before and after; ``doubled`` is how many records of a key it was given more than once.
    """
    names = ("incidents", "creatures")
    paths = {name: new_folder(spark, f"grouped-{name}") for name in names}
    read, reading = ({name: new_folder(spark, label) for name in names} for label in ("read", "state"))
    publish, state = jobs.publisher(paths, time="ts"), new_folder(spark, "state")
    clean = _clean_batches(spark, folder)
    counted = totals.grouped(clean.rows, "ts")

    def written_but_not_committed(rows: DataFrame, batch_id: int) -> None:
        publish(rows, batch_id)
        if batch_id == 1:
            raise RuntimeError("failure for the sake of the query")

    def read_on() -> None:
        for name in names:
            records = topics.topic_source(spark, paths[name]).withColumn("batch", topics.batch_of())
            amounts = topics.grouped_counts(records).select(*KEY.fieldNames(), "amount", "batch")
            drain(jobs.append_rows(amounts, read[name], reading[name]))

    try:
        clean.drain(jobs.each_batch(counted, written_but_not_committed, state))
    except StreamingQueryException:
        read_on()
    # the batch that failed comes first, then the windows that were not offered yet
    drain(jobs.each_batch(counted, publish, state))
    clean.drain(jobs.each_batch(counted, publish, state))
    read_on()
    measures = []
    for name in names:
        times = spark.read.parquet(read[name]).groupBy(*KEY.fieldNames(), "batch").agg(F.max("amount").alias("amount"), F.count("*").alias("n"))
        latest = F.max_by("amount", "batch").alias("amount")
        of_key = times.groupBy(*KEY.fieldNames()).agg(latest, F.sum(F.col("n") - 1).alias("doubled"))
        measures.append(of_key.withColumn("measure", F.lit(name)))
    both = measures[0].unionByName(measures[1]).groupBy(*KEY.fieldNames())
    amount = lambda name: F.max(F.when(F.col("measure") == name, F.col("amount"))).alias(name)
    return both.agg(*[amount(name) for name in names], F.sum("doubled").alias("doubled"))


def stream_topn(spark: SparkSession, folder: str) -> DataFrame:
    counts = jobs.counts_log(new_folder(spark, "counts"))
    ranking = jobs.ranking_log(new_folder(spark, "ranking"))
    clean = _clean_batches(spark, folder)
    clean.drain(jobs.rank_years(clean.rows, counts, ranking, new_folder(spark, "state")))
    return rank.exploded_by_year(ranking.latest(spark))


def snapshot_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Both outputs as their own clock writes them, side by side."""
    counts = jobs.counts_log(new_folder(spark, "counts"))
    ranking = jobs.ranking_log(new_folder(spark, "ranking"))
    outputs = new_folder(spark, "from-counts"), new_folder(spark, "from-ranking")
    clean = _clean_batches(spark, folder)
    clean.drain(jobs.rank_years(clean.rows, counts, ranking, new_folder(spark, "state")))
    clock = jobs.rewrite_outputs(counts, ranking, outputs, spark, tick="1 second").start()
    try:
        ticked(clock)
    finally:
        clock.stop()
    first, second = (
        csv_files.read_published(spark, path).withColumn("output", F.lit(name))
        for path, name in zip(outputs, ("counts", "ranking"))
    )
    return first.unionByName(second)


def stream_windowed_topn(spark: SparkSession, folder: str) -> DataFrame:
    """The chain of the topics: clean incidents, counts per key, last count per window, totals per species and year, ranked years.

    Every step is a stream that reads the topic of the one before; nothing is counted in batch.
    """
    grouped, creatures, windows, ranked = (new_folder(spark, label) for label in ("grouped", "creatures", "windows", "top-n"))
    clean = _clean_batches(spark, folder)
    clean.drain(jobs.publish_counts(clean.rows, grouped, creatures, new_folder(spark, "state"), "ts"))
    counts = topics.grouped_counts(topics.topic_source(spark, grouped, per_trigger=8), time="ts")
    species = GROUPED.fieldNames()
    summed = jobs.sum_windows(counts, KEY.fieldNames(), species, "ts", windows, new_folder(spark, "state"), width=INCIDENT_WINDOW)
    _drain_topic(summed, spark, grouped)
    sums = topics.yearly_counts(topics.topic_source(spark, windows, per_trigger=4))
    _drain_topic(jobs.rank_windows(sums, jobs.totals_log(new_folder(spark, "totals")), ranked, new_folder(spark, "state")), spark, windows)
    records = topics.ranked_from_envelopes(spark.read.parquet(ranked))
    latest = records.groupBy("year").agg(F.max_by("ranked", "id").alias("ranked"))
    return rank.exploded_by_year(latest)


def _closed(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    spark = rows.sparkSession
    path, state = new_folder(spark, "windows"), new_folder(spark, "state")
    drain(jobs.close_windows(rows, keys, value, "ts", path, state, order, DAY))
    return spark.read.parquet(path)


def stream_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    stream = events_of(spark, folder, table_stream(spark, folder, "events"))
    return _window_seconds(_closed(stream, ["event_type"], "value", ["event_id"]))


def stream_windowed_last_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Events through topics: counts per key as they change, the last count per window, and the sums of the closed windows."""
    events = events_of(spark, folder)
    key = T.StructType([events.schema[c] for c in EVENT_KEY])
    group = T.StructType([events.schema["event_type"]])
    raw = _Offer.of(topics.to_envelopes(events, key, "value", "ts"), DAY, "events-topic")
    counted = topics.from_envelopes(raw.rows, key, T.DoubleType()).groupBy("key").agg(
        F.count(F.lit(1)).alias("amount"), F.max("timestamp").alias("ts")
    )
    grouped, windows = new_folder(spark, "grouped-topic"), new_folder(spark, "windows-topic")
    publish = jobs.publisher({"amount": grouped}, key, "ts")
    raw.drain(jobs.each_batch(counted.select("key.*", "amount", "ts"), publish, new_folder(spark, "state")))
    counts = topics.grouped_counts(topics.topic_source(spark, grouped, per_trigger=8), key, "ts")
    _drain_topic(jobs.sum_windows(counts, EVENT_KEY, ["event_type"], "ts", windows, new_folder(spark, "state"), width=DAY), spark, grouped)
    log = UpsertLog(new_folder(spark, "totals"), ["event_type"], ["amount"])
    sums = topics.from_envelopes(topics.topic_source(spark, windows), group, T.LongType())
    added = jobs.add_windows(sums.select("key.*", F.col("value").alias("amount")), ["event_type"], log, new_folder(spark, "state"))
    _drain_topic(added, spark, windows)
    return log.latest(spark).withColumnRenamed("amount", "total")


def late_drop(spark: SparkSession, folder: str) -> DataFrame:
    """Quarters of the event time arriving in the order third, fourth, first, second: the last two are too late."""
    events = events_of(spark, folder)
    micros = F.unix_micros(F.col("ts"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    quarter = (high - low) // 4
    arrivals, path, state = (new_folder(spark, label) for label in ("arrivals", "windows", "state"))
    for part in (2, 3, 0, 1):
        start = low + part * quarter
        arrived = events.filter((micros >= start) & ((micros < start + quarter) | F.lit(part == 3)))
        arrived.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        counted = stream.withWatermark("ts", "0 seconds").groupBy(F.window("ts", DAY).alias("w"), "event_type")
        closed = counted.agg(F.count(F.lit(1)).alias("n")).select(
            F.unix_timestamp("w.start").alias("window_start"), "event_type", "n"
        )
        drain(jobs.append_rows(closed, path, state))
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    "topn_per_year": topn_per_year,
    "yearly_totals": yearly_totals,
    "grouped_incidents": grouped_incidents,
    "grouped_creatures": grouped_creatures,
    "topn_creatures": topn_creatures,
    "clean_incidents": clean_incidents,
    "normalize_summary": normalize_summary,
    "parse_quantity": quantity_forms,
    "upper_ids": upper_ids,
    "rule_profile": rule_profile,
    "rule_selection": rule_selection,
    "invalid_topics": invalid_topics,
    "route_fanout": route_fanout,
    "dedup_rows": dedup_rows,
    "id_name_map": id_name_map,
    "multi_code": multi_code,
    "mapping_direction": mapping_direction,
    "mapping_orientation": mapping_orientation,
    "unknown_species": unknown_species,
    "canonical_id_sync": canonical_id_sync,
    "swapped_codes": swapped_codes,
    "distinct_by_key": distinct_by_key,
    "merge_topn": merge_topn,
    "topn_nested": topn_nested,
    "latest_by_key": latest_by_key,
    "tumbling_last": tumbling_last,
    "running_count": running_count,
    "windowed_last_sum": windowed_last_sum,
    "csv_roundtrip": csv_roundtrip,
    "csv_untyped": csv_untyped,
    "csv_sink": csv_sink,
    "json_roundtrip": json_roundtrip,
    "envelope": envelope,
    "stream_source": stream_source,
    "stream_static": stream_static,
    "replay_equals_batch": replay_equals_batch,
    "stream_grouped": stream_grouped,
    "grouped_topics": grouped_topics,
    "replay_idempotent": replay_idempotent,
    "stream_topn": stream_topn,
    "snapshot_sink": snapshot_sink,
    "stream_windowed_topn": stream_windowed_topn,
    "stream_tumbling": stream_tumbling,
    "stream_windowed_last_sum": stream_windowed_last_sum,
    "late_drop": late_drop,
}
