import glob
import os
import re
import time

import pyarrow.parquet as pq
import pytest
from conftest import SMALL, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikelens.functions.rules import FIELD_RULES
from strikelens.operators import rank, route, totals
from strikelens.plans import batch, catalogue
from strikelens.plans.tables import details_of, events_of, table, table_stream
from strikelens.runtime import OPEN_FILES, STATE_BYTES, state_for
from strikelens.schemas import KEY, RANKED, SUMMARY
from strikelens.sources import csv_files, topics
from strikelens.streaming import jobs
from strikelens.streaming.changelog import Changelog
from strikelens.streaming.replay import Replay
from strikelens.streaming.run import drain, drain_ticks, paced, ticked
from strikelens.streaming.upserts import UpsertLog

FILES = 4


def in_files(df, path, order=range(FILES), by="ts"):
    """``df`` in one file per quarter of ``by``, which a stream reads in the given order."""
    edges = df.select(F.unix_micros(by).alias("m")).approxQuantile("m", [i / FILES for i in range(FILES + 1)], 0.0)
    micros = F.unix_micros(by)
    for age, part in enumerate(order):
        chosen = (micros >= edges[part]) & ((micros < edges[part + 1]) | F.lit(part == FILES - 1))
        before = set(os.listdir(path)) if os.path.isdir(path) else set()
        df.filter(chosen).coalesce(1).write.mode("append").parquet(path)
        for name in set(os.listdir(path)) - before:
            if name.endswith(".parquet"):
                os.utime(f"{path}/{name}", (1_700_000_000 + age, 1_700_000_000 + age))
    return path


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def incidents(spark, tmp_path_factory):
    """Clean incidents in several files, and the batch preparation they came from."""
    view = details_of(spark, SMALL)
    prepared = batch.prepare(view)
    path = str(tmp_path_factory.mktemp("clean") / "rows")
    batch.clean_incidents(view, prepared).repartition(FILES).write.parquet(path)
    return spark.read.parquet(path), path, prepared


def expected_ranking(clean):
    return rows(rank.top_n_per_year(totals.yearly_totals(totals.grouped(clean))))


def test_counts_over_several_batches(spark, incidents, folder):
    clean, path, _ = incidents
    log = jobs.counts_log(folder(), fold_every=2)
    query = drain(jobs.count_keys(stream(spark, path, clean.schema), log, folder()))
    assert query.lastProgress["batchId"] >= FILES - 1
    assert rows(log.latest(spark)) == rows(totals.grouped(clean))
    assert os.path.isdir(f"{log.path}/bases/id=3")


def test_ranking_over_several_batches(spark, incidents, folder):
    clean, path, _ = incidents
    counts, ranking = jobs.counts_log(folder(), fold_every=3), jobs.ranking_log(folder(), fold_every=2)
    drain(jobs.rank_years(stream(spark, path, clean.schema), counts, ranking, folder()))
    assert rows(rank.exploded_by_year(ranking.latest(spark))) == expected_ranking(clean)


def test_stopped_and_started_again(spark, incidents, folder):
    clean, path, _ = incidents
    first, arrivals, state = clean.filter("month <= 6"), folder(), folder()
    counts, ranking = jobs.counts_log(folder()), jobs.ranking_log(folder())
    for part in (first, clean.filter("month > 6")):
        part.write.mode("append").parquet(arrivals)
        source = spark.readStream.schema(clean.schema).parquet(arrivals)
        drain(jobs.rank_years(source, counts, ranking, state))
        arrived = spark.read.schema(clean.schema).parquet(arrivals)
        assert rows(rank.exploded_by_year(ranking.latest(spark))) == expected_ranking(arrived)


def test_both_outputs_are_rewritten_on_their_own_clock(spark, incidents, folder):
    clean, path, _ = incidents
    outputs = folder(), folder()
    logs = jobs.counts_log(folder()), jobs.ranking_log(folder())
    clock = jobs.rewrite_outputs(*logs, outputs, spark, tick="100 milliseconds").start()
    try:
        clock.processAllAvailable()
        # nothing was counted yet
        assert not os.path.exists(outputs[0])
        drain(jobs.rank_years(stream(spark, path, clean.schema), *logs, folder()))
        clock.processAllAvailable()
    finally:
        clock.stop()
    jobs.write_snapshot(*logs, outputs, spark)
    for output in outputs:
        assert rows(csv_files.read_published(spark, output)) == expected_ranking(clean)
        versions = [name for name in os.listdir(output) if name[0].isdigit()]
        assert 1 <= len(versions) <= 2


def test_a_clock_slower_than_its_source_is_waited_for(spark, incidents, folder, monkeypatch):
    clean, path, _ = incidents
    outputs, writes = (folder(), folder()), []
    logs = jobs.counts_log(folder()), jobs.ranking_log(folder())
    drain(jobs.rank_years(stream(spark, path, clean.schema), *logs, folder()))
    write = jobs.write_snapshot

    def slow(*args):
        write(*args)
        writes.append(time.time())
        time.sleep(1.5)

    monkeypatch.setattr(jobs, "write_snapshot", slow)
    clock = jobs.rewrite_outputs(*logs, outputs, spark, tick="1 second").start()
    try:
        ticked(clock)
        ticked(clock)
    finally:
        clock.stop()
    # as nothing was logged in between
    assert len(writes) == 1
    for output in outputs:
        assert rows(csv_files.read_published(spark, output)) == expected_ranking(clean)
    with pytest.raises(Exception, match="stopped"):
        ticked(clock)


def test_a_reader_sees_whole_outputs_only(spark, folder):
    output = folder()
    sizes = []
    for n in range(1, 5):
        frame = spark.range(1, n + 1).selectExpr("0 AS index", "int(id) AS year", "'a' AS species_id", "'A' AS species_name", "id AS amount")
        before = csv_files.read_published(spark, output) if sizes else None
        csv_files.publish_ranked(frame.select(RANKED.fieldNames()).repartition(3), output)
        if before is not None:
            # who began with the former version can end with it
            assert before.count() == sizes[-1]
        sizes.append(csv_files.read_published(spark, output).count())
    assert sizes == [1, 2, 3, 4]
    # a writer that fails leaves the current version as it is
    broken = spark.range(1).selectExpr("int(raise_error('no')) AS index", "1 AS year", "'a' AS species_id", "'A' AS species_name", "id AS amount")
    with pytest.raises(Exception, match="no"):
        csv_files.publish_ranked(broken, output)
    assert csv_files.read_published(spark, output).count() == 4


def test_changelog_topics(spark, incidents, folder):
    clean, path, _ = incidents
    incidents_topic, creatures_topic = folder(), folder()
    drain(jobs.publish_counts(stream(spark, path, clean.schema), incidents_topic, creatures_topic, folder()))
    expected = totals.grouped(clean)
    keys = [c for c in expected.columns if c not in jobs.KEY_COUNTS]
    for topic, measure in ((incidents_topic, "incidents"), (creatures_topic, "creatures")):
        records = topics.grouped_counts(spark.read.parquet(topic))
        assert records.count() > expected.count()
        assert rows(totals.latest_by_key(records, keys, "amount", ["id"])) == rows(expected.select(*keys, measure))


def test_routing_with_frozen_rules(spark, incidents, folder):
    _, _, prepared = incidents
    raw, quarantine = folder(), folder()
    view = details_of(spark, SMALL)
    topics.to_envelopes(batch.repaired_summary(view, prepared)).repartition(FILES).write.parquet(raw)
    summaries = topics.summaries(topics.topic_source(spark, raw, per_trigger=1))
    drain(jobs.quarantine(route.with_topics(summaries, prepared.rules), quarantine, folder()))
    expected = route.fan_out(batch.validated(view, prepared))
    assert rows(spark.read.parquet(quarantine).select(expected.columns)) == rows(expected)
    assert sorted(n for n in os.listdir(quarantine) if n.startswith("topic=")) == [
        "topic=quarantine-other", "topic=quarantine-quantity", "topic=quarantine-species",
    ]


@pytest.mark.parametrize("files", [1, 3])
def test_table_of_any_number_of_files_as_stream(spark, folder, files):
    tables, target = folder(), folder()
    written = table(spark, SMALL, "events").repartition(files)
    written.write.parquet(f"{tables}/events.parquet")
    query = drain(jobs.append_rows(table_stream(spark, tables, "events", files_per_trigger=1), target, folder()))
    assert query.lastProgress["batchId"] == files - 1
    assert rows(spark.read.parquet(target)) == rows(table(spark, SMALL, "events"))


def test_paced_replay(spark, incidents, folder):
    clean, path, _ = incidents
    target = folder()
    query = paced(jobs.append_rows(stream(spark, path, clean.schema), target, folder()), "100 milliseconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.schema(clean.schema).parquet(target)) == rows(clean)


def test_console(spark, incidents):
    clean, path, _ = incidents
    drain(topics.console_sink(stream(spark, path, clean.schema).select("year").limit(1)))


def test_replayed_batch_changes_nothing(spark, folder):
    log = UpsertLog(folder(), ["k"], ["n"], fold_every=2)
    batches = [[("a", 1)], [("a", 2), ("b", 1)], [("a", 3)], [("c", 1)]]
    frames = [spark.createDataFrame(b, "k string, n bigint") for b in batches]
    for i, frame in enumerate(frames):
        log.write(frame, i)
        log.write(frame, i)
    expected = [("a", 3), ("b", 1), ("c", 1)]
    assert rows(log.latest(spark)) == expected
    assert rows(log.latest(spark, 2)) == [("a", 3), ("b", 1)]
    log.write(frames[3], 3)
    assert rows(log.latest(spark)) == expected


def test_empty_batch(spark, folder):
    log = UpsertLog(folder(), ["k"], ["n"])
    log.write(spark.createDataFrame([("a", 1)], "k string, n bigint"), 0)
    log.write(spark.createDataFrame([], "k string, n bigint"), 1)
    assert rows(log.latest(spark)) == [("a", 1)]


def closed_windows(spark, events, order, folder):
    path, target = in_files(events, folder(), order), folder()
    source = stream(spark, path, events.schema)
    drain(jobs.close_windows(source, ["event_type"], "value", "ts", target, folder(), ["event_id"], "1 day"))
    return spark.read.parquet(target)


def test_windows_over_several_batches(spark, folder):
    events = events_of(spark, SMALL)
    closed = closed_windows(spark, events, range(FILES), folder)
    last = events.agg(F.max("ts")).first()[0]
    expected = totals.tumbling_last(events, ["event_type"], "value", "ts", ["event_id"], "1 day")
    assert rows(closed) == rows(expected.filter(F.col("window_end") <= F.lit(last)))


def test_windows_emit_once_and_drop_late_rows(spark, folder):
    events = events_of(spark, SMALL)
    closed = closed_windows(spark, events, [2, 3, 0], folder)
    assert closed.groupBy("window_start", "event_type").count().filter("count > 1").isEmpty()
    start = events.select(F.unix_micros("ts").alias("m")).approxQuantile("m", [0.5], 0.0)[0]
    assert closed.filter(F.unix_micros("window_end") <= start).isEmpty()


def test_log_keeps_a_constant_number_of_folders(spark, folder):
    path = folder()
    log = UpsertLog(path, ["k"], ["n"], fold_every=5)
    counts = []
    for batch in range(30):
        log.write(spark.createDataFrame([(batch % 3, batch)], "k int, n int"), batch)
        counts.append(sum(len(glob.glob(f"{path}/{kind}/id=*")) for kind in ("batches", "bases")))
    assert rows(log.latest(spark)) == [(0, 27), (1, 28), (2, 29)]
    assert max(counts[10:]) == max(counts[20:]) <= 12


# ---- topics that carry time, and what is built on them


def timed(spark, values):
    """(k, n, second) as rows with a time."""
    return spark.createDataFrame(values, "k string, n bigint, second bigint").withColumn("at", F.timestamp_seconds("second"))


K = T.StructType([T.StructField("k", T.StringType())])


def test_records_keep_their_time(spark, folder):
    topic = folder()
    rows_in = timed(spark, [("a", 1, 3), ("b", 2, 5)])
    drain(topics.topic_sink(topics.to_envelopes(stream_of(rows_in, folder()), K, "n", "at"), folder(), topic))
    read = topics.grouped_counts(topics.read_topic(spark, topic), K, "at")
    assert rows(read.select("k", "amount", F.unix_seconds("at"))) == [("a", 1, 3), ("b", 2, 5)]
    # without a column, a record has the time at which it was written
    now = topics.to_envelopes(rows_in, K, "n").select((F.current_timestamp() - F.col("timestamp")).alias("age")).first().age
    assert abs(now.total_seconds()) < 60


def stream_of(df, path):
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def test_a_topic_alone_is_windowed_and_summed(spark, folder):
    # a's count changes twice in the first window and once in the third; c comes too late for the first
    batches = [[("a", 1, 1), ("a", 2, 9), ("b", 5, 3)], [("b", 6, 12)], [("a", 3, 25)], [("b", 7, 50), ("c", 9, 2)]]
    topic, windows = folder(), folder()
    for batch_id, values in enumerate(batches):
        Changelog(topic).publish(topics.to_envelopes(timed(spark, values).coalesce(1), K, "n", "at", batch_id), batch_id)
    counts = topics.grouped_counts(topics.topic_source(spark, topic, per_trigger=1), K, "at").withColumn("g", F.lit("all"))
    query = drain(jobs.sum_windows(counts, ["k", "g"], ["g"], "at", windows, folder(), width="10 seconds"))
    assert query.lastProgress["batchId"] >= 3
    group = T.StructType([T.StructField("g", T.StringType())])
    sums = topics.from_envelopes(topics.read_topic(spark, windows), group, T.LongType())
    assert rows(sums.select(F.unix_seconds("timestamp"), "value")) == [(10, 7), (20, 6), (30, 3)]
    log = UpsertLog(folder(), ["g"], ["amount"])
    added = topics.from_envelopes(topics.topic_source(spark, windows, per_trigger=1), group, T.LongType())
    drain(jobs.add_windows(added.select("key.*", F.col("value").alias("amount")), ["g"], log, folder()))
    assert rows(log.latest(spark)) == [("all", 16)]


def test_chain_of_topics_equals_batch(spark, incidents, folder):
    clean, _, _ = incidents
    dated = clean.withColumn("at", F.timestamp_seconds(F.unix_date(F.make_date("year", "month", "day")) * 86_400))
    topic = folder()
    replay = Replay.by_time(topics.to_envelopes(dated, at="at"), "365 days")
    ticks = len(replay.waiting())
    assert replay.offer(topic, ticks) == ticks >= 7 and replay.waiting() == []
    source = topics.summaries(topics.topic_source(spark, topic, per_trigger=1), "at")
    grouped, creatures, windows, ranked = folder(), folder(), folder(), folder()
    query = drain(jobs.publish_counts(source, grouped, creatures, folder(), "at"))
    assert query.lastProgress["batchId"] >= ticks - 1
    counts = topics.grouped_counts(topics.topic_source(spark, grouped), time="at")
    drain(jobs.sum_windows(counts, KEY.fieldNames(), topics.GROUPED.fieldNames(), "at", windows, folder(), width="365 days"))
    sums = topics.yearly_counts(topics.topic_source(spark, windows, per_trigger=1))
    drain(jobs.rank_windows(sums, jobs.totals_log(folder()), ranked, folder()))
    found = topics.ranked_from_envelopes(spark.read.parquet(ranked)).groupBy("year").agg(F.max_by("ranked", "id").alias("ranked"))
    counted = totals.windowed_running_count(dated, KEY.fieldNames(), "at", "365 days")
    end = dated.agg(F.max("at")).first()[0]
    whole = totals.windowed_last_sum(counted.filter(F.col("window_end") <= F.lit(end)), topics.GROUPED.fieldNames(), "running_count")
    expected = rank.top_n_per_year(whole.withColumnRenamed("total", "amount"))
    assert rows(rank.exploded_by_year(found)) == rows(expected) != []


@pytest.mark.parametrize("moment", ["before", "between", "after"])
def test_a_batch_that_fails_is_in_the_topics_once(spark, incidents, folder, moment, monkeypatch):
    clean, path, _ = incidents
    paths, state, seen, reading = {"incidents": folder(), "creatures": folder()}, folder(), folder(), folder()
    publish = jobs.publisher(paths)
    write = Changelog.publish

    def failing(batch, batch_id):
        if batch_id == 1 and moment == "before":
            raise RuntimeError("failed")
        publish(batch, batch_id)
        if batch_id == 1 and moment == "after":
            raise RuntimeError("failed")

    def one_topic_only(self, records, batch_id):
        if batch_id == 1 and self.path == paths["creatures"]:
            raise RuntimeError("failed")
        return write(self, records, batch_id)

    def read_on():
        drain(jobs.append_rows(topics.topic_source(spark, paths["creatures"]).select("key", "value"), seen, reading))

    counted = totals.grouped(stream(spark, path, clean.schema))
    if moment == "between":
        monkeypatch.setattr(Changelog, "publish", one_topic_only)
    with pytest.raises(StreamingQueryException):
        drain(jobs.each_batch(counted, failing, state))
    monkeypatch.undo()
    read_on()
    drain(jobs.each_batch(counted, publish, state))
    read_on()
    topic = spark.read.parquet(paths["creatures"])
    assert rows(spark.read.parquet(seen)) == rows(topic.select("key", "value"))
    latest = totals.latest_by_key(topics.grouped_counts(topic), KEY.fieldNames(), "amount", ["id"])
    assert rows(latest) == rows(totals.grouped(clean).drop("incidents"))
    assert Changelog(paths["creatures"]).batches(spark) == Changelog(paths["incidents"]).batches(spark) == list(range(FILES))


def test_records_that_come_twice_are_taken_once(spark, folder):
    topic, target = folder(), folder()
    first = topics.to_envelopes(timed(spark, [("a", 1, 1), ("b", 1, 2)]), K, "n", "at", 0)
    for records in (first, first, topics.to_envelopes(timed(spark, [("a", 2, 3)]), K, "n", "at", 1)):
        records.write.mode("append").parquet(topic)
    read = topics.once(topics.topic_source(spark, topic).withWatermark("timestamp", "1 hour"))
    drain(jobs.append_rows(read.select("key", "value", topics.batch_of().alias("batch")), target, folder()))
    found = spark.read.parquet(target)
    assert rows(found) == [('{"k":"a"}', "1", 0), ('{"k":"a"}', "2", 1), ('{"k":"b"}', "1", 0)]


def test_ranking_reads_touched_years_only(spark, incidents, folder):
    clean, _, _ = incidents
    dated = clean.withColumn("at", F.timestamp_seconds(F.unix_date(F.make_date("year", "month", "day")) * 86_400))
    topic = folder()
    replay = Replay.by_time(topics.to_envelopes(dated, at="at"), "240 days")
    ticks = replay.offer(topic, 99)
    assert ticks >= 10
    counts, ranking = jobs.counts_log(folder(), fold_every=4), jobs.ranking_log(folder())
    drain(jobs.rank_years(topics.summaries(topics.topic_source(spark, topic, per_trigger=1)), counts, ranking, folder()))
    assert rows(rank.exploded_by_year(ranking.latest(spark))) == expected_ranking(clean)
    touched = counts.touched(spark, ticks - 1)
    assert 1 <= len(touched) <= 2
    plan = counts.latest(spark, only=touched)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^]]*year", plan)) == plan.count("FileScan") > 0
    assert rows(counts.latest(spark)) == rows(totals.grouped(clean))


def test_log_keeps_null_partitions(spark, folder):
    log = UpsertLog(folder(), ["year"], ["n"], partition="year")
    log.write(spark.createDataFrame([(1, 1), (None, 2), (3, 3)], "year int, n bigint"), 0)
    assert set(log.touched(spark, 0)) == {1, None, 3}
    assert rows(log.latest(spark, only=[None]).select("year", "n")) == [(None, 2)]
    assert rows(log.latest(spark, only=[3, None]).select("year", "n")) == [(3, 3), (None, 2)]
    assert rows(log.latest(spark, only=[])) == []


# ---- replay


def test_replay_offers_bounded_batches_in_order(spark, folder):
    topic, target = folder(), folder()
    values = timed(spark, [(f"k{i}", i, i) for i in range(3500)]).repartition(7)
    replay = Replay.by_rows(topics.to_envelopes(values, K, "n", "at"), [F.col("timestamp")])
    assert replay.offer(topic, 2) == 2 and len(replay.waiting()) == 2
    # after a restart the remainder is offered
    again = Replay(spark, replay.folder)
    source = topics.topic_source(spark, topic, per_trigger=1)
    seen = []

    def see(batch, batch_id):
        amounts = topics.grouped_counts(batch, K).agg(F.count("*").alias("n"), F.min("amount").alias("low"), F.max("amount").alias("high"))
        seen.append(tuple(amounts.first()))

    state = folder()
    drain(jobs.each_batch(source, see, state))
    assert again.offer_paced(topic, seconds=0.01) == 2 and again.offer(topic) == 0
    drain(jobs.each_batch(source, see, state))
    assert seen == [(1000, 0, 999), (1000, 1000, 1999), (1000, 2000, 2999), (500, 3000, 3499)]


# ---- stored preparations


def test_restart_uses_the_stored_preparation(spark, folder):
    kept = folder()
    view = details_of(spark, SMALL)
    first = batch.prepared_once(view, kept)
    expected = rows(batch.clean_incidents(view, first))
    # the raw records have changed: another preparation would choose other rules
    changed = view.withColumn("aircraft_mass", F.lit(None).cast("float")).withColumn("airport_name", F.lit(""))
    assert set(batch.prepare(changed).rules) != set(first.rules)
    again = batch.prepared_once(changed, kept)
    assert again.rules == first.rules and again.lookups == first.lookups
    assert rows(again.repairs) == rows(first.repairs) and rows(again.profile) == rows(first.profile)
    target = folder()
    source = table_stream(spark, SMALL, "lineitem")
    drain(jobs.append_rows(batch.clean_incidents(details_of(spark, SMALL, source), again), target, folder()))
    assert rows(spark.read.schema(SUMMARY).parquet(target)) == expected
    # a new version takes its place, and the former one stays for streams that use it
    batch.store(batch.prepare(changed), kept)
    assert batch.stored(spark, kept).rules != first.rules and rows(again.repairs) == rows(first.repairs)
    assert batch.stored(spark, folder()) is None


def test_a_record_is_decoded_once(spark, incidents, folder):
    clean, _, _ = incidents
    topic = folder()
    topics.to_envelopes(clean).write.parquet(topic)
    rules = {field: rule for field, rule in FIELD_RULES.items() if field in SUMMARY.fieldNames()}
    read = topics.summaries(topics.read_topic(spark, topic))
    again = route.clean(route.with_topics(read, rules))
    assert again._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert rows(again.select(clean.columns)) == rows(route.clean(route.with_topics(clean, rules)))
    # an empty record is a row all the same
    nothing = spark.createDataFrame([(None, None, None, None)], topics.ENVELOPE)
    assert rows(topics.summaries(nothing)) == [(None,) * len(SUMMARY)]
    assert rows(topics.grouped_counts(nothing)) == [(None,) * (len(KEY) + 1)]


def test_files_of_a_changelog_follow_its_size(spark, folder):
    values, topic, windows = folder(), folder(), folder()
    timed(spark, [(f"k{i}", i, 1) for i in range(100)]).write.parquet(values)
    counts = stream(spark, values, spark.read.parquet(values).schema).groupBy("k").agg(F.count("*").alias("n"), F.max("at").alias("at"))
    drain(jobs.each_batch(counts, jobs.publisher({"n": topic}, K, "at"), folder()))
    assert len(glob.glob(f"{topic}/id=0/part-*")) == 1
    read = topics.grouped_counts(topics.topic_source(spark, topic), K, "at")
    drain(jobs.sum_windows(read, ["k"], ["k"], "at", windows, folder()))
    assert all(len(glob.glob(f"{batch}/part-*")) == 1 for batch in glob.glob(f"{windows}/id=*"))


def test_state_has_partitions_for_its_input(spark):
    conf = lambda: spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for size, wanted in ((0, 8), (STATE_BYTES * 50, 50), (STATE_BYTES * 500, 200)):
            with state_for(spark, size):
                assert conf() == str(wanted)
        assert conf() == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_tick_of_several_files_is_one_batch(spark, folder):
    source, topic, target = folder(), folder(), folder()
    values = topics.to_envelopes(timed(spark, [(f"k{i}", i, i % 2 * 100) for i in range(20)]), K, "n", "at")
    for tick in (0, 1):
        values.repartition(5).write.parquet(f"{source}/tick={tick}")
    os.makedirs(topic)
    query = drain_ticks(Replay(spark, source), topic, jobs.append_rows(topics.topic_source(spark, topic), target, folder()))
    assert query.lastProgress["batchId"] == 1 and spark.read.parquet(target).count() == 40


def test_offered_records_are_written_once_and_not_shuffled(spark, incidents):
    clean, _, _ = incidents
    dated = clean.withColumn("at", F.timestamp_seconds(F.unix_date(F.make_date("year", "month", "day")) * 86_400))
    raw = topics.to_envelopes(dated, at="at")
    next_shuffle = spark.sparkContext._jsc.sc().newShuffleId
    before = next_shuffle()
    offer = catalogue._Offer.of(raw, "730 days", "raw-topic")
    assert next_shuffle() == before + 1
    assert len(offer.replay.waiting()) == offer.replay.offer(offer.topic, 99) >= 3
    written = glob.glob(f"{offer.topic}/*.parquet")
    assert {pq.ParquetFile(path).metadata.row_group(0).column(1).compression for path in written} == {"ZSTD"}
    texts = ["key", "value", "timestamp"]
    assert rows(topics.read_topic(spark, offer.topic).select(texts)) == rows(raw.select(texts)) != []


def test_more_ticks_than_open_files(spark, folder):
    n = OPEN_FILES * 3
    values = timed(spark, [(f"k{i}", i, i % n * 100) for i in range(n * 4)] + [("none", -1, None)]).repartition(2)
    topic = folder()
    replay = Replay.by_time(topics.to_envelopes(values, K, "n", "at"), "100 seconds", gathered=False)
    assert replay.offer(topic, n + 1) == n
    read = topics.grouped_counts(topics.read_topic(spark, topic).withColumn("file", F.input_file_name()), K, "at")
    assert sorted(r.amount for r in read.collect()) == list(range(n * 4))
    assert read.groupBy("file").agg(F.countDistinct("at").alias("n")).filter("n != 1").count() == 0


def test_what_the_scan_of_a_preparation_shuffled_is_gone(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    first = spark.sparkContext._jsc.sc().newShuffleId() + 1
    prepared = batch.prepare(details_of(spark, SMALL))
    left = lambda: [f for at in folders for f in glob.glob(f"{at}/*/shuffle_{first}_*")]
    until = time.time() + 10
    while left() and time.time() < until:
        time.sleep(0.1)
    assert left() == [] and prepared.pairs.count() > 0
