import random

from conftest import SMALL, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from strikelens.operators import rank, totals
from strikelens.plans.tables import events_of

AT = "timestamp_seconds(at) AS ts"


def changes(spark, *values):
    """Rows (k, n, ts) from (key, value, seconds)."""
    return spark.createDataFrame(values, "k string, n bigint, at int").selectExpr("k", "n", AT)


def test_last_per_window_then_sum(spark):
    frame = changes(spark, ("a", 1, 1), ("a", 2, 5), ("a", 3, 14))
    last = totals.tumbling_last(frame, ["k"], "n", "ts")
    assert [r.n for r in last.orderBy("window_start").collect()] == [2, 3]
    assert rows(totals.windowed_last_sum(last, ["k"], "n")) == [("a", 5)]
    assert rows(totals.latest_by_key(frame, ["k"], "n", ["ts"])) == [("a", 3)]


def test_equal_times_are_ordered_by_the_next_column(spark):
    frame = changes(spark, ("a", 1, 1), ("a", 2, 1)).withColumn("seq", -F.col("n"))
    assert rows(totals.latest_by_key(frame, ["k"], "n", ["ts", "seq"])) == [("a", 1)]
    assert totals.tumbling_last(frame, ["k"], "n", "ts", ["seq"]).first().n == 1


def test_running_count_of_a_hot_key(spark):
    draw = random.Random(3)
    made = [("hot" if draw.random() < 0.6 else f"k{draw.randrange(9)}", i, draw.randrange(7200)) for i in range(3000)]
    counted = totals.running_count(changes(spark, *made), ["k"], "ts", ["n"])
    seen, expected = {}, []
    for k, n, _ in sorted(made, key=lambda row: (row[2], row[1])):
        seen[k] = seen.get(k, 0) + 1
        expected.append((k, n, seen[k]))
    assert rows(counted.select("k", "n", "running_count")) == sorted(expected, key=repr)


def test_running_count_keeps_null_keys(spark):
    counted = totals.running_count(changes(spark, (None, 1, 1), (None, 2, 90), ("a", 3, 5)), ["k"], "ts")
    assert rows(counted.select("k", "n", "running_count")) == [("a", 3, 1), (None, 1, 1), (None, 2, 2)]


def test_windowed_running_count_equals_last_of_running_count(spark):
    events = events_of(spark, SMALL)
    keys = ["user_id", "event_type"]
    short = totals.windowed_running_count(events, keys, "ts", "6 hours")
    counted = totals.running_count(events, keys, "ts", ["event_id"])
    long = totals.tumbling_last(counted, keys, "running_count", "ts", ["event_id"], "6 hours")
    assert rows(short) == rows(long)


def test_windowed_sum_counts_a_key_once_per_window(spark):
    events = events_of(spark, "/root/testdata/sf0.01")
    last = totals.windowed_running_count(events, ["user_id", "event_type"], "ts", "1 day")
    windowed = dict(rows(totals.windowed_last_sum(last, ["event_type"], "running_count")))
    assert windowed["click"] == 12432 and windowed["error"] == 12477


def test_missing_quantities_do_not_spoil_a_sum(spark):
    schema = (
        "year int, month int, species_id string, species_name string, aircraft_damage boolean, "
        "species_quantity_min int, species_quantity_max int"
    )
    same = (2000, 1, "S", "GULL", True)
    frame = spark.createDataFrame([(*same, 2, 10), (*same, None, None), (2001, 1, "S", "GULL", True, None, 3)], schema)
    assert rows(totals.grouped(frame).select("year", "incidents", "creatures")) == [(2000, 2, 6), (2001, 1, 0)]


YEARLY = "year int, species_id string, species_name string, amount bigint"


def yearly(spark, *amounts):
    return spark.createDataFrame([(2000, s, s.upper(), n) for s, n in amounts], YEARLY)


def ranking(frame):
    return [(r["index"], r.species_id, r.amount) for r in rank.in_output_order(frame).collect()]


def test_equal_amounts_are_ranked_by_code(spark):
    frame = yearly(spark, ("c", 5), ("a", 5), ("b", 7), ("d", 5))
    assert ranking(rank.top_n_per_year(frame, 3)) == [(0, "b", 7), (1, "a", 5), (2, "c", 5)]


def test_fewer_rows_than_asked_for(spark):
    assert ranking(rank.top_n_per_year(yearly(spark, ("a", 1)))) == [(0, "a", 1)]


def test_incremental_ranking(spark):
    ranked = rank.top_n_per_year(yearly(spark), 2)
    for update in [("a", 1), ("b", 2), ("c", 3), ("a", 4)]:
        ranked = rank.merge_top_n(ranked, yearly(spark, update), 2)
    assert ranking(ranked) == [(0, "a", 4), (1, "c", 3)]


def test_incremental_ranking_equals_ranking_of_all(spark):
    draw = random.Random(5)
    amounts, ranked = {}, rank.top_n_per_year(yearly(spark), 5)
    for _ in range(4):
        for _ in range(30):
            species = f"s{draw.randrange(12):02d}"
            amounts[species] = amounts.get(species, 0) + 1
        ranked = spark.createDataFrame(rank.merge_top_n(ranked, yearly(spark, *amounts.items())).collect(), ranked.schema)
    assert ranking(ranked) == ranking(rank.top_n_per_year(yearly(spark, *amounts.items())))


def test_nesting_and_back(spark):
    ranked = rank.top_n_per_year(yearly(spark, ("a", 1), ("b", 2), ("c", 3)), 2)
    nested = rank.nested_by_year(ranked)
    assert [r["index"] for r in nested.first().ranked] == [0, 1]
    assert rows(rank.exploded_by_year(nested)) == rows(ranked)


def test_first_per_key(spark):
    frame = spark.createDataFrame([("s1", 5), ("s2", 4), ("s1", 3)], "s string, n int")
    assert rows(rank.first_per_key(frame, ["s"], [F.desc("n")])) == [("s1", 5), ("s2", 4)]


def test_each_year_is_cut_before_the_shuffle(spark):
    plan = rank.top_n_per_year(yearly(spark, ("a", 1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_running_count_of_a_hot_key_spreads(spark):
    # all rows of one key within a second, others around it, null keys among them
    frame = spark.range(4000).selectExpr(
        "CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 = 7 THEN NULL ELSE string(id % 5) END AS k", "timestamp_millis(id % 900) AS ts", "id AS i"
    )
    counted = totals.running_count(frame.repartition(3), ["k"], "ts", ["i"])
    expected = Window.partitionBy("k").orderBy("ts", "i")
    assert rows(counted) == rows(frame.withColumn("running_count", F.row_number().over(expected).cast("bigint")))
