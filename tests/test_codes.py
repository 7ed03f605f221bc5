import random

from conftest import SMALL, rows
from pyspark.sql import functions as F

from strikelens import runtime
from strikelens.operators import codes
from strikelens.plans import batch
from strikelens.plans.tables import details_of

COLUMNS = "airport_id string, airport_name string, species_id string, species_name string"


def airports(spark, *pairs):
    return spark.createDataFrame([(i, n, "S1", "GULL") for i, n in pairs], COLUMNS)


def species(spark, *pairs):
    return spark.createDataFrame([("KATL", "ATLANTA", i, n) for i, n in pairs], COLUMNS)


def repaired(frame, *roles):
    repairs = codes.code_repairs(codes.code_pairs(frame), *roles)
    return codes.apply_repairs(frame, repairs, codes.needed_lookups(repairs), *roles)


def test_repairs_grow_with_ambiguous_names_not_with_pairs(spark):
    frame = airports(spark, *[(f"K{i:03d}", "X") for i in range(200)], ("KA", "Y"))
    repairs = codes.code_repairs(codes.code_pairs(frame))
    assert rows(repairs) == [("airports", "name", "X", "K000")]


def airport_pairs(frame):
    return rows(frame.select("airport_id", "airport_name"))


def test_longest_id_wins(spark):
    frame = airports(spark, ("FSM", "FORT SMITH"), ("KFSM", "FORT SMITH"))
    assert airport_pairs(repaired(frame)) == [("KFSM", "FORT SMITH")] * 2


def test_smallest_of_longest_ids_wins(spark):
    frame = airports(spark, ("KB", "X"), ("KA", "X"), ("K", "X"))
    assert airport_pairs(repaired(frame)) == [("KA", "X")] * 3


def test_swapped_code(spark):
    frame = airports(spark, ("KATL", "ATLANTA"), ("ATLANTA", "HARTSFIELD"), ("KHFD", "HARTSFIELD"))
    assert airport_pairs(repaired(frame)) == [("KATL", "ATLANTA"), ("KATL", "ATLANTA"), ("KHFD", "HARTSFIELD")]


def test_swapped_code_takes_the_canonical_id(spark):
    frame = airports(spark, ("KATL", "ATLANTA"), ("ATL", "ATLANTA"), ("ATLANTA", "HARTSFIELD"), ("KHFD", "HARTSFIELD"))
    assert airport_pairs(repaired(frame)) == [("KATL", "ATLANTA")] * 3 + [("KHFD", "HARTSFIELD")]


def test_an_id_that_is_a_name_stays_where_its_name_is_unambiguous(spark):
    frame = airports(spark, ("KATL", "ATLANTA"), ("ATLANTA", "HARTSFIELD"))
    assert airport_pairs(repaired(frame)) == [("ATLANTA", "HARTSFIELD"), ("KATL", "ATLANTA")]


def test_kinds_do_not_mix(spark):
    frame = spark.createDataFrame([("A", "X", "AA", "X"), ("B", "Y", "B", "Y")], COLUMNS)
    assert rows(repaired(frame)) == [("A", "X", "AA", "X"), ("B", "Y", "B", "Y")]


def test_repairs_names_by_id_when_mirrored(spark):
    frame = airports(spark, ("KFSM", "FORT SMITH"), ("KFSM", "FORT SMITH RGNL"))
    assert airport_pairs(repaired(frame, "name", "id")) == [("KFSM", "FORT SMITH RGNL")] * 2


def test_misplaced_id_when_mirrored(spark):
    # KATL stands in the name column of an id with two names
    frame = airports(spark, ("KATL", "ATLANTA"), ("KHFD", "KATL"), ("KHFD", "HARTSFIELD"))
    fixed = airport_pairs(repaired(frame, "name", "id"))
    assert fixed == [("KATL", "ATLANTA"), ("KATL", "ATLANTA"), ("KHFD", "HARTSFIELD")]


def test_null_codes_stay(spark):
    frame = airports(spark, (None, "X"), ("KA", "X"), ("A", "X"), ("K", None))
    assert airport_pairs(repaired(frame)) == [("K", None), ("KA", "X"), ("KA", "X"), (None, "X")]


def test_repair_is_idempotent_and_keeps_every_row(spark):
    view = details_of(spark, SMALL)
    once = batch.repaired_summary(view, batch.prepare(view))
    again = repaired(once)
    assert once.count() == view.count()
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
    assert codes.ambiguous_codes(codes.code_pairs(once)).filter("direction = 'name_to_ids'").isEmpty()


def brute_force(pairs):
    """The repair of each (id, name), straight from its description."""
    ids_of = {}
    for i, n in pairs:
        ids_of.setdefault(n, set()).add(i)
    # a proper id is no name
    proper = {n: [i for i in ids if i not in ids_of] for n, ids in ids_of.items()}
    canonical = {n: min(ids, key=lambda i: (-len(i), i)) for n, ids in proper.items() if ids}
    ambiguous = {n for n, ids in ids_of.items() if len(ids) > 1}
    misplaced = {i for n in ambiguous for i in ids_of[n] if i in ids_of}
    result = []
    for i, n in pairs:
        if i in misplaced and i in canonical:
            result.append((canonical[i], i))
        elif n in ambiguous and n in canonical and not ids_of[n] & misplaced:
            result.append((canonical[n], n))
        else:
            result.append((i, n))
    return sorted(result)


def test_moved_names_get_ids_that_are_no_names(spark):
    pairs = [("KATL", "ATLANTA"), ("ATLANTA", "HARTS"), ("KHFD", "HARTS"), ("HARTS", "ATLANTA")]
    once = repaired(airports(spark, *pairs))
    assert airport_pairs(once) == [("KATL", "ATLANTA"), ("KATL", "ATLANTA"), ("KHFD", "HARTS"), ("KHFD", "HARTS")]
    assert airport_pairs(repaired(once)) == airport_pairs(once)


def test_repair_against_brute_force(spark):
    texts = [f"T{i}" for i in range(30)] + [f"TT{i}" for i in range(10)]
    draw = random.Random(7)
    for _ in range(3):
        pairs = [(draw.choice(texts), draw.choice(texts)) for _ in range(45)]
        assert airport_pairs(repaired(airports(spark, *pairs))) == brute_force(pairs)


NO_BROADCAST_SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    "spark.sql.shuffle.partitions": "8",
}


def test_hot_name_with_repairs_too_large_to_broadcast(spark):
    # a third of all rows has one ambiguous name: its partition must be split over several tasks
    made = spark.range(0, 300_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 > 0 THEN concat('K', id % 5000) WHEN id = 0 THEN 'KFSM' ELSE 'FSM' END AS airport_id",
        "CASE WHEN id % 3 > 0 THEN concat('N', id % 2500) ELSE 'FORT SMITH' END AS airport_name",
        "'S1' AS species_id",
        "concat('GULL', id % 7) AS species_name",
        "sha2(string(id), 512) AS rest",
    )
    before = {name: spark.conf.get(name, None) for name in NO_BROADCAST_SMALL_SKEW}
    for name, value in NO_BROADCAST_SMALL_SKEW.items():
        spark.conf.set(name, value)
    try:
        counted = repaired(made).groupBy("airport_id").agg(F.count("rest").alias("n"), F.max("rest"))
        by_id = {r.airport_id: r.n for r in counted.collect()}
        assert by_id["KFSM"] == 100_000 and "FSM" not in by_id and sum(by_id.values()) == 300_000
        assert "SortMergeJoin(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_no_lookup_without_need(spark):
    frame = airports(spark, ("KATL", "ATLANTA"), ("KHFD", "HARTSFIELD"))
    plan = repaired(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_ambiguous_codes_in_both_directions(spark):
    pairs = codes.code_pairs(airports(spark, ("A", "x"), ("A", "y"), ("B", "y")))
    assert rows(codes.ambiguous_codes(pairs)) == [
        ("airports", "id_to_names", "A", "x"),
        ("airports", "id_to_names", "A", "y"),
        ("airports", "name_to_ids", "y", "A"),
        ("airports", "name_to_ids", "y", "B"),
    ]


def test_mapping_directions(spark):
    pairs = codes.code_pairs(airports(spark, ("A", "x"), ("B", "x"), ("C", "y")))
    assert rows(codes.mapping_directions(pairs)) == [("airports", 3, 2, "name_to_ids"), ("species", 1, 1, None)]


def test_id_name_map_is_empty_when_an_id_has_two_names(spark):
    pairs = codes.code_pairs(airports(spark, ("A", "x"), ("A", "y"), ("B", "y")))
    assert codes.id_name_map(pairs, codes.AIRPORTS).isEmpty()
    assert rows(codes.id_name_map(pairs, codes.SPECIES)) == [("S1", "GULL")]


def test_orientation(spark):
    found = codes.mapping_orientation(codes.code_pairs(airports(spark, ("FSM", "FORT SMITH"), ("KFSM", "FORT SMITH"))))
    assert rows(found) == [("airports", "name_to_ids", "FORT SMITH", False)]


def test_unknown_names_once_per_id(spark):
    pairs = codes.code_pairs(species(spark, ("UNKB", "UNKNOWN BIRD"), ("X1", "UNKNOWN BIRD"), ("G", "GULL")))
    assert rows(codes.unknown_codes(pairs)) == [("id", "UNKB"), ("name", "UNKNOWN BIRD"), ("name", "UNKNOWN BIRD")]


def test_preparation_takes_few_jobs(spark, monkeypatch):
    view = details_of(spark, SMALL)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext

    def prepared(group):
        context.setJobGroup(group, group)
        found = batch.prepare(view)
        context.setLocalProperty("spark.jobGroup.id", None)
        return found, len(tracker.getJobIdsForGroup(group))

    small, jobs = prepared("small")
    # one for each exchange of the scan of the raw records, one for the repairs, one for the rules, one for the lookups
    assert jobs <= 9
    monkeypatch.setattr(runtime, "ONE_TASK_BYTES", 0)
    spread, more = prepared("spread")
    assert more > jobs and rows(spread.repairs) == rows(small.repairs) and (spread.lookups, spread.rules) == (small.lookups, small.rules)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_salted_lookups_spread_a_hot_code(spark):
    pairs = airports(spark, ("K1", "ONE"), ("K11", "ONE"), ("K2", "TWO"))
    repairs = codes.code_repairs(codes.code_pairs(pairs))
    hot = spark.range(4000).selectExpr(
        "id", "'K1' AS airport_id", "CASE WHEN id < 3800 THEN 'ONE' ELSE 'TWO' END AS airport_name", "'S1' AS species_id", "'GULL' AS species_name"
    )
    needed, key = codes.needed_lookups(repairs), "spark.sql.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k) for k in (key, "spark.sql.adaptive.enabled")}
    spark.conf.set(key, "-1")
    # as in a stream with state
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        largest = {}
        for salts in (1, 16):
            repaired = codes.apply_repairs(hot, repairs, needed, salts=salts)
            assert repaired.filter("airport_id = 'K11'").count() == 3800 and repaired.columns == hot.columns
            by_task = repaired.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            largest[salts] = by_task
        assert largest[1] >= 3800 and largest[16] < 2500
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)
