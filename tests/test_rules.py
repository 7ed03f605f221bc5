import json

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F
from records import UNKNOWN, VALID, details, summary_like

from strikelens.functions import rules
from strikelens.operators import route, validate
from strikelens.operators.narrow import to_summary
from strikelens.plans import batch
from strikelens.plans.tables import details_of


def verdicts(spark, rule, dtype, values):
    frame = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in frame.select(rule(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "rule, dtype, values, expected",
    [
        (rules.not_null(), "int", [1, None], [True, False]),
        (rules.not_empty(), "string", ["a", "", " ", None], [True, False, True, False]),
        (rules.in_range(1990, 2015), "int", [1989, 1990, 2015, 2016], [False, True, True, False]),
        (rules.lacks("UNKN"), "string", ["KFSM", "UNKN", "XUNKNX", "unkn", None], [True, False, False, True, False]),
        (
            rules.not_matching(r"-?\d+(\.\d+)?"),
            "string",
            ["123", "-1.5", "KFSM", "K12", "12K", "12\n", "", None],
            [False, False, True, True, True, True, True, False],
        ),
        (rules.not_matching("a|b"), "string", ["a", "b", "ab", "xb"], [False, False, True, True]),
    ],
)
def test_rule(spark, rule, dtype, values, expected):
    assert verdicts(spark, rule, dtype, values) == expected


def test_null_counts_once_for_not_null_and_range(spark):
    profiled = validate.profile(details(spark, {**VALID, "year": None}))
    assert profiled.first()["year"] == 1


def test_failing_rules_are_counted_not_rows(spark):
    both = {**VALID, "species_id": "UNK100000000000"}
    assert validate.profile(details(spark, both)).first()["species_id"] == 2


def test_empty_input_keeps_no_rule(spark):
    nothing = details(spark, VALID).limit(0)
    profiled = validate.profile(nothing)
    assert set(profiled.first()) == {0}
    assert validate.select_rules(profiled) == {}
    prepared = batch.prepare(nothing)
    assert prepared.rules == {} and prepared.pairs.isEmpty() and prepared.repairs.isEmpty()
    assert batch.top_n_per_year(nothing).isEmpty()


@pytest.mark.parametrize("record", [VALID, UNKNOWN])
def test_one_row_keeps_no_rule(spark, record):
    # one failure of one row is not fewer than the threshold allows
    assert validate.select_rules(validate.profile(details(spark, record))) == {}


def test_thresholds(spark):
    profiled = validate.profile(details_of(spark, "/root/testdata/sf0.01"))
    strict = {
        "aircraft", "aircraft_mass", "engines", "airport_id", "species_id", "species_name", "species_quantity_min",
        "species_quantity_max",
    }
    assert set(validate.select_rules(profiled)) == strict
    assert set(validate.select_rules(profiled, 0.05)) == strict - {"engines", "airport_id"}
    assert validate.select_rules(profiled, 0.03) == {}
    assert "year" in validate.select_rules(profiled, keep_zero_failure=True)


def test_counts_of_the_incident_view(spark):
    profile = validate.profile(details_of(spark, "/root/testdata/sf0.01")).first().asDict()
    expected = {
        "total": 60000, "year": 0, "aircraft": 2823, "aircraft_mass": 2941, "engines": 8598, "airport_id": 3052,
        "warning_issued": 30064, "species_id": 2637, "species_name": 2637, "species_quantity": 2374,
    }
    assert {k: profile[k] for k in expected} == expected


def test_topics_without_repairs(spark):
    view = details_of(spark, "/root/testdata/sf0.01")
    kept = validate.select_rules(validate.profile(view))
    validated = route.with_topics(to_summary(view), kept)
    counts = {r.t: r["count"] for r in validated.groupBy(F.array_join("topics", ",").alias("t")).count().collect()}
    assert counts == {
        "": 40545, "other": 14545, "quantity": 1648, "quantity,other": 625, "species": 1913, "species,other": 623,
        "species,quantity": 73, "species,quantity,other": 28,
    }
    assert route.clean(validated).count() == 13565


RULES = {
    name: {**rules.FIELD_RULES, **rules.PARSED_QUANTITY_RULES}[name]
    for name in ["aircraft_mass", "species_name", "species_quantity_min", "species_quantity_max"]
}


def test_valid_and_triple_failure(spark):
    rows_ = summary_like(
        spark,
        {},
        {"aircraft_mass": None, "species_name": "UNKNOWN", "species_quantity_min": None, "species_quantity_max": None},
    )
    topics = [r.topics for r in route.with_topics(rows_, RULES).collect()]
    assert topics == [[], ["species", "quantity", "other"]]


def test_no_rules_no_topics(spark):
    assert route.with_topics(summary_like(spark, {}), {}).first().topics == []


def test_rule_of_the_user(spark):
    own = {"height": [lambda c: c < 1000]}
    frame = details(spark, VALID, {**VALID, "height": 10.0}, {**VALID, "height": None})
    assert validate.profile(frame, own).first()["height"] == 2
    assert validate.failing_rows(frame, "height", own).count() == 2
    topics = [r.topics for r in route.with_topics(frame, own).collect()]
    assert topics == [["other"], [], ["other"]]
    assert set(validate.select_rules(validate.profile(frame, own), 0.7, own)) == {"height"}


def test_topic_class():
    assert [validate.topic_class(f) for f in ("species_quantity_min", "speciesQuantity", "species_id", "airport_id")] == [
        "quantity", "quantity", "species", "other",
    ]


def test_clean_needs_damage(spark):
    frame = summary_like(spark, {"aircraft_damage": True}, {"aircraft_damage": False}, {"aircraft_damage": None})
    assert route.clean(route.with_topics(frame, RULES)).count() == 1


def test_fan_out_and_clean_are_disjoint(spark):
    view = details_of(spark, SMALL)
    validated = batch.validated(view, batch.prepare(view))
    invalid = validated.filter(F.size("topics") > 0)
    assert route.fan_out(validated).count() == invalid.agg(F.sum(F.size("topics"))).first()[0]
    assert route.clean(validated).count() + validated.filter("size(topics) = 0 AND NOT aircraft_damage").count() == (
        validated.count() - invalid.count()
    )


def test_single_scan_equals_separate_scans(spark):
    from strikelens.operators import codes

    view = details_of(spark, SMALL)
    prepared = batch.prepare(view)
    assert rows(prepared.profile) == rows(validate.profile(view))
    assert rows(prepared.pairs) == rows(codes.code_pairs(view))


def test_profile_counts_rows_with_null_codes(spark):
    frame = details(spark, VALID, {**VALID, "species_id": None, "airport_name": None, "engines": 2})
    prepared = batch.prepare(frame)
    assert rows(prepared.profile) == rows(validate.profile(frame))
    assert prepared.profile.first()["total"] == 2
    assert prepared.pairs.count() == 2


def test_failing_rows_are_distinct(spark):
    frame = details(spark, UNKNOWN, UNKNOWN, VALID)
    assert validate.failing_rows(frame, "species_name").count() == 1


def test_rules_as_data():
    known = {**rules.FIELD_RULES, **rules.PARSED_QUANTITY_RULES}
    stored = json.loads(json.dumps(rules.to_specification(known)))
    assert rules.from_specification(stored) == known
    with pytest.raises(TypeError, match="speed"):
        rules.to_specification({"speed": [lambda c: c < 900]})


def test_a_range_alone_fails_null(spark):
    frame = spark.createDataFrame([(5,), (50,), (None,)], "v int")
    alone, reported = {"v": [rules.in_range(1, 9)]}, {"v": [rules.not_null(), rules.in_range(1, 9)]}
    for of_field, failures in ((alone, [0, 1, 1]), (reported, [0, 1, 1])):
        assert [r[0] for r in frame.select(rules.all_valid("v", of_field["v"])).collect()] == [True, False, False]
        assert [r[0] for r in frame.select(validate.failures("v", of_field)).collect()] == failures


def test_failing_rows_of_all_fields(spark):
    frame = spark.createDataFrame([(1, ""), (1, ""), (None, "a"), (None, ""), (2, "b")], "n int, t string")
    known = {"n": [rules.not_null()], "t": [rules.not_empty()]}
    assert rows(validate.failing_by_field(frame, known)) == [(1, "", "t"), (None, "", "n"), (None, "", "t"), (None, "a", "n")]
    assert rows(validate.failing_by_field(frame, {})) == []
