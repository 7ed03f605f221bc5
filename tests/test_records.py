import pytest
from conftest import rows
from pyspark.sql import functions as F
from records import UNKNOWN, VALID, details

from strikelens.functions.quantity import mean_quantity, parse_quantity
from strikelens.operators import codes
from strikelens.operators.narrow import to_summary, upper_ids, with_mean_quantity
from strikelens.schemas import SUMMARY


@pytest.mark.parametrize(
    "text, bounds",
    [
        ("", (None, None)),
        (None, (None, None)),
        ("1", (1, 1)),
        ("2-10", (2, 10)),
        ("11-100", (11, 100)),
        ("Over 100", (100, 10000)),
        ("many", (None, None)),
        (" 5", (None, None)),
        ("1.5", (None, None)),
        ("2-", (None, None)),
        ("-3", (None, None)),
        ("Over ", (None, None)),
        ("2-99999999999", (None, None)),
        ("Over 99999999999", (None, None)),
    ],
)
def test_parse_quantity(spark, text, bounds):
    frame = spark.createDataFrame([(text,)], "q string")
    assert tuple(frame.select(*parse_quantity(F.col("q"))).first()) == bounds


def test_mean_quantity(spark):
    frame = spark.createDataFrame(
        [(1, 1), (2, 10), (11, 100), (100, 10000), (3, 4), (2147483647, 2147483647), (None, 4)], "low int, high int"
    )
    means = frame.select(mean_quantity(F.col("low"), F.col("high")).alias("m"))
    assert means.schema["m"].dataType.simpleString() == "bigint"
    assert [r.m for r in means.collect()] == [1, 6, 55, 5050, 3, 2147483647, None]


def test_to_summary(spark):
    summary = to_summary(details(spark, VALID, UNKNOWN))
    assert summary.schema.simpleString() == SUMMARY.simpleString()
    assert rows(summary.select("species_quantity_min", "species_quantity_max")) == [(1, 1), (None, None)]
    assert [r.mean_quantity for r in with_mean_quantity(summary).collect()] == [1, None]


def test_upper_ids(spark):
    frame = spark.createDataFrame([("yh004",), (None,)], "species_id string")
    assert [r[0] for r in upper_ids(frame).collect()] == ["YH004", None]


def test_unknown_species_of_one_row(spark):
    found = codes.unknown_codes(codes.code_pairs(to_summary(details(spark, UNKNOWN))))
    assert rows(found) == [("name", "UNKNOWN")]
