import glob
import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F
from records import UNKNOWN, VALID, details, summary_like

from strikelens.functions.codec import wire_name
from strikelens.operators import rank
from strikelens.schemas import DETAIL_COLUMNS, DETAILS, RANKED, SUMMARY
from strikelens.sources import csv_files, topics


def test_detail_columns():
    assert len(DETAIL_COLUMNS) == 66 and len(SUMMARY) == 20
    assert sum(dtype == "boolean" for _, _, dtype in DETAIL_COLUMNS) == 31


def write(path, text):
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "wt") as file:
        file.write(text)
    return path


def test_columns_are_found_by_header(spark, tmp_path):
    text = (
        "Species Quantity,species id,Extra,Incident Year,Aircraft Mass,Warning Issued,Airport\n"
        'Over 100,yh004,x,1990,4,Y,"FORT ""SMITH"", ARPT"\n'
        ",,,,,,\n"
        ",,,not a year,x,maybe,\n"
    )
    read = csv_files.read_details(spark, write(str(tmp_path / "raw.csv"), text))
    assert read.schema.simpleString() == DETAILS.simpleString()
    picked = read.select("year", "aircraft_mass", "warning_issued", "airport_name", "species_id", "species_quantity", "state")
    empty = (None, None, None, "", "", "", "")
    assert [tuple(r) for r in picked.collect()] == [
        (1990, 4.0, True, 'FORT "SMITH", ARPT', "YH004", "Over 100", ""),
        empty,
        empty,
    ]


@pytest.mark.parametrize("text, flag", [("TRUE", True), ("t", True), ("yes", True), ("1", True), ("N", False), ("0", False), ("?", None)])
def test_flags(spark, tmp_path, text, flag):
    path = write(str(tmp_path / "raw.csv"), f"Record ID,Aircraft Damage\n1,{text}\n")
    assert csv_files.read_details(spark, path).first().aircraft_damage is flag


def test_malformed_numbers_can_fail(spark, tmp_path):
    path = write(str(tmp_path / "raw.csv"), "Incident Year\nabc\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.read_details(spark, path, fail_on_malformed=True).select("year").collect()


def test_gzip_with_line_breaks_in_quotes(spark, tmp_path):
    path = write(str(tmp_path / "raw.csv.gz"), 'Record ID,Operator\n1,"two\nlines"\n2,one\n')
    read = csv_files.read_details(spark, path, partitions=3)
    assert rows(read.select("record_id", "operator")) == [(1, "two\nlines"), (2, "one")]
    assert read.rdd.getNumPartitions() == 3


def test_only_needed_columns_are_scanned(spark, folder):
    path = folder()
    csv_files.write_details(details(spark, VALID), path)
    plan = csv_files.read_details(spark, path).select("year")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Incident Year:int>" in plan


def test_details_through_gzip(spark, folder):
    path = folder()
    frame = details(spark, VALID, UNKNOWN)
    csv_files.write_details(frame, path)
    assert glob.glob(f"{path}/*.csv.gz")
    texts = [f.name for f in DETAILS if f.dataType.simpleString() == "string"]
    assert rows(csv_files.read_details(spark, path)) == rows(frame.fillna("", texts))


def test_untyped_scan_returns_the_header_as_data(spark, tmp_path):
    path = write(str(tmp_path / "raw.csv.gz"), 'a,b\n1,\n"x, y",2\n')
    assert [r.fields for r in csv_files.read_untyped(spark, path).collect()] == [["a", "b"], ["1", ""], ["x, y", "2"]]


def test_untyped_records_keep_their_own_width(spark, tmp_path):
    text = 'a,b\n1,2,3,4\n5\n"x\ny","say ""hi""",,\n,\n'
    expected = [["a", "b"], ["1", "2", "3", "4"], ["5"], ["x\ny", 'say "hi"', "", ""], ["", ""]]
    path = write(str(tmp_path / "raw.csv"), text)
    assert [r.fields for r in csv_files.read_untyped(spark, path).collect()] == expected


@pytest.mark.parametrize("length", [2_000, 100_000, 1_000_000])
def test_untyped_records_with_long_fields(spark, tmp_path, length):
    long, quotes = "ab\n," * (length // 4), '"' * (length // 2)
    doubled = quotes.replace('"', '""')
    path = write(str(tmp_path / "raw.csv"), f'1,"{long}",{"x" * length}\n"{doubled}",2,3,4\n')
    assert [r.fields for r in csv_files.read_untyped(spark, path).collect()] == [["1", long, "x" * length], [quotes, "2", "3", "4"]]


def test_details_are_the_same_from_file_folder_and_pattern(spark, folder):
    path = folder()
    frame = details(spark, VALID, UNKNOWN).withColumn("operator", F.lit('one\ntwo, "three"'))
    csv_files.write_details(frame.coalesce(1), path)
    (file,) = glob.glob(f"{path}/*.csv.gz")
    expected = rows(csv_files.read_details(spark, file))
    assert len(expected) == 2 and all('one\ntwo, "three"' in r for r in expected)
    assert rows(csv_files.read_details(spark, path)) == expected == rows(csv_files.read_details(spark, f"{path}/*.csv.g[z]"))


def ranked(spark, *values):
    return spark.createDataFrame(values, RANKED)


def test_ranked_output_format(spark, folder):
    path = folder()
    csv_files.write_ranked(ranked(spark, (0, 1990, "NE1", 'A "GULL"', 49)).coalesce(1), path)
    csv_files.write_ranked(ranked(spark, (0, 1991, "NE1", 'A "GULL"', 50)).coalesce(1), path)
    lines = [line for name in glob.glob(f"{path}/*.csv") for line in open(name).read().splitlines()]
    assert lines == ['"0","1991","NE1","A ""GULL""","50"']
    assert rows(csv_files.read_ranked(spark, path)) == [(0, 1991, "NE1", 'A "GULL"', 50)]


def test_envelopes_keep_nulls(spark):
    frame = summary_like(spark, {"aircraft_mass": None, "species_quantity_min": None}, {"aircraft_damage": None})
    envelopes = topics.to_envelopes(frame)
    text = envelopes.first().value
    assert '"aircraftMass":null' in text and '"speciesQuantityMax":10' in text
    assert '"speciesId":"K5105"' in envelopes.first().key
    assert rows(topics.summaries(envelopes)) == rows(frame)
    keys = topics.from_envelopes(envelopes).select("key.*")
    assert keys.columns == ["year", "month", "species_id", "species_name", "aircraft_damage"]


def test_headers_are_unique(spark):
    envelopes = topics.to_envelopes(summary_like(spark, *[{}] * 50))
    header = envelopes.select(F.col("headers")[0].alias("h")).select("h.*")
    assert header.select("key").distinct().first().key == "Key"
    assert header.select("value").distinct().count() == 50


def test_bare_counts(spark):
    counted = summary_like(spark, {}).withColumn("n", F.lit(7))
    assert topics.grouped_counts(topics.to_envelopes(counted, value="n")).first().amount == 7
    by_year = topics.to_envelopes(counted, topics.GROUPED, "n")
    assert tuple(topics.yearly_counts(by_year).first()) == (2015, "K5105", "MERLIN", 7)


def test_ranked_topic(spark):
    frame = ranked(spark, (0, 1990, "a", "A", 9), (1, 1990, "b", "B", 8), (0, 1991, "a", "A", 1))
    envelopes = topics.ranked_to_envelopes(rank.nested_by_year(frame))
    assert rows(rank.exploded_by_year(topics.ranked_from_envelopes(envelopes))) == rows(frame)


def test_bytes_as_delivered_by_a_broker(spark):
    frame = summary_like(spark, {})
    raw = topics.to_envelopes(frame).withColumns({c: F.col(c).cast("binary") for c in ("key", "value")})
    assert rows(topics.summaries(raw)) == rows(frame)


def test_wire_names():
    assert [wire_name(n) for n in ("year", "species_id", "species_quantity_min")] == ["year", "speciesId", "speciesQuantityMin"]
