"""Incident records derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCAN_PARTITIONS = "strikelens.scan.partitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream: every file of it is a piece of one unbounded input."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # a pattern, because a stream does not take the path of a single file
    return reader.parquet(f"{folder}/{name}.parque[t]")


def incident_details(lineitem: DataFrame, part: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw incident records, one per line item; ``lineitem`` may be a stream.

    Which dimension is broadcast is left to its size.
    """
    joined = (
        lineitem.join(part, F.expr("p_partkey = l_partkey"))
        .join(supplier, F.expr("s_suppkey = l_suppkey"))
        .join(nation, F.expr("n_nationkey = s_nationkey"))
    )
    return joined.selectExpr(
        "l_orderkey * 10 + l_linenumber AS record_id",
        "year(l_shipdate) AS year",
        "month(l_shipdate) AS month",
        "day(l_shipdate) AS day",
        "CASE WHEN p_size <= 2 THEN 'UNKNOWN' ELSE p_type END AS aircraft",
        "CAST(CASE WHEN l_discount >= 0.01D THEN p_size END AS float) AS aircraft_mass",
        "CASE WHEN l_linenumber < 7 THEN l_linenumber END AS engines",
        "CASE WHEN s_suppkey % 20 = 0 THEN string(s_suppkey) ELSE concat('K', s_suppkey) END AS airport_id",
        "n_name AS airport_name",
        "p_brand AS state",
        "concat('R', n_regionkey) AS faa_region",
        "CASE WHEN l_linestatus <> 'O' THEN l_tax > 0.04D END AS warning_issued",
        "CASE WHEN l_linestatus = 'O' THEN '' ELSE 'CLIMB' END AS flight_phase",
        "CASE p_name WHEN 'red plate' THEN '100000000000' WHEN 'small widget' THEN 'UNKBS' "
        "ELSE concat('S', p_partkey) END AS species_id",
        "CASE p_name WHEN 'red plate' THEN 'UNKNOWN' WHEN 'small widget' THEN 'UNKNOWN BIRD - SMALL' "
        "ELSE p_name END AS species_name",
        "CASE WHEN l_quantity >= 49 THEN '' WHEN l_quantity >= 45 THEN 'Over 100' WHEN l_quantity >= 11 THEN '11-100' "
        "WHEN l_quantity >= 2 THEN '2-10' ELSE '1' END AS species_quantity",
        "CASE WHEN l_discount < 0.04D THEN 0 END AS fatalities",
        "CASE WHEN l_tax >= 0.05D THEN 1 END AS injuries",
        "l_returnflag = 'R' AS aircraft_damage",
    )


def details_of(spark: SparkSession, folder: str, lineitem: DataFrame | None = None) -> DataFrame:
    """The incident view; the session's ``strikelens.scan.partitions``, if set, deals the scanned rows out to so many tasks.

    That is for few large files that cannot be split; it costs a shuffle of the columns in use.
    """
    if lineitem is None:
        lineitem = table(spark, folder, "lineitem")
        partitions = spark.conf.get(SCAN_PARTITIONS, None)
        if partitions:
            lineitem = lineitem.repartition(int(partitions))
    dimensions = [table(spark, folder, name) for name in ("part", "supplier", "nation")]
    return incident_details(lineitem, *dimensions)


def events_of(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Events with a timestamp proper, as event time must be; the times of the table are UTC."""
    if events is None:
        events = table(spark, folder, "events")
    local = F.col("ts").cast("timestamp")
    return events.withColumn("ts", F.from_utc_timestamp(local, F.current_timezone()))
