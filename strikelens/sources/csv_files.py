"""CSV files: the typed raw scan, the untyped scan, and the ranked output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DETAIL_COLUMNS, DETAILS, RANKED
from .files import Versions

# A quote inside a quoted field is written twice.
_QUOTING = {"quote": '"', "escape": '"'}
# Raw records say the same again and again; the fastest level of gzip takes little more room for them.
GZIP_FAST = {"zlib.compress.level": "BEST_SPEED"}
_NUMBERS = ("int", "bigint", "float")


def read_details(
    spark: SparkSession,
    path: str,
    multiline: bool = True,
    partitions: int | None = None,
    fail_on_malformed: bool = False,
) -> DataFrame:
    """Typed scan of raw records; columns are found by header, in any order, and absent ones are null.

    Empty texts stay empty, empty numbers and flags are null, species ids are
    put in upper case. Line breaks inside quotes are part of a text, in a file,
    a folder and a pattern alike. ``multiline=False`` lets plain files be split
    and is right only for files without such breaks. ``partitions`` spreads
    the rows of few large files over the cluster.
    """
    reader = spark.read.options(header=True, multiLine=multiline, enforceSchema=False, **_QUOTING)
    headers = reader.csv(path).columns
    header_of = {header.strip().lower(): header for header in headers}
    source = {name: header_of.get(header.lower()) for header, name, _ in DETAIL_COLUMNS}

    # numbers are read by the CSV source itself; flags are spelled in more ways than it accepts
    numbers = {source[name]: DETAILS[name].dataType for _, name, dtype in DETAIL_COLUMNS if dtype in _NUMBERS}
    schema = T.StructType([T.StructField(header, numbers.get(header, T.StringType())) for header in headers])
    mode = "FAILFAST" if fail_on_malformed else "PERMISSIVE"
    raw = reader.schema(schema).option("mode", mode).csv(path)

    columns = []
    for _, name, dtype in DETAIL_COLUMNS:
        column = F.col(f"`{source[name]}`") if source[name] else F.lit(None).cast(dtype)
        if dtype == "string":
            column = F.coalesce(column, F.lit(""))
        elif dtype == "boolean":
            column = column.cast(dtype) if fail_on_malformed else column.try_cast(dtype)
        columns.append(column.alias(name))
    details = raw.select(columns).withColumn("species_id", F.upper("species_id"))
    return details.repartition(partitions) if partitions else details


def write_details(details: DataFrame, path: str, compression: str = "gzip") -> None:
    """Raw records under their original headers."""
    named = details.select([F.col(name).alias(header) for header, name, _ in DETAIL_COLUMNS])
    named.write.options(header=True, compression=compression, **GZIP_FAST, **_QUOTING).csv(path)


def read_untyped(spark: SparkSession, path: str) -> DataFrame:
    """Every record of every file as an array of texts in ``fields``, header lines included.

    Records have as many fields as they have: the scan knows two columns, and
    a record of any other width comes as the whole text, which is cut here.
    """
    schema = "first string, second string, whole string"
    reader = spark.read.options(header=False, multiLine=True, columnPruning=False, columnNameOfCorruptRecord="whole", **_QUOTING)
    raw = reader.schema(schema).csv(path)
    # a comma before each field, so that empty ones are found too
    text = F.concat(F.lit(","), F.regexp_replace("whole", r"\r?\n$", ""))
    # nothing is given back once matched, so that a long field takes no stack
    found = F.regexp_extract_all(text, F.lit(',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'), 1)
    plain = lambda x: F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    cut = F.transform(found, lambda x: F.when(x.startswith('"'), plain(x)).otherwise(x))
    pair = F.array(*[F.coalesce(c, F.lit("")) for c in ("first", "second")])
    return raw.select(F.when(F.col("whole").isNull(), pair).otherwise(cut).alias("fields"))


def publish_ranked(ranked: DataFrame, path: str) -> None:
    """Ranked rows as a new version of an output, which takes the place of the former one in a single step."""
    Versions(ranked.sparkSession, path, former=1).publish(lambda folder: write_ranked(ranked, folder))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of an output, whatever is written meanwhile."""
    return read_ranked(spark, Versions(spark, path).current())


def write_ranked(ranked: DataFrame, path: str) -> None:
    """Ranked rows without header, every field quoted; a rewrite replaces the former output."""
    rows = ranked.select(RANKED.fieldNames())
    rows.write.mode("overwrite").options(header=False, quoteAll=True, **_QUOTING).csv(path)


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RANKED).options(header=False, **_QUOTING).csv(path)

