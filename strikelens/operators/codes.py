"""Code dimensions (id and name of airports and species) and the repair of ambiguous codes.

All work happens on the distinct (kind, id, name) pairs, which are far fewer
than the rows; the rows are touched once by the scan that finds the pairs and
once by the join that applies the repair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AIRPORTS, SPECIES = "airports", "species"

# kind -> (id column, name column) of a summary row
CODE_COLUMNS: dict[str, tuple[str, str]] = {
    AIRPORTS: ("airport_id", "airport_name"),
    SPECIES: ("species_id", "species_name"),
}

PAIR = ["kind", "id", "name"]


def code_counts(rows: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """Distinct (kind, id, name) with the sums of ``sums`` over its rows.

    All kinds come from one scan and one shuffle of map-side combined rows.
    Every row counts once per kind, under null codes, too.
    """
    columns = [c for pair in CODE_COLUMNS.values() for c in pair]
    grouped = rows.groupingSets([list(pair) for pair in CODE_COLUMNS.values()], *columns).agg(
        *[F.grouping(id_column).alias(f"_without_{kind}") for kind, (id_column, _) in CODE_COLUMNS.items()],
        *[F.sum(name).alias(name) for name in sums],
    )
    of_kind = [(F.col(f"_without_{kind}") == 0, kind, pair) for kind, pair in CODE_COLUMNS.items()]
    return grouped.select(
        F.coalesce(*[F.when(test, kind) for test, kind, _ in of_kind]).alias("kind"),
        F.coalesce(*[F.when(test, F.col(id_column)) for test, _, (id_column, _) in of_kind]).alias("id"),
        F.coalesce(*[F.when(test, F.col(name_column)) for test, _, (_, name_column) in of_kind]).alias("name"),
        *sums,
    )


def known_pairs(counts: DataFrame) -> DataFrame:
    return counts.select(PAIR).filter("id IS NOT NULL AND name IS NOT NULL")


def code_pairs(rows: DataFrame) -> DataFrame:
    """Distinct (kind, id, name)."""
    return known_pairs(code_counts(rows))


def id_name_map(pairs: DataFrame, kind: str) -> DataFrame:
    """id -> name of one kind, or no row at all when any id has two names."""
    by_id = pairs.filter(F.col("kind") == kind).groupBy("id").agg(
        F.min("name").alias("name"), F.count(F.lit(1)).alias("names")
    )
    most_names = by_id.agg(F.max("names")).scalar()
    return by_id.filter(most_names <= 1).select("id", "name")


def ambiguous_codes(pairs: DataFrame) -> DataFrame:
    """Codes with several partners, one row per partner: (kind, direction, code, member)."""
    sides = F.array(
        F.struct(F.lit("name_to_ids").alias("direction"), F.col("name").alias("code"), F.col("id").alias("member")),
        F.struct(F.lit("id_to_names").alias("direction"), F.col("id").alias("code"), F.col("name").alias("member")),
    )
    both = pairs.select("kind", F.explode(sides).alias("side")).select("kind", "side.*")
    code = ["kind", "direction", "code"]
    several = both.groupBy(code).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    return both.join(several.select(code), code, "left_semi")


def mapping_directions(pairs: DataFrame) -> DataFrame:
    """Per kind the direction recorded from the two sizes alone: ``name_to_ids`` where ids outnumber names."""
    sides = F.array(
        F.struct(F.lit(True).alias("is_id"), F.col("id").alias("code")),
        F.struct(F.lit(False).alias("is_id"), F.col("name").alias("code")),
    )
    codes = pairs.select("kind", F.explode(sides).alias("side")).select("kind", "side.*").distinct()
    sizes = codes.groupBy("kind").agg(
        F.count_if("is_id").alias("ids"), F.count_if(~F.col("is_id")).alias("names")
    )
    direction = F.when(F.col("ids") > F.col("names"), "name_to_ids").when(
        F.col("ids") < F.col("names"), "id_to_names"
    )
    return sizes.withColumn("direction", direction)


def unknown_codes(pairs: DataFrame, kind: str = SPECIES) -> DataFrame:
    """Ids containing ``UNK`` once each, and per id its name when that contains ``UNKNOWN``."""
    found = F.array_compact(
        F.array(
            F.when(F.contains("id", F.lit("UNK")), F.struct(F.lit("id").alias("role"), F.col("id").alias("code"))),
            F.when(
                F.contains("name", F.lit("UNKNOWN")),
                F.struct(F.lit("name").alias("role"), F.col("name").alias("code")),
            ),
        )
    )
    return pairs.filter(F.col("kind") == kind).select(F.explode(found).alias("found")).select("found.*")


def code_roles(pairs: DataFrame) -> DataFrame:
    """For every text of a kind, whether it occurs as an id and whether it occurs as a name."""
    uses = F.array(
        F.struct(F.col("id").alias("code"), F.lit(True).alias("as_id")),
        F.struct(F.col("name").alias("code"), F.lit(False).alias("as_id")),
    )
    return (
        pairs.select("kind", F.explode(uses).alias("use"))
        .select("kind", "use.*")
        .groupBy("kind", "code")
        .agg(F.bool_or("as_id").alias("is_id"), F.bool_or(~F.col("as_id")).alias("is_name"))
    )


def mapping_orientation(pairs: DataFrame) -> DataFrame:
    """Per ambiguous code whether it is an id with names (true) or a name with ids (false).

    A text used only as an id or only as a name is evidence, a text used as
    both is not; evidence from code and member that disagrees says nothing.
    """
    roles = code_roles(pairs)
    code_says = F.when(F.col("is_id") != F.col("is_name"), F.col("is_id"))
    member_says = F.when(F.col("is_id") != F.col("is_name"), F.col("is_name"))
    of_code = roles.select("kind", "code", code_says.alias("code_says"))
    of_member = roles.select("kind", F.col("code").alias("member"), member_says.alias("member_says"))
    agreed = F.when(
        F.coalesce(F.col("code_says") == F.col("member_says"), F.lit(True)),
        F.coalesce("code_says", "member_says"),
    )
    return (
        ambiguous_codes(pairs)
        .join(of_code, ["kind", "code"])
        .join(of_member, ["kind", "member"])
        .groupBy("kind", "direction", "code")
        .agg(F.bool_and(agreed).alias("is_id_to_name"))
    )


def code_repairs(pairs: DataFrame, member: str = "id", key: str = "name") -> DataFrame:
    """What to look up to repair a row: (kind, lookup, code, replacement).

    A ``member`` of an ambiguous key that is itself a key stands in the wrong
    column: rows with that member get the canonical member found under it instead.
    Every other ambiguous key replaces its members by the canonical one,
    unless one of them stood in the wrong column. Canonical is the longest
    member, the smallest of several, among those that are not keys themselves; rows whose
    key has no such member stay. By default names repair
    ids; exchange ``member`` and ``key`` to repair names by id.

    One row per ambiguous key or misplaced member, however many pairs they have.
    """
    keys = pairs.select("kind", F.col(key).alias(member), F.lit(True).alias("is_key")).distinct()
    known = pairs.join(keys, ["kind", member], "left")
    proper = F.col("is_key").isNull() & F.col(member).isNotNull()
    by_key = known.groupBy("kind", key).agg(
        F.count(F.lit(1)).alias("members"),
        F.bool_or(F.col("is_key").isNotNull()).alias("has_misplaced"),
        F.min_by(member, F.when(proper, F.struct(-F.length(member), F.col(member)))).alias("canonical"),
    )
    ambiguous = by_key.filter("members > 1")
    lookup = by_key.filter("canonical IS NOT NULL").select("kind", F.col(key).alias(member), "canonical")
    misplaced = known.filter("is_key").join(ambiguous, ["kind", key], "left_semi").select("kind", member).distinct()
    moves = misplaced.join(lookup, ["kind", member]).select(
        "kind", F.lit(member).alias("lookup"), F.col(member).alias("code"), "canonical"
    )
    syncs = ambiguous.filter("NOT has_misplaced AND canonical IS NOT NULL").select(
        "kind", F.lit(key).alias("lookup"), F.col(key).alias("code"), "canonical"
    )
    return moves.unionByName(syncs).withColumnRenamed("canonical", "replacement")


def needed_lookups(repairs: DataFrame) -> set[tuple[str, str]]:
    """The (kind, lookup) combinations that occur; at most two per kind."""
    return {(r.kind, r.lookup) for r in repairs.select("kind", "lookup").distinct().collect()}


def apply_repairs(
    rows: DataFrame, repairs: DataFrame, needed: set[tuple[str, str]], member: str = "id", key: str = "name", salts: int = 1
) -> DataFrame:
    """Rewrite the codes of every row; batch and streaming rows alike.

    Equi-joins on one code each, and only the ``needed`` ones: rows are not
    shuffled to look up nothing. ``repairs`` should be a staged table: Spark
    then broadcasts it only while its files are small, and otherwise runs a
    sort-merge join whose hot keys adaptive execution splits. A stream with state has no adaptive execution:
    there ``salts`` copies of the lookups, which are small beside the rows, spread the rows of a code over as many tasks.
    """
    columns = rows.columns
    salted = []
    if salts > 1:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(salts)))
        repairs = repairs.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        salted = ["_salt"]
    for kind, names in CODE_COLUMNS.items():
        column = dict(zip(("id", "name"), names))
        found = {}
        for lookup, result in ((member, "_moved"), (key, "_synced")):
            found[lookup] = F.lit(None)
            if (kind, lookup) in needed:
                wanted = repairs.filter((F.col("kind") == kind) & (F.col("lookup") == lookup))
                by_code = wanted.select(F.col("code").alias(column[lookup]), F.col("replacement").alias(result), *salted)
                rows = rows.join(by_code, [column[lookup], *salted], "left")
                found[lookup] = F.col(result)
        old_member, old_key = F.col(column[member]), F.col(column[key])
        repaired = {
            column[member]: F.when(old_member.isNotNull(), F.coalesce(found[member], found[key], old_member)),
            column[key]: F.when(found[member].isNotNull(), old_member).otherwise(old_key),
        }
        rows = rows.withColumns(repaired).select(*columns, *salted)
    return rows.select(columns)
