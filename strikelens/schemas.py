"""Record layouts.

Columns are snake_case inside Spark and camelCase in JSON (``functions.codec``).
Record ids are bigint: large inputs run out of 32-bit ids.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the raw file, as (header, column, type).
DETAIL_COLUMNS: list[tuple[str, str, str]] = [
    ("Record ID", "record_id", "bigint"),
    ("Incident Year", "year", "int"),
    ("Incident Month", "month", "int"),
    ("Incident Day", "day", "int"),
    ("Operator ID", "operator_id", "string"),
    ("Operator", "operator", "string"),
    ("Aircraft", "aircraft", "string"),
    ("Aircraft Type", "aircraft_type", "string"),
    ("Aircraft Make", "aircraft_make", "string"),
    ("Aircraft Model", "aircraft_model", "string"),
    ("Aircraft Mass", "aircraft_mass", "float"),
    ("Engine Make", "engine_make", "int"),
    ("Engine Model", "engine_model", "string"),
    ("Engines", "engines", "int"),
    ("Engine Type", "engine_type", "string"),
    ("Engine1 Position", "engine1_position", "string"),
    ("Engine2 Position", "engine2_position", "int"),
    ("Engine3 Position", "engine3_position", "string"),
    ("Engine4 Position", "engine4_position", "int"),
    ("Airport ID", "airport_id", "string"),
    ("Airport", "airport_name", "string"),
    ("State", "state", "string"),
    ("FAA Region", "faa_region", "string"),
    ("Warning Issued", "warning_issued", "boolean"),
    ("Flight Phase", "flight_phase", "string"),
    ("Visibility", "visibility", "string"),
    ("Precipitation", "precipitation", "string"),
    ("Height", "height", "float"),
    ("Speed", "speed", "float"),
    ("Distance", "distance", "float"),
    ("Species ID", "species_id", "string"),
    ("Species Name", "species_name", "string"),
    ("Species Quantity", "species_quantity", "string"),
    ("Flight Impact", "flight_impact", "string"),
    ("Fatalities", "fatalities", "int"),
    ("Injuries", "injuries", "int"),
    ("Aircraft Damage", "aircraft_damage", "boolean"),
    ("Radome Strike", "radome_strike", "boolean"),
    ("Radome Damage", "radome_damage", "boolean"),
    ("Windshield Strike", "windshield_strike", "boolean"),
    ("Windshield Damage", "windshield_damage", "boolean"),
    ("Nose Strike", "nose_strike", "boolean"),
    ("Nose Damage", "nose_damage", "boolean"),
    ("Engine1 Strike", "engine1_strike", "boolean"),
    ("Engine1 Damage", "engine1_damage", "boolean"),
    ("Engine2 Strike", "engine2_strike", "boolean"),
    ("Engine2 Damage", "engine2_damage", "boolean"),
    ("Engine3 Strike", "engine3_strike", "boolean"),
    ("Engine3 Damage", "engine3_damage", "boolean"),
    ("Engine4 Strike", "engine4_strike", "boolean"),
    ("Engine4 Damage", "engine4_damage", "boolean"),
    ("Engine Ingested", "engine_ingested", "boolean"),
    ("Propeller Strike", "propeller_strike", "boolean"),
    ("Propeller Damage", "propeller_damage", "boolean"),
    ("Wing or Rotor Strike", "wing_rotor_strike", "boolean"),
    ("Wing or Rotor Damage", "wing_rotor_damage", "boolean"),
    ("Fuselage Strike", "fuselage_strike", "boolean"),
    ("Fuselage Damage", "fuselage_damage", "boolean"),
    ("Landing Gear Strike", "landing_gear_strike", "boolean"),
    ("Landing Gear Damage", "landing_gear_damage", "boolean"),
    ("Tail Strike", "tail_strike", "boolean"),
    ("Tail Damage", "tail_damage", "boolean"),
    ("Lights Strike", "lights_strike", "boolean"),
    ("Lights Damage", "lights_damage", "boolean"),
    ("Other Strike", "other_strike", "boolean"),
    ("Other Damage", "other_damage", "boolean"),
]


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike DDL parsing it needs no running session."""
    pairs = [field.split() for field in fields.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[dtype]) for name, dtype in pairs])


DETAILS = T.StructType([T.StructField(name, _TYPES[dtype]) for _, name, dtype in DETAIL_COLUMNS])

SUMMARY = _struct(
    "record_id bigint, year int, month int, day int, aircraft string, aircraft_mass float, engines int, "
    "airport_id string, airport_name string, state string, faa_region string, warning_issued boolean, "
    "flight_phase string, species_id string, species_name string, species_quantity_min int, "
    "species_quantity_max int, fatalities int, injuries int, aircraft_damage boolean"
)

KEY = _struct("year int, month int, species_id string, species_name string, aircraft_damage boolean")

GROUPED = _struct("year int, species_id string, species_name string")

RANKED = _struct("index int, year int, species_id string, species_name string, amount bigint")

# A record of a keyed stream: JSON key, JSON value, string headers and the time of the record.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("headers", T.ArrayType(_struct("key string, value string"))),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
