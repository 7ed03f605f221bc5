"""Hand-made raw records."""

from strikelens.schemas import DETAILS

VALID = {
    "record_id": 2259, "year": 1990, "month": 1, "day": 11, "operator_id": "MIL", "operator": "MILITARY",
    "aircraft": "F-16", "airport_id": "KFSM", "airport_name": "FORT SMITH REGIONAL ARPT", "state": "AR",
    "faa_region": "ASW", "flight_phase": "CLIMB", "visibility": "DAY", "height": 1400.0, "speed": 200.0,
    "species_id": "YH004", "species_name": "HORNED LARK", "species_quantity": "1", "aircraft_damage": False,
}

UNKNOWN = {**VALID, "species_id": "100000000000", "species_name": "UNKNOWN", "species_quantity": ""}


def details(spark, *records):
    return spark.createDataFrame([tuple(r.get(f) for f in DETAILS.fieldNames()) for r in records], DETAILS)


def summary_like(spark, *changes):
    from strikelens.schemas import SUMMARY

    base = {
        "record_id": 111, "year": 2015, "month": 6, "day": 24, "aircraft": "T-38A", "aircraft_mass": 4.0, "engines": 2,
        "airport_id": "KIWA", "airport_name": "PHOENIX-MESA GATEWAY", "state": "AZ", "faa_region": "AWP",
        "flight_phase": "CLIMB", "species_id": "K5105", "species_name": "MERLIN", "species_quantity_min": 2,
        "species_quantity_max": 10, "aircraft_damage": False,
    }
    made = [{**base, **change} for change in changes]
    return spark.createDataFrame([tuple(r.get(f) for f in SUMMARY.fieldNames()) for r in made], SUMMARY)
