"""JSON encoding of keys and values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nulls are written out, and timestamps keep their microseconds.
_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_WRITE = {**_FORMAT, "ignoreNullFields": "false"}


def wire_name(column: str) -> str:
    """``species_id`` -> ``speciesId``."""
    head, *rest = column.split("_")
    return head + "".join(word.capitalize() for word in rest)


def wire_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(wire_name(f.name), f.dataType, f.nullable) for f in schema])


def encode(schema: T.StructType) -> Column:
    """JSON text of the columns of ``schema``."""
    fields = [F.col(f.name).cast(f.dataType).alias(wire_name(f.name)) for f in schema]
    return F.to_json(F.struct(*fields), _WRITE)


def encode_list(items: str, schema: T.StructType) -> Column:
    """JSON text of an array column whose elements have the fields of ``schema``."""
    renamed = F.transform(
        F.col(items), lambda item: F.struct(*[item[f.name].alias(wire_name(f.name)) for f in schema])
    )
    return F.to_json(renamed, _WRITE)


def decode(text: str, schema: T.StructType) -> Column:
    """Struct with the fields of ``schema`` read from JSON text.

    The cast only renames the fields, so the text is parsed once however many
    fields are taken from it.
    """
    return F.from_json(F.col(text), wire_schema(schema), _FORMAT).cast(schema)


def decode_list(text: str, schema: T.StructType) -> Column:
    """Array of structs with the fields of ``schema`` read from JSON text."""
    return F.from_json(F.col(text), T.ArrayType(wire_schema(schema)), _FORMAT).cast(T.ArrayType(schema))
