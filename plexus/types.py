"""Property types of the data model and their Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

# Property type names of the data model.
PROPERTY_TYPES = {
    "number": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "datetime": T.TimestampType(),
    "json": T.StringType(),
    "blob": T.BinaryType(),
    "uniqueid": T.StringType(),
}

ID = "_uniqueid"
SRC = "_src"
DST = "_dst"


def property_type(data_type: T.DataType, name: str = "") -> str | None:
    """Name of the property type that a column holds; None when the model has none for it."""
    if name in (ID, SRC, DST):
        return "uniqueid"
    if isinstance(data_type, T.NumericType):
        return "number"
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(data_type, T.VariantType):
        return "json"
    if isinstance(data_type, T.BinaryType):
        return "blob"
    return None
