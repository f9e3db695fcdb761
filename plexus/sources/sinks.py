"""Sinks: headered CSV and JSON-safe rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.sources.objects import PROPERTY_CSV
from plexus.types import property_type


def write_property_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A20. Headered CSV without an index, one file per partition, which ``property_csv`` reads back as it was."""
    df.write.mode(mode).options(**PROPERTY_CSV | {"nullValue": "", "emptyValue": '""'}).csv(path)


def export_rows(df: DataFrame, as_json: bool = False) -> tuple[DataFrame, list[dict[str, str]]]:
    """A21. Rows that JSON can carry (bytes in base64, times in ISO form with fraction and zone) and the ordered column metadata."""
    columns, meta = [], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            # base64 in one line
            c = F.regexp_replace(F.base64(c), r"\s", "")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            fraction = F.when(F.date_format(c, "SSSSSS") != "000000", F.date_format(c, ".SSSSSS")).otherwise("")
            zone = F.date_format(c, "xxx") if isinstance(f.dataType, T.TimestampType) else F.lit("")
            c = F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), fraction, zone)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        columns.append(c.alias(f.name))
        meta.append({"name": f.name, "type": property_type(f.dataType, f.name) or "json"})
    rows = df.select(*columns)
    if as_json:
        rows = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("row"))
    return rows, meta
