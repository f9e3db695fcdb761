"""Constraint language, patterns and row filters. Everything compiles to one Column per filter."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import content_type_main, let, url_host
from plexus.types import ID


def project(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """B01. Only the asked columns; none asked means the id."""
    return df.select(*columns) if columns else df.select(ID)


def _literal(value: Any, data_type: T.DataType) -> Column:
    """A literal of the column's own type where exact, so that the filter reaches the scan."""
    if isinstance(value, Mapping) and "_date" in value:
        return F.lit(value["_date"]).cast(
            data_type if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType))
            else T.TimestampType())
    if isinstance(data_type, T.NumericType) and not isinstance(value, bool):
        number = float(value)
        exact = isinstance(data_type, T.IntegralType) and number.is_integer()
        return F.lit(int(number)).cast(data_type) if exact else F.lit(number)
    return F.lit(value)


def _comparison(column: Column, data_type: T.DataType, op: str, value: Any) -> Column:
    if op in ("in", "not in"):
        values = [F.lit(None) if v is None else _literal(v, data_type) for v in value]
        hit = column.isin(values) if values else F.lit(False)
        return hit if op == "in" else ~hit
    if value is None:
        if op == "==":
            return column.isNull()
        if op == "!=":
            return column.isNotNull()
        raise ValueError(f"{op} needs a value")
    right = _literal(value, data_type)
    if op == "==":
        return column == right
    if op == "!=":
        return column != right
    if op == "<":
        return column < right
    if op == "<=":
        return column <= right
    if op == ">":
        return column > right
    if op == ">=":
        return column >= right
    raise ValueError(f"unknown operator {op}")


def condition(df: DataFrame, constraints: Mapping[str, Sequence[Any]]) -> Column:
    """B02. ``{property: [op, value, op, value, ...]}`` as one condition; all parts must hold.

    Operators: == != < <= > >= in, not in. ``{"_date": iso}`` is a datetime value. None with
    == and != tests for NULL. Everything else is three-valued SQL logic.
    """
    terms = []
    for name, spec in constraints.items():
        if len(spec) % 2:
            raise ValueError(f"{name}: operators and values must come in pairs")
        data_type = df.schema[name].dataType
        for op, value in zip(spec[::2], spec[1::2]):
            terms.append(_comparison(F.col(name), data_type, op, value))
    return reduce(lambda a, b: a & b, terms, F.lit(True)) if terms else F.lit(True)


def constrain(df: DataFrame, constraints: Mapping[str, Sequence[Any]]) -> DataFrame:
    """B02. Rows that meet all constraints, as one filter."""
    return df.where(condition(df, constraints)) if constraints else df


def similar_to(value: str | Column, pattern: str) -> Column:
    """B08. SQL ``SIMILAR TO``: ``%`` any text, ``_`` one character, the rest a regular expression."""
    out, escaped, in_set = [], False, False
    for ch in pattern:
        if escaped:
            out.append(re.escape(ch))
            escaped = False
        elif ch == "\\":
            escaped = True
        elif in_set:
            out.append(ch)
            in_set = ch != "]"
        elif ch == "[":
            out.append(ch)
            in_set = True
        elif ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch in ".^$":
            out.append("\\" + ch)
        else:
            out.append(ch)
    c = F.col(value) if isinstance(value, str) else value
    return c.rlike("(?s)^(?:" + "".join(out) + ")$")


def pattern_match(df: DataFrame, column: str, kind: str, pattern: str) -> DataFrame:
    """B08. LIKE, ILIKE, SIMILAR TO and ``~`` filters."""
    c = F.col(column)
    how = {"like": lambda: c.like(pattern), "ilike": lambda: c.ilike(pattern),
           "similar to": lambda: similar_to(c, pattern), "~": lambda: c.rlike(pattern)}
    if kind.lower() not in how:
        raise ValueError(f"unknown pattern kind {kind}")
    return df.where(how[kind.lower()]())


def with_blobs(df: DataFrame, blob_column: str, blobs: bool | None = True) -> DataFrame:
    """B12. Same rows either way; the bytes are read only when asked for."""
    if blobs:
        return df
    return df.withColumn(blob_column, F.lit(None).cast("binary"))


def with_label(annotations: DataFrame, label: str, images: DataFrame, image_key: str,
               limit: int | None = None) -> DataFrame:
    """B13. Images that carry an annotation with the label; each image once."""
    owners = annotations.where(F.col("label") == label).select(F.col(image_key).alias(ID)).distinct()
    out = images.join(owners, ID, "left_semi")
    return out if limit is None else out.orderBy(ID).limit(limit)


def confidence_filter(df: DataFrame, threshold: float = 0.7, score: str = "score") -> DataFrame:
    """B14. Drop detections whose score is below the threshold."""
    return df.where(F.col(score) >= F.lit(float(threshold)))


# Content types kept by default.
ALLOWED_CONTENT_TYPES = ("text/plain", "text/html", "application/pdf")


def content_type_allow(df: DataFrame, column: str = "content_type",
                       allowed: Sequence[str] = ALLOWED_CONTENT_TYPES) -> DataFrame:
    """B15. Keep responses whose bare content type is allowed."""
    return df.where(content_type_main(column).isin(*allowed))


def domain_suffixes(domain: Column) -> Column:
    """A domain and all its parent domains, as an array."""
    return let(F.split(domain, r"\."), lambda parts: F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))


def allowed_domains(df: DataFrame, start_urls: DataFrame, extra: Sequence[str] = (),
                    url: str = "url") -> DataFrame:
    """B16. Rows on the hosts of the start urls or the extra domains, subdomains included, whatever port and capitals.

    The suffixes of each row's domain are matched with an equi join: no scan of a domain list
    per row. Domains repeat heavily, so the join runs on distinct domains and the rows come
    back through a semi join.
    """
    spark = df.sparkSession
    domains = start_urls.select(url_host(start_urls.columns[0]).alias("_suffix"))
    if extra:
        domains = domains.union(spark.createDataFrame([(d.lower(),) for d in extra], "_suffix string"))
    domains = domains.where("_suffix is not null").distinct()
    rows = df.withColumn("_domain", url_host(url))
    fits = (rows.select("_domain").distinct()
            .select("_domain", F.explode(domain_suffixes(F.col("_domain"))).alias("_suffix"))
            .join(domains, "_suffix", "left_semi").select("_domain").distinct())
    return rows.join(fits, "_domain", "left_semi").drop("_domain")


def drop_null_properties(df: DataFrame, key: str = ID) -> DataFrame:
    """B17. One JSON record per row, without the NULL properties."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, F.to_json(F.struct(*rest), {"ignoreNullFields": "true"}).alias("properties"))
