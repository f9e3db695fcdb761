"""Profiles of classes and relational tables: one aggregate per table, nothing collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import glob_regex
from plexus.types import DST, ID, SRC, property_type


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def schema_profile(classes: Mapping[str, DataFrame]) -> DataFrame:
    """A06. Per class and property: rows of the class, non-NULL count, type, indexed."""
    parts = []
    for name, df in classes.items():
        props = [f for f in df.schema.fields if f.name not in (ID, SRC, DST)]
        counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                        *[F.count(F.col(f"`{f.name}`")).alias(f"_n{i}") for i, f in enumerate(props)])
        pairs = F.array(*[
            F.struct(F.lit(f.name).alias("property"), F.col(f"_n{i}").alias("n_values"),
                     F.lit(property_type(f.dataType, f.name) or "other").alias("type"))
            for i, f in enumerate(props)])
        parts.append(counts.select(F.lit(name).alias("class"), F.col("_rows").alias("matched"),
                                   F.explode(pairs).alias("p"))
                     .select("class", "matched", "p.property", "p.n_values", "p.type",
                             F.lit(False).alias("indexed")))
    return _union(parts)


def describe_connections(edges: DataFrame) -> DataFrame:
    """A07. Per edge class and shape (source class, target class): number of edges."""
    return (edges.groupBy("class", "src_class", "dst_class")
            .agg(F.count(F.lit(1)).alias("matched")))


# Roles a table can have in a graph load.
ENTITY, IMAGE, PDF = "entity", "image", "pdf"


def classify_tables(tables: Mapping[str, DataFrame], keys: Mapping[str, str], *,
                    image_tables: Sequence[str] = (), pdf_tables: Sequence[str] = (),
                    ignore_tables: Sequence[str] = (), ignore_columns: Sequence[str] = (),
                    url_columns: Sequence[str] = (), foreign_keys: Sequence[str] = (),
                    entity_names: Mapping[str, str] | None = None,
                    error_on_unused_binary: bool = False) -> DataFrame:
    """A13. Role of every table and column in a graph load, with the key verified on the rows.

    One row per kept column: table, entity name, table role, column, column role, rows,
    non-NULL values, and whether the declared key is unique and complete.
    """
    skip_table = [glob_regex(p) for p in ignore_tables]
    skip_column = [glob_regex(p) for p in ignore_columns]
    url_pattern = [glob_regex(p) for p in url_columns]
    names = entity_names or {}
    parts = []
    for table, df in tables.items():
        if any(p.match(table) for p in skip_table):
            continue
        if not isinstance(keys.get(table), str):
            raise ValueError(f"{table}: exactly one key column is needed")
        key = keys[table]
        role = IMAGE if table in image_tables else PDF if table in pdf_tables else ENTITY
        columns: list[tuple[str, str]] = []
        binary_taken = False
        for f in df.schema.fields:
            full = f"{table}.{f.name}"
            if any(p.match(full) for p in skip_column):
                continue
            if full in foreign_keys:
                columns.append((f.name, "foreign_key"))
            elif any(p.match(full) for p in url_pattern):
                if not isinstance(f.dataType, T.StringType):
                    raise ValueError(f"{full}: a url column must be a string")
                columns.append((f.name, "url"))
                binary_taken = True
            elif isinstance(f.dataType, T.BinaryType):
                if not binary_taken and role != ENTITY:
                    columns.append((f.name, "binary"))
                elif role == ENTITY and error_on_unused_binary:
                    raise ValueError(f"{full}: binary column in a plain entity table")
                binary_taken = True
            else:
                columns.append((f.name, "key" if f.name == key else "property"))
        if role != ENTITY and not binary_taken:
            raise ValueError(f"{table}: expected a binary or url column")
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"), F.count_distinct(F.col(key)).alias("_keys"),
            *[F.count(c).alias(f"_n{i}") for i, (c, _) in enumerate(columns)])
        pairs = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("column_role"),
                     F.col(f"_n{i}").alias("n_values")) for i, (c, r) in enumerate(columns)])
        parts.append(
            counts.select(F.lit(table).alias("table_name"),
                          F.lit(names.get(table, table)).alias("entity_name"),
                          F.lit(role).alias("table_role"), F.col("_rows").alias("n_rows"),
                          (F.col("_rows") == F.col("_keys")).alias("key_ok"),
                          F.explode(pairs).alias("p"))
            .select("table_name", "entity_name", "table_role", "n_rows", "key_ok", "p.*"))
    return _union(parts)


def foreign_key_candidates(tables: Mapping[str, DataFrame], keys: Mapping[str, str],
                           explicit: Mapping[str, str] | None = None,
                           automatic: bool = True) -> dict[str, str]:
    """Map ``table.column`` to ``table.key``: explicit entries, then the ``fk_<table>_<column>`` rule.

    An explicit empty target switches the column off. Table names may hold underscores: the
    longest known table name that fits wins.
    """
    explicit = explicit or {}
    found: dict[str, str] = {}
    for table, df in tables.items():
        for column in df.columns:
            full = f"{table}.{column}"
            if full in explicit:
                if explicit[full]:
                    found[full] = explicit[full]
                continue
            if automatic and column.startswith("fk_"):
                rest = column[3:]
                fits = sorted((t for t in tables if rest.startswith(f"{t}_")), key=len, reverse=True)
                if not fits:
                    raise ValueError(f"{full}: no table for this foreign key")
                found[full] = f"{fits[0]}.{rest[len(fits[0]) + 1:]}"
    for full, target in found.items():
        target_table, _, target_column = target.partition(".")
        if target_table not in tables or target_column not in tables[target_table].columns:
            raise ValueError(f"{full}: target {target} does not exist")
        if keys.get(target_table) != target_column:
            raise ValueError(f"{full}: target {target} is not the key of its table")
    return found


def discover_fks(tables: Mapping[str, DataFrame], keys: Mapping[str, str],
                 explicit: Mapping[str, str] | None = None, automatic: bool = True) -> DataFrame:
    """A14. Foreign keys confirmed on the rows: matched, unmatched and NULL counts per candidate.

    The source column is aggregated to one row per value before the join, so a value that
    fills a third of the table is one row in the shuffle.
    """
    parts = []
    for full, target in foreign_key_candidates(tables, keys, explicit, automatic).items():
        table, _, column = full.partition(".")
        target_table, _, target_column = target.partition(".")
        values = tables[table].groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        known = tables[target_table].select(F.col(target_column).alias("_v"), F.lit(True).alias("_hit"))
        n = F.col("_n")
        parts.append(
            values.join(known, "_v", "left")
            .agg(F.coalesce(F.sum(F.when(F.col("_hit"), n)), F.lit(0)).alias("n_matched"),
                 F.coalesce(F.sum(F.when(F.col("_hit").isNull() & F.col("_v").isNotNull(), n)),
                            F.lit(0)).alias("n_unmatched"),
                 F.coalesce(F.sum(F.when(F.col("_v").isNull(), n)), F.lit(0)).alias("n_null"))
            .select(F.lit(full).alias("source"), F.lit(target).alias("target"),
                    "n_matched", "n_unmatched", "n_null"))
    return _union(parts)
