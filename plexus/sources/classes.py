"""Node classes, edge classes and vector sets as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.types import DST, ID, PROPERTY_TYPES, SRC, property_type


def unique_id(class_name: str, *keys: str | Column) -> Column:
    """Deterministic id of a row of a class, so that recomputation never changes it."""
    return F.concat_ws(":", F.lit(class_name), *[_col(k).cast("string") for k in keys])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def entity_table(df: DataFrame, class_name: str, key: str | Sequence[str],
                 properties: Mapping[str, str] | None = None) -> DataFrame:
    """A01. One node class. ``properties`` maps property name to source column."""
    keys = [key] if isinstance(key, str) else list(key)
    props = properties if properties is not None else {c: c for c in df.columns}
    return df.select(unique_id(class_name, *keys).alias(ID),
                     *[F.col(c).alias(p) for p, c in props.items()])


def connection_table(df: DataFrame, class_name: str, key: str | Sequence[str],
                     src: tuple[str, str], dst: tuple[str, str],
                     properties: Mapping[str, str] | None = None) -> DataFrame:
    """A02. One edge class from the foreign keys of ``df``.

    ``src`` and ``dst`` are (node class, key column). Rows without an endpoint are no edges.
    Several shapes of one class are the union of several calls; the shape columns tell them apart.
    """
    keys = [key] if isinstance(key, str) else list(key)
    props = properties or {}
    return (
        df.where(F.col(src[1]).isNotNull() & F.col(dst[1]).isNotNull())
        .select(
            unique_id(class_name, *keys).alias(ID),
            unique_id(src[0], src[1]).alias(SRC),
            unique_id(dst[0], dst[1]).alias(DST),
            F.lit(class_name).alias("class"),
            F.lit(src[0]).alias("src_class"),
            F.lit(dst[0]).alias("dst_class"),
            *[F.col(c).alias(p) for p, c in props.items()],
        )
    )


def agreed_properties(frames: Mapping[str, DataFrame]) -> dict[str, str]:
    """Properties whose type is the same in every class that has them (a pass over schemas only)."""
    seen: dict[str, set[str | None]] = {}
    for frame in frames.values():
        for f in frame.schema.fields:
            seen.setdefault(f.name, set()).add(property_type(f.dataType, f.name))
    return {name: next(iter(kinds)) for name, kinds in seen.items()
            if len(kinds) == 1 and None not in kinds and "blob" not in kinds}


def _conform(frames: Mapping[str, DataFrame], fixed: Sequence[str], tag: str) -> DataFrame:
    agreed = agreed_properties(frames)
    names = [n for n in agreed if n not in fixed and n != tag]
    result = None
    for class_name, frame in frames.items():
        present = set(frame.columns)
        part = frame.select(
            *[F.col(c) for c in fixed],
            F.lit(class_name).alias(tag),
            *[F.col(n).cast(PROPERTY_TYPES[agreed[n]]).alias(n) for n in names if n in present],
        )
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    if result is None:
        raise ValueError("no classes given")
    return result


def system_entity(nodes: Mapping[str, DataFrame]) -> DataFrame:
    """A03. All nodes of all classes over the properties whose type agrees everywhere."""
    return _conform(nodes, [ID], "class")


def system_connection(edges: Mapping[str, DataFrame]) -> DataFrame:
    """A04. All edges of all classes over the properties whose type agrees everywhere."""
    return _conform(edges, [ID, SRC, DST], "class")


def descriptor_table(vectors: DataFrame, set_name: str | None = None) -> DataFrame:
    """A05. One vector set (or all): id, properties, ``_vector``; the search columns start NULL."""
    out = vectors if set_name is None else vectors.where(F.col("set") == set_name)
    return out.withColumns({"_distance": F.lit(None).cast("double"),
                            "_find_similar": F.lit(None).cast("string")})


FETCH_ROWS = 10_000          # rows that a driver fetches in one trip
PARTITION_ROWS = 1_000_000   # rows that a range of a table is planned for


def jdbc_table(spark: SparkSession, table: str, columns: Sequence[str], *, url: str | None = None,
               path: str | None = None, partition_column: str | None = None,
               bounds: tuple[int, int] | None = None, partitions: int | None = None,
               properties: Mapping[str, str] | None = None) -> DataFrame:
    """A12. Selected columns of a SQL table; a missing column is an error.

    With ``url`` the table is read over JDBC in ranges of ``partition_column``, by default the first selected column of a whole
    number. The database is asked for its least and largest value and the number of rows, unless ``bounds`` and
    ``partitions`` are given; a range is planned for ``PARTITION_ROWS`` rows. NULLs lie in the first range. A table without
    such a column is one task. With ``path`` the same call reads an exported parquet copy.
    """
    if url is not None:
        def load(dbtable: str, **more: Any) -> DataFrame:
            options = {"fetchsize": FETCH_ROWS, **(properties or {}), "url": url, "dbtable": dbtable, **more}
            return spark.read.format("jdbc").options(**options).load()

        df = load(table)
        if partition_column is None:
            whole = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}
            partition_column = next((c for c in columns if c in whole), None)
        if partition_column is not None:
            if bounds is None or partitions is None:
                c = partition_column
                low, high, n = load(f"(SELECT min({c}) AS low, max({c}) AS high, count(*) AS n FROM {table}) AS bounds").first()
                bounds = bounds or (low, high)
                partitions = partitions or max(1, -(-n // PARTITION_ROWS))
            if bounds[0] is not None and partitions > 1:
                df = load(table, partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1] + 1, numPartitions=partitions)
    elif path is not None:
        df = spark.read.parquet(path)
    else:
        raise ValueError("give url or path")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"table {table} has no column {', '.join(missing)}")
    return df.select(*columns)


@dataclass
class PropertyGraph:
    """Node classes, edge classes and vector sets under one name space each."""

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)
    vectors: dict[str, DataFrame] = field(default_factory=dict)

    def entity(self) -> DataFrame:
        return system_entity(self.nodes)

    def connection(self) -> DataFrame:
        return system_connection(self.edges)

    def register(self, prefix: str = "") -> list[str]:
        """Publish every class as a temporary view, for ``spark.sql``."""
        views = []
        for kind, frames in (("entity", self.nodes), ("connection", self.edges),
                             ("descriptor", self.vectors)):
            for name, frame in frames.items():
                view = f"{prefix}{kind}_{name}"
                frame.createOrReplaceTempView(view)
                views.append(view)
        if self.nodes:
            self.entity().createOrReplaceTempView(f"{prefix}system_Entity")
            views.append(f"{prefix}system_Entity")
        if self.edges:
            self.connection().createOrReplaceTempView(f"{prefix}system_Connection")
            views.append(f"{prefix}system_Connection")
        return views
