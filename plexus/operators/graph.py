"""Graph traversal and edge construction on DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.functions.scalars import edge_class_name, resource_key
from plexus.operators.skew import rank_in_key
from plexus.types import DST, ID, SRC


def edge_join(src: DataFrame, edges: DataFrame, dst: DataFrame) -> DataFrame:
    """C01. Source rows, edges and target rows side by side.

    Columns come back as ``src`` and ``dst`` structs plus the edge columns. Filter both ends
    before the call: the filters then sit below the joins. Keys are unique on the node sides,
    so a hot node only makes the edge side skewed, which AQE splits.
    """
    left = src.select(F.col(ID).alias(SRC), F.struct(*src.columns).alias("src"))
    right = dst.select(F.col(ID).alias(DST), F.struct(*dst.columns).alias("dst"))
    return edges.join(left, SRC).join(right, DST)


def edges_by_endpoints(edges: DataFrame, src_ids: DataFrame | None = None,
                       dst_ids: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """C02. Edges whose source and/or target is in a set, optionally with a property filter."""
    out = edges if where is None else edges.where(where)
    if src_ids is not None:
        out = out.join(src_ids.select(F.col(src_ids.columns[0]).alias(SRC)), SRC, "left_semi")
    if dst_ids is not None:
        out = out.join(dst_ids.select(F.col(dst_ids.columns[0]).alias(DST)), DST, "left_semi")
    return out


def _of_class(edges: DataFrame, edge_class: str | None) -> DataFrame:
    return edges if edge_class is None else edges.where(F.col("class") == edge_class)


def neighbour_ids(reference: DataFrame, edges: DataFrame, direction: str = "any",
                  edge_class: str | None = None) -> DataFrame:
    """Distinct ids next to the reference nodes. Reduced to distinct ids before the next shuffle."""
    if direction not in ("in", "out", "any"):
        raise ValueError("direction is in, out or any")
    chosen = _of_class(edges, edge_class)
    ref = reference.select(ID).distinct()
    parts = []
    if direction in ("out", "any"):
        # edges leaving the reference
        parts.append(chosen.join(ref.withColumnRenamed(ID, SRC), SRC, "left_semi").select(F.col(DST).alias(ID)))
    if direction in ("in", "any"):
        parts.append(chosen.join(ref.withColumnRenamed(ID, DST), DST, "left_semi").select(F.col(SRC).alias(ID)))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.distinct()


def is_connected_to(nodes: DataFrame, reference: DataFrame, edges: DataFrame,
                    direction: str = "any", edge_class: str | None = None) -> DataFrame:
    """C03. Nodes next to a reference set; each node once, however many edges lead to it.

    ``direction`` is seen from the reference: "out" follows edges away from it.
    """
    return nodes.join(neighbour_ids(reference, edges, direction, edge_class), ID, "left_semi")


def group_by_source(reference: DataFrame, edges: DataFrame, nodes: DataFrame, *,
                    direction: str = "out", edge_class: str | None = None,
                    columns: Sequence[str] = (ID,), max_items: int = 100_000) -> DataFrame:
    """C04. Result rows grouped by the node they were reached from: ``_src, part, items``.

    The sorted items of a source are cut into parts of ``max_items``: part 0 has the first ones, part 1 the
    next, so the parts in order are the whole list, however long it is. No row is dropped.
    """
    near, far = (SRC, DST) if direction == "out" else (DST, SRC)
    ref = reference.select(F.col(ID).alias("_from")).distinct()
    reached = (_of_class(edges, edge_class).select(F.col(near).alias("_from"), F.col(far).alias(ID))
               .join(ref, "_from", "left_semi")
               .join(nodes.select(ID, *[c for c in columns if c != ID]), ID))
    item = F.struct(*[F.col(c) for c in columns])
    split = (rank_in_key(reached, "_from", item, "_place")
             .withColumn("part", F.floor(F.col("_place") / F.lit(max_items)).cast("int")))
    return (split.groupBy("_from", "part").agg(F.array_sort(F.collect_list(item)).alias("items"))
            .withColumnRenamed("_from", SRC))


def k_hop(start: DataFrame, hops: Sequence[Mapping], edges: DataFrame) -> DataFrame:
    """C05. Ids reached over a fixed chain of hops, each ``{"direction", "edge_class"}``."""
    here = start.select(ID)
    for hop in hops:
        here = neighbour_ids(here, hop.get("edges", edges), hop.get("direction", "any"), hop.get("edge_class"))
    return here


def fk_edges(source: DataFrame, target: DataFrame, *, prefix: str, source_table: str,
             target_table: str, source_key: str, fk_column: str, target_key: str,
             source_class: str | None = None, target_class: str | None = None) -> DataFrame:
    """C07. Edges from a foreign key, endpoints and edge named by SHA-1 keys; dangling rows left out."""
    known = target.select(F.col(target_key).alias(fk_column))
    kept = source.select(source_key, fk_column).join(known, fk_column, "left_semi")
    src = resource_key(f"{prefix}/{source_table}", F.col(source_key))
    dst = resource_key(f"{prefix}/{target_table}", F.col(fk_column))
    name = edge_class_name(source_class or source_table, target_class or target_table)
    return (kept.select(src.alias(SRC), dst.alias(DST), F.lit(name).alias("class"))
            .withColumn("wf_sha1_hash", F.sha1(F.concat(SRC, DST))))


def dangling_edges(source: DataFrame, target: DataFrame, fk_column: str, target_key: str) -> DataFrame:
    """C08. Source rows whose foreign key has a value but no target."""
    known = target.select(F.col(target_key).alias(fk_column))
    return source.where(F.col(fk_column).isNotNull()).join(known, fk_column, "left_anti")


def merge_properties(files: DataFrame, properties: DataFrame, mode: str = "all_blobs",
                     error_missing: bool = False, key: str = "filename") -> DataFrame:
    """C09. Files with their property rows: every file (``all_blobs``) or only files with properties."""
    if mode not in ("all_blobs", "only_matched"):
        raise ValueError("mode is all_blobs or only_matched")
    if error_missing:
        for lost, what in ((files.join(properties, key, "left_anti"), "files without properties"),
                           (properties.join(files, key, "left_anti"), "properties without file")):
            n = lost.count()
            if n:
                raise ValueError(f"{n} {what}")
    return files.join(properties, key, "left" if mode == "all_blobs" else "inner")


def not_yet_loaded(candidates: DataFrame, existing: DataFrame, key: str = "wf_sha1_hash") -> DataFrame:
    """C10. Candidates whose key is not stored yet."""
    return candidates.join(existing.select(key), key, "left_anti")


def record_set_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """C11. Two record sets on their id."""
    return left.join(right, F.col(left_key) == F.col(right_key))


def link_by_url(blocks: DataFrame, images: DataFrame, edge_class: str, block_url: str = "image_url",
                image_url: str = "url") -> DataFrame:
    """C12. Edges from blocks to the images with an equal url; blocks without image give no edge."""
    targets = images.select(F.col(ID).alias(DST), F.col(image_url).alias("_url"))
    return (blocks.select(F.col(ID).alias(SRC), F.col(block_url).alias("_url"))
            .join(targets, "_url").drop("_url").withColumn("class", F.lit(edge_class)))


def coverage_check(sources: DataFrame, derived: DataFrame, derived_source: str) -> DataFrame:
    """C13. Sources with no derived row (missing) and derived rows of unknown sources (extra)."""
    made = derived.select(F.col(derived_source).alias(ID)).distinct()
    have = sources.select(ID)
    return (have.join(made, ID, "left_anti").withColumn("problem", F.lit("missing"))
            .unionByName(made.join(have, ID, "left_anti").withColumn("problem", F.lit("extra"))))


def cardinality_check(sources: DataFrame, derived: DataFrame, derived_source: str,
                      expected: int = 1) -> DataFrame:
    """C14. Sources whose number of derived rows is not the expected one (none counts as 0)."""
    counts = derived.groupBy(F.col(derived_source).alias(ID)).agg(F.count(F.lit(1)).alias("n_derived"))
    return (sources.select(ID).join(counts, ID, "left")
            .withColumn("n_derived", F.coalesce("n_derived", F.lit(0).cast("bigint")))
            .where(F.col("n_derived") != expected))


def vector_to_object(hits: DataFrame, edges: DataFrame, objects: DataFrame,
                     vector_id: str = "vector_id", edge_class: str | None = None) -> DataFrame:
    """C15. Search hits with the object that each vector describes; the distance is kept."""
    links = _of_class(edges, edge_class).select(F.col(SRC).alias(ID), F.col(DST).alias(vector_id))
    return hits.join(links, vector_id).join(objects, ID)
