"""Specs, runs, links, cascading deletes and done flags (K).

Plain files know no row delete: deletes return the tables that stay, to be written in place of
the old ones. Id sets are distinct before each anti join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.functions.scalars import mime_from_bytes, resource_key, sql_creator_key
from plexus.operators.graph import neighbour_ids
from plexus.operators.upsert import add_edge_if_not_found, update_properties
from plexus.session import materialise
from plexus.types import DST, ID, SRC


def create_spec(specs: DataFrame, spec_id: str, properties: Mapping[str, Any] | None = None, clean: bool = False) -> DataFrame:
    """K01. Add a spec; an existing id is an error unless ``clean``, which replaces it."""
    exists = not specs.where(F.col("spec_id") == spec_id).isEmpty()
    if exists and not clean:
        raise ValueError(f"spec {spec_id} exists")
    spark = specs.sparkSession
    values = {"spec_id": spec_id, **(properties or {})}
    row = spark.createDataFrame([tuple(values.get(f.name) for f in specs.schema.fields)], specs.schema)
    return specs.where(~F.col("spec_id").eqNullSafe(F.lit(spec_id))).unionByName(row)


def add_run(runs: DataFrame, spec_id: str, run_id: str, start: Column) -> DataFrame:
    """K02. Append a run with its start."""
    spark = runs.sparkSession
    columns = {"run_id": F.lit(run_id), "spec_id": F.lit(spec_id), "run_start": start}
    row = spark.range(1).select(*[(columns.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in runs.schema.fields])
    return runs.unionByName(row)


def finish_run(runs: DataFrame, run_id: str, end: Column, linked_types: Sequence[str] = ()) -> DataFrame:
    """K02. Set end and linked types of a run."""
    return update_properties(runs, {"run_id": ["==", run_id]}, {
        "run_end": end, "linked_types": F.array(*[F.lit(t) for t in linked_types]).cast("array<string>")})


def link_objects(objects: DataFrame, run: str = "run_id", edge_class: str = "WorkflowAdded") -> DataFrame:
    """K03. Edges from each run to every object that carries its id."""
    return objects.where(F.col(run).isNotNull()).select(
        F.col(run).cast("string").alias(SRC), F.col(ID).alias(DST), F.lit(edge_class).alias("class"))


@dataclass
class Workflow:
    """Specs, runs, object tables by class (each with ``spec_id``), and edges."""

    specs: DataFrame
    runs: DataFrame
    objects: dict[str, DataFrame] = field(default_factory=dict)
    edges: DataFrame | None = None


def _without_dangling(work: Workflow, gone: DataFrame) -> DataFrame | None:
    if work.edges is None:
        return None
    return (work.edges.join(gone.select(F.col(ID).alias(SRC)), SRC, "left_anti")
            .join(gone.select(F.col(ID).alias(DST)), DST, "left_anti"))


def delete_specs(work: Workflow, spec_ids: DataFrame, owned: Sequence[str] = ()) -> Workflow:
    """K04, K06. Remove specs with their runs, objects, blobs reached from those objects, and all their edges.

    ``owned`` names classes without ``spec_id`` (blobs): their rows go when an edge leads to them
    from a deleted object. ``spec_ids`` is one column of ids.
    """
    ids = materialise(spec_ids.select(F.col(spec_ids.columns[0]).alias("spec_id")).distinct(), "spec-ids")
    text = lambda c: F.col(c).cast("string").alias(ID)
    gone = reduce(DataFrame.unionByName, [
        ids.select(text("spec_id")), work.runs.join(ids, "spec_id", "left_semi").select(text("run_id")),
        *[df.join(ids, "spec_id", "left_semi").select(text(ID)) for c, df in work.objects.items() if c not in owned]])
    # the ids that go are needed for every table: they are found once
    gone = materialise(gone, "gone")
    stay = {c: df.join(ids, "spec_id", "left_anti") for c, df in work.objects.items() if c not in owned}
    if owned:
        if work.edges is None:
            raise ValueError("owned classes need edges")
        reached = materialise(work.edges.join(gone.select(F.col(ID).alias(SRC)), SRC, "left_semi").select(F.col(DST).alias(ID)).distinct(), "reached")
        for c in owned:
            stay[c] = work.objects[c].join(reached, ID, "left_anti")
            gone = gone.unionByName(work.objects[c].join(reached, ID, "left_semi").select(ID))
    return replace(work, specs=work.specs.join(ids, "spec_id", "left_anti"), runs=work.runs.join(ids, "spec_id", "left_anti"),
                   objects=stay, edges=_without_dangling(work, gone))


def delete_all(work: Workflow, workflow_name: str, owned: Sequence[str] = ()) -> Workflow:
    """K06. Remove all specs of one workflow."""
    return delete_specs(work, work.specs.where(F.col("workflow_name") == workflow_name).select("spec_id"), owned)


def delete_shared_sets(vectors: DataFrame, registry: DataFrame, spec_id: Any) -> tuple[DataFrame, DataFrame]:
    """K05. Remove a spec's vectors; a vector set goes too when all its vectors were the spec's."""
    counts = vectors.groupBy("set").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("spec_id") == F.lit(spec_id)).alias("_mine"))
    emptied = counts.where("_mine > 0 and _mine = _n").select(F.col("set").alias("name"))
    stay = vectors.where(~F.col("spec_id").eqNullSafe(F.lit(spec_id)))
    return stay, registry.join(emptied, "name", "left_anti")


def delete_by_creator(classes: Mapping[str, DataFrame], creator_key: str | None = None, creator: str | None = None,
                      edges: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """K07. Remove every object of a creator key or creator name, in all classes, with its edges."""
    if (creator_key is None) == (creator is None):
        raise ValueError("give creator_key or creator")
    column, value = ("wf_creator_key", creator_key) if creator_key is not None else ("wf_creator", creator)
    hit = F.col(column).eqNullSafe(value)
    stay = {name: df.where(~hit) for name, df in classes.items()}
    if edges is None:
        return stay, None
    gone = reduce(DataFrame.unionByName, [df.where(hit).select(ID) for df in classes.values()]).distinct()
    return stay, (edges.join(gone.select(F.col(ID).alias(SRC)), SRC, "left_anti")
                  .join(gone.select(F.col(ID).alias(DST)), DST, "left_anti"))


def delete_lineage(nodes: DataFrame, edges: DataFrame, urls: DataFrame, levels: int = 3, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """K08. Remove datasets by url with everything below: record sets, records, fields."""
    here = materialise(nodes.join(urls.select(F.col(urls.columns[0]).alias(url)), url, "left_semi").select(ID), "lineage")
    gone = here
    for _ in range(levels):
        # each level is written once: it feeds both the next level and the result
        here = materialise(neighbour_ids(here, edges, "out"), "lineage")
        gone = gone.unionByName(here)
    gone = gone.distinct()
    left = nodes.join(gone, ID, "left_anti")
    return left, (edges.join(gone.select(F.col(ID).alias(SRC)), SRC, "left_anti")
                  .join(gone.select(F.col(ID).alias(DST)), DST, "left_anti"))


def pending(rows: DataFrame, flag: str, done: Any = True) -> DataFrame:
    """K09. Rows whose flag is not the done value; NULL counts as pending."""
    return rows.where(~F.col(flag).eqNullSafe(F.lit(done)))


def pending_by_ledger(rows: DataFrame, ledger: DataFrame, job: str, key: str = ID) -> DataFrame:
    """K09. Rows without an entry of the job in the ledger."""
    seen = ledger.where(F.col("job") == job).select(F.col("object_id").alias(key))
    return rows.join(seen, key, "left_anti")


def mark_done(objects: DataFrame, derived: DataFrame, job: str, run_id: str, key: str = ID, source: str = "source_id") -> DataFrame:
    """K10. Ledger entries: object, job, number of derived rows, run."""
    counts = derived.groupBy(F.col(source).alias(key)).agg(F.count(F.lit(1)).alias("n_derived"))
    return objects.select(key).join(counts, key, "left").select(
        F.col(key).alias("object_id"), F.lit(job).alias("job"),
        F.coalesce("n_derived", F.lit(0).cast("bigint")).alias("n_derived"), F.lit(run_id).alias("run_id"))


def annotation_provenance(annotations: DataFrame, existing: DataFrame, run_id: str) -> DataFrame:
    """K11. Edges run to annotation by the key of run and annotation; each is added once."""
    edges = annotations.select(F.lit(run_id).alias(SRC), F.col(ID).cast("string").alias(DST),
                               F.sha1(F.concat_ws("_", F.lit(run_id), F.col(ID))).alias("wf_sha1_hash"))
    return add_edge_if_not_found(edges, existing)


def sql_ingest(rows: DataFrame, *, host: str, database: str, table: str, key: str, entity_class: str, run_id: str | None = None,
               binary: str | None = None, add_table_source: bool = True, drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame | None]:
    """K12. A SQL table as nodes: SHA-1 key, creator, creator key, run, source table; NULLs left out.

    A binary column moves to its own table keyed like the node, with its media type. Nodes come as
    ``wf_sha1_hash, EntityClass, properties`` (JSON); append them with ``insert_if_not_found``.
    """
    digest = resource_key(f"postgres://{host}/{database}/{table}", F.col(key))
    left = [c for c in rows.columns if c != binary and c not in drop]
    extra = {"wf_creator": F.lit("sql_ingestor"), "wf_creator_key": sql_creator_key(host, database, table)}
    if run_id:
        extra["wf_workflow_id"] = F.lit(run_id)
    if add_table_source:
        extra["wf_table_source"] = F.lit(table)
    body = F.to_json(F.struct(*left, *[v.alias(k) for k, v in extra.items()]), {"ignoreNullFields": "true"})
    nodes = rows.select(digest.alias("wf_sha1_hash"), F.lit(entity_class).alias("EntityClass"), body.alias("properties"))
    if binary is None:
        return nodes, None
    blobs = rows.where(F.col(binary).isNotNull()).select(
        digest.alias("wf_sha1_hash"), mime_from_bytes(binary).alias("adb_mime_type"), F.col(binary).alias("data"))
    return nodes, blobs
