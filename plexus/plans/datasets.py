"""Published datasets as graph tables: nested records, annotated images, face attributes (J)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import area_share, aspect_ratio, box_clamp, capitalize, iso_date, polygon_pairs, url_tail_id
from plexus.operators.models import Model, embed_texts
from plexus.operators.upsert import first_per_key
from plexus.sources.objects import AnnotationTables, fetch_one, fetch_urls
from plexus.types import DST, ID, SRC

# Node classes and edge classes made from the nested lists of a record.
PERSON = "array<struct<id: bigint, name: string, gender: int{0}>>"
LISTS = {
    # list: (node class, edge class, key field, JSON schema, edge properties)
    "cast": ("Professional", "HasCast", "id", PERSON.format(", character: string, cast_id: bigint"), ("character", "cast_id")),
    "crew": ("Professional", "HasCrew", "id", PERSON.format(", department: string, job: string, credit_id: string"),
             ("department", "job", "credit_id")),
    "genres": ("Genre", "HasGenre", "id", "array<struct<id: bigint, name: string>>", ()),
    "production_companies": ("ProductionCompany", "HasProductionCompany", "id", "array<struct<id: bigint, name: string>>", ()),
    "keywords": ("Keyword", "HasKeyword", "id", "array<struct<id: bigint, name: string>>", ()),
    "spoken_languages": ("SpokenLanguage", "HasSpokenLanguage", "iso_639_1", "array<struct<iso_639_1: string, name: string>>", ()),
}
MOVIE = ("title", "budget", "overview", "popularity", "tagline", "vote_average", "vote_count")


@dataclass
class GraphTables:
    """Tables by class. ``all_nodes`` and ``all_edges`` hold the classes with a common shape, told apart by ``label`` and ``class``."""
    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)
    all_nodes: DataFrame | None = None
    all_edges: DataFrame | None = None


def _list_items(records: DataFrame) -> DataFrame:
    """The items of all lists of all records in one shape, from one scan and one ``explode``."""
    kinds = {f.name: f.dataType for _, _, _, schema, names in LISTS.values()
             for f in T.DataType.fromDDL(schema).elementType.fields if f.name in names}

    def shaped(order: int, name: str, key: str, schema: str) -> Column:
        own = T.DataType.fromDDL(schema).elementType.fieldNames()

        def item(e: Column, at: Column) -> Column:
            pick = lambda n, kind: (e[n] if n in own else F.lit(None)).cast(kind).alias(n)
            return F.struct(F.lit(order).alias("list"), at.alias("at"), e[key].cast("string").alias("id"), e["name"].alias("name"),
                            pick("gender", "int"), *[pick(n, kind) for n, kind in kinds.items()])

        return F.coalesce(F.transform(F.from_json(name, schema), item), F.array())

    lists = [shaped(order, name, key, schema) for order, (name, (_, _, key, schema, _)) in enumerate(LISTS.items())]
    return records.select("movie_id", F.inline(F.concat(*lists))).where("id IS NOT NULL")


def nested_to_graph(records: DataFrame, dataset: str = "movies") -> GraphTables:
    """J01. One nested record to a Movie node, six kinds of nodes around it, and their edges.

    Lists are JSON text. A node that many records mention is kept once, from the first record
    (by movie id and place); mentions are reduced on the map side, so a shared genre stays cheap.
    All lists are parsed in one pass over the records, and the nodes of all classes come from one aggregate:
    ``all_nodes`` and ``all_edges`` need a scan each. Tables of one class are parts of these; to read several, store them first.
    """
    out = GraphTables()
    movie_key = F.col("movie_id").cast("string")
    movies = first_per_key(records, ["movie_id"], ["title"])
    out.nodes["Movie"] = movies.select(
        movie_key.alias("id"), "movie_id", *MOVIE, capitalize("title").alias("uniqueid"), F.lit("Movie").alias("label"),
        F.lit(dataset).alias("dataset_name"))
    items = _list_items(records)
    of_list = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("list") + 1)
    # cast comes before crew inside a record
    first = F.min(F.struct("movie_id", "list", "at", "name", "gender")).alias("first")
    once = items.groupBy(of_list([c for c, *_ in LISTS.values()]).alias("label"), "id").agg(first)
    out.all_nodes = once.select("id", F.col("first.name").alias("name"), F.col("first.gender").alias("gender"),
                                capitalize("first.name").alias("uniqueid"), "label", F.lit(dataset).alias("dataset_name"))
    properties = list(dict.fromkeys(n for *_, names in LISTS.values() for n in names))
    out.all_edges = items.select(F.col("movie_id").cast("string").alias(SRC), F.col("id").alias(DST),
                                 of_list([c for _, c, *_ in LISTS.values()]).alias("class"), *properties)
    return _by_class(out)


def _by_class(graph: GraphTables) -> GraphTables:
    """The table of each class, with the columns that it has."""
    for node_class, edge_class, _, _, properties in LISTS.values():
        graph.edges[edge_class] = graph.all_edges.where(F.col("class") == edge_class).select(SRC, DST, "class", *properties)
        columns = ["id", "name", *(["gender"] if node_class == "Professional" else []), "uniqueid", "label", "dataset_name"]
        graph.nodes[node_class] = graph.all_nodes.where(F.col("label") == node_class).select(*columns)
    return graph


def store_graph(graph: GraphTables, path: str) -> GraphTables:
    """Write all list nodes and all edges, one pass and one write each, in a folder per class; tables of a class read their own."""
    spark = graph.all_nodes.sparkSession

    def stored(df: DataFrame, name: str, column: str) -> DataFrame:
        df.write.mode("overwrite").partitionBy(column).parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}").select(*df.columns)

    out = GraphTables({"Movie": graph.nodes["Movie"]}, {}, stored(graph.all_nodes, "nodes", "label"), stored(graph.all_edges, "edges", "class"))
    return _by_class(out)


def poster_and_tagline(movies: DataFrame, load_text: Callable[[], Model] | None = None,
                       load_image: Callable[[], Model] | None = None, poster_url: str | Column = "poster_url",
                       fetch: Callable[[str], bytes] = fetch_one) -> GraphTables:
    """J02. Optional poster images with vectors, and optional tagline vectors, with derived ids.

    A movie whose poster cannot be fetched gets none.
    """
    from pyspark.sql import types as T
    from plexus.operators.models import batch_infer

    out = GraphTables()
    if load_image is not None:
        url = F.col(poster_url) if isinstance(poster_url, str) else poster_url
        asked = movies.select("id", url.alias("_url")).where(F.col("_url").isNotNull())
        images = fetch_urls(asked, "id", "_url", fetch=fetch).where(F.col("content").isNotNull()).select("id", "content")
        out.nodes["Image"] = images.withColumn(ID, F.concat(F.lit("image_"), "id"))
        vectors = batch_infer(images, "content", load_image, {"_vector": T.ArrayType(T.FloatType())}).drop("content")
        out.nodes["ImageEmbedding"] = vectors.select(
            F.concat(F.lit("image_embedding_"), "id").alias("id"), F.col("id").alias("_of"), F.lit("image").alias("source"), "_vector")
        out.edges["HasImage"] = asked.join(images.select("id"), "id", "left_semi").select(
            F.col("id").alias(SRC), F.concat(F.lit("image_"), "id").alias(DST), F.lit("HasImage").alias("class"))
        out.edges["HasImageEmbedding"] = out.nodes["ImageEmbedding"].select(
            F.concat(F.lit("image_"), "_of").alias(SRC), F.col("id").alias(DST), F.lit("HasImageEmbedding").alias("class"))
    if load_text is not None:
        vectors = embed_texts(movies.select("id", "tagline"), "tagline", load_text).drop("tagline")
        out.nodes["TaglineEmbedding"] = vectors.select(
            F.concat(F.lit("tagline_embedding_"), "id").alias("id"), F.col("id").alias("_of"), F.lit("tagline").alias("source"), "_vector")
        out.edges["HasTaglineEmbedding"] = out.nodes["TaglineEmbedding"].select(
            F.col("_of").alias(SRC), F.col("id").alias(DST), F.lit("HasTaglineEmbedding").alias("class"))
    return out


def image_table(tables: AnnotationTables, image_path: str) -> DataFrame:
    """J03. Images with size, licence, urls, date, aspect ratio and corpus."""
    return tables.images.select(
        F.concat(F.lit(image_path.rstrip("/") + "/"), "file_name").alias("filename"), "id", "file_name", "height", "width",
        "license", "coco_url", "flickr_url", iso_date("date_captured").alias("date_captured"),
        aspect_ratio("width", "height").alias("aspect_ratio"), url_tail_id("flickr_url").alias("yfcc_id"),
        F.col("corpus").alias("type"), "corpus")


def _named(tables: AnnotationTables, annotations: DataFrame) -> DataFrame:
    """Annotations with the names of their categories, of which there are as few as labels: annotations are not dealt by category."""
    return annotations.join(F.broadcast(tables.categories.select(F.col("id").alias("category_id"), F.col("name").alias("_label"))), "category_id")


def box_table(tables: AnnotationTables) -> DataFrame:
    """J04. Boxes with clamped coordinates, category name and share of the image area."""
    sizes = tables.images.select(F.col("id").alias("image_id"), "width", "height")
    corner = [box_clamp(F.get("bbox", F.lit(i))) for i in range(4)]
    return _named(tables, tables.annotations).join(sizes, "image_id").select(
        "image_id", corner[0].alias("x_pos"), corner[1].alias("y_pos"), corner[2].alias("box_width"), corner[3].alias("box_height"),
        F.col("id").alias("bbox_id"), "category_id", "area", area_share("area", "width", "height").alias("area_perc"),
        F.col("iscrowd").alias("is_crowd"), "_label", "corpus")


# Annotations left out as polygons, self-intersecting or empty.
SELF_INTERSECTING = (112058, 439437, 1739161, 1746989, 1889299, 1903692, 43101, 66776, 72306, 81707, 84930, 100074, 106259,
                     128551, 129193, 138704, 175423, 206849, 211109, 217875, 264532, 265143, 458930, 497030, 512331, 710934,
                     1053842, 1258446, 1271939, 1301323, 1818283)
EMPTY = (918, 2206849)


def polygon_table(tables: AnnotationTables, excluded: tuple[int, ...] = SELF_INTERSECTING + EMPTY) -> DataFrame:
    """J04. Polygons of annotations that are no crowds and not excluded."""
    kept = tables.annotations.where((F.col("iscrowd") == 0) & ~F.col("id").isin(*excluded))
    return _named(tables, kept).select(
        "image_id", F.col("id").alias("ann_id"), "category_id", "_label", "corpus",
        F.transform("segmentation", lambda ring: polygon_pairs(ring)).alias("polygons"))


def mask_edges(tables: AnnotationTables, mask_path: str) -> tuple[DataFrame, DataFrame]:
    """J05. Mask images (one PNG per image) and the edges image to mask."""
    stem = F.substring_index("file_name", ".", 1)
    masks = tables.images.select(F.concat(F.lit(mask_path.rstrip("/") + "/"), stem, F.lit(".png")).alias("filename"),
                                 F.col("id").alias("seg_id"), "corpus")
    edges = tables.images.select(F.lit("segmentation").alias("class"), F.col("id").cast("string").alias(SRC),
                                 F.concat(F.lit("seg_"), "id").alias(DST), "id", "corpus")
    return masks, edges


def attribute_columns(attributes: DataFrame, boxes: DataFrame, images_root: str, key: str = "image_id") -> DataFrame:
    """J06. Attributes joined with boxes; ids become ``cropped_<stem>``, the picture path comes first."""
    rest = [c for c in attributes.join(boxes, key).columns if c != key]
    return attributes.join(boxes, key).select(
        F.concat(F.lit(images_root.rstrip("/") + "/"), F.col(key)).alias("filename"),
        F.concat(F.lit("cropped_"), F.regexp_replace(key, r"\.[^.]*$", "")).alias(key), *rest)


def id_mapping_limit(mapping: DataFrame, limit: int = -1, key: str = "orig_idx") -> DataFrame:
    """J07. The mapping up to an original index; -1 takes all."""
    return mapping if limit == -1 else mapping.where(F.col(key) <= limit)
